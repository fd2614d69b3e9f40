"""Given tables whose files have few row groups."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.helpers import plan
from tests.test_oracle import SF_DIR
from tierflow.sources import feeds, files

OPEN_COST = "spark.sql.files.openCostInBytes"


def _with_small_splits(spark, use):
    before = spark.conf.get(OPEN_COST)
    spark.conf.set(OPEN_COST, "4096")
    try:
        return use()
    finally:
        spark.conf.set(OPEN_COST, before)


def _rows_per_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_rows_of_one_row_group_are_read_by_one_task_and_decoded_by_all(spark, root):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").coalesce(1)
    lines.write.option("parquet.block.size", 1 << 30).parquet(f"{root}/lineitem.parquet")

    def use():
        assert len(_rows_per_task(spark.read.parquet(f"{root}/lineitem.parquet"))) == 1
        decoded = entry.decode_orders(spark, root)
        n = _rows_per_task(decoded)
        assert sum(n) == lines.count()
        assert len(n) >= 8 and max(n) <= 2 * sum(n) / 8
        plain = entry.decode_orders(spark, SF_DIR)
        assert decoded.exceptAll(plain).isEmpty() and plain.exceptAll(decoded).isEmpty()
        early = entry._lines_shipped(spark, root, end="1997-01-01")
        assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in plan(early)
        assert "l_quantity" not in plan(early)

    _with_small_splits(spark, use)


def test_well_split_and_small_tables_stay_as_they_lie(spark, root):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    lines.repartition(16).write.parquet(f"{root}/lineitem.parquet")
    assert "Exchange" not in plan(feeds.table(spark, SF_DIR, "region"))
    _with_small_splits(spark, lambda: _check_no_exchange(spark, root))


def _check_no_exchange(spark, root):
    assert "Exchange" not in plan(feeds.table(spark, root, "lineitem"))
    feeds.table(spark, root, "lineitem").limit(0).write.parquet(f"{root}/none.parquet")
    assert feeds.spread(spark.read.parquet(f"{root}/none.parquet")).isEmpty()


def test_lines_of_one_row_group_are_landed_by_all_tasks(spark, root):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").coalesce(1)
    lines.write.option("parquet.block.size", 1 << 30).parquet(f"{root}/sf/lineitem.parquet")
    _with_small_splits(spark, lambda: entry._land_lines_by_period(spark, f"{root}/sf", f"{root}/bronze", range(2)))
    for n in range(2):
        path = f"{root}/bronze/live/run={entry.RUN}/batch_id={n}"
        assert len([f for f in files.child_files(spark, path) if f.endswith(".parquet")]) >= 8


def test_gold_catalog_makes_events_of_the_lines_once(spark, monkeypatch):
    made, order_lines = [], entry.order_lines
    monkeypatch.setattr(entry, "order_lines", lambda *args: made.append(args) or order_lines(*args))
    rows = {r["table"]: (r["valid"], r["rows"]) for r in entry.gold_catalog(spark, "/root/testdata/sf0.001").collect()}
    assert rows["scratch"] == (0, None) and rows["orders_by_status"][0] == 1
    assert len(made) == 1
