"""Stored layers: snapshots, Bronze batches, compaction, refreshes."""

import dataclasses
import os

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tests.helpers import at, bronze_clicks, bronze_orders, click, facts, order
from tierflow.contracts import CLICKS, MART_SCHEMAS, ORDERS
from tierflow.operators import clean
from tierflow import session
from tierflow.plans import cycle, gold, silver, upkeep
from tierflow.plans.lake import Lake
from tierflow.plans.stats import stored_layers
from tierflow.session import require_utc, shared_root, work_dir
from tierflow.sources import bronze, feeds, files, snapshots
from tierflow.streaming import ingest

RUN = "r"


def ids(df):
    return sorted(r["order_id"] for r in df.collect())


def read(spark, path, after=None):
    return bronze.read_bronze(spark, path, ORDERS.bronze_stored, after)


# --- snapshots


def test_readers_take_the_last_committed_snapshot(spark, root):
    path = f"{root}/t"
    assert snapshots.latest_snapshot(spark, path) is None
    assert snapshots.write_table(spark, path, spark.range(3)) == 3
    assert snapshots.write_table(spark, path, spark.range(5)) == 5
    os.makedirs(f"{path}/snapshot=3/rows")
    assert snapshots.latest_snapshot(spark, path) == 2
    assert snapshots.next_snapshot(spark, path) == 4
    assert snapshots.read_table(spark, path).count() == 5


def test_schema_may_change_between_snapshots(spark, root):
    snapshots.write_table(spark, f"{root}/t", spark.range(3))
    other = spark.range(2).select(F.lit("x").alias("name"))
    snapshots.write_table(spark, f"{root}/t", other)
    assert snapshots.read_table(spark, f"{root}/t").columns == ["name"]


def test_old_snapshots_go(spark, root):
    path = f"{root}/t"
    for n in range(4):
        snapshots.write_table(spark, path, spark.range(n))
    snapshots.drop_old_snapshots(spark, path, keep=2)
    assert files.child_dirs(spark, path) == ["snapshot=3", "snapshot=4"]


def test_missing_table_is_empty_but_a_broken_one_raises(spark, root):
    schema = MART_SCHEMAS["orders_by_status"]
    empty = snapshots.read_or_empty(spark, f"{root}/none", schema)
    assert (empty.count(), empty.columns) == (0, ["status", "order_count"])
    with pytest.raises(FileNotFoundError):
        snapshots.read_table(spark, f"{root}/none")
    os.makedirs(f"{root}/bad/snapshot=1/rows")
    for name in ("_SUCCESS", "part-0.parquet"):
        with open(f"{root}/bad/snapshot=1/rows/{name}", "w") as f:
            f.write("x")
    with pytest.raises(Exception, match="(?i)parquet|footer|read"):
        snapshots.read_or_empty(spark, f"{root}/bad", schema).collect()


def test_catalog_is_sorted_and_flags_what_is_no_table(spark, root):
    snapshots.write_table(spark, f"{root}/b", spark.range(1))
    os.makedirs(f"{root}/a")
    assert [tuple(r) for r in snapshots.catalog(spark, root).collect()] == [
        ("a", False, None), ("b", True, 1),
    ]
    assert snapshots.catalog(spark, f"{root}/nowhere").count() == 0


# --- Bronze


def test_replayed_batch_lands_once(spark, root):
    rows = bronze_orders(spark, [order("a"), order("b")])
    assert bronze.land_batch(rows, root, RUN, 0) == 2
    assert bronze.land_batch(rows, root, RUN, 0) == 2
    assert ids(read(spark, root)) == ["a", "b"]


def test_another_run_never_overwrites(spark, root):
    bronze.land_batch(bronze_orders(spark, [order("a")]), root, "r1", 0)
    bronze.land_batch(bronze_orders(spark, [order("b")]), root, "r2", 0)
    assert ids(read(spark, root)) == ["a", "b"]


def test_empty_batch_leaves_nothing(spark, root):
    rows = bronze_orders(spark, [order("a")]).filter(F.lit(False))
    assert bronze.land_batch(rows, root, RUN, 0) == 0
    assert read(spark, root) is None


def test_unfinished_batch_is_not_read(spark, root):
    bronze.land_batch(bronze_orders(spark, [order("a")]), root, RUN, 0)
    bronze.land_batch(bronze_orders(spark, [order("b")]), root, RUN, 1)
    os.remove(f"{root}/live/run={RUN}/batch_id=1/_SUCCESS")
    assert ids(read(spark, root)) == ["a"]


def test_new_column_merges(spark, root):
    rows = bronze_orders(spark, [order("a")])
    bronze.land_batch(rows, root, RUN, 0)
    bronze.land_batch(rows.withColumn("channel", F.lit("web")), root, RUN, 1)
    merged = bronze.read_bronze(spark, root, schema=None)
    assert sorted((r["batch_id"], r["channel"]) for r in merged.collect()) == [
        (0, None), (1, "web"),
    ]
    assert "channel" not in read(spark, root).columns


def test_compaction_keeps_rows_and_marks(spark, root):
    for n in range(6):
        bronze.land_batch(bronze_orders(spark, [order(f"o{n}")]), root, RUN, n)
    before = facts(read(spark, root))
    assert bronze.compact(spark, root, RUN, 2, ORDERS.bronze_stored) == 3
    assert facts(read(spark, root)) == before
    bronze.drop_packed_batches(spark, root, RUN)
    assert files.numbered(spark, f"{root}/live/run={RUN}", "batch_id") == [3, 4, 5]
    assert bronze.compact(spark, root, RUN, 4, ORDERS.bronze_stored) == 2
    assert bronze.compact(spark, root, RUN, 4, ORDERS.bronze_stored) == 0
    assert facts(read(spark, root)) == before
    assert ids(read(spark, root, {RUN: 1})) == ["o2", "o3", "o4", "o5"]
    assert ids(read(spark, root, {RUN: 4})) == ["o5"]
    assert read(spark, root, {RUN: 5}) is None
    assert ids(read(spark, root, {"other": 9})) == [f"o{n}" for n in range(6)]
    assert bronze.marks_of(bronze.extents(spark, root)) == {RUN: 5}


def test_compaction_joins_small_files_without_a_shuffle(spark, root):
    rows = bronze_orders(spark, [order(f"o{n}") for n in range(100)])
    for n in range(3):
        bronze.land_batch(rows.repartition(5), root, RUN, n)
    folder = f"{root}/packed/run={RUN}/upto"

    def parts(upto):
        return [f for f in os.listdir(f"{folder}={upto}") if f.endswith(".parquet")]

    assert bronze.compact(spark, root, RUN, 1, ORDERS.bronze_stored) == 200
    assert len(parts(1)) == 1
    assert bronze.compact(spark, root, RUN, 2, ORDERS.bronze_stored, file_bytes=6_000) == 100
    assert len(parts(2)) > 1
    assert read(spark, root).count() == 300


# --- Silver


def land(spark, lake, batches, start=0):
    for n, rows in enumerate(batches, start):
        bronze.land_batch(bronze_orders(spark, rows), lake.bronze(ORDERS), RUN, n)


def table(spark, lake):
    return snapshots.read_table(spark, lake.silver(ORDERS))


@pytest.mark.parametrize("broadcast_limit", ["10485760", "-1"])
def test_incremental_equals_rebuild(spark, root, broadcast_limit):
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        lake = Lake.under(root)
        land(spark, lake, [[order("a", status="created", timestamp=at(1)), order("b")]])
        assert silver.refresh_silver(spark, lake, ORDERS) == silver.Outcome(
            "ok", 2, None, 2, 0, 0, 2
        )
        second = [
            [order("a", status="paid", timestamp=at(2)), order("c"), order(None)],
            [order("a", status="stale", timestamp=at(0)), order("c")],
        ]
        land(spark, lake, second, start=1)
        assert silver.refresh_silver(spark, lake, ORDERS) == silver.Outcome("ok", 3, None, 5, 1, 2, 2)
        assert silver.read_marks(spark, lake.silver(ORDERS)) == {RUN: 2}
        refreshed = facts(table(spark, lake))
        assert silver.refresh_silver(spark, lake, ORDERS).status == "skipped"
        assert silver.rebuild_silver(spark, lake, ORDERS) == silver.Outcome("ok", 3, None, 7, 1, 3, 3)
        assert facts(table(spark, lake)) == refreshed
        assert silver.refresh_silver(spark, lake, ORDERS).status == "skipped"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)


def test_refresh_reads_across_packed_batches(spark, root):
    lake = Lake.under(root)
    land(spark, lake, [[order("a")], [order("b")]])
    silver.refresh_silver(spark, lake, ORDERS)
    land(spark, lake, [[order("c")], [order("d")]], start=2)
    bronze.compact(spark, lake.bronze(ORDERS), RUN, 3, ORDERS.bronze_stored)
    bronze.drop_packed_batches(spark, lake.bronze(ORDERS), RUN)
    silver.refresh_silver(spark, lake, ORDERS)
    assert ids(table(spark, lake)) == ["a", "b", "c", "d"]


def test_replace_mode_and_its_unique_key_check(spark, root):
    lake = Lake.under(root)
    path = lake.silver(ORDERS)

    def cleaned(rows):
        return clean.clean_orders(bronze_orders(spark, rows))

    silver.upsert_table(spark, path, cleaned([order("a", timestamp=at(9))]), ORDERS)
    old = cleaned([order("a", status="old", timestamp=at(1))])
    assert silver.upsert_table(spark, path, old, ORDERS, mode="replace") == (1, 1)
    assert table(spark, lake).first()["status"] == "old"
    with pytest.raises(ValueError, match="several rows"):
        silver.upsert_table(spark, path, old.unionByName(old), ORDERS, mode="replace")
    assert table(spark, lake).count() == 1
    with pytest.raises(ValueError, match="unknown mode"):
        silver.upsert_table(spark, path, old, ORDERS, mode="other")


def test_tables_without_row_level_changes_refuse_merge(spark, root):
    rows = clean.clean_orders(bronze_orders(spark, [order("a")]))
    spark.sql(f"CREATE TABLE merge_target USING parquet LOCATION '{root}/m' AS SELECT 1 AS one")
    try:
        with pytest.raises(AnalysisException):
            silver.merge_into_catalog_table(rows, "merge_target", ORDERS)
    finally:
        spark.sql("DROP TABLE merge_target")


def test_update_size_does_not_change_the_table(spark, root):
    """Ties on all survivor columns: clock columns decide, with and without broadcast."""
    tables = []
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old = clean.clean_orders(bronze_orders(spark, [order("a"), order("b")]))
    new = old.withColumn("processed_at", F.col("processed_at") + F.expr("INTERVAL 1 DAY"))
    for limit in ("-1", saved):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        path = f"{root}/silver{len(tables)}"
        silver.upsert_table(spark, path, old.persist(), ORDERS)
        silver.upsert_table(spark, path, new.persist(), ORDERS)
        tables.append(facts(snapshots.read_table(spark, path), drop=()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert tables[0] == tables[1] == facts(new, drop=())


def test_silver_in_the_catalog(spark, root):
    """First load, reading and rebuild; the row-level merge needs a table format that is not here."""
    lake = dataclasses.replace(Lake.under(root), silver_catalog="lake_test")
    spark.sql(f"CREATE DATABASE lake_test LOCATION '{root}/db'")
    try:
        land(spark, lake, [[order("a"), order("b"), order("a", status="x", timestamp=at(3))]])
        assert silver.refresh_silver(spark, lake, ORDERS) == silver.Outcome("ok", 2, None, 3, 0, 1, 2)
        assert silver.refresh_silver(spark, lake, ORDERS).status == "skipped"
        assert gold.refresh_mart(spark, lake, ORDERS, "orders_by_status").rows == 2
        assert gold.refresh_mart(spark, lake, ORDERS, "orders_by_status").status == "skipped"
        land(spark, lake, [[order("c")]], start=1)
        with pytest.raises(PySparkException, match="MERGE"):
            silver.refresh_silver(spark, lake, ORDERS)
        assert spark.table("lake_test.orders").count() == 2
        assert silver.rebuild_silver(spark, lake, ORDERS).rows == 3  # nothing was marked as taken
        assert silver.refresh_silver(spark, lake, ORDERS).status == "skipped"
        assert gold.refresh_mart(spark, lake, ORDERS, "orders_by_status").status == "ok"
    finally:
        spark.sql("DROP DATABASE lake_test CASCADE")


# --- upkeep


def test_packing_as_a_step(spark, root):
    lake = Lake.under(root)
    land(spark, lake, [[order(str(n))] for n in range(6)])
    how = upkeep.Packing(min_batches=3, delay_seconds=0)
    log = {r["step"]: r for r in cycle.run_cycle(spark, lake, packing=how).collect()}
    assert (log["pack_orders"]["status"], log["pack_orders"]["rows"]) == ("ok", 5)
    assert log["pack_clicks"]["status"] == "skipped"
    assert bronze.extents(spark, lake.bronze(ORDERS)) == [bronze.Extent(RUN, (4,), (5,))]
    assert upkeep.pack(spark, lake, ORDERS, how).status == "skipped"
    land(spark, lake, [[order("new")]] * 4, start=6)
    slow = upkeep.Packing(min_batches=3, delay_seconds=3600)
    assert upkeep.pack(spark, lake, ORDERS, slow).rows == 4
    live = files.numbered(spark, f"{lake.bronze(ORDERS)}/live/run={RUN}", "batch_id")
    assert live == [5, 6, 7, 8, 9]  # packed, but readers may still want them
    rows = bronze.read_bronze(spark, lake.bronze(ORDERS), ORDERS.bronze_stored)
    assert rows.count() == 10


def test_listing_asks_only_above_the_mark(spark, root, monkeypatch):
    for n in range(1000):
        folder = f"{root}/live/run={RUN}/batch_id={n}"
        os.makedirs(folder)
        open(f"{folder}/_SUCCESS", "w").close()
    calls = []
    for name in ("child_dirs", "is_complete"):
        real = getattr(files, name)
        monkeypatch.setattr(files, name, lambda s, p, real=real: calls.append(p) or real(s, p))
    found = bronze.extents(spark, root, {RUN: 994})
    assert found == [bronze.Extent(RUN, (), (995, 996, 997, 998, 999))]
    assert len(calls) == 3 + 5


# --- cycle and reads


def test_cycle_on_an_empty_lake_skips_everything(spark, root):
    log = cycle.run_cycle(spark, Lake.under(root)).collect()
    assert {r["status"] for r in log} == {"skipped"} and len(log) == 8
    lake = Lake.under(root)
    for feed in (ORDERS, CLICKS):
        assert all(m.count() == 0 for m in gold.load_marts(spark, lake, feed).values())
    assert [tuple(r) for r in stored_layers(spark, lake).collect()] == [
        ("bronze", 0, 0, 0), ("silver", 0, 0, 0),
    ]
    assert gold.gold_catalog(spark, lake).count() == 0


def test_cycle_reports_and_stores(spark, root):
    lake = Lake.under(root)
    land(spark, lake, [[order("a", product="x"), order("a", product="x"), order("b", product="y")]])
    bronze.land_batch(bronze_clicks(spark, [click()]), lake.bronze(CLICKS), RUN, 0)
    log = {r["step"]: r for r in cycle.run_cycle(spark, lake, 7).collect()}
    assert {r["status"] for r in log.values()} == {"ok"}
    assert log["silver_orders"]["rows"] == 2 and log["silver_orders"]["cycle"] == 7
    assert log["gold_orders_revenue_per_product"]["rows"] == 2
    assert [tuple(r) for r in stored_layers(spark, lake).collect()] == [
        ("bronze", 3, 1, 4), ("silver", 2, 1, 3),
    ]
    marts = gold.load_marts(spark, lake, ORDERS)
    assert [r["product"] for r in marts["orders_revenue_per_product"].collect()] == ["x", "y"]
    again = cycle.run_cycle(spark, lake, 8).collect()
    assert {(r["status"], r["error"]) for r in again} == {
        ("skipped", "no new bronze batches"), ("skipped", "silver unchanged"),
    }
    forced = gold.refresh_mart(spark, lake, ORDERS, "orders_by_status", force=True)
    assert forced == gold.Outcome("ok", 1)
    land(spark, lake, [[order("c", product="z")]], start=1)
    third = {r["step"]: r["status"] for r in cycle.run_cycle(spark, lake, 9).collect()}
    assert third["gold_orders_by_status"] == "ok" and third["gold_clicks_top_pages"] == "skipped"
    marts = gold.load_marts(spark, lake, ORDERS)
    assert marts["orders_revenue_per_product"].count() == 3


def test_failing_step_does_not_stop_the_others(spark, root):
    lake = Lake.under(root)
    land(spark, lake, [[order("a")]])
    bronze.land_batch(bronze_clicks(spark, [click()]), lake.bronze(CLICKS), RUN, 0)
    folder = f"{lake.bronze(ORDERS)}/live/run={RUN}/batch_id=0"
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            with open(f"{folder}/{name}", "w") as f:
                f.write("broken")
        elif name.endswith(".crc"):
            os.remove(f"{folder}/{name}")
    log = {r["step"]: r for r in cycle.run_cycle(spark, lake).collect()}
    assert log["silver_orders"]["status"] == "failed" and log["silver_orders"]["error"]
    assert log["silver_clicks"]["status"] == "ok"
    assert log["gold_clicks_top_pages"]["status"] == "ok"
    assert log["gold_orders_by_status"]["status"] == "skipped"


def test_lake_from_environment(monkeypatch):
    monkeypatch.setenv("SILVER_PATH", "s3a://bucket/silver")
    lake = Lake.from_env()
    assert lake.silver(ORDERS) == "s3a://bucket/silver/orders"
    assert lake.bronze(CLICKS) == "/data/bronze/clicks"


@pytest.mark.parametrize("master, ok", [("local", True), ("local[8]", True), ("local[*]", True),
                                        ("local-cluster[3,2,512]", False), ("yarn", False)])
def test_only_a_local_session_may_go_without_a_shared_folder(monkeypatch, master, ok):
    class Session:
        class conf:
            get = staticmethod(lambda name, default: default)

        class sparkContext:
            applicationId = "x"

    Session.sparkContext.master = master
    monkeypatch.setattr(session, "_private_root", lambda app: "/private")
    if ok:
        assert shared_root(Session) == "/private"
    else:
        with pytest.raises(ValueError, match="checkpoint.dir"):
            shared_root(Session)


def test_jobs_refuse_another_zone(spark, root):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        lake = Lake.under(root)
        for job in (
            lambda: silver.refresh_silver(spark, lake, ORDERS),
            lambda: silver.rebuild_silver(spark, lake, ORDERS),
            lambda: gold.refresh_mart(spark, lake, ORDERS, "orders_by_status"),
            lambda: feeds.table(spark, root, "orders"),
            lambda: ingest.start_stream(spark, ORDERS, lake, "parquet", {"path": root}),
        ):
            with pytest.raises(ValueError, match="UTC"):
                job()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_session_rules(spark):
    require_utc(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_root(spark) == named.rstrip("/")
    assert work_dir(spark, "x") != work_dir(spark, "x")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
