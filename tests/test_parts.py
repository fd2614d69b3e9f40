"""Silver kept in parts: what a refresh writes, what it leaves, and marts that follow it."""

import os
import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import at, bronze_clicks, bronze_orders, click, order, plan
from tierflow.contracts import CLICKS, ORDERS
from tierflow.operators import clean, marts, upsert
from tierflow.plans import cycle, gold, silver
from tierflow.plans.lake import Lake
from tierflow.sources import bronze, parts

RUN = "r"


def parted(root, n=16):
    return Lake.under(f"{root}/{uuid.uuid4().hex}", silver_database=f"d{uuid.uuid4().hex}", silver_parts=n)


def land(spark, lake, n, rows, feed=ORDERS):
    make = bronze_orders if feed is ORDERS else bronze_clicks
    bronze.land_batch(make(spark, rows), lake.bronze(feed), RUN, n)


def content(df, without=("processed_at",)):
    return sorted(map(str, df.drop(*without).collect()))


def lie(spark, lake, feed=ORDERS):
    table = lake.silver_parted(feed)
    return parts.locations(spark, table, int(parts.properties(spark, table)["version"]))


def written(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet"))


def test_refresh_writes_only_the_parts_that_change(spark, root):
    lake, whole = parted(root, 64), Lake.under(f"{root}/whole")
    first = [order(f"o{i}", amount=i / 4, timestamp=at(i % 60)) for i in range(3000)]
    later = [order(f"o{i}", amount=999.0, status="paid", timestamp=at(59, 59)) for i in (5, 6, 7)] + [order("new", amount=1.5)]
    stale = [order("o59", amount=0.0, timestamp=at(0))]
    for n, rows in enumerate((first, later + stale)):
        for each in (lake, whole):
            land(spark, each, n, rows)
            out = silver.refresh_silver(spark, each, ORDERS)
        assert out.rows == silver.read_silver(spark, lake, ORDERS).count() == (3000, 3001)[n]
        if n == 0:
            before = lie(spark, lake)
    after = lie(spark, lake)
    moved = {k for k in after if after[k] != before.get(k)}
    keys = spark.createDataFrame([(r[0],) for r in later], "order_id string")
    want = {r[0] for r in keys.select(parts.part_of(ORDERS.dedup, 64)).collect()}
    assert moved == want and 0 < len(moved) <= 4
    folder = lake.silver(ORDERS)
    assert written(f"{folder}/version=2/rows") < 0.2 * written(f"{folder}/version=1/rows")
    assert not os.path.exists(f"{folder}/version=2/updates")
    assert content(silver.read_silver(spark, lake, ORDERS)) == content(silver.read_silver(spark, whole, ORDERS))
    assert (out.rows_in, out.passed) == (5, 5)


def test_stale_updates_write_no_part(spark, root):
    lake = parted(root)
    land(spark, lake, 0, [order("a", timestamp=at(9)), order("b")])
    silver.refresh_silver(spark, lake, ORDERS)
    before = lie(spark, lake)
    land(spark, lake, 1, [order("a", timestamp=at(1))])
    assert silver.refresh_silver(spark, lake, ORDERS).rows == 2
    assert lie(spark, lake) == before
    assert silver.refresh_silver(spark, lake, ORDERS).status == "skipped"
    # ... but with replace the update wins, whatever its time.
    land(spark, lake, 2, [order("a", timestamp=at(1), status="old")])
    silver.refresh_silver(spark, lake, ORDERS, mode="replace")
    got = {r["order_id"]: r["status"] for r in silver.read_silver(spark, lake, ORDERS).collect()}
    assert got["a"] == "old" and len(got) == 2


def test_a_writer_that_died_changes_nothing(spark, root):
    lake = parted(root)
    land(spark, lake, 0, [order("a")])
    silver.refresh_silver(spark, lake, ORDERS)
    os.makedirs(f"{lake.silver(ORDERS)}/version=2/rows/part=3")
    land(spark, lake, 1, [order("b")])
    silver.refresh_silver(spark, lake, ORDERS)
    assert parts.properties(spark, lake.silver_parted(ORDERS))["version"] == "3"
    assert silver.read_silver(spark, lake, ORDERS).count() == 2


def test_old_versions_go_and_what_they_share_stays(spark, root):
    lake = parted(root, 8)
    table, folder = lake.silver_parted(ORDERS), lake.silver(ORDERS)
    land(spark, lake, 0, [order(f"o{i}") for i in range(200)])
    silver.refresh_silver(spark, lake, ORDERS)
    for n in range(1, 5):
        reader = silver.read_silver(spark, lake, ORDERS)
        land(spark, lake, n, [order("o1", timestamp=at(n), amount=float(n))])
        silver.refresh_silver(spark, lake, ORDERS)
        assert reader.count() == 200  # planned before the refresh
    moved = lie(spark, lake)
    assert len({f.rsplit("/", 3)[1] for f in moved.values()}) == 2
    assert os.path.exists(f"{folder}/version=1/rows") and not os.path.exists(f"{folder}/version=2/rows")
    assert len(os.listdir(f"{folder}/version=1/rows")) < 16
    assert not spark.catalog.tableExists(table.version(1)) and spark.catalog.tableExists(table.version(4))
    got = {r["order_id"]: r["amount"] for r in silver.read_silver(spark, lake, ORDERS).collect()}
    assert len(got) == 200 and got["o1"] == 4.0


def test_rebuild_and_other_number_of_parts(spark, root):
    lake = parted(root, 4)
    land(spark, lake, 0, [order("a"), order("b"), order("c")])
    silver.refresh_silver(spark, lake, ORDERS)
    import dataclasses

    wider = dataclasses.replace(lake, silver_parts=32)
    assert silver.rebuild_silver(spark, wider, ORDERS).rows == 3
    assert parts.properties(spark, lake.silver_parted(ORDERS))["parts"] == "32"
    land(spark, lake, 1, [order("d")])
    assert silver.refresh_silver(spark, lake, ORDERS).rows == 4  # dealt as the table is
    assert content(silver.read_silver(spark, lake, ORDERS).select("order_id")) == [f"Row(order_id='{c}')" for c in "abcd"]


def _marts(spark, lake, feed):
    return {name: list(map(tuple, df.collect())) for name, df in gold.load_marts(spark, lake, feed).items()}


def test_marts_follow_changes_without_reading_silver(spark, root, monkeypatch):
    lake, whole = parted(root), Lake.under(f"{root}/whole")
    orders = [
        [order(f"o{i}", product=f"p{i % 7}", amount=i * 0.37, status=f"s{i % 3}", timestamp=at(i % 5)) for i in range(300)],
        [order("o1", product="p9", amount=1e300, timestamp=at(6)), order("o2", product=None, amount=0.1 + 0.2, timestamp=at(9))],
        [order("o1", product="p9", amount=2.0, timestamp=at(7)), order("x", product="p1", status=None, timestamp="bad")],
    ]
    clicks = [
        [click(f"s{i}", page=f"/{i % 40}", device=f"d{i % 2}") for i in range(300)],
        [click(f"s{i}", page="/39", user_id="u2", timestamp=at(0)) for i in range(4)] + [click("t", page="/39")],
        [click("t", page="/new", action="hover")],
    ]
    for n in range(3):
        for each in (lake, whole):
            land(spark, each, n, orders[n])
            land(spark, each, n, clicks[n], CLICKS)
        if n:
            def never(*_):
                raise AssertionError("read all of Silver")

            monkeypatch.setattr(gold, "read_silver", never)
        log = cycle.run_cycle(spark, lake).collect()
        monkeypatch.undo()
        assert all(r["status"] == "ok" for r in log), log
        notes = {r["error"] for r in log if r["step"].startswith("gold")}
        assert notes == ({"by change"} if n else {None})
        cycle.run_cycle(spark, whole)
        for feed in (ORDERS, CLICKS):
            assert _marts(spark, lake, feed) == _marts(spark, whole, feed)


def test_marts_start_anew_where_changes_are_gone(spark, root):
    lake = parted(root)
    land(spark, lake, 0, [order("a", amount=1.0)])
    cycle.run_cycle(spark, lake, feeds=[ORDERS])
    for n in range(1, 5):
        land(spark, lake, n, [order(f"b{n}", amount=1.0)])
        silver.refresh_silver(spark, lake, ORDERS)
    out = gold.refresh_mart(spark, lake, ORDERS, "orders_by_status")
    assert (out.status, out.note) == ("ok", None)
    silver.rebuild_silver(spark, lake, ORDERS)
    assert gold.refresh_mart(spark, lake, ORDERS, "orders_by_status").note is None
    assert gold.refresh_mart(spark, lake, ORDERS, "orders_by_status").status == "skipped"
    assert _marts(spark, lake, ORDERS)["orders_by_status"][0][1] == 5


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 3)), max_size=6), min_size=1, max_size=3))
def test_any_batching_gives_the_same_table(spark, tmp_path_factory, batches):
    lake = parted(str(tmp_path_factory.mktemp("b")), 3)
    rows = []
    for n, batch in enumerate(batches):
        made = [order(f"k{k}", timestamp=at(t), amount=float(a)) for k, t, a in batch]
        rows += made
        if made:
            land(spark, lake, n, made)
            silver.refresh_silver(spark, lake, ORDERS)
    if rows:
        once = clean.clean_orders(bronze_orders(spark, rows))
        cols = ["order_id", "amount", "event_timestamp"]
        assert content(silver.read_silver(spark, lake, ORDERS).select(*cols)) == content(once.select(*cols))


def test_changes_are_old_and_new_rows(spark):
    schema = "k string, t int, v int"
    old = spark.createDataFrame([("a", 1, 1), ("b", 5, 2), (None, 1, 3), ("same", 1, 1)], schema)
    new = spark.createDataFrame([("a", 2, 9), ("b", 4, 9), (None, 2, 9), ("c", 0, 9), ("same", 1, 1)], schema)
    got = upsert.changes(old, new, ["k"], ["t"])
    want = [("a", 1, 1, -1), ("a", 2, 9, 1), (None, 1, 3, -1), (None, 2, 9, 1), ("c", 0, 9, 1)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    table = upsert.with_changes(old, got, ["k"]).collect()
    assert sorted(map(str, map(tuple, table))) == sorted(map(str, [("a", 2, 9), ("b", 5, 2), (None, 2, 9), ("same", 1, 1), ("c", 0, 9)]))
    dealt = upsert.with_changes_in(parts.cell_of(("k",), 3), old, got, ["k"])
    assert sorted(map(str, map(tuple, dealt.collect()))) == sorted(map(str, map(tuple, table)))
    replaced = upsert.changes(old, new, ["k"], ["t"], "replace").where("_sign = 1").collect()
    assert len(replaced) == 5


def test_many_changes_take_one_shuffle(spark, root, monkeypatch):
    """Rows that go to new files are shuffled once, to more cells than parts."""
    monkeypatch.setattr(silver, "CELL_ROWS", 20)
    monkeypatch.setattr(silver, "_broadcast_limit", lambda spark: -1)
    seen = []
    deal = silver.with_changes_in
    monkeypatch.setattr(silver, "with_changes_in", lambda *a: seen.append(deal(*a)) or seen[-1])
    lake = parted(root, 2)
    first = [order(f"o{i}", timestamp=at(1)) for i in range(200)]
    second = [order(f"o{i}", timestamp=at(2), amount=2.0) for i in range(100, 300)]
    for n, rows in enumerate((first, second)):
        land(spark, lake, n, rows)
        silver.refresh_silver(spark, lake, ORDERS)
    got = {r["order_id"]: r["amount"] for r in silver.read_silver(spark, lake, ORDERS).collect()}
    assert got == {f"o{i}": 1.0 if i < 100 else 2.0 for i in range(300)}
    assert len(seen) == 1 and plan(seen[0]).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("small", [True, False])
def test_plans(spark, root, small):
    """Only named parts are opened, and a filter of the updates' keys stands before the shuffle."""
    lake = parted(root)
    land(spark, lake, 0, [order(f"o{i}") for i in range(500)])
    silver.refresh_silver(spark, lake, ORDERS)
    table = lake.silver_parted(ORDERS)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "1")
    if not small:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        updates = silver.read_silver(spark, lake, ORDERS).limit(3).withColumn("part", parts.part_of(ORDERS.dedup, 16))
        updates.write.parquet(f"{root}/u")
        mine = spark.read.parquet(f"{root}/u").where(F.col("part").isin([1, 2, 3]))
        old = upsert.matched(parts.read_version(spark, table, 1, [1, 2, 3]), mine, ORDERS.dedup)
        text = plan(old)
        assert "PartitionFilters: [part#" in text and " IN (1,2,3)" in text
        assert ("might_contain" in text) != small and ("BroadcastHashJoin" in text) == small
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold")


def test_sums_of_marts_read_few_columns(spark, root):
    lake = parted(root)
    land(spark, lake, 0, [order("a")])
    silver.refresh_silver(spark, lake, ORDERS)
    sums = marts.SUMS["orders_revenue_per_product"]
    text = plan(sums.of(silver.read_silver(spark, lake, ORDERS).select(*sums.reads), None))
    assert "ReadSchema: struct<product:string,amount:double>" in text
