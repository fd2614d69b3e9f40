"""Bronze to Silver."""

import random

from pyspark.sql import functions as F

from tests.helpers import at, bronze_clicks, bronze_orders, click, facts, never, order, plan
from tierflow.contracts import CLICKS, ORDERS
from tierflow.operators import clean


def test_required_fields_and_nan(spark):
    rows = [
        order("ok"),
        order(None),
        order("no-user", user_id=None),
        order("no-amount", amount=None),
        order("nan", amount=float("nan")),
        order("", user_id=""),
        order("no-product", product=None),
    ]
    kept = clean.clean_orders(bronze_orders(spark, rows))
    assert sorted(r["order_id"] for r in kept.collect()) == ["", "no-product", "ok"]


def test_status_default(spark):
    kept = clean.clean_orders(bronze_orders(spark, [order("a", status=None), order("b")]))
    assert {r["order_id"]: r["status"] for r in kept.collect()} == {"a": "unknown", "b": "paid"}


def test_latest_event_survives_and_null_time_loses(spark):
    rows = [
        order("a", status="created", timestamp=at(1)),
        order("a", status="shipped", timestamp=at(3)),
        order("a", status="paid", timestamp=at(2)),
        order("a", status="lost", timestamp="bad"),
        order("b", status="only", timestamp="bad"),
    ]
    kept = clean.clean_orders(bronze_orders(spark, rows))
    assert {r["order_id"]: r["status"] for r in kept.collect()} == {"a": "shipped", "b": "only"}


def test_survivor_does_not_depend_on_row_order(spark):
    rows = [order("a", product=p, amount=float(x)) for p in "xyz" for x in range(5)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        spread = bronze_orders(spark, rows).repartition(seed + 1)
        seen.add(str(facts(clean.clean_orders(spread))))
    assert len(seen) == 1


def test_clicks_use_the_whole_key_and_nulls_are_one_value(spark):
    rows = [
        click("s", action="view"),
        click("s", action="view"),
        click("s", action="hover"),
        click("s", action=None),
        click("s", action=None),
        click("s", timestamp="bad"),
        click("s", timestamp="worse"),
        click("s", page=None, action="drop"),
    ]
    kept = clean.clean_clicks(bronze_clicks(spark, rows))
    assert kept.count() == 4


def test_audit_adds_up(spark):
    rows = [order("a"), order("a"), order("b"), order(None), order("c", amount=float("nan"))]
    bronze = bronze_orders(spark, rows)
    row = clean.audit(bronze, ORDERS).first()
    assert row.asDict() == {
        "step": "clean_orders", "rows_in": 5, "rows_out": 2, "dropped_null": 2, "dropped_dup": 1,
    }
    assert clean.clean_orders(bronze).count() == row["rows_out"]


def test_empty_input(spark):
    empty = never(bronze_clicks(spark, [click()]))
    assert clean.clean_clicks(empty).count() == 0
    assert clean.audit(empty, CLICKS).first()["rows_in"] == 0


def test_silver_columns(spark):
    assert clean.clean_orders(bronze_orders(spark, [order()])).columns == ORDERS.silver.fieldNames()


def test_null_checks_reach_the_reader_and_dedup_runs_before_the_shuffle(spark, root):
    bronze_orders(spark, [order()]).write.parquet(f"{root}/b")
    text = plan(clean.clean_orders(spark.read.parquet(f"{root}/b")))
    pushed = text[text.index("PushedFilters"):]
    for name in ORDERS.required:
        assert f"IsNotNull({name})" in pushed
    before_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert "Python" not in text


def test_hot_key_is_cut_before_the_shuffle(spark, root):
    """A third of all rows under one key: each map task passes on one of them."""
    hot = spark.range(0, 30_000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        .alias("order_id"),
        F.lit("u").alias("user_id"),
        F.lit(1.0).alias("amount"),
        F.lit(None).cast("string").alias("status"),
        F.timestamp_seconds("id").alias("event_timestamp"),
    )
    kept = clean.clean_orders(hot)
    kept.write.format("noop").mode("overwrite").save()
    assert kept.count() == 20_001
    top = kept.filter(F.col("order_id") == "hot").select(F.unix_seconds("event_timestamp")).first()
    assert top[0] == 29_997
    assert "Partial" in plan(kept)
