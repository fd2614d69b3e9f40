"""Merging: semantics of both modes and independence from batching."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import at, bronze_clicks, bronze_orders, click, facts, never, order
from tierflow.contracts import CLICKS, ORDERS
from tierflow.operators import clean
from tierflow.operators.upsert import merge_newest, merge_newest_narrow, merge_replace

NEWEST = [merge_newest, merge_newest_narrow]


def silver(spark, rows):
    return clean.clean_orders(bronze_orders(spark, rows))


def statuses(df):
    return {r["order_id"]: r["status"] for r in df.collect()}


def test_replace_always_takes_the_update(spark):
    target = silver(spark, [order("a", status="new", timestamp=at(9)), order("b")])
    updates = silver(spark, [order("a", status="old", timestamp=at(1)), order("c")])
    merged = merge_replace(target, updates, ORDERS.dedup)
    assert statuses(merged) == {"a": "old", "b": "paid", "c": "paid"}


@pytest.mark.parametrize("merge", NEWEST)
def test_newest_refuses_stale_updates(spark, merge):
    target = silver(spark, [order("a", status="new", timestamp=at(9)), order("b", timestamp=at(1))])
    updates = silver(
        spark,
        [
            order("a", status="stale", timestamp=at(1)),
            order("b", status="fresh", timestamp=at(2)),
            order("c"),
        ],
    )
    merged = merge(target, updates, ORDERS.dedup, ORDERS.survivor)
    assert statuses(merged) == {"a": "new", "b": "fresh", "c": "paid"}
    assert merged.columns == target.columns


def test_null_key_is_inserted_unless_nulls_match(spark):
    rows = [click("s", action=None)]
    target = clean.clean_clicks(bronze_clicks(spark, rows))
    assert merge_replace(target, target, CLICKS.dedup).count() == 2
    assert merge_replace(target, target, CLICKS.dedup, nulls_match=True).count() == 1
    for merge in NEWEST:
        assert merge(target, target, CLICKS.dedup, CLICKS.survivor).count() == 1


def test_first_load_is_an_upsert_into_nothing(spark):
    rows = silver(spark, [order("a"), order("b")])
    assert facts(merge_replace(never(rows), rows, ORDERS.dedup)) == facts(rows)
    for merge in NEWEST:
        assert facts(merge(never(rows), rows, ORDERS.dedup, ORDERS.survivor)) == facts(rows)


@pytest.mark.parametrize("merge", NEWEST)
def test_new_column_is_null_in_old_rows(spark, merge):
    target = silver(spark, [order("a"), order("b")])
    updates = silver(spark, [order("b", timestamp=at(5))]).withColumn("channel", F.lit("web"))
    merged = merge(target, updates, ORDERS.dedup, ORDERS.survivor)
    assert {r["order_id"]: r["channel"] for r in merged.collect()} == {"a": None, "b": "web"}
    replaced = merge_replace(target, updates, ORDERS.dedup)
    assert {r["order_id"]: r["channel"] for r in replaced.collect()} == {"a": None, "b": "web"}


@pytest.mark.parametrize("merge", NEWEST)
@pytest.mark.parametrize("seed", range(3))
def test_any_batching_gives_the_latest_per_key(spark, root, merge, seed):
    draw = random.Random(seed)
    rows = [
        order(
            f"o{draw.randrange(12)}",
            product=draw.choice(["x", "y", None]),
            amount=float(draw.randrange(4)),
            status=draw.choice(["paid", "shipped", None]),
            timestamp=draw.choice([at(draw.randrange(6)), "bad"]),
        )
        for _ in range(60)
    ]
    once = facts(silver(spark, rows))
    draw.shuffle(rows)
    cuts = sorted(draw.sample(range(1, 60), 3))
    batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 60])]
    batches.append(batches[1])
    table = never(silver(spark, rows[:1]))
    for n, batch in enumerate(batches):
        merged = merge(table, silver(spark, batch), ORDERS.dedup, ORDERS.survivor)
        merged.write.parquet(f"{root}/{n}")
        table = spark.read.parquet(f"{root}/{n}")
    assert facts(table) == once
