"""Gold marts."""

import math
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import at, bronze_clicks, bronze_orders, click, never, order, plan
from tierflow.functions import money
from tierflow.operators import clean, marts


def silver(spark, rows):
    return clean.clean_orders(bronze_orders(spark, rows))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_revenue_per_product(spark):
    data = [
        order("1", product="a", amount=0.1),
        order("2", product="a", amount=0.2),
        order("3", product="b", amount=10.0),
        order("4", product=None, amount=0.3),
    ]
    assert rows(marts.revenue_per_product(silver(spark, data))) == [
        ("b", 10.0, 1, 10.0),
        (None, 0.3, 1, 0.3),
        ("a", 0.3, 2, 0.15),
    ]


def sum_and_mean(df):
    """Of all rows, by way of partial sums."""
    one = df.withColumn("k", F.lit(0))
    got = money.totals(money.partial_sums(one, ["k"], "amount"), ["k"], "total", "n", "mean")
    return tuple(got.select("total", "mean").first())


def exact(amounts):
    """Sum and mean of the amounts as Spark writes them, rounded once."""
    with localcontext() as c:
        c.prec = 1500
        total = sum(Decimal(a) for a in amounts)
        cents = [x.quantize(Decimal("0.01"), ROUND_HALF_UP) for x in (total, total / len(amounts))]
    return tuple(float(x) for x in cents)


INF = float("inf")


@pytest.mark.parametrize(
    ("amounts", "expected"),
    [
        ([0.01, 0.02], (0.03, 0.02)),
        ([-0.01, -0.02], (-0.03, -0.02)),
        ([0.01, 0.01, 0.02], (0.04, 0.01)),
        ([1.005], (1.01, 1.01)),
        ([0.333, 0.333, 0.333], (1.0, 0.33)),
        ([0.004] * 10, (0.04, 0.0)),
        ([5.0, -5.0], (0.0, 0.0)),
        ([999_999_999.99, 0.01], (1e9, 5e8)),
        ([1e9] * 8 + [0.3], (8_000_000_000.3, 888_888_888.92)),
        ([3e15, 0.25, 3e15, 0.01], (6_000_000_000_000_000.0, 1_500_000_000_000_000.06)),
        ([1e-7] * 100_000, (0.01, 0.0)),
        ([1e-9] * 5_000_000, (0.01, 0.0)),
        ([0.005, 1e-8], (0.01, 0.0)),
        ([0.004999999999], (0.0, 0.0)),
        ([-0.005], (-0.01, -0.01)),
        ([1e19, 0.01], (1e19, 5e18)),
        ([1e300, 1.0], (1e300, 5e299)),
        ([1e300, 0.015, -1e300], (0.02, 0.01)),
        ([1e20, 1e-9, -1e20], (0.0, 0.0)),
        ([-1e20, 5.0], (-1e20, -5e19)),
        ([5e-324] * 3, (0.0, 0.0)),
        ([1.7e308] * 30, (INF, 1.7e308)),
        ([INF, -1e300], (INF, INF)),
        ([-INF, 1.0], (-INF, -INF)),
    ],
)
def test_sums_and_means_round_half_away_from_zero(spark, amounts, expected):
    df = spark.createDataFrame([(a,) for a in amounts[:100]], "amount double")
    if len(amounts) > 100:
        df = spark.range(len(amounts)).select(F.lit(amounts[0]).alias("amount"))
    assert sum_and_mean(df) == expected


def test_sum_of_nothing_is_null(spark):
    assert sum_and_mean(spark.createDataFrame([(None,)], "amount double")) == (None, None)


def test_sum_does_not_depend_on_partitioning(spark):
    df = spark.range(100_000).select((F.col("id") % 1000 / 100 + 0.01).alias("amount"))
    written = [r[0] for r in df.select(F.col("amount").cast("string")).collect()]
    assert {sum_and_mean(df.repartition(n)) for n in (1, 3, 8)} == {exact(written)}


@pytest.mark.parametrize("scale", [1e-300, 1e-7, 0.01, 1.0, 1e9, 3e15, 1e20, 1e290])
def test_sum_is_exact_for_amounts_of_any_size(spark, scale):
    """Like an exact decimal sum, however the rows are spread."""
    draw = random.Random(str(scale))
    amounts = [i % 97 * scale + i % 7 / 10 for i in range(1000)]
    amounts += [draw.choice([-1, 1]) * draw.random() * scale for _ in range(500)]
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    want = exact([r[0] for r in df.select(F.col("amount").cast("string")).collect()])
    assert {sum_and_mean(df.repartition(n)) for n in (1, 3, 7)} == {want}


def test_nan_and_both_infinities_have_no_sum(spark):
    for amounts in ([float("nan"), 1.0], [INF, -INF], [float("nan"), INF]):
        got = sum_and_mean(spark.createDataFrame([(a,) for a in amounts], "amount double"))
        assert all(math.isnan(x) for x in got)


def test_sums_hold_beyond_64_bit_millionths(spark):
    """A trillion rows of 2499.99, from the partial sums of ten thousand tasks."""
    parts = spark.createDataFrame(
        [(0, None, 0, 249_999 * 10**8, None, 0, 0, 0, 10**8, 10**8)] * 10_000, f"k int, {money.PARTIAL_SCHEMA}"
    )
    got = money.totals(money.merged(parts, ["k"]), ["k"], "total", "n", "mean").first()
    assert tuple(got) == (0, 2.49999e15, 10**12, 2499.99)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.floats() | st.just(0.1) | st.none(), st.booleans()), min_size=1, max_size=60))
def test_rows_taken_back_leave_the_sums_of_the_others(spark, data):
    schema = "k int, amount double, gone boolean, sign int"
    rows = spark.createDataFrame([(*d, 1) for d in data], schema)
    back = rows.where("gone").withColumn("sign", F.lit(-1))
    kept = money.partial_sums(rows.where("NOT gone"), ["k"], "amount")
    changes = money.partial_sums(rows.where("gone").unionByName(back), ["k"], "amount", "sign")
    later = money.merged(money.partial_sums(rows, ["k"], "amount").unionByName(money.partial_sums(back, ["k"], "amount", "sign")), ["k"])

    def end(partials):
        return sorted(map(str, money.totals(partials, ["k"], "total", "n", "mean").collect()))

    assert end(later) == end(kept)
    assert money.merged(changes, ["k"]).count() == 0


def test_status_counts_and_shares(spark):
    data = [order(str(i), status=s) for i, s in enumerate(["paid", "paid", None, "created"])]
    assert rows(marts.orders_by_status(silver(spark, data))) == [
        ("paid", 2), ("created", 1), ("unknown", 1),
    ]
    assert rows(marts.status_share(silver(spark, data))) == [
        ("paid", 2, 0.5), ("created", 1, 0.25), ("unknown", 1, 0.25),
    ]


def test_minutes_with_null_bucket_first(spark):
    data = [
        order("1", amount=1.0, timestamp=at(1, 5)),
        order("2", amount=2.0, timestamp=at(1, 59)),
        order("3", amount=4.0, timestamp=at(0)),
        order("4", amount=8.0, timestamp="bad"),
    ]
    got = marts.revenue_per_minute(silver(spark, data))
    assert [(str(r["minute"]), r["revenue"]) for r in got.collect()] == [
        ("None", 8.0), ("2024-01-01 00:00:00", 4.0), ("2024-01-01 00:01:00", 3.0),
    ]


def test_top_pages_ties_and_limit(spark):
    data = [click(f"s{i}-{n}", page=f"/{i}") for i in range(12) for n in range(1 + (i == 7))]
    silver_clicks = clean.clean_clicks(bronze_clicks(spark, data))
    got = rows(marts.top_pages(silver_clicks))
    assert got[0] == ("/7", 2) and len(got) == 10
    assert [p for p, _ in got[1:]] == sorted(f"/{i}" for i in range(12) if i != 7)[:9]
    assert rows(marts.top_pages(silver_clicks, 1)) == [("/7", 2)]


def test_actions_and_devices(spark):
    data = [click("a", action="view"), click("b", action="view"), click("c", action="hover")]
    silver_clicks = clean.clean_clicks(bronze_clicks(spark, data))
    assert rows(marts.top_actions(silver_clicks)) == [("view", 2), ("hover", 1)]
    assert rows(marts.events_per_device(silver_clicks)) == [("mobile", 3)]


def test_empty_input(spark):
    empty = never(silver(spark, [order()]))
    for mart in marts.MARTS["orders"].values():
        assert mart(empty).count() == 0
    assert marts.status_share(empty).count() == 0


def test_mart_row_totals_are_the_silver_rows(spark):
    data = [order(str(i), product=f"p{i % 7}", status=f"s{i % 3}") for i in range(50)]
    table = silver(spark, data)
    for mart in (marts.revenue_per_product, marts.orders_by_status):
        assert mart(table).agg(F.sum("order_count")).first()[0] == 50


def test_plans(spark, root):
    silver(spark, [order()]).write.parquet(f"{root}/o")
    clean.clean_clicks(bronze_clicks(spark, [click()])).write.parquet(f"{root}/c")
    stored, visits = spark.read.parquet(f"{root}/o"), spark.read.parquet(f"{root}/c")
    assert "TakeOrderedAndProject" in plan(marts.top_pages(visits))
    assert "ReadSchema: struct<product:string,amount:double>" in plan(
        marts.revenue_per_product(stored)
    )
    share = marts.status_share(stored)
    share.collect()
    assert "ReusedExchange" in plan(share) and "Window" not in plan(share)
    for text in (plan(m(stored)) for m in marts.MARTS["orders"].values()):
        assert "partial_" in text and "Python" not in text
