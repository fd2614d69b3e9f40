"""Bronze to Silver: required fields, typing, one row per key, row accounting
(P7-P9, A13-A15)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.contracts import CLICKS, ORDERS, Feed
from tierflow.functions.times import clock_now

UNKNOWN_STATUS = "unknown"


def latest_per_key(df: DataFrame, keys: Sequence[str], survivor: Sequence[str]) -> DataFrame:
    """Keeps, per key, the row that is largest in ``survivor`` (nulls lose).

    Spark turns rank-one-of-window into a group limit that also runs before the
    shuffle, so at most one row per key leaves each task: a key that holds a
    third of the table costs one row per task in the exchange, not a hot partition.
    Null key parts compare equal.
    """
    window = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in survivor if c not in keys]
    )
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def has_required(df: DataFrame, required: Sequence[str]) -> Column:
    """All named columns present and, for floating point, not NaN.

    Written as null checks because these reach the Parquet reader; ``dropna`` does not.
    """
    floating = {name for name, kind in df.dtypes if kind in ("double", "float")}
    tests = [F.col(c).isNotNull() for c in required]
    tests += [~F.isnan(c) for c in required if c in floating]
    return reduce(and_, tests)


def typed_orders(bronze: DataFrame) -> DataFrame:
    return (
        bronze.filter(has_required(bronze, ORDERS.required))
        .withColumn("amount", F.col("amount").try_cast("double"))
        .withColumn("status", F.coalesce(F.col("status"), F.lit(UNKNOWN_STATUS)))
    )


def typed_clicks(bronze: DataFrame) -> DataFrame:
    return bronze.filter(has_required(bronze, CLICKS.required))


_TYPED = {ORDERS.name: typed_orders, CLICKS.name: typed_clicks}


def clean(bronze: DataFrame, feed: Feed, as_of: Column | None = None) -> DataFrame:
    typed = _TYPED[feed.name](bronze)
    survivor = [c for c in feed.survivor if c in typed.columns]
    return latest_per_key(typed, feed.dedup, survivor).withColumn(
        "processed_at", clock_now(as_of)
    )


def intake(bronze: DataFrame, feed: Feed) -> tuple[int, int]:
    """How many rows the cleaning step takes, and how many of them have what is required.

    Reads the required columns only, and counts in a job of its own: counts taken on the
    way through a shuffle would grow when a lost stage is run again.
    """
    ok = has_required(bronze, feed.required)
    row = bronze.agg(F.count(F.lit(1)).alias("rows"), F.count_if(ok).alias("valid")).first()
    return row["rows"], row["valid"]


def clean_orders(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    return clean(bronze, ORDERS, as_of)


def clean_clicks(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    return clean(bronze, CLICKS, as_of)


def audit(bronze: DataFrame, feed: Feed) -> DataFrame:
    """How many rows the cleaning step takes, drops for each reason, and gives.

    The step keeps one row per distinct key, so its output is counted as distinct
    keys: two aggregations over the required and key columns, with partial results
    before each shuffle, and no window.
    """
    ok = has_required(bronze, feed.required)
    key = F.struct(*[F.col(c) for c in feed.dedup])
    counted = bronze.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(ok).alias("_valid"),
        F.count_distinct(F.when(ok, key)).alias("rows_out"),
    )
    return counted.select(
        F.lit(f"clean_{feed.name}").alias("step"),
        "rows_in",
        "rows_out",
        (F.col("rows_in") - F.col("_valid")).alias("dropped_null"),
        (F.col("_valid") - F.col("rows_out")).alias("dropped_dup"),
    )
