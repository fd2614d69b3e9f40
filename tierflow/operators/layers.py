"""Row counts of the layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.contracts import CLICKS, ORDERS


def layer_summary(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """``(layer, orders, clicks, total)`` from ``{layer: {feed: table}}``.

    Each table is counted on its own; over Parquet that reads footers only.
    """
    counts = None
    for layer, tables in layers.items():
        for name, table in tables.items():
            row = table.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("feed"), "n"
            )
            counts = row if counts is None else counts.unionByName(row)

    return layer_totals(counts)


def layer_totals(counts: DataFrame) -> DataFrame:
    """``(layer, orders, clicks, total)`` of ``(layer, feed, n)``."""

    def of(feed: str):
        return F.sum(F.when(F.col("feed") == feed, F.col("n")).otherwise(0)).alias(feed)

    return (
        counts.groupBy("layer")
        .agg(of(ORDERS.name), of(CLICKS.name), F.sum("n").alias("total"))
        .orderBy("layer")
    )
