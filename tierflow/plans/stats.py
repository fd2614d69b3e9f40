"""Row counts of the stored layers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.contracts import FEEDS, Feed
from tierflow.operators.layers import layer_totals
from tierflow.plans.lake import Lake
from tierflow.plans.silver import read_silver
from tierflow.sources import bronze, parts, snapshots

_V1 = "spark.sql.sources.useV1SourceList"
_PUSHED = "spark.sql.parquet.aggregatePushdown"


@contextmanager
def footer_counts(spark: SparkSession) -> Iterator[None]:
    """Within, counts over Parquet files are pushed into the reader, which takes them from the
    files' footers and hands on one number a file."""
    before = {k: spark.conf.get(k) for k in (_V1, _PUSHED)}
    spark.conf.set(_V1, ",".join(s for s in before[_V1].split(",") if s != "parquet"))
    spark.conf.set(_PUSHED, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def count_of(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``n``, the rows of some folders of Parquet files; to be run within :func:`footer_counts`."""
    return spark.read.parquet(*folders).agg(F.count(F.lit(1)).alias("n"))


def _counted(spark: SparkSession, folders: Sequence[str]) -> int:
    if not folders:
        return 0
    with footer_counts(spark):
        return count_of(spark, folders).first()["n"]


def _silver_rows(spark: SparkSession, lake: Lake, feed: Feed) -> int:
    table = lake.silver_parted(feed)
    if table:
        says = parts.properties(spark, table)
        return int(says["rows"]) if says else 0
    name = lake.silver_table(feed)
    if name:
        return read_silver(spark, lake, feed).count() if spark.catalog.tableExists(name) else 0
    number = snapshots.latest_snapshot(spark, lake.silver(feed))
    if number is None:
        return 0
    return _counted(spark, [f"{snapshots.snapshot_dir(lake.silver(feed), number)}/{snapshots.ROWS}"])


def stored_layers(spark: SparkSession, lake: Lake) -> DataFrame:
    """``(layer, orders, clicks, total)``; a table that is not there yet counts 0.

    Counts come from footers and from what the refreshes noted; no rows are read.
    """
    counts = []
    for feed in FEEDS:
        path = lake.bronze(feed)
        found = bronze.extents(spark, path)
        counts.append(("bronze", feed.name, _counted(spark, bronze.folders(path, found))))
        counts.append(("silver", feed.name, _silver_rows(spark, lake, feed)))
    return layer_totals(spark.createDataFrame(counts, "layer string, feed string, n bigint"))
