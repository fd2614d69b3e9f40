"""Packing of closed batches, as a step of the cycle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tierflow.contracts import SUMMARY, Feed
from tierflow.plans.lake import Lake
from tierflow.plans.silver import Outcome
from tierflow.sources import bronze

# What a summary's folder holds, with the columns that its place tells.
_SUMMARY_STORED = T.StructType(
    [f for f in SUMMARY.fields if f.name != "batch_id"]
    + [T.StructField("run", T.StringType()), T.StructField("batch_id", T.LongType())]
)


@dataclass(frozen=True)
class Packing:
    """``min_batches``: closed batches of a run that make a packed folder worth its while.
    ``delay_seconds``: how long packed batches stay live for readers that still want them."""

    min_batches: int = 500
    delay_seconds: float = 3600.0


def pack_folder(spark: SparkSession, path: str, schema: T.StructType, how: Packing) -> tuple[int, int]:
    """Packs each run's closed batches and drops those packed long enough ago; returns rows
    packed and folders dropped. A run's last batch stays live: it may be replayed."""
    packed = dropped = 0
    for extent in bronze.extents(spark, path):
        closed = extent.live[:-1]
        if len(closed) >= how.min_batches:
            packed += bronze.compact(spark, path, extent.run, closed[-1], schema)
        dropped += bronze.drop_packed_batches(spark, path, extent.run, how.delay_seconds)
    return packed, dropped


def pack(spark: SparkSession, lake: Lake, feed: Feed, how: Packing = Packing()) -> Outcome:
    """Packs the feed's Bronze batches and its summaries."""
    landed = pack_folder(spark, lake.bronze(feed), feed.bronze_stored, how)
    summaries = pack_folder(spark, lake.summaries(feed), _SUMMARY_STORED, how)
    if not any(landed + summaries):
        return Outcome("skipped", note="nothing to pack or drop")
    return Outcome("ok", landed[0] + summaries[0])
