"""Suppression of repeated deliveries over a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how long a key is remembered after its event time.
REMEMBERED = "10 minutes"
SALTS = 16
# Where a record stands in its topic: tells its deliveries apart.
PLACE = ("partition", "offset")


def _first(rows: DataFrame, keys: Sequence[str], time: str, remembered: str, spread_by, salts) -> DataFrame:
    marked = rows.withWatermark(time, remembered)
    if not spread_by:
        return marked.dropDuplicatesWithinWatermark(list(keys))
    salted = marked.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    thinned = salted.dropDuplicatesWithinWatermark([*keys, "_salt"])
    return thinned.drop("_salt").dropDuplicatesWithinWatermark(list(keys))


def first_within(
    rows: DataFrame,
    keys: Sequence[str],
    remembered: str = REMEMBERED,
    spread_by: Sequence[str] | None = None,
    salts: int = SALTS,
    arrival: str = "ingestion_timestamp",
) -> DataFrame:
    """Passes the first row of each key and drops repeats while the key is remembered.

    A key is remembered for ``remembered`` after its event time; rows that come later
    than the watermark are dropped, also if they repeat nothing. Rows without a readable
    event time have nothing to be late by: they are told apart on the same keys (no time
    counts as one value) and remembered by their ``arrival`` instead.

    Streaming deduplication has no map-side step: all rows of a key meet in
    one task. So a first round works on key and salt, and the task that sees a hot key whole
    gets at most ``salts`` of its rows. The salt is a hash of ``spread_by``, columns that
    differ between deliveries: ``partition`` and ``offset`` if the rows have them, else all
    columns. An empty list leaves the first round out.
    """
    if spread_by is None:
        spread_by = [c for c in PLACE if c in rows.columns] or rows.columns
    dated = F.col("event_timestamp").isNotNull()
    known = _first(rows.where(dated), keys, "event_timestamp", remembered, spread_by, salts)
    undated = rows.where(~dated).withColumn(arrival, F.coalesce(F.col(arrival), F.current_timestamp()))
    unknown = _first(undated, keys, arrival, remembered, spread_by, salts)
    return known.unionByName(unknown)
