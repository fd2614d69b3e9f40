"""The append-only landing layer.

``<path>/live/run=<r>/batch_id=<n>`` is one micro-batch, ``run`` being the
id of the streaming checkpoint that numbered it. A replayed micro-batch
overwrites its own folder, so at-least-once delivery lands once; a new checkpoint
is a new run and can never overwrite what another one landed.

``<path>/packed/run=<r>/upto=<n>`` holds closed micro-batches rewritten as few large
files. Readers take packed rows, plus the live batches above the packed mark,
and list no others.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.contracts import BATCH_META
from tierflow.sources import files

PACKED_FILE_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Extent:
    """Committed folders of one run: packed marks, and live batches above them."""

    run: str
    packed: tuple[int, ...]
    live: tuple[int, ...]

    @property
    def last(self) -> int:
        return max((*self.packed, *self.live))


def _live_dir(path: str, run: str, batch_id: int) -> str:
    return f"{path}/live/run={run}/batch_id={batch_id}"


def _packed_dir(path: str, run: str, upto: int) -> str:
    return f"{path}/packed/run={run}/upto={upto}"


def land_batch(batch: DataFrame, path: str, run: str, batch_id: int) -> int:
    """Writes one micro-batch and returns its record count, reading the source once.

    The count is observed in the writing tasks: nothing is shuffled before them, so
    each record is counted once however often a task is retried. An empty batch
    leaves no folder behind.
    """
    spark = batch.sparkSession
    target = _live_dir(path, run, batch_id)
    seen = Observation()
    batch.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(target)
    records = seen.get["n"]
    if records == 0:
        files.delete(spark, target)
    return records


def read_batch(
    spark: SparkSession, path: str, run: str, batch_id: int, schema: T.StructType
) -> DataFrame:
    return spark.read.schema(schema).parquet(_live_dir(path, run, batch_id))


def _committed(spark: SparkSession, paths: dict[int, str]) -> list[int]:
    """The numbers whose folders were committed, ascending."""
    done = files.complete(spark, list(paths.values()))
    return [n for n, ok in zip(paths, done) if ok]


def extents(spark: SparkSession, path: str, after: Mapping[str, int] | None = None) -> list[Extent]:
    """What is committed, per run, leaving out what lies at or below the ``after`` mark.

    One listing for each run and level; commit marks are asked for only above the mark,
    and for live batches only above the last packed one, side by side.
    """
    after = after or {}
    packed_runs = {d.removeprefix("run=") for d in files.child_dirs(spark, f"{path}/packed")}
    live_runs = {d.removeprefix("run=") for d in files.child_dirs(spark, f"{path}/live")}
    found = []
    for run in sorted(packed_runs | live_runs):
        mark = after.get(run, -1)
        names = files.numbered(spark, f"{path}/packed/run={run}", "upto") if run in packed_runs else []
        packed = _committed(spark, {n: _packed_dir(path, run, n) for n in names if n > mark})
        floor = max([mark, *packed])
        names = files.numbered(spark, f"{path}/live/run={run}", "batch_id") if run in live_runs else []
        live = _committed(spark, {n: _live_dir(path, run, n) for n in names if n > floor})
        extent = Extent(run, tuple(packed), tuple(live))
        if extent.packed or extent.live:
            found.append(extent)
    return found


def newest_extents(spark: SparkSession, path: str, batches: int) -> list[Extent]:
    """Of each run the folders of at least its last ``batches`` committed batches, if it has so many.

    Commit marks are asked for from the newest on, and packed folders only where the live
    batches are too few; so what is read later does not grow with the layer.
    """
    found = []
    runs = set()
    for kind in ("packed", "live"):
        runs |= {d.removeprefix("run=") for d in files.child_dirs(spark, f"{path}/{kind}")}
    for run in sorted(runs):
        names = files.numbered(spark, f"{path}/live/run={run}", "batch_id")
        live: list[int] = []
        while names and len(live) < batches:
            step, names = names[-batches:], names[:-batches]
            live = [*_committed(spark, {n: _live_dir(path, run, n) for n in step}), *live]
        packed: list[int] = []
        names = files.numbered(spark, f"{path}/packed/run={run}", "upto")
        names = _committed(spark, {n: _packed_dir(path, run, n) for n in names})
        if names:  # what is packed counts there, its live folders may go at any time
            live = [n for n in live if n > names[-1]]
        while names and len(live) + (packed[-1] - names[-1] if packed else 0) < batches:
            packed.insert(0, names.pop())
        if packed or live:
            found.append(Extent(run, tuple(packed), tuple(live[-batches:])))
    return found


def _above(after: Mapping[str, int]) -> Column:
    """Row test for packed files, which may reach across a mark."""
    run, batch = F.col("run"), F.col("batch_id")
    tests = [(run == r) & (batch > mark) for r, mark in after.items()]
    return reduce(or_, tests, ~run.isin(list(after)))


def read_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None,
    after: Mapping[str, int] | None = None,
    found: list[Extent] | None = None,
) -> DataFrame | None:
    """Landed rows with their ``run`` and ``batch_id``, or None if nothing is there.

    With a ``schema`` (event, record and batch columns) no file is opened to plan
    the read and a column that older batches lack is null there. Without one the schemas of
    all files are merged, which costs a pass over their footers.
    """
    found = extents(spark, path, after) if found is None else found
    reader = spark.read if schema is None else spark.read.schema(schema)
    if schema is None:
        reader = reader.option("mergeSchema", "true")
    live = [_live_dir(path, e.run, n) for e in found for n in e.live]
    packed = [_packed_dir(path, e.run, n) for e in found for n in e.packed]
    parts = []
    if live:
        parts.append(reader.option("basePath", f"{path}/live").parquet(*live))
    if packed:
        rows = reader.option("basePath", f"{path}/packed").parquet(*packed).drop("upto")
        parts.append(rows.filter(_above(after)) if after else rows)
    if not parts:
        return None
    types = {f.name: f.dataType for f in BATCH_META}
    parts = [p.withColumns({c: F.col(c).cast(t) for c, t in types.items()}) for p in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def folders(path: str, found: list[Extent]) -> list[str]:
    live = [_live_dir(path, e.run, n) for e in found for n in e.live]
    return live + [_packed_dir(path, e.run, n) for e in found for n in e.packed]


def marks_of(found: list[Extent]) -> dict[str, int]:
    return {e.run: e.last for e in found}


def compact(
    spark: SparkSession,
    path: str,
    run: str,
    max_batch: int,
    schema: T.StructType | None = None,
    file_bytes: int = PACKED_FILE_BYTES,
) -> int:
    """Rewrites a run's live batches up to ``max_batch`` as one packed folder.

    One read and one write, no shuffle: the scan already puts many small files
    into one task and splits a large one over several, and ``coalesce`` joins
    neighbouring tasks until a file has about ``file_bytes``. Already packed folders
    are not touched again. Returns the rows packed.
    """
    open_extents = [e for e in extents(spark, path) if e.run == run]
    batches = [n for e in open_extents for n in e.live if n <= max_batch]
    if not batches:
        return 0
    rows = read_bronze(spark, path, schema, found=[Extent(run, (), tuple(batches))]).drop("run")
    size = sum(files.size_in_bytes(spark, _live_dir(path, run, n)) for n in batches)
    seen = Observation()
    rows.coalesce(-(-size // file_bytes)).observe(seen, F.count(F.lit(1)).alias("n")).write.mode(
        "overwrite"
    ).parquet(_packed_dir(path, run, max(batches)))
    return seen.get["n"]


def drop_packed_batches(
    spark: SparkSession, path: str, run: str, delay_seconds: float = 0.0
) -> int:
    """Deletes live batches that a packed folder has held for ``delay_seconds``; returns how many.

    Readers that planned before the packing may still want them, so leave them the time
    that the longest read takes.
    """
    names = files.numbered(spark, f"{path}/packed/run={run}", "upto")
    packed = _committed(spark, {n: _packed_dir(path, run, n) for n in names})
    before = time.time() - delay_seconds
    old = [
        n
        for n in packed
        if files.modified_at(spark, f"{_packed_dir(path, run, n)}/{files.SUCCESS}") / 1000 <= before
    ]
    gone = [
        n
        for n in files.numbered(spark, f"{path}/live/run={run}", "batch_id")
        if old and n <= max(old)
    ]
    for n in gone:
        files.delete(spark, _live_dir(path, run, n))
    return len(gone)
