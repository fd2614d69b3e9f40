"""Bronze to Silver: full or incremental, repeatable."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.contracts import Feed
from tierflow.operators.clean import clean, intake
from tierflow.operators.upsert import (
    SIGN, changes, matched, merge_newest, merge_newest_narrow, merge_replace, with_changes, with_changes_in,
)
from tierflow.plans.lake import Lake
from tierflow.session import require_utc, work_dir
from tierflow.sources import bronze, files, parts, snapshots


# Rows of a part that one task sorts at a time when many of them change.
CELL_ROWS = 1_000_000


@dataclass(frozen=True)
class Outcome:
    """What a step did. ``rows`` is the table's count afterwards; the others account for the
    rows that a cleaning step took in, dropped and passed on."""

    status: str
    rows: int | None = None
    note: str | None = None
    rows_in: int | None = None
    dropped_null: int | None = None
    dropped_dup: int | None = None
    passed: int | None = None


def _cleaned(
    rows: DataFrame, feed: Feed, as_of: Column | None
) -> tuple[DataFrame, Callable[[int, int], Outcome]]:
    """The cleaned rows, and the report on them once their number is known."""
    taken = rows.select(*feed.bronze.fieldNames())
    rows_in, valid = intake(taken, feed)

    def report(n: int, passed: int) -> Outcome:
        return Outcome("ok", n, None, rows_in, rows_in - valid, valid - passed, passed)

    return clean(taken, feed, as_of), report


def read_silver(spark: SparkSession, lake: Lake, feed: Feed) -> DataFrame:
    table = lake.silver_parted(feed)
    if table:
        return spark.table(table.view)
    name = lake.silver_table(feed)
    return spark.table(name) if name else snapshots.read_table(spark, lake.silver(feed))


def silver_version(spark: SparkSession, lake: Lake, feed: Feed) -> str | None:
    """A text that changes with every refresh; None if there is no table yet."""
    table = lake.silver_parted(feed)
    if table:
        says = parts.properties(spark, table)
        return f"{says['version']}@{says['made']}" if says else None
    name = lake.silver_table(feed)
    if not name:
        return snapshots.version(spark, lake.silver(feed))
    return files.read_text(spark, f"{lake.silver(feed)}/marks.json")


def _marks_file(path: str, number: int) -> str:
    return f"{snapshots.snapshot_dir(path, number)}/marks.json"


def read_marks(spark: SparkSession, path: str) -> dict[str, int]:
    """Per run, the last Bronze batch the current snapshot contains. One entry per
    streaming checkpoint ever used, so small whatever the data volume."""
    number = snapshots.latest_snapshot(spark, path)
    text = None if number is None else files.read_text(spark, _marks_file(path, number))
    return json.loads(text) if text else {}


def _broadcast_limit(spark: SparkSession) -> int:
    """The session's own broadcast bound in bytes; negative where broadcasts are off."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _require_unique(updates: DataFrame, keys: tuple[str, ...]) -> None:
    twice = updates.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ValueError(f"updates hold several rows for one {keys}")


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    feed: Feed,
    mode: str = "newest",
    marks: dict[str, int] | None = None,
) -> tuple[int, int]:
    """Merges ``updates`` into the table as a new snapshot; returns its row count and theirs.

    ``newest`` keeps the later of old and new row. ``replace`` lets the update win
    always. The updates are written out first: they are then computed once, and
    their true size, not an estimate, decides whether the table has to be shuffled.
    """
    if mode not in ("newest", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    number = snapshots.next_snapshot(spark, path)
    here = snapshots.snapshot_dir(path, number)
    marks = read_marks(spark, path) if marks is None else marks
    files.write_text(spark, _marks_file(path, number), json.dumps(marks))
    if not snapshots.table_exists(spark, path):
        rows = snapshots.write_table(spark, path, updates, number)
        return rows, rows

    staging = f"{here}/updates"
    seen = Observation()
    # Observed above the last shuffle, so a rerun task is not counted twice.
    updates.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staging)
    staged = spark.read.schema(updates.schema).parquet(staging)
    target = snapshots.read_table(spark, path)
    keys = feed.dedup
    survivor = [c for c in feed.survivor if c in updates.columns]
    if mode == "replace":
        _require_unique(staged, keys)
        merged = merge_replace(target, staged, keys, nulls_match=True)
    elif files.size_in_bytes(spark, staging) <= _broadcast_limit(spark):
        merged = merge_newest_narrow(target, staged, keys, survivor)
    else:
        merged = merge_newest(target, staged, keys, survivor)
    rows = snapshots.write_table(spark, path, merged, number)
    files.delete(spark, staging)
    snapshots.drop_old_snapshots(spark, path)
    return rows, seen.get["n"]


def _publish_parts(
    spark: SparkSession, table: parts.Parted, number: int, schema: T.StructType,
    lie: dict[int, str], n_parts: int, rows: int, marks: dict[str, int],
) -> None:
    says = {"parts": str(n_parts), "rows": str(rows), "marks": json.dumps(marks), "made": str(time.time_ns())}
    parts.publish(spark, table, number, schema, lie, says)
    parts.drop_old_versions(spark, table)


def load_parts(
    spark: SparkSession, table: parts.Parted, rows: DataFrame, feed: Feed, n_parts: int, marks: dict[str, int]
) -> int:
    """All rows of a table as its next version; returns their number."""
    number = parts.next_version(spark, table)
    here = f"{table.folder(number)}/rows"
    # Rebalanced, not repartitioned: a task that would get too much of a part for its memory is split.
    dealt = rows.withColumn(parts.PART, parts.part_of(feed.dedup, n_parts)).hint("rebalance", parts.PART)
    seen = Observation()
    dealt.observe(seen, F.count(F.lit(1)).alias("n")).write.partitionBy(parts.PART).parquet(here)
    lie = {int(d.split("=")[1]): f"{here}/{d}" for d in files.child_dirs(spark, here)}
    _publish_parts(spark, table, number, rows.schema, lie, n_parts, seen.get["n"], marks)
    return seen.get["n"]


def upsert_parts(
    spark: SparkSession, table: parts.Parted, updates: DataFrame, feed: Feed, n_parts: int,
    mode: str = "newest", marks: dict[str, int] | None = None,
) -> tuple[int, int]:
    """Merges ``updates`` into a table in parts; returns its row count and theirs.

    Reads the parts that updates belong to and rewrites those where one takes effect; all
    others stay where they lie. What changes is kept in the version's folder, the old row
    beside the new one, for whatever is derived from the table.
    """
    if mode not in ("newest", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    says = parts.properties(spark, table)
    if says is None:
        rows = load_parts(spark, table, updates, feed, n_parts, marks or {})
        return rows, rows
    n_parts, last = int(says["parts"]), int(says["version"])
    marks = json.loads(says["marks"]) if marks is None else marks
    number = parts.next_version(spark, table)
    here, keys = table.folder(number), feed.dedup
    staging = f"{here}/updates"
    seen = Observation()
    dealt = updates.withColumn(parts.PART, parts.part_of(keys, n_parts))
    dealt.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staging)
    staged = spark.read.schema(dealt.schema).parquet(staging)
    if mode == "replace":
        _require_unique(staged, keys)

    def parts_of(rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(parts.PART).distinct().collect())  # at most all parts

    named = parts_of(staged)
    mine = staged.where(F.col(parts.PART).isin(named))  # all; tells Spark that a filter of their keys is worth it
    old = matched(parts.read_version(spark, table, last, named), mine, keys)
    survivor = [c for c in feed.survivor if c in updates.columns]
    found = changes(old, staged, keys, survivor, mode)
    found.write.parquet(f"{here}/changes")
    changed = spark.read.schema(found.schema).parquet(f"{here}/changes")
    signs = changed.agg(F.sum(SIGN).alias("added")).first()
    hit = parts_of(changed)
    lie = parts.locations(spark, table, last)
    if hit:
        target = parts.read_version(spark, table, last, hit)
        if files.size_in_bytes(spark, f"{here}/changes") > _broadcast_limit(spark):
            cells = 1 + int(says["rows"]) // (n_parts * CELL_ROWS)
            after = with_changes_in(parts.cell_of(keys, cells), target, changed, keys, (parts.PART,))
        else:
            after = with_changes(target, changed, keys)
        after.write.partitionBy(parts.PART).parquet(f"{here}/rows")
        lie.update({k: f"{here}/rows/{parts.PART}={k}" for k in hit})
    files.delete(spark, staging)
    rows = int(says["rows"]) + (signs["added"] or 0)
    _publish_parts(spark, table, number, found.drop(SIGN).schema, lie, n_parts, rows, marks)
    return rows, seen.get["n"]


def changes_since(spark: SparkSession, lake: Lake, feed: Feed, version: str) -> DataFrame | None:
    """All :func:`changes` of the table since that version; None if they are not all kept."""
    table = lake.silver_parted(feed)
    says = parts.properties(spark, table) if table else None
    if says is None or not version.split("@")[0].isdigit():
        return None
    numbers = range(int(version.split("@")[0]) + 1, int(says["version"]) + 1)
    kept = files.numbered(spark, table.path, "version")
    folders = [f"{table.folder(n)}/changes" for n in numbers if n in kept]
    # A version that was loaded as a whole, or a writer that died, has no changes.
    if not folders or len(folders) < len(numbers) or not all(files.complete(spark, folders)):
        return None
    return spark.read.option("mergeSchema", "true").parquet(*folders)


def _upsert_catalog_table(
    spark: SparkSession, lake: Lake, feed: Feed, updates: DataFrame, mode: str, marks: dict[str, int]
) -> tuple[int, int]:
    """The same into a table of the catalog, with the marks in a file beside it.

    The updates are stored first. The marks are written last: a refresh that dies before
    is repeated, and merging the same updates again changes nothing.
    """
    name = lake.silver_table(feed)
    staging = work_dir(spark, f"silver-{feed.name}")
    updates.write.parquet(staging)
    staged = spark.read.schema(updates.schema).parquet(staging)
    if spark.catalog.tableExists(name):
        merge_into_catalog_table(staged, name, feed, mode)
    else:
        staged.write.saveAsTable(name)
    files.write_text(spark, f"{lake.silver(feed)}/marks.json", json.dumps(marks))
    return spark.table(name).count(), staged.count()


def refresh_silver(
    spark: SparkSession,
    lake: Lake,
    feed: Feed,
    mode: str = "newest",
    as_of: Column | None = None,
) -> Outcome:
    """Takes in the Bronze batches landed since the last refresh, and only those.

    ``newest`` keeps the later of old and new row; with ``replace`` the update always wins.
    Where Silver is kept in parts, or in a catalog that takes row-level changes, only the
    parts or files concerned are rewritten; snapshots are copied as a whole.
    """
    require_utc(spark)
    table = lake.silver_parted(feed)
    in_catalog = table is None and lake.silver_table(feed) is not None
    if table:
        says = parts.properties(spark, table)
        done = json.loads(says["marks"]) if says else {}
    elif in_catalog:
        text = files.read_text(spark, f"{lake.silver(feed)}/marks.json")
        done = json.loads(text) if text else {}
    else:
        done = read_marks(spark, lake.silver(feed))
    found = bronze.extents(spark, lake.bronze(feed), done)
    rows = bronze.read_bronze(spark, lake.bronze(feed), feed.bronze_stored, done, found)
    if rows is None:
        return Outcome("skipped", note="no new bronze batches" if done else "no bronze table")
    updates, report = _cleaned(rows, feed, as_of)
    marks = {**done, **bronze.marks_of(found)}
    if table:
        return report(*upsert_parts(spark, table, updates, feed, lake.silver_parts, mode, marks))
    if in_catalog:
        return report(*_upsert_catalog_table(spark, lake, feed, updates, mode, marks))
    return report(*upsert_table(spark, lake.silver(feed), updates, feed, mode, marks))


def rebuild_silver(
    spark: SparkSession, lake: Lake, feed: Feed, as_of: Column | None = None
) -> Outcome:
    """Recovery: Silver from all of Bronze, whatever Silver holds now."""
    require_utc(spark)
    path = lake.silver(feed)
    found = bronze.extents(spark, lake.bronze(feed))
    rows = bronze.read_bronze(spark, lake.bronze(feed), feed.bronze_stored, found=found)
    if rows is None:
        return Outcome("skipped", note="no bronze table")
    marks = bronze.marks_of(found)
    cleaned, report = _cleaned(rows, feed, as_of)
    table = lake.silver_parted(feed)
    if table:
        n = load_parts(spark, table, cleaned, feed, lake.silver_parts, marks)
        return report(n, n)
    name = lake.silver_table(feed)
    if name:
        cleaned.write.mode("overwrite").saveAsTable(name)
        files.write_text(spark, f"{path}/marks.json", json.dumps(marks))
        n = spark.table(name).count()
        return report(n, n)
    number = snapshots.next_snapshot(spark, path)
    files.write_text(spark, _marks_file(path, number), json.dumps(marks))
    n = snapshots.write_table(spark, path, cleaned, number)
    snapshots.drop_old_snapshots(spark, path)
    return report(n, n)


def merge_into_catalog_table(
    updates: DataFrame, table: str, feed: Feed, mode: str = "newest"
) -> None:
    """The same upsert where the catalog's tables take row-level changes.

    The table format then rewrites only the files it must; this is the way to go
    for a Silver table too large to copy on each refresh. With ``newest`` an update that
    does not rank above the stored row is left out, ``replace`` takes every update.
    """
    names = [c for c in feed.survivor if c in updates.columns and c not in feed.dedup]
    names += [c for c in updates.columns if c not in names and c not in feed.dedup]
    old = F.struct(*[F.col(f"{table}.{c}") for c in names])
    new = F.struct(*[F.col(f"updates.{c}") for c in names])
    same = [F.col(f"{table}.{k}").eqNullSafe(F.col(f"updates.{k}")) for k in feed.dedup]
    condition = same[0]
    for test in same[1:]:
        condition = condition & test
    merge = updates.alias("updates").mergeInto(table, condition)
    matched = merge.whenMatched() if mode == "replace" else merge.whenMatched(new > old)
    (
        matched.updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
