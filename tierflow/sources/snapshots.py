"""Parquet tables kept as numbered snapshots.

``<path>/snapshot=<n>/rows`` holds one complete version. Readers take the highest
committed one, so a table is never read while it is overwritten, its schema may
change from one version to the next, and a writer that dies leaves the last
version in place. One writer per table at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources import files

ROWS = "rows"
# Retention: how many versions stay. A reader of an older one has to end before two more
# refreshes are through; give ``drop_old_snapshots`` a larger number where reads take longer.
KEPT_SNAPSHOTS = 2


def snapshot_dir(path: str, number: int) -> str:
    return f"{path}/snapshot={number}"


def latest_snapshot(spark: SparkSession, path: str) -> int | None:
    for number in reversed(files.numbered(spark, path, "snapshot")):
        if files.is_complete(spark, f"{snapshot_dir(path, number)}/{ROWS}"):
            return number
    return None


def next_snapshot(spark: SparkSession, path: str) -> int:
    """A number no writer has used, be it a failed one."""
    return max(files.numbered(spark, path, "snapshot"), default=0) + 1


def version(spark: SparkSession, path: str) -> str | None:
    """A text that is different for every committed snapshot, also after the table was
    removed and made anew."""
    number = latest_snapshot(spark, path)
    if number is None:
        return None
    mark = f"{snapshot_dir(path, number)}/{ROWS}/{files.SUCCESS}"
    return f"{number}@{files.modified_at(spark, mark)}"


def table_exists(spark: SparkSession, path: str) -> bool:
    return latest_snapshot(spark, path) is not None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    number = latest_snapshot(spark, path)
    if number is None:
        raise FileNotFoundError(f"no committed snapshot in {path}")
    return spark.read.parquet(f"{snapshot_dir(path, number)}/{ROWS}")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table, or no rows if there is none yet; any other trouble is raised."""
    if table_exists(spark, path):
        return read_table(spark, path)
    return spark.createDataFrame([], schema)


def write_table(spark: SparkSession, path: str, df: DataFrame, number: int | None = None) -> int:
    """Writes ``df`` as the next snapshot and returns its row count.

    The rows are counted by the writing tasks themselves, not by a second job;
    the count sits above the last shuffle, where a rerun task is not counted twice.
    """
    number = next_snapshot(spark, path) if number is None else number
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(
        f"{snapshot_dir(path, number)}/{ROWS}"
    )
    return written.get["n"]


def drop_old_snapshots(spark: SparkSession, path: str, keep: int = KEPT_SNAPSHOTS) -> None:
    """Removes all but the newest ``keep`` committed snapshots; readers of those go on."""
    committed = [
        n
        for n in files.numbered(spark, path, "snapshot")
        if files.is_complete(spark, f"{snapshot_dir(path, n)}/{ROWS}")
    ]
    if len(committed) <= keep:
        return
    oldest_kept = committed[-keep]
    for number in files.numbered(spark, path, "snapshot"):
        if number < oldest_kept:
            files.delete(spark, snapshot_dir(path, number))


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """Every folder in ``root`` by name, whether it holds a readable table, and how many rows."""
    found = []
    for name in files.child_dirs(spark, root):
        valid = table_exists(spark, f"{root}/{name}")
        rows = read_table(spark, f"{root}/{name}").count() if valid else None
        found.append((name, valid, rows))
    schema = "table string, valid boolean, rows bigint"
    return spark.createDataFrame(found, schema).orderBy("table")
