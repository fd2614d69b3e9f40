"""Running figures over the summary log (A9-A12): kept sums, and what came since.

``<summaries>/figures`` holds snapshots of the sums with marks that tell how far into the
log they reach. Reading adds the summaries above the marks; refreshing stores the result.
Both read what is new, however long the log.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tierflow.contracts import FEEDS, SUMMARY, Feed
from tierflow.operators.live import FIGURES, RATE_WINDOW_SECONDS, added_figures, figures_of
from tierflow.plans.lake import Lake
from tierflow.plans.silver import Outcome
from tierflow.sources import bronze, files, snapshots


def _path(lake: Lake) -> str:
    return f"{lake.summary_root}/figures"


def _marks_file(lake: Lake, number: int) -> str:
    return f"{snapshots.snapshot_dir(_path(lake), number)}/marks.json"


def _kept(spark: SparkSession, lake: Lake) -> tuple[DataFrame | None, dict[str, dict[str, int]]]:
    number = snapshots.latest_snapshot(spark, _path(lake))
    if number is None:
        return None, {}
    marks = json.loads(files.read_text(spark, _marks_file(lake, number)))
    return spark.read.schema(FIGURES).parquet(f"{snapshots.snapshot_dir(_path(lake), number)}/{snapshots.ROWS}"), marks


def _with_new(
    spark: SparkSession, lake: Lake, feeds: Sequence[Feed], window_seconds: int, as_of: Column | None
) -> tuple[DataFrame, dict[str, dict[str, int]], bool]:
    """The figures, the marks they reach to, and whether anything is above the kept ones."""
    lines, marks = _kept(spark, lake)
    log = spark.createDataFrame([], SUMMARY)
    after, is_new = dict(marks), False
    for feed in feeds:
        path, done = lake.summaries(feed), marks.get(feed.name, {})
        found = bronze.extents(spark, path, done)
        rows = bronze.read_bronze(spark, path, SUMMARY, done, found)
        if rows is not None:
            log = log.unionByName(rows.select(*SUMMARY.fieldNames()))
            after[feed.name] = {**done, **bronze.marks_of(found)}
            is_new = True
    if is_new or lines is None:
        new = figures_of(log, as_of)
        lines = new if lines is None else lines.unionByName(new)
    return added_figures(lines, window_seconds), after, is_new


def running_figures(
    spark: SparkSession,
    lake: Lake,
    feeds: Sequence[Feed] = FEEDS,
    window_seconds: int = RATE_WINDOW_SECONDS,
    as_of: Column | None = None,
) -> DataFrame:
    """The figures of all summaries written so far, for ``live.totals_from`` and its like."""
    return _with_new(spark, lake, feeds, window_seconds, as_of)[0]


def refresh_figures(
    spark: SparkSession,
    lake: Lake,
    feeds: Sequence[Feed] = FEEDS,
    window_seconds: int = RATE_WINDOW_SECONDS,
    as_of: Column | None = None,
) -> Outcome:
    """Stores the running figures, so that the next reader starts from here.

    A batch below a mark counts once, also if its stream replays it.
    """
    lines, marks, is_new = _with_new(spark, lake, feeds, window_seconds, as_of)
    if not is_new:
        return Outcome("skipped", note="no new summaries")
    number = snapshots.next_snapshot(spark, _path(lake))
    files.write_text(spark, _marks_file(lake, number), json.dumps(marks))
    rows = snapshots.write_table(spark, _path(lake), lines.coalesce(1), number)
    snapshots.drop_old_snapshots(spark, _path(lake))
    return Outcome("ok", rows)
