"""Silver to Gold, and reading the marts back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.contracts import MART_SCHEMAS, Feed
from tierflow.operators.marts import MART_ORDER, MARTS, SUMS, in_mart_order, most_viewed
from tierflow.operators.upsert import SIGN
from tierflow.plans.lake import Lake
from tierflow.plans.silver import Outcome, changes_since, read_silver, silver_version
from tierflow.session import require_utc
from tierflow.sources import files, snapshots


def _source_note(path: str, number: int) -> str:
    return f"{snapshots.snapshot_dir(path, number)}/made_from"


def _sums(path: str, number: int) -> str:
    return f"{snapshots.snapshot_dir(path, number)}/sums"


def _by_change(
    spark: SparkSession, lake: Lake, feed: Feed, mart: str, path: str, current: int | None, number: int
) -> tuple[DataFrame, str | None]:
    """The mart from its sums, which are stored beside it: those of the last version with the
    rows that came since added and those that went taken back, or all of Silver's."""
    sums = SUMS[mart]
    lines, note = None, None
    if current is not None and files.is_complete(spark, _sums(path, current)):
        changed = changes_since(spark, lake, feed, files.read_text(spark, _source_note(path, current)))
        if changed is not None:
            before = spark.read.schema(sums.schema).parquet(_sums(path, current))
            lines = before.unionByName(sums.of(changed.select(*sums.reads, SIGN), SIGN))
            note = "by change"
    if lines is None:
        lines = sums.of(read_silver(spark, lake, feed).select(*sums.reads), None)
    sums.add(lines).write.mode("overwrite").parquet(_sums(path, number))
    made = sums.mart(spark.read.schema(sums.schema).parquet(_sums(path, number)))
    return (most_viewed(made) if mart == "clicks_top_pages" else made), note


def refresh_mart(
    spark: SparkSession, lake: Lake, feed: Feed, mart: str, force: bool = False
) -> Outcome:
    """Recomputes one mart from current Silver, unless it was made from just that version.

    Silver is not cached between marts: each reads only the one or two columns it
    needs, which is less than writing the whole table to executor storage would cost.
    Where Silver is kept in parts, only the rows that changed are read.
    """
    require_utc(spark)
    source = silver_version(spark, lake, feed)
    if source is None:
        return Outcome("skipped", note="no silver table")
    path = lake.gold(mart)
    current = snapshots.latest_snapshot(spark, path)
    if current is not None and not force:
        if files.read_text(spark, _source_note(path, current)) == source:
            return Outcome("skipped", note="silver unchanged")
    number = snapshots.next_snapshot(spark, path)
    files.write_text(spark, _source_note(path, number), source)
    # Files carry no order, so there is no sort before the write; reading sorts.
    note = None
    if lake.silver_parted(feed):
        made, note = _by_change(spark, lake, feed, mart, path, None if force else current, number)
    else:
        made = MARTS[feed.name][mart](read_silver(spark, lake, feed), ordered=False)
    rows = snapshots.write_table(spark, path, made, number)
    snapshots.drop_old_snapshots(spark, path)
    return Outcome("ok", rows, note)


def load_marts(spark: SparkSession, lake: Lake, feed: Feed) -> dict[str, DataFrame]:
    """The feed's marts in their own order; a mart that is not there yet is empty."""
    return {
        mart: in_mart_order(mart, snapshots.read_or_empty(spark, lake.gold(mart), schema))
        for mart, schema in MART_SCHEMAS.items()
        if mart in MARTS[feed.name]
    }


def marts_as_rows(marts: dict[str, DataFrame]) -> DataFrame:
    """Several marts in one table of ``(mart, key, measure)``."""
    stacked = None
    for mart, df in marts.items():
        measure = next((c for c, down in MART_ORDER[mart] if down), "revenue")
        key = next(c for c, down in MART_ORDER[mart] if not down)
        part = df.select(
            F.lit(mart).alias("mart"),
            F.col(key).cast("string").alias("key"),
            F.col(measure).cast("double").alias("measure"),
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


def gold_catalog(spark: SparkSession, lake: Lake) -> DataFrame:
    """Every folder of the Gold layer, whether it holds a readable table, and its row count."""
    return snapshots.catalog(spark, lake.gold_root)
