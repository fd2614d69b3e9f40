"""Topics to Bronze, with a summary per micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.contracts import FEEDS, SUMMARY, Feed
from tierflow.functions.records import decode_checked
from tierflow.functions.times import iso
from tierflow.operators.live import BATCH_TYPE, SAMPLE_ROWS, row_json
from tierflow.plans.lake import Lake
from tierflow.session import require_utc
from tierflow.sources import bronze
from tierflow.sources.topics import topic_stream

TRIGGER_SECONDS = 5
_QUERY_ID = "sql.streaming.queryId"


def write_summary(
    spark: SparkSession,
    path: str,
    run: str,
    batch_id: int,
    topic: str,
    records: int,
    sample: Sequence[str],
) -> None:
    """Lands the summary like a batch of its own: a replay overwrites it."""
    row = spark.createDataFrame(
        [(BATCH_TYPE, batch_id, topic, records, None, list(sample))], SUMMARY
    ).withColumn("timestamp", iso(F.current_timestamp()))
    # One row; ``batch_id`` comes back from the folder name.
    bronze.land_batch(row.drop("batch_id").coalesce(1), path, run, batch_id)


def read_summaries(spark: SparkSession, lake: Lake, feeds: Sequence[Feed] = FEEDS) -> DataFrame:
    """All summaries written so far; no rows where no stream has run yet."""
    log = spark.createDataFrame([], SUMMARY)
    for feed in feeds:
        part = bronze.read_bronze(spark, lake.summaries(feed), SUMMARY)
        if part is not None:
            log = log.unionByName(part.select(*SUMMARY.fieldNames()))
    return log


def newest_summaries(spark: SparkSession, lake: Lake, batches: int, feeds: Sequence[Feed] = FEEDS) -> DataFrame:
    """The summaries of at least the last ``batches`` batches of each run, from folder names.

    A run writes its summaries in the order of their times, so the newest ones of the whole
    log are among them. The files read do not grow with the log.
    """
    log = spark.createDataFrame([], SUMMARY)
    for feed in feeds:
        path = lake.summaries(feed)
        found = bronze.newest_extents(spark, path, batches)
        part = bronze.read_bronze(spark, path, SUMMARY, found=found)
        if part is not None:
            log = log.unionByName(part.select(*SUMMARY.fieldNames()))
    return log


def run_id(spark: SparkSession) -> str:
    """The id of the streaming checkpoint that the current micro-batch belongs to."""
    run = spark.sparkContext.getLocalProperty(_QUERY_ID)
    if not run:
        raise RuntimeError(f"{_QUERY_ID} is not set: call this from within foreachBatch")
    return run


def batch_handler(feed: Feed, lake: Lake) -> Callable[[DataFrame, int], None]:
    """Land, then summarise. The source is read by the landing job only: the
    record count is observed there, and the sample comes from the landed files."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_id(spark)
        path = lake.bronze(feed)
        records = bronze.land_batch(batch, path, run, batch_id)
        sample: list[str] = []
        if records:
            landed = bronze.read_batch(spark, path, run, batch_id, feed.bronze)
            rows = landed.select(row_json(landed).alias("json")).limit(SAMPLE_ROWS).collect()
            sample = [r["json"] for r in rows]
        write_summary(spark, lake.summaries(feed), run, batch_id, feed.topic, records, sample)

    return handle


def start_stream(
    spark: SparkSession,
    feed: Feed,
    lake: Lake,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    available_now: bool = False,
    trigger_seconds: int = TRIGGER_SECONDS,
) -> StreamingQuery:
    """Starts the feed's landing stream; it resumes from its checkpoint when started again.

    ``available_now`` takes what the topic holds and ends, for catch-up runs: its first run
    starts at the earliest offset, a service run at the latest, unless ``options`` say
    otherwise.
    """
    require_utc(spark)
    raw = topic_stream(spark, feed.topic, fmt, options, from_start=available_now)
    rows = decode_checked(raw, feed, feed.topic)
    trigger = (
        {"availableNow": True}
        if available_now
        else {"processingTime": f"{trigger_seconds} seconds"}
    )
    return (
        rows.writeStream.foreachBatch(batch_handler(feed, lake))
        .option("checkpointLocation", lake.checkpoint(feed))
        .queryName(f"bronze-{feed.name}")
        .trigger(**trigger)
        .start()
    )


def run_streams(
    spark: SparkSession,
    lake: Lake,
    fmt: str = "kafka",
    options: Mapping[str, Mapping[str, str]] | None = None,
    feeds: Sequence[Feed] = FEEDS,
    available_now: bool = False,
    trigger_seconds: int = TRIGGER_SECONDS,
) -> None:
    """Runs all feeds side by side.

    A bounded run waits for each stream. A service run ends, and stops the others,
    as soon as one stream ends or fails.
    """
    options = options or {}
    queries = [
        start_stream(spark, f, lake, fmt, options.get(f.name), available_now, trigger_seconds)
        for f in feeds
    ]
    try:
        if available_now:
            for query in queries:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()
