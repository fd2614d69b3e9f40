"""Revenue per minute over a stream.

``<out>/<part>`` is kept like a Bronze feed: a folder for each run (the streaming
checkpoint's id) and micro-batch, commit marks, and packing. ``minutes`` holds the
changes of the minutes, ``undated`` those of the null minute, which gathers the orders
without a readable event time.
"""

from __future__ import annotations

import time
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.functions import money
from tierflow.sources import bronze, files
from tierflow.streaming.ingest import run_id

# Fixed value: how late an order may arrive and still be counted.
LATENESS = "10 minutes"
PARTS = ("minutes", "undated")
_SCHEMA = f"minute timestamp, {money.PARTIAL_SCHEMA}, run string, batch_id bigint"
_SUMS = [c.split()[0] for c in money.PARTIAL_SCHEMA.split(", ")]


def revenue_windows(orders: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Running money sums per event minute, put together when read. State is one row per open
    minute, and one for each bin of odd amounts in it; the watermark closes minutes and
    drops what arrives after."""
    marked = orders.withWatermark("event_timestamp", lateness)
    window = F.window("event_timestamp", "1 minute")
    return money.partial_sums(marked, [window], "amount").select(F.col("window.start").alias("minute"), *_SUMS)


def undated_revenue(orders: DataFrame) -> DataFrame:
    """The running sums of orders without an event time: one row of state, and one for each bin."""
    undated = orders.where(F.col("event_timestamp").isNull())
    none = F.lit(None).cast("timestamp").alias("minute")
    return money.partial_sums(undated, [none], "amount").select("minute", *_SUMS)


def _write(path: str, changed: DataFrame, batch_id: int) -> None:
    """Lands the minutes that a micro-batch changed. A replay overwrites its own folder."""
    spark = changed.sparkSession
    run = run_id(spark)
    started = f"{path}/started/{run}"
    if not files.exists(spark, started):
        files.write_text(spark, started, str(time.time_ns()))
    bronze.land_batch(changed, path, run, batch_id)


def start_revenue_stream(
    orders: DataFrame,
    out: str,
    checkpoint: str,
    lateness: str = LATENESS,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Writes, per micro-batch, the minutes that changed (update mode): one query for the
    minutes and one for the null minute, each with its own checkpoint."""
    trigger = {"availableNow": True} if available_now else {"processingTime": "5 seconds"}
    started = []
    for part, rows in zip(PARTS, (revenue_windows(orders, lateness), undated_revenue(orders))):
        stream = rows.writeStream.outputMode("update").foreachBatch(partial(_write, f"{out}/{part}"))
        stream = stream.option("checkpointLocation", f"{checkpoint}/{part}")
        started.append(stream.trigger(**trigger).start())
    return started


def current_run(spark: SparkSession, path: str) -> str | None:
    """The run that started last. A new checkpoint reads its topic anew, so its values
    replace those of the runs before; they are not added up."""
    runs = files.child_files(spark, f"{path}/started")
    if not runs:
        return None
    return max(runs, key=lambda r: int(files.read_text(spark, f"{path}/started/{r}")))


def read_revenue(spark: SparkSession, out: str) -> DataFrame:
    """The current value of each minute, of the sums that the last batches of the current run
    wrote. Folders of unfinished batches are not read."""
    changes = spark.createDataFrame([], _SCHEMA)
    for part in PARTS:
        path = f"{out}/{part}"
        found = [e for e in bronze.extents(spark, path) if e.run == current_run(spark, path)]
        rows = bronze.read_bronze(spark, path, changes.schema, found=found)
        if rows is not None:
            changes = changes.unionByName(rows.select(*changes.columns))
    latest = changes.groupBy("minute", "_bin").agg(F.max_by(F.struct(*_SUMS[1:]), "batch_id").alias("s"))
    sums = latest.select("minute", "_bin", "s.*")
    return money.totals(sums, ["minute"], "revenue").orderBy("minute")
