"""

Each query runs over whole tables of ``sf_dir``. Queries that need a stored lake
or a stream first derive it from those tables, in a fresh folder below the
session's shared work folder.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterator

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import duckdb_queries  # noqa: E402
from tierflow.contracts import CLICKS, ORDERS  # noqa: E402
from tierflow.functions import records  # noqa: E402
from tierflow.operators import clean, layers, live, marts, upsert  # noqa: E402
from tierflow.plans import cycle, figures, gold, silver, upkeep  # noqa: E402
from tierflow.plans.lake import Lake  # noqa: E402
from tierflow.session import work_dir  # noqa: E402
from tierflow.sources import bronze, feeds, snapshots, topics  # noqa: E402
from tierflow.streaming import aggregates, dedup, ingest  # noqa: E402

try:  # the operators for training text can be left out
    from tierflow.llm import queries as training_text  # noqa: E402
except ImportError as missing:
    if missing.name not in ("tierflow.llm", "tierflow.llm.queries", "corpus_pipeline"):
        raise
    training_text = None

SMOKE_DIR = "/root/testdata/sf0.001"
SLICE_SECONDS = 6 * 3600
MINUTE = 60
DAY = 24 * 3600
# Longer than the test data, so that no row counts as late.
WHOLE_PERIOD = "60 days"
# At most so many micro-batches, for topics of more than two files each.
MICRO_BATCHES = 4


# --- the given tables as events -------------------------------------------------


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.order_lines(feeds.table(spark, sf, "lineitem"))


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.purchases(feeds.table(spark, sf, "events"))


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.clicks(feeds.table(spark, sf, "events"))


def landed_lines(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.landed(order_lines(spark, sf), ORDERS)


def landed_purchases(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.landed(purchases(spark, sf), ORDERS)


def landed_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.landed(clicks(spark, sf), CLICKS)


def silver_lines(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_orders(landed_lines(spark, sf))


def silver_purchases(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_orders(landed_purchases(spark, sf))


def silver_clicks(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_clicks(landed_clicks(spark, sf))


# --- records and cleaning -------------------------------------------------------


def envelope_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events = order_lines(spark, sf).unionByName(purchases(spark, sf))
    sent = records.encode(events, ORDERS.key)
    back = records.decode(sent, ORDERS.event, ORDERS.topic)
    return back.select("kafka_key", *ORDERS.event.fieldNames())


def decode_orders(spark: SparkSession, sf: str) -> DataFrame:
    sent = records.encode(order_lines(spark, sf), ORDERS.key, ORDERS.topic)
    return records.decode(sent, ORDERS.event, as_of=feeds.as_of())


def decode_clicks(spark: SparkSession, sf: str) -> DataFrame:
    sent = records.encode(clicks(spark, sf), CLICKS.key, CLICKS.topic)
    return records.decode(sent, CLICKS.event, as_of=feeds.as_of())


def mixed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Good orders and, from the other tables, records with every kind of fault."""

    def table(name: str) -> DataFrame:
        return feeds.table(spark, sf, name)

    def text(col: str):
        return F.col(col).cast("string")

    good = order_lines(spark, sf).unionByName(purchases(spark, sf))
    no_order = clicks(spark, sf)
    no_user = table("part").select(
        F.concat(F.lit("part-"), "p_partkey").alias("order_id"),
        F.col("p_retailprice").alias("amount"),
    )
    no_amount = table("supplier").select(
        F.concat(F.lit("supplier-"), "s_suppkey").alias("order_id"),
        F.col("s_name").alias("user_id"),
    )
    wordy_amount = table("customer").select(
        F.concat(F.lit("customer-"), "c_custkey").alias("order_id"),
        F.col("c_name").alias("user_id"),
        F.col("c_mktsegment").alias("amount"),
    )
    wordy_time = table("orders").select(
        F.concat(F.lit("order-"), "o_orderkey").alias("order_id"),
        text("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("timestamp"),
    )
    not_json = table("conversations").select(
        F.concat(F.lit("talk-"), "conv_id", F.lit("-"), "turn").cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
    )
    no_value = table("nation").select(
        F.concat(F.lit("nation-"), "n_nationkey").cast("binary").alias("key"),
        F.lit(None).cast("binary").alias("value"),
    )
    coded = [
        records.encode(good, "order_id"),
        records.encode(no_order, "session_id"),
        *[records.encode(d, "order_id") for d in (no_user, no_amount, wordy_amount, wordy_time)],
    ]
    everything = not_json.unionByName(no_value)
    for part in coded:
        everything = everything.unionByName(part)
    return everything


def quarantine_orders(spark: SparkSession, sf: str) -> DataFrame:
    judged = records.classify(mixed_records(spark, sf), ORDERS)
    return judged.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.coalesce("reject_reason", F.lit("accepted")).alias("verdict"),
        records.is_excluded(F.col("reject_reason")).cast("int").alias("excluded"),
    )


def fault_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of all landed records, warnings included."""
    landed = records.decode_checked(mixed_records(spark, sf), ORDERS, ORDERS.topic)
    return records.fault_counts(landed)


SILVER_ORDER_COLUMNS = [*ORDERS.event.fieldNames(), "event_timestamp"]
SILVER_CLICK_COLUMNS = [*CLICKS.event.fieldNames(), "event_timestamp"]


def clean_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Line items hold several rows for a quarter of the keys; the newest one stays."""
    return silver_lines(spark, sf).select(*SILVER_ORDER_COLUMNS)


def clean_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Every click delivered twice."""
    once = landed_clicks(spark, sf)
    return clean.clean_clicks(once.unionByName(once)).select(*SILVER_CLICK_COLUMNS)


def silver_audit(spark: SparkSession, sf: str) -> DataFrame:
    mixed = records.decode(mixed_records(spark, sf), ORDERS.event, ORDERS.topic)
    once = landed_clicks(spark, sf)
    return clean.audit(mixed, ORDERS).unionByName(
        clean.audit(once.unionByName(once), CLICKS)
    )


# --- marts ----------------------------------------------------------------------


def revenue_per_product(spark: SparkSession, sf: str) -> DataFrame:
    return marts.revenue_per_product(silver_lines(spark, sf))


def orders_by_status(spark: SparkSession, sf: str) -> DataFrame:
    return marts.orders_by_status(silver_lines(spark, sf))


def revenue_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    return marts.revenue_per_minute(silver_purchases(spark, sf))


def top_pages(spark: SparkSession, sf: str) -> DataFrame:
    return marts.top_pages(silver_clicks(spark, sf))


def top_actions(spark: SparkSession, sf: str) -> DataFrame:
    return marts.top_actions(silver_clicks(spark, sf))


def events_per_device(spark: SparkSession, sf: str) -> DataFrame:
    return marts.events_per_device(silver_clicks(spark, sf))


def revenue_of_any_size(spark: SparkSession, sf: str) -> DataFrame:
    """Order prices as they are, in ten millions (a billion and more), and in hundred
    millionths of the customer number, summed up exactly; the same for prices times 1e290
    and 1e18 next to billionths of the customer number."""
    orders = feeds.table(spark, sf, "orders")

    def part(amount, name: str = "") -> DataFrame:
        product = F.concat("o_orderpriority", F.lit(name)).alias("product")
        return orders.select(product, amount.alias("amount"))

    def power(number, exponent: str):
        return F.concat(number.cast("long"), F.lit(exponent)).cast("double")

    price = F.col("o_totalprice")
    rows = part(price).unionByName(part(price * 1e7)).unionByName(part(F.col("o_custkey") / 1e8))
    whole = F.floor(price)
    for name, exponent in ((" huge", "e290"), (" large", "e18")):
        rows = rows.unionByName(part(power(whole, exponent), name))
        rows = rows.unionByName(part(power(F.col("o_custkey"), "e-9"), name))
    rows = rows.unionByName(part(power(F.col("o_custkey"), "e-9"), " tiny"))
    return marts.revenue_per_product(rows)


def status_share(spark: SparkSession, sf: str) -> DataFrame:
    return marts.status_share(silver_lines(spark, sf))


def top_products(spark: SparkSession, sf: str) -> DataFrame:
    return marts.top_products(revenue_per_product(spark, sf))


# --- summaries and live metrics -------------------------------------------------


def _sliced(rows: DataFrame, slice_seconds: int) -> DataFrame:
    second = F.unix_seconds("event_timestamp")
    return rows.withColumn("batch_id", F.call_function("div", second, F.lit(slice_seconds)))


def event_summaries(
    spark: SparkSession, sf: str, slice_seconds: int = SLICE_SECONDS, sampled: bool = False
) -> DataFrame:
    """One summary per topic and time slice of the events table."""
    parts = []
    for rows, feed in (
        (landed_purchases(spark, sf), ORDERS),
        (landed_clicks(spark, sf), CLICKS),
    ):
        batches = _sliced(rows, slice_seconds)
        part = live.summarise(batches, at=F.col("event_timestamp"))
        if sampled:
            shown = [*feed.event.fieldNames(), "kafka_key", "source_topic", "event_timestamp"]
            part = live.with_samples(
                part, live.samples(batches, ["event_timestamp", feed.key], shown)
            )
        parts.append(part)
    return parts[0].unionByName(parts[1])


def _sample_as_text(df: DataFrame) -> DataFrame:
    joined = F.concat(F.lit("["), F.array_join("sample", ","), F.lit("]"))
    return df.withColumn("sample", joined)


def batch_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return _sample_as_text(event_summaries(spark, sf, sampled=True))


def topic_totals(spark: SparkSession, sf: str) -> DataFrame:
    return live.topic_totals(event_summaries(spark, sf))


def stream_stats(spark: SparkSession, sf: str) -> DataFrame:
    return live.stream_stats(event_summaries(spark, sf))


def throughput_per_second(spark: SparkSession, sf: str) -> DataFrame:
    """One summary per minute, shown over the last day."""
    return live.throughput_per_second(event_summaries(spark, sf, MINUTE), DAY)


def current_rate(spark: SparkSession, sf: str) -> DataFrame:
    return live.current_rate(event_summaries(spark, sf, MINUTE))


def dashboard_header(spark: SparkSession, sf: str) -> DataFrame:
    return live.header(event_summaries(spark, sf, MINUTE))


def summary_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Every summary as a message, and faulty messages made of the other tables."""
    sent = event_summaries(spark, sf, sampled=True)
    good = live.messages(sent)

    def message(table: str, *fields) -> DataFrame:
        return feeds.table(spark, sf, table).select(F.to_json(F.struct(*fields)).alias("value"))

    when = F.col("o_orderdate").cast("string").alias("timestamp")

    def written(table: str, text: str):
        """Messages written out, with the table's first column as ``batch_id``."""
        rows = feeds.table(spark, sf, table)
        number = F.col(rows.columns[0]).cast("string")
        return rows.select(F.replace(F.lit(text), F.lit("#"), number).alias("value"))

    head = '{"batch_id":#,"topic":"raw.orders","records":5,"timestamp":"2024"'
    odd = [
        written("nation", '{"batch_id":#,"topic":7,"records":5,"timestamp":"2024"}'),
        written("region", '{"batch_id":#,"topic":"t","records":5,"timestamp":2024}'),
        written("supplier", head + ',"type":1}'),
        written("customer", head + ',"sample":null}'),
        written("part", head + ',"sample":[1,2]}'),
        written("benchmark", '{"batch_id":#,"topic":"t","records":5.0,"timestamp":"x"}'),
    ]
    messages = (
        good.unionByName(
            feeds.table(spark, sf, "conversations").select(F.col("text").alias("value"))
        )
        .unionByName(message("part", F.col("p_name").alias("topic")))
        .unionByName(message("supplier", F.col("s_suppkey").alias("batch_id")))
        .unionByName(
            message(
                "orders",
                F.col("o_orderkey").alias("batch_id"),
                F.col("o_orderpriority").alias("topic"),
                F.col("o_orderstatus").alias("records"),
                when,
            )
        )
        .unionByName(
            message(
                "orders",
                F.col("o_orderkey").cast("string").alias("batch_id"),
                F.col("o_orderpriority").alias("topic"),
                F.col("o_custkey").alias("records"),
                when,
            )
        )
    )
    for part in odd:
        messages = messages.unionByName(part)
    return (
        live.accept_messages(messages)
        .groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("verdict"))
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum("records").alias("records"),
            F.sum(F.size("sample")).alias("samples"),
        )
    )


def _summary_log(spark: SparkSession, lake: Lake, log: DataFrame, steps: int) -> Iterator[int]:
    """Lands the log in so many batches a topic, oldest first; yields after each."""
    log = log.persist()
    for step in range(steps):
        share = F.ntile(steps).over(Window.partitionBy("topic").orderBy("batch_id")) - 1
        for feed in (ORDERS, CLICKS):
            part = log.withColumn("_step", share).where((F.col("_step") == step) & (F.col("topic") == feed.topic))
            bronze.land_batch(part.drop("_step", "batch_id").coalesce(1), lake.summaries(feed), RUN, step)
        yield step


def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Records per kind from kept figures, refreshed after each part of the log but the last."""
    lake = Lake.under(work_dir(spark, "running-totals"))
    for step in _summary_log(spark, lake, event_summaries(spark, sf), 3):
        if step < 2:
            figures.refresh_figures(spark, lake)
    return live.totals_from(figures.running_figures(spark, lake))


def running_header(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake.under(work_dir(spark, "running-header"))
    for _ in _summary_log(spark, lake, event_summaries(spark, sf, MINUTE), 3):
        figures.refresh_figures(spark, lake)
    return live.header_from(figures.running_figures(spark, lake))


def live_feed(spark: SparkSession, sf: str) -> DataFrame:
    return _sample_as_text(live.live_feed(event_summaries(spark, sf, sampled=True)))


def replay_buffer(spark: SparkSession, sf: str) -> DataFrame:
    return _sample_as_text(live.replay_buffer(event_summaries(spark, sf, sampled=True)))


def layer_summary(spark: SparkSession, sf: str) -> DataFrame:
    lines, visits = landed_lines(spark, sf), landed_clicks(spark, sf)
    twice = lines.unionByName(lines)
    return layers.layer_summary(
        {
            "bronze": {ORDERS.name: twice, CLICKS.name: visits},
            "silver": {
                ORDERS.name: clean.clean_orders(twice),
                CLICKS.name: clean.clean_clicks(visits),
            },
        }
    )


# --- upserts --------------------------------------------------------------------

SPLIT_DAY = "1998-07-01"
CLICK_TARGET_END = "2024-01-16"
CLICK_UPDATE_START = "2024-01-11"


def _lines_shipped(
    spark: SparkSession, sf: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Line items of a period as events; the bounds reach the Parquet reader."""
    lines = feeds.table(spark, sf, "lineitem")
    if start:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        lines = lines.filter(F.col("l_shipdate") < F.lit(end).cast("timestamp_ntz"))
    return feeds.order_lines(lines)


def silver_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """MERGE semantics: lines shipped from the split day on replace and extend the earlier ones."""
    earlier = feeds.landed(_lines_shipped(spark, sf, end=SPLIT_DAY), ORDERS)
    later = feeds.landed(_lines_shipped(spark, sf, start=SPLIT_DAY), ORDERS)
    target, updates = clean.clean_orders(earlier), clean.clean_orders(later)
    merged = upsert.merge_replace(target, updates, ORDERS.dedup)
    return merged.select(*SILVER_ORDER_COLUMNS)


def silver_upsert_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Composite key: the two periods overlap by five days, the update corrects the address."""
    events = feeds.table(spark, sf, "events")
    target_end = F.lit(CLICK_TARGET_END).cast("timestamp_ntz")
    update_start = F.lit(CLICK_UPDATE_START).cast("timestamp_ntz")
    earlier = feeds.clicks(events.filter(F.col("ts") < target_end))
    later = feeds.clicks(events.filter(F.col("ts") >= update_start))
    target = clean.clean_clicks(feeds.landed(earlier, CLICKS))
    updates = clean.clean_clicks(
        feeds.landed(later.withColumn("ip", F.lit("10.0.0.1")), CLICKS)
    )
    merged = upsert.merge_replace(target, updates, CLICKS.dedup, nulls_match=True)
    return merged.select(*SILVER_CLICK_COLUMNS)


def _changed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A change notice per line: for open lines a day newer, for closed ones a day stale."""
    days = F.when(F.col("l_linestatus") == "O", 1).otherwise(-1)
    shifted = feeds.table(spark, sf, "lineitem").withColumn(
        "l_shipdate",
        (F.col("l_shipdate") + F.make_dt_interval(days=days)).cast("timestamp_ntz"),
    )
    changed = feeds.order_lines(shifted).withColumn("status", F.lit("cancelled"))
    return feeds.landed(changed, ORDERS)


def _newest(spark: SparkSession, sf: str, merge: Callable[..., DataFrame]) -> DataFrame:
    target = silver_lines(spark, sf)
    updates = clean.clean_orders(_changed_lines(spark, sf))
    merged = merge(target, updates, ORDERS.dedup, ORDERS.survivor)
    return merged.select(*SILVER_ORDER_COLUMNS)


def silver_upsert_newest(spark: SparkSession, sf: str) -> DataFrame:
    return _newest(spark, sf, upsert.merge_newest)


def silver_upsert_newest_narrow(spark: SparkSession, sf: str) -> DataFrame:
    return _newest(spark, sf, upsert.merge_newest_narrow)


# --- stored layers --------------------------------------------------------------

RUN = "run-a"
LINE_BOUNDS = ["1997-01-01", "1999-01-01", "2001-01-01"]


def _land_lines_by_period(spark: SparkSession, sf: str, path: str, periods: range) -> None:
    """The line items as four Bronze batches, one per ship period."""
    edges = [None, *LINE_BOUNDS, None]
    for n in periods:
        rows = feeds.landed(_lines_shipped(spark, sf, edges[n], edges[n + 1]), ORDERS)
        bronze.land_batch(rows, path, RUN, n)


def bronze_schema_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch brings a column that the first does not have."""
    path = f"{work_dir(spark, 'schema-merge')}/orders"
    bronze.land_batch(landed_lines(spark, sf), path, RUN, 0)
    wider = landed_purchases(spark, sf).withColumn("channel", F.concat(F.lit("c-"), "product"))
    bronze.land_batch(wider, path, RUN, 1)
    return bronze.read_bronze(spark, path, schema=None).select(
        "batch_id", "order_id", "amount", "channel"
    )


def pack_summaries(spark: SparkSession, sf: str) -> DataFrame:
    """The summaries of all time slices landed as batches, and packed: none lost."""
    lake = Lake.under(work_dir(spark, "pack-summaries"))
    log = event_summaries(spark, sf, sampled=True).persist()
    for feed in (ORDERS, CLICKS):
        mine = log.where(F.col("topic") == feed.topic)
        numbers = sorted(r[0] for r in mine.select("batch_id").distinct().collect())
        for n, slice_id in enumerate(numbers[-8:]):  # the last folders, one for each slice
            one = mine.where(F.col("batch_id") == slice_id).drop("batch_id")
            bronze.land_batch(one.coalesce(1), lake.summaries(feed), RUN, n + 1)
        early = mine.where(~F.col("batch_id").isin(numbers[-8:])).drop("batch_id")
        bronze.land_batch(early, lake.summaries(feed), RUN, 0)
        upkeep.pack(spark, lake, feed, upkeep.Packing(min_batches=4, delay_seconds=0))
    return _sample_as_text(ingest.read_summaries(spark, lake)).drop("batch_id")


def compact_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Two closed batches packed, two left as they are: same rows as before."""
    path = f"{work_dir(spark, 'compact')}/orders"
    _land_lines_by_period(spark, sf, path, range(4))
    bronze.compact(spark, path, RUN, 1, ORDERS.bronze_stored)
    bronze.drop_packed_batches(spark, path, RUN)
    rows = bronze.read_bronze(spark, path, ORDERS.bronze_stored)
    return rows.select("batch_id", *SILVER_ORDER_COLUMNS)


def incremental_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Two refreshes, the second taking in only the batches that came after the first."""
    lake = Lake.under(work_dir(spark, "incremental"))
    _land_lines_by_period(spark, sf, lake.bronze(ORDERS), range(0, 2))
    silver.refresh_silver(spark, lake, ORDERS)
    _land_lines_by_period(spark, sf, lake.bronze(ORDERS), range(2, 4))
    silver.refresh_silver(spark, lake, ORDERS)
    return snapshots.read_table(spark, lake.silver(ORDERS)).select(*SILVER_ORDER_COLUMNS)


def _parted_lake(spark: SparkSession, purpose: str) -> Lake:
    """A new lake with Silver in parts, in a database of its own."""
    root = work_dir(spark, purpose)
    return Lake.under(root, silver_database=f"silver_{uuid.uuid4().hex}", silver_parts=16)


def incremental_silver_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The same with Silver in parts, of which the second refresh rewrites those that change."""
    lake = _parted_lake(spark, "incremental-parts")
    _land_lines_by_period(spark, sf, lake.bronze(ORDERS), range(0, 3))
    silver.refresh_silver(spark, lake, ORDERS)
    _land_lines_by_period(spark, sf, lake.bronze(ORDERS), range(3, 4))
    silver.refresh_silver(spark, lake, ORDERS)
    return silver.read_silver(spark, lake, ORDERS).select(*SILVER_ORDER_COLUMNS)


def marts_by_change(spark: SparkSession, sf: str) -> DataFrame:
    """All marts of both feeds after a second cycle, which reads changed rows only."""
    lake = _parted_lake(spark, "marts-by-change")
    visits = landed_clicks(spark, sf)
    early = F.col("event_timestamp") < F.lit(CLICK_TARGET_END).cast("timestamp")
    _land_lines_by_period(spark, sf, lake.bronze(ORDERS), range(0, 3))
    bronze.land_batch(visits.where(early), lake.bronze(CLICKS), RUN, 0)
    cycle.run_cycle(spark, lake)
    _land_lines_by_period(spark, sf, lake.bronze(ORDERS), range(3, 4))
    bronze.land_batch(visits.where(~early), lake.bronze(CLICKS), RUN, 1)
    log = cycle.run_cycle(spark, lake, cycle=2)
    marts_made = {**gold.load_marts(spark, lake, ORDERS), **gold.load_marts(spark, lake, CLICKS)}
    how = log.select(
        F.substring("step", 6, 100).alias("mart"), F.coalesce("error", F.lit("whole")).alias("made")
    ).where(F.col("step").startswith("gold_"))
    return gold.marts_as_rows(marts_made).join(how, "mart")


def silver_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    lake = Lake.under(work_dir(spark, "rebuild"))
    _land_lines_by_period(spark, sf, lake.bronze(ORDERS), range(4))
    silver.rebuild_silver(spark, lake, ORDERS)
    return snapshots.read_table(spark, lake.silver(ORDERS)).select(*SILVER_ORDER_COLUMNS)


def _refreshed_lake(spark: SparkSession, sf: str) -> tuple[Lake, DataFrame]:
    lake = Lake.under(work_dir(spark, "cycle"))
    bronze.land_batch(landed_lines(spark, sf), lake.bronze(ORDERS), RUN, 0)
    bronze.land_batch(landed_clicks(spark, sf), lake.bronze(CLICKS), RUN, 0)
    return lake, cycle.run_cycle(spark, lake)


def refresh_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """What a cycle reports, without its timings."""
    _, log = _refreshed_lake(spark, sf)
    account = ["rows_in", "dropped_null", "dropped_dup", "passed"]
    return log.select("cycle", "step", "status", "rows", *account)


def gold_catalog(spark: SparkSession, sf: str) -> DataFrame:
    lake, _ = _refreshed_lake(spark, sf)
    # A folder that is no table: the lines as they were landed.
    lines = bronze.read_batch(spark, lake.bronze(ORDERS), RUN, 0, ORDERS.bronze)
    lines.write.parquet(f"{lake.gold_root}/scratch")
    return gold.gold_catalog(spark, lake).withColumn("valid", F.col("valid").cast("int"))


def load_marts_orders(spark: SparkSession, sf: str) -> DataFrame:
    lake, _ = _refreshed_lake(spark, sf)
    return gold.marts_as_rows(gold.load_marts(spark, lake, ORDERS))


def load_marts_clicks(spark: SparkSession, sf: str) -> DataFrame:
    lake, _ = _refreshed_lake(spark, sf)
    return gold.marts_as_rows(gold.load_marts(spark, lake, CLICKS))


# --- streams --------------------------------------------------------------------


def _line_topic(spark: SparkSession, sf: str, path: str) -> None:
    sent = records.encode(order_lines(spark, sf), ORDERS.key, ORDERS.topic)
    topics.publish(sent, ORDERS.topic, "parquet", {"path": path})


def _in_files(records: DataFrame, least: int) -> DataFrame:
    """Records of one scan as they lie, or dealt out anew where they would give too few files."""
    return records if records.rdd.getNumPartitions() >= least else records.repartition(least)


def _files_per_trigger(spark: SparkSession, path: str) -> str:
    """Two files a micro-batch, or more where the topic would then take over ``MICRO_BATCHES``:
    each one goes through all state that is kept, so their number must not grow with the topic."""
    return str(max(2, -(-len(spark.read.parquet(path).inputFiles()) // MICRO_BATCHES)))


def _click_topic(spark: SparkSession, sf: str, path: str, deliveries: int = 1) -> None:
    """Clicks as records; ``offset`` tells the deliveries of one click apart."""
    visits = clicks(spark, sf)
    for n in range(deliveries):
        number = F.xxhash64("timestamp", F.lit(n))
        sent = records.encode(visits, CLICKS.key, CLICKS.topic, offset=number)
        topics.publish(sent, CLICKS.topic, "parquet", {"path": path})


def stream_ingest_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Both topics streamed to Bronze side by side; the landed rows."""
    root = work_dir(spark, "ingest")
    lake = Lake.under(f"{root}/lake")
    paths = {f.name: f"{root}/topics/{f.name}" for f in (ORDERS, CLICKS)}
    _line_topic(spark, sf, paths[ORDERS.name])
    _click_topic(spark, sf, paths[CLICKS.name])
    options = {name: {"path": path} for name, path in paths.items()}
    ingest.run_streams(spark, lake, "parquet", options, available_now=True)
    parts = [
        bronze.read_bronze(spark, lake.bronze(f), f.bronze_stored).select(
            "source_topic", "kafka_key", "user_id", "timestamp", "event_timestamp"
        )
        for f in (ORDERS, CLICKS)
    ]
    return parts[0].unionByName(parts[1])


def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Good and faulty records streamed to Bronze; the refused ones found there."""
    root = work_dir(spark, "quarantine")
    lake = Lake.under(f"{root}/lake")
    path = {"path": f"{root}/topic"}
    topics.publish(mixed_records(spark, sf), ORDERS.topic, "parquet", path)
    ingest.start_stream(spark, ORDERS, lake, "parquet", path, available_now=True).awaitTermination()
    rows = bronze.read_bronze(spark, lake.bronze(ORDERS), ORDERS.bronze_stored)
    return records.landed_quarantine(rows).select(
        "kafka_key", "reject_reason", F.length("value").alias("text_length")
    )


def stream_summary_log(spark: SparkSession, sf: str) -> DataFrame:
    """Records per topic according to the summaries that the streams wrote."""
    root = work_dir(spark, "summary-log")
    lake = Lake.under(f"{root}/lake")
    paths = {f.name: f"{root}/topics/{f.name}" for f in (ORDERS, CLICKS)}
    _line_topic(spark, sf, paths[ORDERS.name])
    _click_topic(spark, sf, paths[CLICKS.name])
    options = {name: {"path": path} for name, path in paths.items()}
    ingest.run_streams(spark, lake, "parquet", options, available_now=True)
    return live.topic_totals(ingest.read_summaries(spark, lake))


def stream_revenue_per_minute(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases, and orders whose time cannot be read, over several micro-batches."""
    root = work_dir(spark, "stream-revenue")
    priced = feeds.table(spark, sf, "orders").select(
        F.concat(F.lit("order-"), "o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("timestamp"),
    )
    for events in (purchases(spark, sf), priced):
        sent = records.encode(events, "order_id", ORDERS.topic)
        topics.publish(sent.repartition(3), ORDERS.topic, "parquet", {"path": f"{root}/topic"})
    options = {"path": f"{root}/topic", "maxFilesPerTrigger": "2"}
    raw = topics.topic_stream(spark, ORDERS.topic, "parquet", options)
    orders = records.decode(raw, ORDERS.event, ORDERS.topic)
    for query in aggregates.start_revenue_stream(
        orders, f"{root}/out", f"{root}/checkpoint", WHOLE_PERIOD, available_now=True
    ):
        query.awaitTermination()
    return aggregates.read_revenue(spark, f"{root}/out")


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every click delivered twice, and clicks without a readable time, one for each order
    but only a few keys; over several micro-batches the stream lets one of each key pass."""
    root = work_dir(spark, "stream-dedup")
    _click_topic(spark, sf, f"{root}/topic", deliveries=2)
    undated = feeds.table(spark, sf, "orders", as_it_lies=True).select(
        F.concat(F.lit("customer-"), "o_custkey").alias("session_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.concat(F.lit("/"), "o_orderstatus").alias("page"),
        F.col("o_orderstatus").alias("action"),
        F.lit("unreadable").alias("timestamp"),
        "o_orderkey",
    )
    sent = records.encode(undated, CLICKS.key, CLICKS.topic, offset=F.xxhash64("o_orderkey"))
    topics.publish(_in_files(sent, 3), CLICKS.topic, "parquet", {"path": f"{root}/topic"})
    options = {"path": f"{root}/topic", "maxFilesPerTrigger": _files_per_trigger(spark, f"{root}/topic")}
    raw = topics.topic_stream(spark, CLICKS.topic, "parquet", options)
    rows = records.decode(raw, CLICKS.event, CLICKS.topic, keep=["partition", "offset"])
    passed = dedup.first_within(
        rows, CLICKS.dedup, WHOLE_PERIOD, spread_by=["partition", "offset"]
    )
    passed.select(*SILVER_CLICK_COLUMNS).writeStream.format("parquet").option(
        "path", f"{root}/out"
    ).option("checkpointLocation", f"{root}/checkpoint").trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(f"{root}/out")


# --- contract -------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Line items as keyed records, decoded, cleaned, and summed up per product."""
    sent = records.encode(order_lines(spark, SMOKE_DIR), ORDERS.key, ORDERS.topic)
    landed = records.decode(sent, ORDERS.event)
    return marts.revenue_per_product(clean.clean_orders(landed))


_QUERIES = [
    envelope_roundtrip,
    decode_orders,
    decode_clicks,
    quarantine_orders,
    fault_counts,
    clean_orders,
    clean_clicks,
    silver_audit,
    revenue_per_product,
    orders_by_status,
    revenue_per_minute,
    revenue_of_any_size,
    top_pages,
    top_actions,
    events_per_device,
    status_share,
    top_products,
    batch_summaries,
    topic_totals,
    stream_stats,
    throughput_per_second,
    current_rate,
    dashboard_header,
    summary_contract,
    running_totals,
    running_header,
    live_feed,
    replay_buffer,
    layer_summary,
    silver_upsert,
    silver_upsert_clicks,
    silver_upsert_newest,
    silver_upsert_newest_narrow,
    bronze_schema_merge,
    compact_bronze,
    pack_summaries,
    incremental_silver,
    incremental_silver_parts,
    marts_by_change,
    silver_rebuild,
    refresh_cycle,
    gold_catalog,
    load_marts_orders,
    load_marts_clicks,
    stream_ingest_bronze,
    stream_quarantine,
    stream_summary_log,
    stream_revenue_per_minute,
    stream_dedup,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {q.__name__: q for q in _QUERIES}
    return found | (training_text.queries() if training_text else {})


def oracle_sql() -> dict[str, str]:
    found = duckdb_queries.oracle_sql()
    return found | (training_text.oracle_sql() if training_text else {})
