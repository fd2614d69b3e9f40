"""Schemas of every table, and the two feeds that tie schema, keys and marts together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Field names and order of the two events.
ORDER_EVENT = T.StructType(
    _strings("order_id", "user_id", "product")
    + [T.StructField("amount", T.DoubleType())]
    + _strings("currency", "status", "ip", "timestamp")
)
CLICK_EVENT = T.StructType(
    _strings("session_id", "user_id", "page", "action", "device", "ip", "timestamp")
)

# What a keyed topic delivers. ``partition`` and ``offset`` identify a record within its topic.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

BRONZE_META = [
    T.StructField("kafka_key", T.StringType()),
    T.StructField("source_topic", T.StringType()),
    T.StructField("ingestion_timestamp", T.TimestampType()),
    T.StructField("event_timestamp", T.TimestampType()),
    # Where the record stood in its topic: tells which of two equally old updates came later.
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
]
# Why a record cannot go on to Silver, and its text; both null for a good record.
FAULT_META = [
    T.StructField("reject_reason", T.StringType()),
    T.StructField("rejected_value", T.StringType()),
]
# Where a Bronze row was landed: the streaming checkpoint's id and the micro-batch number.
BATCH_META = [
    T.StructField("run", T.StringType()),
    T.StructField("batch_id", T.LongType()),
]

SUMMARY = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("topic", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("sample", T.ArrayType(T.StringType())),
    ]
)

# As DDL text: Spark parses it when a session exists.
MART_SCHEMAS = {
    "orders_revenue_per_product": (
        "product string, total_revenue double, order_count bigint, avg_order_value double"
    ),
    "orders_by_status": "status string, order_count bigint",
    "orders_revenue_per_minute": "minute timestamp, revenue double",
    "clicks_top_pages": "page string, views bigint",
    "clicks_top_actions": "action string, events bigint",
    "clicks_events_per_device": "device string, events bigint",
}


@dataclass(frozen=True)
class Feed:
    """One event stream and the rules that hold for it in every layer.

    ``survivor`` ranks rows that share ``dedup``: the largest (event time, then the later
    offset, as a topic keeps a key in one partition, then the listed fields) wins, so that a
    rerun always keeps the same row.
    """

    name: str
    topic: str
    event: T.StructType
    key: str
    required: tuple[str, ...]
    dedup: tuple[str, ...]
    survivor: tuple[str, ...]

    @property
    def bronze(self) -> T.StructType:
        return T.StructType(self.event.fields + BRONZE_META)

    @property
    def bronze_stored(self) -> T.StructType:
        return T.StructType(self.bronze.fields + FAULT_META + BATCH_META)

    @property
    def silver(self) -> T.StructType:
        return T.StructType(
            self.bronze.fields + [T.StructField("processed_at", T.TimestampType())]
        )


_ARRIVAL = ("kafka_key", "source_topic", "ingestion_timestamp")

ORDERS = Feed(
    name="orders",
    topic="raw.orders",
    event=ORDER_EVENT,
    key="order_id",
    required=("order_id", "user_id", "amount"),
    dedup=("order_id",),
    survivor=(
        "event_timestamp", "offset", "amount", "product", "user_id", "currency", "status", "ip", "timestamp",
        *_ARRIVAL,
    ),
)

CLICKS = Feed(
    name="clicks",
    topic="raw.clicks",
    event=CLICK_EVENT,
    key="session_id",
    required=("session_id", "user_id", "page"),
    dedup=("session_id", "event_timestamp", "action"),
    survivor=("event_timestamp", "offset", "page", "user_id", "device", "ip", "timestamp", *_ARRIVAL),
)

FEEDS = (ORDERS, CLICKS)
