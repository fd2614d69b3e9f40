"""Coding of keyed JSON records, and why a record would be refused."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.contracts import Feed
from tierflow.functions.times import clock_now, parse_instant

_CORRUPT = "_corrupt_record"

# Quarantine classes; ``missing_<field>`` stands between these.
NULL_VALUE = "null_value"
MALFORMED = "malformed_json"
BAD_AMOUNT = "bad_amount"
BAD_TIMESTAMP = "bad_timestamp"


def encode(
    events: DataFrame,
    key: str,
    topic: str | None = None,
    offset: Column | None = None,
) -> DataFrame:
    """Events as keyed records: UTF-8 key bytes and UTF-8 JSON bytes.

    ``to_json`` leaves null fields out; they decode back to null.
    """
    columns = [
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*events.columns)).cast("binary").alias("value"),
    ]
    if topic is not None:
        columns.append(F.lit(topic).alias("topic"))
    if offset is not None:
        columns += [F.lit(0).alias("partition"), offset.cast("bigint").alias("offset")]
    return events.select(*columns)


def with_bronze_columns(
    events: DataFrame,
    topic: Column,
    as_of: Column | None = None,
) -> DataFrame:
    """Adds topic, ingest time and parsed event time to decoded events; the place in the
    topic is null where the events do not carry it."""
    place = {"partition": "int", "offset": "bigint"}
    unknown = {c: F.lit(None).cast(t) for c, t in place.items() if c not in events.columns}
    return events.withColumns(
        {
            **unknown,
            "source_topic": topic,
            "ingestion_timestamp": clock_now(as_of),
            "event_timestamp": parse_instant(F.col("timestamp")),
        }
    )


def decode(
    raw: DataFrame,
    schema: T.StructType,
    topic: str | None = None,
    as_of: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Keyed records to Bronze rows; works the same on a batch and on a stream.

    A record that is not readable JSON gives a row of nulls. Without ``topic``
    the topic is taken from the record. ``keep`` carries record columns such as
    ``offset`` along, after the Bronze columns.
    """
    source_topic = F.col("topic") if topic is None else F.lit(topic)
    payload = F.from_json(F.col("value").cast("string"), schema)
    carried = [F.col(c).alias(f"_{c}") for c in keep]
    opened = raw.select(
        payload.alias("_payload"),
        F.col("key").cast("string").alias("kafka_key"),
        source_topic.alias("_topic"),
        *carried,
    ).select("_payload.*", "kafka_key", "_topic", *[f"_{c}" for c in keep])
    bronze = with_bronze_columns(opened, F.col("_topic"), as_of).drop("_topic")
    ordered = [f.name for f in schema.fields] + [
        "kafka_key", "source_topic", "ingestion_timestamp", "event_timestamp",
    ]
    return bronze.select(*ordered, *[F.col(f"_{c}").alias(c) for c in keep])


def _text_schema(schema: T.StructType) -> T.StructType:
    names = [f.name for f in schema.fields] + [_CORRUPT]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _judged(raw: DataFrame, feed: Feed) -> DataFrame:
    """``raw`` with its text, typed parse, parsed event time and ``reject_reason``.

    A clean record is parsed once, under the typed schema. The second, all-text
    parse that tells a mistyped field from broken JSON is behind a condition and
    runs only for records the typed parse complained about.
    """
    typed_schema = T.StructType(feed.event.fields + [T.StructField(_CORRUPT, T.StringType())])
    option = {"columnNameOfCorruptRecord": _CORRUPT}
    parsed = raw.withColumn("_text", F.col("value").cast("string")).withColumn(
        "_typed", F.from_json(F.col("_text"), typed_schema, option)
    )
    complained = F.col("_typed")[_CORRUPT].isNotNull()
    loosely = F.from_json(F.col("_text"), _text_schema(feed.event), option)
    parsed = parsed.withColumns(
        {
            "_loose": F.when(complained, loosely),
            "_at": parse_instant(F.col("_typed")["timestamp"]),
        }
    )

    typed, loose = F.col("_typed"), F.col("_loose")

    def absent(field: str) -> Column:
        return typed[field].isNull() & loose[field].isNull()

    reason = F.when(F.col("_text").isNull(), F.lit(NULL_VALUE)).when(
        (F.trim(F.col("_text")) == "") | loose[_CORRUPT].isNotNull(), F.lit(MALFORMED)
    )
    for field in feed.required:
        reason = reason.when(absent(field), F.lit(f"missing_{field}"))
    if "amount" in feed.event.fieldNames():
        reason = reason.when(
            typed["amount"].isNull() | F.isnan(typed["amount"]), F.lit(BAD_AMOUNT)
        )
    reason = reason.when(
        typed["timestamp"].isNotNull() & F.col("_at").isNull(),
        F.lit(BAD_TIMESTAMP),
    )
    return parsed.withColumn("reject_reason", reason).drop("_loose")


def classify(raw: DataFrame, feed: Feed) -> DataFrame:
    """Adds ``reject_reason``, null for a good record; every record is in one class only."""
    return _judged(raw, feed).drop("_text", "_typed", "_at")


def decode_checked(
    raw: DataFrame,
    feed: Feed,
    topic: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """:func:`decode` with each record's place in its topic, its ``reject_reason`` and, where it
    has one, its text. Records without a place get nulls.

    Broken records so stay traceable in Bronze, from the same parse and the same
    write as the good ones.
    """
    place = [
        (F.col(c) if c in raw.columns else F.lit(None)).cast(t).alias(c)
        for c, t in (("partition", "int"), ("offset", "bigint"))
    ]
    return _judged(raw, feed).select(
        *[F.col("_typed")[name].alias(name) for name in feed.event.fieldNames()],
        F.col("key").cast("string").alias("kafka_key"),
        (F.col("topic") if topic is None else F.lit(topic)).alias("source_topic"),
        clock_now(as_of).alias("ingestion_timestamp"),
        F.col("_at").alias("event_timestamp"),
        *place,
        "reject_reason",
        F.when(F.col("reject_reason").isNotNull(), F.col("_text")).alias("rejected_value"),
    )


def is_excluded(reason: Column) -> Column:
    """Whether the class keeps a record out of Silver; a bad time is only a warning."""
    return reason.isNotNull() & (reason != BAD_TIMESTAMP)


def quarantine(raw: DataFrame, feed: Feed) -> DataFrame:
    """The refused records with their key, text and reason."""
    return (
        classify(raw, feed)
        .filter(is_excluded(F.col("reject_reason")))
        .select(
            F.col("key").cast("string").alias("kafka_key"),
            F.col("value").cast("string").alias("value"),
            "reject_reason",
        )
    )


def landed_quarantine(bronze: DataFrame) -> DataFrame:
    """The refused records among landed rows; null checks on one column reach the reader."""
    return bronze.filter(is_excluded(F.col("reject_reason"))).select(
        "kafka_key", F.col("rejected_value").alias("value"), "reject_reason"
    )


def fault_counts(bronze: DataFrame) -> DataFrame:
    """Landed rows per class, warnings included.

    Good rows are left out after the count: a filter before it would go below the parse, and
    parse each record anew for every field that the reason looks at.
    """
    return (
        bronze.groupBy("reject_reason")
        .agg(F.count("reject_reason").alias("records"))
        .filter(F.col("records") > 0)
        .orderBy("reject_reason")
    )
