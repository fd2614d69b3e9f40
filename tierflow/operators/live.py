"""Batch summaries and the live metrics read from them
(A8-A12, P10-P12, P15-P21, L5-L7, S14).

A summary is one row per micro-batch: ``type, batch_id, topic, records,
timestamp, sample``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.kinds import (
    CLICKS_KIND,
    ORDERS_KIND,
    kind_of,
    records_or_zero,
    topic_or_unknown,
)
from tierflow.functions.times import (
    MINUTE_CLOCK_FORMAT,
    NO_BATCH,
    clock,
    clock_now,
    iso,
    parse_instant,
    transport,
)

BATCH_TYPE = "batch"
SAMPLE_ROWS = 3
FEED_ROWS = 50
REPLAY_ROWS = 100
RATE_WINDOW_SECONDS = 60


def row_json(df: DataFrame) -> Column:
    """One row as JSON text with timestamps in full precision (``to_json`` cuts to ms)."""
    fields = [
        transport(F.col(name)).alias(name) if kind == "timestamp" else F.col(name)
        for name, kind in df.dtypes
    ]
    return F.to_json(F.struct(*fields))


def summarise(rows: DataFrame, at: Column) -> DataFrame:
    """One summary per ``(source_topic, batch_id)`` of landed rows, without a sample.

    ``at`` is the batch's time, taken as the maximum over its rows.
    """
    totals = rows.groupBy("source_topic", "batch_id").agg(
        F.count(F.lit(1)).alias("records"), F.max(at).alias("_at")
    )
    return totals.select(
        F.lit(BATCH_TYPE).alias("type"),
        "batch_id",
        F.col("source_topic").alias("topic"),
        "records",
        iso(F.col("_at")).alias("timestamp"),
        F.array().cast("array<string>").alias("sample"),
    )


def samples(rows: DataFrame, first_by: Sequence[str], shown: Sequence[str]) -> DataFrame:
    """The first three rows of each batch by ``first_by``, as JSON texts.

    The rank cut runs before the shuffle, so a batch that holds most of the table
    still sends three rows per task, and only those rows are rendered.
    """
    batch = ["source_topic", "batch_id"]
    first = Window.partitionBy(*batch).orderBy(*first_by)
    ranked = rows.withColumn("_rank", F.row_number().over(first)).filter(
        F.col("_rank") <= SAMPLE_ROWS
    )
    text = row_json(rows.select(*shown)).alias("json")
    return (
        ranked.groupBy(*batch)
        .agg(F.sort_array(F.collect_list(F.struct("_rank", text))).alias("_ranked"))
        .select(
            F.col("source_topic").alias("topic"),
            "batch_id",
            F.col("_ranked")["json"].alias("sample"),
        )
    )


def with_samples(summaries: DataFrame, sampled: DataFrame) -> DataFrame:
    """Puts samples into summaries; a batch without one keeps its empty list.

    Kept apart from :func:`summarise` because totals and rates need no sample and
    should not pay for it.
    """
    filled = summaries.drop("sample").join(sampled, ["topic", "batch_id"], "left")
    none = F.array().cast("array<string>")
    return filled.withColumn("sample", F.coalesce("sample", none)).select(*summaries.columns)


def messages(summaries: DataFrame) -> DataFrame:
    """Summaries as messages, JSON text in ``value``: the sample's rows become a list of objects."""
    others = F.to_json(F.struct(*[c for c in summaries.columns if c != "sample"]))
    rows = F.coalesce(F.array_join("sample", ","), F.lit(""))
    return summaries.select(
        F.concat(F.rtrim(others, F.lit("}")), F.lit(',"sample":['), rows, F.lit("]}")).alias("value")
    )


def _whole_number(text: Column) -> Column:
    """A number without a fraction, also one written as ``5.0``; else null."""
    value = text.try_cast("decimal(38,10)")
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def accept_messages(messages: DataFrame) -> DataFrame:
    """Summary messages, JSON text in ``value``, checked against their contract.

    ``batch_id``, ``topic``, ``records`` and ``timestamp`` must be there; the two numbers must
    be whole, the others JSON strings. ``type``, a string, and ``sample``, a list of objects,
    have defaults. ``reject_reason`` is null for a message that holds. Texts are judged by
    their JSON type, numbers by their text.
    """
    corrupt = "_corrupt_record"
    fields = "type string, batch_id string, topic string, records string, timestamp string"
    parsed = messages.select(
        "value",
        F.from_json(
            "value",
            f"{fields}, sample string, {corrupt} string",
            {"columnNameOfCorruptRecord": corrupt},
        ).alias("m"),
        F.try_parse_json("value").alias("v"),
    )
    message = F.col("m")
    entries = F.from_json(message["sample"], "array<string>")

    def token(path: str) -> Column:
        """The JSON type at a path: null where there is nothing, ``VOID`` for a null."""
        return F.schema_of_variant(F.try_variant_get("v", path, "variant"))

    reason = F.when(F.col("value").isNull(), "null_value").when(
        (F.trim("value") == "") | message[corrupt].isNotNull() | F.col("v").isNull(),
        "malformed_json",
    )
    for field in ("batch_id", "topic", "records", "timestamp"):
        reason = reason.when(message[field].isNull(), f"missing_{field}")
    for field in ("batch_id", "records"):
        reason = reason.when(_whole_number(message[field]).isNull(), f"bad_{field}")
    for field in ("topic", "timestamp", "type"):
        kind = token(f"$.{field}")
        reason = reason.when(kind.isNotNull() & (kind != "STRING"), f"bad_{field}")
    listed = F.try_variant_get("v", "$.sample", "array<variant>")
    objects = F.forall(listed, lambda e: F.startswith(F.schema_of_variant(e), F.lit("OBJECT")))
    given = token("$.sample").isNotNull()
    reason = reason.when(given & ~F.coalesce(objects, F.lit(False)), "bad_sample")
    return parsed.select(
        F.coalesce(message["type"], F.lit(BATCH_TYPE)).alias("type"),
        _whole_number(message["batch_id"]).alias("batch_id"),
        message["topic"].alias("topic"),
        _whole_number(message["records"]).alias("records"),
        message["timestamp"].alias("timestamp"),
        F.coalesce(entries, F.array().cast("array<string>")).alias("sample"),
        reason.alias("reject_reason"),
    )


def batches_only(summaries: DataFrame) -> DataFrame:
    return summaries.filter(F.col("type") == BATCH_TYPE)


def _time_text(as_of: Column | None) -> Column:
    """A summary's time, or the time of reading it where the sender gave none."""
    return F.coalesce(F.nullif(F.col("timestamp"), F.lit("")), iso(clock_now(as_of)))


def _normalised(summaries: DataFrame, as_of: Column | None) -> DataFrame:
    """Kind, instant and record count with the defaults for missing fields."""
    return batches_only(summaries).select(
        "batch_id",
        topic_or_unknown(F.col("topic")).alias("topic"),
        kind_of(F.col("topic")).alias("kind"),
        records_or_zero(F.col("records")).alias("records"),
        "timestamp",
        parse_instant(_time_text(as_of)).alias("_at"),
        F.coalesce(F.col("sample"), F.array().cast("array<string>")).alias("sample"),
    )


def topic_totals(summaries: DataFrame) -> DataFrame:
    """Records per kind, and a ``total`` row that adds orders and clicks."""
    counted = F.sum(F.when(F.col("kind").isin(ORDERS_KIND, CLICKS_KIND), F.col("records")))
    return (
        _normalised(summaries, None)
        .rollup("kind")
        .agg(
            F.grouping("kind").alias("_all"),
            F.sum("records").alias("_records"),
            F.coalesce(counted, F.lit(0)).alias("_counted"),
        )
        .select(
            F.when(F.col("_all") == 1, "total").otherwise(F.col("kind")).alias("kind"),
            F.when(F.col("_all") == 1, F.col("_counted"))
            .otherwise(F.coalesce(F.col("_records"), F.lit(0)))
            .alias("records"),
        )
    )


def stream_stats(summaries: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Records seen and time of the last batch, over all topics and message types."""
    text = _time_text(as_of)
    return summaries.agg(
        F.coalesce(F.sum(records_or_zero(F.col("records"))), F.lit(0)).alias("total_events"),
        F.max_by(text, F.struct(parse_instant(text), F.col("batch_id"))).alias("last_batch_at"),
    )


def _rates(summaries: DataFrame, window_seconds: int, as_of: Column | None) -> DataFrame:
    """Per-second record counts of the last ``window_seconds``, both ends included.

    Older summaries are cut off before the aggregation, against the newest second
    as a scalar subquery.
    """
    seconds = _normalised(summaries, as_of).select(
        "kind", "records", F.unix_seconds("_at").alias("second")
    )
    newest = seconds.agg(F.max("second")).scalar()

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("records")).otherwise(0))

    return (
        seconds.filter(F.col("second") >= newest - window_seconds)
        .groupBy("second")
        .agg(of(ORDERS_KIND).alias("orders"), of(CLICKS_KIND).alias("clicks"))
    )


def throughput_per_second(
    summaries: DataFrame,
    window_seconds: int = RATE_WINDOW_SECONDS,
    as_of: Column | None = None,
) -> DataFrame:
    """Rate series, oldest first; seconds without a batch have no row."""
    t = F.timestamp_seconds("second")
    return (
        _rates(summaries, window_seconds, as_of)
        .select(
            t.alias("t"), F.date_format(t, MINUTE_CLOCK_FORMAT).alias("time"), "orders", "clicks"
        )
        .orderBy("t")
    )


def _per_second(summaries: DataFrame, as_of: Column | None) -> DataFrame:
    """One row a second: records by kind, and the last summary's time."""

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("records")).otherwise(0))

    return (
        _normalised(summaries, as_of)
        .groupBy(F.unix_seconds("_at").alias("second"))
        .agg(
            of(ORDERS_KIND).alias("orders"),
            of(CLICKS_KIND).alias("clicks"),
            F.max_by(F.struct(F.col("timestamp").alias("at")), F.struct("_at", "batch_id")).alias("_last"),
            F.max(F.struct("_at", "batch_id")).alias("_newest"),
        )
    )


def _rate_now() -> Column:
    """The newest second always lies in the rate's window, so no horizon is needed."""
    rate = F.max_by(F.col("orders") + F.col("clicks"), "second")
    return F.coalesce(rate, F.lit(0)).alias("records_per_second")


def current_rate(summaries: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Orders plus clicks of the last second that has a batch, 0 when there is none."""
    return _per_second(summaries, as_of).agg(_rate_now())


def header(summaries: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The figures over the dashboard: events, rate now, time of last batch, split by kind.

    One pass: per second, then over all seconds.
    """
    return (
        _per_second(summaries, as_of)
        .agg(
            F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
            F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"),
            _rate_now(),
            F.max_by("_last", "_newest").alias("_last"),
        )
        .select(
            (F.col("orders") + F.col("clicks")).alias("total_events"),
            "records_per_second",
            clock(parse_instant(F.col("_last.at")), NO_BATCH).alias("last_batch"),
            "orders",
            "clicks",
        )
    )


# --- running figures: sums that can be kept and added to

#: A line for each kind, for each second of the rate's window, and for the newest summary
#: of any type (``any``) and of type batch (``batch``).
FIGURES = (
    "part string, kind string, second bigint, records bigint, orders bigint, clicks bigint, "
    "at timestamp, batch_id bigint, text string"
)
_FIGURE_COLUMNS = [c.split()[0] for c in FIGURES.split(", ")]


def _figure_lines(part: str, df: DataFrame) -> DataFrame:
    kinds = dict(c.split() for c in FIGURES.split(", "))
    given = {"part": F.lit(part), **{c: F.col(c) for c in df.columns}}
    return df.select(*[given.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in _FIGURE_COLUMNS])


def figures_of(summaries: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The figures of some summaries, as lines that :func:`added_figures` can add to others'."""
    batches, text = _normalised(summaries, as_of), _time_text(as_of)

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("records")).otherwise(0)).alias(kind)

    def newest(at: Column, shown: Column) -> Column:
        return F.max(F.struct(at.alias("at"), F.col("batch_id"), shown.alias("text"))).alias("n")

    per_kind = batches.groupBy("kind").agg(F.sum("records").alias("records"))
    per_second = batches.groupBy(F.unix_seconds("_at").alias("second")).agg(of(ORDERS_KIND), of(CLICKS_KIND))
    last = batches.agg(newest(F.col("_at"), F.col("timestamp"))).select("n.*")
    seen = summaries.agg(F.sum(records_or_zero(F.col("records"))).alias("records"), newest(parse_instant(text), text))
    return (
        _figure_lines("kind", per_kind)
        .unionByName(_figure_lines("second", per_second))
        .unionByName(_figure_lines("batch", last))
        .unionByName(_figure_lines("any", seen.select("records", "n.*")))
    )


def added_figures(lines: DataFrame, window_seconds: int = RATE_WINDOW_SECONDS) -> DataFrame:
    """One line where there were several, without the seconds that left the rate's window."""
    newest = F.max(F.struct("at", "batch_id", "text"))
    summed = lines.groupBy("part", "kind", "second").agg(
        *[F.sum(c).alias(c) for c in ("records", "orders", "clicks")], newest.alias("n")
    )
    summed = summed.select("part", "kind", "second", "records", "orders", "clicks", "n.*")
    last = summed.agg(F.max("second")).scalar()
    gone = (F.col("part") == "second") & (F.col("second") < last - window_seconds)
    return summed.where(~F.coalesce(gone, F.lit(False)))


def totals_from(figures: DataFrame) -> DataFrame:
    """:func:`topic_totals` of all summaries that the figures are of."""
    kinds = figures.where(F.col("part") == "kind").select("kind", F.coalesce("records", F.lit(0)).alias("records"))
    counted = F.when(F.col("kind").isin(ORDERS_KIND, CLICKS_KIND), F.col("records"))
    total = kinds.agg(F.coalesce(F.sum(counted), F.lit(0)).alias("records"), F.count(F.lit(1)).alias("n")).where("n > 0")
    return kinds.unionByName(total.select(F.lit("total").alias("kind"), "records"))


def stats_from(figures: DataFrame) -> DataFrame:
    """:func:`stream_stats` of all summaries that the figures are of."""
    seen = figures.where(F.col("part") == "any")
    return seen.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("total_events"), F.max("text").alias("last_batch_at"))


def throughput_from(figures: DataFrame, window_seconds: int = RATE_WINDOW_SECONDS) -> DataFrame:
    """:func:`throughput_per_second`, for at most the seconds that the figures have."""
    seconds = figures.where(F.col("part") == "second")
    newest, t = seconds.agg(F.max("second")).scalar(), F.timestamp_seconds("second")
    shown = [t.alias("t"), F.date_format(t, MINUTE_CLOCK_FORMAT).alias("time"), "orders", "clicks"]
    return seconds.where(F.col("second") >= newest - window_seconds).select(*shown).orderBy("t")


def header_from(figures: DataFrame) -> DataFrame:
    """:func:`header` of all summaries that the figures are of."""

    def of(kind: str) -> Column:
        test = (F.col("part") == "kind") & (F.col("kind") == kind)
        return F.coalesce(F.sum(F.when(test, F.col("records"))), F.lit(0)).alias(kind)

    second = F.when(F.col("part") == "second", F.col("second"))
    rate = F.coalesce(F.max_by(F.col("orders") + F.col("clicks"), second), F.lit(0)).alias("records_per_second")
    last = F.max(F.when(F.col("part") == "batch", F.col("text"))).alias("last")
    return figures.agg(of(ORDERS_KIND), of(CLICKS_KIND), rate, last).select(
        (F.col(ORDERS_KIND) + F.col(CLICKS_KIND)).alias("total_events"),
        "records_per_second",
        clock(parse_instant(F.col("last")), NO_BATCH).alias("last_batch"),
        ORDERS_KIND,
        CLICKS_KIND,
    )


def live_feed(
    summaries: DataFrame, limit: int = FEED_ROWS, as_of: Column | None = None
) -> DataFrame:
    """The newest summaries, newest first, as the feed shows them."""
    return (
        _normalised(summaries, as_of)
        .orderBy(F.col("_at").desc_nulls_last(), F.col("topic"), F.col("batch_id").desc())
        .limit(limit)
        .select(
            F.concat_ws(
                "-", F.col("batch_id").cast("string"), "topic", F.unix_millis("_at").cast("string")
            ).alias("id"),
            "topic",
            "kind",
            "batch_id",
            "records",
            "timestamp",
            clock(parse_instant(F.col("timestamp"))).alias("clock"),
            "sample",
        )
    )


def replay_buffer(summaries: DataFrame, limit: int = REPLAY_ROWS) -> DataFrame:
    """The last summaries, oldest first: what a newly connected reader is sent."""
    at = parse_instant(F.col("timestamp"))
    newest = (
        summaries.withColumn("_at", at)
        .orderBy(F.col("_at").desc_nulls_last(), F.col("topic"), F.col("batch_id").desc())
        .limit(limit)
    )
    return newest.orderBy(
        F.col("_at").asc_nulls_first(), F.col("topic").desc(), F.col("batch_id").asc()
    ).drop("_at")
