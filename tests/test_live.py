"""Live metrics over literal summaries."""

from pyspark.sql import functions as F

from tests.helpers import never
from tierflow.contracts import SUMMARY
from tierflow.operators import layers, live


def summary(batch_id, topic="raw.orders", records=1, timestamp="2024-01-01T00:00:00.000000+00:00",
            sample=None, kind="batch"):
    return (kind, batch_id, topic, records, timestamp, sample)


def log(spark, rows):
    return spark.createDataFrame(rows, SUMMARY)


def at(second):
    return f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}.250000+00:00"


def test_totals_by_kind(spark):
    rows = [
        summary(0, "raw.orders", 5),
        summary(0, "raw.clicks", 7),
        summary(1, "orders.and.clicks", 1),
        summary(0, "audit", 100),
        summary(0, None, 10),
        summary(0, "", 1),
        summary(2, "raw.orders", None),
        summary(3, "raw.orders", 50, kind="ping"),
    ]
    got = {r["kind"]: r["records"] for r in live.topic_totals(log(spark, rows)).collect()}
    assert got == {"orders": 6, "clicks": 7, "other": 111, "total": 13}


def test_totals_of_nothing(spark):
    empty = never(log(spark, [summary(0)]))
    assert [tuple(r) for r in live.topic_totals(empty).collect()] in ([], [("total", 0)])
    assert live.stream_stats(empty).first()["total_events"] == 0
    assert live.current_rate(empty).first()[0] == 0
    assert live.throughput_per_second(empty).count() == 0


def test_stream_stats_counts_every_message(spark):
    rows = [summary(0, records=2, timestamp=at(5)), summary(1, records=3, timestamp=at(9)),
            summary(2, "audit", None, at(7), kind="ping")]
    assert tuple(live.stream_stats(log(spark, rows)).first()) == (5, at(9))


def test_missing_time_is_the_reading_time(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    rows = [summary(0, timestamp=at(5)), summary(1, timestamp=None)]
    got = live.stream_stats(log(spark, rows), as_of=now).first()["last_batch_at"]
    assert got == "2024-01-02T00:00:00.000000+00:00"


def test_rate_window_keeps_both_ends(spark):
    rows = [summary(s, "raw.clicks" if s % 2 else "raw.orders", s, at(s)) for s in range(100)]
    got = live.throughput_per_second(log(spark, rows)).collect()
    assert len(got) == 61
    assert (got[0]["time"], got[0]["orders"], got[0]["clicks"]) == ("00:39", 0, 39)
    assert (got[-1]["time"], got[-1]["orders"], got[-1]["clicks"]) == ("01:39", 0, 99)
    assert live.current_rate(log(spark, rows)).first()[0] == 99


def test_rates_add_up_within_a_second_and_leave_gaps(spark):
    rows = [summary(0, "raw.orders", 2, at(1)), summary(1, "raw.orders", 3, at(1)),
            summary(0, "raw.clicks", 4, at(1)), summary(0, "audit", 9, at(8))]
    got = live.throughput_per_second(log(spark, rows)).select("time", "orders", "clicks").collect()
    assert [tuple(r) for r in got] == [("00:01", 5, 4), ("00:08", 0, 0)]
    assert live.current_rate(log(spark, rows)).first()[0] == 0


def test_feed_and_replay(spark):
    rows = [summary(s, records=s, timestamp=at(s), sample=[f'{{"n":{s}}}']) for s in range(120)]
    feed = live.live_feed(log(spark, rows)).collect()
    assert [r["batch_id"] for r in feed] == list(range(119, 69, -1))
    assert feed[0]["id"] == "119-raw.orders-1704067319250"
    assert (feed[0]["clock"], feed[0]["kind"], feed[0]["sample"]) == (
        "00:01:59", "orders", ['{"n":119}'],
    )
    replay = live.replay_buffer(log(spark, rows)).collect()
    assert [r["batch_id"] for r in replay] == list(range(20, 120))


def test_feed_defaults(spark):
    row = live.live_feed(log(spark, [summary(4, None, None, None)])).first()
    assert (row["topic"], row["kind"], row["records"], row["clock"], row["sample"]) == (
        "unknown", "other", 0, "--:--:--", [],
    )
    assert row["id"].startswith("4-unknown-")


def test_feed_reads_only_the_top(spark):
    df = live.live_feed(log(spark, [summary(0)]))
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_summaries_hold_true_counts_and_three_rows(spark):
    rows = spark.range(10).select(
        F.lit("raw.orders").alias("source_topic"),
        (F.col("id") % 2).alias("batch_id"),
        F.col("id").cast("string").alias("order_id"),
        F.timestamp_micros(F.col("id") * 1_000_001).alias("event_timestamp"),
    )
    plain = live.summarise(rows, F.col("event_timestamp"))
    sampled = live.samples(rows, ["order_id"], ["order_id", "event_timestamp"])
    got = {r["batch_id"]: r for r in live.with_samples(plain, sampled).collect()}
    assert {b: r["records"] for b, r in got.items()} == {0: 5, 1: 5}
    assert got[1]["timestamp"] == "1970-01-01T00:00:09.000009+00:00"
    assert got[1]["sample"] == [
        f'{{"order_id":"{i}","event_timestamp":"1970-01-01 00:00:0{i}.00000{i}"}}' for i in (1, 3, 5)
    ]
    assert plain.columns == SUMMARY.fieldNames()


def test_layer_summary(spark):
    one, two = spark.range(1), spark.range(2)
    got = layers.layer_summary(
        {"bronze": {"orders": two, "clicks": one}, "silver": {"orders": one, "clicks": never(one)}}
    )
    assert [tuple(r) for r in got.collect()] == [("bronze", 2, 1, 3), ("silver", 1, 0, 1)]


def test_header(spark):
    rows = [summary(0, "raw.orders", 2, at(1)), summary(1, "raw.orders", 3, at(70)),
            summary(0, "raw.clicks", 4, at(70)), summary(0, "audit", 9, at(71))]
    assert live.header(log(spark, rows)).first().asDict() == {
        "total_events": 9, "records_per_second": 0, "last_batch": "00:01:11",
        "orders": 5, "clicks": 4,
    }
    assert live.header(log(spark, rows[:3])).first()["records_per_second"] == 7
    assert tuple(live.header(never(log(spark, rows))).first()) == (0, 0, "\u2014", 0, 0)


def test_own_summaries_are_messages(spark):
    rows = [summary(1, sample=['{"a":"}"}', '{"b":[1]}']), summary(2), summary(3, "raw.orders", 5, at(1))]
    sent = live.messages(log(spark, rows))
    got = live.accept_messages(sent).orderBy("batch_id").collect()
    assert [r["reject_reason"] for r in got] == [None] * 3
    assert got[0]["sample"] == ['{"a":"}"}', '{"b":[1]}'] and got[1]["sample"] == []


def test_message_contract(spark):
    full = '{"batch_id":1,"topic":"t","records":2,"timestamp":"x"'
    cases = {
        full + ',"type":"ping","sample":[{"a":1},{"b":"c"}]}': None,
        full + "}": None,
        full.replace(":1,", ':"1",') + "}": None,
        full.replace(":2,", ':"two",') + "}": "bad_records",
        full.replace(":1,", ":null,") + "}": "missing_batch_id",
        full + ',"sample":{"a":1}}': "bad_sample",
        full + ',"sample":null}': "bad_sample",
        full + ',"sample":[1,2]}': "bad_sample",
        full + ',"sample":[]}': None,
        full + ',"type":1}': "bad_type",
        full.replace('"t"', "7") + "}": "bad_topic",
        full.replace('"x"', "2024") + "}": "bad_timestamp",
        full.replace(":2,", ":5.0,") + "}": None,
        full.replace(":2,", ":5.5,") + "}": "bad_records",
        '{"batch_id":1}': "missing_topic",
        '{"batch_id":1,"topic":"t","records":2}': "missing_timestamp",
        "nonsense": "malformed_json",
        "": "malformed_json",
    }
    messages = spark.createDataFrame([(v,) for v in cases], "value string").coalesce(1)
    got = live.accept_messages(messages).collect()
    assert [r["reject_reason"] for r in got] == list(cases.values())
    assert (got[0]["type"], got[0]["sample"]) == ("ping", ['{"a":1}', '{"b":"c"}'])
    assert (got[1]["type"], got[1]["batch_id"], got[1]["records"], got[1]["sample"]) == (
        "batch", 1, 2, [],
    )
