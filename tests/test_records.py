"""Coding of records: faults, round trips, and the quarantine split."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import envelopes, facts, order, orders
from tierflow.contracts import CLICKS, ORDERS
from tierflow.functions import records

GOOD = json.dumps(
    {"order_id": "a", "user_id": "u", "amount": 1.5, "timestamp": "2024-01-01T00:00:00+00:00"}
)
# value -> (order_id, amount) as decoded, class
CASES = [
    (GOOD, ("a", 1.5), None),
    ("not json", (None, None), "malformed_json"),
    ('{"amount":2,"extra":1}', (None, 2.0), "missing_order_id"),
    ('{"order_id":"b","user_id":"u","amount":"x"}', ("b", None), "bad_amount"),
    ('{"order_id":"b","user_id":"u","amount":"1.5"}', ("b", None), "bad_amount"),
    ('{"order_id":"b","user_id":"u","amount":"NaN"}', None, "bad_amount"),
    ('{"order_id":"b","amount":"x"}', ("b", None), "missing_user_id"),
    ('{"amount":"x"}', (None, None), "missing_order_id"),
    ('{"order_id":"b","user_id":"u"}', ("b", None), "missing_amount"),
    ('{"order_id":7,"user_id":"u","amount":1}', ("7", 1.0), None),
    ('{"order_id":"","user_id":"u","amount":1}', ("", 1.0), None),
    ('{"order_id":"b","user_id":"u","amount":1,"timestamp":"bad"}', ("b", 1.0), "bad_timestamp"),
    ("", (None, None), "malformed_json"),
    ("   ", (None, None), "malformed_json"),
    (None, (None, None), "null_value"),
    ("[]", (None, None), "malformed_json"),
    ("{}", (None, None), "missing_order_id"),
]


def test_decode_of_faulty_records(spark):
    raw = envelopes(spark, [c[0] for c in CASES])
    got = {r["kafka_key"]: r for r in records.decode(raw, ORDERS.event).collect()}
    assert len(got) == len(CASES)
    for i, (_, expected, _) in enumerate(CASES):
        if expected is not None:
            assert (got[f"k{i}"]["order_id"], got[f"k{i}"]["amount"]) == expected, CASES[i]
        assert got[f"k{i}"]["source_topic"] == "raw.orders"


def test_each_record_is_in_one_class(spark):
    raw = envelopes(spark, [c[0] for c in CASES])
    judged = records.classify(raw, ORDERS).select(F.col("key").cast("string"), "reject_reason")
    got = dict(map(tuple, judged.collect()))
    assert got == {f"k{i}": c[2] for i, c in enumerate(CASES)}


def test_quarantine_and_valid_make_up_the_input(spark):
    raw = envelopes(spark, [c[0] for c in CASES])
    judged = records.classify(raw, ORDERS)
    valid = judged.filter(~records.is_excluded(F.col("reject_reason"))).count()
    assert valid + records.quarantine(raw, ORDERS).count() == len(CASES)
    required = [F.col(c).isNotNull() for c in ORDERS.required]
    decoded = records.decode(raw, ORDERS.event)
    kept = decoded.filter(required[0] & required[1] & required[2] & ~F.isnan("amount"))
    assert kept.count() == valid


def test_clicks_are_classified_by_their_own_fields(spark):
    values = ['{"session_id":"s","user_id":"u","page":"/"}', '{"session_id":"s","user_id":"u"}']
    judged = records.classify(envelopes(spark, values), CLICKS)
    assert [r["reject_reason"] for r in judged.orderBy("key").collect()] == [None, "missing_page"]


def test_bad_time_keeps_the_row(spark):
    value = '{"order_id":"b","user_id":"u","amount":1,"timestamp":"bad"}'
    row = records.decode(envelopes(spark, [value]), ORDERS.event).first()
    assert row["event_timestamp"] is None and row["timestamp"] == "bad"


texts = st.text(
    st.characters(blacklist_categories=("Cs",), blacklist_characters="\x00"), max_size=12
)
rows = st.lists(
    st.tuples(
        texts, texts, texts, st.floats(allow_nan=False, allow_infinity=False, width=32),
        texts, st.none() | texts, texts, texts,
    ),
    min_size=1,
    max_size=8,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_decode_undoes_encode(spark, events):
    sent = orders(spark, events)
    names = ORDERS.event.fieldNames()
    back = records.decode(records.encode(sent, "order_id"), ORDERS.event, "t").select(*names)
    assert facts(back) == facts(sent)


@pytest.mark.parametrize("zone_text", ["2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00Z"])
def test_offsets_are_honoured(spark, zone_text):
    raw = envelopes(spark, [json.dumps({"order_id": "a", "timestamp": zone_text})])
    got = records.decode(raw, ORDERS.event).select(F.unix_seconds("event_timestamp")).first()[0]
    assert got == 1704067200


def test_topic_comes_from_the_record_unless_named(spark):
    raw = envelopes(spark, [GOOD], topic="from.record")
    assert records.decode(raw, ORDERS.event).first()["source_topic"] == "from.record"
    assert records.decode(raw, ORDERS.event, "named").first()["source_topic"] == "named"


def test_null_fields_are_left_out(spark):
    sent = records.encode(orders(spark, [order(status=None)]), "order_id").first()
    assert "status" not in json.loads(bytes(sent["value"]))
    assert bytes(sent["key"]) == b"o1"


def test_faults_are_counted_without_parsing_again(spark):
    raw = envelopes(spark, [GOOD, None, "{", GOOD])
    counted = records.fault_counts(records.decode_checked(raw, ORDERS))
    text = counted._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 2  # typed, and behind a condition as texts
    assert {tuple(r) for r in counted.collect()} == {("null_value", 1), ("malformed_json", 1)}
