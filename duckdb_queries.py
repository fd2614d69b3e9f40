"""The registered queries as plain SQL over the same tables, for an independent engine."""

from __future__ import annotations

ORDER_LINES = """
    SELECT l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR AS order_id,
           l_suppkey::VARCHAR AS user_id,
           l_partkey::VARCHAR AS product,
           l_extendedprice AS amount,
           'USD' AS currency,
           CASE l_returnflag WHEN 'A' THEN 'delivered' WHEN 'R' THEN 'cancelled' END AS status,
           '0.0.0.0' AS ip,
           strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
           l_shipdate::TIMESTAMP AS event_timestamp
    FROM lineitem"""

PURCHASES = """
    SELECT event_id::VARCHAR AS order_id,
           user_id::VARCHAR AS user_id,
           'k' || json_extract_string(props, '$.k') AS product,
           value AS amount,
           'USD' AS currency,
           'paid' AS status,
           '0.0.0.0' AS ip,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
           ts::TIMESTAMP AS event_timestamp
    FROM events WHERE event_type = 'purchase'"""

CLICKS = """
    SELECT user_id::VARCHAR || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
           user_id::VARCHAR AS user_id,
           '/p/' || json_extract_string(props, '$.k') AS page,
           event_type AS action,
           CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device,
           '0.0.0.0' AS ip,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
           ts::TIMESTAMP AS event_timestamp
    FROM events WHERE event_type <> 'purchase'"""

ORDER_RANK = """event_timestamp DESC NULLS LAST, amount DESC NULLS LAST,
        product DESC NULLS LAST, user_id DESC NULLS LAST, currency DESC NULLS LAST,
        status DESC NULLS LAST, ip DESC NULLS LAST, "timestamp" DESC NULLS LAST"""
ORDER_FIELDS = 'order_id, user_id, product, amount, currency, status, ip, "timestamp"'
CLICK_FIELDS = 'session_id, user_id, page, action, device, ip, "timestamp"'
AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"


def _typed(source: str) -> str:
    return (
        f"SELECT order_id, user_id, product, amount, currency, coalesce(status, 'unknown') AS "
        f'status, ip, "timestamp", event_timestamp FROM ({source}) '
        "WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND amount IS NOT NULL"
    )


def _latest(source: str) -> str:
    return (
        f"SELECT * FROM ({source}) QUALIFY row_number() OVER "
        f"(PARTITION BY order_id ORDER BY {ORDER_RANK}) = 1"
    )


def _silver(source: str) -> str:
    return _latest(_typed(source))


SILVER_LINES = _silver(ORDER_LINES)
SILVER_PURCHASES = _silver(PURCHASES)

MIXED = f"""
    SELECT order_id AS kafka_key, 'accepted' AS verdict FROM ({ORDER_LINES})
    UNION ALL SELECT order_id, 'accepted' FROM ({PURCHASES})
    UNION ALL SELECT session_id, 'missing_order_id' FROM ({CLICKS})
    UNION ALL SELECT 'part-' || p_partkey::VARCHAR, 'missing_user_id' FROM part
    UNION ALL SELECT 'supplier-' || s_suppkey::VARCHAR, 'missing_amount' FROM supplier
    UNION ALL SELECT 'customer-' || c_custkey::VARCHAR, 'bad_amount' FROM customer
    UNION ALL SELECT 'order-' || o_orderkey::VARCHAR, 'bad_timestamp' FROM orders
    UNION ALL SELECT 'talk-' || conv_id::VARCHAR || '-' || turn::VARCHAR, 'malformed_json'
              FROM conversations
    UNION ALL SELECT 'nation-' || n_nationkey::VARCHAR, 'null_value' FROM nation"""


# The text lengths of faulty records, from the JSON that each table's rows make.
MIXED_LENGTHS = f"""
    SELECT session_id AS kafka_key, 'missing_order_id' AS verdict,
           length('{{"session_id":"","user_id":"","page":"","action":"","device":"","ip":"",'
                  || '"timestamp":""}}')
           + length(session_id || user_id || page || action || device || ip || "timestamp")
           AS text_length
    FROM ({CLICKS})
    UNION ALL SELECT 'part-' || p_partkey::VARCHAR, 'missing_user_id',
           length('{{"order_id":"part-","amount":}}')
           + length(p_partkey::VARCHAR || p_retailprice::VARCHAR) FROM part
    UNION ALL SELECT 'supplier-' || s_suppkey::VARCHAR, 'missing_amount',
           length('{{"order_id":"supplier-","user_id":""}}')
           + length(s_suppkey::VARCHAR || s_name) FROM supplier
    UNION ALL SELECT 'customer-' || c_custkey::VARCHAR, 'bad_amount',
           length('{{"order_id":"customer-","user_id":"","amount":""}}')
           + length(c_custkey::VARCHAR || c_name || c_mktsegment) FROM customer
    UNION ALL SELECT 'talk-' || conv_id::VARCHAR || '-' || turn::VARCHAR, 'malformed_json',
           length("text") FROM conversations
    UNION ALL SELECT 'nation-' || n_nationkey::VARCHAR, 'null_value', NULL FROM nation"""


def _cents(column: str = "amount") -> str:
    return f"CAST(sum(CAST(round({column} * 100) AS BIGINT)) AS BIGINT)"


def _revenue_per_product(silver: str) -> str:
    return f"""
    SELECT product, s / 100.0::DOUBLE AS total_revenue, n AS order_count,
           ((2 * s + n) // (2 * n)) / 100.0::DOUBLE AS avg_order_value
    FROM (SELECT product, {_cents()} AS s, count(*) AS n FROM ({silver}) GROUP BY product)"""


def _orders_by_status(silver: str) -> str:
    return f"SELECT status, count(*) AS order_count FROM ({silver}) GROUP BY status"


def _revenue_per_minute(silver: str) -> str:
    return (
        f"SELECT date_trunc('minute', event_timestamp)::TIMESTAMP AS minute, "
        f"{_cents()} / 100.0::DOUBLE AS revenue FROM ({silver}) GROUP BY 1"
    )


def _count_by(key: str, name: str, source: str) -> str:
    return f"SELECT {key}, count(*) AS {name} FROM ({source}) GROUP BY {key}"


TOP_PAGES = f"{_count_by('page', 'views', CLICKS)} ORDER BY views DESC, page LIMIT 10"
REVENUE_PER_PRODUCT = _revenue_per_product(SILVER_LINES)


def _two_decimals(cents: str) -> str:
    """Cents as the nearest double, by way of their text."""
    return f"(({cents} // 100)::VARCHAR || '.' || lpad(({cents} % 100)::VARCHAR, 2, '0'))::DOUBLE"


# Every amount as the decimal that it is written as, in units of 1e-8. Of very large amounts
# the small ones beside them do not reach the double nearest to the sum.
ANY_SIZE = f"""
    WITH o AS (SELECT o_orderpriority AS product, floor(o_totalprice)::BIGINT AS whole, o_custkey AS k FROM orders),
    g AS (SELECT product, sum(whole)::HUGEINT AS s, sum(k)::HUGEINT AS t, count(*) AS n FROM o GROUP BY product),
    p AS (SELECT * FROM (VALUES (' huge', 290), (' large', 18)) AS v(name, e))
    SELECT product || name AS product, (s::VARCHAR || 'e' || e)::DOUBLE AS total_revenue, 2 * n AS order_count,
           ((s * 100000000000000000000::HUGEINT // (2 * n))::VARCHAR || 'e' || (e - 20))::DOUBLE AS avg_order_value
    FROM g, p
    UNION ALL
    SELECT product || ' tiny', {_two_decimals("((2 * t + 10000000) // 20000000)")}, n,
           {_two_decimals("((2 * t + 10000000 * n) // (20000000 * n))")}
    FROM g
    UNION ALL
    SELECT product, {_two_decimals("((2 * s + 1000000) // 2000000)")} AS total_revenue,
           n AS order_count,
           {_two_decimals("((2 * s + 1000000 * n) // (2000000 * n))")} AS avg_order_value
    FROM (SELECT product, count(*) AS n,
                 sum(replace(amount::VARCHAR::DECIMAL(38,8)::VARCHAR, '.', '')::HUGEINT)::HUGEINT AS s
          FROM (SELECT o_orderpriority AS product, o_totalprice AS amount FROM orders
                UNION ALL SELECT o_orderpriority, o_totalprice * 1e7::DOUBLE FROM orders
                UNION ALL SELECT o_orderpriority, o_custkey / 1e8::DOUBLE FROM orders)
          GROUP BY product)"""


def _json_object(pairs: list[tuple[str, str]], numbers: tuple[str, ...] = ()) -> str:
    parts = []
    for name, value in pairs:
        shown = f"CAST({value} AS VARCHAR)"
        quoted = shown if name in numbers else f"'\"' || {shown} || '\"'"
        parts.append(f"'\"{name}\":' || {quoted}")
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_SHOWN_TIME = "strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f')"


def _summaries(seconds: int) -> str:
    def of(source: str, topic: str, key: str, fields: str) -> str:
        names = [f.strip().strip('"') for f in fields.split(",")]
        pairs = [(n, f'"{n}"') for n in names] + [
            ("kafka_key", key), ("source_topic", f"'{topic}'"), ("event_timestamp", _SHOWN_TIME),
        ]
        return f"""
        SELECT 'batch' AS type, batch_id, '{topic}' AS topic, count(*) AS records,
               strftime(max(event_timestamp), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
               max(event_timestamp) AS at_ts,
               '[' || string_agg(js, ',' ORDER BY rn) FILTER (rn <= 3) || ']' AS sample
        FROM (SELECT *, {_json_object(pairs, ('amount',))} AS js,
                     row_number() OVER (PARTITION BY batch_id ORDER BY event_timestamp, {key}) AS rn
              FROM (SELECT *, epoch_us(event_timestamp) // 1000000 // {seconds} AS batch_id
                    FROM ({source})))
        GROUP BY batch_id"""

    return (
        of(PURCHASES, "raw.orders", "order_id", ORDER_FIELDS)
        + "\n UNION ALL "
        + of(CLICKS, "raw.clicks", "session_id", CLICK_FIELDS)
    )


SUMMARIES = _summaries(6 * 3600)
MINUTE_SUMMARIES = _summaries(60)

RATES = f"""
    SELECT date_trunc('second', at_ts) AS t,
           sum(CASE WHEN topic = 'raw.orders' THEN records ELSE 0 END)::BIGINT AS orders,
           sum(CASE WHEN topic = 'raw.clicks' THEN records ELSE 0 END)::BIGINT AS clicks
    FROM ({MINUTE_SUMMARIES}) GROUP BY 1"""

SPLIT_DAY = "TIMESTAMP '1998-07-01'"
CHANGED_LINES = ORDER_LINES.replace(
    "FROM lineitem",
    "FROM (SELECT * REPLACE (l_shipdate + CASE WHEN l_linestatus = 'O' THEN INTERVAL 1 DAY "
    "ELSE INTERVAL (-1) DAY END AS l_shipdate) FROM lineitem)",
)
CHANGED_SILVER = _silver(
    f"SELECT * REPLACE ('cancelled' AS status) FROM ({CHANGED_LINES})"
)
NEWEST = (
    f"SELECT {ORDER_FIELDS}, event_timestamp FROM "
    f"({_latest(f'SELECT * FROM ({SILVER_LINES}) UNION ALL SELECT * FROM ({CHANGED_SILVER})')})"
)

LINE_BATCH = """(event_timestamp >= TIMESTAMP '1997-01-01')::INT
    + (event_timestamp >= TIMESTAMP '1999-01-01')::INT
    + (event_timestamp >= TIMESTAMP '2001-01-01')::INT"""


def _step(step: str, counted: str, taken: str | None = None) -> str:
    """A step's line; ``taken`` is what a cleaning step reads."""
    rows = f"(SELECT count(*) FROM ({counted}))"
    account = "NULL::BIGINT AS rows_in, NULL::BIGINT AS dropped_null, NULL::BIGINT AS dropped_dup, NULL::BIGINT AS passed"
    if taken:
        required = "order_id IS NULL OR user_id IS NULL OR amount IS NULL"
        if "session_id" in taken:
            required = "session_id IS NULL OR user_id IS NULL OR page IS NULL"
        n = f"(SELECT count(*) FROM ({taken}))"
        null = f"(SELECT count(*) FROM ({taken}) WHERE {required})"
        account = (
            f"{n} AS rows_in, {null} AS dropped_null, {n} - {null} - {rows} AS dropped_dup, "
            f"{rows} AS passed"
        )
    return f"SELECT 1 AS cycle, '{step}' AS step, 'ok' AS status, {rows} AS rows, {account}"


def _catalog(marts: dict[str, str]) -> str:
    lines = [
        f"SELECT '{name}' AS \"table\", 1 AS valid, (SELECT count(*) FROM ({sql})) AS rows"
        for name, sql in marts.items()
    ]
    return "\n UNION ALL ".join([*lines, "SELECT 'scratch', 0, NULL"])


GOLD = {
    "orders_revenue_per_product": REVENUE_PER_PRODUCT,
    "orders_by_status": _orders_by_status(SILVER_LINES),
    "orders_revenue_per_minute": _revenue_per_minute(SILVER_LINES),
    "clicks_top_pages": TOP_PAGES,
    "clicks_top_actions": _count_by("action", "events", CLICKS),
    "clicks_events_per_device": _count_by("device", "events", CLICKS),
}

CYCLE = "\n UNION ALL ".join(
    [
        _step("silver_orders", SILVER_LINES, ORDER_LINES),
        _step("silver_clicks", CLICKS, CLICKS),
        *[_step(f"gold_{name}", sql) for name, sql in GOLD.items()],
    ]
)


def oracle_sql() -> dict[str, str]:
    silver_rows = f"SELECT {ORDER_FIELDS}, event_timestamp FROM ({SILVER_LINES})"
    found = {
        "envelope_roundtrip": f"""
            SELECT order_id AS kafka_key, {ORDER_FIELDS} FROM ({ORDER_LINES})
            UNION ALL SELECT order_id, {ORDER_FIELDS} FROM ({PURCHASES})""",
        "decode_orders": f"""
            SELECT {ORDER_FIELDS}, order_id AS kafka_key, 'raw.orders' AS source_topic,
                   {AS_OF} AS ingestion_timestamp, event_timestamp FROM ({ORDER_LINES})""",
        "decode_clicks": f"""
            SELECT {CLICK_FIELDS}, session_id AS kafka_key, 'raw.clicks' AS source_topic,
                   {AS_OF} AS ingestion_timestamp, event_timestamp FROM ({CLICKS})""",
        "quarantine_orders": f"""
            SELECT kafka_key, verdict,
                   (verdict NOT IN ('accepted', 'bad_timestamp'))::INT AS excluded
            FROM ({MIXED})""",
        "fault_counts": f"""
            SELECT verdict AS reject_reason, count(*) AS records FROM ({MIXED})
            WHERE verdict <> 'accepted' GROUP BY 1""",
        "clean_orders": silver_rows,
        "clean_clicks": f"SELECT {CLICK_FIELDS}, event_timestamp FROM ({CLICKS})",
        "silver_audit": f"""
            SELECT 'clean_orders' AS step, n AS rows_in, k AS rows_out,
                   n - v AS dropped_null, v - k AS dropped_dup
            FROM (SELECT count(*) AS n,
                         count(*) FILTER (verdict IN ('accepted', 'bad_timestamp')) AS v,
                         count(DISTINCT kafka_key)
                           FILTER (verdict IN ('accepted', 'bad_timestamp')) AS k
                  FROM ({MIXED}))
            UNION ALL
            SELECT 'clean_clicks', 2 * n, n, 0, n FROM (SELECT count(*) AS n FROM ({CLICKS}))""",
        "revenue_per_product": REVENUE_PER_PRODUCT,
        "orders_by_status": _orders_by_status(SILVER_LINES),
        "revenue_of_any_size": ANY_SIZE,
        "revenue_per_minute": _revenue_per_minute(SILVER_PURCHASES),
        "top_pages": TOP_PAGES,
        "top_actions": _count_by("action", "events", CLICKS),
        "events_per_device": _count_by("device", "events", CLICKS),
        "status_share": f"""
            SELECT status, count(*) AS order_count,
                   count(*) / (sum(count(*)) OVER ())::DOUBLE AS share
            FROM ({SILVER_LINES}) GROUP BY status""",
        "top_products": f"""
            SELECT product, total_revenue FROM ({REVENUE_PER_PRODUCT})
            ORDER BY total_revenue DESC, product LIMIT 6""",
        "batch_summaries": f"SELECT * EXCLUDE (at_ts) FROM ({SUMMARIES})",
        "topic_totals": f"""
            SELECT replace(topic, 'raw.', '') AS kind, sum(records)::BIGINT AS records
            FROM ({SUMMARIES}) GROUP BY 1
            UNION ALL SELECT 'total', sum(records)::BIGINT FROM ({SUMMARIES})""",
        "stream_stats": f"""
            SELECT sum(records)::BIGINT AS total_events, max("timestamp") AS last_batch_at
            FROM ({SUMMARIES})""",
        "throughput_per_second": f"""
            SELECT t, strftime(t, '%M:%S') AS "time", orders, clicks FROM ({RATES})
            WHERE t >= (SELECT max(t) FROM ({RATES})) - INTERVAL 86400 SECOND""",
        "current_rate": f"""
            SELECT coalesce(arg_max(orders + clicks, t), 0) AS records_per_second
            FROM ({RATES})""",
        "dashboard_header": f"""
            SELECT sum(orders + clicks)::BIGINT AS total_events,
                   arg_max(orders + clicks, t)::BIGINT AS records_per_second,
                   strftime(max(t), '%H:%M:%S') AS last_batch,
                   sum(orders)::BIGINT AS orders, sum(clicks)::BIGINT AS clicks
            FROM ({RATES})""",
        "summary_contract": f"""
            SELECT 'accepted' AS verdict,
                   (SELECT count(*) FROM ({SUMMARIES})) + (SELECT count(*) FROM orders)
                     + (SELECT count(*) FROM benchmark) AS messages,
                   ((SELECT sum(records) FROM ({SUMMARIES})) + (SELECT sum(o_custkey) FROM orders)
                     + (SELECT 5 * count(*) FROM benchmark))::BIGINT AS records,
                   (SELECT sum(least(records, 3)) FROM ({SUMMARIES}))::BIGINT AS samples
            UNION ALL SELECT 'malformed_json', count(*), NULL, 0 FROM conversations
            UNION ALL SELECT 'missing_batch_id', count(*), NULL, 0 FROM part
            UNION ALL SELECT 'missing_topic', count(*), NULL, 0 FROM supplier
            UNION ALL SELECT 'bad_records', count(*), NULL, 0 FROM orders
            UNION ALL SELECT 'bad_topic', count(*), 5 * count(*), 0 FROM nation
            UNION ALL SELECT 'bad_timestamp', count(*), 5 * count(*), 0 FROM region
            UNION ALL SELECT 'bad_type', count(*), 5 * count(*), 0 FROM supplier
            UNION ALL SELECT 'bad_sample', (SELECT count(*) FROM customer) + (SELECT count(*) FROM part),
                   5 * ((SELECT count(*) FROM customer) + (SELECT count(*) FROM part)),
                   2 * (SELECT count(*) FROM part)""",
        "live_feed": f"""
            SELECT batch_id::VARCHAR || '-' || topic || '-' || (epoch_us(at_ts) // 1000)::VARCHAR AS id,
                   topic, replace(topic, 'raw.', '') AS kind, batch_id, records, "timestamp",
                   strftime(at_ts, '%H:%M:%S') AS clock, sample
            FROM ({SUMMARIES}) ORDER BY at_ts DESC, topic, batch_id DESC LIMIT 50""",
        "replay_buffer": f"""
            SELECT * EXCLUDE (at_ts) FROM ({SUMMARIES})
            ORDER BY at_ts DESC, topic, batch_id DESC LIMIT 100""",
        "layer_summary": f"""
            SELECT 'bronze' AS layer, 2 * o AS orders, c AS clicks, 2 * o + c AS total
            FROM (SELECT (SELECT count(*) FROM lineitem) AS o,
                         (SELECT count(*) FROM ({CLICKS})) AS c)
            UNION ALL
            SELECT 'silver', o, c, o + c
            FROM (SELECT (SELECT count(*) FROM ({SILVER_LINES})) AS o,
                         (SELECT count(*) FROM ({CLICKS})) AS c)""",
        "silver_upsert": f"""
            WITH u AS ({_silver(f'SELECT * FROM ({ORDER_LINES}) WHERE event_timestamp >= {SPLIT_DAY}')}),
                 t AS ({_silver(f'SELECT * FROM ({ORDER_LINES}) WHERE event_timestamp < {SPLIT_DAY}')})
            SELECT {ORDER_FIELDS}, event_timestamp FROM u
            UNION ALL
            SELECT {ORDER_FIELDS}, event_timestamp FROM t
            WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.order_id = t.order_id)""",
        "silver_upsert_clicks": f"""
            WITH u AS (SELECT * REPLACE ('10.0.0.1' AS ip) FROM ({CLICKS})
                       WHERE event_timestamp >= TIMESTAMP '2024-01-11'),
                 t AS (SELECT * FROM ({CLICKS}) WHERE event_timestamp < TIMESTAMP '2024-01-16')
            SELECT {CLICK_FIELDS}, event_timestamp FROM u
            UNION ALL
            SELECT {CLICK_FIELDS}, event_timestamp FROM t
            WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.session_id = t.session_id
                              AND u.event_timestamp = t.event_timestamp AND u.action = t.action)""",
        "silver_upsert_newest": NEWEST,
        "silver_upsert_newest_narrow": NEWEST,
        "bronze_schema_merge": f"""
            SELECT 0::BIGINT AS batch_id, order_id, amount, NULL::VARCHAR AS channel
            FROM ({ORDER_LINES})
            UNION ALL
            SELECT 1, order_id, amount, 'c-' || product FROM ({PURCHASES})""",
        "compact_bronze": f"""
            SELECT ({LINE_BATCH})::BIGINT AS batch_id, {ORDER_FIELDS}, event_timestamp
            FROM ({ORDER_LINES})""",
        "incremental_silver": silver_rows,
        "incremental_silver_parts": silver_rows,
        "silver_rebuild": silver_rows,
        "refresh_cycle": CYCLE,
        "gold_catalog": _catalog(GOLD),
        "pack_summaries": f"SELECT * EXCLUDE (at_ts, batch_id) FROM ({SUMMARIES})",
        "load_marts_orders": f"""
            SELECT 'orders_revenue_per_product' AS mart, product AS "key",
                   total_revenue AS measure FROM ({REVENUE_PER_PRODUCT})
            UNION ALL
            SELECT 'orders_by_status', status, order_count::DOUBLE
            FROM ({_orders_by_status(SILVER_LINES)})
            UNION ALL
            SELECT 'orders_revenue_per_minute', minute::VARCHAR, revenue
            FROM ({_revenue_per_minute(SILVER_LINES)})""",
        "load_marts_clicks": f"""
            SELECT 'clicks_top_pages' AS mart, page AS "key", views::DOUBLE AS measure
            FROM ({TOP_PAGES})
            UNION ALL
            SELECT 'clicks_top_actions', action, events::DOUBLE
            FROM ({_count_by('action', 'events', CLICKS)})
            UNION ALL
            SELECT 'clicks_events_per_device', device, events::DOUBLE
            FROM ({_count_by('device', 'events', CLICKS)})""",
        "stream_ingest_bronze": f"""
            SELECT 'raw.orders' AS source_topic, order_id AS kafka_key, user_id, "timestamp",
                   event_timestamp FROM ({ORDER_LINES})
            UNION ALL
            SELECT 'raw.clicks', session_id, user_id, "timestamp", event_timestamp
            FROM ({CLICKS})""",
        "stream_quarantine": f"""
            SELECT kafka_key, verdict AS reject_reason, text_length FROM ({MIXED_LENGTHS})
            WHERE verdict NOT IN ('accepted', 'bad_timestamp')""",
        "stream_summary_log": f"""
            SELECT 'orders' AS kind, count(*) AS records FROM ({ORDER_LINES})
            UNION ALL SELECT 'clicks', count(*) FROM ({CLICKS})
            UNION ALL SELECT 'total', (SELECT count(*) FROM ({ORDER_LINES}))
                                    + (SELECT count(*) FROM ({CLICKS}))""",
        "stream_revenue_per_minute": _revenue_per_minute(
            f"SELECT event_timestamp, amount FROM ({SILVER_PURCHASES}) "
            "UNION ALL SELECT NULL::TIMESTAMP, o_totalprice FROM orders"
        ),
        "stream_dedup": f"""
            SELECT {CLICK_FIELDS}, event_timestamp FROM ({CLICKS})
            UNION ALL
            SELECT DISTINCT 'customer-' || o_custkey::VARCHAR, o_custkey::VARCHAR,
                   '/' || o_orderstatus, o_orderstatus, NULL, NULL, 'unreadable', NULL::TIMESTAMP
            FROM orders""",
    }
    found["running_totals"] = found["topic_totals"]
    found["running_header"] = found["dashboard_header"]
    found["marts_by_change"] = (
        f"SELECT *, 'by change' AS made FROM ({found['load_marts_orders']} UNION ALL {found['load_marts_clicks']})"
    )
    return found
