"""Small literal inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierflow.contracts import CLICKS, ENVELOPE, ORDERS
from tierflow.sources.feeds import landed


def order(order_id="o1", user_id="u1", product="p", amount=1.0, currency="USD", status="paid",
          ip="0.0.0.0", timestamp="2024-01-01T00:00:00.000000+00:00"):
    return (order_id, user_id, product, amount, currency, status, ip, timestamp)


def click(session_id="s1", user_id="u1", page="/", action="view", device="mobile", ip="0.0.0.0",
          timestamp="2024-01-01T00:00:00.000000+00:00"):
    return (session_id, user_id, page, action, device, ip, timestamp)


def at(minute, second=0):
    return f"2024-01-01T00:{minute:02d}:{second:02d}.000000+00:00"


def orders(spark, rows):
    return spark.createDataFrame(rows, ORDERS.event)


def bronze_orders(spark, rows):
    return landed(orders(spark, rows), ORDERS)


def bronze_clicks(spark, rows):
    return landed(spark.createDataFrame(rows, CLICKS.event), CLICKS)


def envelopes(spark, values, topic="raw.orders"):
    rows = [
        (f"k{i}".encode(), None if v is None else v.encode(), topic, 0, i)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, ENVELOPE)


def facts(df, drop=("ingestion_timestamp", "processed_at")):
    """Rows as a sorted list, without clock columns."""
    kept = df.select(*sorted(c for c in df.columns if c not in drop))
    return sorted((tuple(r) for r in kept.collect()), key=str)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def never(df):
    return df.filter(F.lit(False))
