"""Topic names to display kinds, with the defaults for missing fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ORDERS_KIND = "orders"
CLICKS_KIND = "clicks"
OTHER_KIND = "other"
NO_TOPIC = "unknown"


def topic_or_unknown(topic: Column) -> Column:
    return F.coalesce(F.nullif(topic, F.lit("")), F.lit(NO_TOPIC))


def kind_of(topic: Column) -> Column:
    name = topic_or_unknown(topic)
    return (
        F.when(name.contains(ORDERS_KIND), ORDERS_KIND)
        .when(name.contains(CLICKS_KIND), CLICKS_KIND)
        .otherwise(OTHER_KIND)
    )


def records_or_zero(records: Column) -> Column:
    return F.coalesce(records, F.lit(0)).cast("bigint")
