"""The six Gold marts and two reports over them.

Each mart is one aggregation with partial results before the shuffle, so a hot
product or page sends one row per task. Every sort ends with the group key: equal
measures come out in a fixed order.

Every mart but for its order and limit is made of sums, kept as :class:`Sums`: those of one
part of Silver can be added to those of another, and rows can be taken back, so that a
stored mart follows changed rows without reading the others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.contracts import CLICKS, ORDERS
from tierflow.functions import money


@dataclass(frozen=True)
class Sums:
    """Partial sums of a mart by ``key``. ``of`` takes rows, and the name of a column with 1 or -1
    if some are to be taken back; ``add`` makes one line of each group's lines; ``mart``
    gives the mart's rows from such lines. ``reads`` are the columns of Silver that it needs."""

    key: str
    reads: tuple[str, ...]
    schema: str
    of: Callable[[DataFrame, str | None], DataFrame]
    add: Callable[[DataFrame], DataFrame]
    mart: Callable[[DataFrame], DataFrame]


def _counts(key: str, name: str) -> Sums:
    def of(rows: DataFrame, sign: str | None = None) -> DataFrame:
        n = F.count(F.lit(1)) if sign is None else F.sum(sign).cast("long")
        return rows.groupBy(key).agg(n.alias(name))

    def add(lines: DataFrame) -> DataFrame:
        return lines.groupBy(key).agg(F.sum(name).alias(name)).where(F.col(name) != 0)

    return Sums(key, (key,), f"{key} string, {name} bigint", of, add, lambda lines: lines)


def _revenue(
    key: str, kind: str, reads: tuple[str, ...], keyed: Callable[[DataFrame], DataFrame], names: tuple[str, ...]
) -> Sums:
    def of(rows: DataFrame, sign: str | None = None) -> DataFrame:
        return money.partial_sums(keyed(rows), [key], "amount", sign)

    return Sums(
        key,
        reads,
        f"{key} {kind}, {money.PARTIAL_SCHEMA}",
        of,
        lambda lines: money.merged(lines, [key]),
        lambda lines: money.totals(lines, [key], *names),
    )


def _by_minute(orders: DataFrame) -> DataFrame:
    return orders.withColumn("minute", F.date_trunc("minute", "event_timestamp"))


SUMS: dict[str, Sums] = {
    "orders_revenue_per_product": _revenue(
        "product", "string", ("product", "amount"), lambda orders: orders,
        ("total_revenue", "order_count", "avg_order_value"),
    ),
    "orders_by_status": _counts("status", "order_count"),
    "orders_revenue_per_minute": _revenue(
        "minute", "timestamp", ("event_timestamp", "amount"), _by_minute, ("revenue",)
    ),
    "clicks_top_pages": _counts("page", "views"),
    "clicks_top_actions": _counts("action", "events"),
    "clicks_events_per_device": _counts("device", "events"),
}


def _made(mart: str, rows: DataFrame) -> DataFrame:
    sums = SUMS[mart]
    return sums.mart(sums.of(rows.select(*sums.reads), None))


def _ranked(df: DataFrame, measure: str, key: str, ordered: bool = True) -> DataFrame:
    return df if not ordered else df.orderBy(F.col(measure).desc(), F.col(key).asc_nulls_first())


def revenue_per_product(orders: DataFrame, ordered: bool = True) -> DataFrame:
    return _ranked(_made("orders_revenue_per_product", orders), "total_revenue", "product", ordered)


def orders_by_status(orders: DataFrame, ordered: bool = True) -> DataFrame:
    return _ranked(_made("orders_by_status", orders), "order_count", "status", ordered)


def revenue_per_minute(orders: DataFrame, ordered: bool = True) -> DataFrame:
    """Orders without a readable event time share the null minute."""
    mart = _made("orders_revenue_per_minute", orders)
    return mart.orderBy("minute") if ordered else mart


def top_pages(clicks: DataFrame, limit: int = 10, ordered: bool = True) -> DataFrame:
    """The rows are picked by rank either way; ``ordered`` has no further cost here."""
    return most_viewed(_made("clicks_top_pages", clicks), limit)


def most_viewed(views: DataFrame, limit: int = 10) -> DataFrame:
    """The first pages of all pages' views."""
    return _ranked(views, "views", "page").limit(limit)


def top_actions(clicks: DataFrame, ordered: bool = True) -> DataFrame:
    return _ranked(_made("clicks_top_actions", clicks), "events", "action", ordered)


def events_per_device(clicks: DataFrame, ordered: bool = True) -> DataFrame:
    return _ranked(_made("clicks_events_per_device", clicks), "events", "device", ordered)


def status_share(orders: DataFrame) -> DataFrame:
    """Each status with its part of all orders.

    The total is a scalar subquery over the same counts; Spark reuses their exchange.
    """
    counts = _made("orders_by_status", orders)
    total = counts.agg(F.sum("order_count")).scalar()
    shares = counts.withColumn("share", F.col("order_count") / total)
    return _ranked(shares, "order_count", "status")


def top_products(revenue: DataFrame, limit: int = 6) -> DataFrame:
    """The chart's cut of ``revenue_per_product``; sorts again, as files carry no order."""
    return _ranked(revenue.select("product", "total_revenue"), "total_revenue", "product").limit(
        limit
    )


# Each takes Silver and ``ordered``: False leaves out the sort.
MARTS: dict[str, dict[str, Callable[..., DataFrame]]] = {
    ORDERS.name: {
        "orders_revenue_per_product": revenue_per_product,
        "orders_by_status": orders_by_status,
        "orders_revenue_per_minute": revenue_per_minute,
    },
    CLICKS.name: {
        "clicks_top_pages": top_pages,
        "clicks_top_actions": top_actions,
        "clicks_events_per_device": events_per_device,
    },
}

# How a stored mart is put back in order: (column, descending).
MART_ORDER: dict[str, list[tuple[str, bool]]] = {
    "orders_revenue_per_product": [("total_revenue", True), ("product", False)],
    "orders_by_status": [("order_count", True), ("status", False)],
    "orders_revenue_per_minute": [("minute", False)],
    "clicks_top_pages": [("views", True), ("page", False)],
    "clicks_top_actions": [("events", True), ("action", False)],
    "clicks_events_per_device": [("events", True), ("device", False)],
}


def in_mart_order(mart: str, df: DataFrame) -> DataFrame:
    return df.orderBy(
        *[
            F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first()
            for c, down in MART_ORDER[mart]
        ]
    )
