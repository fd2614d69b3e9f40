"""Time parsing, formatting and bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of an instant.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
ISO_WALL_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TRANSPORT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CLOCK_FORMAT = "HH:mm:ss"
MINUTE_CLOCK_FORMAT = "mm:ss"
NO_CLOCK = "--:--:--"
NO_BATCH = "\u2014"


def clock_now(as_of: Column | None = None) -> Column:
    """The processing time; a caller that needs repeatable output passes ``as_of``."""
    return F.current_timestamp() if as_of is None else as_of


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to timestamp; unreadable text gives null also under ANSI rules."""
    return F.try_to_timestamp(text)


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def iso_of_utc_wall(ts_ntz: Column) -> Column:
    """ISO text of a zone-less timestamp that is known to be in UTC."""
    return F.concat(F.date_format(ts_ntz, ISO_WALL_FORMAT), F.lit("+00:00"))


def transport(ts: Column) -> Column:
    return F.date_format(ts, TRANSPORT_FORMAT)


def clock(ts: Column, none: str = NO_CLOCK) -> Column:
    return F.coalesce(F.date_format(ts, CLOCK_FORMAT), F.lit(none))
