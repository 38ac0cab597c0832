"""Time expressions. ``as_of`` replaces every notion of "now"."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

Moment = datetime | date | str

# Fixed formats of the inbound time texts.
HOUR_PATTERN = "yyyy-MM-dd'T'HH"
MINUTE_PATTERN = "yyyy-MM-dd'T'HH:mm"
MINUTE_Z_PATTERN = "yyyy-MM-dd'T'HH:mm'Z'"
ISO_SECOND_PATTERN = "yyyy-MM-dd'T'HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_datetime(moment: Moment) -> datetime:
    """Naive UTC datetime of any accepted way to state a moment."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment.replace("Z", "+00:00"))
    elif not isinstance(moment, datetime):
        moment = datetime(moment.year, moment.month, moment.day)
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def instant(moment: Moment) -> Column:
    """Zone-free literal.

    Compared with either timestamp type it folds to a constant of the column's
    own type, so a range predicate still reaches the Parquet scan.
    """
    return F.lit(as_datetime(moment).isoformat(sep=" ")).cast("timestamp_ntz")


def stamp(moment: Moment) -> Column:
    """Literal for audit columns."""
    return instant(moment).cast("timestamp")


def width(text: str) -> Column:
    """Interval literal such as ``width("30 minutes")``."""
    return F.expr(f"INTERVAL '{text}'")


def newer_than(ts: Column | str, span: str, as_of: Moment) -> Column:
    """Strict trailing range: after ``as_of - span``; no upper bound."""
    return _col(ts) > instant(as_of) - width(span)


def time_bin(ts: Column | str, span: str) -> Column:
    """Start of the epoch-aligned bin. Rows without a time belong to no bin."""
    return F.window(_col(ts), span)["start"]


def parse_hour(text: Column | str) -> Column:
    return F.try_to_timestamp(_col(text), F.lit(HOUR_PATTERN))


def parse_minute(text: Column | str) -> Column:
    return F.try_to_timestamp(_col(text), F.lit(MINUTE_PATTERN))


def parse_minute_z(text: Column | str) -> Column:
    return F.try_to_timestamp(_col(text), F.lit(MINUTE_Z_PATTERN))


def parse_event_time(text: Column | str) -> Column:
    """Events carry full ISO text with an offset, or the short minute form."""
    return F.coalesce(_col(text).try_cast("timestamp"), parse_minute_z(text))


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def minutes_between(later: Column | str, earlier: Column | str) -> Column:
    return seconds_between(_col(later), _col(earlier)) / F.lit(60)


def date_key(day: Column | str) -> Column:
    d = _col(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def sunday_week(day: Column | str) -> Column:
    """Week number where week 1 holds January 1 and weeks start on Sunday."""
    d = _col(day)
    offset = F.dayofweek(F.trunc(d, "YEAR")) - 2
    return (F.floor((F.dayofyear(d) + offset) / F.lit(7)) + 1).cast("int")
