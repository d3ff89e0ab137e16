"""Date and time column expressions.

Time in the data model is text: ``yyyy-MM-dd`` dates, ``yyyy-MM-dd HH:mm:ss``
times, ``yyyyMMdd`` date keys and epoch-millisecond fields in log lines.  All
functions are built-ins, so they stay inside whole-stage codegen.  Parsing is
lenient (bad text -> null), matching a parser that reports failure instead of
throwing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the data model.
DATE_FMT = "yyyy-MM-dd"
TIME_FMT = "yyyy-MM-dd HH:mm:ss"
DATEKEY_FMT = "yyyyMMdd"
MINUTE_FMT = "yyyyMMddHHmm"
DATE_HOUR_FMT = "yyyy-MM-dd_HH"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> timestamp; null on bad input."""
    return F.try_to_timestamp(_col(c), F.lit(TIME_FMT))


def parse_date_key(c) -> Column:
    """``yyyyMMdd`` text -> date; null on bad input."""
    return F.try_to_timestamp(_col(c), F.lit(DATEKEY_FMT)).cast("date")


def format_date(ts) -> Column:
    return F.date_format(_col(ts), DATE_FMT)


def format_time(ts) -> Column:
    return F.date_format(_col(ts), TIME_FMT)


def format_date_key(ts) -> Column:
    return F.date_format(_col(ts), DATEKEY_FMT)


def format_time_minute(ts) -> Column:
    return F.date_format(_col(ts), MINUTE_FMT)


def date_hour(action_time) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> ``yyyy-MM-dd_HH`` (text manipulation, no parse)."""
    c = _col(action_time)
    return F.concat(F.substring(c, 1, 10), F.lit("_"), F.substring(c, 12, 2))


def before(a, b) -> Column:
    """time a < time b; false when either is unparsable."""
    return F.coalesce(parse_time(a) < parse_time(b), F.lit(False))


def after(a, b) -> Column:
    return F.coalesce(parse_time(a) > parse_time(b), F.lit(False))


def minus_seconds(a, b) -> Column:
    """Seconds from b to a; 0 when either is unparsable."""
    return F.coalesce(F.unix_seconds(parse_time(a)) - F.unix_seconds(parse_time(b)), F.lit(0).cast("long"))


def epoch_ms_to_ts(c) -> Column:
    return F.timestamp_millis(_col(c).cast("long"))


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return F.try_to_date(as_of)
    return F.lit(as_of).cast("date")


def today(as_of=None) -> Column:
    """The as-of date (text or column; ``current_date`` when not given) as ``yyyy-MM-dd``."""
    return F.date_format(_as_of(as_of), DATE_FMT)


def yesterday(as_of=None) -> Column:
    """The day before the as-of date as ``yyyy-MM-dd``."""
    return F.date_format(F.date_sub(_as_of(as_of), 1), DATE_FMT)
