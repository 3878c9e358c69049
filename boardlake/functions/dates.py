"""Date and timestamp expressions: parsing, display format, range predicates."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from boardlake.schemas import LAST_UPDATED_FORMAT

BOUNDS = ("closed_ts", "open_ts", "closed_date")


def parse_timestamp_text(col: Column | str) -> Column:
    """ISO-8601 text -> timestamp; unparseable text becomes null (never an error)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c)


def last_updated(col: Column | str, fmt: str = LAST_UPDATED_FORMAT) -> Column:
    """Display date of the last activity in the session time zone; null stays null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, fmt)


def utc_naive(value: _dt.datetime) -> _dt.datetime:
    """The same instant as a UTC time without zone; a time without zone is UTC already."""
    return value if value.tzinfo is None else value.astimezone(_dt.timezone.utc).replace(tzinfo=None)


def parse_date_arg(value: str | _dt.date | None, fmt: str = "%Y-%m-%d") -> _dt.date | None:
    """Parse a job argument on the driver; bad text raises at once.

    ``fmt`` is a Python ``strptime`` pattern: ``%Y-%m-%d`` for most jobs,
    ``%d-%m-%Y`` for the day-first variant.  A ``datetime`` gives its UTC date.
    """
    bound = parse_bound(value, fmt)
    return None if bound is None else bound.date()


def parse_bound(value: str | _dt.date | None, fmt: str = "%Y-%m-%d") -> _dt.datetime | None:
    """As :func:`parse_date_arg`, with the time of day: 00:00 for dates and text."""
    if value is None:
        return None
    if isinstance(value, _dt.datetime):
        return utc_naive(value)
    if isinstance(value, _dt.date):
        return _dt.datetime.combine(value, _dt.time())
    return _dt.datetime.strptime(value, fmt)


def _literal_like(dtype, value: _dt.datetime) -> Column:
    """A timestamp literal of the column's type so Parquet can push the predicate.

    A ``timestamp_ntz`` column compared with a session-zone literal would be
    wrapped in a cast and lose pushdown; the literal is cast instead.  String
    and date columns are compared as timestamps.
    """
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text).cast("timestamp_ntz" if isinstance(dtype, TimestampNTZType) else "timestamp")


def _as_timestamp(dtype, column: str) -> Column:
    if isinstance(dtype, (TimestampNTZType, TimestampType)):
        return F.col(column)
    return F.try_to_timestamp(F.col(column).cast("string"))


def range_condition(df: DataFrame, column: str, start, end, bounds: str = "closed_ts",
                    date_format: str = "%Y-%m-%d", tz: str | None = None) -> Column | None:
    """Predicate for :func:`range_filter`; None when a bound is missing."""
    if bounds not in BOUNDS:
        raise ValueError(f"bounds must be one of {BOUNDS}, got {bounds!r}")
    lo, hi = parse_bound(start, date_format), parse_bound(end, date_format)
    if lo is None or hi is None:
        return None
    dtype = df.schema[column].dataType
    ts = _as_timestamp(dtype, column)
    shifted = bool(tz) and tz.upper() != "UTC"
    if shifted:
        ts = F.from_utc_timestamp(ts, tz)
        if isinstance(dtype, TimestampNTZType):
            ts = ts.cast("timestamp_ntz")
    if bounds == "closed_ts":
        return (ts >= _literal_like(dtype, lo)) & (ts <= _literal_like(dtype, hi))
    if bounds == "open_ts":
        return (ts > _literal_like(dtype, lo)) & (ts < _literal_like(dtype, hi))
    first = _dt.datetime.combine(lo.date(), _dt.time())
    after = _dt.datetime.combine(hi.date(), _dt.time()) + _dt.timedelta(days=1)
    return (ts >= _literal_like(dtype, first)) & (ts < _literal_like(dtype, after))


def range_filter(df: DataFrame, column: str, start, end, bounds: str = "closed_ts",
                 date_format: str = "%Y-%m-%d", tz: str | None = None) -> DataFrame:
    """Keep rows whose ``column`` lies in the date range ``[start, end]``.

    Bound variants (a date or text bound is at 00:00; the ``_ts`` variants use
    the time of day of a ``datetime`` bound, in UTC if it has a zone):
      * ``closed_ts``   ``start <= ts <= end`` as timestamps: activity later on the
        end day falls outside.
      * ``open_ts``     ``start < ts < end``.
      * ``closed_date`` ``start <= to_date(ts) <= end``: the whole end day counts.
        Written as ``start <= ts < end + 1 day`` so it stays a pushable range.
    The filter is applied only when both bounds are given.  ``tz`` shifts
    the timestamp from UTC to that zone before any variant compares it
    (no-op for UTC).
    """
    cond = range_condition(df, column, start, end, bounds, date_format, tz)
    return df if cond is None else df.where(cond)


def idle_filter(df: DataFrame, column: str, days: int,
                as_of: _dt.datetime | None = None) -> DataFrame:
    """Rows whose last activity is strictly before ``as_of - days``; null drops.

    ``as_of`` defaults to the query's current timestamp; one with a zone is
    converted to UTC.
    """
    dtype = df.schema[column].dataType
    ts = _as_timestamp(dtype, column)
    if as_of is None:
        now = F.current_timestamp()
        if isinstance(dtype, TimestampNTZType):
            now = now.cast("timestamp_ntz")
        return df.where(ts < now - F.make_interval(days=F.lit(int(days))))
    if isinstance(as_of, _dt.date) and not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime.combine(as_of, _dt.time())
    cutoff = utc_naive(as_of) - _dt.timedelta(days=int(days))
    return df.where(ts < _literal_like(dtype, cutoff))


def board_date(name: Column | str) -> Column:
    """Sprint date encoded in a board name such as ``Sprint (14-Sept-2022)``.

    Steps: take the text inside the first parentheses; split on ``-``; the
    day is part 1, the month part 2 (must start with a three-letter English
    month name, any case), the year part 3, or the last four characters of
    the parenthesised text when there are only two parts.  Anything that
    does not resolve to a real date (no parentheses, no ``-``, unknown
    month, 31 February) gives null instead of failing the job.
    """
    c = F.col(name) if isinstance(name, str) else name
    inner = F.regexp_extract(c, r"\((.*?)\)", 1)
    parts = F.split(inner, "-")
    day = F.try_element_at(parts, F.lit(1))
    month = F.initcap(F.substring(F.try_element_at(parts, F.lit(2)), 1, 3))
    year = F.coalesce(F.try_element_at(parts, F.lit(3)), F.right(inner, F.lit(4)))
    text = F.concat_ws("-", day, month, year)
    parsed = F.try_to_date(text, "d-MMM-yyyy")
    return F.when(F.size(parts) >= 2, parsed)
