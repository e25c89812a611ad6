"""Time ranges: bounds, validity checks, containment and partition bounds.

A range is half-open ``[left, right)``.  Bounds may be Python values (a query
with literal bounds) or columns (a table of requests); literal bounds become
TIMESTAMP_NTZ literals so that Catalyst folds them and pushes them into the
Parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventrollup.functions.buckets import bucket_end, bucket_start


def parse_instant(value) -> _dt.datetime:
    """ISO text (``2015-12-25T11:00``, ``2015-12-25 11:00:00``) to a naive datetime."""
    if isinstance(value, _dt.datetime):
        return value.replace(tzinfo=None) if value.tzinfo is None else \
            value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day)
    text = str(value).strip()
    if text.endswith("Z"):
        text = text[:-1] + "+00:00"
    parsed = _dt.datetime.fromisoformat(text)
    if parsed.tzinfo is not None:
        parsed = parsed.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return parsed


def check_range(left, right) -> tuple[_dt.datetime, _dt.datetime]:
    """Parse both bounds; ``right`` before ``left`` is an error."""
    lo, hi = parse_instant(left), parse_instant(right)
    if hi < lo:
        raise ValueError(f"invalid range: {hi} is before {lo}")
    return lo, hi


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal (foldable, so it pushes down as a scan filter)."""
    ts = parse_instant(value)
    return F.expr(f"TIMESTAMP_NTZ '{ts.isoformat(sep=' ')}'")


def as_bound(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str) and not value[:4].isdigit():
        return F.col(value)
    return ts_literal(value)


def try_parse_timestamp(text: str | Column) -> Column:
    """Text to TIMESTAMP_NTZ, null when it does not parse (no ANSI error)."""
    t = F.col(text) if isinstance(text, str) else text
    return t.try_cast("timestamp_ntz")


# --- epoch seconds ---------------------------------------------------------------

# Fixed value: where epoch seconds begin.
EPOCH = _dt.datetime(1970, 1, 1)


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ, whatever the session's zone.

    Stored beside the timestamp because the Parquet reader skips row groups and
    pages by the statistics of a long, but not by those of a TIMESTAMP_NTZ, although
    the plan lists such a filter as pushed.
    """
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("SECOND", ts_literal(EPOCH), t)


def epoch_bound(value) -> Column:
    """The first whole second at or after a bound: for a column ``s`` of whole
    seconds, ``s >= epoch_bound(b)`` is ``ts >= b`` and ``s < epoch_bound(b)`` is
    ``ts < b``.  A literal bound is a literal here."""
    if isinstance(value, Column):
        floor = epoch_seconds(value)
        return F.when(F.timestamp_add("SECOND", floor, ts_literal(EPOCH)) < value, floor + 1).otherwise(floor)
    span = parse_instant(value) - EPOCH
    return F.lit(span.days * 86400 + span.seconds + (1 if span.microseconds else 0)).cast("bigint")


# --- range predicates over columns (P19-P24) ---------------------------------

def range_is_empty(left, right) -> Column:
    return as_bound(left) == as_bound(right)


def range_is_valid(left, right) -> Column:
    return as_bound(right) >= as_bound(left)


def range_length_ms(left, right) -> Column:
    return F.timestamp_diff("MILLISECOND", as_bound(left), as_bound(right))


def range_starts_with(left, other_left) -> Column:
    return as_bound(left) == as_bound(other_left)


def range_ends_with(right, other_right) -> Column:
    return as_bound(right) == as_bound(other_right)


def range_is_wider(left, right, other_left, other_right) -> Column:
    return range_length_ms(left, right) > range_length_ms(other_left, other_right)


# --- containment (P15) --------------------------------------------------------

def contained(code: str, bdate: str | Column, left, right) -> Column:
    """Bucket of grain ``code`` starting at ``bdate`` lies wholly in [left, right).

    The first two terms are simple comparisons on ``bdate`` that reach the
    Parquet reader; the end test is the residual.
    """
    b = F.col(bdate) if isinstance(bdate, str) else bdate
    lo, hi = as_bound(left), as_bound(right)
    return (b >= lo) & (b < hi) & (bucket_end(code, b) <= hi)


def enclosing_contained(code: str, bdate: str | Column, left, right) -> Column:
    """The ``code`` bucket that encloses ``bdate`` lies wholly in [left, right)."""
    b = F.col(bdate) if isinstance(bdate, str) else bdate
    start = bucket_start(code, b)
    lo, hi = as_bound(left), as_bound(right)
    return (start >= lo) & (bucket_end(code, start) <= hi)


# --- partition bounds for the master dataset (X1) ----------------------------

def partition_bounds(left=None, right=None, year="year", month="month", day="day") -> Column:
    """Predicate on year/month/day partition columns for rows with ts in [left, right).

    Spark does not derive partition filters from a ``ts`` predicate, so a
    scan of the day-partitioned master dataset adds this next to it.
    """
    part_day = F.make_date(F.col(year), F.col(month), F.col(day))
    cond = F.lit(True)
    if left is not None:
        cond = cond & (part_day >= F.to_date(as_bound(left)))
    if right is not None:
        cond = cond & (part_day <= F.to_date(as_bound(right)))
    return cond
