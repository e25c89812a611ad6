"""Calendar grains and bucket arithmetic as built-in Spark column expressions.

A bucket is the pair (bucket code, bucket start ``bdate``).  Starts are
TIMESTAMP_NTZ values rebuilt from calendar fields, so they do not depend on
the session time zone; ends add one calendar unit (months and years vary).
No UDF is involved, so the expressions stay inside whole-stage codegen and
literal bounds on ``bdate`` still reach the Parquet reader.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The grain codes, their ids and names, finest to coarsest.
#   m = minute (1), H = hour (2), D = day (3), M = month (4), Y = year (5)
GRAIN_CODES: tuple[str, ...] = ("m", "H", "D", "M", "Y")
GRAIN_IDS = {"m": 1, "H": 2, "D": 3, "M": 4, "Y": 5}
GRAIN_NAMES = {"m": "minute", "H": "hour", "D": "day", "M": "month", "Y": "year"}
GRAIN_UNITS = {"m": "MINUTE", "H": "HOUR", "D": "DAY", "M": "MONTH", "Y": "YEAR"}

# Chains used by the range cover (coarse grains are tried first).
ALL_LEVELS: tuple[str, ...] = ("Y", "M", "D", "H", "m")
# The grain list sorted as text, which is the order the reference walks.
REFERENCE_LEVELS: tuple[str, ...] = tuple(sorted(GRAIN_CODES))  # D, H, M, Y, m
SPEED_GRAINS: tuple[str, ...] = ("m", "H")


def check_grain(code: str) -> str:
    """Grain code lookup; an unknown code fails before any job runs."""
    if code not in GRAIN_IDS:
        raise ValueError(f"unknown bucket code {code!r}; expected one of {GRAIN_CODES}")
    return code


def check_levels(levels: Iterable[str]) -> tuple[str, ...]:
    out = tuple(check_grain(c) for c in levels)
    if not out:
        raise ValueError("at least one bucket code is needed")
    return out


def is_coarser(a: str, b: str) -> bool:
    return GRAIN_IDS[a] > GRAIN_IDS[b]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- calendar fields (P1-P6) -------------------------------------------------

def calendar_columns(ts: str | Column) -> dict[str, Column]:
    t = _col(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "minute": F.minute(t),
    }


# --- bucket starts (P8, P10, P11, C1, U1) -------------------------------------

def bucket_start_from_fields(code: str, year: Column | str, month: Column | str | None = None,
                             day: Column | str | None = None, hour: Column | str | None = None,
                             minute: Column | str | None = None) -> Column:
    """Bucket start from calendar fields; fields below the grain default to 1/1 00:00."""
    check_grain(code)
    one, zero = F.lit(1), F.lit(0)
    rank = GRAIN_IDS[code]
    y = _col(year)
    mo = _col(month) if rank <= 4 and month is not None else one
    d = _col(day) if rank <= 3 and day is not None else one
    h = _col(hour) if rank <= 2 and hour is not None else zero
    mi = _col(minute) if rank <= 1 and minute is not None else zero
    return F.make_timestamp_ntz(y, mo, d, h, mi, zero)


def bucket_start(code: str, ts: str | Column) -> Column:
    """Floor a timestamp to the start of its bucket, as TIMESTAMP_NTZ."""
    t = _col(ts)
    rank = GRAIN_IDS[check_grain(code)]
    return bucket_start_from_fields(
        code,
        F.year(t),
        F.month(t) if rank <= 4 else None,
        F.dayofmonth(t) if rank <= 3 else None,
        F.hour(t) if rank <= 2 else None,
        F.minute(t) if rank <= 1 else None,
    )


def bucket_end(code: str, bdate: str | Column) -> Column:
    """Exclusive end of the bucket starting at ``bdate`` (calendar aware, P12)."""
    unit = GRAIN_UNITS[check_grain(code)]
    return F.timestamp_add(unit, F.lit(1), _col(bdate))


def bucket_ceil(code: str, ts: str | Column) -> Column:
    """Start of the first bucket that begins at or after ``ts``."""
    t = _col(ts)
    floor = bucket_start(code, t)
    return F.when(floor == t, floor).otherwise(bucket_end(code, floor))


def _by_code(bucket: str | Column, make) -> Column:
    b = _col(bucket)
    expr = None
    for code in GRAIN_CODES:
        branch = make(code)
        expr = F.when(b == code, branch) if expr is None else expr.when(b == code, branch)
    return expr


def bucket_end_for(bucket: str | Column, bdate: str | Column) -> Column:
    """Bucket end when the grain is a column rather than a constant."""
    return _by_code(bucket, lambda code: bucket_end(code, bdate))


def bucket_start_for(bucket: str | Column, ts: str | Column) -> Column:
    """Bucket start when the grain is a column (also re-floors stored rows, D1)."""
    return _by_code(bucket, lambda code: bucket_start(code, ts))


def grain_name_for(bucket: str | Column) -> Column:
    return _by_code(bucket, lambda code: F.lit(GRAIN_NAMES[code]))


def bucket_code_for(grain: str | Column) -> Column:
    g = _col(grain)
    expr = None
    for code in GRAIN_CODES:
        name = GRAIN_NAMES[code]
        expr = F.when(g == name, F.lit(code)) if expr is None else expr.when(g == name, F.lit(code))
    return expr


# --- tagging (P7, P9) ---------------------------------------------------------

def tag(df: DataFrame, code: str) -> DataFrame:
    """Add the grain code and the bucket start rebuilt from the calendar columns
    the frame carries; fields below the grain may be absent."""
    cols = {c: c for c in ("year", "month", "day", "hour", "minute") if c in df.columns}
    start = bucket_start_from_fields(code, cols["year"], cols.get("month"), cols.get("day"), cols.get("hour"), cols.get("minute"))
    return df.withColumn("bucket", F.lit(check_grain(code))).withColumn("bdate", start)


def expand_to_grains(bdate: str | Column, grains: Sequence[str]) -> Column:
    """Array of (bucket, bdate) structs, one per grain, for ``inline``."""
    return F.array(*[
        F.struct(F.lit(check_grain(g)).alias("bucket"), bucket_start(g, bdate).alias("bdate"))
        for g in grains
    ])
