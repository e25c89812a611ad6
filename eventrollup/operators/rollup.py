"""Event counts per calendar bucket.

The multi-grain view is built bottom up:

1. raw rows -> (event, minute) counts.  Partial (map-side) aggregation runs
   before the shuffle, so the exchange carries at most one row per
   (event, minute) per input task, however hot one event or one minute is.
2. minute rows -> hours, again with a partial aggregate.
3. hour rows -> day, month and year with ``inline``, summed per
   (event, bucket, bdate).

Coarser grains are sums of finer ones, so no raw row is touched twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventrollup.functions.buckets import (
    GRAIN_CODES,
    bucket_start,
    bucket_start_from_fields,
    check_grain,
    expand_to_grains,
)

VIEW_COLUMNS = ("event", "bucket", "bdate", "count")


def minute_counts(events: DataFrame, ts: str = "ts") -> DataFrame:
    """(event, bdate, count) per minute; duplicates count.

    ``events`` carries either a timestamp column ``ts`` or the master
    dataset's calendar columns (year, month, day, hour, minute).
    """
    if ts in events.columns:
        minute = bucket_start("m", ts)
    else:
        minute = bucket_start_from_fields("m", "year", "month", "day", "hour", "minute")
    return (events.groupBy("event", minute.alias("bdate"))
            .agg(F.count(F.lit(1)).alias("count")))


def rollup(counts: DataFrame, code: str) -> DataFrame:
    """Sum finer (event, bdate, count) rows into grain ``code``."""
    return (counts.groupBy("event", bucket_start(check_grain(code), "bdate").alias("bdate"))
            .agg(F.sum("count").cast("bigint").alias("count")))


def cascade(events: DataFrame, ts: str = "ts") -> dict[str, DataFrame]:
    """The five grains as separate frames, each rolled up from the finer one."""
    out = {"m": minute_counts(events, ts)}
    finer = out["m"]
    for code in GRAIN_CODES[1:]:
        finer = out[code] = rollup(finer, code)
    return out


def expand_counts(counts: DataFrame, grains: Sequence[str] = GRAIN_CODES) -> DataFrame:
    """Minute rows -> (event, bucket, bdate, count) summed for each grain."""
    grains = tuple(check_grain(g) for g in grains)
    expanded = counts.select(
        "event", "count", F.inline(expand_to_grains("bdate", grains)))
    return (expanded.groupBy("event", "bucket", "bdate")
            .agg(F.sum("count").cast("bigint").alias("count")))


def multi_grain_view(events: DataFrame, grains: Sequence[str] = GRAIN_CODES,
                     ts: str = "ts") -> DataFrame:
    """The batch view: counts per event at every requested grain.

    Raw rows are shuffled once, as partial (event, minute) counts.  Minute rows
    are final after that and pass through; hours are summed from them, and the
    coarser grains from hours, so the later shuffles carry at most a row per
    minute, then a few rows per hour.  Both earlier shuffles are reused by the
    branches that read them, not run again.
    """
    grains = tuple(check_grain(g) for g in grains)
    minutes = minute_counts(events, ts)
    parts = [_tagged(minutes, "m")] if "m" in grains else []
    if set(grains) - {"m"}:
        hours = rollup(minutes, "H")
        if "H" in grains:
            parts.append(_tagged(hours, "H"))
        coarse = [g for g in grains if g not in ("m", "H")]
        if coarse:
            parts.append(expand_counts(hours, coarse).select(*VIEW_COLUMNS))
    return reduce(DataFrame.unionByName, parts)


def _tagged(counts: DataFrame, code: str) -> DataFrame:
    return counts.select("event", F.lit(code).alias("bucket"), "bdate", "count")


def complete_grains(view: DataFrame, stored: Sequence[str]) -> DataFrame:
    """Add the grains coarser than the coarsest stored one, rolled up from it.

    For totals only: the speed view keeps m and H, and its day, month and
    year sums are the sums of its hour rows, so a range can be tiled with
    few coarse keys instead of one key per hour.
    """
    top = max(stored, key=GRAIN_CODES.index)
    missing = GRAIN_CODES[GRAIN_CODES.index(top) + 1:]
    if not missing:
        return view.select(*VIEW_COLUMNS)
    base = view.where(F.col("bucket") == top).select("event", "bdate", "count")
    return view.select(*VIEW_COLUMNS).unionByName(expand_counts(base, missing).select(*VIEW_COLUMNS))


def event_types(view: DataFrame) -> DataFrame:
    """Distinct event names, kept as a DataFrame.

    From a view that stores buckets, the year rows (the fewest per event: on a
    stored view the filter prunes to their folder); from events, the scanned
    column itself.
    """
    rows = view.where(F.col("bucket") == "Y") if "bucket" in view.columns else view
    return rows.select("event").distinct()
