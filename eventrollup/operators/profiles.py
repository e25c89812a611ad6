"""Edge profiles: cumulative counts of a grain's buckets inside their parent.

For grain g with parent p (minute in hour, hour in day, day in month, month
in year) one row per (event, g, parent bucket) holds ``cum`` with
``cum[k]`` = total of the g buckets with index < k inside that parent.  Any
run of whole g buckets inside one parent is then ``cum[j] - cum[i]``: one
lookup instead of one row per bucket.  The profile is a fixed-width row of
conditional sums, so no group is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrollup.functions.buckets import bucket_start, check_grain

# The parent grain and the number of child slots per parent.
PARENT = {"m": "H", "H": "D", "D": "M", "M": "Y"}
SLOTS = {"m": 60, "H": 24, "D": 31, "M": 12}


def index_in_parent(code: str, t: Column) -> Column:
    """0-based position of the ``code`` bucket holding ``t`` inside its parent."""
    check_grain(code)
    if code == "m":
        return F.minute(t)
    if code == "H":
        return F.hour(t)
    if code == "D":
        return F.dayofmonth(t) - 1
    if code == "M":
        return F.month(t) - 1
    raise ValueError(f"grain {code!r} has no parent")


def _by_bucket(make) -> Column:
    expr = None
    for code in PARENT:
        b = F.col("bucket") == code
        expr = F.when(b, make(code)) if expr is None else expr.when(b, make(code))
    return expr


def edge_profiles(view: DataFrame, grains: Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """(event, bucket, parent, cum) for the given child grains of a roll-up view.

    ``cum[k]`` is a conditional sum, ``sum(count) where index < k``, for
    k = 0 .. the largest slot count: one hash aggregate with fixed-width
    buffers, partial before its shuffle and inside whole-stage codegen (no
    list of cells is collected per group).  Grains with fewer slots simply
    repeat their total past their last slot; lookups never index there.

    ``wanted`` holds the keys (event, bucket, parent) that will be looked up: only
    their cells enter the aggregate (a semi join, which AQE broadcasts while the
    keys are few), so its input follows the requests and not the view.
    """
    grains = [g for g in grains if g in PARENT]
    width = max(SLOTS[g] for g in grains)
    cells = (view.where(F.col("bucket").isin(grains))
             .select("event", "bucket",
                     _by_bucket(lambda g: bucket_start(PARENT[g], F.col("bdate"))).alias("parent"),
                     _by_bucket(lambda g: index_in_parent(g, F.col("bdate"))).alias("i"),
                     F.col("count").cast("bigint").alias("c")))
    if wanted is not None:
        cells = cells.join(wanted, ["event", "bucket", "parent"], "left_semi")
    zero = F.lit(0).cast("bigint")
    sums = [F.sum(F.when(F.col("i") < k, F.col("c")).otherwise(zero)).alias(f"_cum{k}")
            for k in range(1, width + 1)]
    grouped = cells.groupBy("event", "bucket", "parent").agg(*sums)
    cum = F.array(zero, *[F.col(f"_cum{k}") for k in range(1, width + 1)])
    return grouped.select("event", "bucket", "parent", cum.alias("cum"))


def top_profiles(view: DataFrame, code: str) -> DataFrame:
    """Single-slot profiles of the coarsest grain: (event, bucket, parent=bdate, [0, count]).

    Lets a top bucket be looked up like an edge run (``i0=0, i1=1``), so a
    range needs one join against ``top_profiles`` + ``edge_profiles``.
    """
    rows = view.where(F.col("bucket") == check_grain(code))
    return rows.select("event", "bucket", F.col("bdate").alias("parent"),
                       F.array(F.lit(0).cast("bigint"), F.col("count").cast("bigint")).alias("cum"))

