"""The first non-empty bucket of a range, for a whole table of ranges (J1 in X5).

The default cut between batch and speed rows is the first stored speed bucket in
the cover of the range.  ``successors`` is an index over the stored buckets, by
calendar level: one row per (event, level, parent bucket) with ``next[i]`` = the
earliest stored bucket whose place inside that parent is i or later.

    m  parent hour    earliest minute
    H  parent day     earliest hour
    D  parent month   earliest hour from day i on
    M  parent year    earliest hour from month i on
    Y  one row per year: earliest hour of any later year

A cover is minutes up to the first whole hour, whole hours, then minutes again,
so its first bucket is found by at most six keyed lookups: one at each edge, and
"from here on" at each level for the hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventrollup.functions.buckets import bucket_ceil, bucket_start
from eventrollup.operators.profiles import PARENT, SLOTS, index_in_parent

_LEVELS = ("H", "D", "M")          # levels that hold hours


def _wide(cells: DataFrame, width: int) -> DataFrame:
    """(event, bucket, parent, i, t) -> next[k] = min(t where i >= k): one hash
    aggregate with fixed-width buffers, partial before its shuffle."""
    least = [F.min(F.when(F.col("i") >= k, F.col("t"))).alias(f"_n{k}") for k in range(width)]
    grouped = cells.groupBy("event", "bucket", "parent").agg(*least)
    return grouped.select("event", "bucket", "parent", F.array(*[F.col(f"_n{k}") for k in range(width)]).alias("next"))


def successors(view: DataFrame, years: tuple[int, int]) -> DataFrame:
    """The index of a view that stores minutes and hours: (event, bucket, parent,
    next).  ``years`` are the first and last year that ranges begin in."""
    t = F.col("bdate")
    minutes = view.where(F.col("bucket") == "m").select(
        "event", "bucket", bucket_start("H", t).alias("parent"), index_in_parent("m", t).alias("i"), t.alias("t"))
    stored = view.where(F.col("bucket") == "H")
    hours = stored.select("event", t.alias("t"), F.inline(F.array(*[
        F.struct(F.lit(g).alias("bucket"), bucket_start(PARENT[g], t).alias("parent"), index_in_parent(g, t).alias("i"))
        for g in _LEVELS]))).select("event", "bucket", "parent", "i", "t")
    # A year's first hour answers for every earlier year that is asked.
    first = stored.groupBy("event", F.year(t).alias("year")).agg(F.min(t).alias("t"))
    low, high = F.lit(years[0]), F.least(F.lit(years[1]), F.col("year") - 1)
    later = first.where(low <= high).select("event", "t", F.explode(F.sequence(low, high)).alias("year")) \
        .groupBy("event", "year").agg(F.min("t").alias("t"))
    one = F.lit(1)
    return _wide(minutes, SLOTS["m"]).unionByName(_wide(hours, SLOTS["D"])).unionByName(later.select(
        "event", F.lit("Y").alias("bucket"),
        F.make_timestamp_ntz("year", one, one, F.lit(0), F.lit(0), F.lit(0)).alias("parent"), F.array("t").alias("next")))


def _slots(minute: Column, hour: Column, last: Column, hi: Column) -> Column:
    """The lookups of one range: (part, bucket, parent, i), part a, b or c."""

    def slot(part: str, code: str, parent: Column, i: Column, ok: Column) -> Column:
        return F.when(ok, F.struct(F.lit(part).alias("part"), F.lit(code).alias("bucket"), parent.alias("parent"), i.cast("int").alias("i")))

    whole = hour < last
    return F.array(
        # Minutes before the first whole hour; if the range has none, all of them.
        slot("a", "m", bucket_start("H", minute), F.minute(minute), (minute < hour) & (minute < hi)),
        # Whole hours: in the same day, else later in the month, the year, ever.
        slot("b", "H", bucket_start("D", hour), F.hour(hour), whole),
        slot("b", "D", bucket_start("M", hour), F.dayofmonth(hour), whole),
        slot("b", "M", bucket_start("Y", hour), F.month(hour), whole),
        slot("b", "Y", bucket_start("Y", hour), F.lit(0), whole),
        # Minutes behind the last whole hour.
        slot("c", "m", last, F.lit(0), (hour <= last) & (last < hi)))


def first_buckets(requests: DataFrame, view: DataFrame, columns: list[str], years: tuple[int, int],
                  lo: str = "_lo", hi: str = "_hi") -> DataFrame:
    """Requests (``columns``, event, lo, hi among them) with ``_cut``: the start of
    the first stored bucket in the cover of [lo, hi) by hours and minutes, or null.

    The request rows cross two shuffles, six rows each: the lookup join, which
    AQE splits where a key is hot, and the minimum per request.
    """
    # The calendar bounds are columns, evaluated once; plain arrays stay in codegen.
    bounds = [bucket_ceil("m", F.col(lo)).alias("_minute"), bucket_ceil("H", F.col(lo)).alias("_hour"), bucket_start("H", F.col(hi)).alias("_last")]
    slots = _slots(F.col("_minute"), F.col("_hour"), F.col("_last"), F.col(hi))
    # The first slot stays also where it is null: every range keeps a row.
    keyed = requests.select(*columns, *bounds).select(*columns, F.posexplode(slots).alias("pos", "k")) \
        .where(F.col("k").isNotNull() | (F.col("pos") == 0)).select(*columns, "k.part", "k.bucket", "k.parent", "k.i")
    found = keyed.join(successors(view, years), ["event", "bucket", "parent"], "left") \
        .select(*columns, "part", F.get("next", F.col("i")).alias("t"))
    inside = F.when(F.col("part") == "b", F.col("t") < bucket_start("H", F.col(hi))) \
        .otherwise(F.col("t") < bucket_start("m", F.col(hi)))
    # Parts follow each other in time, so the earliest bucket is the first.
    return found.groupBy(*columns).agg(F.min(F.when(inside, F.col("t"))).alias("_cut"))
