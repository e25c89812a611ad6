"""Serving queries over the batch and speed views.

Every query is one lazy plan over two views with the columns
``event, bucket, bdate, count``:

* the batch view holds any of the five grains, recomputed in full by the
  batch job;
* the speed view holds minute and hour partials summed per key.

Speed rows win from the first speed bucket of the cover on (per event), as
in the reference (``cutover="first_speed_bucket"``).  If that bucket is an
hour the stream saw only in part, the batch rows of the other part are lost;
``cutover="horizon"`` takes an explicit batch horizon instead and is exact
when the batch is complete before it and the stream after it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventrollup.functions.buckets import (
    ALL_LEVELS,
    GRAIN_CODES,
    REFERENCE_LEVELS,
    SPEED_GRAINS,
    check_grain,
    check_levels,
)
from eventrollup.functions.ranges import as_bound, check_range, epoch_bound, parse_instant, range_is_valid, ts_literal
from eventrollup.operators.profiles import edge_profiles, top_profiles
from eventrollup.operators.rollup import complete_grains
from eventrollup.plans.cover import (
    bounds_from_columns,
    cover_bounds,
    cover_predicate,
    effective_levels,
    lookup_slots,
    slot_count,
    top_step,
)
from eventrollup.plans.successor import first_buckets

CUT_FIRST_SPEED = "first_speed_bucket"
CUT_HORIZON = "horizon"
# Response date format.
DATE_FORMAT = "yyyy-MM-dd HH:mm"

VIEW_COLUMNS = ("event", "bucket", "bdate", "count")


def _events_list(events) -> list[str] | None:
    if events is None:
        return None
    if isinstance(events, str):
        return [events]
    return list(events)


def _restrict(view: DataFrame | None, events, lo=None, hi=None) -> DataFrame | None:
    """The view's four columns for the wanted events.  A view read with its
    year folder and epoch second (``period``, ``at``) is first pruned to those of
    [lo, hi)."""
    if view is None:
        return None
    names = _events_list(events)
    if lo is not None and "period" in view.columns:
        view = view.where((F.col("period") >= lo.year) & (F.col("period") <= hi.year))
    if lo is not None and "at" in view.columns:
        view = view.where((F.col("at") >= epoch_bound(lo)) & (F.col("at") < epoch_bound(hi)))
    view = view.select(*VIEW_COLUMNS)
    return view if names is None else view.where(F.col("event").isin(names))


def _chain(levels: Sequence[str], stored: Sequence[str]) -> tuple[str, ...]:
    """Grains of ``levels`` that the view stores, as the walk would meet them."""
    kept = tuple(g for g in check_levels(levels) if g in stored)
    return effective_levels(kept) if kept else ()


def view_cover(view: DataFrame, left, right, levels: Sequence[str] = REFERENCE_LEVELS,
               stored: Sequence[str] = GRAIN_CODES, events=None) -> DataFrame:
    """Cover rows of one view (Q0 over a single view, J3/J4 subsumed)."""
    lo, hi = check_range(left, right)
    chain = _chain(levels, stored)
    view = _restrict(view, events, lo, hi)
    if not chain:
        return view.limit(0)
    return view.where(cover_predicate(chain, lo, hi))


def merged_cover(batch: DataFrame, speed: DataFrame | None, left, right,
                 levels: Sequence[str] = REFERENCE_LEVELS, events=None,
                 cutover: str = CUT_FIRST_SPEED, horizon=None,
                 batch_grains: Sequence[str] = GRAIN_CODES,
                 speed_grains: Sequence[str] = SPEED_GRAINS) -> DataFrame:
    """Cover rows of batch and speed views together.

    Batch rows then speed rows (UNION ALL); sort by (event, bdate) for the
    reference's order, as all batch rows end before the first speed row.
    """
    lo, hi = check_range(left, right)
    b_chain = _chain(levels, batch_grains)
    s_chain = _chain(levels, speed_grains)
    batch = _restrict(batch, events, lo, hi)
    speed = _restrict(speed, events, lo, hi)

    if speed is None or not s_chain:
        return view_cover(batch, lo, hi, b_chain) if b_chain else batch.limit(0)

    if cutover == CUT_HORIZON:
        if horizon is None:
            raise ValueError("horizon cut-over needs a horizon")
        h = parse_instant(horizon)
        b_hi, s_lo = min(hi, max(lo, h)), max(lo, min(hi, h))
        parts = [batch.where(cover_predicate(b_chain, lo, b_hi)) if b_chain else batch.limit(0),
                 speed.where(cover_predicate(s_chain, s_lo, hi))]
        return parts[0].unionByName(parts[1])
    if cutover != CUT_FIRST_SPEED:
        raise ValueError(f"unknown cutover {cutover!r}")

    speed_cover = speed.where(cover_predicate(s_chain, lo, hi))
    if not b_chain:
        return speed_cover
    # One row per event: the start of its first speed bucket.  Computed inside
    # the query each time (a new micro-batch moves it); AQE broadcasts it if
    # the finished stage is small, else the join stays a shuffle join.
    cut = speed_cover.groupBy("event").agg(F.min("bdate").alias("_cut"))
    lo_lit, hi_lit = ts_literal(lo), ts_literal(hi)
    candidates = batch.where((F.col("bdate") >= lo_lit) & (F.col("bdate") < hi_lit)
                             & F.col("bucket").isin(list(b_chain)))
    joined = candidates.join(cut, "event", "left")
    batch_cover = (joined.where(cover_predicate(b_chain, lo_lit, F.coalesce(F.col("_cut"), hi_lit)))
                   .select(*VIEW_COLUMNS))
    return batch_cover.unionByName(speed_cover)


def _requested(spark: SparkSession, names: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField("pos", T.IntegerType()),
                           T.StructField("event", T.StringType())])
    return spark.createDataFrame(list(enumerate(names)), schema)


def _all_events(batch: DataFrame, speed: DataFrame | None,
                batch_grains: Sequence[str] = GRAIN_CODES,
                speed_grains: Sequence[str] = SPEED_GRAINS) -> DataFrame:
    """Every event with data in either view, read from each view's coarsest
    grain (one row per event and period: the smallest folder to scan)."""
    top = max(batch_grains, key=lambda g: GRAIN_CODES.index(g))
    names = batch.where(F.col("bucket") == top).select("event")
    if speed is not None:
        s_top = max(speed_grains, key=lambda g: GRAIN_CODES.index(g))
        names = names.unionByName(speed.where(F.col("bucket") == s_top).select("event"))
    return names.distinct()


def count_by_period(batch: DataFrame, speed: DataFrame | None, left, right, event=None,
                    levels: Sequence[str] = REFERENCE_LEVELS, **merge) -> DataFrame:
    """Total count in [left, right) per event (Q1, A11): (event, from, to, result).

    ``event`` = one name, a list, or None for every event present in the
    views.  Events without rows in the cover get 0.
    """
    lo, hi = check_range(left, right)
    cover = merged_cover(batch, speed, lo, hi, levels, events=event, **merge)
    totals = cover.groupBy("event").agg(F.sum("count").alias("_total"))
    names = _events_list(event)
    if names is None:
        wanted = _all_events(batch, speed, merge.get("batch_grains", GRAIN_CODES),
                             merge.get("speed_grains", SPEED_GRAINS))
    else:
        wanted = _requested(batch.sparkSession, names).select("event").distinct()
    return (wanted.join(totals, "event", "left")
            .select("event",
                    F.lit(lo.isoformat(sep=" ")).alias("from"),
                    F.lit(hi.isoformat(sep=" ")).alias("to"),
                    F.coalesce(F.col("_total"), F.lit(0)).cast("bigint").alias("result")))


def shape_rows(rows: DataFrame) -> DataFrame:
    """Response rows: event, bucket code, start as yyyy-MM-dd HH:mm, count."""
    return rows.select("event", "bucket", "bdate",
                       F.date_format("bdate", DATE_FORMAT).alias("date"),
                       F.col("count").cast("bigint").alias("count"))


def timeseries(batch: DataFrame, speed: DataFrame | None, left, right, bucket: str,
               event=None, **merge) -> DataFrame:
    """One grain only, whole buckets only, no zero rows, ordered by start (Q2)."""
    code = check_grain(bucket)
    rows = merged_cover(batch, speed, left, right, (code,), events=event, **merge)
    return shape_rows(rows).orderBy("event", "bdate")


def get_events(batch: DataFrame, speed: DataFrame | None, left, right, event=None,
               levels: Sequence[str] = REFERENCE_LEVELS, catalogue=None,
               **merge) -> DataFrame:
    """The cover rows themselves (Q3); an empty ``event`` means every
    catalogue event (Q4, J5, C5).

    ``catalogue``: a list of names, a one-column DataFrame of names, or None
    for all events present.
    """
    if event is None or (isinstance(event, str) and event.strip() == ""):
        names = None
        if catalogue is not None:
            if isinstance(catalogue, DataFrame):
                cat = catalogue.select("event")
            else:
                cat = _requested(batch.sparkSession, list(catalogue)).select("event")
            batch = batch.join(cat, "event", "left_semi")
            speed = None if speed is None else speed.join(cat, "event", "left_semi")
    else:
        names = _events_list(event)
    rows = merged_cover(batch, speed, left, right, levels, events=names, **merge)
    return shape_rows(rows).orderBy("event", "bdate")


def split_event_list(text: str | Column) -> Column:
    """``"a, b ,c"`` -> array of (pos, event) structs, names trimmed, order kept (C4)."""
    t = F.lit(text) if isinstance(text, str) else text
    return F.posexplode(F.transform(F.split(t, ","), lambda x: F.trim(x)))


def compare_events(batch: DataFrame, speed: DataFrame | None, events_text: str, left, right,
                   levels: Sequence[str] = REFERENCE_LEVELS, **merge) -> DataFrame:
    """Total per listed event, unknown events 0, in list order."""
    spark = batch.sparkSession
    wanted = spark.range(1).select(split_event_list(events_text)).toDF("pos", "event")
    names = [s.strip() for s in events_text.split(",")]
    totals = count_by_period(batch, speed, left, right, event=names, levels=levels, **merge)
    return (wanted.join(totals.select("event", "result"), "event", "left")
            .select("pos", "event", F.coalesce(F.col("result"), F.lit(0)).cast("bigint").alias("count"))
            .orderBy("pos"))


def count_many_ranges(requests: DataFrame, batch: DataFrame, speed: DataFrame | None = None,
                      id_col: str = "request_id", event_col: str = "event",
                      from_col: str = "from_ts", to_col: str = "to_ts",
                      levels: Sequence[str] = ALL_LEVELS, horizon=None,
                      narrow: bool = False) -> DataFrame:
    """Totals for a whole table of (id, event, from, to) requests.

    The cover of each request is split into the whole buckets of the
    coarsest grain and at most two edge runs per finer grain.  Each piece is
    one lookup (bucket, parent, i0, i1) into a profile table holding, per
    (event, grain, parent bucket), the cumulative counts of the child
    buckets; a top bucket is a one-slot profile of itself.  With a speed view
    and ``horizon`` each request is split between the two views (exact
    mode), and the pieces of both sides are tagged and looked up in the same
    table.  So the request rows go through two shuffles in all, one equi-join
    on (event, side, bucket, parent) and one sum per request, about ten rows
    per request whatever the range: no range join, and no pairing of a
    request with all rows of its event.  ``narrow`` is for few requests against a
    large view: the distinct keys of the pieces first reduce both views to the
    parents that are asked for (a semi join below the profiles), at the price of
    reading the requests once more per view.  The pieces come from fixed slot
    arrays (no higher-order functions), so the request side runs in one
    whole-stage-codegen stage.  A hot lookup key is split by AQE's skew
    join; the profile side is broadcast only when AQE has measured it below
    its threshold.  Invalid requests (to < from) get a null count.

    Every request row gives one result row, also where ids are null or rows
    repeat.  The years that the requests span (one small aggregate of the
    request table) prune the ``period`` folders of both views, if they were
    read with them.

    With a speed view and no ``horizon`` each request has the cut of
    ``count_by_period``: the first speed bucket of its own cover, found by keyed
    lookups in an index of the speed view (``successor``).
    """
    req_cols = ["_row", "_id", "event", "_lo", "_hi"]
    req = requests.select(F.monotonically_increasing_id().alias("_row"),
                          F.col(id_col).alias("_id"), F.col(event_col).alias("event"),
                          F.col(from_col).alias("_lo"), F.col(to_col).alias("_hi"))
    own_cut = speed is not None and horizon is None
    if own_cut or any("period" in v.columns for v in (batch, speed) if v is not None):
        first, last = req.agg(F.min(F.year("_lo")), F.max(F.year("_hi"))).first()
        if first is not None and last is not None:
            years = F.col("period").between(first, last)
            batch = batch.where(years) if "period" in batch.columns else batch
            speed = speed.where(years) if speed is not None and "period" in speed.columns else speed
    sides = []
    if speed is None:
        sides.append(("b", batch, F.col("_lo"), F.col("_hi"), GRAIN_CODES))
    elif own_cut:
        if _chain(levels, SPEED_GRAINS) != ("H", "m"):
            raise ValueError("the first-bucket cut of many ranges needs hours and minutes among the levels")
        if first is not None and last is not None:
            req = first_buckets(req, speed.select(*VIEW_COLUMNS), req_cols, (first, last))
        else:
            req = req.withColumn("_cut", F.lit(None).cast("timestamp_ntz"))
        req_cols = [*req_cols, "_cut"]
        sides.append(("b", batch, F.col("_lo"), F.coalesce("_cut", "_hi"), GRAIN_CODES))
        sides.append(("s", complete_grains(speed, SPEED_GRAINS), F.col("_lo"), F.col("_hi"), GRAIN_CODES))
    else:
        h = ts_literal(horizon)
        b_hi = F.least(F.col("_hi"), F.greatest(F.col("_lo"), h))
        s_lo = F.greatest(F.col("_lo"), F.least(F.col("_hi"), h))
        sides.append(("b", batch, F.col("_lo"), b_hi, GRAIN_CODES))
        # Coarser speed grains rolled up from its hour rows: few keys per request.
        sides.append(("s", complete_grains(speed, SPEED_GRAINS), s_lo, F.col("_hi"), GRAIN_CODES))
    # One pass over the requests: each side's calendar bounds are selected
    # once as plain columns, then turned into that side's lookup slots.
    keyed, slot_cols, tables, steps = req, [], [], set()
    for side, view, lo, hi, stored in sides:
        chain = _chain(levels, stored)
        steps.add(chain[0])
        keyed = keyed.select(*req_cols, *[c for c, _ in slot_cols], *cover_bounds(chain, lo, hi).values())
        keyed = keyed.select(*req_cols, *[c for c, _ in slot_cols],
                             lookup_slots(chain, bounds_from_columns(chain), side).alias(f"_slots_{side}"))
        slot_cols.append((f"_slots_{side}", slot_count(chain)))
        tables.append((side, chain, view.select(*VIEW_COLUMNS)))
    if len(steps) != 1:
        raise ValueError("both views need the same coarsest grain")
    slots = F.concat(*[F.col(c) for c, _ in slot_cols]) if len(slot_cols) > 1 else F.col(slot_cols[0][0])
    # Unused slots are dropped; a request whose cover is empty (every slot
    # null) keeps its slot 0 as one null row, so that it sums to 0.
    empty = F.coalesce(*[F.col(c)[i] for c, n in slot_cols for i in range(n)]).isNull()
    keyed = (keyed.select(*req_cols, empty.alias("_empty"), F.posexplode(slots).alias("pos", "k"))
             .where(F.col("k").isNotNull() | ((F.col("pos") == 0) & F.col("_empty")))
             .select(*req_cols, "k.side", "k.bucket", "k.i0", "k.i1",
                     F.explode_outer(F.sequence("k.first", "k.last", top_step(steps.pop()))).alias("parent")))
    wanted = keyed.where(F.col("parent").isNotNull()).select("event", "side", "bucket", "parent").distinct()
    profiles = []
    for side, chain, view in tables:
        table = top_profiles(view, chain[0])
        if len(chain) > 1:
            keys = wanted.where(F.col("side") == side).drop("side") if narrow else None
            table = table.unionByName(edge_profiles(view, chain[1:], keys))
        profiles.append(table.withColumn("side", F.lit(side)))
    profiles = reduce(DataFrame.unionByName, profiles)
    part = F.element_at("cum", F.col("i1") + 1) - F.element_at("cum", F.col("i0") + 1)
    matched = (keyed.join(profiles, ["event", "side", "bucket", "parent"], "left")
               .select(*req_cols, part.alias("part")))
    total = F.coalesce(F.sum("part"), F.lit(0)).cast("bigint")
    out = matched.groupBy(*req_cols).agg(total.alias("_total"))
    return out.select(F.col("_id").alias(id_col), F.col("event").alias(event_col),
                      F.col("_lo").alias(from_col), F.col("_hi").alias(to_col),
                      F.when(range_is_valid(F.col("_lo"), F.col("_hi")), F.col("_total")).alias("count"))


__all__ = [
    "CUT_FIRST_SPEED", "CUT_HORIZON", "as_bound",
    "compare_events", "count_by_period", "count_many_ranges", "get_events",
    "merged_cover", "shape_rows", "split_event_list", "timeseries", "view_cover",
]
