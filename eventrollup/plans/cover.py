"""Range cover (Q0): tile [left, right) with whole buckets, coarse grains first.

The reference walks a list of grains: take the buckets of the first grain
that lie inside the range, then cover the remainder at each edge with the
next grain.  Over a consistent roll-up (each grain the sum of the finer
one) that walk keeps exactly the rows satisfying

    bucket = g  AND  the g bucket lies in [left, right)
                AND  no coarser grain earlier in the list has its
                     enclosing bucket inside [left, right)

and a grain listed after a finer one can add nothing.  So the cover is a
filter, not a loop: one scan, no join, literal or per-row bounds alike.
(The reference's loop over-counts when, after the first match, only one
edge has rows at a level; the filter is the intended result.)

``cover_keys`` is the same tiling generated from the bounds alone, and
``lookup_slots`` its compact form (whole top buckets plus edge runs inside
one parent each), used to answer many ranges by an equi-join instead of a
range join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventrollup.functions.buckets import (
    GRAIN_NAMES,
    GRAIN_UNITS,
    bucket_ceil,
    bucket_start,
    check_levels,
    is_coarser,
)
from eventrollup.functions.ranges import as_bound, contained, enclosing_contained
from eventrollup.operators.profiles import PARENT, SLOTS, index_in_parent


def effective_levels(levels: Sequence[str]) -> tuple[str, ...]:
    """Drop grains listed after a finer grain: they can never add a row."""
    out: list[str] = []
    for code in check_levels(levels):
        if all(is_coarser(prev, code) for prev in out):
            out.append(code)
    return tuple(out)


def cover_predicate(levels: Sequence[str], left, right,
                    bucket: str = "bucket", bdate: str = "bdate") -> Column:
    """Rows of a roll-up view that make up the cover of [left, right)."""
    chain = effective_levels(levels)
    b = F.col(bdate)
    lo, hi = as_bound(left), as_bound(right)
    terms = []
    for i, code in enumerate(chain):
        term = (F.col(bucket) == code) & contained(code, b, lo, hi)
        for coarser in chain[:i]:
            term = term & ~enclosing_contained(coarser, b, lo, hi)
        terms.append(term)
    # The common conjuncts come first so they reach the scan as filters.
    return (b >= lo) & (b < hi) & F.col(bucket).isin(list(chain)) & reduce(or_, terms)


def cover_keys(levels: Sequence[str], left, right) -> Column:
    """Array of (bucket, bdate) structs tiling [left, right); empty if none fit.

    At most (coarsest buckets in the range) + two edge runs per finer grain,
    e.g. years + 22 months + 60 days + 46 hours + 118 minutes for the full
    chain.  Explode it and equi-join on (event, bucket, bdate).
    """
    chain = effective_levels(levels)
    lo, hi = as_bound(left), as_bound(right)
    empty = F.array().cast("array<struct<bucket:string,bdate:timestamp_ntz>>")

    def run(code: str, start: Column, stop: Column) -> Column:
        unit = GRAIN_UNITS[code]
        # greatest() keeps the unused branch well-formed when start >= stop.
        last = F.greatest(start, F.timestamp_add(unit, F.lit(-1), stop))
        seq = F.sequence(start, last, F.expr(f"INTERVAL 1 {unit}"))
        keyed = F.transform(seq, lambda t: F.struct(F.lit(code).alias("bucket"), t.alias("bdate")))
        return F.when(start < stop, keyed).otherwise(empty)

    # Grains nest, so once a grain fits inside the range every finer one
    # does too, and the span covered so far is [ceil_prev(lo), floor_prev(hi)).
    pieces = []
    prev = None
    for code in chain:
        a, z = bucket_ceil(code, lo), bucket_start(code, hi)
        if prev is None:
            pieces.append(run(code, a, z))
        else:
            pa, pz = prev
            pieces.append(F.when(pa < pz, F.concat(run(code, a, pa), run(code, pz, z)))
                          .otherwise(run(code, a, z)))
        prev = (a, z)
    return F.concat(*pieces) if len(pieces) > 1 else pieces[0]


def cover_bounds(levels: Sequence[str], left, right) -> dict[str, Column]:
    """Per grain of the chain: ``a_<g>`` = first whole bucket start at or after
    ``left``, ``z_<g>`` = start of the bucket holding ``right``.

    Select these once as columns (``df.select("*", *bounds.values())``) and
    pass ``bounds_from_columns`` to ``lookup_slots``, so each
    calendar expression is evaluated once per row.
    """
    lo, hi = as_bound(left), as_bound(right)
    out = {}
    for code in effective_levels(levels):
        name = GRAIN_NAMES[code]  # not the code: column names ignore case (m vs M)
        out[f"_a_{name}"] = bucket_ceil(code, lo).alias(f"_a_{name}")
        out[f"_z_{name}"] = bucket_start(code, hi).alias(f"_z_{name}")
    return out


def bounds_from_columns(levels: Sequence[str]) -> dict[str, tuple[Column, Column]]:
    return {code: (F.col(f"_a_{GRAIN_NAMES[code]}"), F.col(f"_z_{GRAIN_NAMES[code]}"))
            for code in effective_levels(levels)}


def _edge_runs(chain: Sequence[str], bounds: dict[str, tuple[Column, Column]]):
    """(child code, parent start, i0, i1, applies) for each possible edge run."""
    for parent, child in zip(chain, chain[1:]):
        if PARENT.get(child) != parent:
            raise ValueError(f"edge lookups need consecutive grains, got {chain}")
    for parent, child in zip(chain, chain[1:]):
        a, z = bounds[child]
        pa, pz = bounds[parent]
        n = F.lit(SLOTS[child])
        # Left run [a, pa) sits in the parent bucket just before pa.
        left_parent = F.timestamp_add(GRAIN_UNITS[parent], F.lit(-1), pa)
        yield child, left_parent, index_in_parent(child, a), n, (pa <= pz) & (a < pa)
        # Right run [pz, z) sits in the parent bucket starting at pz.
        yield child, pz, F.lit(0), index_in_parent(child, z), (pa <= pz) & (pz < z)
        # No parent boundary inside the range: one run [a, z) in parent pz.
        yield child, pz, index_in_parent(child, a), index_in_parent(child, z), (pa > pz) & (a < z)


def lookup_slots(levels: Sequence[str], bounds: dict[str, tuple[Column, Column]],
                 side: str) -> Column:
    """Every profile lookup of one range as a fixed array of nullable slots.

    Slot = (side, bucket, first, last, i0, i1): the runs of whole ``bucket``
    buckets with index in [i0, i1) inside each parent bucket whose start is
    in ``first`` .. ``last`` (stepping by the coarsest grain).  Slot 0 is the
    coarsest grain's run of whole buckets, each a one-slot profile of itself
    (``first`` .. ``last`` = its starts, [0, 1)); the others are the edge
    runs of the finer grains, one parent each (``first`` = ``last``).
    Unused slots are null.  Only plain array, struct and CASE expressions:
    ``posexplode`` then ``explode(sequence(first, last, step))`` stay inside
    whole-stage codegen, unlike higher-order functions over the array.
    """
    chain = effective_levels(levels)
    tag = F.lit(side)

    def slot(code, first, last, i0, i1, ok):
        return F.when(ok, F.struct(tag.alias("side"), F.lit(code).alias("bucket"),
                                   first.alias("first"), last.alias("last"),
                                   i0.cast("int").alias("i0"), i1.cast("int").alias("i1")))

    top = chain[0]
    a, z = bounds[top]
    slots = [slot(top, a, F.timestamp_add(GRAIN_UNITS[top], F.lit(-1), z), F.lit(0), F.lit(1), a < z)]
    slots += [slot(code, par, par, i0, i1, ok) for code, par, i0, i1, ok in _edge_runs(chain, bounds)]
    return F.array(*slots)


def slot_count(levels: Sequence[str]) -> int:
    """Length of the ``lookup_slots`` array: the top run plus three per finer grain."""
    return 1 + 3 * (len(effective_levels(levels)) - 1)


def top_step(levels: Sequence[str]) -> Column:
    """Step between the parents of a slot: one bucket of the coarsest grain."""
    return F.expr(f"INTERVAL 1 {GRAIN_UNITS[effective_levels(levels)[0]]}")
