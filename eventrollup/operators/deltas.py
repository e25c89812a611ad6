"""Batch view with merge-on-read upserts.

The view is a ``runs`` store: one base run and delta runs, each holding only the
rows whose count changed.  Of several rows with one key the one of the latest
change wins.  An upsert reads the stored rows it may touch and writes its changes,
nothing else: no folder is rewritten, and nothing needs to be held aside as no
file is replaced.  Deltas are merged by level; once they hold more than ``share``
of the base's rows, base and deltas become a new base, so the rows written stay
proportional to the rows changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.operators import runs
from eventrollup.operators.views import _from_stored, _grain_filter, _to_stored, changed_rows, in_range
from eventrollup.operators.views import stored_grains as run_grains

BASE_LEVEL = 1 << 30
FOLD_SHARE = 0.25
KEY = ("event", "grain", "period", "bdate", "at")


def latest(rows: DataFrame) -> DataFrame:
    """The row of the latest change for every key."""
    return rows.groupBy(*KEY).agg(F.max_by("count", "seq").alias("count"))


def _resolved(spark: SparkSession, root: str, live: Sequence[runs.Run], keep=None) -> DataFrame:
    """Stored rows of the view; ``keep`` filters every run before they are resolved
    (by key columns only, so that no newer row is left out).

    The base is not regrouped: its rows pass unless a delta has their key, an
    anti join that AQE broadcasts while the deltas are small.
    """
    base, deltas = ([r for r in live if (r.level == BASE_LEVEL) == is_base] for is_base in (True, False))
    rows = runs.read_runs(spark, root, base).drop("seq")
    rows = rows if keep is None else rows.where(keep)
    if not deltas:
        return rows
    changes = runs.read_runs(spark, root, deltas)
    changes = latest(changes if keep is None else changes.where(keep))
    columns = [*KEY, "count"]
    return rows.join(changes.select(*KEY), list(KEY), "left_anti").select(*columns).unionByName(changes.select(*columns))


def read_store(spark: SparkSession, root: str, codes: Sequence[str] | None = None,
               events: Sequence[str] | None = None, left=None, right=None,
               with_period: bool = False) -> DataFrame:
    """The view (as ``views.read_view``); every filter reaches all runs."""
    keep = F.lit(True)
    cond = _grain_filter(codes)
    if cond is not None:
        keep = keep & cond
    if events is not None:
        keep = keep & F.col("event").isin(list(events))
    return _from_stored(_resolved(spark, root, runs.manifest(spark, root).runs, keep & in_range(left, right)), with_period)


def stored_grains(spark: SparkSession, root: str) -> set[str]:
    """Codes of the grains that any live run holds."""
    live = runs.manifest(spark, root).runs
    return set().union(*[run_grains(spark, runs.folder(root, r)) for r in live])


def write_base(view: DataFrame, root: str) -> None:
    """Make ``view`` the whole content of the store."""
    spark = view.sparkSession
    now = runs.manifest(spark, root)
    seq = max((r.last for r in now.runs), default=0) + 1
    runs.publish(spark, root, now, [runs.write_run(_to_stored(view), root, BASE_LEVEL, seq, seq)])


def upsert(new: DataFrame, root: str, fanout: int = runs.FANOUT, share: float = FOLD_SHARE) -> DataFrame:
    """Set the count of ``new``'s keys where it differs, insert missing ones, keep
    all others.  Returns the rows that changed."""
    spark = new.sparkSession
    now = runs.manifest(spark, root)
    new = new.persist()
    try:
        # One row per (grain, year): a calendar-sized list.
        held = _to_stored(new).groupBy("grain", "period").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).collect()
        if not held:
            return new.limit(0)
        keep = reduce(lambda a, b: a | b, [
            (F.col("grain") == h["grain"]) & (F.col("period") == h["period"]) & F.col("at").between(h["lo"], h["hi"])
            for h in held])
        old = _from_stored(_resolved(spark, root, now.runs, keep))
        seq = max((r.last for r in now.runs), default=0) + 1
        first = not any(r.level == BASE_LEVEL for r in now.runs)
        added = runs.write_run(_to_stored(changed_rows(new, old)), root, BASE_LEVEL if first else 0, seq, seq)
        if added.rows:
            runs.publish(spark, root, now, [*now.runs, added])
    finally:
        new.unpersist()
    changes = _from_stored(runs.read_runs(spark, root, [added]))
    if added.rows:
        fold(spark, root, fanout, share)
    return changes


def fold(spark: SparkSession, root: str, fanout: int = runs.FANOUT, share: float = FOLD_SHARE) -> runs.Manifest:
    """Merge full levels of deltas, and everything into a new base once the deltas
    hold more than ``share`` of the base's rows."""
    now = runs.merge_full_levels(spark, root, latest, fanout=fanout, below=BASE_LEVEL)
    base = sum(r.rows for r in now.runs if r.level == BASE_LEVEL)
    deltas = sum(r.rows for r in now.runs if r.level != BASE_LEVEL)
    if not deltas or deltas <= share * base:
        return now
    whole = runs.write_run(_resolved(spark, root, now.runs), root, BASE_LEVEL,
                           min(r.first for r in now.runs), max(r.last for r in now.runs))
    return runs.publish(spark, root, now, [whole])
