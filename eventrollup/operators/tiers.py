"""Speed view as a tiered store of summed runs.

Each micro-batch is one run of level 0 in a ``runs`` store.  Written again (a
retry), it takes the place of its first run; a batch folded into a higher level
had been committed and is not taken again.  Totals are the sums over all live
runs, so merging runs changes no answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.operators import runs
from eventrollup.operators.views import _from_stored, _grain_filter, _to_stored, in_range


def summed(rows: DataFrame) -> DataFrame:
    """Counts per key over several runs."""
    return rows.groupBy("event", "grain", "period", "bdate", "at").agg(F.sum("count").cast("bigint").alias("count"))


def commit_batch(counts: DataFrame, root: str, batch_id: int) -> int:
    """Store the counts of one micro-batch; returns its number of rows.  A batch
    without rows leaves the store as it is."""
    spark = counts.sparkSession
    now = runs.manifest(spark, root)
    if any(r.level > 0 and r.first <= batch_id <= r.last for r in now.runs):
        return 0
    new = runs.write_run(_to_stored(counts), root, 0, batch_id, batch_id)
    others = [r for r in now.runs if (r.level, r.first) != (0, batch_id)]
    if new.rows or len(others) < len(now.runs):
        runs.publish(spark, root, now, others + ([new] if new.rows else []))
    return new.rows


def merge_tiers(spark: SparkSession, root: str, committed: int, fanout: int = runs.FANOUT) -> runs.Manifest:
    """Merge full levels of the batches up to ``committed``."""
    return runs.merge_full_levels(spark, root, summed, upto=committed, fanout=fanout)


def read_speed_store(spark: SparkSession, root: str, codes: Sequence[str] | None = None,
                     events: Sequence[str] | None = None, left=None, right=None,
                     with_period: bool = False) -> DataFrame:
    """The speed view; grains and years prune folders of every run, the rest
    reaches the Parquet filters."""
    rows = runs.read_runs(spark, root, runs.manifest(spark, root).runs)
    cond = _grain_filter(codes)
    if cond is not None:
        rows = rows.where(cond)
    if events is not None:
        rows = rows.where(F.col("event").isin(list(events)))
    return _from_stored(summed(rows.where(in_range(left, right))), with_period)


def last_batch(spark: SparkSession, root: str) -> int:
    """The highest batch id with rows, -1 if none."""
    return max((r.last for r in runs.manifest(spark, root).runs), default=-1)
