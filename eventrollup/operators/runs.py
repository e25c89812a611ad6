"""Immutable runs of view rows, named by a manifest.

A store is a folder with ``data/run=<name>/grain=/period=`` (the rows, never
changed once written) and ``manifest/<version>.json`` (which runs are live).  A
change writes a new run first and then one new manifest, so a reader, which
resolves the newest manifest and reads the runs it lists and nothing else, sees
the store before the change or after it.  Data folders are never listed by readers.

Runs have levels.  Once ``fanout`` runs of one level are there, they are merged
into one run of the next, so n changes leave about ``fanout * log(n)`` live runs
and a row is rewritten once per level.  Merged runs stay on disk, marked with the
time they were dropped, until ``vacuum`` finds that time older than the grace
period: readers that resolved an older manifest finish in peace.

One writer at a time per store; a second one fails when both create the same
manifest version.  How rows of several runs combine is the caller's rule: summed
(``tiers``) or the last one wins (``deltas``).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventrollup import files
from eventrollup.operators.views import STORED_SCHEMA, parquet_writer

FANOUT = 8
GRACE_SECONDS = 24 * 3600
RUN_SCHEMA = T.StructType([*STORED_SCHEMA.fields, T.StructField("run", T.StringType())])


@dataclass(frozen=True)
class Run:
    """One folder of rows: the changes ``first`` .. ``last`` it stands for."""

    name: str
    level: int
    first: int
    last: int
    rows: int


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    runs: tuple[Run, ...] = ()
    dropped: tuple[tuple[str, float], ...] = ()      # (run name, when)


def _data(root: str) -> str:
    return f"{root.rstrip('/')}/data"


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


def folder(root: str, run: Run) -> str:
    return f"{_data(root)}/run={run.name}"


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.entries(spark, _log(root)) if n.endswith(".json"))


def manifest(spark: SparkSession, root: str) -> Manifest:
    """The newest manifest; an empty one if the store has none."""
    versions = _versions(spark, root)
    if not versions:
        return Manifest()
    read = json.loads(files.read_text(spark, f"{_log(root)}/{versions[-1]:012d}.json"))
    return Manifest(read["version"], tuple(Run(**r) for r in read["runs"]), tuple((n, t) for n, t in read["dropped"]))


def publish(spark: SparkSession, root: str, old: Manifest, runs: Sequence[Run]) -> Manifest:
    """Make ``runs`` the live ones in place of those of ``old``."""
    live, now = {r.name for r in runs}, time.time()
    gone = tuple((r.name, now) for r in old.runs if r.name not in live)
    new = Manifest(old.version + 1, tuple(sorted(runs, key=lambda r: (r.first, r.last))), old.dropped + gone)
    files.create_text(spark, f"{_log(root)}/{new.version:012d}.json", json.dumps(
        {"version": new.version, "runs": [asdict(r) for r in new.runs], "dropped": new.dropped}))
    return new


def write_run(stored: DataFrame, root: str, level: int, first: int, last: int) -> Run:
    """Write rows (the columns of ``STORED_SCHEMA``) as a run; it is live only
    once a manifest lists it.  The row count is observed by the write itself."""
    name, seen = f"{first:012d}-{last:012d}-{uuid.uuid4().hex[:8]}", Observation()
    rows = stored.select(*STORED_SCHEMA.names)
    if level:
        # A merged run can be large: folders are split into advisory-sized tasks.
        rows = rows.hint("rebalance", "grain", "period")
    (parquet_writer(rows.sortWithinPartitions("grain", "period", "event", "bdate")
                    .observe(seen, F.count(F.lit(1)).alias("rows"))).partitionBy("grain", "period").parquet(f"{_data(root)}/run={name}"))
    return Run(name, level, first, last, int(seen.get["rows"]))


def read_runs(spark: SparkSession, root: str, runs: Sequence[Run]) -> DataFrame:
    """The rows of some runs with the last change each run stands for (``seq``)."""
    paths = [folder(root, r) for r in runs if r.rows]
    if not paths:
        return spark.createDataFrame([], RUN_SCHEMA).drop("run").withColumn("seq", F.lit(0).cast("bigint"))
    rows = spark.read.schema(RUN_SCHEMA).option("basePath", _data(root)).parquet(*paths)
    return rows.withColumn("seq", F.split_part("run", F.lit("-"), F.lit(2)).cast("bigint")).drop("run")


def merge_full_levels(spark: SparkSession, root: str, combine: Callable[[DataFrame], DataFrame],
                      upto: int | None = None, fanout: int = FANOUT, below: int = 1 << 30) -> Manifest:
    """Merge ``fanout`` runs of a level into one of the next, oldest first, as long
    as a level under ``below`` has that many.  Only runs of changes up to ``upto``
    are touched: later ones may still be written again."""
    now = manifest(spark, root)
    while True:
        ready: dict[int, list[Run]] = {}
        for r in now.runs:
            if r.level < below and (upto is None or r.last <= upto):
                ready.setdefault(r.level, []).append(r)
        full = [level for level, found in sorted(ready.items()) if len(found) >= fanout]
        if not full:
            return now
        part = ready[full[0]][:fanout]
        merged = write_run(combine(read_runs(spark, root, part)), root, full[0] + 1, part[0].first, part[-1].last)
        now = publish(spark, root, now, [r for r in now.runs if r not in part] + [merged])


def vacuum(spark: SparkSession, root: str, grace_seconds: float = GRACE_SECONDS) -> int:
    """Delete what no reader can want any more: runs dropped longer than the grace
    period ago, runs of that age that no manifest ever listed (a writer failed),
    and manifests before the newest.  The grace period must be longer than any
    read and any write.  Returns the number of folders removed."""
    now, before = manifest(spark, root), time.time() - grace_seconds
    kept = {r.name for r in now.runs}
    waiting = {n for n, t in now.dropped if t > before}
    removed = []
    for entry, changed in files.entries(spark, _data(root)).items():
        name = entry.removeprefix("run=")
        if name in kept or name in waiting or (name not in dict(now.dropped) and changed > before):
            continue
        files.delete(spark, f"{_data(root)}/{entry}")
        removed.append(name)
    if len(waiting) < len(now.dropped):
        trimmed = replace(now, dropped=tuple((n, t) for n, t in now.dropped if n in waiting))
        now = publish(spark, root, trimmed, trimmed.runs)
    for entry, changed in files.entries(spark, _log(root)).items():
        if entry != f"{now.version:012d}.json" and changed <= before:
            files.delete(spark, f"{_log(root)}/{entry}")
    return len(removed)
