"""Published versions of the batch layer's outputs.

A root folder holds ``v=<n>/`` (one complete master and view each) and
``published/<n>``, an empty pointer file created when version n is complete.
Readers resolve the newest pointer once, when they are opened, so a reader sees
one version from start to end whatever is rebuilt meanwhile, and a rebuild that
fails half way is never seen at all.  Version numbers are claimed by creating
``claims/<n>``, so two rebuilds never share a folder.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from eventrollup import files
from eventrollup.functions.buckets import GRAIN_CODES
from eventrollup.operators import views
from eventrollup.plans.batch import check_landing, view_from_master
from eventrollup.sources import master

GRACE_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Snapshot:
    """The folders of one version."""

    number: int
    master: str
    view: str
    rejects: str


def _snapshot(root: str, number: int) -> Snapshot:
    base = f"{root.rstrip('/')}/v={number}"
    return Snapshot(number, f"{base}/master", f"{base}/view", f"{base}/rejects")


def _numbers(spark: SparkSession, root: str, kind: str) -> dict[int, float]:
    found = files.entries(spark, f"{root.rstrip('/')}/{kind}")
    return {int(n): t for n, t in found.items() if n.isdigit()}


def begin(spark: SparkSession, root: str) -> Snapshot:
    """Claim the next version number; nothing is visible to readers yet."""
    number = max([0, *_numbers(spark, root, "claims"), *_numbers(spark, root, "published")]) + 1
    while True:
        try:
            files.create_text(spark, f"{root.rstrip('/')}/claims/{number:012d}", "")
            return _snapshot(root, number)
        except FileExistsError:
            number += 1


def publish(spark: SparkSession, root: str, snapshot: Snapshot) -> None:
    """Show a complete version to readers opened from now on.  An older version
    that is finished late never replaces a newer one."""
    files.create_text(spark, f"{root.rstrip('/')}/published/{snapshot.number:012d}", "")


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest published version."""
    found = _numbers(spark, root, "published")
    return _snapshot(root, max(found)) if found else None


def retire(spark: SparkSession, root: str, keep: int = 2, grace_seconds: float = GRACE_SECONDS) -> list[int]:
    """Delete versions that are out of use: published ones beyond the newest
    ``keep`` whose successor has been there for the grace period, and unfinished
    ones below the newest, claimed that long ago.  The grace period must be longer
    than any read and any rebuild."""
    base, before = root.rstrip("/"), time.time() - grace_seconds
    published, claims = _numbers(spark, root, "published"), _numbers(spark, root, "claims")
    order = sorted(published)
    gone = [n for n, after in zip(order, order[1:], strict=False)
            if n in order[:-keep] and published[after] <= before]
    gone += [n for n, t in claims.items() if n not in published and order and n < order[-1] and t <= before]
    for n in sorted(gone):
        # The pointer goes first: no new reader can resolve what is being deleted.
        files.delete(spark, f"{base}/published/{n:012d}")
        files.delete(spark, f"{base}/v={n}")
        files.delete(spark, f"{base}/claims/{n:012d}")
    return sorted(gone)


def rebuild(spark: SparkSession, landing_dir: str, root: str, grains: Sequence[str] = GRAIN_CODES,
            allow_empty: bool = False) -> Snapshot:
    """Full rebuild into a version of its own, published once master, rejects and
    view are complete.  A landing folder without a finished file is refused."""
    check_landing(spark, landing_dir, allow_empty)
    new = begin(spark, root)
    # All of history at once: files are bounded by days and bytes, not by tasks.
    master.ingest(spark, landing_dir, new.master, mode="overwrite", rejects_dir=new.rejects, clustered=True)
    views.write_view(view_from_master(spark, new.master, grains), new.view)
    publish(spark, root, new)
    return new


def read_view(spark: SparkSession, root: str, **filters) -> DataFrame:
    """The view of the newest version (filters as ``views.read_view``); empty if
    nothing was published yet."""
    found = current(spark, root)
    return views.read_view(spark, found.view if found else f"{root.rstrip('/')}/v=0/view", **filters)


def read_master(spark: SparkSession, root: str, left=None, right=None) -> DataFrame:
    """The master rows of the newest version."""
    found = current(spark, root)
    return master.read_master(spark, found.master if found else f"{root.rstrip('/')}/v=0/master", left, right)
