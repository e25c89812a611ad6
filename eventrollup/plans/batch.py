"""Batch layer runs: landing files -> master dataset -> batch view.

The reference empties its stores and re-derives everything on each run.
Here both outputs are overwritten, so a rerun (or a retried job) leaves the
same files; ``refresh`` instead appends only landing files not ingested yet
and rewrites only the view folders whose counts changed.

A master folder belongs to one of the two runs.  ``refresh`` appends
through the streaming Parquet sink, whose commit log (``_spark_metadata``)
then decides which files every reader sees, so files a ``rebuild`` wrote
into the same folder would silently disappear from reads (and a rebuild
over a refreshed folder would leave the stream's checkpoint out of step).
Both runs therefore refuse a folder written by the other one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup import files
from eventrollup.functions.buckets import GRAIN_CODES, check_grain
from eventrollup.operators import deltas, rollup, views
from eventrollup.session import child_names
from eventrollup.sources import landing, master
from eventrollup.streaming.speed import run_until_done

# The streaming file sink's commit log folder inside its output path.
SINK_LOG = "_spark_metadata"


def view_from_master(spark: SparkSession, master_dir: str,
                     grains: Sequence[str] = GRAIN_CODES) -> DataFrame:
    """The multi-grain view from the master's calendar columns (no text re-parse)."""
    return rollup.multi_grain_view(master.read_master(spark, master_dir), grains)


def check_landing(spark: SparkSession, landing_dir: str, allow_empty: bool = False) -> None:
    """Refuse a landing folder that holds no finished, non-empty file."""
    if allow_empty:
        return
    for path, size in files.files_below(spark, landing_dir):
        parts = path.removeprefix(landing_dir).strip("/").split("/")
        hidden = any(p.startswith(("_", ".")) for p in parts[-1:])
        if size and not hidden and not path.endswith(landing.IN_PROGRESS_SUFFIX):
            return
    raise FileNotFoundError(f"no finished landing file under {landing_dir}")


def rebuild(spark: SparkSession, landing_dir: str, master_dir: str, view_path: str,
            rejects_dir: str | None = None, grains: Sequence[str] = GRAIN_CODES,
            allow_empty: bool = False) -> None:
    """Full rebuild: master and view both replaced, idempotent by construction.

    A landing folder without a finished file is refused unless ``allow_empty``,
    so a misspelt path or a drop still being written does not empty the view.
    Readers may meet a half-written view here; ``snapshots.rebuild`` publishes
    complete versions instead.
    """
    check_landing(spark, landing_dir, allow_empty)
    if SINK_LOG in child_names(spark, master_dir):
        raise ValueError(f"{master_dir} is fed by refresh (streaming sink log present); "
                         "rebuild into a fresh master folder")
    master.ingest(spark, landing_dir, master_dir, mode="overwrite", rejects_dir=rejects_dir)
    views.write_view(view_from_master(spark, master_dir, grains), view_path, mode="overwrite")


def refresh(spark: SparkSession, landing_dir: str, master_dir: str, view_path: str,
            checkpoint: str, grains: Sequence[str] = GRAIN_CODES,
            rejects_dir: str | None = None, merge_on_read: bool = False) -> DataFrame:
    """Incremental run: ingest new landing files once, then bring the view up to date.

    Returns the view rows that changed.

    The view is driven by a second stream over the master's own committed
    files: each of its batches names the days that got new rows, only those
    days are read again from the master, and only changed counts are written: into
    a rewrite of their folders, or with ``merge_on_read`` as a delta of a
    ``deltas`` store.  A batch that is retried recounts the same days, so a
    failure at any point leaves nothing counted twice or missed.  Rejected
    lines of the new files go to ``rejects_dir`` if one is given.  A view keeps
    the list of grains it began with.
    """
    names = child_names(spark, master_dir)
    if names and SINK_LOG not in names:
        raise ValueError(f"{master_dir} was written by a batch rebuild; readers would lose its files "
                         "once the streaming sink log exists, so refresh needs its own master folder")
    read = deltas.read_store if merge_on_read else views.read_view
    grains = tuple(check_grain(g) for g in grains)
    if not merge_on_read:
        views.create_view(spark, view_path)
    held = (deltas if merge_on_read else views).stored_grains(spark, view_path)
    if held and held != set(grains):
        raise ValueError(f"{view_path} holds the grains {sorted(held)}; refresh was asked for {sorted(grains)}")
    base = checkpoint.rstrip("/")
    run_until_done(master.ingest_stream(landing.text_source(spark, landing_dir), master_dir, checkpoint,
                                        available_now=True))
    if rejects_dir is not None:
        run_until_done(master.reject_stream(landing.text_source(spark, landing_dir), rejects_dir, f"{base}-rejects"))
    changed = [spark.createDataFrame([], views.VIEW_SCHEMA)]

    def update(new_rows: DataFrame, batch_id: int) -> None:
        # Calendar days, so their number is bounded by the calendar.
        days = [tuple(r) for r in new_rows.select(*master.PARTITION_COLUMNS).distinct().collect()]
        if days:
            new = recount(spark, master_dir, view_path, days, grains, read)
            rows = deltas.upsert(new, view_path) if merge_on_read else views.upsert_view(spark, new, view_path)
            changed.append(rows.select(*views.VIEW_SCHEMA.names))

    run_until_done(master.master_stream(spark, master_dir).writeStream.foreachBatch(update)
                   .option("checkpointLocation", f"{base}-view").trigger(availableNow=True).start())
    return reduce(DataFrame.unionByName, changed)


def recount(spark: SparkSession, master_dir: str, view_path: str, days: list[tuple[int, int, int]],
            grains: Sequence[str] = GRAIN_CODES, read=views.read_view) -> DataFrame:
    """View rows of the given days, and of the months and years around them.

    Minutes, hours and days come from those day folders of the master.  Months
    and years are summed from the recounted days and, for the other days of the
    touched years, from the coarsest grain below a month that the view stores;
    a view that stores none has those years counted again from the master.
    """
    fine = rollup.multi_grain_view(master.read_days(spark, master_dir, days), ("m", "H", "D"))
    parts = [fine.where(F.col("bucket").isin([g for g in grains if g in ("m", "H", "D")]))]
    coarse = [g for g in grains if g in ("M", "Y")]
    if coarse:
        years = sorted({y for y, _, _ in days})
        below = next((g for g in ("D", "H", "m") if g in grains), None)
        if below is None:
            counted = rollup.multi_grain_view(master.read_years(spark, master_dir, years), ("D",))
        else:
            touched = [f"{y:04d}-{m:02d}-{d:02d}" for y, m, d in days]
            counted = read(spark, view_path, codes=(below,), with_period=True) \
                .where(F.col("period").isin(years) & ~F.date_format("bdate", "yyyy-MM-dd").isin(touched)) \
                .select("event", "bdate", "count").unionByName(fine.where(F.col("bucket") == below).select("event", "bdate", "count"))
        rows = rollup.expand_counts(counted.select("event", "bdate", "count"), coarse).select(*views.VIEW_SCHEMA.names)
        months = sorted({f"{y:04d}-{m:02d}" for y, m, _ in days})
        parts.append(rows.where((F.col("bucket") == "Y") | F.date_format("bdate", "yyyy-MM").isin(months)))
    return reduce(DataFrame.unionByName, parts)
