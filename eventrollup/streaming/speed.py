"""Speed layer: minute and hour counts of recent events.

Main path: ``foreachBatch`` computes each micro-batch's minute counts and
the hour roll-up of them (the same two-aggregation plan as the batch view,
restricted to m and H) and overwrites the ``batch_id=<id>`` folder of the
partials table.  Readers sum partials per key, which is the reference's
counter column without a mutable store:

* late events of any age land in their own buckets (no watermark, T4);
* a replayed batch id rewrites its own folder, so totals do not move (T5);
* the checkpoint keeps source offsets, so a restart continues where it
  stopped instead of emptying the view (``reset=True`` empties it first,
  as the reference does on start).

Alternative (T3 variant): event-time tumbling windows with a watermark in
append mode; the last open window is emitted only once the watermark passes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventrollup.functions.buckets import SPEED_GRAINS
from eventrollup.operators import runs, tiers
from eventrollup.operators.rollup import multi_grain_view
from eventrollup.operators.views import batch_ids, compacted_upto, empty_speed_view, write_partials
from eventrollup.session import child_names
from eventrollup.sources.landing import REJECT_SCHEMA, good_rows, parse_raw, reject_rows


def speed_counts(raw_lines: DataFrame) -> DataFrame:
    """Raw JSON lines of one micro-batch -> minute and hour counts."""
    events = good_rows(parse_raw(raw_lines))
    return multi_grain_view(events, SPEED_GRAINS)


def process_batch(raw_lines: DataFrame, batch_id: int, view_path: str) -> int:
    """One micro-batch: count and overwrite its partials folder; returns the
    number of rows written.

    The row count is an ``Observation`` of the write job itself (A12), not a
    second job.  An empty batch writes nothing (P18).  Minute and hour
    rows leave one plan in one write, so the minute counts are computed once
    and need no cache between two writes (T6).
    """
    if raw_lines.isEmpty():
        return 0
    rows = Observation()
    write_partials(speed_counts(raw_lines).observe(rows, F.count(F.lit(1)).alias("rows")), view_path, batch_id)
    return int(rows.get["rows"])


def start_speed_layer(lines: DataFrame, view_path: str, checkpoint: str,
                      processing_time: str | None = "1 second", available_now: bool = False,
                      reset: bool = False, query_name: str | None = None,
                      on_batch: Callable[[int, int], None] | None = None) -> StreamingQuery:
    """Run the speed layer over a stream of raw lines.

    Batch ids count from 0 in every new checkpoint, so a view that has rows
    accepts only the checkpoint that wrote it; ``reset`` empties it first.
    ``on_batch`` gets every batch id with the number of rows it wrote.
    """
    spark = lines.sparkSession
    if reset:
        empty_speed_view(spark, view_path)
    elif (batch_ids(spark, view_path) or compacted_upto(spark, view_path) >= 0) and not child_names(spark, checkpoint):
        raise ValueError(f"{view_path} has rows of another stream run and {checkpoint} is new; "
                         "restart with the old checkpoint, or reset the view")

    def _each(batch_df: DataFrame, batch_id: int) -> None:
        rows = process_batch(batch_df, batch_id, view_path)
        if on_batch is not None:
            on_batch(batch_id, rows)

    writer = lines.writeStream.foreachBatch(_each).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


# --- tiered store, rejects and figures of every batch (S10, X2, X3, A12) --------

FIGURES_SCHEMA = "batch_id bigint, rows_in bigint, rejected bigint, written bigint"


@dataclass(frozen=True)
class SpeedStore:
    """The folders one stream writes: counts, rejected lines, figures of batches."""

    root: str

    @property
    def counts(self) -> str:
        return f"{self.root.rstrip('/')}/counts"

    @property
    def rejects(self) -> str:
        return f"{self.root.rstrip('/')}/rejects"

    @property
    def figures(self) -> str:
        return f"{self.root.rstrip('/')}/figures"


def process_tiered(raw_lines: DataFrame, batch_id: int, store: SpeedStore, fanout: int = runs.FANOUT) -> tuple[int, int, int]:
    """One micro-batch into counts, rejects and figures; returns (rows in,
    rejected, rows written).

    The source is read and parsed once: both sinks and the row counts read the
    parsed rows that the first job kept (memory, then disk; lost pieces are parsed
    again).  Every sink is keyed by the batch id, the figures last, so a retry at
    any point leaves each line in one place once.  Then full levels of the batches
    before this one, which the stream has committed, are merged.
    """
    spark = raw_lines.sparkSession
    parsed = parse_raw(raw_lines).persist()
    try:
        seen = parsed.agg(F.count(F.lit(1)).alias("rows_in"), F.count("reason").alias("rejected")).first()
        written = 0
        if seen["rows_in"] > seen["rejected"]:
            written = tiers.commit_batch(multi_grain_view(good_rows(parsed), SPEED_GRAINS), store.counts, batch_id)
        if seen["rows_in"]:
            for rows, path in ((reject_rows(parsed), store.rejects),
                               (spark.createDataFrame([(batch_id, seen["rows_in"], seen["rejected"], written)], FIGURES_SCHEMA)
                                .drop("batch_id").coalesce(1), store.figures)):
                if path != store.rejects or seen["rejected"]:
                    rows.write.mode("overwrite").parquet(f"{path}/batch_id={int(batch_id)}")
    finally:
        parsed.unpersist()
    tiers.merge_tiers(spark, store.counts, batch_id - 1, fanout)
    return seen["rows_in"], seen["rejected"], written


def start_tiered(lines: DataFrame, store: SpeedStore, checkpoint: str, fanout: int = runs.FANOUT,
                 processing_time: str | None = "1 second", available_now: bool = False,
                 on_batch: Callable[[int, tuple[int, int, int]], None] | None = None) -> StreamingQuery:
    """Run the speed layer into a ``SpeedStore`` (T1, T2).  A store that has
    batches accepts only the checkpoint that wrote it."""
    if child_names(lines.sparkSession, store.figures) and not child_names(lines.sparkSession, checkpoint):
        raise ValueError(f"{store.root} has rows of another stream run and {checkpoint} is new")

    def _each(batch_df: DataFrame, batch_id: int) -> None:
        figures = process_tiered(batch_df, batch_id, store, fanout)
        if on_batch is not None:
            on_batch(batch_id, figures)

    writer = lines.writeStream.foreachBatch(_each).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def _side_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not child_names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def read_rejects(spark: SparkSession, store: SpeedStore) -> DataFrame:
    """Rejected lines of the stream: value, reason, batch_id."""
    columns = ", ".join(f"{f.name} string" for f in REJECT_SCHEMA.fields)
    return _side_rows(spark, store.rejects, f"{columns}, batch_id bigint")


def read_figures(spark: SparkSession, store: SpeedStore) -> DataFrame:
    """Rows in, rejected and written of every batch that had any."""
    return _side_rows(spark, store.figures, FIGURES_SCHEMA)


def windowed_counts(lines: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Stateful variant: minute windows, then hour windows chained on them.

    The hour aggregation reads the minute windows' event time
    (``window_time``), so each raw row is counted once per grain and the hour
    state holds one row per open (event, hour), not the raw rows.  Append
    mode only (Spark rejects update mode for chained windows).  Rows older
    than the watermark are dropped, unlike the foreachBatch path, and each
    window is emitted once the watermark passes its end.
    """
    events = good_rows(parse_raw(lines)).select("event", F.col("ts").cast("timestamp").alias("ts"))
    minutes = (events.withWatermark("ts", watermark)
               .groupBy("event", F.window("ts", "1 minute").alias("w"))
               .agg(F.count(F.lit(1)).alias("count")))
    hours = (minutes.groupBy("event", F.window(F.window_time("w"), "1 hour").alias("w"))
             .agg(F.sum("count").alias("count")))

    def shaped(df: DataFrame, code: str) -> DataFrame:
        return df.select("event", F.lit(code).alias("bucket"),
                         F.col("w.start").cast("timestamp_ntz").alias("bdate"),
                         F.col("count").cast("bigint").alias("count"))

    return shaped(minutes, "m").unionByName(shaped(hours, "H"))


def start_windowed(lines: DataFrame, out_path: str, checkpoint: str, watermark: str = "10 minutes",
                   available_now: bool = False, processing_time: str | None = "1 second") -> StreamingQuery:
    """Write windowed minute and hour counts to a Parquet sink in append mode."""
    writer = (windowed_counts(lines, watermark).writeStream.format("parquet")
              .outputMode("append")
              .option("checkpointLocation", checkpoint)
              .option("path", out_path))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_until_done(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Block until an ``availableNow`` query has drained its input."""
    query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise exc


def speed_view_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """The speed view the stream would build, computed as one batch job."""
    return multi_grain_view(events, SPEED_GRAINS)
