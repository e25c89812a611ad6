"""Master dataset: parsed events as Parquet partitioned by calendar day.

Layout: ``event STRING, timestamp STRING, hour INT, minute INT, at BIGINT, raw
STRING`` with partition columns ``year, month, day``.  The roll-up needs only the
calendar fields, and range reads the event time in epoch seconds (``at``), so
neither parses the timestamp text again; ``raw`` is the whole landed record, so
fields beyond these two outlive the landing file.  Batch writes sort every file by
event time, so a range read skips row groups and pages inside a day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventrollup.functions.buckets import calendar_columns
from eventrollup.functions.ranges import epoch_bound, epoch_seconds, partition_bounds
from eventrollup.sources.landing import MAX_FILE_AGE, good_rows, parse_raw, read_landing, reject_rows

PARTITION_COLUMNS = ("year", "month", "day")
MASTER_SCHEMA = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("at", T.LongType()),
    T.StructField("raw", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
])


def to_master(events: DataFrame) -> DataFrame:
    """Good parsed rows (event, timestamp, ts, value) to the master layout."""
    cal = calendar_columns("ts")
    return events.select("event", "timestamp", cal["hour"].alias("hour"), cal["minute"].alias("minute"),
                         epoch_seconds("ts").alias("at"), F.col("value").alias("raw"), *[cal[c].alias(c) for c in PARTITION_COLUMNS])


def write_master(master: DataFrame, master_dir: str, mode: str = "append", clustered: bool = False) -> None:
    """One write for all input files.

    No shuffle: each task's rows are sorted by the partition columns and the event
    time, and the writer opens one file per day the task holds.  Landing input is already
    grouped by ingest day, so a task touches few day folders, and a hot day
    is spread over as many tasks as its input splits (no single-task day).
    ``clustered`` is for a backfill, whose tasks hold rows of many days and would
    write (tasks x days) small files: one shuffle by day, which AQE cuts into
    pieces of the advisory size (a hot day into several), bounds the files by the
    days and the bytes.
    ``overwrite`` replaces every day, also those absent from ``master``,
    whatever the session's overwrite mode.
    """
    rows = master.hint("rebalance", *PARTITION_COLUMNS) if clustered else master
    (rows.sortWithinPartitions(*PARTITION_COLUMNS, "at").write.mode(mode).option("partitionOverwriteMode", "static")
     .partitionBy(*PARTITION_COLUMNS).parquet(master_dir))


def ingest(spark: SparkSession, landing_dir: str, master_dir: str, mode: str = "append",
           rejects_dir: str | None = None, clustered: bool = False) -> None:
    """Landing JSON -> master Parquet in one job; rejects written aside if asked
    (a second scan: parsing is cheaper than keeping the raw rows)."""
    parsed = parse_raw(read_landing(spark, landing_dir))
    if rejects_dir is not None:
        reject_rows(parsed).write.mode(mode).parquet(rejects_dir)
    write_master(to_master(good_rows(parsed)), master_dir, mode=mode, clustered=clustered)


def ingest_stream(lines: DataFrame, master_dir: str, checkpoint: str,
                  available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Incremental landing -> master: each landing file is ingested once.

    The Parquet file sink keeps a commit log next to the data, so a replayed
    micro-batch does not append twice.
    """
    master = to_master(good_rows(parse_raw(lines)))
    writer = (master.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint)
              .option("path", master_dir)
              .partitionBy(*PARTITION_COLUMNS))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def reject_stream(lines: DataFrame, rejects_dir: str, checkpoint: str) -> StreamingQuery:
    """Rejected lines of new landing files, with their reasons."""
    return (reject_rows(parse_raw(lines)).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).option("path", rejects_dir)
            .trigger(availableNow=True).start())


def master_stream(spark: SparkSession, master_dir: str) -> DataFrame:
    """The files that ``ingest_stream`` commits, as a stream (each once)."""
    return (spark.readStream.schema(MASTER_SCHEMA).option("maxFileAge", MAX_FILE_AGE).parquet(master_dir))


def read_days(spark: SparkSession, master_dir: str, days: list[tuple[int, int, int]]) -> DataFrame:
    """The master rows of some (year, month, day) folders; no other is read."""
    wanted = reduce(lambda a, b: a | b, [
        (F.col("year") == y) & (F.col("month") == m) & F.col("day").isin(sorted(d for yy, mm, d in days if (yy, mm) == (y, m)))
        for y, m in sorted({(y, m) for y, m, _ in days})])
    return read_master(spark, master_dir).where(wanted)


def read_years(spark: SparkSession, master_dir: str, years: list[int]) -> DataFrame:
    """The master rows of some year folders."""
    return read_master(spark, master_dir).where(F.col("year").isin(years))


def read_master(spark: SparkSession, master_dir: str, left=None, right=None) -> DataFrame:
    """Master scan (S6) with optional [left, right) bounds on the event time.

    The bound is applied twice: on the day partitions (so whole folders are
    skipped) and on the stored event second (exact, raw times have whole seconds;
    it reaches the Parquet reader).
    """
    try:
        df = spark.read.schema(MASTER_SCHEMA).parquet(master_dir)
    except Exception as exc:  # missing folder -> empty master
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], MASTER_SCHEMA)
        raise
    if left is None and right is None:
        return df
    df = df.where(partition_bounds(left, right))
    if left is not None:
        df = df.where(F.col("at") >= epoch_bound(left))
    if right is not None:
        df = df.where(F.col("at") < epoch_bound(right))
    return df
