"""Landing zone: raw JSON event lines grouped by ingest day.

Raw events are JSON lines ``{"event": "...", "timestamp": "yyyy-MM-dd HH:mm:ss"}``.
They arrive from a topic (Kafka) or any text stream, are written as text files
under ``<landing>/ingest_day=<yy-MM-dd>/``, and are read back recursively,
skipping files still being written (``*.tmp``).  Parsing never raises: lines
that are not JSON, lack a field or carry a bad timestamp go to a rejects
frame with a reason instead of becoming a null event type.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventrollup.functions.ranges import try_parse_timestamp

# Raw event format and landing layout.
RAW_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
INGEST_DAY_FORMAT = "yy-MM-dd"
IN_PROGRESS_SUFFIX = ".tmp"
# Far beyond any retention: no landing file is skipped for its age.
MAX_FILE_AGE = "36500d"
# The whole text of a raw timestamp: a wall-clock time without zone or offset.
RAW_TS_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

RAW_SCHEMA = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])
LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])
REJECT_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("reason", T.StringType()),
])


def to_raw_json(df: DataFrame, event: str = "event", ts: str = "ts") -> DataFrame:
    """Render (event, ts) rows as raw JSON lines, the producer's record shape."""
    return df.select(F.to_json(F.struct(
        F.col(event).alias("event"),
        F.date_format(F.col(ts), RAW_TS_FORMAT).alias("timestamp"),
    )).alias("value"))


def _with_ingest_day(lines: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    when = ingest_ts if ingest_ts is not None else F.current_timestamp()
    return lines.select("value", F.date_format(when, INGEST_DAY_FORMAT).alias("ingest_day"))


def land_batch(lines: DataFrame, landing_dir: str, ingest_ts: Column | None = None) -> None:
    """Append raw lines to the landing zone, one directory per ingest day."""
    (_with_ingest_day(lines, ingest_ts)
     .write.mode("append").partitionBy("ingest_day").text(landing_dir))


def topic_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "latest") -> DataFrame:
    """Raw lines from a Kafka topic, key dropped (S7, P13).  Needs the Kafka connector."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
            .selectExpr("CAST(value AS STRING) AS value"))


def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                clean_source: str | None = None, archive_dir: str | None = None,
                max_file_age: str = MAX_FILE_AGE) -> DataFrame:
    """Raw lines from files appearing under ``path`` (stand-in for a topic in tests).

    ``clean_source`` = ``delete`` or ``archive`` removes consumed files once
    their batch commits (S5); the checkpoint makes each file count once.
    Files still being written (``*.tmp``) give no rows; under their final name
    they are new files and are read then.  ``max_file_age`` is how far a file's
    time may lie behind the newest one: Spark's own default of a week would
    skip files that are delivered late.
    """
    reader = (spark.readStream.schema(LINE_SCHEMA).option("recursiveFileLookup", "true")
              .option("maxFileAge", max_file_age))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    return reader.text(path).where(_finished()).select("value")


def _finished() -> Column:
    return ~F.col("_metadata.file_name").endswith(IN_PROGRESS_SUFFIX)


def land_stream(lines: DataFrame, landing_dir: str, checkpoint: str,
                processing_time: str | None = "5 seconds", available_now: bool = False) -> StreamingQuery:
    """Roll a stream of raw lines into landing files by ingest day."""
    writer = (_with_ingest_day(lines).writeStream.format("text")
              .option("checkpointLocation", checkpoint)
              .partitionBy("ingest_day")
              .option("path", landing_dir))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_landing(spark: SparkSession, landing_dir: str) -> DataFrame:
    """All finished landing files under ``landing_dir`` (S2); a missing folder is empty.

    The predicate on ``_metadata.file_name`` prunes in-progress files when
    the folder is listed, so they are never opened (the scan's file count
    leaves them out), rather than filtering their rows after a read.
    """
    try:
        lines = (spark.read.schema(LINE_SCHEMA)
                 .option("recursiveFileLookup", "true")
                 .text(landing_dir))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], LINE_SCHEMA)
        raise
    return lines.where(_finished()).select("value")


def parse_raw(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse raw lines into (value, event, timestamp, ts, reason).

    ``reason`` is null for good rows.  ``ts`` is TIMESTAMP_NTZ: the raw text
    is a wall-clock time, so no time zone is applied, and any other form (a
    date alone, an offset, a fraction) is a bad timestamp.
    """
    parsed = F.from_json(F.col(value), RAW_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    df = lines.select(F.col(value).alias("value"), parsed.alias("p"))
    ts = F.when(F.col("p.timestamp").rlike(RAW_TS_PATTERN), try_parse_timestamp(F.col("p.timestamp")))
    reason = (F.when(F.col("p").isNull() | F.col("p._corrupt_record").isNotNull(), F.lit("malformed json"))
              .when(F.col("p.event").isNull(), F.lit("missing event"))
              .when(F.col("p.timestamp").isNull(), F.lit("missing timestamp"))
              .when(ts.isNull(), F.lit("bad timestamp")))
    return df.select(
        "value",
        F.col("p.event").alias("event"),
        F.col("p.timestamp").alias("timestamp"),
        ts.alias("ts"),
        reason.alias("reason"),
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select("event", "timestamp", "ts", "value")


def reject_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNotNull()).select("value", "reason")


def read_events(spark: SparkSession, landing_dir: str) -> tuple[DataFrame, DataFrame]:
    """(good events, rejects) from the landing zone; both lazy, one scan each."""
    parsed = parse_raw(read_landing(spark, landing_dir))
    return good_rows(parsed), reject_rows(parsed)
