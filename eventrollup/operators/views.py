"""Serving views stored as Parquet.

Batch view: ``event, bdate, at, count`` in folders ``grain=<name>/period=<year>``
(grain names, not the one-letter codes, so ``m`` and ``M`` never collide on a
case-insensitive store).  ``at`` is ``bdate`` in epoch seconds: files are sorted by
(event, bdate) and the reader skips row groups and pages by the statistics of
``event`` and ``at`` (those of a TIMESTAMP_NTZ it does not use).  ``bucket`` (the
code) is added back on read.

Speed view: the same rows as *partial* counts under ``partials/batch_id=<n>/``.
A micro-batch overwrites only its own folder, so a replayed batch id leaves the
totals unchanged; readers sum the partials (a counter column without a mutable
store).  Compaction writes the sum of all batches up to a committed id under
``compacted/upto=<n>/``, outside the folders a batch can write; readers take
the newest finished one and the partials after it, so a replay of a folded
batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventrollup.functions.buckets import (
    GRAIN_NAMES,
    bucket_code_for,
    bucket_start_for,
    check_grain,
    grain_name_for,
)
from eventrollup.functions.ranges import as_bound, epoch_bound, epoch_seconds
from eventrollup.session import child_names

KEY = ("event", "bucket", "bdate")
VIEW_SCHEMA = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("bdate", T.TimestampNTZType()),
    T.StructField("count", T.LongType()),
])
STORED_SCHEMA = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("bdate", T.TimestampNTZType()),
    T.StructField("at", T.LongType()),
    T.StructField("count", T.LongType()),
    T.StructField("grain", T.StringType()),
    T.StructField("period", T.IntegerType()),
])
PARTIALS_SCHEMA = T.StructType(list(STORED_SCHEMA.fields) + [
    T.StructField("batch_id", T.LongType())])


def _is_missing(exc: Exception) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


def _to_stored(view: DataFrame) -> DataFrame:
    return view.select("event", "bdate", epoch_seconds("bdate").alias("at"), F.col("count").cast("bigint").alias("count"),
                       grain_name_for("bucket").alias("grain"),
                       F.year("bdate").alias("period"))


def _from_stored(stored: DataFrame, with_period: bool = False) -> DataFrame:
    extra = ["period", "at"] if with_period else []
    return stored.select("event", bucket_code_for("grain").alias("bucket"), "bdate", "count", *extra)


def _grain_filter(codes: Sequence[str] | None):
    if codes is None:
        return None
    return F.col("grain").isin([GRAIN_NAMES[check_grain(c)] for c in codes])


def in_range(left=None, right=None) -> Column:
    """Stored rows with ``bdate`` in [left, right): year folders, statistics of
    ``at``, and the exact bound."""
    cond = F.lit(True)
    if left is not None:
        cond = cond & (F.col("bdate") >= as_bound(left)) & (F.col("at") >= epoch_bound(left)) & (F.col("period") >= F.year(as_bound(left)))
    if right is not None:
        cond = cond & (F.col("bdate") < as_bound(right)) & (F.col("at") < epoch_bound(right)) & (F.col("period") <= F.year(as_bound(right)))
    return cond


def parquet_writer(rows: DataFrame):
    """Writer of stored rows.  A point read skips the row groups whose bloom filter
    lacks its event.  Rows are sorted by event, so a row group holds few: the filter
    is sized for a thousand, about 2 KB."""
    return (rows.write.option("parquet.bloom.filter.enabled#event", "true")
            .option("parquet.bloom.filter.expected.ndv#event", "1000"))


# --- create / empty (S11) -----------------------------------------------------

def create_view(spark: SparkSession, path: str) -> None:
    """Create an empty view at ``path`` if there is none yet."""
    try:
        spark.read.schema(STORED_SCHEMA).parquet(path).limit(0).collect()
        return
    except Exception as exc:
        if not _is_missing(exc):
            raise
    empty_view(spark, path)


def empty_view(spark: SparkSession, path: str) -> None:
    """Truncate: overwrite with no rows (dynamic overwrite would keep old folders)."""
    (spark.createDataFrame([], STORED_SCHEMA).write.mode("overwrite")
     .option("partitionOverwriteMode", "static")
     .partitionBy("grain", "period").parquet(path))


# --- batch view write and read (S8, S12, O1) ---------------------------------

def write_view(view: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a full view; ``overwrite`` replaces it (idempotent rebuild).

    Rows are clustered by (grain, period) so a folder gets few files, then
    sorted by (event, bdate) inside each file for row-group skipping.  The
    ``rebalance`` hint lets AQE split a large (grain, period) partition into
    advisory-sized tasks, so a hot folder is never funnelled through one
    task; unlike a range repartition it needs no sampling pass (which would
    compute the whole roll-up a second time).
    """
    stored = _to_stored(view)
    (parquet_writer(stored.hint("rebalance", "grain", "period")
                    .sortWithinPartitions("grain", "period", "event", "bdate")).mode(mode).option("partitionOverwriteMode", "static")
     .partitionBy("grain", "period").parquet(path))


def read_view(spark: SparkSession, path: str, codes: Sequence[str] | None = None,
              events: Sequence[str] | None = None, left=None, right=None,
              with_period: bool = False) -> DataFrame:
    """Point/range read (S8): grains prune folders, the rest reaches Parquet filters.

    ``with_period`` keeps the year folder and the epoch second as columns, so the
    serving functions can prune folders, row groups and pages from the bounds of
    each query.
    """
    try:
        stored = spark.read.schema(STORED_SCHEMA).parquet(path)
    except Exception as exc:
        if _is_missing(exc):
            empty = spark.createDataFrame([], VIEW_SCHEMA)
            return empty.withColumn("period", F.lit(None).cast("int")).withColumn("at", F.lit(None).cast("bigint")) if with_period else empty
        raise
    cond = _grain_filter(codes)
    if cond is not None:
        stored = stored.where(cond)
    if events is not None:
        stored = stored.where(F.col("event").isin(list(events)))
    return _from_stored(stored.where(in_range(left, right)), with_period)


def stored_grains(spark: SparkSession, path: str) -> set[str]:
    """Codes of the grains that have a folder under ``path``."""
    codes = {name: code for code, name in GRAIN_NAMES.items()}
    return {codes[n.removeprefix("grain=")] for n in child_names(spark, path) if n.startswith("grain=")}


def check_floored(view: DataFrame) -> DataFrame:
    """Rows whose bdate is not the start of its bucket (D1 data-quality check)."""
    return view.where(F.col("bdate") != bucket_start_for("bucket", "bdate"))


# --- conditional upsert (S9, P17) --------------------------------------------

def changed_rows(new: DataFrame, old: DataFrame) -> DataFrame:
    """New rows whose count differs from the stored one, or that are absent.

    An equi-join on the full key (event, bucket, bdate): every key is unique
    on both sides, so there is no fan-out and no hot key.
    """
    o = old.select(*KEY, F.col("count").alias("old_count"))
    return (new.join(o, list(KEY), "left")
            .where(~F.col("count").eqNullSafe(F.col("old_count")))
            .select(*KEY, "count"))


def _folders(stored: DataFrame) -> list[tuple[str, int]]:
    return sorted(tuple(r) for r in stored.select("grain", "period").distinct().collect())


def _in_folders(folders: list[tuple[str, int]]):
    """Partition filter for some (grain, period) folders."""
    terms = [(F.col("grain") == g) & F.col("period").isin([p for gg, p in folders if gg == g])
             for g in sorted({g for g, _ in folders})]
    return reduce(lambda a, b: a | b, terms)


def upsert_view(spark: SparkSession, new: DataFrame, path: str) -> DataFrame:
    """Apply ``new`` to the stored view: set count where it differs, insert missing.

    Stored rows absent from ``new`` are kept, as an UPDATE never deletes.  Only
    the (grain, period) folders holding a change are rewritten (dynamic
    partition overwrite).  The merged rows are checkpointed first because
    they are read from the folders being overwritten.  Returns the changes.
    """
    create_view(spark, path)
    new = new.checkpoint()
    # Folders are named by five grains and calendar years: a short list.
    held = _folders(_to_stored(new))
    if not held:
        return new
    old_stored = spark.read.schema(STORED_SCHEMA).parquet(path).where(_in_folders(held))
    changes = changed_rows(new, _from_stored(old_stored)).checkpoint()
    touched = _folders(_to_stored(changes))
    if not touched:
        return changes
    kept = old_stored.where(_in_folders(touched)).join(
        _to_stored(changes).select("event", "bdate", "grain"), ["event", "bdate", "grain"], "left_anti")
    merged = kept.unionByName(_to_stored(changes)).checkpoint()
    (merged.hint("rebalance", "grain", "period")
     .sortWithinPartitions("grain", "period", "event", "bdate")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("grain", "period").parquet(path))
    return changes


# --- speed view partials (S10, A10, X2) --------------------------------------

def _partials(path: str) -> str:
    return f"{path.rstrip('/')}/partials"


def _compacted(path: str) -> str:
    return f"{path.rstrip('/')}/compacted"


def write_partials(counts: DataFrame, path: str, batch_id: int) -> None:
    """Store one micro-batch's counts under ``batch_id=<id>`` (replay-safe)."""
    stored = _to_stored(counts)
    (stored.sortWithinPartitions("grain", "period", "event", "bdate")
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("grain", "period").parquet(f"{_partials(path)}/batch_id={int(batch_id)}"))


def read_stored_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The counts one micro-batch stored."""
    return _from_stored(spark.read.schema(STORED_SCHEMA).parquet(f"{_partials(path)}/batch_id={int(batch_id)}"))


def compacted_upto(spark: SparkSession, path: str) -> int:
    """Highest batch id folded into a finished compaction, -1 if none."""
    done = [-1]
    for name in child_names(spark, _compacted(path)):
        if name.startswith("upto=") and "_SUCCESS" in child_names(spark, f"{_compacted(path)}/{name}"):
            done.append(int(name.removeprefix("upto=")))
    return max(done)


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Ids of the micro-batches that have partials, ascending."""
    names = child_names(spark, _partials(path))
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The newest compaction and the partials after it, each row with its batch id."""
    upto = compacted_upto(spark, path)
    try:
        rows = spark.read.schema(PARTIALS_SCHEMA).option("basePath", _partials(path)).parquet(_partials(path))
    except Exception as exc:
        if not _is_missing(exc):
            raise
        rows = spark.createDataFrame([], PARTIALS_SCHEMA)
    if upto < 0:
        return rows
    folded = spark.read.schema(STORED_SCHEMA).parquet(f"{_compacted(path)}/upto={upto}")
    return rows.where(F.col("batch_id") > upto).unionByName(folded.withColumn("batch_id", F.lit(upto).cast("bigint")))


def read_speed_view(spark: SparkSession, path: str, codes: Sequence[str] | None = None,
                    events: Sequence[str] | None = None, left=None, right=None,
                    with_period: bool = False) -> DataFrame:
    """Speed view = partial counts summed per key (the counter merge, A10).

    With ``with_period`` the year folder and the epoch second are kept (functions
    of ``bdate``, so grouping by them changes nothing) and a filter on them later
    reaches the partials through the aggregate.
    """
    parts = read_partials(spark, path)
    cond = _grain_filter(codes)
    if cond is not None:
        parts = parts.where(cond)
    if events is not None:
        parts = parts.where(F.col("event").isin(list(events)))
    parts = parts.where(in_range(left, right))
    keys = ["event", "grain", "period", "bdate", "at"] if with_period else ["event", "grain", "bdate"]
    summed = parts.groupBy(*keys).agg(F.sum("count").cast("bigint").alias("count"))
    return _from_stored(summed, with_period)


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """Highest micro-batch id that a stream's checkpoint has committed, -1 if none."""
    names = child_names(spark, f"{checkpoint.rstrip('/')}/commits")
    return max((int(n) for n in names if n.isdigit()), default=-1)


def compact_partials(spark: SparkSession, path: str, checkpoint: str) -> int:
    """Fold all batches that ``checkpoint`` has committed into one folder.

    A batch that may still be retried is never folded.  Returns the highest
    folded id.  Folded partials stay until the caller removes them.
    """
    upto, before = committed_batch(spark, checkpoint), compacted_upto(spark, path)
    if upto <= before:
        return before
    parts = read_partials(spark, path).where(F.col("batch_id") <= upto)
    summed = (parts.groupBy("event", "grain", "period", "bdate", "at")
              .agg(F.sum("count").cast("bigint").alias("count")))
    (summed.select(*STORED_SCHEMA.names).hint("rebalance", "grain", "period")
     .sortWithinPartitions("grain", "period", "event", "bdate")
     .write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("grain", "period").parquet(f"{_compacted(path)}/upto={upto}"))
    return upto


def empty_speed_view(spark: SparkSession, path: str) -> None:
    """Remove all partials and compactions of a speed view."""
    jvm = spark.sparkContext._jvm
    for folder in (_compacted(path), _partials(path)):
        hpath = jvm.org.apache.hadoop.fs.Path(folder)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
