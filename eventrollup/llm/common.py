"""Helpers shared by the operators: scratch tables, text batches, global positions."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup import files
from eventrollup.session import work_dir

# Text bytes handled at once inside a task; a single longer text is one batch.
BATCH_BYTES = 1024 * 1024


def read_input(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Named columns of a given table (extra columns are never read)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


# Folders that ``store`` wrote inside a ``recorded`` call, until they are released.
_RECORDED: list[str] = []
_recording = False


def recorded(make, *args):
    """``make(*args)``; the folders it stores can be released once its result has
    been written elsewhere."""
    global _recording
    outer, _recording = _recording, True
    try:
        return make(*args)
    finally:
        _recording = outer


def release(spark: SparkSession) -> None:
    """Delete the recorded folders: nothing that reads them may be pending."""
    while _RECORDED:
        files.delete(spark, _RECORDED.pop())


def store(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared checkpoint folder and
    return a reader of it: the lineage ends at files every executor can read."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    if _recording:
        _RECORDED.append(path)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def discard(*stored: DataFrame) -> None:
    """Delete the folders of frames that ``store`` returned: whatever reads them
    must have been stored itself."""
    for df in stored:
        files.delete(df.sparkSession, df._folder)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application,
    so that tasks import it on machines where the repository is not installed."""
    sc = spark.sparkContext
    if getattr(sc, "_eventrollup_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    # The driver's own folder: Spark copies the file to the executors itself.
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="eventrollup-ship-")), "eventrollup.zip")
    Path(path).write_bytes(buf.getvalue())
    sc.addPyFile(path)
    sc._eventrollup_shipped = True


# What a worker process keeps between its tasks: one model at most.
_RESIDENT: dict[str, object] = {}


def resident(name: str, make: Callable[[], object]):
    """The model of that name, made once per worker process.  A worker that goes on
    to another model, or calls ``vacate``, drops it: workers live as long as their
    executor, and the models of all operators together would fill it."""
    if name not in _RESIDENT:
        vacate()
        _RESIDENT[name] = make()
    return _RESIDENT[name]


def vacate() -> None:
    """Drop the model of this worker process and hand back the memory that earlier
    tasks have left free."""
    if _RESIDENT:
        _RESIDENT.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):     # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut incoming Arrow batches into runs of rows whose ``text`` totals at
    most ``max_bytes`` (one row at least), without copying."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        size = np.array(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.cumsum(size)
        at = 0
        while at < n:
            base = ends[at] - size[at]
            to = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def with_position(df: DataFrame, order: list, name: str, position: str = "position") -> DataFrame:
    """Add each row's place (from 0) in the order of ``order`` over ALL rows.

    The rows are dealt by range, sorted inside their partitions and stored with
    (partition, index) taken from ``monotonically_increasing_id``; the starts of
    the partitions are the running sum of one row per partition, so no task
    sees more than its share and only that per-partition table is broadcast
    (one row per shuffle partition, whatever the input size).
    """
    local = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("__id", local)
    dealt = dealt.withColumn("__part", F.shiftright("__id", 33).cast("int")) \
        .withColumn("__idx", F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))).drop("__id")
    stored = store(dealt, name)
    starts = partition_starts(stored.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")))
    return stored.join(F.broadcast(starts), "__part") \
        .withColumn(position, F.col("__start") + F.col("__idx")) \
        .drop("__part", "__idx", "__start")


def partition_starts(counts: DataFrame) -> DataFrame:
    """(__part, __n) -> (__part, __start): running totals before each partition.

    One row per shuffle partition, so the totals are summed on the driver:
    a bound set by the cluster's configuration, not by the data.
    """
    rows = sorted((r["__part"], r["__n"]) for r in counts.collect())
    out, total = [], 0
    for part, n in rows:
        out.append((part, total))
        total += n
    return counts.sparkSession.createDataFrame(out, "__part int, __start bigint")
