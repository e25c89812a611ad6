"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on; callers with their own session should
# keep the time zone pinned so that textual bounds mean the same instant.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Broadcast only on sizes measured at run time: the static planner
    # estimates aggregates from compressed file sizes, which can be far off.
    # AQE converts a join to a broadcast once a finished stage is below the
    # adaptive threshold, and keeps the shuffle join otherwise.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.ui.enabled": "false",
    # PySpark 4 records the Python call site of every column function for
    # error messages, one extra JVM round trip per call; the serving plans
    # build a few thousand column expressions each, so this is planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Starting points for a large cluster (about 100 TB of raw events, hundreds to
# thousands of executors).  Shuffles start wide and AQE coalesces them to the
# advisory size, so a partition fits in executor memory whether a stage
# carries raw-sized or roll-up-sized data; file splits are larger than the
# default to keep the task count of a full scan manageable; a shuffle
# partition several times the median is split by the skew join; streaming
# state (the windowed variant) lives in RocksDB instead of the JVM heap.
# ``spark.checkpoint.dir`` must name a shared folder and is left to the
# cluster's own configuration.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                app_name: str = "eventrollup", driver_memory: str | None = None,
                **extra: str) -> SparkSession:
    """A session with the library's defaults.

    Local masters (tests, bench) get ``shuffle_partitions`` and a large
    driver heap; any other master gets ``CLUSTER_CONF`` as well.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if master.startswith("local"):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
        # Local mode runs every task inside the driver JVM.
        conf["spark.driver.memory"] = driver_memory or "12g"
    else:
        conf.update(CLUSTER_CONF)
        if shuffle_partitions:
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
    # Local runs (tests, bench) only: a private folder under the system temp dir.
    root = tempfile.mkdtemp(prefix="eventrollup-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's checkpoint location for one job's files."""
    root = _checkpoint_root(spark).rstrip("/")
    return f"{root}/eventrollup/{name}-{uuid.uuid4().hex[:12]}"


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (empty if it does not
    exist), asked of the file system that serves it (HDFS, object store or
    local) through the session's Hadoop settings.  Listing only: no data."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath)]
