"""The provided tables seen as event streams: (event STRING, ts TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# table -> (event column, timestamp column)
EVENT_COLUMNS = {
    "events": ("event_type", "ts"),
    "orders": ("o_orderpriority", "o_orderdate"),
    "lineitem": ("l_returnflag", "l_shipdate"),
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def event_frame(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    """Only the two columns the counts need, so the scan reads nothing else."""
    event_col, ts_col = EVENT_COLUMNS[table]
    return read_table(spark, sf_dir, table).select(
        F.col(event_col).alias("event"),
        F.col(ts_col).cast("timestamp_ntz").alias("ts"),
    )
