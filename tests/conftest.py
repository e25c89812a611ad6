import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from eventrollup.session import get_session

    s = get_session("local[8]", 8)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventrollup-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="eventrollup-test-")


def events_df(spark, rows):
    """(event, 'yyyy-MM-dd HH:mm:ss') pairs -> DataFrame(event, ts NTZ)."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "event string, t string")
    return df.select("event", F.col("t").cast("timestamp_ntz").alias("ts"))
