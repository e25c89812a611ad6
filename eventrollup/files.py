"""Small files and folder listings through the session's Hadoop file systems.

Only names, times and short control files pass through the driver, never data.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def entries(spark: SparkSession, path: str) -> dict[str, float]:
    """Names directly under ``path`` with their modification time in seconds;
    empty if there is no such folder."""
    hpath, fs = _at(spark, path)
    if not fs.exists(hpath):
        return {}
    return {st.getPath().getName(): st.getModificationTime() / 1000 for st in fs.listStatus(hpath)}


def files_below(spark: SparkSession, path: str) -> Iterator[tuple[str, int]]:
    """(path, bytes) of the files below ``path``, one by one."""
    hpath, fs = _at(spark, path)
    if not fs.exists(hpath):
        return
    found = fs.listFiles(hpath, True)
    while found.hasNext():
        st = found.next()
        yield st.getPath().toString(), st.getLen()


def read_text(spark: SparkSession, path: str) -> str:
    hpath, fs = _at(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a new file; fails if it exists, so two writers cannot both have it.

    The text is written beside its place first and renamed, so a reader sees the
    whole file or none.
    """
    hpath, fs = _at(spark, path)
    part = hpath.suffix(".part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(hpath) or not fs.rename(part, hpath):
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; one that is gone already is no error."""
    hpath, fs = _at(spark, path)
    fs.delete(hpath, True)
