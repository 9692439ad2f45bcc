"""Small files beside tables: markers that say which data files count. They go through Hadoop's file systems, as the tables do."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession, name: str = "stream") -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; without it a local one if the session is local, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="geoflume-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """df written to a work folder and read back: what its rows hold, a task's number too, stays what it is."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there. Hidden and unfinished ones are left out."""
    fs, p = _at(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(x for x in found if not x.startswith((".", "_")))


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def put(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole or not at all; False if it is there already."""
    fs, p = _at(spark, path)
    if fs.exists(p):
        return False
    _, half = _at(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = fs.create(half, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.rename(half, p):
        return True
    fs.delete(half, False)
    return False


def get(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()
