"""Helpers shared by the training-data operators: staging, components, words."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; without one, a local folder if the session is a local one, else an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="geoflume-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        jvm = df.sparkSession._jvm
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text binary), a null text as empty; whatever else df has is left out."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
    )


def words_of(text: bytes) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of UTF-8 bytes, A-Z in lower case."""
    return text.lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= _MIX_A
        x ^= x >> np.uint64(27)
        x *= _MIX_B
        x ^= x >> np.uint64(31)
    return x


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Components of the undirected edges (a, b) as rows (id, component_id): the smallest id reachable.

    Alternates large-star and small-star contraction until the edges stay the
    same. Only ids that have an edge to another id are returned.
    """
    norm = lambda df: df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stage(norm(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), name)
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = norm(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stage(norm(small.select("e.u", "e.v")), name)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    ends = now.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return ends.union(now.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
