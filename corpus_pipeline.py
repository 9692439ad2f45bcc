"""A training corpus from documents: quality, near copies, benchmark leaks, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. run() writes each stage's rows to the shared folder and reads them back.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoflume.llm import crf_quality, decontaminate, ngram_join, packing, pii
from geoflume.llm.common import stage

#: Bytes of texts that Spark puts into one batch for Python; by its own bound of 10,000 rows a batch is tens of MB, held on both sides by every task.
BATCH_BYTES = 4 << 20


def small_batches(f):
    """The stage f with batches of about BATCH_BYTES; the session keeps that setting, as the stage's rows are made later."""

    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return f(spark, docs, sf_dir)

    return run_stage


@small_batches
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose lines the classifier finds bad, rows without text among them; without labels of both kinds all rows have one score."""
    model = crf_quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(text):
        return text.map(lambda t: crf_quality.score(held.value, t) >= 0.5).astype(bool)

    return docs.where(good(F.coalesce(F.col("text").cast("binary"), F.lit(b""))))


@small_batches
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose five-word shingles have Jaccard similarity 0.8 or more, the smallest doc_id stays."""
    groups = ngram_join.ngram_components(docs, n=5, num=4, den=5)
    gone = groups.where("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")


@small_batches
def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, re-parameterised ones included."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@small_batches
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that reveal it; n_chars is that of the new text."""
    out = pii.sanitise(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(out.schema["n_chars"].dataType))


@small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining documents into sequences of 4096 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near copies", near_copies), ("benchmark leaks", leaks), ("personal data", personal_data), ("packing", pack)]

#: No SQL: the classifier is trained and the tokens come from a tokenizer. Tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, f) in enumerate(STAGES):
        docs = f(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"corpus-{k}")
    return docs
