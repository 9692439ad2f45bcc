"""Versioned rows: newest per key, idempotent replacement, insertion of what is absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoflume.functions.cols import broadcast_small


def latest_version(df: DataFrame, keys: list[str], version: str | list[str]) -> DataFrame:
    """One row per key, of the greatest version; ties by all other columns, so the result is always the same."""
    order = [version] if isinstance(version, str) else version
    rest = [c for c in df.columns if c not in (*keys, *order)]
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*order, *rest)])
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def latest_by(df: DataFrame, keys: list[str], cols: list[str], version: str) -> DataFrame:
    """The value of each column at the greatest version per key: aggregated before the shuffle, without a sort."""
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(version, *cols)).alias("b"))
    return best.select(*keys, *[F.col(f"b.{c}").alias(c) for c in cols])


def upsert(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """base without the keys of new, and new: running it twice changes nothing more."""
    return base.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def insert_if_absent(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new whose keys target doesn't have, one per key."""
    return latest_version(new.join(target.select(*keys).distinct(), keys, "left_anti"), keys, keys[0])


def restrict_to(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose tuple of keys is wanted. A few wanted tuples are broadcast: by a shuffle, all rows of a tuple would go to one task."""
    return df.join(broadcast_small(wanted.select(*keys).distinct()), keys, "left_semi")


def named_version(df: DataFrame, name: str, version: str | None = None) -> DataFrame:
    """The row of a name at a version, or its newest."""
    rows = df.where(F.col("name") == name)
    return rows.where(F.col("version") == version) if version is not None else latest_version(rows, ["name"], "version")


def merge_candidates(old: DataFrame, new: DataFrame, now) -> DataFrame:
    """New or changed candidates (by checksum) with the next version; a review given earlier stays."""
    o = old.select("candidate_id", F.col("checksum").alias("o_sum"), F.col("record_version").alias("o_version"), F.col("review_status").alias("o_status"))
    j = new.join(o, "candidate_id", "left").where(F.col("o_sum").isNull() | (F.col("o_sum") != F.col("checksum")))
    return j.select(
        *[F.col(c) for c in new.columns if c not in ("record_version", "review_status", "updated_at")],
        (F.coalesce("o_version", F.lit(0)) + 1).alias("record_version"),
        F.coalesce("o_status", F.lit("pending")).alias("review_status"),
        F.lit(now).cast("timestamp").alias("updated_at"),
    )


def backfill_marking(entities: DataFrame, sources: DataFrame) -> DataFrame:
    """Entities whose marking is blank or differs from their source's default, with the default and the next version."""
    j = entities.join(broadcast_small(sources.select("source_id", F.col("default_marking").alias("__d"))), "source_id", "left")
    changed = j.where(F.col("__d").isNotNull() & (F.coalesce("marking", F.lit("")) != F.col("__d")))
    return changed.withColumn("marking", F.col("__d")).withColumn("record_version", F.col("record_version") + 1).drop("__d")
