"""Streaming versions of the jobs: late rows beyond the watermark go through the windows of ledger.py."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geoflume.sources.files import work_dir  # noqa: F401  (the streams' callers take it from here)
from geoflume.sources.ingest import ais_messages
from geoflume.streaming.tables import BucketTable, newest


#: How late a row may be.
DELAY = "1 day"


def read_stream(spark: SparkSession, path: str, schema, max_files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def stream_dedup(s: DataFrame, id_cols: list[str], ts: str, delay: str = DELAY) -> DataFrame:
    """Drops what was delivered before, within the watermark: the state stays bounded."""
    return s.withWatermark(ts, delay).dropDuplicatesWithinWatermark(id_cols)


def latest_table(spark: SparkSession, path: str, keys: list[str], version: str, buckets: int = 64) -> BucketTable:
    """The newest row per key, kept in buckets."""
    return BucketTable(spark, path, keys, newest(keys, version), buckets)


def start_ais_stream(spark: SparkSession, src: str, entities: str, points: str, checkpoint: str, trigger: dict | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Batches of messages -> latest entities and an append of track points. src: Parquet of raw_id, body, fetched_at."""
    raw = read_stream(spark, src, "raw_id string, body string, fetched_at timestamp")
    m = ais_messages(raw)
    how = trigger or {"processingTime": "5 seconds"}
    e = m.where("route = 'entity'").select("vessel_id", "name", "mmsi", "observed_at").writeStream.foreachBatch(lambda b, epoch: latest_table(b.sparkSession, entities, ["vessel_id"], "observed_at").merge(b, epoch)).option("checkpointLocation", f"{checkpoint}/entities").trigger(**how).start()
    p = m.where("route = 'track_point' and latitude is not null and longitude is not null")
    q = stream_dedup(p, ["record_key"], "observed_at").writeStream.format("parquet").option("path", points).option("checkpointLocation", f"{checkpoint}/points").outputMode("append").trigger(**how).start()
    return e, q


def stream_latest(s: DataFrame, path: str, keys: list[str], version: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Newest event time wins over re-deliveries."""
    return s.writeStream.foreachBatch(lambda b, epoch: latest_table(b.sparkSession, path, keys, version).merge(b, epoch)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_counts(s: DataFrame, ts: str, by: str, delay: str = DELAY, size: str = "1 hour") -> DataFrame:
    """Counts and sums per tumbling window; rows later than the watermark are left out."""
    return s.withWatermark(ts, delay).groupBy(F.window(ts, size).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("value_sum")).select(F.col("w.start").alias("window_start"), by, "n", "value_sum")


def track_sessions(s: DataFrame, ts: str = "observed_at", gap: str = "20 minutes", delay: str = DELAY) -> DataFrame:
    """Sessions of a track: a new one after a gap."""
    return s.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), "track_id").agg(F.count("*").alias("points")).select("track_id", F.col("w.start").alias("starts_at"), F.col("w.end").alias("ends_at"), "points")


def changed_windows(ledger: DataFrame, rows: DataFrame, since, until) -> DataFrame:
    """(source_id, table_name, window_start, window_end, n) of rows parsed in [since, until) whose window has no success in the ledger."""
    x = rows.where((F.col("parsed_at") >= F.lit(since).cast("timestamp")) & (F.col("parsed_at") < F.lit(until).cast("timestamp")))
    g = x.groupBy("source_id", "table_name", F.date_trunc("day", "parsed_at").alias("window_start")).agg(F.count("*").alias("n")).withColumn("window_end", F.col("window_start") + F.expr("interval 24 hours"))
    return g.join(ledger.where("status = 'success'").select("source_id", "table_name", "window_start"), ["source_id", "table_name", "window_start"], "left_anti")
