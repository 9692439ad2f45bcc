"""The metric chain as streams: all 18 metrics, distinct-once ones from first records, and snapshots refreshed by timers.

Three queries share a folder. `sums` folds each batch's partial states into a
bucket table. `firsts` folds the first record of an entity or source, in the
places that it names and a day, into another; a later delivery of an earlier
record takes the place of the former first. Scopes count them when the state is
read. Both leave a tick when an epoch is finished; `refresh` reads ticks and
holds a timer per grain of windows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from geoflume.operators import metrics
from geoflume.streaming.tables import BucketTable

ONCE = ("entity_count_approx", "source_count_approx")
#: Seconds between refreshes of a grain's snapshots.
CADENCE = {"day": 900, "24h": 3600, "7d": 3600, "30d": 3600}
#: Buckets of each table.
BUCKETS = 64
#: Buckets of the table of first records.
SHARES = 64
_FIRST = ["metric_id", *metrics._PLACES, "day", "k"]
_RECORD = ["at", "record_id", "record_type", "source_id"]


def _with_state_store(spark: SparkSession) -> None:
    """Processors with keyed state need RocksDB, which also keeps state out of the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def once_per_record(records: DataFrame, delay: str | None = None) -> DataFrame:
    """Records without repeated deliveries. With a delay, only ids of that time are remembered, and later records are dropped."""
    return records.withWatermark("occurred_at", delay).dropDuplicatesWithinWatermark(["record_id"]) if delay else records.dropDuplicates(["record_id"])


def _first_of(df: DataFrame) -> DataFrame:
    """The least (at, record_id, record_type, source_id) of each key; a fold."""
    return df.groupBy(*_FIRST).agg(F.min(F.struct(*_RECORD)).alias("f")).select(*_FIRST, *[F.col(f"f.{x}").alias(x) for x in _RECORD])


def _candidates(records: DataFrame) -> DataFrame:
    """What may be the first record of an entity or source on a day, among those that name the same places: a row for a record and metric, none for a scope."""
    pair = lambda m, k, use: F.when(use & (k != ""), F.struct(F.lit(m).alias("metric_id"), k.alias("k")))
    made = F.array(pair(ONCE[0], metrics._entity(), F.col("record_type").isin("observation", "event")), pair(ONCE[1], metrics._filled("source_id"), F.lit(True)))
    x = metrics._weighed(records).select(F.explode(F.filter(made, lambda x: x.isNotNull())).alias("m"), *[metrics._filled(c).alias(c) for c in (*metrics._PLACES, "record_id", "record_type")], "occurred_at", F.coalesce("source_id", F.lit("\0")).alias("source_id"))
    return x.select("m.metric_id", *metrics._PLACES, F.unix_micros(F.date_trunc("day", "occurred_at")).alias("day"), "m.k", F.unix_micros("occurred_at").alias("at"), *_RECORD[1:])


class Cadence(StatefulProcessor):
    """A row for a grain when its refresh is due: at once if the last one is older than the cadence, else by a timer then."""

    def __init__(self, seconds: dict[str, float]):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, waiting boolean")

    def _due(self, grain: str, at: int):
        import pandas as pd

        self.last.update((at, False))
        return pd.DataFrame({"window_grain": [grain], "at": [at]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        for _ in rows:
            pass
        now, wait = timerValues.getCurrentProcessingTimeInMs(), int(self.seconds[key[0]] * 1000)
        last, waiting = tuple(self.last.get()) if self.last.exists() else (None, False)
        if last is None or now >= last + wait:
            yield self._due(key[0], now)
        elif not waiting:
            self.last.update((last, True))
            self.handle.registerTimer(last + wait)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        yield self._due(key[0], timerValues.getCurrentProcessingTimeInMs())

    def close(self) -> None:
        pass


def _fold_state(df: DataFrame) -> DataFrame:
    return metrics.merge_state(df).select(*_STATE)


_STATE = [*metrics.SUBJECT, "materialization_key", "window_end", "n", "value_sum", "weight_sum", "peak_value", "sources", "latest"]


def sums_table(spark: SparkSession, path: str) -> BucketTable:
    return BucketTable(spark, f"{path}/sums", ["materialization_key"], _fold_state, BUCKETS)


def firsts_table(spark: SparkSession, path: str) -> BucketTable:
    return BucketTable(spark, f"{path}/firsts", _FIRST, _first_of, SHARES)


def snapshots_table(spark: SparkSession, path: str) -> BucketTable:
    """The last refresh of each grain's snapshots; the parts of a row that only the last refresh can have (rank) are its own."""
    from geoflume.streaming.tables import newest

    return BucketTable(spark, f"{path}/snapshots", ["snapshot_id"], newest(["snapshot_id"], "snapshot_at"), BUCKETS)


def _tick(spark: SparkSession, path: str, name: str, epoch: int) -> None:
    """One small file for an epoch; written again, it is the same epoch's."""
    spark.createDataFrame([(g, epoch) for g in CADENCE], "window_grain string, epoch long").coalesce(1).write.mode("overwrite").parquet(f"{path}/ticks/from={name}/epoch={epoch}")


def start_sums(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, delay: str | None = None) -> StreamingQuery:
    """The sixteen metrics that add up."""

    _with_state_store(records.sparkSession)

    def fold(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist(StorageLevel.DISK_ONLY)  # else the state of record ids is gone through for each of its readers
        try:
            sums_table(spark, path).merge(metrics.partial_states(batch, without=ONCE), epoch)
        finally:
            batch.unpersist()
        _tick(spark, path, "sums", epoch)

    return once_per_record(records, delay).writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def start_firsts(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The two metrics that count a key once. Repeated and late records need no memory of their own: the first stays the first."""

    def fold(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        firsts_table(spark, path).merge(_candidates(batch), epoch)
        _tick(spark, path, "firsts", epoch)

    return records.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def start_refresh(spark: SparkSession, path: str, checkpoint: str, trigger: dict | None = None, cadence: dict[str, float] = CADENCE, now=None) -> StreamingQuery:
    """Snapshots of a grain are built anew from the whole state when it has changed and its time has come."""
    _with_state_store(spark)
    ticks = spark.readStream.schema("window_grain string, epoch long").option("recursiveFileLookup", "true").parquet(f"{path}/ticks")
    due = ticks.groupBy("window_grain").transformWithStateInPandas(Cadence(cadence), "window_grain string, at long", "Append", "ProcessingTime")

    def build(batch: DataFrame, epoch: int) -> None:
        s = batch.sparkSession
        grains = [r["window_grain"] for r in batch.select("window_grain").distinct().collect()]  # four at most
        state = metric_state(s, path)
        if grains and state is not None:
            snap = metrics.build_snapshots(state.where(F.col("window_grain").isin(*grains)), metrics.registry(s), now or F.current_timestamp())
            snapshots_table(s, path).merge(snap, epoch)

    return due.writeStream.foreachBatch(build).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "30 seconds"})).start()


def metric_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The state of all metrics as of the last finished epochs, as metrics.state_of_records has it."""
    sums, firsts = sums_table(spark, path).read(), firsts_table(spark, path).read()
    if firsts is not None:
        scope = ["subject_grain", "subject_id", "metric_id", "day"]
        each = firsts.select(F.explode(metrics.scopes()).alias("scope"), "metric_id", "day", "k", F.struct(*_RECORD).alias("f"))
        each = each.select(F.col("scope.grain").alias("subject_grain"), F.col("scope.id").alias("subject_id"), "metric_id", "day", "k", "f").groupBy(*scope, "k").agg(F.min("f").alias("f"))
        f = each.groupBy(*scope, "f.source_id").agg(F.count("*").alias("n"))
        f = f.groupBy(*scope).agg(F.sum("n").alias("n"), F.collect_list(F.when(F.col("source_id") != "\0", F.col("source_id"))).alias("sources"))
        start, one = F.timestamp_micros("day"), F.lit(1.0)
        f = f.withColumns({"place_id": F.col("subject_id"), "window_grain": F.lit("day"), "window_start": start, "window_end": start + F.expr("interval 24 hours"), "value_sum": F.col("n").cast("double"), "weight_sum": F.col("n").cast("double"), "peak_value": one})
        f = f.withColumn("latest", F.struct("window_end", F.col("peak_value").alias("contribution_value"))).withColumn("materialization_key", metrics._key()).select(*_STATE)
        sums = f if sums is None else sums.unionByName(f)
    return sums
