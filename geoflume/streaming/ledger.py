"""Promotion runs over windows of changed rows: each window once, whatever fails in between.

A window is keyed by source, table, mode and bounds. A run claims its windows in
the ledger, publishes their rows under the run's token, and marks them. A run
that stops anywhere leaves claims; the next run finishes those first, under
their own bounds and token, so rows that were published already don't come again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoflume.functions.cols import blank
from geoflume.sources.ingest import stage_then_publish
from geoflume.streaming.tables import BucketTable, newest

_KEY = ["source_id", "table_name"]
_WINDOW = ["checkpoint_id", *_KEY, "mode", "window_start", "window_end"]


def changes(parses: DataFrame, fetches: DataFrame, registry: DataFrame) -> DataFrame:
    """(source_id, table_name, changed_at) of parses that succeeded and of fetches of enabled HTTP sources that have a table.

    parses: source_id, table_name, parsed_at, status. fetches: source_id, fetched_at, success. registry: source_id, table_name, transport_type, enabled.
    """
    p = parses.where("status = 'success'").select(*_KEY, F.col("parsed_at").alias("changed_at"))
    on = registry.where((F.col("transport_type") == "http") & F.col("enabled") & ~blank("table_name")).select(*_KEY)
    f = fetches.where("success").join(on, "source_id").select(*_KEY, F.col("fetched_at").alias("changed_at"))
    return p.unionByName(f).where(~blank("source_id") & ~blank("table_name") & F.col("changed_at").isNotNull())


def windows(changed: DataFrame, until, start=None, end=None, done: DataFrame | None = None) -> DataFrame:
    """A window for each changed source and table: since the last success of its own (delta), or [start, end) where something changed (range).

    done: the ledger. A delta window begins with the first change at or after the
    greatest end of the delta windows that the ledger has for the source and table.
    """
    if (start is None) != (end is None):
        raise ValueError("a range needs both bounds")
    if start is not None:
        a, b = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
        g = changed.where((F.col("changed_at") >= a) & (F.col("changed_at") < b)).select(*_KEY).distinct().select(*_KEY, F.lit("range").alias("mode"), a.alias("window_start"), b.alias("window_end"))
        g = g.where("window_start < window_end")
    else:
        b = F.lit(until).cast("timestamp")
        x = changed.where(F.col("changed_at") < b)
        if done is not None:
            last = done.where("mode = 'delta'").groupBy(*_KEY).agg(F.max("window_end").alias("__last"))
            x = x.join(last, _KEY, "left").where(F.col("__last").isNull() | (F.col("changed_at") >= F.col("__last")))
        g = x.groupBy(*_KEY).agg(F.min("changed_at").alias("window_start")).select(*_KEY, F.lit("delta").alias("mode"), "window_start", b.alias("window_end"))
    parts = F.concat_ws("\0", F.trim("source_id"), F.trim("table_name"), "mode", F.unix_micros("window_start"), F.unix_micros("window_end"))
    return g.select(F.substring(F.sha2(parts, 256), 1, 32).alias("checkpoint_id"), *g.columns)


class Ledger:
    """The runs' windows with status (running, success), attempts and counted rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, BucketTable(spark, path, ["checkpoint_id"], newest(["checkpoint_id"], "record_version"), 16)

    def read(self) -> DataFrame:
        """checkpoint_id, source_id, table_name, mode, window_start, window_end, run_id, status, attempts, input_rows, at, record_version."""
        have = self.table.read()
        schema = "checkpoint_id string, source_id string, table_name string, mode string, window_start timestamp, window_end timestamp, run_id string, status string, attempts int, input_rows long, at timestamp, record_version long"
        return self.spark.createDataFrame([], schema) if have is None else have

    def put(self, rows: DataFrame) -> None:
        """A state of windows. The checkpoint's later state has the greater record_version."""
        self.table.merge(rows, self.table.last()[0] + 1)


def selected(rows: DataFrame, wins: DataFrame) -> DataFrame:
    """The rows whose parsed_at lies in a window of their source and table, with its checkpoint_id. rows: source_id, table_name, parsed_at."""
    j = rows.join(wins.select("checkpoint_id", *_KEY, "window_start", "window_end"), _KEY)
    return j.where((F.col("parsed_at") >= F.col("window_start")) & (F.col("parsed_at") < F.col("window_end"))).drop("window_start", "window_end")


def _finish(ledger: Ledger, rows: DataFrame, work: Callable[[DataFrame], DataFrame], target: str, now, step: Callable[[str], None]) -> int:
    """Publish and mark every claimed run."""
    open_ = ledger.read().where("status = 'running'")
    runs = sorted(r["run_id"] for r in open_.select("run_id").distinct().collect())  # one, but for a claim made while another run was at work
    for run in runs:
        wins = ledger.read().where((F.col("status") == "running") & (F.col("run_id") == run))
        took = selected(rows, wins)
        stage_then_publish(work(took), target, run)
        step("written")
        counts = took.groupBy("checkpoint_id").agg(F.count("*").alias("__n"))
        done = wins.join(counts, "checkpoint_id", "left").withColumns({"status": F.lit("success"), "input_rows": F.coalesce("__n", F.lit(0).cast("long")), "at": F.lit(now).cast("timestamp"), "record_version": F.col("record_version") + 1}).drop("__n")
        ledger.put(done)
        step("marked")
    return len(runs)


def run(ledger: Ledger, rows: DataFrame, changed: DataFrame, work: Callable[[DataFrame], DataFrame], target: str, now, start=None, end=None, step: Callable[[str], None] = lambda _: None) -> int:
    """Finish what an earlier run left, then claim, write and mark the windows that changed; the number of runs finished.

    Windows with a success are left out. step is told of every step done (claimed, written, marked).
    """
    n = _finish(ledger, rows, work, target, now, step)
    have = ledger.read()
    new = windows(changed, now, start, end, have).join(have.where("status = 'success'").select("checkpoint_id"), "checkpoint_id", "left_anti")
    before = have.select("checkpoint_id", F.col("attempts").alias("__a"), F.col("record_version").alias("__v"))
    claim = new.join(before, "checkpoint_id", "left").select(
        *_WINDOW, F.lit(uuid.uuid4().hex).alias("run_id"), F.lit("running").alias("status"), (F.coalesce("__a", F.lit(0)) + 1).alias("attempts"), F.lit(0).cast("long").alias("input_rows"), F.lit(now).cast("timestamp").alias("at"),
        (F.coalesce("__v", F.lit(0).cast("long")) + 1).alias("record_version"),
    )
    ledger.put(claim)
    step("claimed")
    return n + _finish(ledger, rows, work, target, now, step)
