"""Data-quality reports, source coverage and retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoflume.functions.cols import c


def count_flags(df: DataFrame, preds: dict[str, Column]) -> DataFrame:
    """Conditional counts in one pass."""
    return df.agg(*[F.count_if(p).alias(n) for n, p in preds.items()])


def distinct_count(df: DataFrame, by: list[str], col: str, approx: bool = False) -> DataFrame:
    f = F.approx_count_distinct if approx else F.count_distinct
    return df.groupBy(*by).agg(f(col).alias("n_distinct"))


def rollout_counts(cat: DataFrame) -> DataFrame:
    """Catalogue counts: total, concrete, runnable, enabled, gated."""
    return count_flags(cat, {"total": F.lit(True), "concrete": c("catalog_kind") == "concrete", "runnable": c("transport_type") == "http", "enabled": c("enabled"), "gated": c("needs_credentials")})


def freshness(sources: DataFrame, raw: DataFrame, now, threshold_s: int = 600) -> DataFrame:
    """Seconds since each source's last fetch, and ok, stale or never."""
    last = raw.groupBy("source_id").agg(F.max("fetched_at").alias("last_fetch_at"))
    j = sources.select("source_id").join(last, "source_id", "left")
    age = F.floor((F.unix_millis(F.lit(now).cast("timestamp")) - F.unix_millis("last_fetch_at")) / 1000)
    reason = F.when(F.col("last_fetch_at").isNull(), "never").when(age > threshold_s, "stale").otherwise("ok")
    return j.select("source_id", "last_fetch_at", age.alias("freshness_seconds"), reason.alias("lag_reason"))


#: Cells of a histogram of `nth`, and distinct values of which the last pass may take one.
CELLS, FEW = 4096, 4096


def nth(df: DataFrame, col: str, ranks: list[int]) -> list[float]:
    """The values of the given ranks (from 0) among a column's numbers, exactly: histograms over a narrowing range.

    A pass counts CELLS cells before its shuffle and sends them to the driver;
    the range left is a cell or less. Doubles only; nulls don't count.
    """
    x = df.select(c(col).cast("double").alias("x")).where("x is not null")
    low, high = x.agg(F.min("x"), F.max("x")).first()
    out = []
    for rank in ranks:
        a, b, skip = low, high, 0
        while True:
            here = x.where(F.col("x").between(a, b))
            some = here.groupBy("x").agg(F.count("*").alias("n")).limit(FEW + 1).collect() if a == b or (b - a) / CELLS == 0 or a + (b - a) / CELLS == a else None
            width = (b - a) / CELLS
            if some is None:
                cells = here.groupBy(F.least(F.floor((F.col("x") - a) / width), F.lit(CELLS - 1)).alias("i")).agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")).orderBy("i").collect()
                some = [r for r in cells] if all(r["a"] == r["b"] for r in cells) else None
                if some is not None:
                    some = [{"x": r["a"], "n": r["n"]} for r in cells]
            if some is not None:
                for r in sorted(some, key=lambda r: r["x"]):
                    if rank < skip + r["n"]:
                        out.append(r["x"])
                        break
                    skip += r["n"]
                break
            for r in cells:
                if rank < skip + r["n"]:
                    a, b = r["a"], r["b"]
                    break
                skip += r["n"]
    return out


def lag_summary(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """Median (the mean of the middle two, rounded down), maximum, and the number over the threshold; a row of nulls and 0 if there is no number."""
    n = df.where(c(col).isNotNull()).count()
    middle = nth(df, col, sorted({(n - 1) // 2, n // 2})) if n else []
    median = F.floor(F.lit(sum(middle) / len(middle))) if middle else F.lit(None).cast("long")
    return df.where(c(col).isNotNull()).agg(F.max(col).alias("maximum"), F.count_if(c(col) > threshold).alias("over_threshold")).select(median.alias("median"), "maximum", "over_threshold")


def parse_quality(log: DataFrame, now, minutes: int = 15) -> DataFrame:
    """Total, successes and rate of the last minutes."""
    t = F.lit(now).cast("timestamp")
    x = log.where((c("at") <= t) & (F.unix_millis("at") > F.unix_millis(t) - minutes * 60000))
    return x.agg(F.count("*").alias("total"), F.count_if(c("status") == "success").alias("success"), F.coalesce(F.round(F.count_if(c("status") == "success") * 10000.0 / F.count("*"), 0) / 10000, F.lit(0.0)).alias("success_rate"))


def top_failures(log: DataFrame, n: int = 5) -> DataFrame:
    """The commonest failure classes with the least source as example."""
    return log.where("status <> 'success'").groupBy("failure").agg(F.count("*").alias("n"), F.min("source_id").alias("example_source")).orderBy(F.desc("n"), "failure").limit(n)


def open_work(jobs: DataFrame, frontier: DataFrame, queue: DataFrame) -> DataFrame:
    one = lambda df, kind, p: df.agg(F.count_if(p).alias("n")).select(F.lit(kind).alias("kind"), "n")
    return one(jobs, "running_jobs", c("status") == "running").union(one(frontier, "frontier_due", c("state") == "pending")).union(one(queue, "unresolved_open", c("state") == "open"))


def table_rows(dfs: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("table_name"), "n") for k, df in sorted(dfs.items())])


def terminal_catalog(dfs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Newest time and number of rows of each table."""
    return reduce(DataFrame.union, [df.agg(F.max(ts).alias("last_at"), F.count("*").alias("n")).select(F.lit(k).alias("table_name"), "last_at", "n") for k, (df, ts) in sorted(dfs.items())])


def output_counts(snapshots: DataFrame, hotspots: DataFrame, cross: DataFrame) -> DataFrame:
    one = lambda df, kind: df.agg(F.count("*").alias("n"), F.max("window_start").alias("last_window")).select(F.lit(kind).alias("kind"), "n", "last_window")
    return one(snapshots, "metric_snapshot").union(one(hotspots, "hotspot_snapshot")).union(one(cross, "cross_domain_snapshot"))


def apply_retention(df: DataFrame, ts: str, days: int, now, cond: Column | None = None) -> DataFrame:
    """Rows younger than the limit, and older ones that cond keeps from deletion."""
    old = F.unix_millis(ts) < F.unix_millis(F.lit(now).cast("timestamp")) - days * 86400000
    return df.where(~(old & cond) if cond is not None else ~old)


def drift_rate(df: DataFrame) -> DataFrame:
    return df.agg((F.round(F.avg(c("schema_drift_detected").cast("double")) * 10000, 0) / 10000).alias("schema_drift_rate"), F.count("*").alias("records"))


def source_coverage(sources: DataFrame, anchors: list[DataFrame], events: DataFrame, states: DataFrame) -> DataFrame:
    """Places and events per source over all anchors, and its state. anchors: source_id, place_id; states: source_id, coverage_state, reason."""
    both = reduce(DataFrame.union, [a.select("source_id", "place_id") for a in anchors]).where("place_id <> ''").groupBy("source_id").agg(F.count_distinct("place_id").alias("p"))
    ev = events.groupBy("source_id").agg(F.count_distinct("event_id").alias("e"))
    j = sources.join(both, "source_id", "left").join(ev, "source_id", "left").join(states, "source_id", "left")
    return j.select(
        F.concat("source_id", F.lit(":coverage")).alias("coverage_id"), "source_id", F.coalesce("p", F.lit(0)).alias("place_count"), F.coalesce("e", F.lit(0)).alias("event_count"),
        F.coalesce("coverage_state", F.lit("parsed_no_promotable_rows")).alias("coverage_state"), F.coalesce("reason", F.lit("")).alias("reason"),
    )


def coverage_summary(sources: DataFrame, summaries: dict[str, DataFrame], stamp: DataFrame) -> DataFrame:
    """Sources with one count column per summary (source_id, n) and the one row of `stamp`; the state is the first stage without rows."""
    j = sources
    for name, s in summaries.items():
        j = j.join(s.select("source_id", F.col("n").alias(name)), "source_id", "left")
    j = j.fillna(0, list(summaries)).join(F.broadcast(stamp.limit(1)), F.lit(True), "left")
    state = F.lit("complete")
    for name in reversed(list(summaries)):
        state = F.when(c(name) == 0, f"no_{name}").otherwise(state)
    return j.withColumn("coverage_state", state)


def route_sources(sources: DataFrame, matrix: list[tuple[str, list[str], str]]) -> DataFrame:
    """Shape and target of each source by the first row of the matrix (shape, tags, target) whose tags it has one of."""
    hit = F.lit(None).cast("struct<shape:string,target:string>")
    for shape, tags, target in reversed(matrix):
        hit = F.when(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])), F.struct(F.lit(shape).alias("shape"), F.lit(target).alias("target"))).otherwise(hit)
    return sources.withColumn("__h", hit).select("*", F.coalesce("__h.shape", F.lit("generic")).alias("shape"), F.coalesce("__h.target", F.lit("bronze")).alias("target")).drop("__h")
