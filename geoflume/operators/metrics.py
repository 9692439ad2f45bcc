"""The metric chain: contributions, mergeable state, snapshots, hotspots, cross-domain scores."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoflume.functions.cols import broadcast_small, c, round4, weight
from geoflume.sources import files

WORLD = "plc:world"
#: Metric id, family, rollup rule, window grain.
REGISTRY = (
    ("obs_count", "activity", "sum", "day"),
    ("event_count", "activity", "sum", "day"),
    ("confidence_weighted_activity", "activity", "sum", "day"),
    ("entity_count_approx", "activity", "sum", "day"),
    ("source_count_approx", "activity", "sum", "day"),
    ("source_diversity_score", "quality", "distinct_sources_per_contribution", "day"),
    ("trend_24h", "trend", "sum", "24h"),
    ("trend_7d", "trend", "sum", "7d"),
    ("acceleration_7d_vs_30d", "trend", "sum", "30d"),
    ("geolocation_success_rate", "quality", "weighted_avg", "day"),
    ("dedup_rate", "quality", "weighted_avg", "day"),
    ("schema_drift_rate", "quality", "weighted_avg", "day"),
    ("cross_source_confirmation_rate", "quality", "weighted_avg", "day"),
    ("evidence_density", "quality", "weighted_avg", "day"),
    ("freshness_lag_minutes", "quality", "weighted_avg", "day"),
    ("burst_score", "activity", "weighted_avg", "day"),
    ("risk_composite_global", "risk", "weighted_avg", "day"),
    ("anomaly_zscore_30d", "risk", "weighted_avg", "30d"),
)
SUBJECT = ["metric_id", "subject_grain", "subject_id", "place_id", "window_grain", "window_start"]


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGISTRY, "metric_id string, metric_family string, rollup_rule string, window_grain string")


def with_family(df: DataFrame, reg: DataFrame) -> DataFrame:
    """df with the metric's family, or its id where the registry has none. The registry is a list of constants."""
    return df.join(broadcast_small(reg.select("metric_id", "metric_family")), "metric_id", "left").withColumn("metric_family", F.coalesce("metric_family", "metric_id"))


def window_of(ts: str | Column, grain: str) -> tuple[Column, Column]:
    """Start and end of the one window that a record enters."""
    if grain == "day":
        start = F.date_trunc("day", c(ts))
        return start, start + F.expr("interval 24 hours")
    end = F.date_trunc("hour" if grain == "24h" else "day", c(ts)) + F.expr("interval 1 hour" if grain == "24h" else "interval 24 hours")
    return end - F.expr({"24h": "interval 24 hours", "7d": "interval 168 hours", "30d": "interval 720 hours"}[grain]), end


def scopes(place="place_id", admin0="admin0_place_id", continent="continent_place_id") -> Column:
    """The distinct non-blank (grain, id) pairs that a record counts for."""
    pairs = [("place", c(place)), ("admin0", c(admin0)), ("continent", c(continent)), ("world", F.lit(WORLD))]
    made = F.array(*[F.struct(F.lit(g).alias("grain"), F.coalesce(x, F.lit("")).alias("id")) for g, x in pairs])
    return F.array_distinct(F.filter(made, lambda s: s["id"] != ""))


def _values() -> list[tuple[str, Column, Column, Column]]:
    """(metric, applies, value, weight); the two distinct-once metrics aren't among them."""
    one, active = F.lit(1.0), F.col("record_type").isin("observation", "event")
    flag = lambda x: c(x).cast("double")
    w = F.when(F.col("conf") == 0, 1.0).otherwise(F.col("conf"))
    burst = F.when(F.coalesce("burst_score", F.lit(0.0)) <= 0, w).otherwise(F.col("burst_score"))
    density = F.when(F.col("evidence_count") > 0, F.col("evidence_count")).otherwise(F.col("evidence_items")).cast("double")
    lag = F.greatest(F.lit(0.0), (F.unix_millis("occurred_at") - F.unix_millis("published_at")) / 60000.0)
    every = F.lit(True)
    return [
        ("obs_count", F.col("record_type") == "observation", one, one),
        ("event_count", F.col("record_type") == "event", one, one),
        ("confidence_weighted_activity", active, F.col("conf"), one),
        ("source_diversity_score", active, one, one),
        ("trend_24h", active, one, one),
        ("trend_7d", active, one, one),
        ("acceleration_7d_vs_30d", active, F.coalesce("acceleration_7d_vs_30d", F.lit(0.0)), one),
        ("geolocation_success_rate", every, flag("geolocation_succeeded"), one),
        ("evidence_density", every, density, one),
        ("dedup_rate", every, flag("deduplicated"), one),
        ("schema_drift_rate", every, flag("schema_drift_detected"), one),
        ("cross_source_confirmation_rate", every, flag(F.col("confirming_source_count") > 1), one),
        ("freshness_lag_minutes", F.col("published_at").isNotNull(), lag, one),
        ("burst_score", every, burst * w, w),
        ("risk_composite_global", every, F.greatest(F.coalesce("risk_score", F.lit(0.0)), F.lit(0.0)) * w, w),
        ("anomaly_zscore_30d", every, F.coalesce("anomaly_zscore_30d", F.lit(0.0)), one),
    ]


def _filled(x: str) -> Column:
    return F.coalesce(c(x), F.lit(""))


def _entity() -> Column:
    return F.when(_filled("entity_id") != "", F.col("entity_id")).when(_filled("record_id") != "", F.col("record_id")).otherwise(_filled("source_id"))


def _key() -> Column:
    return F.concat_ws("|", *SUBJECT[:5], F.unix_millis("window_start"))


def _weighed(records: DataFrame) -> DataFrame:
    """A row for each record, with its weight, its count of evidence and its scopes."""
    base = records.withColumn("conf", weight("confidence")).withColumn("occurred_at", F.timestamp_millis(F.unix_millis("occurred_at")))
    return base.withColumn("evidence_items", F.size("evidence") if "evidence" in records.columns else F.lit(0)).withColumn("scopes", scopes())


def _scoped(records: DataFrame) -> DataFrame:
    """A row for each record and scope, with the record's weight and count of evidence."""
    return _weighed(records).withColumn("scope", F.explode("scopes")).drop("scopes")


_PLACES = ["place_id", "admin0_place_id", "continent_place_id"]


def first_records(records: DataFrame, key: Column, start: Column) -> DataFrame:
    """(subject_grain, subject_id, window_start, k, f): the first record of each key that isn't blank, in a scope and window.

    The least of a struct is found by sorting, so records are first combined by the places that they name, before a row
    is made for each scope; what is left has a row per scope and combination of places, and is sorted once.
    """
    least = lambda x: F.min(x).alias("f")
    one = records.select(*_PLACES, start.alias("window_start"), key.alias("k"), F.struct("occurred_at", "record_id", "record_type", "source_id").alias("f")).where("k <> ''").groupBy(*_PLACES, "window_start", "k").agg(least("f"))
    keys = ["subject_grain", "subject_id", "window_start", "k"]
    each = one.select(F.explode(scopes()).alias("scope"), "window_start", "k", "f").select(F.col("scope.grain").alias("subject_grain"), F.col("scope.id").alias("subject_id"), "window_start", "k", "f")
    return each.repartition(*keys).groupBy(*keys).agg(least("f"))


def emit_contributions(records: DataFrame, only: tuple[str, ...] | None = None) -> DataFrame:
    """A row for each record, scope and metric (of `only`, else of all) that applies.

    entity_count_approx and source_count_approx count the first record (by
    occurred_at, record_id) of an entity or source in a scope and day (first_records).
    Values are computed for a record once, then repeated for its scopes.
    """
    grain = {m: g for m, _, _, g in REGISTRY}
    base = _weighed(records)
    starts = {g: window_of("occurred_at", g) for g in ("day", "24h", "7d", "30d")}
    made = F.array(
        *[
            F.when(use, F.struct(F.lit(m).alias("metric_id"), F.lit(grain[m]).alias("window_grain"), starts[grain[m]][0].alias("window_start"), starts[grain[m]][1].alias("window_end"), round4(v).alias("contribution_value"), round4(w).alias("contribution_weight")))
            for m, use, v, w in _values()
            if only is None or m in only
        ]
    )
    keep = ["record_id", "record_type", "source_id"]
    parts = []
    if only is None or any(m in only for m, *_ in _values()):
        plain = base.select(*keep, "scopes", F.explode(made).alias("m")).where("m is not null").select("m.*", *keep, F.explode("scopes").alias("scope"))
        parts.append(plain.select("*", F.col("scope.grain").alias("subject_grain"), F.col("scope.id").alias("subject_id")).drop("scope"))

    def once(metric: str, rows: DataFrame, key: Column) -> DataFrame:
        return first_records(rows, key, starts["day"][0]).select(
            F.lit(metric).alias("metric_id"), F.lit("day").alias("window_grain"), "window_start", (F.col("window_start") + F.expr("interval 24 hours")).alias("window_end"),
            F.lit(1.0).alias("contribution_value"), F.lit(1.0).alias("contribution_weight"), "f.record_id", "f.record_type", "f.source_id", "subject_grain", "subject_id",
        )

    for metric, rows, key in (("entity_count_approx", base.where(F.col("record_type").isin("observation", "event")), _entity()), ("source_count_approx", base, _filled("source_id"))):
        if only is None or metric in only:
            parts.append(once(metric, rows, key))
    out = reduce(DataFrame.unionByName, parts)
    out = out.withColumn("place_id", F.col("subject_id"))
    return out.withColumn("materialization_key", _key()).withColumn("contribution_id", F.concat_ws(":", F.lit("mc"), "metric_id", "subject_grain", "subject_id", "record_id", F.floor(F.unix_millis("window_start") / 1000)))


def build_state(contributions: DataFrame) -> DataFrame:
    """Mergeable aggregates per materialization key. The set of sources is exact."""
    return contributions.groupBy(*SUBJECT, "materialization_key").agg(
        F.max("window_end").alias("window_end"),
        F.count("*").alias("n"),
        F.sum("contribution_value").alias("value_sum"),
        F.sum("contribution_weight").alias("weight_sum"),
        F.max("contribution_value").alias("peak_value"),
        F.collect_set("source_id").alias("sources"),
        F.max(F.struct("window_end", "contribution_value")).alias("latest"),
    )


_GRAINS = {m: g for m, _, _, g in REGISTRY}
_SCOPE = ["subject_grain", "subject_id"]


def _metric_rows(g: DataFrame, names: list[str]) -> DataFrame:
    """Metric rows of wide sums; bit i of a source's mask says that metric i has it."""

    def row(i: int, m: str) -> Column:
        start, end = window_of("at", _GRAINS[m])
        bit = F.lit(1 << i).cast("long")
        have = F.transform(F.filter("src", lambda x: x["mask"].bitwiseAND(bit) != 0), lambda x: x["source_id"])
        parts = {"metric_id": F.lit(m), "window_grain": F.lit(_GRAINS[m]), "window_start": start, "window_end": end, "n": F.col(f"n{i}"), "value_sum": F.col(f"v{i}"), "weight_sum": F.col(f"w{i}"), "peak_value": F.col(f"p{i}"), "sources": have}
        return F.when(F.col(f"n{i}") > 0, F.struct(*[x.alias(k) for k, x in parts.items()]))

    made = F.array(*[row(i, m) for i, m in enumerate(names)])
    return g.select(*_SCOPE, F.explode(F.filter(made, lambda x: x.isNotNull())).alias("m")).select(*_SCOPE, "m.*")


def _first_rows(metric: str, records: DataFrame, key: Column, part: Callable[[Column], Column] | None = None) -> DataFrame:
    """Metric rows of the first records of a day's keys, and for each part those whose first record is of it."""
    first = first_records(records, key, F.date_trunc("day", "occurred_at")).withColumnRenamed("window_start", "at")
    at = ["at"]
    if part:
        first, at = first.withColumn("part", part(F.col("f.record_id"))), ["at", "part"]
    known = F.when(F.col("source_id").isNotNull(), F.struct("source_id", F.lit(1).cast("long").alias("mask")))
    g = first.groupBy(*_SCOPE, *at, "f.source_id").agg(F.count("*").alias("n0")).groupBy(*_SCOPE, *at).agg(F.sum("n0").alias("n0"), F.collect_list(known).alias("src"))
    return _metric_rows(g.withColumns({"v0": F.col("n0").cast("double"), "w0": F.col("n0").cast("double"), "p0": F.lit(1.0)}), [metric])


def _as_state(rows: list[DataFrame]) -> DataFrame:
    out = reduce(DataFrame.unionByName, rows)
    out = out.withColumn("place_id", F.col("subject_id")).withColumn("latest", F.struct("window_end", F.col("peak_value").alias("contribution_value")))
    return out.withColumn("materialization_key", _key()).select(*SUBJECT, "materialization_key", "window_end", "n", "value_sum", "weight_sum", "peak_value", "sources", "latest")


def state_of_records(records: DataFrame) -> DataFrame:
    """build_state(emit_contributions(records)), without a row per metric before the sums.

    Days fix the windows of all grains but the hourly one, so all metrics of a
    scope and day are summed side by side in an aggregate of numbers alone,
    which hashes and combines before its shuffle; metrics become rows after
    that. Sources come from a second such aggregate, which notes the metrics of
    a source as bits, and only an entity's first record needs a sorted one.
    """
    grain, scope = _GRAINS, _SCOPE
    values = [(m, use, round4(v), round4(w)) for m, use, v, w in _values()]
    base = _scoped(records).withColumn("subject_grain", F.col("scope.grain")).withColumn("subject_id", F.col("scope.id"))

    def with_sources(sums: DataFrame, sources: DataFrame) -> DataFrame:
        sources = sources.where("source_id is not null").groupBy(*scope, "at").agg(F.collect_list(F.struct("source_id", "mask")).alias("src"))
        return sums.join(sources, [*scope, "at"], "left").withColumn("src", F.coalesce("src", F.array().cast("array<struct<source_id:string,mask:long>>")))

    def wide(at: str, names: list[str]) -> DataFrame:
        took, day = [x for x in values if x[0] in names], base.withColumn("at", F.date_trunc(at, "occurred_at"))
        sums = day.groupBy(*scope, "at").agg(*[x for i, (_, use, v, w) in enumerate(took) for x in (F.count(F.when(use, 1)).alias(f"n{i}"), F.sum(F.when(use, v)).alias(f"v{i}"), F.sum(F.when(use, w)).alias(f"w{i}"), F.max(F.when(use, v)).alias(f"p{i}"))])
        bits = [F.when(use, F.lit(1 << i)).otherwise(0).cast("long") for i, (_, use, _, _) in enumerate(took)]
        order = [m for m, *_ in took]
        if "source_count_approx" in names:
            bits.append(F.when(_filled("source_id") != "", F.lit(1 << len(order))).otherwise(0).cast("long"))
        mask = bits[0]
        for x in bits[1:]:
            mask = mask.bitwiseOR(x)
        g = with_sources(sums, day.groupBy(*scope, "at", "source_id").agg(F.bit_or(mask).alias("mask")))
        if "source_count_approx" in names:
            i, n = len(order), F.size(F.filter("src", lambda x: x["source_id"] != ""))
            order.append("source_count_approx")
            g = g.withColumns({f"n{i}": n.cast("long"), f"v{i}": n.cast("double"), f"w{i}": n.cast("double"), f"p{i}": F.lit(1.0)})
        return _metric_rows(g, order)

    hourly = [m for m in grain if grain[m] == "24h"]
    daily = [m for m in grain if grain[m] != "24h" and m != "entity_count_approx"]
    entities = _first_rows("entity_count_approx", _weighed(records).where(F.col("record_type").isin("observation", "event")), _entity())
    return _as_state([wide("day", daily), wide("hour", hourly), entities])


def partial_states(records: DataFrame, part: Callable[[Column], Column] | None = None, without: tuple[str, ...] = ()) -> DataFrame:
    """States of the records' contributions for merge_state: one for each value of part, a function of record_id.

    All metrics are summed side by side by the places and source that the
    records name, before a row is made for each scope; then by scope. Which
    sources a metric has follows from its counts. So a scope's sum is one of
    sums, in another order than state_of_records has it: as near, but a mean
    that lies on a half of its last digit may turn the other way.
    """
    grain = {m: g for m, g in _GRAINS.items() if m not in without}
    values = [(m, use, round4(v), round4(w)) for m, use, v, w in _values() if m in grain]
    base, at = _weighed(records).drop("scopes"), ["at"]
    if part:
        base, at = base.withColumn("part", part(F.col("record_id"))), ["at", "part"]

    def wide(cut: str, names: list[str]) -> DataFrame:
        took = [x for x in values if x[0] in names]
        cols = [f"{x}{i}" for i in range(len(took)) for x in "nvwp"]
        added = [(F.max if x[0] == "p" else F.sum)(x).alias(x) for x in cols]
        one = base.withColumn("at", F.date_trunc(cut, "occurred_at")).groupBy(*_PLACES, *at, "source_id")
        one = one.agg(*[x for i, (_, use, v, w) in enumerate(took) for x in (F.count(F.when(use, 1)).alias(f"n{i}"), F.sum(F.when(use, v)).alias(f"v{i}"), F.sum(F.when(use, w)).alias(f"w{i}"), F.max(F.when(use, v)).alias(f"p{i}"))])
        each = one.select(F.explode(scopes()).alias("scope"), *at, "source_id", *cols).select(F.col("scope.grain").alias("subject_grain"), F.col("scope.id").alias("subject_id"), *at, "source_id", *cols)
        each = each.groupBy(*_SCOPE, *at, "source_id").agg(*added)
        mask = reduce(Column.__add__, [(F.col(f"n{i}") > 0).cast("long") * F.lit(1 << i) for i in range(len(took))])
        source = F.when(F.col("source_id").isNotNull(), F.struct("source_id", mask.cast("long").alias("mask")))
        return _metric_rows(each.groupBy(*_SCOPE, *at).agg(*added, F.collect_list(source).alias("src")), [m for m, *_ in took])

    summed = [m for m, *_ in values]
    cuts = (("day", [m for m in summed if grain[m] != "24h"]), ("hour", [m for m in summed if grain[m] == "24h"]))
    out = [wide(cut, names) for cut, names in cuts if names]
    for metric, recs, key in (("entity_count_approx", base.where(F.col("record_type").isin("observation", "event")), _entity()), ("source_count_approx", base, _filled("source_id"))):
        if metric in grain:
            out.append(_first_rows(metric, recs, key, part))
    return _as_state(out)


def merge_state(*states: DataFrame) -> DataFrame:
    """One state from partial states."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.groupBy(*SUBJECT, "materialization_key").agg(
        F.max("window_end").alias("window_end"),
        F.sum("n").alias("n"),
        F.sum("value_sum").alias("value_sum"),
        F.sum("weight_sum").alias("weight_sum"),
        F.max("peak_value").alias("peak_value"),
        F.array_distinct(F.flatten(F.collect_list("sources"))).alias("sources"),
        F.max("latest").alias("latest"),
    )


def finalize(state: DataFrame, reg: DataFrame) -> DataFrame:
    """metric_value by the registry's rule."""
    j = state.join(broadcast_small(reg.select("metric_id", "rollup_rule")), "metric_id")
    value = (
        F.when(F.col("rollup_rule") == "weighted_avg", F.when(F.col("weight_sum") == 0, 0.0).otherwise(F.col("value_sum") / F.col("weight_sum")))
        .when(F.col("rollup_rule") == "distinct_sources_per_contribution", F.when(F.col("n") == 0, 0.0).otherwise(F.size("sources") / F.col("n")))
        .when(F.col("rollup_rule").isin("latest", "latest_daily_pack_score"), F.col("latest.contribution_value"))
        .otherwise(F.col("value_sum"))
    )
    return j.withColumn("metric_value", round4(value))


def with_delta(df: DataFrame) -> DataFrame:
    w = Window.partitionBy("metric_id", "subject_grain", "subject_id", "window_grain").orderBy("window_start")
    return df.withColumn("metric_delta", round4(F.col("metric_value") - F.coalesce(F.lag("metric_value").over(w), F.lit(0.0))))


def ranked(df: DataFrame, keys: list[str], order: list, name: str = "rank") -> DataFrame:
    """df with each row's number within its keys, in the order, which must tell all rows of a key apart.

    Rows are dealt by range of keys and order; a task numbers its own rows of a
    key, and the counts of the key's earlier tasks are added. So no task holds a
    key's rows, however many. The dealt rows are written, since a second reading
    of the input might be cut elsewhere.
    """
    x = files.staged(df.repartitionByRange(*keys, *order).withColumn("__part", F.spark_partition_id()), "ranked")
    w = Window.partitionBy(*keys, "__part")
    before = x.groupBy(*keys, "__part").agg(F.count("*").alias("__n"))
    before = before.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))).drop("__n")
    mine = x.withColumn("__own", F.row_number().over(w.orderBy(*order)).cast("long")).alias("x")
    on = F.lit(True)
    for k in (*keys, "__part"):
        on = on & F.col(f"x.{k}").eqNullSafe(F.col(f"b.{k}"))
    j = mine.join(before.alias("b"), on)
    return j.select(*[F.col(f"x.{c}") for c in df.columns if c != name], (F.col("x.__own") + F.col("b.__before")).alias(name))


def with_rank(df: DataFrame) -> DataFrame:
    return ranked(df, ["metric_id", "subject_grain", "window_grain", "window_start"], [F.desc("metric_value"), F.asc("subject_id")])


def with_totals(df: DataFrame, keys: list[str], **aggs) -> DataFrame:
    """df with aggregates over all rows of the same keys; they combine before their shuffle and are joined back."""
    t = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    return df.join(t, keys)


def explain_json(df: DataFrame) -> DataFrame:
    attrs = F.to_json(F.struct(
        F.lit("registry->silver.metric_contribution->gold.metric_state->gold.metric_snapshot").alias("materialization_path"), F.col("rollup_rule"),
        F.struct(F.lit(True).alias("includes_confidence"), F.lit(True).alias("includes_feature_contributions"), F.lit(True).alias("includes_evidence_refs"), F.col("metric_id").alias("summary")).alias("explainability"),
    ))
    evidence = F.to_json(F.array(F.struct(F.lit("metric_registry").alias("kind"), F.col("metric_id").alias("ref"), F.lit("snapshot_support").alias("value"))))
    return df.withColumn("attrs", attrs).withColumn("evidence", evidence)


def build_snapshots(state: DataFrame, reg: DataFrame, now, rank: bool = True) -> DataFrame:
    """Values, deltas and ranks over the whole history; write only touched keys with versions.restrict_to. rank=False leaves the rank null."""
    s = with_delta(finalize(state, reg).select(*SUBJECT, "window_end", "materialization_key", "rollup_rule", "metric_value"))
    s = with_rank(s) if rank else s.withColumn("rank", F.lit(None).cast("long"))
    s = s.withColumn("snapshot_id", F.concat(F.lit("snapshot:"), "materialization_key")).withColumn("snapshot_at", F.lit(now).cast("timestamp"))
    return explain_json(s).select("snapshot_id", *SUBJECT, "window_end", "materialization_key", "snapshot_at", "metric_value", "metric_delta", "rank", "rollup_rule", "attrs", "evidence")


def latest_surface(snapshots: DataFrame) -> DataFrame:
    w = Window.partitionBy(*SUBJECT).orderBy(F.desc("snapshot_at"), F.desc("snapshot_id"))
    return snapshots.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def _share(value: Column, most: Column) -> Column:
    return F.when(most <= 0, 0.0).otherwise(F.least(value / most, F.lit(1.0)))


def hotspots(surface: DataFrame, reg: DataFrame) -> DataFrame:
    """Scores of 60 for value, 25 for rise and 15 for rank within metric, grain and window."""
    s = with_family(surface, reg).where("metric_value > 0 or metric_delta > 0").withColumn("rise", F.greatest("metric_delta", F.lit(0.0)))
    keys = ["metric_id", "subject_grain", "window_grain", "window_start"]
    s = ranked(s.select(*keys, "metric_family", "subject_id", "place_id", "metric_value", "rise"), keys, [F.desc("metric_value"), F.asc("subject_id"), F.asc("place_id")])
    s = with_totals(s, keys, most=F.max("metric_value"), rise_most=F.max("rise"), population_size=F.count("*"))
    rank_part = F.when(F.col("population_size") <= 1, 15.0).otherwise((1 - (F.col("rank") - 1) / (F.col("population_size") - 1)) * 15)
    score = _share(F.col("metric_value"), F.col("most")) * 60 + _share(F.col("rise"), F.col("rise_most")) * 25 + rank_part
    return s.select(
        F.concat_ws(":", F.lit("hotspot"), "metric_id", "subject_grain", "subject_id", "window_grain", F.unix_millis("window_start")).alias("hotspot_id"),
        "metric_id", "metric_family", F.col("subject_grain").alias("scope_type"), F.col("subject_id").alias("scope_id"), "place_id", "window_grain", "window_start", "rank", "population_size", round4(score).alias("hotspot_score"),
    )


def cross_domain(surface: DataFrame, reg: DataFrame) -> DataFrame:
    """Mean of the components of a subject's metrics, and 5 for each further domain, 10 at most."""
    s = with_family(surface, reg).where("metric_value > 0 or metric_delta > 0").withColumn("rise", F.greatest("metric_delta", F.lit(0.0)))
    s = with_totals(s, ["metric_id", "window_grain", "window_start"], most=F.max("metric_value"), rise_most=F.max("rise"))
    part = _share(F.col("metric_value"), F.col("most")) * 0.7 + _share(F.col("rise"), F.col("rise_most")) * 0.3
    s = s.withColumn("component", round4(part * 100))
    g = s.groupBy("subject_grain", "subject_id", "place_id", "window_grain", "window_start").agg(
        F.array_sort(F.collect_set("metric_family")).alias("domains"), F.array_sort(F.collect_set("metric_id")).alias("metric_ids"), (F.round(F.sum(F.round(F.col("component") * 10000, 0).cast("long")) / F.count("*"), 0) / 10000).alias("mean_component")
    )
    # the mean of whole ten-thousandths, so that a tie doesn't hang on the order of the sum
    bonus = F.least((F.size("domains") - 1) * 5.0, F.lit(10.0))
    return g.select(
        F.concat_ws(":", F.lit("cross"), "subject_grain", "subject_id", "place_id", "window_grain", F.unix_millis("window_start")).alias("cross_domain_id"),
        "subject_grain", "subject_id", "window_grain", "window_start", "domains", "metric_ids", round4(F.col("mean_component") + bonus).alias("composite_score"),
    )


def saturating_score(rows: DataFrame, keys: list[str], value: str, event_id: str, source: str, cap: float = 100) -> DataFrame:
    """Sum of non-negative values up to the cap, with the ids and sources behind it."""
    return rows.groupBy(*keys).agg(
        round4(F.least(F.lit(float(cap)), F.sum(F.greatest(c(value), F.lit(0.0))))).alias("score"), F.array_sort(F.collect_set(event_id)).alias("event_ids"), F.array_sort(F.collect_set(source)).alias("sources")
    )


def time_series(snapshots: DataFrame) -> DataFrame:
    """(point_id, series, time, value) of snapshots."""
    series = F.concat_ws("|", "metric_id", "subject_grain", "subject_id", "window_grain")
    return snapshots.select(F.concat_ws("@", series, F.unix_millis("window_start")).alias("point_id"), series.alias("series"), "window_start", "metric_value")


def rollup_places(snapshots: DataFrame, closure: DataFrame) -> DataFrame:
    """Values of a place summed into all of its ancestors."""
    j = snapshots.where("subject_grain = 'place'").join(closure, snapshots["place_id"] == closure["descendant_id"])
    return j.groupBy("metric_id", "window_grain", "window_start", "ancestor_id").agg(round4(F.sum("metric_value")).alias("metric_value"))


def backfill_explain(df: DataFrame) -> DataFrame:
    """attrs with an explainability part where there is none."""
    have = F.get_json_object("attrs", "$.explainability").isNotNull()
    part = F.concat(F.lit('"explainability":{"summary":"'), "metric_id", F.lit('"}}'))
    empty = F.trim(F.coalesce("attrs", F.lit(""))).isin("", "{}")
    return df.withColumn("attrs", F.when(have, F.col("attrs")).when(empty, F.concat(F.lit("{"), part)).otherwise(F.concat(F.regexp_replace("attrs", r"\}\s*$", ","), part)))
