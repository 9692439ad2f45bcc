"""Promotion of parsed rows to facts, entities and the unresolved queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoflume.functions.cols import band, blank, c, canonical_id, non_blank, stable_id
from geoflume.operators.versions import latest_version

MIN_CONFIDENCE = 0.75
CONFIDENCE_BANDS = [(0.9, "high"), (0.75, "medium")]


def build_bronze_rows(cand: DataFrame, now) -> DataFrame:
    """Bronze columns of candidate records: key by native id, else content hash; time by observed, occurred, starts."""
    t = lambda *xs: F.coalesce(*[c(x).cast("timestamp") for x in xs])
    return cand.select(
        "raw_id", "source_id", "parser_id", "parser_version", F.coalesce(non_blank("native_id"), F.col("content_hash")).alias("source_record_key"), "source_record_index", "record_kind", "native_id", "content_hash",
        t("observed_at", "occurred_at", "starts_at").alias("occurred_at"), F.lit(now).cast("timestamp").alias("parsed_at"), F.unix_millis(F.lit(now).cast("timestamp")).alias("record_version"), "payload_json",
    )


def bronze_to_input(bronze: DataFrame) -> DataFrame:
    """Promotion input; a place id in the payload resolves the location with confidence 1."""
    place = non_blank(F.get_json_object("payload_json", "$.place_id"))
    return bronze.select(
        "source_id", "raw_id", "record_kind", F.col("source_record_key").alias("native_id"), "occurred_at", "parsed_at", "source_record_index",
        F.coalesce(place, F.lit("")).alias("place_id"), place.isNotNull().alias("resolved"), F.when(place.isNotNull(), 1.0).otherwise(0.0).alias("location_confidence"),
        F.get_json_object("payload_json", "$.name").alias("name"), F.get_json_object("payload_json", "$.value").cast("double").alias("value"), F.get_json_object("payload_json", "$.entity_id").alias("entity_ref"),
    )


def promote(inputs: DataFrame, now, min_conf: float = MIN_CONFIDENCE) -> dict[str, DataFrame]:
    """observations, events, entities, unresolved and rejects; ids don't depend on the raw document, the last input of an id wins."""
    bad = blank("source_id") | blank("native_id") | ~F.col("record_kind").isin("observation", "event", "entity")
    ok = inputs.where(~F.coalesce(bad, F.lit(True)))
    located = F.col("resolved") & (F.col("location_confidence") >= min_conf)
    facts = ok.where(located & (F.col("record_kind") != "entity")).withColumn("record_id", stable_id("record_kind", "source_id", "native_id", F.unix_millis("occurred_at")))
    facts = latest_version(facts, ["record_id"], ["parsed_at", "raw_id", "source_record_index"])
    ents = ok.where((F.col("record_kind") == "entity") | ~blank("entity_ref")).withColumn("entity_id", canonical_id("ent", "source_id", F.coalesce(non_blank("entity_ref"), F.col("native_id"))))
    reason = F.when(F.col("resolved"), "low_confidence").otherwise("no_match")
    queue = ok.where(~located & (F.col("record_kind") != "entity")).select(
        stable_id(F.lit("unresolved"), "source_id", "native_id").alias("queue_id"), "source_id", "native_id", reason.alias("reason"), "location_confidence",
        band("location_confidence", [(0.65, "70"), (0.3, "50")], "90").cast("int").alias("priority"), F.lit(now).cast("timestamp").alias("first_failed_at"),
    )
    return {
        "observations": facts.where("record_kind = 'observation'").withColumn("confidence_band", band("location_confidence", CONFIDENCE_BANDS, "low")),
        "events": facts.where("record_kind = 'event'").withColumn("confidence_band", band("location_confidence", CONFIDENCE_BANDS, "low")),
        "entities": merge_entities(ents),
        "unresolved": latest_version(queue, ["queue_id"], "location_confidence"),
        "rejects": inputs.where(F.coalesce(bad, F.lit(True))),
    }


def merge_entities(rows: DataFrame) -> DataFrame:
    """One row per entity: the first non-blank value in the order parsed_at desc, raw_id, index; all sources, sorted."""
    order = F.struct((-F.unix_millis("parsed_at")).alias("t"), "raw_id", "source_record_index")
    first = lambda x: F.coalesce(F.min_by(x, F.when(~blank(x), order)), F.lit("")).alias(x)
    return rows.groupBy("entity_id").agg(first("name"), first("place_id"), F.min("occurred_at").alias("valid_from"), F.max("parsed_at").alias("updated_at"), F.array_sort(F.collect_set("source_id")).alias("source_ids"), F.count("*").alias("inputs"))


def envelope(df: DataFrame, kind: str, data: list[str]) -> DataFrame:
    """Generic record: id by native id or content hash, the strategy, the hash, and the data as JSON."""
    body = F.to_json(F.struct(*data))
    return df.select(
        canonical_id(kind, "source_id", "native_id", body).alias("id"), F.when(blank("native_id"), "content_hash").otherwise("native_id").alias("id_strategy"), F.lit(kind).alias("kind"), "source_id", F.sha2(body, 256).alias("content_hash"), F.lit(1).alias("schema_version"), body.alias("data"),
    )


def documents_to_parse(raw: DataFrame, ledger: DataFrame, parser: str, now) -> DataFrame:
    """Documents without a ledger row of the parser, or whose retry is due."""
    led = ledger.where(F.col("parser_id") == parser).select("raw_id", "status", "next_retry_at")
    return raw.join(led, "raw_id", "left").where(F.col("status").isNull() | ((F.col("status") == "retry") & (F.col("next_retry_at") <= F.lit(now).cast("timestamp")))).drop("status", "next_retry_at")


def parse_ledger(results: DataFrame, prev: DataFrame, now, max_attempts: int = 3) -> DataFrame:
    """Ledger rows after a run: success, retry in attempts squared times five minutes, or dead letter."""
    p = prev.select("raw_id", "parser_id", F.col("attempts").alias("__n"))
    n = F.coalesce("__n", F.lit(0)) + 1
    t = F.unix_millis(F.lit(now).cast("timestamp"))
    j = results.join(p, ["raw_id", "parser_id"], "left").withColumn("attempts", n).drop("__n")
    status = F.when(F.col("ok"), "success").when(F.col("attempts") >= max_attempts, "dead_letter").otherwise("retry")
    return j.withColumn("status", status).withColumn("next_retry_at", F.when(F.col("status") == "retry", F.timestamp_millis(t + (F.pow(F.col("attempts"), 2) * 300_000).cast("long")))).select("raw_id", "parser_id", "attempts", "status", "next_retry_at")
