"""Domain scores: maritime, space, geopolitical and safety."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoflume.functions.cols import band, blank, broadcast_small, c, canonical_id, clamp, hours, non_blank, percent, round4, round8, weight
from geoflume.operators.metrics import saturating_score


# maritime


def ais_dark_hours_sum(gaps: DataFrame) -> DataFrame:
    """Sum, longest and number of closed gaps with a length."""
    g = gaps.withColumn("h", hours("starts_at", "ends_at")).where("h > 0")
    return g.groupBy("entity_id").agg(round4(F.sum("h")).alias("metric_value"), round4(F.max("h")).alias("longest_gap_hours"), F.count("*").alias("gap_count"))


def port_gap_hours(calls: DataFrame, gaps: DataFrame) -> DataFrame:
    """Hours from the latest gap that ended before a call (its next port blank or the call's place) to the call, summed.

    Gaps without a next port may match any call of the entity, the others only
    calls at their port: two merges in time order, one by entity and one by
    entity and port, so no key's calls and gaps are paired.
    """
    def latest(left: DataFrame, right: DataFrame, by: list[str], name: str) -> DataFrame:
        r = right.select(*by, F.col("ends_at").alias("t"), F.lit(0).alias("side"), F.col("ends_at").alias("g"))
        low = left.select(*by, F.col("started_at").alias("t"), F.lit(-1).alias("side"), F.lit(None).cast("timestamp").alias("g"), "call_id", "started_at", *[x for x in left.columns if x not in (*by, "call_id", "started_at")])
        both = r.unionByName(low, allowMissingColumns=True)
        # at one time the call stands before the gap, as the gap must have ended earlier
        w = Window.partitionBy(*by).orderBy("t", "side").rowsBetween(Window.unboundedPreceding, -1)
        return both.withColumn(name, F.last("g", ignorenulls=True).over(w)).where("side = -1").drop("t", "side", "g")

    cl = calls.select("call_id", "entity_id", "place_id", "started_at")
    blank_port = blank("next_known_port_id")
    a = latest(cl, gaps.where(blank_port), ["entity_id"], "g1")
    b = latest(a, gaps.where(~blank_port).withColumn("place_id", F.col("next_known_port_id")), ["entity_id", "place_id"], "g2")
    m = b.withColumn("gap_end", F.greatest("g1", "g2")).where("gap_end is not null").withColumn("h", round4(hours("gap_end", "started_at")))
    return m.groupBy("entity_id").agg(round4(F.sum("h")).alias("metric_value"), F.count("*").alias("matched_calls"))


def anchorage_dwell_hours(calls: DataFrame) -> DataFrame:
    text = F.lower(F.concat_ws(" ", *[x for x in ("port_name", "terminal", "berth") if x in calls.columns]))
    return calls.where(text.contains("anchorage") & (F.col("ended_at") > F.col("started_at"))).groupBy("entity_id").agg(round4(F.sum(hours("started_at", "ended_at"))).alias("metric_value"), F.count("*").alias("stays"))


def flag_registry_mismatch(signals: DataFrame) -> DataFrame:
    differ = ~blank("registry_flag_state") & ~blank("observed_flag_state") & (F.upper(F.trim(c("registry_flag_state"))) != F.upper(F.trim(c("observed_flag_state"))))
    return signals.select("entity_id", round4(F.when(differ, 0.7).otherwise(0.0) + 0.3 * F.least(F.col("flag_changes_90d") / 3.0, F.lit(1.0))).alias("metric_value"))


def shadow_fleet_score(signals: DataFrame) -> DataFrame:
    """Weighted sum of nine signals, each cut to 0..1."""
    parts = [
        (F.col("ais_dark_hours") / 24, 0.22), (F.col("ais_gap_frequency") / 6, 0.10), (F.col("flag_changes_90d") / 3, 0.12), (F.col("ownership_changes_180d") / 2, 0.12), (c("sanctions_exposure"), 0.18),
        (F.col("high_risk_port_calls") / 4, 0.10), (c("sts_suspicion_score"), 0.08), (c("route_deviation_score"), 0.05), (F.greatest(F.col("vessel_age_years") - 15, F.lit(0)) / 20, 0.03),
    ]
    total = F.lit(0.0)
    for x, w in parts:
        total = total + weight(x) * w
    return signals.select("entity_id", round4(total).alias("metric_value"))


def route_deviation_score(signals: DataFrame) -> DataFrame:
    return signals.select("entity_id", round4(weight("route_deviation_score")).alias("metric_value"))


def field_changes(states: DataFrame, by: str, order: str, fields: list[str]) -> DataFrame:
    """(by, order, field, old_value, new_value) where a watched field differs from the state before."""
    w = Window.partitionBy(by).orderBy(order)
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.lag(c(f).cast("string")).over(w).alias("old_value"), c(f).cast("string").alias("new_value")) for f in fields])
    s = states.select(by, order, F.row_number().over(w).alias("n"), pairs.alias("p"))
    return s.where("n > 1").select(by, order, F.explode("p").alias("p")).select(by, order, "p.*").where("not (old_value <=> new_value)")


def fingerprint(fields: list[str]) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(c(f).cast("string"), F.lit("")) for f in fields]), 256)


def route_plans(b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plan rows, and one row per waypoint with its number and arrival time (0 is none). b: route_id, entity_id, waypoints array<struct<lat,lon,eta_s>>."""
    plan = b.select("route_id", "entity_id", F.size("waypoints").alias("waypoint_count"))
    way = b.select("route_id", F.posexplode("waypoints").alias("sequence", "w")).select("route_id", (F.col("sequence") + 1).alias("sequence"), "w.lat", "w.lon", F.when(F.col("w.eta_s") != 0, F.timestamp_seconds("w.eta_s")).alias("arrives_at"))
    return plan, way


def port_code(x) -> Column:
    """Upper case letters and digits only; five characters, else blank."""
    v = F.regexp_replace(F.upper(c(x)), "[^A-Z0-9]", "")
    return F.when(F.length(v) == 5, v).otherwise("")


def degrees_of(x) -> Column:
    """Degree-minute text, such as 5130N or 00005W, in degrees."""
    d = F.regexp_extract(c(x), r"^(\d{2,3})(\d{2})([NSEW])$", 1).cast("double") + F.regexp_extract(c(x), r"^(\d{2,3})(\d{2})([NSEW])$", 2).cast("double") / 60
    return F.when(F.regexp_extract(c(x), r"([NSEW])$", 1).isin("S", "W"), -d).otherwise(d)


def port_places(csv: DataFrame) -> DataFrame:
    """Place rows of a port list: country, location, name, coordinates as 'lat lon' degree-minute text."""
    code = port_code(F.concat("country", "location"))
    out = csv.withColumn("code", code).where("code <> ''")
    parts = F.split(F.trim(c("coordinates")), r"\s+")
    return out.select(F.concat(F.lit("plc:port:"), F.lower(F.concat_ws("-", "country", "location"))).alias("place_id"), "code", "name", round4(degrees_of(parts[0])).alias("latitude"), round4(degrees_of(F.get(parts, 1))).alias("longitude"))


def country_by_prefix(df: DataFrame, table: DataFrame, col: str = "mmsi") -> DataFrame:
    """Country by an identifier's first three digits; else the flag, else blank. The table of prefixes has a thousand rows at most."""
    j = df.withColumn("__p", F.substring(col, 1, 3)).join(broadcast_small(table.select(F.col("prefix").alias("__p"), F.col("country").alias("__c"))), "__p", "left")
    return j.withColumn("country", F.coalesce("__c", non_blank("flag_state") if "flag_state" in df.columns else F.lit(None), F.lit(""))).drop("__p", "__c")


def maritime_vessels(v: DataFrame) -> DataFrame:
    """Vessel rows: id by the first known of native id, IMO, MMSI, call sign, name; aliases without repeats."""
    key = non_blank("native_id", "imo", "mmsi", "call_sign", "name")
    names = F.array_distinct(F.filter(F.transform(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda x: F.trim(x)), lambda x: x != ""))
    return v.select(canonical_id("ent", "source_id", key).alias("entity_id"), F.coalesce("name", F.lit("")).alias("name"), names.alias("aliases"), "imo", "mmsi")


def maritime_calls(v: DataFrame) -> DataFrame:
    done = F.col("ended_at").isNotNull()
    return v.select("call_id", "entity_id", "place_id", F.when(done, "completed").otherwise("open").alias("status"), round4(F.when(done, F.greatest(hours("started_at", "ended_at"), F.lit(0.0))).otherwise(0.0)).alias("dwell_hours"))


# space


def overpass_density(windows: DataFrame, horizon_hours: float) -> DataFrame:
    return windows.groupBy("place_id").agg(round4(F.count("*") * 24.0 / horizon_hours).alias("metric_value"), F.count("*").alias("pass_count"), F.count_distinct("satellite_id").alias("satellite_count"))


def revisit_capability(windows: DataFrame, coverage: DataFrame, horizon_hours: float) -> DataFrame:
    sats = windows.groupBy("place_id").agg(F.count_distinct("satellite_id").alias("sats"))
    return sats.join(coverage, "place_id").select("place_id", round4(clamp((1 - F.col("largest_gap_hours") / horizon_hours) * 70 + F.least(F.col("sats") * 15.0, F.lit(30.0)), 0, 100)).alias("metric_value"))


def conjunction_risk(advisories: DataFrame) -> DataFrame:
    severity = round4(0.6 * clamp(F.col("probability") / 0.001, 0, 1) + 0.4 * (1 - clamp(F.col("miss_distance_km") / 25, 0, 1)))
    return advisories.groupBy("satellite_id").agg(round4(F.avg(severity)).alias("metric_value"), F.count("*").alias("advisory_count"), round4(F.min("miss_distance_km")).alias("closest_miss_distance_km"), round8(F.avg("probability")).alias("mean_probability"))


def decay_parts(altitude, bstar, motion) -> Column:
    return F.least(F.abs(c(bstar)) * 1e6, F.lit(60.0)) + F.greatest(F.lit(0.0), 450 - c(altitude)) * 0.12 + clamp((c(motion) - 12) * 5, 0, 20)


def orbital_decay(elements: DataFrame, altitude: DataFrame) -> DataFrame:
    """elements: satellite_id, mean_motion_rev_per_day, bstar; altitude: satellite_id, altitude_km samples."""
    m = altitude.groupBy("satellite_id").agg(F.avg("altitude_km").alias("alt"))
    j = elements.join(m, "satellite_id", "left").fillna(0, ["alt"])
    return j.select("satellite_id", round4(clamp(decay_parts("alt", "bstar", "mean_motion_rev_per_day"), 0, 100)).alias("metric_value"))


def json_number(attrs, *keys: str) -> Column:
    """The first of the keys that holds a number, else 0."""
    return F.coalesce(*[F.get_json_object(c(attrs), f"$.{k}").try_cast("double") for k in keys], F.lit(0.0))


def maneuver_frequency(elements: DataFrame) -> DataFrame:
    m = json_number("attrs", "maneuver_count_30d", "maneuvers_30d", "planned_maneuver_count")
    f = json_number("attrs", "thruster_firings_7d", "recent_thruster_firings")
    return elements.select("satellite_id", percent(m * 18 + f * 4).alias("metric_value"))


def satellite_health(elements: DataFrame, decay: DataFrame) -> DataFrame:
    """elements: satellite_id, attrs JSON, transmitters array<string> of status."""
    or_else = lambda x, d: F.when(x == 0, float(d)).otherwise(x)
    up, bat = or_else(json_number("attrs", "uptime_pct"), 92), or_else(json_number("attrs", "battery_margin_pct", "power_margin_pct"), 80)
    bad, own = json_number("attrs", "anomaly_count_30d", "anomalies_30d"), json_number("attrs", "health_score", "satellite_health_index")
    active = F.size(F.filter("transmitters", lambda s: F.lower(F.trim(s)).isin("", "active", "nominal", "online")))
    tw = F.when(F.size("transmitters") > 0, active / F.size("transmitters") * 10).otherwise(0.0)
    j = elements.join(decay.select("satellite_id", F.col("metric_value").alias("d")), "satellite_id")
    v = F.when(own == 0, up * 0.55 + bat * 0.25 + tw + 10 - bad * 8 - F.col("d") * 0.2).otherwise(own + tw - bad * 6 - F.col("d") * 0.15)
    return j.select("satellite_id", percent(v).alias("metric_value"))


# geopolitical

#: Fragments of category, subtype or title, and actor roles, of each class.
SANCTION = (("sanction", "designation", "watchlist", "asset_freeze"), ("sanctioned_entity", "sanctioning_authority"))
HUMANITARIAN = (("humanitarian", "aid", "relief", "displacement"), ("humanitarian_actor",))
DISRUPTION = (("disruption", "outage", "blackout", "logistics", "port", "bridge", "utility"), ())


def _mentions(fragments) -> Column:
    text = F.lower(F.concat_ws("\n", "category", "subtype", "title"))
    out = F.lit(False)
    for f in fragments:
        out = out | text.contains(f)
    return out


def _roles(roles) -> Column:
    return F.size(F.filter("actors", lambda a: F.trim(a["role"]).isin(*roles))) if roles else F.lit(0)


def normalize_geopolitical(raw: DataFrame) -> dict[str, DataFrame]:
    """events, entities, and the three bridges. raw: source_id, native_id, title, category, subtype, primary_place_id, related_place_ids, occurred_at, published_at, impact_score, media_mentions, actors, cross_links."""
    lag = F.when(F.col("published_at") > F.col("occurred_at"), round4(hours("occurred_at", "published_at"))).otherwise(0.0)
    e = raw.select(
        canonical_id("event", "source_id", "native_id").alias("event_id"), "source_id", F.col("category").alias("event_type"), F.col("primary_place_id").alias("place_id"), "related_place_ids", F.col("occurred_at").alias("starts_at"), "impact_score", "media_mentions", "cross_links", "actors",
        lag.alias("publication_lag_hours"), (_mentions(SANCTION[0]) | (_roles(SANCTION[1]) > 0)).alias("is_sanction"), (_mentions(HUMANITARIAN[0]) | (_roles(HUMANITARIAN[1]) > 0)).alias("is_humanitarian"), _mentions(DISRUPTION[0]).alias("is_disruption"),
        _roles(HUMANITARIAN[1]).alias("humanitarian_actors"), _roles(SANCTION[1]).alias("sanction_actors"), F.size("related_place_ids").alias("related_places"),
    )
    a = e.select("event_id", "source_id", "place_id", "starts_at", "impact_score", F.explode("actors").alias("a"))
    a = a.withColumn("entity_id", F.concat_ws(":", F.lit("ent"), F.lower(F.col("a.type")), F.regexp_replace(F.lower(F.trim(F.col("a.name"))), "[^a-z0-9]+", "-")))
    band_of = band("impact_score", [(0.8, "high"), (0.5, "medium")], "low")
    newest = F.struct("starts_at", "event_id")
    ents = a.groupBy("entity_id").agg(F.max_by("a.name", newest).alias("canonical_name"), F.max_by("a.type", newest).alias("entity_type"), F.max_by(band_of, newest).alias("risk_band"), F.max_by("place_id", newest).alias("primary_place_id"))
    return {
        "events": e.drop("actors"),
        "entities": ents,
        "event_entities": a.select(F.concat_ws(":", F.lit("bee"), "event_id", "entity_id").alias("bridge_id"), "event_id", "entity_id", F.col("a.role").alias("role"), band_of.alias("confidence_band")).dropDuplicates(["bridge_id"]),
        "event_places": e.select("event_id", F.explode(F.array_distinct(F.concat(F.array("place_id"), "related_place_ids"))).alias("place_id")).where("place_id <> ''"),
        "entity_places": a.select(F.concat_ws(":", F.lit("bep"), "entity_id", "place_id").alias("bridge_id"), "entity_id", "place_id").dropDuplicates(["bridge_id"]),
    }


def cross_border(events: DataFrame, lineage: DataFrame) -> DataFrame:
    """Events with a flag whether a related place lies in another country than the event's own."""
    lin = lineage.select("place_id", "admin0_place_id")
    rel = events.select("event_id", F.explode("related_place_ids").alias("place_id")).join(lin, "place_id").groupBy("event_id").agg(F.collect_set("admin0_place_id").alias("__r"))
    own = events.join(lin.withColumnRenamed("admin0_place_id", "__own"), "place_id", "left").join(rel, "event_id", "left")
    differ = (F.coalesce("__own", F.lit("")) != "") & F.coalesce(F.exists("__r", lambda x: (x != "") & (x != F.col("__own"))), F.lit(False))
    return own.withColumn("cross_border", differ).drop("__own", "__r")


def _per_day(rows: DataFrame, scores: list[tuple[str, Column, Column]], ts: str, event: str) -> DataFrame:
    """Scores (name, applies, value) of every row, summed up to 100 per place and day."""
    made = F.array(*[F.when(use, F.struct(F.lit(n).alias("metric_id"), percent(v).alias("v"))) for n, use, v in scores])
    x = rows.select("place_id", F.date_trunc("day", c(ts)).alias("window_start"), c(event).alias("event_id"), "source_id", F.explode(F.filter(made, lambda s: s.isNotNull())).alias("m"))
    return saturating_score(x.select("*", "m.metric_id", "m.v"), ["metric_id", "place_id", "window_start"], "v", "event_id", "source_id")


def geopolitical_scores(events: DataFrame) -> DataFrame:
    """Eight scores per place and day of events with the flag of cross_border."""
    m, k, i = F.col("media_mentions"), F.col("cross_links"), F.col("impact_score")
    every = F.lit(True)
    return _per_day(events, [
        ("media_attention_score", every, m * 4 + k * 5),
        ("media_attention_acceleration", every, m * 1.5 / F.greatest("publication_lag_hours", F.lit(0.5)) + k * 8),
        ("humanitarian_pressure_score", F.col("is_humanitarian"), i * 55 + F.col("humanitarian_actors") * 20 + k * 10),
        ("infrastructure_disruption_score", F.col("is_disruption"), i * 65 + m * 2 + F.col("related_places") * 10),
        ("sanction_activity_score", F.col("is_sanction"), i * 60 + F.col("sanction_actors") * 15 + m * 1.5),
        ("conflict_intensity_score", F.col("event_type") == "conflict", i * 100),
        ("protest_activity_score", F.col("event_type") == "protest", F.lit(25.0)),
        ("cross_border_spillover_score", F.col("cross_border"), F.lit(35.0)),
    ], "starts_at", "event_id")


# safety


def safety_weight(band_col) -> Column:
    return F.when(c(band_col) == "high", 1.0).when(c(band_col) == "medium", 0.75).otherwise(0.5)


def status_weight(status) -> Column:
    s = F.lower(F.trim(F.coalesce(c(status), F.lit(""))))
    return F.when(s.isin("resolved", "active", "confirmed"), 1.0).when(s.isin("review", "coarse"), 0.6).when(s == "", 0.5).otherwise(0.75)


def normalize_safety(ents: DataFrame, obs: DataFrame) -> dict[str, DataFrame]:
    """Entities with relation refs resolved, and observations with subject refs resolved, through the refs of the entities."""
    e = ents.withColumn("entity_id", canonical_id("ent", "source_id", "native_id"))
    refs = e.select(F.col("ref").alias("__ref"), F.col("entity_id").alias("__id")).dropDuplicates(["__ref"])
    rel = e.select("entity_id", F.explode("relations").alias("r")).join(refs, F.col("r.target_ref") == F.col("__ref"), "left")
    rel = rel.select("entity_id", F.col("r.type").alias("relation"), F.coalesce("__id", F.col("r.value")).alias("target"))
    o = obs.join(refs, obs["subject_ref"] == F.col("__ref"), "left").withColumn("subject_id", F.coalesce("__id", "subject_ref")).drop("__ref", "__id")
    o = o.withColumn("observation_id", canonical_id("obs", "source_id", "native_id")).withColumn("confidence_band", band("confidence", [(0.85, "high"), (0.6, "medium")], "low"))
    return {"entities": e.withColumn("risk_band", band("risk_score", [(0.8, "severe"), (0.6, "elevated")], "moderate")).drop("relations"), "relations": rel, "observations": o}


def safety_scores(obs: DataFrame) -> DataFrame:
    """Six scores per place and day. obs: observation_type, measurement_value, confidence_band, attrs JSON and the usual ids."""
    w, v = safety_weight("confidence_band"), F.col("measurement_value")
    kind = lambda x: F.col("observation_type") == x
    text = lambda k: F.coalesce(F.get_json_object("attrs", f"$.{k}"), F.lit(""))
    impacts = F.coalesce(F.size(F.from_json(text("expected_impacts"), "array<string>")), F.lit(0))
    impacts = F.when(impacts < 0, 0).otherwise(impacts)
    severity = percent(v * w)
    flood = kind("coastal_hazard_bulletin") & F.lower(text("bulletin_type")).contains("coastal_flood")
    cyber = percent(v * w * 8)
    sector, place = json_number("attrs", "sector_mapping.confidence"), json_number("attrs", "location_resolution.confidence")
    return _per_day(obs, [
        ("sanctions_exposure_score", kind("sanctions_match"), v * w),
        ("fire_hotspot_score", kind("fire_hotspot"), v * w * 5),
        ("weather_event_impact_score", kind("coastal_hazard_bulletin"), severity + impacts * 8.0),
        ("coastal_flood_risk_index", flood, severity + impacts * 12.0 + status_weight(text("mapping_status")) * 10),
        ("cyber_exposure_index", kind("known_exploited_vulnerability"), cyber + F.when(text("ransomware_use") == "true", 12.0).otherwise(0.0)),
        ("infrastructure_vulnerability_score", kind("known_exploited_vulnerability"), v * w * 5 + sector * 25 + place * 15),
    ], "observed_at", "observation_id")


def with_aliases(registry: DataFrame, aliases: DataFrame) -> DataFrame:
    """Registry rows and deprecated copies of them under their old ids. aliases: legacy_id, metric_id."""
    old = registry.join(broadcast_small(aliases), "metric_id").withColumn("replacement_metric_id", F.col("metric_id")).withColumn("metric_id", F.col("legacy_id")).withColumn("deprecated", F.lit(True)).drop("legacy_id")
    return registry.withColumn("replacement_metric_id", F.lit("")).withColumn("deprecated", F.lit(False)).unionByName(old)


def pack_contributions(metrics: DataFrame, metric_id: str, grain: str, subject: str, source: str, day) -> DataFrame:
    """A pack's metric rows as contributions for metrics.build_state."""
    start = F.date_trunc("day", F.lit(day).cast("timestamp"))
    key = F.concat_ws("|", F.lit(metric_id), F.lit(grain), c(subject), F.lit(""), F.lit("day"), F.unix_millis(start))
    return metrics.select(F.lit(metric_id).alias("metric_id"), F.lit(grain).alias("subject_grain"), c(subject).alias("subject_id"), F.lit("").alias("place_id"), F.lit("day").alias("window_grain"), start.alias("window_start"), (start + F.expr("interval 24 hours")).alias("window_end"), F.lit(source).alias("source_id"), round4("metric_value").alias("contribution_value"), F.lit(1.0).alias("contribution_weight"), key.alias("materialization_key"))
