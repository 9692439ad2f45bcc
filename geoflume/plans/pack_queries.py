"""Registered queries of the domain packs, vectors, discovery, quality and incremental jobs."""

from __future__ import annotations


from pyspark.sql import functions as F


from geoflume.operators import discovery, metrics, packs, places, quality, serve, tracks, versions
from geoflume.plans.queries import _CHAIN, NOW, PLACE_WINDOWS, _chain, _contributions, _logs, _snapshots, _windows, gaps_sql, query, r4
from geoflume.sources import views
from geoflume.sources.views import read_table

_H = "(epoch_ms({b}) - epoch_ms({a})) / 3600000.0::double"

# maritime


@query("ref_96_ais_dark_hours", f"select entity_id, {r4('sum(h)')} as metric_value, {r4('max(h)')} as longest_gap_hours, count(*) as gap_count from (select entity_id, {_H.format(a='starts_at', b='ends_at')} as h from gaps) where h > 0 group by 1", "gaps")
def _(s, d):
    return packs.ais_dark_hours_sum(views.gaps(s, d))


@query("ref_97_port_gap_hours", f"select entity_id, {r4('sum(h)')} as metric_value, count(*) as matched_calls from (select s.entity_id, s.rid, {r4(_H.format(a='max(g.ends_at)', b='any_value(s.started_at)'))} as h from (select *, row_number() over () as rid from stays) s join gaps g on g.entity_id = s.entity_id and g.ends_at < s.started_at and (g.next_known_port_id = '' or g.next_known_port_id = s.place_id) group by 1, 2) group by 1", "stays", "gaps")
def _(s, d):
    return packs.port_gap_hours(views.stays(s, d), views.gaps(s, d))


@query("ref_98_anchorage_dwell", f"select entity_id, {r4('sum(' + _H.format(a='started_at', b='ended_at') + ')')} as metric_value, count(*) as stays from stays where port_name like '%Anchorage%' and ended_at > started_at group by 1", "stays")
def _(s, d):
    return packs.anchorage_dwell_hours(views.stays(s, d))


def _signals(s, d):
    c = read_table(s, d, "customer")
    k, b = F.col("c_custkey"), F.col("c_acctbal")
    return c.select(
        F.concat(F.lit("ent:customer:"), k).alias("entity_id"), (b / 100).alias("ais_dark_hours"), (k % 9).alias("ais_gap_frequency"), (k % 4).alias("flag_changes_90d"), (k % 3).alias("ownership_changes_180d"), (b / 8000).alias("sanctions_exposure"), (k % 6).alias("high_risk_port_calls"),
        (b / 9000).alias("sts_suspicion_score"), (b / 7000 - 0.2).alias("route_deviation_score"), (k % 40).alias("vessel_age_years"), F.when(k % 2 == 0, "PA").otherwise("tz").alias("registry_flag_state"), F.when(k % 3 == 0, " TZ").when(k % 3 == 1, "").otherwise("PA").alias("observed_flag_state"),
    )


def _c01(x: str) -> str:
    return f"least(greatest({x}, 0::double), 1::double)"


@query("ref_99_flag_mismatch", f"select 'ent:customer:' || c_custkey as entity_id, {r4('case when c_custkey % 3 <> 1 and (c_custkey % 2 = 0) = (c_custkey % 3 = 0) then 0.7::double else 0 end + 0.3::double * least(c_custkey % 4 / 3.0::double, 1)')} as metric_value from customer")
def _(s, d):
    return packs.flag_registry_mismatch(_signals(s, d))


@query(
    "ref_100_shadow_fleet",
    "select 'ent:customer:' || c_custkey as entity_id, "
    + r4(" + ".join(f"{_c01(x)} * {w}::double" for x, w in (("c_acctbal / 100 / 24", 0.22), ("c_custkey % 9 / 6.0::double", 0.1), ("c_custkey % 4 / 3.0::double", 0.12), ("c_custkey % 3 / 2.0::double", 0.12), ("c_acctbal / 8000", 0.18), ("c_custkey % 6 / 4.0::double", 0.1), ("c_acctbal / 9000", 0.08), ("c_acctbal / 7000 - 0.2::double", 0.05), ("greatest(c_custkey % 40 - 15, 0) / 20.0::double", 0.03))))
    + " as metric_value from customer",
)
def _(s, d):
    return packs.shadow_fleet_score(_signals(s, d))


@query("ref_101_route_deviation", f"select 'ent:customer:' || c_custkey as entity_id, {r4(_c01('c_acctbal / 7000 - 0.2::double'))} as metric_value from customer")
def _(s, d):
    return packs.route_deviation_score(_signals(s, d))


@query("ref_102_field_changes", "select o_custkey, o_orderkey, u.field, u.old_value, u.new_value from (select o_custkey, o_orderkey, lag(o_orderstatus) over w as a, o_orderstatus as b, lag(o_orderpriority) over w as c, o_orderpriority as e, row_number() over w as n from orders window w as (partition by o_custkey order by o_orderkey)), lateral (select unnest(['o_orderstatus', 'o_orderpriority']) as field, unnest([a, c]) as old_value, unnest([b, e]) as new_value) u where n > 1 and old_value <> new_value")
def _(s, d):
    return packs.field_changes(read_table(s, d, "orders"), "o_custkey", "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query("ref_103_vessel_state", "select entity_id, point_id, latitude, longitude from (select *, row_number() over (partition by entity_id order by observed_at desc, point_id desc) as rn from points where latitude between -20 and 20) where rn = 1", "points")
def _(s, d):
    p = views.points(s, d).select("entity_id", "observed_at", "point_id", "latitude", "longitude").where("latitude between -20 and 20")
    return versions.latest_version(serve.valid_position(p), ["entity_id"], ["observed_at", "point_id"]).drop("observed_at")


@query("ref_104_route_plans", "select event_id as route_id, i + 1 as sequence, k + i * 1.0::double as lat, i * 2.0::double as lon, case when (k + i) % 3 <> 0 then make_timestamp(1700000000000000 + (k + i) * 1000000) end as arrives_at from ev, (values (0), (1), (2)) t(i)", "ev")
def _(s, d):
    e = views._events(s, d)
    w = lambda i: F.struct((F.col("k") + i * 1.0).alias("lat"), F.lit(i * 2.0).alias("lon"), F.when((F.col("k") + i) % 3 != 0, F.col("k") + i + 1700000000).otherwise(0).cast("long").alias("eta_s"))
    return packs.route_plans(e.select(F.col("event_id").alias("route_id"), F.col("user_id").alias("entity_id"), F.array(w(0), w(1), w(2)).alias("waypoints")))[1]


@query("ref_105_port_places", f"select 'plc:port:fr-' || 'p' || (p_partkey % 90 + 10) as place_id, 'FRP' || (p_partkey % 90 + 10) as code, p_name as name, {r4('(p_partkey % 50 + 10) + 30 / 60.0::double')} as latitude, {r4('-((p_partkey % 50 + 100) + 15 / 60.0::double)')} as longitude from part")
def _(s, d):
    p, k = read_table(s, d, "part"), F.col("p_partkey") % 50
    return packs.port_places(p.select(F.lit("FR").alias("country"), F.concat(F.lit("P"), F.col("p_partkey") % 90 + 10).alias("location"), F.col("p_name").alias("name"), F.concat((k + 10).cast("string"), F.lit("30N "), (k + 100).cast("string"), F.lit("15W")).alias("coordinates")))


@query("ref_145_country_by_prefix", "select c_custkey, case c_custkey % 3 when 0 then 'FR' when 1 then 'flag' else '' end as country from customer")
def _(s, d):
    c = read_table(s, d, "customer").select("c_custkey", F.concat(F.when(F.col("c_custkey") % 3 == 0, "226").otherwise("999"), F.col("c_custkey") + 100000).alias("mmsi"), F.when(F.col("c_custkey") % 3 == 1, "flag").otherwise("").alias("flag_state"))
    return packs.country_by_prefix(c, s.createDataFrame([("226", "FR"), ("227", "FR")], "prefix string, country string")).select("c_custkey", "country")


@query("ref_147_vessels", "select 'ent:src:' || case when c_custkey % 2 = 0 then 'n' || c_custkey else replace(c_name, '#', '_') end as entity_id, c_name as name, [c_name, 'Alias'] as aliases from customer")
def _(s, d):
    c = read_table(s, d, "customer").select(F.lit("src").alias("source_id"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("n"), "c_custkey")).otherwise(" ").alias("native_id"), F.col("c_name").alias("name"), F.lit("").alias("imo"), F.lit("").alias("mmsi"), F.lit("").alias("call_sign"), F.array(F.lit("Alias"), F.lit("Alias "), F.lit("")).alias("aliases"))
    return packs.maritime_vessels(c).drop("imo", "mmsi")


@query("ref_147_calls", f"select call_id, case when right(call_id, 1) = '1' then 'open' else 'completed' end as status, {r4('case when right(call_id, 1) = chr(49) then 0 else greatest(' + _H.format(a='started_at', b='ended_at') + ', 0) end')} as dwell_hours from stays", "stays")
def _(s, d):
    st = views.stays(s, d)
    return packs.maritime_calls(st.withColumn("ended_at", F.when(~F.col("call_id").endswith("1"), F.col("ended_at")))).select("call_id", "status", "dwell_hours")


# space


@query("ref_107_overpass_density", f"select * from (with {PLACE_WINDOWS} select place_id, {r4('count(*) * 24.0::double / 720')} as metric_value, count(*) as pass_count, count(distinct satellite_id) as satellite_count from pw group by 1)", "points")
def _(s, d):
    return packs.overpass_density(_windows(s, d), 720.0)


@query("ref_108_revisit_capability", f"select * from (with {PLACE_WINDOWS}, {gaps_sql('place_id', 'pw')} select place_id, {r4('least(100, greatest(0, (1 - max(largest_gap_hours) / 720) * 70 + least(count(distinct satellite_id) * 15.0::double, 30)))')} as metric_value from pw join gaps using (place_id) group by 1)", "points")
def _(s, d):
    w = _windows(s, d)
    return packs.revisit_capability(w, tracks.coverage_gaps(w, ["place_id"], "2024-01-01", "2024-01-31"), 720.0)


@query("ref_110_conjunction_risk", f"select user_id % 50 as satellite_id, {r4('avg(' + r4('0.6::double * least(k / 100000.0::double / 0.001::double, 1) + 0.4::double * (1 - least(value / 2 / 25, 1))') + ')')} as metric_value, count(*) as advisory_count, {r4('min(value / 2)')} as closest_miss_distance_km from ev group by 1", "ev")
def _(s, d):
    e = views._events(s, d)
    return packs.conjunction_risk(e.select((F.col("user_id") % 50).alias("satellite_id"), (F.col("k") / 100000.0).alias("probability"), (F.col("value") / 2).alias("miss_distance_km"))).drop("mean_probability")


def _elements(s, d):
    k = F.col("p_partkey")
    attrs = F.when(k % 4 == 0, F.format_string('{"maneuver_count_30d":%d,"thruster_firings_7d":"3","uptime_pct":%d,"anomaly_count_30d":1}', k % 7, k % 60 + 40)).when(k % 4 == 1, F.format_string('{"health_score":%d}', k % 90 + 5)).otherwise("{}")
    return read_table(s, d, "part").select(k.alias("satellite_id"), (k % 20 + 5.0).alias("mean_motion_rev_per_day"), (k % 70 / 1e6).alias("bstar"), attrs.alias("attrs"), F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("active"), F.when(k % 2 == 0, "dead").otherwise(" Online"))).alias("transmitters"))


def _altitude(s, d):
    return read_table(s, d, "lineitem").where("l_partkey % 10 <> 3").select(F.col("l_partkey").alias("satellite_id"), (F.col("l_quantity") * 20).alias("altitude_km"))


_DECAY = f"dec as (select p_partkey as satellite_id, {r4('least(greatest(least(abs(p_partkey % 70 / 1e6::double) * 1e6::double, 60) + greatest(0, 450 - coalesce(alt, 0)) * 0.12::double + least(greatest((p_partkey % 20 + 5.0::double - 12) * 5, 0), 20), 0), 100)')} as dv from part left join (select l_partkey, avg(l_quantity * 20) as alt from lineitem where l_partkey % 10 <> 3 group by 1) on l_partkey = p_partkey)"


@query("ref_111_orbital_decay", f"select * from (with {_DECAY} select satellite_id, dv as metric_value from dec)")
def _(s, d):
    return packs.orbital_decay(_elements(s, d), _altitude(s, d))


@query("ref_112_maneuver_frequency", f"select p_partkey as satellite_id, {r4('case when p_partkey % 4 = 0 then least(p_partkey % 7 * 18 + 12, 100) else 0 end::double')} as metric_value from part")
def _(s, d):
    return packs.maneuver_frequency(_elements(s, d))


@query(
    "ref_113_satellite_health",
    f"""select * from (with {_DECAY}, x as (select satellite_id, dv, case when satellite_id % 5 = 0 then 0 when satellite_id % 2 = 0 then 5 else 10 end as tw, case when satellite_id % 4 = 0 then satellite_id % 60 + 40 else 92 end as up, case when satellite_id % 4 = 0 then 1 else 0 end as bad, case when satellite_id % 4 = 1 then satellite_id % 90 + 5 else 0 end as own from dec)
    select satellite_id, {r4("least(greatest(case when own = 0 then up * 0.55::double + 80 * 0.25::double + tw + 10 - bad * 8 - dv * 0.2::double else own + tw - bad * 6 - dv * 0.15::double end, 0), 100)")} as metric_value from x)""",
)
def _(s, d):
    e = _elements(s, d)
    return packs.satellite_health(e, packs.orbital_decay(e, _altitude(s, d)))


# geopolitical and safety


def _geo(s, d):
    f, b = views.facts(s, d), views.event_entities(s, d)
    k = F.element_at(F.split("event_id", ":"), 2).cast("long")
    act = b.join(read_table(s, d, "supplier").select(F.concat(F.lit("ent:supplier:"), "s_suppkey").alias("entity_id"), "s_name", F.concat(F.lit("plc:"), "s_nationkey").alias("sp")), "entity_id")
    act = act.groupBy("event_id").agg(F.sort_array(F.collect_list(F.struct(F.col("s_name").alias("name"), F.lit("org").alias("type"), F.when(F.col("role") == "A", "sanctioned_entity").when(F.col("role") == "R", "humanitarian_actor").otherwise("other").alias("role")))).alias("actors"), F.array_sort(F.collect_set("sp")).alias("related_place_ids"))
    kind = F.element_at(F.array(*[F.lit(x) for x in ("conflict", "protest", "relief work", "outage", "talks")]), (k % 5 + 1).cast("int"))
    return f.join(act, "event_id").select(
        F.lit("src:geo").alias("source_id"), k.cast("string").alias("native_id"), F.lit("title").alias("title"), kind.alias("category"), F.lit("").alias("subtype"), F.col("place_id").alias("primary_place_id"), "related_place_ids", F.col("starts_at").alias("occurred_at"),
        F.timestamp_millis(F.unix_millis("starts_at") + (k % 5) * 3600000).alias("published_at"), "impact_score", (k % 9).cast("double").alias("media_mentions"), (k % 3).cast("double").alias("cross_links"), "actors",
    )


_GEO = """ge as (select o_orderkey as n, 'event:src_geo:' || o_orderkey as event_id, o_orderkey % 5 as ck, 'plc:' || c_nationkey as place_id, o_orderdate as starts_at, o_totalprice / 500000 as i, (o_orderkey % 9)::double as m, (o_orderkey % 3)::double as x, (o_orderkey % 5)::double as lag,
    a.sanc, a.hum, a.rel, a.places from orders join customer on o_custkey = c_custkey join (select l_orderkey, count(*) filter (l_returnflag = 'A') as sanc, count(*) filter (l_returnflag = 'R') as hum, count(distinct s_nationkey) as rel, list_sort(list(distinct 'plc:' || s_nationkey)) as places from lineitem join supplier on l_suppkey = s_suppkey group by 1) a on l_orderkey = o_orderkey)"""
_GS = [
    ("media_attention_score", "true", "m * 4 + x * 5"), ("media_attention_acceleration", "true", "m * 1.5::double / greatest(lag, 0.5::double) + x * 8"), ("humanitarian_pressure_score", "ck = 2 or hum > 0", "i * 55 + hum * 20 + x * 10"),
    ("infrastructure_disruption_score", "ck = 3", "i * 65 + m * 2 + rel * 10"), ("sanction_activity_score", "sanc > 0", "i * 60 + sanc * 15 + m * 1.5::double"), ("conflict_intensity_score", "ck = 0", "i * 100"), ("protest_activity_score", "ck = 1", "25::double"),
    ("cross_border_spillover_score", "len(list_filter(places, lambda p: p <> place_id)) > 0", "35::double"),
]


@query("ref_114_geo_events", f"select * from (with {_GEO} select event_id, place_id, lag as publication_lag_hours, sanc > 0 as is_sanction, ck = 2 or hum > 0 as is_humanitarian, ck = 3 as is_disruption, rel as related_places from ge)")
def _(s, d):
    return packs.normalize_geopolitical(_geo(s, d))["events"].select("event_id", "place_id", "publication_lag_hours", "is_sanction", "is_humanitarian", "is_disruption", F.col("related_places").cast("long").alias("related_places"))


@query("ref_114_geo_entities", "select 'ent:org:supplier-' || right(s_name, 9) as entity_id, s_name as canonical_name from supplier where s_suppkey in (select l_suppkey from lineitem)")
def _(s, d):
    return packs.normalize_geopolitical(_geo(s, d))["entities"].select("entity_id", "canonical_name")


@query("ref_114_geo_event_places", f"select * from (with {_GEO} select distinct event_id, p as place_id from (select event_id, unnest(list_append(places, place_id)) as p from ge))")
def _(s, d):
    return packs.normalize_geopolitical(_geo(s, d))["event_places"]


@query("ref_115_geopolitical_scores", f"select * from (with {_GEO}, sc as (" + " union all ".join(f"select '{n}' as metric_id, place_id, date_trunc('day', starts_at) as window_start, {r4('least(greatest(' + v + ', 0), 100)')} as v from ge where {p}" for n, p, v in _GS) + f") select metric_id, place_id, window_start, {r4('least(100, sum(v))')} as score from sc group by 1, 2, 3)")
def _(s, d):
    e = packs.normalize_geopolitical(_geo(s, d))["events"]
    return packs.geopolitical_scores(packs.cross_border(e, places.lineage(views.places(s, d)))).select("metric_id", "place_id", "window_start", "score")


@query("ref_116_cross_border", f"select * from (with {_GEO} select event_id, len(list_filter(places, lambda p: p <> place_id)) > 0 as cross_border from ge)")
def _(s, d):
    e = packs.normalize_geopolitical(_geo(s, d))["events"]
    return packs.cross_border(e, places.lineage(views.places(s, d))).select("event_id", "cross_border")


def _safety(s, d):
    e = views._events(s, d)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("sanctions_match", "fire_hotspot", "coastal_hazard_bulletin", "known_exploited_vulnerability")]), (F.col("k") % 4 + 1).cast("int"))
    attrs = F.when(F.col("k") % 8 == 2, '{"expected_impacts":["a","b"],"bulletin_type":"Coastal_Flood watch","mapping_status":"review"}').when(F.col("k") % 4 == 2, '{"expected_impacts":["a"]}').when(F.col("k") % 8 == 3, '{"ransomware_use":true,"sector_mapping":{"confidence":0.5},"location_resolution":{"confidence":0.8}}').otherwise("{}")
    ents = read_table(s, d, "supplier").select(F.lit("src").alias("source_id"), F.concat(F.lit("n"), "s_suppkey").alias("native_id"), F.concat(F.lit("ref:"), "s_suppkey").alias("ref"), (F.col("s_acctbal") / 10000).alias("risk_score"), F.array(F.struct(F.concat(F.lit("ref:"), F.col("s_suppkey") + 1).alias("target_ref"), F.lit("owns").alias("type"), F.lit("unknown").alias("value"))).alias("relations"))
    obs = e.select(F.concat(F.lit("src:"), "event_type").alias("source_id"), F.concat(F.lit("o"), "event_id").alias("native_id"), kind.alias("observation_type"), F.concat(F.lit("plc:"), F.col("user_id") % 25).alias("place_id"), F.concat(F.lit("ref:"), F.col("user_id") % 30).alias("subject_ref"), F.col("ts").alias("observed_at"), (F.col("value") / 10).alias("measurement_value"), (F.col("k") / 100.0).alias("confidence"), attrs.alias("attrs"))
    return packs.normalize_safety(ents, obs)


_W = "case when k / 100.0::double >= 0.85::double then 1::double when k / 100.0::double >= 0.6::double then 0.75::double else 0.5::double end"
_V = f"(value / 10 * {_W})"
_CL = "least(greatest({}, 0), 100)"
_SS = [
    ("sanctions_exposure_score", "k % 4 = 0", _V), ("fire_hotspot_score", "k % 4 = 1", f"{_V} * 5"), ("weather_event_impact_score", "k % 4 = 2", f"{r4(_CL.format(_V))} + case when k % 8 = 2 then 16 else 8 end"),
    ("coastal_flood_risk_index", "k % 8 = 2", f"{r4(_CL.format(_V))} + 24 + 6"), ("cyber_exposure_index", "k % 4 = 3", f"{r4(_CL.format(_V + ' * 8'))} + case when k % 8 = 3 then 12 else 0 end"),
    ("infrastructure_vulnerability_score", "k % 4 = 3", f"{_V} * 5 + case when k % 8 = 3 then 12.5::double + 12 else 0 end"),
]


@query("ref_118_safety_scores", "select * from (with sc as (" + " union all ".join(f"select '{n}' as metric_id, 'plc:' || (user_id % 25) as place_id, date_trunc('day', ts) as window_start, {r4(_CL.format(v))} as v from ev where {p}" for n, p, v in _SS) + f") select metric_id, place_id, window_start, {r4('least(100, sum(v))')} as score from sc group by 1, 2, 3)", "ev")
def _(s, d):
    return packs.safety_scores(_safety(s, d)["observations"]).select("metric_id", "place_id", "window_start", "score")


@query("ref_117_safety_relations", "select 'ent:src:n' || a.s_suppkey as entity_id, 'owns' as relation, case when b.s_suppkey is null then 'unknown' else 'ent:src:n' || b.s_suppkey end as target from supplier a left join supplier b on b.s_suppkey = a.s_suppkey + 1")
def _(s, d):
    return _safety(s, d)["relations"]


@query("ref_117_safety_observations", "select 'obs:src_' || event_type || ':o' || event_id as observation_id, case when s_suppkey is null then 'ref:' || (user_id % 30) else 'ent:src:n' || s_suppkey end as subject_id from ev left join supplier on s_suppkey = user_id % 30", "ev")
def _(s, d):
    return _safety(s, d)["observations"].select("observation_id", "subject_id")


@query("ref_119_bands", "select s_suppkey, case when s_acctbal / 10000 >= 0.8 then 'severe' when s_acctbal / 10000 >= 0.6 then 'elevated' else 'moderate' end as risk_band from supplier")
def _(s, d):
    return _safety(s, d)["entities"].select(F.substring("native_id", 2, 20).cast("long").alias("s_suppkey"), "risk_band")


@query("ref_64_with_aliases", "select p_brand || '/' || p_size as metric_id, false as deprecated, '' as replacement_metric_id from (select distinct p_brand, p_size from part) union all select 'old_' || p_brand, true, p_brand || '/7' from (select distinct p_brand from part where p_size = 7)")
def _(s, d):
    p = read_table(s, d, "part").select(F.concat_ws("/", "p_brand", "p_size").alias("metric_id"), "p_brand", "p_size").distinct()
    al = p.where("p_size = 7").select(F.concat(F.lit("old_"), "p_brand").alias("legacy_id"), "metric_id")
    return packs.with_aliases(p.select("metric_id"), al)


@query("ref_120_pack_contributions", f"select entity_id as subject_id, sum(v) as value_sum, count(*) as n from (select entity_id, {r4('sum(h)')} as v from (select entity_id, {_H.format(a='starts_at', b='ends_at')} as h from gaps) group by 1) group by 1", "gaps")
def _(s, d):
    c = packs.pack_contributions(packs.ais_dark_hours_sum(views.gaps(s, d)), "ais_dark_hours_sum", "entity", "entity_id", "src:ais", NOW)
    return metrics.build_state(c).select("subject_id", "value_sum", "n")


# vectors


def _emb(s, d):
    return read_table(s, d, "embeddings").select(F.col("vec_id").alias("entity_id"), F.col("label").cast("string").alias("entity_type"), "embedding")


_Q = "list_value(" + ", ".join(f"{(i % 7 - 3) / 10}" for i in range(64)) + ")::double[64]"


def _knn_sql(metric: str) -> str:
    f = {"cosine": "array_cosine_distance", "euclidean": "array_distance", "dot": "array_inner_product"}[metric]
    score = {"cosine": "greatest(0, 1 - raw)", "euclidean": "1 / (1 + raw)", "dot": "greatest(0, least(1, raw))"}[metric]
    return f"select entity_id, round({score}, 6) as score from (select vec_id as entity_id, {f}(embedding::double[64], {_Q}) as raw from embeddings where label <> 3 and vec_id not in (1, 2)) order by raw {'desc' if metric == 'dot' else ''}, entity_id limit 25"


def _knn(metric: str):
    def run(s, d):
        e = _emb(s, d).where("entity_type <> '3'")
        return serve.knn(e, [(i % 7 - 3) / 10 for i in range(64)], metric, 25, exclude=[1, 2]).select("entity_id", F.round("score", 6).alias("score"))

    return run


for _m in ("cosine", "euclidean", "dot"):
    query(f"ref_121_knn_{_m}", _knn_sql(_m))(_knn(_m))


@query("ref_122_seed_centroid", "select i, round(avg(x), 6) as x from (select unnest(range(0, 64)) as i, unnest(embedding::double[]) as x from embeddings where vec_id in (1, 5, 9)) group by 1")
def _(s, d):
    return serve.resolve_seeds(_emb(s, d), [1, 5, 9], "centroid").select(F.posexplode("seed_vector").alias("i", "x")).select(F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


@query("ref_122_missing_seeds", "select t.i::bigint as entity_id from (values (1), (-5), (-9)) t(i) where t.i not in (select vec_id from embeddings)")
def _(s, d):
    return serve.missing_seeds(_emb(s, d), [1, -5, -9])


@query("ref_121_knn_batch", "select seed_id, entity_id, rank from (select a.vec_id as seed_id, b.vec_id as entity_id, row_number() over (partition by a.vec_id order by array_cosine_similarity(a.embedding::double[64], b.embedding::double[64]) desc, b.vec_id) as rank from embeddings a, embeddings b where a.vec_id in (1, 5, 9) and a.vec_id <> b.vec_id) where rank <= 5")
def _(s, d):
    e = _emb(s, d)
    return serve.knn_batch(e, serve.resolve_seeds(e, [1, 5, 9]), 5).select("seed_id", "entity_id", "rank")


@query("ref_121_knn_batch_twentieth", "select seed_id, entity_id, rank from (select a.vec_id as seed_id, b.vec_id as entity_id, row_number() over (partition by a.vec_id order by array_cosine_similarity(a.embedding::double[64], b.embedding::double[64]) desc, b.vec_id) as rank from embeddings a, embeddings b where a.vec_id % 20 = 0 and a.vec_id <> b.vec_id) where rank <= 5")
def _(s, d):
    e = _emb(s, d)
    seeds = e.where("entity_id % 20 = 0").select(F.col("entity_id").alias("seed_id"), F.col("embedding").alias("seed_vector"))
    return serve.knn_batch(e, seeds, 5).select("seed_id", "entity_id", "rank")


@query("ref_123_check_space", "select vec_id as entity_id from embeddings where len(embedding) <> 32")
def _(s, d):
    return serve.check_space(_emb(s, d), 32).select("entity_id")


@query("ref_124_needs_embedding", "select entity_id, canonical_name || ' [' || entity_type || ']' as source_text from entities where record_version % 2 = 1", "entities")
def _(s, d):
    e = views.entities(s, d)
    have = e.where("record_version % 2 = 0").select("entity_id", F.sha2(F.concat("canonical_name", F.lit(" ["), "entity_type", F.lit("]")), 256).alias("source_text_sha256"))
    return serve.needs_embedding(e, have).drop("source_text_sha256")


# discovery

_URL = r"""url_rows as (select page_id, scheme || '://' || host || path || case when q = '' then '' else '?' || q end as u, scheme || '://' || host as root from (select page_id, scheme, host, case when path = '' then '/' when length(path) > 1 then regexp_replace(path, '/$', '') else path end as path,
    coalesce(array_to_string(list_sort(list_filter(string_split(q0, '&'), lambda p: p <> '' and not starts_with(lower(p), 'utm_') and split_part(lower(p), '=', 1) not in ('fbclid', 'gclid', 'mc_cid', 'mc_eid'))), '&'), '') as q
    from (select page_id, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) as scheme, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) as host, regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/{2,}', '/', 'g') as path, regexp_extract(url, '\?([^#]*)', 1) as q0 from pages)))"""
_FR = f"{_URL}, fr as (select u as canonical_url, max((page_id % 10) / 10.0::double) as quality_hint, max(timestamp '2024-01-01' + to_hours(page_id % 900)) filter (page_id % 4 <> 0) as fresh_at, min(timestamp '2023-01-01' + to_hours(page_id)) as first_seen_at, count(*) as sightings from url_rows group by 1)"


def _frontier(s, d):
    p, k = read_table(s, d, "pages"), F.col("page_id")
    at = lambda t, h: F.timestamp_millis(F.unix_millis(F.lit(t).cast("timestamp")) + h * 3600000)
    return discovery.build_frontier(p.select("url", (k % 10 / 10.0).alias("quality_hint"), F.when(k % 4 != 0, at("2024-01-01", k % 900)).alias("fresh_at"), at("2023-01-01", k).alias("seen_at")))


@query("ref_125_build_frontier", f"select * from (with {_FR} select * from fr)")
def _(s, d):
    return _frontier(s, d)


@query(
    "ref_126_score_frontier",
    rf"""select * from (with {_FR}, z as (select *, regexp_extract(canonical_url, '^[a-z]+://([^/:?]+)', 1) || ':' || case when regexp_extract(canonical_url, '^[a-z]+://[^/?]+/([^/?]+)', 1) = '' then 'root' else regexp_extract(canonical_url, '^[a-z]+://[^/?]+/([^/?]+)', 1) end as bucket, greatest(0::double, (epoch_ms(timestamp '2024-01-20') - epoch_ms(fresh_at)) / 3600000.0::double) as age from fr),
    y as (select *, count(*) over (partition by bucket) as n from z)
    select canonical_url, n as bucket_size, cast(round(least(1, case when fresh_at is null then 0.45::double else 1 / (1 + age / 72) end * 0.4::double + case when quality_hint = 0 then 0.375::double else quality_hint end * 0.3::double + 1.0::double / n * 0.15::double + 0.5::double * 0.15::double) * 1000) as integer) as priority,
    timestamp '2024-01-20' + to_hours(case when fresh_at is null then 24 when age < 6 then 2 when age < 24 then 6 when age > 720 then 168 else 24 end) as next_fetch_at from y)""",
)
def _(s, d):
    return discovery.score_frontier(_frontier(s, d), NOW).select("canonical_url", "bucket_size", "priority", "next_fetch_at")


_PV = "pats(p, s) as (values " + ", ".join(str(x) for x in discovery.PATTERNS) + ")"


@query("ref_127_url_candidates", f"select * from (with {_URL}, {_PV}, c as (select distinct root || s as candidate_url, 'host:' || p as signal, root as observed from url_rows, pats union select u, 'url:' || p, u from url_rows, pats where contains(u, p)) select candidate_url, list_sort(list(distinct signal)) as signals, 'cand:' || left(sha256('catalog|' || candidate_url), 16) as candidate_id from c group by 1)")
def _(s, d):
    return discovery.url_pattern_candidates(read_table(s, d, "pages")).drop("observed_urls")


@query("ref_128_expand_families", "select t.s_suppkey || ':' || m.p_partkey as source_id, case when t.s_suppkey % 5 = m.p_size % 5 then 1 else 0 end + case when t.s_suppkey % 3 = m.p_partkey % 3 then 1 else 0 end as shared from supplier t, part m where shared > 0 and (t.s_suppkey % 2 = 0 or m.p_partkey % 2 = 0 or shared = 2)")
def _(s, d):
    t = read_table(s, d, "supplier").select(F.col("s_suppkey").cast("string").alias("template_id"), F.array(F.concat(F.lit("A"), F.col("s_suppkey") % 5), F.concat(F.lit("b"), F.col("s_suppkey") % 3)).alias("tags"), F.when(F.col("s_suppkey") % 2 == 0, "National").otherwise("local").alias("scope"))
    m = read_table(s, d, "part").select(F.col("p_partkey").cast("string").alias("member_id"), F.lit("http://x/").alias("candidate_url"), F.array(F.concat(F.lit("a"), F.col("p_size") % 5), F.concat(F.lit("B "), F.lit("")), F.concat(F.lit("b"), F.col("p_partkey") % 3)).alias("tags"), F.when(F.col("p_partkey") % 2 == 0, "").otherwise("city").alias("scope"))
    m = m.withColumn("scope", F.col("scope"))
    t = t.withColumn("scope", F.when(F.col("scope") == "National", "").otherwise("local"))
    return discovery.expand_families(t, m).select("source_id", F.col("shared").cast("int").alias("shared"))


@query("ref_129_newest_by_url", f"select * from (with {_URL} select u as canonical_url, max(page_id) as page_id from url_rows group by 1)")
def _(s, d):
    p = read_table(s, d, "pages").select("page_id", "url", F.timestamp_seconds("page_id").alias("published_at"))
    return discovery.newest_by_url(p).select("canonical_url", "page_id")


@query("ref_130_due_sources", "select u.user_id as source_id from (select user_id, max(ts) as m from ev group by 1) u where u.user_id % 5 = 0 or epoch_ms(m) + case when u.user_id % 2 = 0 then 900000 else 21600000 end <= epoch_ms(timestamp '2024-01-20')", "ev")
def _(s, d):
    e = views._events(s, d)
    src = e.select(F.col("user_id").alias("source_id")).distinct().withColumn("refresh", F.when(F.col("source_id") % 2 == 0, "fast").otherwise("slow"))
    return discovery.due_sources(src, e.where("user_id % 5 <> 0").select(F.col("user_id").alias("source_id"), F.col("ts").alias("visited_at")), NOW).select("source_id")


# quality


@query("ref_131_rollout_counts", "select count(*) as total, count(*) filter (p_size % 2 = 0) as concrete, count(*) filter (p_size % 3 = 0) as runnable, count(*) filter (p_size > 10) as enabled, count(*) filter (p_size > 40) as gated from part")
def _(s, d):
    p = read_table(s, d, "part").select(F.when(F.col("p_size") % 2 == 0, "concrete").otherwise("family").alias("catalog_kind"), F.when(F.col("p_size") % 3 == 0, "http").otherwise("ftp").alias("transport_type"), (F.col("p_size") > 10).alias("enabled"), (F.col("p_size") > 40).alias("needs_credentials"))
    return quality.rollout_counts(p)


@query("ref_132_freshness", "select u.user_id as source_id, m as last_fetch_at, cast(floor((epoch_ms(timestamp '2024-01-20') - epoch_ms(m)) / 1000.0::double) as bigint) as freshness_seconds, case when m is null then 'never' when floor((epoch_ms(timestamp '2024-01-20') - epoch_ms(m)) / 1000.0::double) > 600 then 'stale' else 'ok' end as lag_reason from (select distinct user_id from events) u left join (select user_id, max(ts) as m from ev where k % 3 = 1 and user_id % 4 <> 0 group by 1) x using (user_id)", "ev")
def _(s, d):
    e = views._events(s, d)
    return quality.freshness(e.select(F.col("user_id").alias("source_id")).distinct(), e.where("k % 3 = 1 and user_id % 4 <> 0").select(F.col("user_id").alias("source_id"), F.col("ts").alias("fetched_at")), NOW)


@query("ref_133_parse_quality", "select count(*) as total, count(*) filter (event_type <> 'error') as success, coalesce(round(count(*) filter (event_type <> 'error') * 10000.0::double / nullif(count(*), 0)) / 10000, 0) as success_rate from ev where k % 3 = 2 and ts <= timestamp '2024-01-20' and epoch_ms(ts) > epoch_ms(timestamp '2024-01-20') - 1440 * 60000", "ev")
def _(s, d):
    return quality.parse_quality(_logs(s, d)[2].select(F.col("parsed_at").alias("at"), "status"), NOW, 1440)


@query("ref_134_open_work", "select 'running_jobs' as kind, count(*) filter (event_type <> 'error') as n from ev where k % 3 = 0 union all select 'frontier_due', count(*) filter (page_id % 2 = 0) from pages union all select 'unresolved_open', count(*) filter (k % 2 = 0) from ev", "ev")
def _(s, d):
    jobs = _logs(s, d)[0].withColumn("status", F.when(F.col("status") == "success", "running").otherwise("error"))
    fr = read_table(s, d, "pages").select(F.when(F.col("page_id") % 2 == 0, "pending").otherwise("done").alias("state"))
    return quality.open_work(jobs, fr, views._events(s, d).select(F.when(F.col("k") % 2 == 0, "open").otherwise("closed").alias("state")))


@query("ref_135_output_counts", f"select * from (with {_CHAIN} select 'metric_snapshot' as kind, count(*) as n, max(window_start) as last_window from snap union all select 'hotspot_snapshot', count(*), max(window_start) from snap where metric_value > 0 or metric_delta > 0 union all select 'cross_domain_snapshot', count(*), max(window_start) from (select distinct subject_grain, subject_id, window_grain, window_start from snap where metric_value > 0 or metric_delta > 0))", "records")
def _(s, d):
    snap, reg = _snapshots(s, d), metrics.registry(s)
    return quality.output_counts(snap, metrics.hotspots(snap, reg), metrics.cross_domain(snap, reg))


@query("ref_136_table_rows", "select 'events' as table_name, count(*) as n from events union all select 'lineitem', count(*) from lineitem union all select 'orders', count(*) from orders")
def _(s, d):
    return quality.table_rows({k: read_table(s, d, k) for k in ("events", "orders", "lineitem")})


@query("ref_69_terminal_catalog", "select 'events' as table_name, max(ts) as last_at, count(*) as n from ev union all select 'orders', max(o_orderdate), count(*) from orders", "ev")
def _(s, d):
    return quality.terminal_catalog({"events": (views._events(s, d), "ts"), "orders": (read_table(s, d, "orders"), "o_orderdate")})


@query("ref_137_retention", "select o_orderkey, o_orderdate from orders where not (epoch_ms(o_orderdate) < epoch_ms(timestamp '2000-01-01') - 365 * 86400000::bigint and o_orderstatus = 'F')")
def _(s, d):
    return quality.apply_retention(read_table(s, d, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus"), "o_orderdate", 365, "2000-01-01", F.col("o_orderstatus") == "F").drop("o_orderstatus")


@query("ref_139_drift_rate", f"select {r4('avg(schema_drift_detected::int)')} as schema_drift_rate, count(*) as records from records", "records")
def _(s, d):
    return quality.drift_rate(views.records(s, d))


@query("ref_68_source_coverage", "select s.event_type || ':coverage' as coverage_id, s.event_type as source_id, coalesce(p, 0) as place_count, coalesce(e, 0) as event_count, case when s.event_type = 'error' then 'gated' else 'parsed_no_promotable_rows' end as coverage_state, case when s.event_type = 'error' then 'key' else '' end as reason from (select distinct event_type from events) s left join (select event_type, count(distinct user_id % 25) as p from ev where k % 2 = 0 or k % 3 = 0 group by 1) a using (event_type) left join (select event_type, count(distinct event_id) as e from ev where k % 5 = 0 group by 1) b using (event_type)", "ev")
def _(s, d):
    e = views._events(s, d).withColumn("source_id", F.col("event_type")).withColumn("place_id", F.concat(F.lit("plc:"), F.col("user_id") % 25))
    return quality.source_coverage(e.select("source_id").distinct(), [e.where("k % 2 = 0"), e.where("k % 3 = 0")], e.where("k % 5 = 0"), s.createDataFrame([("error", "gated", "key")], "source_id string, coverage_state string, reason string"))


@query("ref_24_coverage_summary", "select user_id as source_id, count(*) filter (k % 2 = 0) as fetched, count(*) filter (k % 10 = 0) as parsed, count(*) filter (k % 50 = 0) as promoted, case when count(*) filter (k % 2 = 0) = 0 then 'no_fetched' when count(*) filter (k % 10 = 0) = 0 then 'no_parsed' when count(*) filter (k % 50 = 0) = 0 then 'no_promoted' else 'complete' end as coverage_state from ev group by 1", "ev")
def _(s, d):
    e = views._events(s, d)
    n = lambda m: e.where(f"k % {m} = 0").groupBy(F.col("user_id").alias("source_id")).agg(F.count("*").alias("n"))
    return quality.coverage_summary(e.select(F.col("user_id").alias("source_id")).distinct(), {"fetched": n(2), "parsed": n(10), "promoted": n(50)}, e.agg(F.max("ts").alias("stamp"))).drop("stamp")


@query("ref_74_changed_windows", "select event_type as source_id, date_trunc('day', ts) as window_start, count(*) as n from ev where ts >= timestamp '2024-01-03' and ts < timestamp '2024-01-20' and day(ts) % 3 <> 0 group by 1, 2", "ev")
def _(s, d):
    from geoflume.streaming.jobs import changed_windows

    e = views._events(s, d).select(F.col("event_type").alias("source_id"), F.lit("bronze").alias("table_name"), F.col("ts").alias("parsed_at"))
    led = e.select("source_id", "table_name", F.date_trunc("day", "parsed_at").alias("window_start")).distinct().where(F.dayofmonth("window_start") % 3 == 0).withColumn("status", F.lit("success"))
    return changed_windows(led, e, "2024-01-03", "2024-01-20").select("source_id", "window_start", "n")


@query("ref_40_incremental_snapshots", _chain("select metric_id, subject_id, window_start, metric_value, metric_delta from snap where subject_grain = 'world' and window_grain = 'day'"), "records")
def _(s, d):
    """The state of the first records, upserted with the keys that the rest touches, gives the same as one pass."""
    c = _contributions(s, d).where("subject_grain = 'world' and window_grain = 'day'")
    old, new = metrics.build_state(c.where(F.col("window_start") < NOW)), metrics.build_state(c.where(F.col("window_start") >= NOW))
    merged = versions.upsert(old, metrics.merge_state(versions.restrict_to(old, new, ["materialization_key"]), new).select(*old.columns), ["materialization_key"])
    return metrics.build_snapshots(merged, metrics.registry(s), NOW).select("metric_id", "subject_id", "window_start", "metric_value", "metric_delta")




# single steps of the metric chain, and streams


@query("ref_39_finalize", _chain("select metric_id, subject_grain, subject_id, window_grain, window_start, rollup_rule, metric_value from final"), "records")
def _(s, d):
    return metrics.finalize(metrics.state_of_records(views.records(s, d)), metrics.registry(s)).select("metric_id", "subject_grain", "subject_id", "window_grain", "window_start", "rollup_rule", "metric_value")


@query("ref_45_sorted_sets", "select user_id, list_sort(list(distinct event_type)) as kinds from events group by 1")
def _(s, d):
    return read_table(s, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"))


def _monthly(s, d):
    o = read_table(s, d, "orders").groupBy("o_custkey", F.date_trunc("month", "o_orderdate").alias("window_start")).agg(F.count("*").cast("double").alias("metric_value"))
    return o.select(F.lit("orders").alias("metric_id"), F.lit("customer").alias("subject_grain"), F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("subject_id"), F.lit("month").alias("window_grain"), "window_start", "metric_value")


_MONTHLY = "mo as (select lpad(cast(o_custkey as varchar), 9, '0') as subject_id, date_trunc('month', o_orderdate) as window_start, count(*)::double as metric_value from orders group by 1, 2)"


@query("ref_47_delta", f"select * from (with {_MONTHLY} select subject_id, window_start, metric_value - coalesce(lag(metric_value) over (partition by subject_id order by window_start), 0) as metric_delta from mo)")
def _(s, d):
    return metrics.with_delta(_monthly(s, d)).select("subject_id", "window_start", "metric_delta")


@query("ref_48_rank", f"select * from (with {_MONTHLY} select subject_id, window_start, row_number() over (partition by window_start order by metric_value desc, subject_id) as rank from mo)")
def _(s, d):
    return metrics.with_rank(_monthly(s, d)).select("subject_id", "window_start", "rank")


@query("ref_49_latest_surface", "select subject_id, metric_value from (select o_custkey as subject_id, o_totalprice as metric_value, row_number() over (partition by o_custkey order by o_orderdate desc, 'snap:' || o_orderkey desc) as rn from orders) where rn = 1")
def _(s, d):
    c = lambda v: F.lit(v)
    o = read_table(s, d, "orders").select(c("m").alias("metric_id"), c("customer").alias("subject_grain"), F.col("o_custkey").alias("subject_id"), c("").alias("place_id"), c("day").alias("window_grain"), c(0).alias("window_start"), F.col("o_orderdate").alias("snapshot_at"), F.concat(c("snap:"), "o_orderkey").alias("snapshot_id"), F.col("o_totalprice").alias("metric_value"))
    return metrics.latest_surface(o).select("subject_id", "metric_value")


@query("ref_153_explain_json", "select p_partkey, 'sum' as rollup_rule, 'm' || p_size as summary, 'm' || p_size as ref from part")
def _(s, d):
    p = read_table(s, d, "part").select("p_partkey", F.concat(F.lit("m"), "p_size").alias("metric_id"), F.lit("sum").alias("rollup_rule"))
    return metrics.explain_json(p).select("p_partkey", F.get_json_object("attrs", "$.rollup_rule").alias("rollup_rule"), F.get_json_object("attrs", "$.explainability.summary").alias("summary"), F.get_json_object("evidence", "$[0].ref").alias("ref"))


@query("ref_71_stream_latest", "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1")
def _(s, d):
    """A stream over the table's files, run until they are read."""
    from geoflume.streaming import jobs

    w = jobs.work_dir(s)
    rows = views.events_stream(s, d).select("user_id", "ts", "event_id", "event_type")
    jobs.stream_latest(rows, f"{w}/latest", ["user_id"], "ts", f"{w}/chk").awaitTermination()
    return jobs.latest_table(s, f"{w}/latest", ["user_id"], "ts").read().select("user_id", "event_id", "event_type")


def _ais_stream(s, d):
    """Raw messages made of the events, as files, each delivered twice, through the stream; the folders of vessels and of track points."""
    from geoflume.streaming import jobs

    w = jobs.work_dir(s)
    kind = F.when(F.col("event_id") % 2 == 0, "ShipStaticData").otherwise("PositionReport")
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    body = F.format_string('{"MessageType":"%s","MetaData":{"MMSI":%d,"ShipName":"S%d ","latitude":%d.5,"longitude":2.0,"time_utc":"%s +0000 UTC"},"Message":{"%s":{}}}', kind, "user_id", "event_id", F.col("event_id") % 60, when, kind)
    raw = views._events(s, d).select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("delivery"), "event_id", body.alias("m"), "ts")
    raw.select(F.concat("delivery", "event_id").alias("raw_id"), F.concat(F.lit("["), "m", F.lit("]")).alias("body"), F.col("ts").alias("fetched_at")).write.parquet(f"{w}/in")
    for q in jobs.start_ais_stream(s, f"{w}/in", f"{w}/entities", f"{w}/points", f"{w}/chk", {"availableNow": True}):
        q.awaitTermination()
    return f"{w}/entities", f"{w}/points"


@query("ref_70_ais_stream", "select 'mmsi:' || user_id as vessel_id, 'S' || arg_max(event_id, (ts, event_id)) as name from (select user_id, event_id, date_trunc('second', ts) as ts from ev) where event_id % 2 = 0 group by 1", "ev")
def _(s, d):
    """The newest name of each vessel."""
    from geoflume.streaming import jobs

    return jobs.latest_table(s, _ais_stream(s, d)[0], ["vessel_id"], "observed_at").read().select("vessel_id", "name")


@query("ref_70_ais_track_points", "select distinct on (user_id, date_trunc('second', ts)) user_id::varchar as mmsi, date_trunc('second', ts) as observed_at from ev where event_id % 2 = 1", "ev")
def _(s, d):
    """The track points, each once."""
    return s.read.schema("mmsi string, observed_at timestamp").parquet(_ais_stream(s, d)[1])


@query("ref_72_stream_dedup", "select event_id, user_id from events")
def _(s, d):
    """Every event is delivered twice and kept once."""
    from geoflume.streaming import jobs

    w = jobs.work_dir(s)
    twice = views.events_stream(s, d).select("event_id", "user_id", "ts", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    q = jobs.stream_dedup(twice, ["event_id"], "ts").select("event_id", "user_id").writeStream.format("parquet").option("path", f"{w}/out").option("checkpointLocation", f"{w}/chk")
    q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return s.read.schema("event_id long, user_id long").parquet(f"{w}/out")


@query("ref_73_stream_metric_state", _chain(f"select metric_id, subject_grain, subject_id, window_grain, window_start, n, {r4('value_sum')} as value_sum, sources from state"), "records")
def _(s, d):
    """All metrics of a stream that delivers every record twice: sums, and firsts with their sources."""
    from geoflume.streaming import jobs
    from geoflume.streaming import metrics as streams

    w = jobs.work_dir(s)
    twice = views.records(s, d, views.events_stream(s, d)).withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")
    for q in (streams.start_sums(twice, w, f"{w}/chk-sums"), streams.start_firsts(twice, w, f"{w}/chk-firsts")):
        q.awaitTermination()
    st = streams.metric_state(s, w)
    return st.select("metric_id", "subject_grain", "subject_id", "window_grain", "window_start", "n", (F.round(F.col("value_sum") * 10000, 0) / 10000).alias("value_sum"), F.size("sources").cast("long").alias("sources"))


def _changed(s, d):
    """Bronze rows, and the changes of their sources: parses and fetches of the events, k telling which."""
    from geoflume.streaming import ledger

    e = views._events(s, d).withColumns({"source_id": F.concat(F.lit("src:"), F.col("user_id") % 7), "table_name": F.concat(F.lit("bronze_"), F.col("user_id") % 7 % 3)})
    parses = e.where("k % 3 <> 2").select("source_id", "table_name", F.col("ts").alias("parsed_at"), F.when(F.col("k") % 3 == 0, "success").otherwise("failed").alias("status"))
    fetches = e.where("k % 3 = 2").select("source_id", F.col("ts").alias("fetched_at"), (F.col("k") % 2 == 0).alias("success"))
    registry = e.select("source_id", "table_name", F.when(F.col("source_id") == "src:1", "file").otherwise("http").alias("transport_type"), (F.col("source_id") != "src:2").alias("enabled")).distinct()
    rows = e.where("k % 3 = 0").select("source_id", "table_name", "event_id", F.col("ts").alias("parsed_at"))
    return rows, ledger.changes(parses, fetches, registry)


_CHANGED = "ch as (select 'src:' || (user_id % 7) as source_id, 'bronze_' || (user_id % 7 % 3) as table_name, ts as changed_at from ev where k % 3 = 0 or (k % 3 = 2 and k % 2 = 0 and user_id % 7 not in (1, 2)))"


@query("ref_74_delta_windows", f"select * from (with {_CHANGED} select source_id, table_name, 'delta' as mode, min(changed_at) as window_start, timestamp '2024-01-20 00:00:00' as window_end from ch where changed_at < timestamp '2024-01-20' group by 1, 2)", "ev")
def _(s, d):
    from geoflume.streaming import ledger

    return ledger.windows(_changed(s, d)[1], NOW).drop("checkpoint_id")


@query("ref_74_range_windows", f"select * from (with {_CHANGED} select distinct source_id, table_name, 'range' as mode, timestamp '2024-01-05 00:00:00' as window_start, timestamp '2024-01-06 00:00:00' as window_end from ch where changed_at >= timestamp '2024-01-05' and changed_at < timestamp '2024-01-06')", "ev")
def _(s, d):
    from geoflume.streaming import ledger

    return ledger.windows(_changed(s, d)[1], NOW, "2024-01-05", "2024-01-06").drop("checkpoint_id")


@query("ref_74_run_ledger", "select event_id, 'src:' || (user_id % 7) as source_id from ev where k % 3 = 0 and ts < timestamp '2024-01-20 00:00:00'", "ev")
def _(s, d):
    """Two delta runs, the first of which stops between writing and marking; every row arrives once."""
    from geoflume.sources import ingest
    from geoflume.streaming import jobs, ledger

    w = jobs.work_dir(s)
    rows, changed = _changed(s, d)
    book, work = ledger.Ledger(s, f"{w}/ledger"), lambda x: x.select("event_id", "source_id")

    def stop(step: str) -> None:
        if step == "written":
            raise InterruptedError(step)

    try:
        ledger.run(book, rows, changed, work, f"{w}/target", "2024-01-10 00:00:00", step=stop)
    except InterruptedError:
        pass
    ledger.run(book, rows, changed, work, f"{w}/target", NOW)
    return ingest.published(s, f"{w}/target", "event_id long, source_id string")
