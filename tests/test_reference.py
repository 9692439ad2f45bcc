"""Operators with known results: small tables, replays, merges, and streams against batches."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from geoflume.functions import cols
from geoflume.operators import metrics, packs, places, promote, serve, tracks, versions
from geoflume.sources import ingest, views
from geoflume.streaming import jobs

NOW = datetime(2026, 3, 10, 12)


def records(spark):
    t = lambda **k: NOW - timedelta(**k)
    rows = [
        ("obs:fr:previous", "observation", "ent:alpha", "plc:fr-idf-paris", "plc:fr", "plc:continent:eu", "src:alpha", t(days=7), t(days=7, minutes=30), True, False, False, 1, 0.5, 1, 0.2, 0.3, 0.05, 0.7),
        ("obs:paris-fr:current", "observation", "ent:alpha", "plc:fr-idf-paris", "plc:fr", "plc:continent:eu", "src:bravo", NOW, t(minutes=90), True, True, False, 2, 0.9, 3, 0.8, 0.7, 0.4, 1.5),
        ("evt:paris-tx:current", "event", "ent:bravo", "plc:us-tx-paris", "plc:us", "plc:continent:na", "src:charlie", NOW, None, False, False, True, 1, 0.4, 1, 0.6, 0.2, -0.2, 2.0),
        ("obs:paris-fr:duplicate", "observation", "ent:alpha", "plc:fr-idf-paris", "plc:fr", "plc:continent:eu", "src:bravo", NOW, t(minutes=60), True, True, False, 3, 0.8, 2, 0.7, 0.6, 0.1, 0.5),
    ]
    schema = "record_id string, record_type string, entity_id string, place_id string, admin0_place_id string, continent_place_id string, source_id string, occurred_at timestamp, published_at timestamp, geolocation_succeeded boolean, deduplicated boolean, schema_drift_detected boolean, confirming_source_count int, confidence double, evidence_count int, burst_score double, risk_score double, acceleration_7d_vs_30d double, anomaly_zscore_30d double"
    return spark.createDataFrame(rows, schema)


def test_metric_values(spark):
    snap = metrics.build_snapshots(metrics.build_state(metrics.emit_contributions(records(spark))), metrics.registry(spark), NOW)
    got = {r.metric_id: r for r in snap.where("subject_grain = 'world'").orderBy("window_start").collect()}
    want = {
        "geolocation_success_rate": 0.6667, "source_diversity_score": 0.6667, "source_count_approx": 2, "entity_count_approx": 2, "confidence_weighted_activity": 2.1, "evidence_density": 2, "dedup_rate": 0.6667,
        "schema_drift_rate": 0.3333, "cross_source_confirmation_rate": 0.6667, "anomaly_zscore_30d": 1.3333, "trend_24h": 3, "acceleration_7d_vs_30d": 0.3,
    }
    assert {k: got[k].metric_value for k in want} == pytest.approx(want)
    assert got["trend_7d"].metric_delta == 2


def test_metric_record_values(spark):
    c = {(r.metric_id, r.record_id): r.contribution_value for r in metrics.emit_contributions(records(spark)).where("subject_grain = 'world'").collect()}
    assert c["freshness_lag_minutes", "obs:paris-fr:current"] == 90 and c["geolocation_success_rate", "evt:paris-tx:current"] == 0
    assert c["confidence_weighted_activity", "obs:paris-fr:current"] == 0.9 and c["acceleration_7d_vs_30d", "evt:paris-tx:current"] == -0.2
    assert ("freshness_lag_minutes", "evt:paris-tx:current") not in c


def test_state_merges_to_one_pass(spark):
    c = metrics.emit_contributions(records(spark))
    key = lambda df: {r.materialization_key: (r.n, round(r.value_sum, 9), round(r.weight_sum, 9), r.peak_value, sorted(r.sources)) for r in df.collect()}
    parts = [metrics.build_state(c.where(F.pmod(F.hash("record_id"), F.lit(3)) == k)) for k in range(3)]
    assert key(metrics.merge_state(*parts)) == key(metrics.build_state(c))


def test_state_of_records_equals_state_of_contributions(spark):
    """The wide sums give the same rows, with null ids, blank sources and repeated rows among the records."""
    from geoflume.sources.views import records as view

    r = view(spark, "/root/testdata/sf0.001")
    odd = r.limit(50).withColumn("source_id", F.when(F.col("record_id") < "obs:3", F.lit("")).otherwise(F.lit(None))).withColumn("entity_id", F.lit(None).cast("string")).withColumn("place_id", F.lit(None).cast("string"))
    r = r.unionByName(odd).unionByName(r.limit(20)).unionByName(r.limit(5).withColumn("record_type", F.lit("note")).withColumn("confidence", F.lit(None).cast("double")))
    near = lambda x: None if x is None else round(x, 6) + 0.0
    key = lambda df: sorted((x.materialization_key, x.metric_id, x.subject_id, str(x.window_start), str(x.window_end), x.n, near(x.value_sum), near(x.weight_sum), x.peak_value, tuple(sorted(x.sources)), x.latest.contribution_value) for x in df.collect())
    got, want = metrics.state_of_records(r), metrics.build_state(metrics.emit_contributions(r))
    assert got.columns == [x for x in want.select(*metrics.SUBJECT, "materialization_key", "window_end", "n", "value_sum", "weight_sum", "peak_value", "sources", "latest").columns]
    assert key(got) == key(want)
    assert metrics.state_of_records(r.where("false")).count() == 0


def test_upsert_twice_is_once(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = versions.upsert(base, new, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, versions.upsert(once, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def box(lat, lon, size):
    p = [(lon, lat), (lon + size, lat), (lon + size, lat + size), (lon, lat + size), (lon, lat)]
    return [[[{"lon": float(x), "lat": float(y)} for x, y in p]]]


def place_rows(spark):
    data = [
        ("plc:world", "", "World", -2, -90.0, -180.0, 90.0, 180.0, box(-90, -180, 360)), ("plc:ovl", "plc:world", "Overlap", 0, 10.0, 10.0, 14.0, 14.0, box(10, 10, 4)),
        ("plc:ovl-west", "plc:ovl", "West", 2, 10.5, 10.5, 11.5, 11.5, box(10.5, 10.5, 1)), ("plc:ovl-east", "plc:ovl", "East", 2, 10.5, 10.5, 12.5, 12.5, box(10.5, 10.5, 2)), ("plc:lost", "plc:gone", "Lost", 1, 50.0, 50.0, 51.0, 51.0, box(50, 50, 1)),
    ]
    return spark.createDataFrame(data, "place_id string, parent_place_id string, canonical_name string, admin_level int, min_lat double, min_lon double, max_lat double, max_lon double, polygons array<array<array<struct<lon:double,lat:double>>>>").withColumn("place_type", F.lit("area"))


def test_point_in_place(spark):
    pts = spark.createDataFrame([(1, 11.0, 11.0), (2, 12.2, 12.2), (3, 10.5, 11.0), (4, 13.9, 13.9), (5, -40.0, 2.0), (6, 14.0, 14.0)], "point_id long, latitude double, longitude double")
    got = {r.point_id: r.place_id for r in places.point_in_place(pts, place_rows(spark), 1.0).collect()}
    assert got == {1: "plc:ovl-west", 2: "plc:ovl-east", 3: "plc:ovl-west", 4: "plc:ovl", 5: "plc:world", 6: "plc:ovl"}


def test_lineage_and_closure(spark):
    lin = {r.place_id: r for r in places.lineage(place_rows(spark)).collect()}
    assert lin["plc:ovl-west"].path == "plc:world>plc:ovl>plc:ovl-west" and lin["plc:ovl-west"].admin0_place_id == "plc:ovl"
    assert lin["plc:lost"].parent_missing and not lin["plc:ovl"].parent_missing
    assert places.closure(place_rows(spark)).where("ancestor_id = 'plc:world'").count() == 4


def test_attribution_cascade(spark):
    cols_ = "subject_id int, source_id string, latitude double, longitude double, polygon_lat double, polygon_lon double, bbox_lat double, bbox_lon double, name_place_id string, name_score double, reverse_lat double, reverse_lon double, track_place_id string, home_place_id string, jurisdiction_place_id string"
    n = None
    rows = [(1, "s", 11.0, 11.0, n, n, n, n, "x", 0.9, n, n, "", "", ""), (2, "s", n, n, 11.0, 11.0, n, n, "", n, n, n, "", "", ""), (3, "s", n, n, n, n, n, n, "plc:a", 0.5, 11.0, 11.0, "t", "", ""), (4, "s", n, n, n, n, n, n, "", n, 11.0, 11.0, "t", "", ""), (5, "s", n, n, n, n, n, n, "", n, n, n, "", "", "j"), (6, "s", n, n, n, n, n, n, "", n, n, n, "", "", "")]
    out = places.attribute(spark.createDataFrame(rows, cols_), place_rows(spark), cell=1.0)
    got = {r.subject_id: (r.method, r.confidence, r.resolved) for r in out.collect()}
    assert got == {1: ("coordinate", 0.99, True), 2: ("polygon", 0.95, True), 3: ("name", 0.5, False), 4: ("reverse", 0.78, True), 5: ("jurisdiction", 0.66, True), 6: ("none", 0.0, False)}
    assert {r.subject_id: r.reason for r in places.unresolved(out, NOW).collect()} == {3: "low_confidence", 6: "no_match"}


def test_maritime_values(spark):
    h = lambda x: NOW - timedelta(hours=x)
    gaps = spark.createDataFrame([("v", h(72), h(54), "plc:sea:arabian-gulf"), ("v", h(30), h(23.5), "plc:port:ae-fjr")], "entity_id string, starts_at timestamp, ends_at timestamp, next_known_port_id string")
    calls = spark.createDataFrame([("c", "v", "plc:port:ae-fjr", "Fujairah Anchorage", h(10), h(2))], "call_id string, entity_id string, place_id string, port_name string, started_at timestamp, ended_at timestamp")
    sig = spark.createDataFrame([("v", 24.5, 2, 2, 1, 1.0, 2, 0.7, 0.8, 19, "PA", "TZ")], "entity_id string, ais_dark_hours double, ais_gap_frequency int, flag_changes_90d int, ownership_changes_180d int, sanctions_exposure double, high_risk_port_calls int, sts_suspicion_score double, route_deviation_score double, vessel_age_years int, registry_flag_state string, observed_flag_state string")
    one = lambda df: df.first().metric_value
    assert one(packs.ais_dark_hours_sum(gaps)) == 24.5 and one(packs.anchorage_dwell_hours(calls)) == 8 and one(packs.port_gap_hours(calls, gaps)) == 13.5
    assert one(packs.flag_registry_mismatch(sig)) == 0.9 and one(packs.route_deviation_score(sig)) == 0.8 and one(packs.shadow_fleet_score(sig)) == 0.7253


def test_conjunction_value(spark):
    a = spark.createDataFrame([("s", 24.9, 1e-5)], "satellite_id string, miss_distance_km double, probability double")
    assert packs.conjunction_risk(a).first().metric_value == 0.0076


def test_ids_and_columns(spark):
    row = spark.range(1).select(
        cols.id_part(F.lit("  a b//c__d. ")).alias("a"), cols.id_part(F.lit(" ")).alias("b"), F.length(cols.id_part(F.lit("x" * 200))).alias("n"), cols.canonical_id("event", F.lit("s"), F.lit("n 1")).alias("c"),
        cols.normalize_url(F.lit("HTTP://User@Example.com:80//a//b/?utm_source=x&b=2&a=1&fbclid=3#f")).alias("u"), cols.weight(F.lit(float("nan"))).alias("w"), cols.band(F.lit(0.8), [(0.9, "high"), (0.75, "medium")], "low").alias("band"),
    ).first()
    assert (row.a, row.b, row.n, row.c, row.u, row.w, row.band) == ("a_b_c_d", "unknown", 71, "event:s:n_1", "http://example.com/a/b?a=1&b=2", 0.0, "medium")


def test_tracks(spark):
    t0 = datetime(2024, 1, 1)
    pts = [(i, "t", "e", t0 + timedelta(minutes=m), 0.0, 0.1 * i, 1000.0, False, "", 0, "") for i, m in enumerate([0, 5, 10, 60, 65, 70])]
    p = spark.createDataFrame(pts, "point_id long, track_id string, entity_id string, observed_at timestamp, latitude double, longitude double, altitude_m double, on_ground boolean, squawk string, category int, callsign string")
    assert tracks.gap_events(p).first().gap_hours == 0.8333
    seg = tracks.segment_geometry(p).orderBy("segment_no").collect()
    assert [(s.point_count, s.gap_count, s.turn_count) for s in seg] == [(3, 1, 0), (3, 0, 0)]
    assert seg[0].distance_km == pytest.approx(2 * 6371 * math.radians(0.1), abs=1e-3)
    air = spark.createDataFrame([("a1", "plc:a", "public", 0.0, 0.01), ("a2", "plc:b", "public", 60.0, 60.0)], "airport_id string, place_id string, use string, latitude double, longitude double")
    assert {r.point_id: r.site_id for r in tracks.nearest_within(p, air).collect()} == {0: "a1", 1: "a1", 2: "a1"}


def test_promotion_replays_without_duplicates(spark):
    rows = [("s", f"raw{i}", kind, native, NOW, NOW + timedelta(seconds=i), 0, "plc:a" if conf else "", bool(conf), conf, "n", 1.0, None) for i, (kind, native, conf) in enumerate([("observation", "1", 1.0), ("event", "2", 0.9), ("entity", "3", 0.0), ("observation", "4", 0.7), ("observation", "1", 1.0), ("odd", "5", 1.0), ("event", "", 1.0)])]
    df = spark.createDataFrame(rows, "source_id string, raw_id string, record_kind string, native_id string, occurred_at timestamp, parsed_at timestamp, source_record_index int, place_id string, resolved boolean, location_confidence double, name string, value double, entity_ref string")
    out = {k: v.count() for k, v in promote.promote(df, NOW).items()}
    assert out == {"observations": 1, "events": 1, "entities": 1, "unresolved": 1, "rejects": 2}
    again = df.union(df.withColumn("raw_id", F.concat(F.lit("x"), "raw_id")))
    assert {k: v.count() for k, v in promote.promote(again, NOW).items()} == out | {"rejects": 4}


def test_ingest_formats(spark, tmp_path):
    bodies = [(' {"id": 1}', "json"), ("<!DOCTYPE html><p>", "html"), ("<?xml version='1.0'?><rss/>", "rss"), ("<feed/>", "atom"), ("a\tb\n1\t2", "tsv"), ("a,b", "csv"), ("", "text"), (None, "text"), ("<x/>", "xml")]
    df = spark.createDataFrame(bodies, "body string, want string")
    assert all(r.f == r.want for r in df.select("want", ingest.sniff_format("body").alias("f")).collect())
    (tmp_path / "x.csv").write_text("dataset_id,item_key,item_value\nd,a,1\nd,b,2\n")
    assert ingest.load_staged_csv(spark, str(tmp_path / "x.csv"), "dataset_id string, item_key string, item_value string", "x", NOW).count() == 2


def test_knn_limits(spark):
    e = spark.createDataFrame([("a", "x", [1.0, 0.0]), ("b", "x", [0.0, 1.0]), ("c", "y", [1.0, 0.0])], "entity_id string, entity_type string, embedding array<double>")
    assert [r.entity_id for r in serve.knn(e, [1.0, 0.0], k=2).collect()] == ["a", "c"]
    assert [r.entity_id for r in serve.knn(e, [1.0, 0.0], k=5, kind="x", min_score=0.5).collect()] == ["a"]
    with pytest.raises(ValueError):
        serve.knn(e, [1.0, 0.0], k=1001)


def test_ais_stream(spark, tmp_path):
    msg = lambda kind, mmsi, s, extra: f'{{"MessageType":"{kind}","MetaData":{{"MMSI":{mmsi},"ShipName":"S{s} ","latitude":1.0,"longitude":2.0,"time_utc":"2024-01-01 00:00:0{s}.1 +0000 UTC"}},"Message":{{"{kind}":{{{extra}}}}}}}'
    rows = [("r1", f"[{msg('PositionReport', 1, 1, chr(34) + 'Sog' + chr(34) + ':10')},{msg('ShipStaticData', 1, 2, '')}]", NOW), ("r2", f"[{msg('PositionReport', 1, 1, '')},{msg('ShipStaticData', 1, 5, '')}]", NOW)]
    spark.createDataFrame(rows, "raw_id string, body string, fetched_at timestamp").write.parquet(str(tmp_path / "in"))
    e, p = jobs.start_ais_stream(spark, str(tmp_path / "in"), str(tmp_path / "ents"), str(tmp_path / "pts"), str(tmp_path / "chk"), {"availableNow": True})
    assert e.awaitTermination(120) and p.awaitTermination(120)
    ents = jobs.latest_table(spark, str(tmp_path / "ents"), ["vessel_id"], "observed_at").read()
    assert [(r.vessel_id, r.name) for r in ents.collect()] == [("mmsi:1", "S5")]
    assert spark.read.parquet(str(tmp_path / "pts")).count() == 1


def test_entry_points(spark):
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 140
    assert entry.entry(spark).limit(1).count() == 1


def test_knn_batch_takes_more_seeds_than_a_block(spark):
    from pyspark.sql import functions as F

    from geoflume.operators import serve

    emb = spark.range(1200).select(F.col("id").alias("entity_id"), F.array(F.cos(F.col("id") / 200), F.sin(F.col("id") / 200)).alias("embedding"))
    seeds = emb.select(F.col("entity_id").alias("seed_id"), F.col("embedding").alias("seed_vector"))
    got = {r.seed_id: r.entity_id for r in serve.knn_batch(emb, seeds, 1).collect()}
    assert len(got) == 1200 and all(abs(a - b) == 1 for a, b in got.items())
    few = seeds.where("seed_id < 50")
    assert set(map(tuple, serve.knn_batch(emb, few, 3, block=7).select("seed_id", "entity_id", "rank").collect())) == set(map(tuple, serve.knn_batch(emb, few, 3).select("seed_id", "entity_id", "rank").collect()))


def test_closure_walks_to_the_root_and_names_cycles(spark):
    tree = spark.createDataFrame([(f"p{k}", f"p{k - 1}" if k else "") for k in range(12)], "place_id string, parent_place_id string")
    got = places.closure(tree).collect()
    assert len(got) == 78 and {(r.ancestor_id, r.depth) for r in got if r.descendant_id == "p11"} == {(f"p{k}", 11 - k) for k in range(12)}
    loop = spark.createDataFrame([("a", "b"), ("b", "a")], "place_id string, parent_place_id string")
    with pytest.raises(Exception, match="RECURSION"):
        places.closure(loop, 15).count()


def test_nearest_over_the_date_line_and_near_the_pole(spark):
    p = spark.createDataFrame([(0, 10.0, 179.99, True), (1, 85.0, 1.0, True), (2, 89.9, 100.0, True), (3, -85.0, -179.9, True), (4, 10.0, 170.0, True)], "point_id long, latitude double, longitude double, on_ground boolean").withColumn("altitude_m", F.lit(0.0))
    a = spark.createDataFrame([("a0", 10.0, -179.99), ("a1", 85.0, -1.0), ("a2", 89.9, -80.0), ("a3", -85.0, 179.9)], "airport_id string, latitude double, longitude double").withColumn("place_id", F.col("airport_id"))
    assert {r.point_id: r.site_id for r in tracks.nearest_within(p, a).collect()} == {0: "a0", 1: "a1", 2: "a2", 3: "a3"}
    rng = random.Random(2)
    pts = [(i, rng.choice([rng.uniform(-90, 90), rng.uniform(84, 90)]), rng.uniform(-180, 180)) for i in range(300)]
    circles = [(f"c{k}", rng.uniform(-90, 90), rng.choice([180.0, -180.0, rng.uniform(-180, 180)]), rng.choice([200.0, 900.0, 2500.0])) for k in range(25)]

    def km(a, b, x, y):
        h = math.sin(math.radians(x - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(x)) * math.sin(math.radians(y - b) / 2) ** 2
        return 2 * 6378.137 * math.atan2(math.sqrt(h), math.sqrt(max(0, 1 - h)))

    got = tracks.place_intersections(spark.createDataFrame(pts, "point_id long, latitude double, longitude double"), spark.createDataFrame(circles, "place_id string, latitude double, longitude double, radius_km double")).collect()
    assert sorted((r.point_id, r.place_id) for r in got) == sorted((i, c) for i, a, b in pts for c, x, y, r in circles if km(a, b, x, y) <= r)


def test_coverage_gaps_count_all_gaps_and_unseen_keys(spark):
    w = spark.createDataFrame([("a", "2024-01-01", "2024-01-11"), ("b", "2023-01-01", "2023-02-01"), ("c", "2024-01-06", "2024-01-06"), ("c", "2024-01-02", "2024-01-08"), ("c", "2024-01-20", "2024-02-20")], "k string, s string, e string")
    w = w.select("k", F.col("s").cast("timestamp").alias("starts_at"), F.col("e").cast("timestamp").alias("ends_at"))
    got = {r.k: (r.largest_gap_hours, r.mean_gap_hours, r.gaps) for r in tracks.coverage_gaps(w, ["k"], "2024-01-01", "2024-01-31").collect()}
    assert got == {"a": (480.0, 240.0, 2), "b": (720.0, 720.0, 1), "c": (288.0, 78.0, 4)}


def test_name_match_folds_the_country(spark):
    p = spark.createDataFrame([("x", "Paris", [], "FR", 2), ("y", "Paris", [], "US", 2)], "place_id string, canonical_name string, alternate_names array<string>, country_code string, admin_level int")
    got = places.match_name(spark.createDataFrame([(1, "paris", "us")], "hint_id long, name string, country_code string"), p).collect()
    assert [(r.place_id, r.confidence) for r in got] == [("y", 0.7)]


def test_proximity_of_entities_without_a_peer(spark):
    t = "2024-01-01 00:00:00"
    p = spark.createDataFrame([("a", t, 1.0, 1.0, 7), ("b", t, 1.0, 1.1, 0), ("c", "2024-01-02 00:00:00", 1.0, 1.0, 0)], "entity_id string, t string, latitude double, longitude double, category int").withColumn("observed_at", F.col("t").cast("timestamp"))
    got = {r.entity_id: (r.closest_peer_id, r.metric_value > 0) for r in tracks.proximity(p, p.where("category = 7")).collect()}
    assert got == {"a": ("", False), "b": ("a", True), "c": ("", False)}
