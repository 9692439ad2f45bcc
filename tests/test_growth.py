"""Steps whose pairs, copies or skewed keys once went through a shuffle, a broadcast or one task."""

import itertools
import math
import random
from datetime import timedelta

from pyspark.sql import functions as F

from geoflume.operators import discovery, metrics, tracks, versions
from geoflume.plans.queries import QUERIES
from geoflume.sources import views
from tests.test_scale import T0, km


metrics_once = ("entity_count_approx", "source_count_approx")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_that_met_are_not_shuffled(spark, sf, monkeypatch):
    """Several parts and shares, chunks of few pairs, and missing positions, ids and times."""
    monkeypatch.setattr(tracks, "PEERS", 40)
    monkeypatch.setattr(tracks, "PAIRS", 7)
    rng = random.Random(8)
    lat = lambda: rng.choice([None, math.nan, *[rng.uniform(-90, 90) for _ in range(20)]])
    rows = [(rng.choice([None, *[f"e{k}" for k in range(12)]]), T0 + timedelta(milliseconds=rng.randrange(4_000_000)), lat(), lat()) for _ in range(150)] + [("e1", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "entity_id string, observed_at timestamp, latitude double, longitude double")
    want = {}
    for e, t, a, b in rows:
        for p, u, x, y in rows[:100]:
            if None not in (e, p, t, u) and e != p and abs((t - u) / timedelta(milliseconds=1)) <= 300_000:
                d = (2, 0.0) if None in (a, b, x, y) else (1, 0.0) if math.isnan(a + b + x + y) else (0, round(km(a, b, x, y), 6))
                want[e, p] = min(want.get((e, p), (3, 0.0)), d)
    got = tracks.min_distance(df, spark.createDataFrame(rows[:100], df.schema)).collect()
    assert len(got) == len(want) > 100
    assert {(r.entity_id, r.peer_id): (2, 0.0) if r.distance_km is None else (1, 0.0) if math.isnan(r.distance_km) else (0, round(r.distance_km, 6)) for r in got} == want
    p = views.points(spark, sf)
    assert "peer_id" not in "".join(x for x in plan(tracks.min_distance(p, p)).splitlines() if "Exchange" in x)
    assert tracks.min_distance(df, df.where("false")).count() == tracks.min_distance(df.where("false"), df).count() == 0


def test_shares_of_pairs_have_a_task_each_and_few_peers(spark, monkeypatch):
    """Hashed blocks left tasks without rows beside tasks with several; peers of a task are so few that a file's dictionary holds them."""
    monkeypatch.setattr(tracks, "PEERS", 500)
    monkeypatch.setattr(tracks, "ID_BYTES", 400, raising=False)
    rows = [(f"e{k % 120:03}", T0 + timedelta(milliseconds=k), k % 7 * 1.0, k % 11 * 1.0) for k in range(960)]
    df = spark.createDataFrame(rows, "entity_id string, observed_at timestamp, latitude double, longitude double")
    out = tracks.min_distance(df, df)
    by = out.groupBy(F.spark_partition_id().alias("k")).agg(F.count("*").alias("n"), F.count_distinct("peer_id").alias("peers")).collect()
    assert len(by) == out.rdd.getNumPartitions() and max(r.peers for r in by) <= 50
    assert out.count() == sum(r.n for r in by) == 120 * 119 == out.select("entity_id", "peer_id").distinct().count()


def test_circles_cells_are_not_broadcast(spark, sf):
    p, a = views.points(spark, sf), views.airports(spark, sf).withColumn("radius_km", F.lit(400.0))
    lines = [x for x in plan(tracks.place_intersections(p, a)).splitlines() if "Join" in x]
    assert any("SortMergeJoin" in x and "cy" in x for x in lines) and not any("Broadcast" in x and "cy" in x for x in lines)


def test_circles_of_all_sizes_equal_all_pairs(spark):
    rng = random.Random(5)
    at = lambda: (rng.choice([rng.uniform(-90, 90), rng.uniform(88, 90), rng.uniform(0, 2)]), rng.choice([rng.uniform(-180, 180), rng.uniform(179, 180), -179.9, 190.0, rng.uniform(0, 2)]))
    circles = [(f"c{k}", *at(), r) for k, r in enumerate([0.0, 0.5, 60.0, 400.0, 400.0, 3000.0, 9000.0, 20037.5, 30000.0, -1.0, None] * 3)] + [("here", 1.0, 1.0, 0.0)]
    pts = [(k, *at()) for k in range(300)] + [(300, 1.0, 1.0), (301, None, 1.0)]
    c = spark.createDataFrame(circles, "place_id string, latitude double, longitude double, radius_km double")
    p = spark.createDataFrame(pts, "point_id long, latitude double, longitude double")
    near = lambda a, b, x, y: km(a, b, x, y) * 6378.137 / 6371
    want = {(i, k) for i, a, b in pts for k, x, y, r in circles if a is not None and r is not None and near(a, b, x, y) <= r}
    got = [(r.point_id, r.place_id) for r in tracks.place_intersections(p, c).collect()]
    assert len(got) == len(set(got)) and set(got) == want and (300, "here") in want


def test_points_of_one_position_meet_a_circle_once(spark, monkeypatch):
    """Their rows for a circle stand together, so files stay small; small shares and blocks give the same rows, and missing ids stay."""
    rng = random.Random(9)
    at = [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(20)]
    pts = [(None if k % 50 == 7 else k, *at[k % 20]) for k in range(500)] + [(k, None, 1.0) for k in range(3)]
    circles = [(f"c{k}", rng.uniform(-3, 3), rng.uniform(-3, 3), r) for k, r in enumerate([60.0, 300.0, 400.0, 3000.0] * 5)]
    c = spark.createDataFrame(circles, "place_id string, latitude double, longitude double, radius_km double")
    p = spark.createDataFrame(pts, "point_id long, latitude double, longitude double").repartition(5)
    near = lambda a, b, x, y: km(a, b, x, y) * 6378.137 / 6371
    order = lambda x: (x[0] is None, x)
    want = sorted(((i, k) for i, a, b in pts for k, x, y, r in circles if a is not None and near(a, b, x, y) <= r), key=order)
    got = [(r.point_id, r.place_id, r.distance_km) for r in tracks.place_intersections(p, c).collect()]
    assert sorted(((i, k) for i, k, _ in got), key=order) == want and len(want) > 3000
    runs = sum(x[1:] != y[1:] for x, y in zip(got, got[1:])) + 1
    assert runs <= len(set(x[1:] for x in got)) <= len(got) / 20
    monkeypatch.setattr(tracks, "CELL_PAIRS", 300, raising=False)
    monkeypatch.setattr(tracks, "BLOCK", 10, raising=False)
    small = [(r.point_id, r.place_id, r.distance_km) for r in tracks.place_intersections(p, c).collect()]
    assert sorted(small, key=order) == sorted(got, key=order)
    assert tracks.place_intersections(p, c.where("false")).count() == tracks.place_intersections(p.where("false"), c).count() == 0


def test_families_pairs_are_not_counted_by_a_shuffle(spark, sf):
    tags = [None, [], ["a", "A "], ["a", "b"], ["b", "a", None], ["c"]]
    scopes = [None, "", "National x", "subnational", "city"]
    t = [(f"t{k}", *x) for k, x in enumerate(itertools.product(tags, scopes))] * 2
    m = [(f"m{k}", u, *x) for k, (u, *x) in enumerate(itertools.product(["http://x", " "], tags, scopes))]
    got = discovery.expand_families(spark.createDataFrame(t[:31], "template_id string, tags array<string>, scope string"), spark.createDataFrame(m, "member_id string, candidate_url string, tags array<string>, scope string"))
    assert "template_id" not in "".join(x for x in plan(got).splitlines() if "Exchange hashpartitioning" in x.split(", ENSURE")[0] and "member_id" in x)
    assert not any("Exchange hashpartitioning(template_id" in x for x in plan(got).splitlines())
    norm = lambda x: {y.strip().lower() for y in x or [] if y is not None}
    want = []
    for (ti, tt, ts), (mi, u, mt, ms) in itertools.product(t[:30], m):
        n, a, b = len(norm(tt) & norm(mt)), (ts or "").strip().lower(), (ms or "").strip().lower()
        if u.strip() and n and (not a or not b or n >= 2 or any(k in a and k in b for k in ("national", "subnational", "global"))):
            want.append((f"{ti}:{mi}", n))
    assert sorted((r.source_id, r.shared) for r in got.distinct().collect()) == sorted(want)


def test_templates_of_a_family_come_again_within_a_chunk(spark, monkeypatch):
    """Ids a few rows apart pack well; a template without id and one that stands twice keep their rows."""
    monkeypatch.setattr(discovery, "SHARES", 2)
    monkeypatch.setattr(discovery, "CHUNK", 5, raising=False)
    t = [(None if k == 3 else f"t{k % 60}", ["a", "b"], "") for k in range(62)]
    m = [(f"m{k}", "http://x", ["b"], "") for k in range(40)]
    got = discovery.expand_families(spark.createDataFrame(t, "template_id string, tags array<string>, scope string"), spark.createDataFrame(m, "member_id string, candidate_url string, tags array<string>, scope string")).collect()
    assert sorted((r.template_id or "", r.member_id) for r in got) == sorted((x[0] or "", y[0]) for x in t for y in m)
    assert {r.source_id for r in got if r.template_id is None} == {y[0] for y in m}
    last, apart = {}, []
    for k, r in enumerate(got):
        apart += [k - last[r.template_id]] if r.template_id in last else []
        last[r.template_id] = k
    assert sorted(apart)[len(apart) * 9 // 10] <= 20


def test_nearest_peers_copies_are_not_broadcast(spark, sf, monkeypatch):
    seen = []
    keep = tracks.files.staged
    monkeypatch.setattr(tracks.files, "staged", lambda df, name: seen.append((name, plan(df))) or keep(df, name))
    p = views.points(spark, sf)
    assert tracks.nearest_peer(p, p).count() > 0
    rounds = [x for n, x in seen if n == "nearest-peer"]
    assert rounds and not any("BroadcastHashJoin [slot" in x for x in rounds)


def test_first_records_are_combined_before_scopes(spark, sf):
    """No row per record and scope goes into a sort: the first aggregate is by places, and metrics that aren't asked for aren't made."""
    lines = plan(metrics.emit_contributions(views.records(spark, sf), metrics_once)).splitlines()
    assert not any("partial_min" in x and "subject_grain" in x and "Exchange" in y for x, y in zip(lines[1:], lines)) and "contribution_value" not in "".join(x for x in lines if "Generate" in x)
    every = metrics.emit_contributions(views.records(spark, sf))
    for only in (metrics_once, ("trend_7d",), ("trend_7d", "source_count_approx")):
        got, want = metrics.emit_contributions(views.records(spark, sf), only), every.where(F.col("metric_id").isin(*only))
        assert got.columns == every.columns and got.count() == want.count() > 0
        assert got.exceptAll(want).isEmpty()


def test_partial_states_equal_those_of_contributions(spark, sf):
    """Halves by record, records without source or places too; no row per record and scope, and none per contribution, is aggregated."""
    part = lambda r: F.pmod(F.xxhash64(r), F.lit(2))
    odd = lambda k, n, x, v: F.when(F.pmod(F.hash("record_id"), F.lit(n)) == k, v).otherwise(F.col(x)).alias(x)
    rec = views.records(spark, sf)
    rec = rec.withColumns({"source_id": odd(0, 5, "source_id", None), "place_id": odd(1, 5, "place_id", ""), "continent_place_id": odd(2, 5, "continent_place_id", None), "entity_id": odd(3, 5, "entity_id", ""), "confidence": odd(4, 5, "confidence", None)})
    key = lambda df: sorted((r.materialization_key, r.n, round(r.value_sum, 4), round(r.weight_sum, 4), r.peak_value, tuple(sorted(r.sources)), r.window_end, r.latest) for r in df.collect())
    c = metrics.emit_contributions(rec).persist()
    got = metrics.partial_states(rec, part).persist()
    assert key(got) == sorted(sum((key(metrics.build_state(c.where(part(F.col("record_id")) == k))) for k in (0, 1)), []))
    assert key(metrics.merge_state(got)) == key(metrics.build_state(c))
    once = metrics.partial_states(rec, None, metrics_once)
    assert key(once) == key(metrics.build_state(c.where(~F.col("metric_id").isin(*metrics_once))))
    lines = plan(QUERIES["ref_38_metric_state"](spark, sf)).splitlines()
    assert not any("contribution_value" in x and "Generate" in x for x in lines)
    assert any("HashAggregate(keys=[place_id" in x for x in lines)
    c.unpersist(), got.unpersist()


def test_a_few_wanted_tuples_are_broadcast(spark, sf):
    li = views.read_table(spark, sf, "lineitem")
    want = spark.createDataFrame([("A", "F"), ("A", "F"), (None, "O")], "l_returnflag string, l_linestatus string")
    got = versions.restrict_to(li, want, ["l_returnflag", "l_linestatus"])
    assert "BroadcastHashJoin" in plan(got) and got.count() == li.where("l_returnflag = 'A' and l_linestatus = 'F'").count()
    e = spark.createDataFrame([("a", "s", "", 1)], "entity_id string, source_id string, marking string, record_version int")
    assert "BroadcastHashJoin" in plan(versions.backfill_marking(e, spark.createDataFrame([("s", "open")], "source_id string, default_marking string")))


def test_asof_match_deals_out_tasks_by_rows(spark, sf, monkeypatch):
    """A task's rows grew with the input, and its sort stood beside a table of all its calls."""
    monkeypatch.setattr(tracks, "ASOF_ROWS", 500, raising=False)
    out = QUERIES["ref_31_asof_match"](spark, sf)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 1000


def test_asof_match_of_repeated_orders_and_missing_keys(spark, tmp_path):
    """A call under two orders is one row with the latest gap, and a missing customer has no gap."""
    o = [(1, 7, T0), (2, 7, T0 + timedelta(days=1)), (3, 7, T0 + timedelta(days=2)), (3, 7, T0 + timedelta(days=5)), (4, 8, T0), *[(k, None, T0 + timedelta(days=k)) for k in (5, 6, 7)], (9, 7, None)]
    spark.createDataFrame(o, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    li = [(k, 1, 1, "A", T0) for k in (1, 2, 3, 4, 7, 9)]
    spark.createDataFrame(li, "l_orderkey long, l_linenumber int, l_suppkey long, l_returnflag string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 3)], "s_suppkey long, s_nationkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    got = sorted((r.call_id, r.gap_end) for r in QUERIES["ref_31_asof_match"](spark, str(tmp_path)).collect())
    assert got == [("call:1:1", None), ("call:2:1", None), ("call:3:1", T0 + timedelta(days=2)), ("call:4:1", None), ("call:7:1", None), ("call:9:1", None)]
