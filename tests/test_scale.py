"""Operators whose large groups are cut up, against plain versions of themselves."""

import math
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from geoflume.operators import metrics, places, quality, tracks

T0 = datetime(2024, 1, 1)


def km(a, b, x, y):
    h = math.sin(math.radians(x - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(x)) * math.sin(math.radians(y - b) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(h), math.sqrt(max(0, 1 - h)))


def test_ranks_over_range_partitions_equal_a_window(spark):
    """A key with most rows, ties, null keys and values."""
    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 0.0, 1.0, 1.0, rng.random()]), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double, id long").repartition(7)
    got = metrics.ranked(df, ["k"], [F.desc("v"), F.asc("id")])
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"), "id")).cast("long"))
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert metrics.ranked(df.where("false"), ["k"], [F.asc("id")]).count() == 0


def test_nearest_peer_is_exact_near_and_far(spark):
    """Peers close by, thousands of km away, at the poles and over the date line; two that are equally near; none at all."""
    rng = random.Random(4)
    at = lambda: (rng.choice([rng.uniform(-90, 90), rng.uniform(88, 90), rng.uniform(0, 2)]), rng.choice([rng.uniform(-180, 180), rng.uniform(179, 180), rng.uniform(-180, -179), rng.uniform(0, 2)]))
    rows = [(f"e{rng.randrange(40)}", T0 + timedelta(seconds=rng.randrange(4000)), *at()) for _ in range(250)]
    rows += [("tie", T0, 10.0, 10.0), ("p1", T0, 10.0, 11.0), ("p0", T0, 10.0, 9.0), ("alone", T0 + timedelta(days=9), 1.0, 1.0), ("nowhere", T0, None, 1.0)]
    df = spark.createDataFrame(rows, "entity_id string, observed_at timestamp, latitude double, longitude double")
    peers = df.where("entity_id rlike '^p|[05]$'")
    want = {}
    for e, t, a, b in rows:
        for p, u, x, y in rows:
            if a is not None and x is not None and e != p and (p[0] == "p" or p[-1] in "05") and abs((t - u).total_seconds()) <= 300:
                want[e] = min(want.get(e, (math.inf, "")), (round(km(a, b, x, y), 6), p))
    got = {r.entity_id: (round(r.distance_km, 6), r.peer_id) for r in tracks.nearest_peer(df, peers).collect()}
    assert got == want and got["tie"][1] == "p0" and "alone" not in got and max(d for d, _ in got.values()) > 3200
    pairs = tracks.min_distance(df.where("latitude is not null"), peers).groupBy("entity_id").agg(F.min("distance_km").alias("d")).collect()
    assert {r.entity_id: round(r.d, 6) for r in pairs} == {e: d for e, (d, _) in want.items()}


def star(n, seed, x0=0.0, y0=0.0, r=1.0):
    """A ring of n edges around a centre that doesn't cross itself."""
    rng = random.Random(seed)
    ring = []
    for k in range(n):
        a, s = 2 * math.pi * k / n, rng.uniform(0.5, 1) * r
        ring.append((x0 + s * math.cos(a), y0 + s * math.sin(a)))
    return ring + ring[:1]


def points_of(ring):
    return [{"lon": float(x), "lat": float(y)} for x, y in ring]


def test_banded_polygons_equal_the_plain_test(spark):
    """Rings of 4 to 500 edges with holes and two parts, points on edges and vertices among them."""
    rng = random.Random(2)
    shapes = []
    for k, n in enumerate((4, 9, 30, 120, 500)):
        parts = [[points_of(star(n, k, 10 * k, 0, 4)), points_of(star(5, k + 50, 10 * k, 0, 0.8))], [points_of([(10 * k + 4, 5), (10 * k + 6, 5), (10 * k + 6, 7), (10 * k + 4, 7), (10 * k + 4, 5)])]]
        xs = [p["lon"] for q in parts for r in q for p in r]
        ys = [p["lat"] for q in parts for r in q for p in r]
        shapes.append((f"p{k}", k, min(ys), min(xs), max(ys), max(xs), parts))
    pl = spark.createDataFrame(shapes, "place_id string, admin_level int, min_lat double, min_lon double, max_lat double, max_lon double, polygons array<array<array<struct<lon:double,lat:double>>>>")
    pts = [(rng.uniform(-6, 8), rng.uniform(-6, 50)) for _ in range(150)] + [(p["lat"], p["lon"]) for s in shapes for q in s[6] for r in q for p in r[:4]] + [(6.0, 4.0), (5.0, 5.0), (7.0, 6.0)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pts)], "point_id long, latitude double, longitude double")
    got = {r.point_id: r.place_id for r in places.point_in_place(df, pl, 3.0).collect()}
    plain = df.crossJoin(pl).where(places.in_polygons("latitude", "longitude", "polygons"))
    want = {r.point_id: r.b.place_id for r in plain.groupBy("point_id").agg(F.max(F.struct("admin_level", "place_id")).alias("b")).collect()}
    assert got == want and len(want) > 50
    bands = places.polygon_bands(pl).where("place_id = 'p4'").agg(F.max(F.size("edges")), F.count("*")).first()
    assert bands[0] < 90 and bands[1] > 20  # of 509 edges


def crosses(ring):
    side = lambda a, b, p: (lambda v: (v > 0) - (v < 0))((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]))
    e = list(zip(ring, ring[1:]))
    return any(side(*p, q[0]) * side(*p, q[1]) < 0 and side(*q, p[0]) * side(*q, p[1]) < 0 for i, p in enumerate(e) for q in e[i + 1 :])


def test_self_crossing_equals_all_pairs(spark):
    rng = random.Random(7)
    rings = [[(rng.randrange(6), rng.randrange(6)) for _ in range(rng.randrange(3, 7))] for _ in range(150)] + [[(rng.random(), rng.random() ** 9) for _ in range(5)] for _ in range(100)]
    rings = [r + r[:1] for r in rings] + [star(n, n) for n in (5, 30, 300)] + [star(200, 1)[:-1] + [(9.0, 0.1), star(200, 1)[0]]]
    df = spark.createDataFrame([(i, points_of(r)) for i, r in enumerate(rings)], "id long, ring array<struct<lon:double,lat:double>>")
    area = lambda r: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:]))) / 2
    want = {i for i, r in enumerate(rings) if len(r) >= 4 and area(r) > 1e-12 and not crosses(r)}
    assert {r.id for r in places.valid_polygons(df).collect()} == want and 20 < len(want) < len(rings) - 20


def test_a_ring_of_a_hundred_thousand_edges(spark):
    n = 100_000
    a = F.col("id") * (2 * math.pi / n)
    s = 0.9 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 1e7
    ring = F.transform(F.array_sort(F.collect_list(F.struct("id", (s * F.cos(a)).alias("lon"), (s * F.sin(a)).alias("lat")))), lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    df = spark.range(n).agg(ring.alias("ring")).select(F.lit(1).alias("id"), F.concat("ring", F.slice("ring", 1, 1)).alias("ring"))
    bow = df.select(F.lit(2).alias("id"), F.concat(F.slice("ring", 1, n // 2), F.array(F.struct(F.lit(0.0).alias("lon"), F.lit(-2.0).alias("lat"))), F.slice("ring", n // 2 + 1, n)).alias("ring"))
    t = time.time()
    assert [r.id for r in places.valid_polygons(df.union(bow)).select("id").collect()] == [1]
    assert time.time() - t < 60


@pytest.mark.parametrize("values", [[5], [1, 2], [3, 1, 2], [0.5] * 900 + [0.25] * 99, None, "spread"])
def test_exact_median(spark, values, monkeypatch):
    monkeypatch.setattr(quality, "CELLS", 16)
    rng = random.Random(3)
    values = [rng.gauss(0, 1) * 10 ** rng.randrange(-3, 9) for _ in range(3000)] if values == "spread" else values if values else [-1e300, 1e300, 7.0, 7.0000001, -7.0, 0.0]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    s, n = sorted(values), len(values)
    assert quality.nth(df, "v", [0, n // 3, n - 1]) == [s[0], s[n // 3], s[-1]]
    r = quality.lag_summary(df, "v", 5).first()
    assert (r.median, r.maximum, r.over_threshold) == (math.floor((s[(n - 1) // 2] + s[n // 2]) / 2), s[-1], sum(v > 5 for v in s))
    assert tuple(quality.lag_summary(df.where("false"), "v", 5).first()) == (None, None, 0)
