"""Trajectories: gaps, segments, nearest sites, proximity, overpasses, and the aircraft metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoflume.functions.cols import EARTH_KM, bearing, blank, broadcast_small, c, clamp, elapsed_s, haversine, heading_delta, hours, non_blank, round4
from geoflume.sources import files

GAP_MIN, GROUND_MIN, AIRPORT_KM, LOW_M = 20, 45, 25.0, 1500.0
#: Rows that a task of an as-of match sorts, some 0.2 kB each in memory.
ASOF_ROWS = 500_000
#: Words in an owner's name or type, and call sign prefixes.
MILITARY_OWNER = ("AIR FORCE", "NAVY", "ARMY", "DEFENSE", "DEFENCE", "MILITARY", "AIR NATIONAL GUARD")
MILITARY_TYPE = ("GOVERNMENT", "PUBLIC")
CIVIL_OWNER = ("AIRLINES", "AIRWAYS", "CHARTER", "LEASE", "LOGISTICS", "LLC", "INC", "CORPORATION", "BANK")
CIVIL_TYPE = ("CORPORATION", "INDIVIDUAL", "PARTNERSHIP")


def _track(order: str = "observed_at"):
    return Window.partitionBy("track_id").orderBy(order, "point_id")


def has_any(x, words) -> Column:
    u = F.upper(F.coalesce(c(x), F.lit("")))
    out = F.lit(False)
    for w in words:
        out = out | u.contains(w)
    return out


def nearest_within(points: DataFrame, sites: DataFrame, km: float = AIRPORT_KM) -> DataFrame:
    """Nearest site of each low or grounded point within km: (point_id, site_id, site_place_id, distance_km), ties by id.

    Points meet only the sites of their own and the adjoining grid cells. A row
    of cells is as high as km; its cells are at least as wide as km is at the
    pole's side of the next row, and go round the globe.
    """
    size = km / 111.0
    edge = lambda cy: F.least((F.greatest(F.abs(cy), F.abs(cy + 1)) + 1) * size, F.lit(90.0))
    columns = lambda cy: F.greatest(F.floor(360 * F.cos(F.radians(edge(cy))) / (1.6 * size)), F.lit(1).cast("long"))
    column = lambda lon, cy: F.pmod(F.floor((F.pmod(c(lon), F.lit(360.0))) / 360 * columns(cy)), columns(cy))
    low = F.coalesce(F.col("on_ground"), F.lit(False)) | F.coalesce(F.col("altitude_m") <= LOW_M, F.lit(False))
    p = points.where(low & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select("point_id", "latitude", "longitude", F.floor(F.col("latitude") / size).alias("cy"))
    p = p.withColumn("cx", column("longitude", F.col("cy")))
    s = sites.select(F.col("airport_id").alias("site_id"), F.col("place_id").alias("site_place_id"), F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon"), F.explode(F.array(*[F.floor(F.col("latitude") / size) + k for k in (-1, 0, 1)])).alias("cy"))
    s = s.withColumn("cx", F.explode(F.array_distinct(F.array(*[F.pmod(column("s_lon", F.col("cy")) + k, columns(F.col("cy"))) for k in (-1, 0, 1)]))))
    j = p.join(s, ["cy", "cx"]).withColumn("d", haversine("latitude", "longitude", "s_lat", "s_lon")).where(F.col("d") <= km)
    return j.groupBy("point_id").agg(F.min(F.struct("d", "site_id", "site_place_id")).alias("b")).select("point_id", F.col("b.site_id").alias("site_id"), F.col("b.site_place_id").alias("site_place_id"), F.col("b.d").alias("distance_km"))


def in_flight(alt="altitude_m", ground="on_ground") -> Column:
    return ~F.coalesce(c(ground), F.lit(False)) & (F.coalesce(c(alt), F.lit(0.0)) > 0)


def gap_events(points: DataFrame, sites: DataFrame | None = None, minutes: float = GAP_MIN) -> DataFrame:
    """A row where a point follows its predecessor by more than `minutes`; the place is the site near it, else near the point before."""
    w = _track()
    cols = ["track_id", "entity_id", "point_id", "observed_at"]
    p = points.select(*cols, in_flight().alias("fly"), F.lag("observed_at").over(w).alias("started_at"), F.lag("point_id").over(w).alias("before_id"), F.lag(in_flight()).over(w).alias("fly_before"), F.row_number().over(w).alias("n"))
    g = p.where(elapsed_s("started_at", "observed_at") > minutes * 60)
    out = g.select("track_id", "entity_id", "point_id", "before_id", (F.col("n") - 1).alias("gap_no"), "started_at", F.col("observed_at").alias("ended_at"), round4(elapsed_s("started_at", "observed_at") / 3600).alias("gap_hours"), (F.col("fly") | F.col("fly_before")).alias("in_flight"))
    if sites is None:
        return out
    near = nearest_within(points, sites).select("point_id", "site_place_id")
    out = out.join(near, "point_id", "left").join(near.select(F.col("point_id").alias("before_id"), F.col("site_place_id").alias("__b")), "before_id", "left")
    return out.withColumn("place_id", F.coalesce("site_place_id", "__b", F.lit(""))).drop("site_place_id", "__b")


def segment_tracks(points: DataFrame, gap: float = GAP_MIN, ground_stop: float = GROUND_MIN) -> DataFrame:
    """points with segment_no, and whether a long gap follows the segment."""
    w = _track()
    dt = elapsed_s(F.lag("observed_at").over(w), "observed_at")
    split = (dt > gap * 60) | (F.col("on_ground") & F.lag("on_ground").over(w) & (dt > ground_stop * 60))
    p = points.withColumn("__split", F.coalesce(split, F.lit(False)).cast("int")).withColumn("__long", F.coalesce(dt > gap * 60, F.lit(False)))
    p = p.withColumn("segment_no", F.sum("__split").over(w.rowsBetween(Window.unboundedPreceding, 0)) + 1)
    p = p.withColumn("gap_after", F.coalesce(F.lead("__long").over(w), F.lit(False)))
    return p.drop("__split", "__long")


def segment_geometry(points: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """A row per segment of two points or more: distance, speed, detour, turns, irregularity, airports at both ends."""
    p = segment_tracks(points)
    w = Window.partitionBy("track_id", "segment_no").orderBy("observed_at", "point_id")
    lat1, lon1 = F.lag("latitude").over(w), F.lag("longitude").over(w)
    p = p.withColumn("step_km", haversine(lat1, lon1, "latitude", "longitude")).withColumn("head", F.when(lat1.isNotNull(), bearing(lat1, lon1, "latitude", "longitude")))
    p = p.withColumn("turn", (heading_delta("head", F.lag("head").over(w)) > 45).cast("int"))
    end = lambda f, x: f(F.struct("latitude", "longitude", "point_id"), F.struct("observed_at", "point_id")).alias(x)
    g = p.groupBy("track_id", "entity_id", "segment_no").agg(
        F.count("*").alias("point_count"), F.min("observed_at").alias("started_at"), F.max("observed_at").alias("ended_at"), F.sum("step_km").alias("km"), F.coalesce(F.sum("turn"), F.lit(0)).alias("turn_count"),
        F.max(F.col("gap_after").cast("int")).alias("gap_count"), end(F.min_by, "a"), end(F.max_by, "b"),
    ).where("point_count >= 2")
    direct = haversine("a.latitude", "a.longitude", "b.latitude", "b.longitude")
    h = hours("started_at", "ended_at")
    g = g.withColumn("direct_km", direct).withColumn("detour", F.when(F.col("direct_km") >= 1, F.col("km") / F.col("direct_km")).otherwise(1.0))
    turn_rate = F.when(F.col("point_count") > 2, F.col("turn_count") / (F.col("point_count") - 2)).otherwise(0.0)
    score = clamp(0.7 * clamp((F.col("detour") - 1) / 0.8, 0, 1) + 0.3 * turn_rate + clamp(F.col("gap_count") * 0.15, 0, 0.3), 0, 1)
    out = g.select(
        "track_id", "entity_id", "segment_no", "started_at", "ended_at", "point_count", round4("km").alias("distance_km"), round4(F.when(h > 0, F.col("km") / h).otherwise(0.0)).alias("avg_speed_kph"),
        round4("detour").alias("detour_ratio"), "turn_count", "gap_count", round4(score).alias("route_irregularity"), F.col("a.point_id").alias("first_id"), F.col("b.point_id").alias("last_id"),
    )
    if sites is None:
        return out
    near = nearest_within(points, sites).select("point_id", "site_id", "site_place_id")
    for side, key in (("from", "first_id"), ("to", "last_id")):
        out = out.join(near.select(F.col("point_id").alias(key), F.col("site_id").alias(f"{side}_airport_id"), F.col("site_place_id").alias(f"{side}_place_id")), key, "left")
    return out.fillna("", [f"{s}_{k}" for s in ("from", "to") for k in ("airport_id", "place_id")])


def airport_events(segments: DataFrame) -> DataFrame:
    """A departure and an arrival for the ends that have an airport."""
    ends = F.array(F.struct(F.lit("departure").alias("kind"), F.col("from_airport_id").alias("airport_id"), F.col("from_place_id").alias("place_id"), F.col("started_at").alias("at")), F.struct(F.lit("arrival").alias("kind"), F.col("to_airport_id").alias("airport_id"), F.col("to_place_id").alias("place_id"), F.col("ended_at").alias("at")))
    return segments.select("track_id", "entity_id", "segment_no", F.explode(ends).alias("e")).select("track_id", "entity_id", "segment_no", "e.*").where("airport_id <> ''")


def route_irregularity(segments: DataFrame, gaps: DataFrame) -> DataFrame:
    wt = F.greatest(F.col("point_count") - 1, F.lit(1))
    s = segments.groupBy("entity_id").agg((F.sum(F.col("route_irregularity") * wt) / F.sum(wt)).alias("base"))
    g = gaps.groupBy("entity_id").agg(F.sum("gap_hours").alias("h"), F.count("*").alias("n"))
    j = s.join(g, "entity_id", "left").fillna(0, ["h", "n"])
    return j.select("entity_id", round4(clamp(F.col("base") + clamp(F.col("h") / 2.5 + F.col("n") * 0.1, 0, 0.35), 0, 1)).alias("metric_value"))


def transponder_gap_hours(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("entity_id").agg(round4(F.sum("gap_hours")).alias("metric_value"), F.count("*").alias("gap_events"), F.count_if("in_flight").alias("in_flight_gaps"), round4(F.max("gap_hours")).alias("longest_gap_hours"))


def altitude_variance(points: DataFrame) -> DataFrame:
    return points.groupBy("entity_id").agg(round4(clamp(F.coalesce(F.stddev_pop("altitude_m"), F.lit(0.0)) / 3000, 0, 1)).alias("metric_value"), F.count("altitude_m").alias("altitude_samples"))


def change_rate(points: DataFrame, col: str = "squawk") -> DataFrame:
    """Changes of a code, blanks skipped, per observed hour (one at least)."""
    w = _track()
    v = F.when(~blank(col), F.trim(c(col)))
    p = points.withColumn("__v", v).withColumn("__p", F.last("__v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    h = hours(F.min("observed_at"), F.max("observed_at"))
    g = p.groupBy("entity_id").agg(F.count_if(F.col("__v") != F.col("__p")).alias("changes"), h.alias("h"))
    return g.select("entity_id", "changes", round4(F.when(F.col("h") > 0, F.col("changes") / F.greatest("h", F.lit(1.0))).otherwise(0.0)).alias("metric_value"))


def hold_pattern_frequency(segments: DataFrame) -> DataFrame:
    hold = (F.col("turn_count") >= 2) & (F.col("detour_ratio") >= 1.1) & (F.col("to_airport_id") != "")
    return segments.groupBy("entity_id").agg(round4(F.count_if(hold) / F.count("*")).alias("metric_value"), F.count_if(hold).alias("holding_segments"), F.count("*").alias("total_segments"))


def diversions(segments: DataFrame, gaps: DataFrame) -> DataFrame:
    """Share of segments that end somewhere new after an earlier destination, elsewhere than the one before, or at another airport over a gap."""
    w = Window.partitionBy("entity_id").orderBy("started_at", "track_id", "segment_no")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    to = F.when(F.col("to_airport_id") != "", F.col("to_airport_id"))
    s = segments.withColumn("to", to)
    first = F.row_number().over(Window.partitionBy("entity_id", "to").orderBy("started_at", "track_id", "segment_no")) == 1
    s = s.withColumn("first", first & F.col("to").isNotNull()).withColumn("earlier", F.count("to").over(before)).withColumn("last_to", F.lag("to").over(w))
    div = (F.col("first") & (F.col("earlier") > 0)) | (F.col("to") != F.col("last_to")) | ((F.col("gap_count") > 0) & (F.col("from_airport_id") != "") & F.col("to").isNotNull() & (F.col("from_airport_id") != F.col("to")))
    g = s.groupBy("entity_id").agg(F.count_if(div).alias("n"), F.count("*").alias("total_segments"))
    fly = gaps.groupBy("entity_id").agg(F.count_if("in_flight").alias("in_flight_gaps"))
    j = g.join(fly, "entity_id", "left").fillna(0, ["in_flight_gaps"])
    n = F.when((F.col("n") == 0) & (F.col("in_flight_gaps") > 0) & (F.col("total_segments") > 1), 1).otherwise(F.col("n"))
    return j.select("entity_id", n.cast("long").alias("diverted_segments"), "total_segments", round4(n / F.col("total_segments")).alias("metric_value"))


#: min_distance: points of the second side that a task holds at most, and pairs that it compares at once.
PEERS, PAIRS = 1_000_000, 500_000
#: Bytes of the ids of a part, so that a file's column of peers keeps its dictionary (1 MB in Parquet); but no more than so many parts for PEERS points.
ID_BYTES, FINER = 800_000, 3


def _least_by_pair(within_ms: int, schema):
    """Batches of blocks, b's points before a's and those by entity, to the least distance of each pair of entities that met.

    A task holds the points of b of one block, by time; the pairs of one entity of a at a time wait for its last point.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def emit(entities, which, codes, h):
            d = 2 * EARTH_KM * np.arctan2(np.sqrt(h), np.sqrt(np.maximum(0.0, 1 - h)))
            d[h == 2.0] = np.nan
            d = pa.array(d, mask=np.isinf(h))
            return pa.RecordBatch.from_arrays([entities.take(pa.array(which)), peers.take(pa.array(codes)), d], schema=schema)

        def least(which, codes, h):
            """The least h of equal (which, codes), in their order."""
            key = which.astype(np.int64) * len(peers) + codes
            order = np.argsort(key, kind="stable")
            key, h = key[order], h[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            return key[first] // len(peers), key[first] % len(peers), np.minimum.reduceat(h, first)

        def column(x, name):
            return x.column(name).to_numpy(zero_copy_only=False).astype(float)

        block, gathered, peers, wait = None, [], None, None  # wait: (entity, codes, h) of an entity whose points may go on
        for batch in batches:
            b, side = batch.column("block").to_numpy(), batch.column("side").to_numpy()
            cut = [0, *(np.flatnonzero((b[1:] != b[:-1]) | (side[1:] != side[:-1])) + 1).tolist(), len(b)]
            for lo, hi in zip(cut, cut[1:]):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if b[lo] != block:
                    if wait:
                        yield emit(wait[0], np.zeros(len(wait[1]), int), *wait[1:])
                    block, gathered, peers, wait = b[lo], [], None, None
                if side[lo] == 0:
                    gathered.append(part)
                    continue
                if not gathered and peers is None:
                    continue
                if peers is None:
                    held = pa.Table.from_batches(gathered).combine_chunks().sort_by("t")
                    ids = held.column("id").combine_chunks().dictionary_encode()
                    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
                    peers, code, t2 = ids.dictionary, ids.indices.to_numpy().astype(np.int64), held.column("t").to_numpy()
                    gone2, lat2, lon2 = (held.column("lat").is_null().to_numpy() | held.column("lon").is_null().to_numpy()), np.radians(column(held, "lat")), np.radians(column(held, "lon"))
                    cos2, gathered = np.cos(lat2), []
                t = part.column("t").to_numpy()
                start, end = np.searchsorted(t2, t - within_ms, "left"), np.searchsorted(t2, t + within_ms, "right")
                ids = part.column("id").dictionary_encode()
                which, names = ids.indices.to_numpy().astype(np.int64), ids.dictionary
                own = pc.fill_null(pc.index_in(names, value_set=peers), -1).to_numpy()[which]
                gone, lat, lon = part.column("lat").is_null().to_numpy(zero_copy_only=False) | part.column("lon").is_null().to_numpy(zero_copy_only=False), np.radians(column(part, "lat")), np.radians(column(part, "lon"))
                n, at = end - start, 0
                total = np.cumsum(n)
                while at < len(t):
                    to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
                    k = n[at:to]
                    i = np.repeat(np.arange(at, to), k)
                    j = np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k) + np.repeat(start[at:to], k)
                    other = code[j] != own[i]
                    i, j = i[other], j[other]
                    h = np.sin((lat2[j] - lat[i]) / 2) ** 2 + np.cos(lat[i]) * cos2[j] * np.sin((lon2[j] - lon[i]) / 2) ** 2
                    h[np.isnan(h)] = 2.0  # after all numbers, as Spark orders NaN
                    h[gone[i] | gone2[j]] = np.inf
                    w, c = which[i], code[j]
                    if wait and wait[0][0].as_py() != names[int(which[at])].as_py():
                        yield emit(wait[0], np.zeros(len(wait[1]), int), *wait[1:])
                    elif wait:
                        w, c, h = np.r_[np.full(len(wait[1]), which[at]), w], np.r_[wait[1], c], np.r_[wait[2], h]
                    wait, last = None, int(which[to - 1])
                    if len(w):
                        w, c, h = least(w, c, h)
                        mine = w == last
                        if mine.any():
                            wait = (names.slice(last, 1), c[mine], h[mine])
                        if not mine.all():
                            yield emit(names, w[~mine], c[~mine], h[~mine])
                    at = to
        if wait:
            yield emit(wait[0], np.zeros(len(wait[1]), int), *wait[1:])

    return run


def min_distance(a: DataFrame, b: DataFrame, within: int = 300) -> DataFrame:
    """Least distance between points of entities of a and of b (others) at most `within` seconds apart, of all pairs that met.

    The result may be as large as the square of the input, so pairs of points
    are never shuffled: entities of a are dealt over shares and those of b over
    parts of about PEERS points, fewer where their ids are many, and all points of a share meet those of a part
    in one task of their own, which finds them by time. Counts both sides at once. For the
    nearest peer alone, see nearest_peer.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import DoubleType, StructField, StructType

    point = lambda df, side: df.where("entity_id is not null and observed_at is not null").select(F.lit(side).alias("side"), F.col("entity_id").alias("id"), F.unix_millis("observed_at").alias("t"), F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    x, y = point(a, 1), point(b, 0)
    n = x.count()
    m, ids = y.agg(F.count("*"), F.approx_count_distinct("id") * (4 + F.avg(F.length(F.col("id").cast("string"))))).first()
    parts = max(1, -(-m // PEERS))
    parts = max(parts, min(FINER * parts, int((ids or 0) // ID_BYTES) + 1))
    shares = max(-(-4 * a.sparkSession.sparkContext.defaultParallelism // parts), -(-parts * n // max(m, 1)))
    dealt = lambda k: F.pmod(F.xxhash64("id"), F.lit(k))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    x = x.withColumn("share", dealt(shares)).withColumn("part", every(parts))
    y = y.withColumn("part", dealt(parts)).withColumn("share", every(shares))
    both = y.unionByName(x).withColumn("block", (F.col("share") * parts + F.col("part")).cast("int")).drop("share", "part")
    kind = both.schema["id"].dataType
    out = StructType([StructField("entity_id", kind), StructField("peer_id", kind), StructField("distance_km", DoubleType())])
    rows = both.repartitionById(shares * parts, "block").sortWithinPartitions("block", "side", "id")
    return rows.mapInArrow(_least_by_pair(within * 1000, to_arrow_schema(out)), out)


#: Distances, in km, of the rounds of nearest_peer; the last reaches round the globe.
RINGS = (12.5, 50.0, 200.0, 800.0, 3200.0, 12800.0)
#: A cell's side, in distances of its round and in times of `within`: a point has about (1 + 2 / CELL) ** 3 copies.
CELL = 4


def _meet(left: DataFrame, right: DataFrame, km: float | None, within: int) -> DataFrame:
    """Pairs of points at most km (None: any distance) and `within` seconds apart. The copied side is never broadcast: Spark doesn't count copies when it guesses its size."""
    wide, long = (km or 0) * CELL, within * CELL * 1000
    near = lambda v, by, size: F.explode(F.sequence(F.floor((F.col(v) - by) / size), F.floor((F.col(v) + by) / size)))
    x = left.withColumn("slot", F.floor(F.col("t") / long))
    y = right.select(F.col("entity_id").alias("peer_id"), F.col("t").alias("t2"), F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2"), *[F.col(v).alias(f"{v}2") for v in "xyz"]).withColumn("slot", near("t2", within * 1000, long))
    keys = ["slot"]
    if km is not None:
        for v in "xyz":
            x, y = x.withColumn(f"c{v}", F.floor(F.col(v) / wide)), y.withColumn(f"c{v}", near(f"{v}2", km, wide))
            keys.append(f"c{v}")
    j = x.join(y.hint("merge"), keys).where((F.col("entity_id") != F.col("peer_id")) & (F.abs(F.col("t") - F.col("t2")) <= within * 1000))
    if km is not None:  # a chord is no longer than its arc
        j = j.where(sum((F.col(v) - F.col(f"{v}2")) * (F.col(v) - F.col(f"{v}2")) for v in "xyz") <= km * km * (1 + 1e-6) + 1e-6)
    return j


def nearest_peer(a: DataFrame, b: DataFrame, within: int = 300, rings: tuple = RINGS) -> DataFrame:
    """(entity_id, peer_id, distance_km): of each entity of a the nearest of b's others, at most `within` seconds apart; ties by id.

    Points lie in cells of space (not of the map, so poles and the date line are
    nothing special) and time. A round finds all pairs at most its distance
    apart, so an entity that has one is settled; the rest go on to the next, with
    wider cells, until none is left. Cells are wider than the distance, so a point of b has
    few copies. Busy cells of wide rounds are split by the adaptive skew join.
    """

    def placed(df: DataFrame) -> DataFrame:
        la, lo = F.radians("latitude"), F.radians("longitude")
        df = df.where("latitude is not null and longitude is not null and observed_at is not null")
        return df.select("entity_id", F.unix_millis("observed_at").alias("t"), "latitude", "longitude", (F.cos(la) * F.cos(lo) * EARTH_KM).alias("x"), (F.cos(la) * F.sin(lo) * EARTH_KM).alias("y"), (F.sin(la) * EARTH_KM).alias("z"))

    left, right = placed(a), placed(b)
    done = None
    for n, km in enumerate(rings):
        last = n == len(rings) - 1
        j = _meet(left, right, None if last else km, within).withColumn("d", haversine("latitude", "longitude", "lat2", "lon2"))
        best = j.where(F.lit(last) | (F.col("d") <= km)).groupBy("entity_id").agg(F.min(F.struct("d", "peer_id")).alias("b"))
        found = files.staged(best.select("entity_id", "b.peer_id", F.col("b.d").alias("distance_km")), "nearest-peer")
        done = found if done is None else done.unionByName(found)
        if not last:
            left = files.staged(left.join(found.select("entity_id"), "entity_id", "left_anti"), "nearest-peer-left")
            if left.isEmpty():
                break
    return done


def military_prefix(callsign) -> Column:
    """Call sign prefixes of military flights."""
    u = F.upper(F.trim(F.coalesce(c(callsign), F.lit(""))))
    out = F.lit(False)
    for p in ("RCH", "CNV", "NAVY", "ARMY", "USAF", "RAF", "DUKE", "REACH", "HOOK"):
        out = out | u.startswith(p)
    return out


def last_non_blank(df: DataFrame, by: list[str], ts: str, cols: list[str]) -> DataFrame:
    """The latest non-blank value of each column; blank where there is none."""
    return df.groupBy(*by).agg(*[F.coalesce(F.max_by(F.when(~blank(x), c(x)), F.when(~blank(x), F.struct(ts, x))), F.lit("")).alias(x) for x in cols])


def military_likelihood(points: DataFrame, registry: DataFrame, segments: DataFrame, sites: DataFrame) -> DataFrame:
    """Evidence from owner, call sign, airports and category; civil owners count against. registry: entity_id, registrant_name, registrant_type."""
    sign = last_non_blank(points, ["entity_id"], "observed_at", ["callsign"])
    cat = points.groupBy("entity_id").agg(F.max(F.col("category").isin(7, 8)).alias("fast"))
    use = sites.where(F.col("use").isin("military", "joint_use")).select("airport_id")
    visits = airport_events(segments).join(use, "airport_id", "left_semi").groupBy("entity_id").agg(F.count("*").alias("visits"))
    j = sign.join(cat, "entity_id").join(registry, "entity_id", "left").join(visits, "entity_id", "left").fillna(0, ["visits"])
    strong = has_any("registrant_name", MILITARY_OWNER) | has_any("registrant_type", MILITARY_TYPE)
    civil = has_any("registrant_name", CIVIL_OWNER) | has_any("registrant_type", CIVIL_TYPE)
    raw = F.when(strong, 0.65).otherwise(0.0) + F.when(military_prefix("callsign"), 0.2).otherwise(0.0) + F.least(F.col("visits") * 0.1, F.lit(0.2)) + F.when(F.col("fast"), 0.05).otherwise(0.0)
    cut = raw - 0.25
    score = clamp(F.when(civil, F.when(~strong, F.least(cut, F.lit(0.45))).otherwise(cut)).otherwise(raw), 0, 1)
    out = j.withColumn("metric_value", round4(score)).withColumn("strong", strong)
    status = F.when(F.col("strong") & (F.col("metric_value") >= 0.85), "likely_military").when(F.col("strong") & (F.col("metric_value") >= 0.55), "possible_military").otherwise("unknown")
    return out.select("entity_id", "callsign", "visits", "metric_value", status.alias("status"))


def proximity(points: DataFrame, flagged: DataFrame) -> DataFrame:
    """Closeness to the nearest flagged entity: 1 at zero distance, 0 from 50 km on and for entities that met none."""
    peers = points.join(flagged.select("entity_id").distinct(), "entity_id", "left_semi")
    g = nearest_peer(points, peers).select("entity_id", F.struct("distance_km", "peer_id").alias("b"))
    j = points.select("entity_id").distinct().join(g, "entity_id", "left")
    score = F.coalesce(round4(clamp(1 - F.col("b.distance_km") / 50, 0, 1)), F.lit(0.0))
    return j.select("entity_id", F.coalesce("b.peer_id", F.lit("")).alias("closest_peer_id"), F.coalesce(round4("b.distance_km"), F.lit(0.0)).alias("minimum_distance_km"), score.alias("metric_value"))


def aircraft_entities(likelihood: DataFrame, metrics: DataFrame) -> DataFrame:
    """Risk band from the likelihood, and each metric's rank. metrics: entity_id, metric_id, metric_value."""
    w = Window.partitionBy("metric_id").orderBy(F.desc("metric_value"), "entity_id")
    risk = F.when(F.col("l") >= 0.8, "high").when(F.col("l") >= 0.45, "medium").otherwise("low")
    return metrics.join(likelihood.select("entity_id", F.col("metric_value").alias("l"), "status"), "entity_id").select("entity_id", "metric_id", "metric_value", F.row_number().over(w).alias("rank"), risk.alias("risk_band"), "status")


def join_registry(df: DataFrame, reg: DataFrame, key: str = "hex", order: str = "row_no") -> DataFrame:
    """df with its registry row by cleaned hex key; the last row of a key wins. Headers are cleaned too."""
    from geoflume.operators.versions import latest_by

    clean = reg.toDF(*[x.strip().lower().replace(" ", "_") for x in reg.columns]).withColumn(key, F.lower(F.trim(F.col(key)))).where(~blank(key))
    last = latest_by(clean, [key], [x for x in clean.columns if x not in (key, order)], order)
    return df.withColumn("__k", F.lower(F.trim(F.col(key)))).drop(key).join(last, F.col("__k") == F.col(key), "left").drop(key).withColumnRenamed("__k", key)


def asof_match(left: DataFrame, right: DataFrame, by: str, left_ts: str, right_ts: str, cond: Column | None = None, keep: list[str] = (), left_id: str = "call_id", rows: int | None = None) -> DataFrame:
    """Each row of left with the latest row of right of the same key that ends before it (and meets cond), else none.

    The key's rows are merged in time order by one window, so a key with many
    rows on both sides makes no pairs. Given about how many rows both sides have, they are
    dealt over so many tasks that each sorts about ASOF_ROWS. A cond on both sides falls back to a join.
    """
    if cond is None:
        r = right.where(F.col(by).isNotNull() & F.col(right_ts).isNotNull()).select(F.col(by), F.col(right_ts).alias("__t"), F.lit(0).alias("__side"), F.struct(*keep).alias("__r"))
        # the key and the time are carried once, unless the union widens their type
        kind = lambda df, x: df.schema[x].dataType
        once = {x: y for x, k, y in ((by, by, by), (left_ts, right_ts, "__t")) if kind(left, x) == kind(right, k)}
        rest = {x: f"__l{i}" for i, x in enumerate(left.columns) if x not in once}
        low = left.select(F.col(by), F.col(left_ts).alias("__t"), F.lit(1).alias("__side"), *[F.col(x).alias(y) for x, y in rest.items()])
        both = r.unionByName(low, allowMissingColumns=True)
        both = both.repartition(max(1, -(-rows // ASOF_ROWS)), by) if rows is not None else both
        w = Window.partitionBy(by).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, -1)
        return both.withColumn("__m", F.last(F.col("__r"), ignorenulls=True).over(w)).where("__side = 1").select(*[F.col((once | rest)[x]).alias(x) for x in left.columns], "__m.*")
    j = left.join(right.withColumnRenamed(by, "__by"), (F.col(by) == F.col("__by")) & (F.col(right_ts) <= F.col(left_ts)) & cond, "left").drop("__by")
    best = j.groupBy(*left.columns).agg(F.max_by(F.struct(*keep), F.struct(right_ts, *keep)).alias("__m"))
    return best.select(*left.columns, "__m.*")


def islands(points: DataFrame, by: list[str], flag: str, order: str, step_s: float = 60) -> DataFrame:
    """Runs of consecutive rows whose flag is set: start, end, samples, duration with one step added."""
    w = Window.partitionBy(*by).orderBy(order, "point_id")
    p = points.withColumn("__a", F.row_number().over(w)).where(F.col(flag)).withColumn("__g", F.col("__a") - F.row_number().over(w))
    g = p.groupBy(*by, "__g").agg(F.min(order).alias("starts_at"), F.max(order).alias("ends_at"), F.count("*").alias("samples"))
    return g.withColumn("duration_s", elapsed_s("starts_at", "ends_at") + step_s).drop("__g")


def coverage_gaps(windows: DataFrame, by: list[str], start, end) -> DataFrame:
    """Largest and mean hours of the gaps of [start, end]: before, between (by the running greatest end) and after the windows.

    The mean is over all gaps, also those of no length; a key without a window in [start, end] is one gap.
    """
    s, e = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    w = Window.partitionBy(*by).orderBy("starts_at", "ends_at")
    x = windows.withColumn("starts_at", F.greatest("starts_at", s)).withColumn("ends_at", F.least("ends_at", e)).where("starts_at <= ends_at")
    x = x.withColumn("__p", F.coalesce(F.max("ends_at").over(w.rowsBetween(Window.unboundedPreceding, -1)), s)).withColumn("__last", F.lead("starts_at").over(w).isNull()).withColumn("__max", F.max("ends_at").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    g = x.select(*by, F.explode(F.array(hours("__p", "starts_at"), F.when(F.col("__last"), hours("__max", e)))).alias("h")).where("h is not null").withColumn("h", F.greatest("h", F.lit(0.0)))
    g = g.groupBy(*by).agg(F.max("h").alias("most"), F.avg("h").alias("mean"), F.count("*").alias("n"))
    whole = round4(hours(s, e))
    j = windows.select(*by).distinct().join(g, by, "left")
    return j.select(*by, F.coalesce(round4("most"), whole).alias("largest_gap_hours"), F.coalesce(round4("mean"), whole).alias("mean_gap_hours"), F.coalesce("n", F.lit(1).cast("long")).alias("gaps"))


#: place_intersections: pairs of points and circles' cells that a share of a cell has, and points of one position that a block holds; both about, at most.
CELL_PAIRS, BLOCK = 100_000_000, 50_000


def place_intersections(points: DataFrame, circles: DataFrame) -> DataFrame:
    """(point_id, place_id, distance_km) of points within radius_km of a place's centre.

    A circle lies on the one of seven grids, which go round the globe, whose cells are about half its radius or less
    wide (0.7 degrees at least), so few points meet it in vain. Both sides are shuffled: Spark doesn't count a circle's cells when it
    guesses what is small enough to broadcast. Pairs are held against the chord first.

    The result may be as large as the product of both sides. Points of one position are a block, which meets a circle once and is opened
    last: a block's rows for a circle stand together, with one distance and the same points as for the circle
    before, so files of the result are a fraction of their rows. Cells are cut into shares by their pairs, counted at once.
    """
    radius = 6378.137
    keys = ["cy", "cx"]  # cx tells the level too
    deg = F.col("radius_km") / 111.0
    unit = lambda la, lo: [F.cos(F.radians(la)) * F.cos(F.radians(lo)), F.cos(F.radians(la)) * F.sin(F.radians(lo)), F.sin(F.radians(la))]
    cell = F.concat_ws(":", *keys).alias("cell")
    level = F.greatest(F.lit(0.0), F.least(F.lit(6.0), F.floor(F.log2(135 / F.greatest(deg, F.lit(0.01)))))).cast("int")
    size, around = 45 / F.pow(F.lit(2.0), F.col("level")), (8 * F.pow(F.lit(2.0), F.col("level"))).cast("long")
    top = F.abs(F.col("latitude")) + deg
    wide = F.when(top >= 89, 180.0).otherwise(F.least(deg / F.cos(F.radians(top)), F.lit(180.0)))
    pl = circles.where("radius_km >= 0").select("place_id", "radius_km", F.col("latitude").alias("p_lat"), F.col("longitude").alias("p_lon"), level.alias("level"), deg.alias("deg"), wide.alias("w"))
    levels = pl.select("level").distinct()
    pl = pl.withColumn("cy", F.explode(F.sequence(F.floor((F.col("p_lat") - F.col("deg")) / size), F.floor((F.col("p_lat") + F.col("deg")) / size))))
    span = F.sequence(F.floor((F.col("p_lon") - F.col("w")) / size), F.floor((F.col("p_lon") + F.col("w")) / size))
    column = lambda k: F.pmod(k, around) + 1024 * F.col("level")
    pl = pl.withColumn("cx", F.explode(F.array_distinct(F.transform(span, column)))).drop("w", "deg", "level")
    p = points.where("latitude is not null and longitude is not null").select("point_id", "latitude", "longitude").join(F.broadcast(levels))  # seven rows at most
    p = p.withColumn("cy", F.floor(F.col("latitude") / size)).withColumn("cx", column(F.floor(F.col("longitude") / size))).drop("level")
    counted = lambda df, n: df.groupBy(*keys).agg(F.count("*").cast("double").alias(n)).select(cell, n)
    pairs = F.col("n") * F.col("m")
    load = files.staged(counted(p, "n").join(counted(pl, "m"), "cell").select("cell", pairs.alias("pairs"), F.ceil(F.greatest(pairs / CELL_PAIRS, F.col("n") / BLOCK)).cast("long").alias("shares")), "cells")
    tasks = max(2 * points.sparkSession.sparkContext.defaultParallelism, int((load.agg(F.sum("pairs")).first()[0] or 0) // CELL_PAIRS))
    load = broadcast_small(load.drop("pairs"))
    dealt = lambda df, share: df.withColumn("cell", cell).join(load, "cell").withColumn("share", share).drop("cell", "shares").repartition(tasks, *keys, "share")
    blocks = dealt(p, F.pmod(F.xxhash64("point_id"), F.col("shares"))).groupBy(*keys, "share", "latitude", "longitude").agg(F.collect_list(F.struct("point_id")).alias("ids"))  # structs, as a list leaves null out
    pl = dealt(pl, F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    half = F.least(F.col("radius_km") / (2 * radius), F.lit(1.5707963267948966))
    named = lambda df, la, lo, by: df.select("*", *[x.alias(f"{by}{v}") for v, x in zip("xyz", unit(la, lo))])
    pl = named(pl, "p_lat", "p_lon", "p").withColumn("chord", 4 * F.sin(half) * F.sin(half) * (1 + 1e-6) + 1e-12)
    j = named(blocks, "latitude", "longitude", "u").join(pl.hint("merge"), [*keys, "share"]).where(sum((F.col(f"u{v}") - F.col(f"p{v}")) * (F.col(f"u{v}") - F.col(f"p{v}")) for v in "xyz") <= F.col("chord"))
    d = haversine("latitude", "longitude", "p_lat", "p_lon", radius)
    met = j.withColumn("distance_km", d).where("distance_km <= radius_km").select("ids", "place_id", round4("distance_km").alias("distance_km"))
    return met.select(F.inline("ids"), "place_id", "distance_km")


def first_known(*xs) -> Column:
    return F.coalesce(non_blank(*xs), F.lit(""))
