"""Places: hierarchy, location of points and names, and the attribution cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoflume.functions.cols import blank, c, grid_cell

#: Levels after which a place tree is taken for a cycle, which is an error.
MAX_LEVELS = 100


def closure(places: DataFrame, max_levels: int = MAX_LEVELS) -> DataFrame:
    """(ancestor_id, descendant_id, depth, direct) of every place and itself, up to the root, whatever the depth; a cycle is an error."""
    spark = places.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")  # the rows are bounded by places times depth
    edge = places.select("place_id", F.col("parent_place_id").alias("parent")).where(~blank("place_id"))
    return spark.sql(
        f"""with recursive up(ancestor_id, descendant_id, depth) max recursion level {max_levels} as (
            select place_id, place_id, 0 from {{edge}} union all
            select e.parent, up.descendant_id, up.depth + 1 from up join {{edge}} e on e.place_id = up.ancestor_id
            where trim(coalesce(e.parent, '')) <> '')
        select ancestor_id, descendant_id, depth, depth = 1 as direct from up""",
        edge=edge,
    )


def lineage(places: DataFrame) -> DataFrame:
    """Path from the root, ancestor at each admin level, continent, and whether a parent is missing."""
    up = closure(places).join(places.select(F.col("place_id").alias("ancestor_id"), F.col("admin_level").alias("level"), F.col("place_type").alias("kind"), F.col("parent_place_id").alias("up")), "ancestor_id")
    at = lambda k: F.max(F.when((F.col("level") == k) & (F.col("kind") != "continent"), F.col("ancestor_id")))
    g = up.groupBy(F.col("descendant_id").alias("place_id")).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("d"), "ancestor_id"))).alias("path"),
        *[F.coalesce(at(k), F.lit("")).alias(f"admin{k}_place_id") for k in range(5)],
        F.coalesce(F.max(F.when(F.col("kind") == "continent", F.col("ancestor_id"))), F.lit("")).alias("continent_place_id"),
        F.max("level").alias("deepest_level"),
        F.min_by("up", -F.col("depth")).alias("root_parent"),
    )
    return g.withColumn("path", F.array_join(F.transform("path", lambda x: x["ancestor_id"]), ">")).withColumn("parent_missing", ~blank("root_parent")).drop("root_parent")


def bounds_and_depth(places: DataFrame) -> DataFrame:
    """Box over all descendants and the deepest level among them."""
    j = closure(places).join(places.withColumnRenamed("place_id", "descendant_id"), "descendant_id")
    return j.groupBy(F.col("ancestor_id").alias("place_id")).agg(F.min("min_lat").alias("min_lat"), F.min("min_lon").alias("min_lon"), F.max("max_lat").alias("max_lat"), F.max("max_lon").alias("max_lon"), F.max("admin_level").alias("deepest_level"), F.count("*").alias("n_places"))


def _edges(ring) -> Column:
    r = c(ring)
    return F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda a, b: F.struct(a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")))


def in_ring(lat, lon, ring) -> Column:
    """Even-odd test with edges inside."""
    x, y = c(lon), c(lat)
    cross = lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    on = lambda e: (F.abs(cross(e)) <= 1e-9) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    hit = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
    return F.exists(_edges(ring), on) | (F.size(F.filter(_edges(ring), hit)) % 2 == 1)


def in_polygons(lat, lon, polygons) -> Column:
    """Inside the first ring of a polygon and none of its holes."""
    def inside(p):
        return in_ring(lat, lon, p[0]) & ~F.exists(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda h: in_ring(lat, lon, h))

    return F.exists(c(polygons), inside)


def ring_area(ring) -> Column:
    return F.aggregate(_edges(ring), F.lit(0.0), lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def centroid(ring) -> Column:
    """Area centroid (lat, lon) of a closed ring; the first vertex of a degenerate one."""
    r, a = c(ring), ring_area(ring)
    k = lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]
    x = F.aggregate(_edges(r), F.lit(0.0), lambda s, e: s + (e["x1"] + e["x2"]) * k(e)) / (6 * a)
    y = F.aggregate(_edges(r), F.lit(0.0), lambda s, e: s + (e["y1"] + e["y2"]) * k(e)) / (6 * a)
    first = F.struct(r[0]["lat"].alias("lat"), r[0]["lon"].alias("lon"))
    return F.when(F.size(r) == 0, F.lit(None)).when(F.abs(a) < 1e-12, first).otherwise(F.struct(y.alias("lat"), x.alias("lon")))


def _crossing(edges: DataFrame) -> DataFrame:
    """Rings (k) of which two edges cross properly. edges: k, i, x1, y1, x2, y2, n (edges of the ring), length (of all), and the ring's box.

    A ring lies on a grid whose cells are as wide as its mean edge is long, so
    its edges fill a few cells each; they go into the cells that they meet, row
    by row, and meet only within a cell.
    """
    extent = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))
    side = F.least(F.greatest(F.ceil(extent * F.col("n") / F.col("length")), F.lit(1).cast("long")), F.col("n").cast("long"))
    high, wide = (F.greatest((F.col(f"max_{v}") - F.col(f"min_{v}")) / side, F.lit(1e-300)) for v in "yx")
    cell = lambda v, v0, step: F.least(F.greatest(F.floor((v - v0) / step), F.lit(0).cast("long")), side - 1)
    e = edges.withColumns({"high": high, "wide": wide, "side": side})
    row = lambda y: cell(y, F.col("min_y"), F.col("high"))
    e = e.withColumn("cy", F.explode(F.sequence(row(F.least("y1", "y2")), row(F.greatest("y1", "y2")))))
    # the part of the edge within the row, a little more than it, so that rounding loses no cell
    slack = F.col("high") * 1e-6
    clip = lambda y: F.least(F.greatest(y, F.least("y1", "y2")), F.greatest("y1", "y2"))
    at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / (F.col("y2") - F.col("y1")))
    low_y, high_y = clip(F.col("min_y") + F.col("cy") * F.col("high") - slack), clip(F.col("min_y") + (F.col("cy") + 1) * F.col("high") + slack)
    flat = F.col("y1") == F.col("y2")
    a, b = F.when(flat, F.col("x1")).otherwise(at(low_y)), F.when(flat, F.col("x2")).otherwise(at(high_y))
    col = lambda x, d: cell(x + d * F.col("wide") * 1e-6, F.col("min_x"), F.col("wide"))
    e = e.withColumn("cx", F.explode(F.sequence(col(F.least(a, b), -1), col(F.greatest(a, b), 1)))).select("k", "i", "x1", "y1", "x2", "y2", "cy", "cx")
    turn = lambda p, q, x, y: F.signum((F.col(f"{p}.x2") - F.col(f"{p}.x1")) * (F.col(f"{q}.{y}") - F.col(f"{p}.y1")) - (F.col(f"{p}.y2") - F.col(f"{p}.y1")) * (F.col(f"{q}.{x}") - F.col(f"{p}.x1")))
    apart = lambda p, q: turn(p, q, "x1", "y1") * turn(p, q, "x2", "y2") < 0
    j = e.alias("p").join(e.alias("q"), ["k", "cy", "cx"]).where(F.col("p.i") < F.col("q.i"))
    return j.where(apart("p", "q") & apart("q", "p")).select("k").distinct()


def valid_polygons(polys: DataFrame, ring: str = "ring") -> DataFrame:
    """Rows whose ring is closed, has four points and an area, and doesn't cross itself."""
    r = c(ring)
    ok = (F.size(r) >= 4) & (r[0]["lat"] == F.element_at(r, -1)["lat"]) & (r[0]["lon"] == F.element_at(r, -1)["lon"]) & (F.abs(ring_area(ring)) > 1e-12)
    simple = polys.where(F.coalesce(ok, F.lit(False))).withColumn("__k", F.sha2(F.to_json(r), 256))
    rings = simple.select("__k", r.alias("ring")).dropDuplicates(["__k"])
    span = lambda f, v: f(F.transform("ring", lambda p: p[v]))
    # measured before the edges become rows, or each row would measure the ring again
    boxed = rings.select(F.col("__k").alias("k"), F.size("ring").alias("n"), F.aggregate(_edges("ring"), F.lit(0.0), lambda t, e: t + F.abs(e["x2"] - e["x1"]) + F.abs(e["y2"] - e["y1"])).alias("length"), span(F.array_min, "lon").alias("min_x"), span(F.array_max, "lon").alias("max_x"), span(F.array_min, "lat").alias("min_y"), span(F.array_max, "lat").alias("max_y"), _edges("ring").alias("edges"))
    boxed = boxed.select("k", "n", "length", "min_x", "max_x", "min_y", "max_y", F.posexplode("edges").alias("i", "e"))
    bad = _crossing(boxed.select("k", "n", "length", "min_x", "max_x", "min_y", "max_y", "i", "e.*"))
    return simple.join(bad, simple["__k"] == bad["k"], "left_anti").drop("__k")


def grid_cells(places: DataFrame, size: float) -> DataFrame:
    """(place_id, cell) of every grid cell that a place's box meets: the bucket key of the point join."""
    lat = F.sequence(F.floor(F.col("min_lat") / size), F.floor(F.col("max_lat") / size))
    lon = F.sequence(F.floor(F.col("min_lon") / size), F.floor(F.col("max_lon") / size))
    p = places.select("*", F.explode(lat).alias("__y"))
    return p.select("*", F.explode(lon).alias("__x")).withColumn("cell", F.concat_ws(":", "__y", "__x")).drop("__x", "__y")


#: Edges of a band of a polygon, about.
BAND_EDGES = 16


def polygon_bands(places: DataFrame) -> DataFrame:
    """(place_id, band, edges) of places with `polygons`: each cut once into bands of latitude that have their own edges.

    There are as many bands as the polygons have edges, by BAND_EDGES, so what a
    point is tested against doesn't grow with them. edges: (polygon, ring, x1, y1, x2, y2).
    """
    p = places.select("place_id", "min_lat", "max_lat", F.posexplode("polygons").alias("polygon", "rings")).select("*", F.posexplode("rings").alias("ring", "r"))
    n = p.groupBy("place_id").agg(F.greatest(F.floor(F.sum(F.size("r")) / BAND_EDGES), F.lit(1).cast("long")).alias("bands"))
    e = p.select("place_id", "min_lat", "max_lat", "polygon", "ring", F.explode(_edges("r")).alias("e")).join(n, "place_id")
    at = lambda y: _band(y)
    e = e.withColumn("band", F.explode(F.sequence(at(F.least("e.y1", "e.y2") - 1e-9), at(F.greatest("e.y1", "e.y2") + 1e-9))))
    return e.groupBy("place_id", "band").agg(F.max("bands").alias("bands"), F.collect_list(F.struct("polygon", "ring", "e.x1", "e.y1", "e.x2", "e.y2")).alias("edges"))


def _band(y) -> Column:
    """The band of a latitude, by the place's box and number of bands."""
    high = F.greatest((F.col("max_lat") - F.col("min_lat")) / F.col("bands"), F.lit(1e-300))
    return F.least(F.greatest(F.floor((y - F.col("min_lat")) / high), F.lit(0).cast("long")), F.col("bands") - 1)


def _in_bands(lat, lon, edges) -> Column:
    """in_polygons() by the edges of the point's band alone: no other edge is level with the point."""
    x, y = c(lon), c(lat)
    cross = lambda e: (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
    on = lambda e: (F.abs(cross(e)) <= 1e-9) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    hit = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])

    def in_ring_(p, r):
        own = F.filter(c(edges), lambda e: (e["polygon"] == p) & (e["ring"] == r))
        return F.exists(own, on) | (F.size(F.filter(own, hit)) % 2 == 1)

    rings = F.array_distinct(F.transform(c(edges), lambda e: F.struct(e["polygon"].alias("polygon"), e["ring"].alias("ring"))))
    held = F.filter(rings, lambda r: in_ring_(r["polygon"], r["ring"]))
    return F.exists(held, lambda r: (r["ring"] == 0) & ~F.exists(held, lambda h: (h["polygon"] == r["polygon"]) & (h["ring"] > 0)))


#: Cells of a side of the grid, from the finest to the one that a place as wide as the world fills with few.
LEVELS = 8


def point_in_place(points: DataFrame, places: DataFrame, cell: float = 10.0) -> DataFrame:
    """The deepest place that holds each point (then smallest, then least id), by cell; the answers meet per point id.

    points: point_id, latitude, longitude. A place is on the one of LEVELS grids,
    each twice as coarse as the one before, on which it fills four cells at most;
    points go to the levels that have places. A cell's rows are dealt over shares
    of the points, as many as a coarse grid needs, with a copy of its places in
    each. With a column `polygons` the box is only a first test, and the polygon
    is asked by the edges of the point's band (polygon_bands).
    """
    area = (F.col("max_lat") - F.col("min_lat")) * (F.col("max_lon") - F.col("min_lon"))
    pl = places.select("place_id", "admin_level", "min_lat", "min_lon", "max_lat", "max_lon", area.alias("area"))
    side = F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lon") - F.col("min_lon"))
    level = F.least(F.greatest(F.ceil(F.log2(F.greatest(side / cell, F.lit(1e-9)))), F.lit(0)), F.lit(LEVELS)).cast("int")
    size = lambda k: F.lit(float(cell)) * F.pow(F.lit(2.0), k)
    shares = lambda k: F.pow(F.lit(4.0), k).cast("long")  # noqa: E731  a cell of a coarser grid has so many times the points
    pl = pl.withColumn("level", level)
    rows = lambda a, b: F.sequence(F.floor(F.col(a) / size(F.col("level"))), F.floor(F.col(b) / size(F.col("level"))))
    pl = pl.withColumn("cy", F.explode(rows("min_lat", "max_lat"))).withColumn("cx", F.explode(rows("min_lon", "max_lon")))
    pl = pl.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.least(shares(F.col("level")), F.lit(256).cast("long")) - 1)))
    pts = points.select("point_id", "latitude", "longitude", F.explode(F.array(*[F.lit(k) for k in range(LEVELS + 1)])).alias("level"))
    pts = pts.join(F.broadcast(pl.select("level").distinct()), "level", "left_semi")  # LEVELS + 1 rows at most
    pts = pts.withColumns({"cy": F.floor(F.col("latitude") / size(F.col("level"))), "cx": F.floor(F.col("longitude") / size(F.col("level"))), "share": F.pmod(F.xxhash64("point_id"), F.least(shares(F.col("level")), F.lit(256).cast("long")))})
    inside = F.col("latitude").between(F.col("min_lat"), F.col("max_lat")) & F.col("longitude").between(F.col("min_lon"), F.col("max_lon"))
    j = pts.join(pl, ["level", "cy", "cx", "share"]).where(inside)
    if "polygons" in places.columns:
        bands = polygon_bands(places)
        j = j.join(bands.select("place_id", "bands").distinct(), "place_id").withColumn("band", _band(F.col("latitude")))
        j = j.join(bands.drop("bands"), ["place_id", "band"]).where(_in_bands("latitude", "longitude", "edges"))
    best = F.min(F.struct((-F.col("admin_level")).alias("l"), F.round(F.col("area"), 9).alias("a"), F.col("place_id").alias("p"))).alias("b")
    return j.groupBy("point_id").agg(best).select("point_id", F.col("b.p").alias("place_id"), (-F.col("b.l")).alias("admin_level"))


def norm_name(x) -> Column:
    return F.trim(F.regexp_replace(F.lower(c(x)), r"[^\p{L}\p{N}]+", " "))


def match_name(hints: DataFrame, places: DataFrame) -> DataFrame:
    """Best place for a name with its context. hints: hint_id, name, and maybe country_code, continent_code, admin0..4_place_id.

    places: place_id, canonical_name, alternate_names, country_code, continent_code, admin_level, admin0..4_place_id.
    """
    names = places.withColumn("nm", F.explode(F.array_distinct(F.transform(F.concat(F.array("canonical_name"), "alternate_names"), norm_name)))).where("nm <> ''")
    h = hints.withColumn("nm", norm_name("name"))
    gain = [("country_code", 0.25), ("continent_code", 0.05), ("admin0_place_id", 0.15), ("admin1_place_id", 0.1), ("admin2_place_id", 0.07), ("admin3_place_id", 0.04), ("admin4_place_id", 0.04)]
    score = F.lit(0.45)
    for k, g in gain:
        if k in hints.columns and k in places.columns:
            fold = F.lower if k == "country_code" else c
            score = score + F.when(~blank(h[k]) & (fold(h[k]) == fold(names[k])), g).otherwise(0.0)
    j = h.join(names, h["nm"] == names["nm"]).select("hint_id", names["place_id"], names["admin_level"], F.least(score, F.lit(0.99)).alias("score"))
    best = F.max(F.struct(F.round("score", 6).alias("s"), F.col("admin_level").alias("l"))).over(Window.partitionBy("hint_id"))
    j = j.withColumn("b", best).where((F.round("score", 6) == F.col("b.s")) & (F.col("admin_level") == F.col("b.l")))
    return j.groupBy("hint_id").agg(F.min("place_id").alias("place_id"), F.max("admin_level").alias("admin_level"), F.round(F.max("score"), 6).alias("confidence"))


def attribute(inputs: DataFrame, places: DataFrame, min_conf: float = 0.65, cell: float = 10.0) -> DataFrame:
    """The first rule that applies decides; a weak name match decides too.

    inputs: subject_id, source_id, latitude/longitude (explicit), polygon_lat/lon and
    bbox_lat/lon (centres), name_place_id with name_score (from match_name),
    reverse_lat/lon, track_place_id, home_place_id, jurisdiction_place_id.
    """
    kinds = (("coordinate", "latitude", "longitude", 0.99), ("polygon", "polygon_lat", "polygon_lon", 0.95), ("bbox", "bbox_lat", "bbox_lon", 0.93), ("reverse", "reverse_lat", "reverse_lon", 0.78))
    made = F.array(*[F.struct(F.lit(k).alias("kind"), c(a).alias("lat"), c(o).alias("lon")) for k, a, o, _ in kinds])
    pts = inputs.select("subject_id", F.explode(F.filter(made, lambda x: x["lat"].isNotNull() & x["lon"].isNotNull())).alias("x"))
    pts = pts.select(F.struct("subject_id", F.col("x.kind").alias("kind")).alias("point_id"), F.col("x.lat").alias("latitude"), F.col("x.lon").alias("longitude"))
    at = point_in_place(pts, places, cell).select(F.col("point_id.subject_id").alias("subject_id"), F.struct(F.col("point_id.kind").alias("kind"), "place_id").alias("v"))
    at = at.groupBy("subject_id").agg(F.map_from_entries(F.collect_list("v")).alias("at"))  # four at most
    j = inputs.join(at, "subject_id", "left")
    rule = lambda m, place, conf: F.when(~blank(place), F.struct(F.lit(m).alias("method"), place.alias("place_id"), conf.cast("double").alias("confidence")))
    found = F.coalesce(
        *[rule(k, F.col("at")[k], F.lit(v)) for k, _, _, v in kinds[:3]],
        rule("name", c("name_place_id"), c("name_score")),
        rule("reverse", F.col("at")["reverse"], F.lit(0.78)),
        rule("track", c("track_place_id"), F.lit(0.74)),
        rule("home", c("home_place_id"), F.lit(0.70)),
        rule("jurisdiction", c("jurisdiction_place_id"), F.lit(0.66)),
    )
    out = j.withColumn("f", found)
    conf = F.coalesce("f.confidence", F.lit(0.0))
    return out.select("subject_id", "source_id", F.coalesce("f.method", F.lit("none")).alias("method"), F.coalesce("f.place_id", F.lit("")).alias("place_id"), conf.alias("confidence"), (conf >= min_conf).alias("resolved"))


def unresolved(attributed: DataFrame, now, previous: DataFrame | None = None) -> DataFrame:
    """Queue rows of what wasn't resolved; the time of the first failure stays."""
    t = F.lit(now).cast("timestamp")
    q = attributed.where(~F.col("resolved")).select("source_id", "subject_id", F.when(F.col("place_id") == "", "no_match").otherwise("low_confidence").alias("reason"), "confidence", t.alias("last_failed_at"))
    if previous is None:
        return q.withColumn("first_failed_at", t).withColumn("attempts", F.lit(1))
    p = previous.select("source_id", "subject_id", F.col("first_failed_at").alias("__first"), F.col("attempts").alias("__n"))
    j = q.join(p, ["source_id", "subject_id"], "left")
    return j.withColumn("first_failed_at", F.coalesce("__first", t)).withColumn("attempts", F.coalesce("__n", F.lit(0)) + 1).drop("__first", "__n")


def queue_order(q: DataFrame) -> DataFrame:
    return q.orderBy(F.desc("priority"), "next_retry_at", "queue_id")


def retry_due(queue: DataFrame, now, cap_minutes: int = 360) -> DataFrame:
    """Open rows whose time has come, with the time after a further failure: attempts squared times five minutes, capped."""
    t = F.lit(now).cast("timestamp")
    wait = F.least(F.pow(F.col("attempts") + 1, 2) * 5, F.lit(cap_minutes)).cast("long")
    return queue.where((F.col("state") == "open") & (F.col("next_retry_at") <= t)).withColumn("then_retry_at", F.timestamp_millis(F.unix_millis(t) + wait * 60000))


def coverage(attributed: DataFrame, by: str) -> DataFrame:
    """Share of resolved rows per region."""
    return attributed.groupBy(by).agg(F.count("*").alias("subjects"), F.count_if("resolved").alias("resolved"), (F.round(F.count_if("resolved") * 1000000.0 / F.count("*"), 0) / 10000).alias("coverage_pct"))
