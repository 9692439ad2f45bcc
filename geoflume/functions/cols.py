"""Column expressions shared by the operators. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM, EQUATOR_KM = 6371.0, 6378.137


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round4(x) -> Column:
    """Four places, half away from zero, on the scaled double."""
    return F.round(c(x) * 10000, 0) / 10000


def round8(x) -> Column:
    return F.round(c(x) * 1e8, 0) / 1e8


def clamp(x, low: float, high: float) -> Column:
    return F.least(F.greatest(c(x), F.lit(float(low))), F.lit(float(high)))


def weight(x) -> Column:
    """0..1; null, NaN, infinite and negative values are 0."""
    v = c(x).cast("double")
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")) | (v < 0), 0.0).otherwise(F.least(v, F.lit(1.0)))


def percent(x) -> Column:
    return round4(clamp(x, 0, 100))


def blank(x) -> Column:
    return F.coalesce(F.trim(c(x)), F.lit("")) == ""


def non_blank(*xs) -> Column:
    """The first value that isn't blank."""
    return F.coalesce(*[F.when(~blank(x), c(x)) for x in xs])


def haversine(lat1, lon1, lat2, lon2, radius_km: float = EARTH_KM) -> Column:
    p1, p2 = F.radians(c(lat1)), F.radians(c(lat2))
    dp, dl = F.radians(c(lat2) - c(lat1)), F.radians(c(lon2) - c(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return 2 * radius_km * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), 1 - a)))


def bearing(lat1, lon1, lat2, lon2) -> Column:
    p1, p2, dl = F.radians(c(lat1)), F.radians(c(lat2)), F.radians(c(lon2) - c(lon1))
    y = F.sin(dl) * F.cos(p2)
    x = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360, F.lit(360.0))


def heading_delta(a, b) -> Column:
    d = F.abs(c(a) - c(b))
    return F.when(d > 180, 360 - d).otherwise(d)


def elapsed_s(a, b) -> Column:
    """Seconds from a to b, from whole milliseconds."""
    return (F.unix_millis(c(b)) - F.unix_millis(c(a))) / 1000.0


def hours(a, b) -> Column:
    return (F.unix_millis(c(b)) - F.unix_millis(c(a))) / 3600000.0


def id_part(x) -> Column:
    """A component of an id: only [A-Za-z0-9._-], trimmed, single underscores; blank is unknown; long ones are hashed."""
    s = F.trim(F.coalesce(c(x), F.lit("")))
    t = F.regexp_replace(s, r"[^A-Za-z0-9._-]+", "_")
    t = F.regexp_replace(F.regexp_replace(t, r"^[._-]+|[._-]+$", ""), "_{2,}", "_")
    return F.when(t == "", "unknown").when(F.length(t) > 96, F.concat(F.lit("sha256-"), F.sha2(s, 256))).otherwise(t)


def canonical_id(namespace: str, source, native, content=None) -> Column:
    native_id = F.when(~blank(native), id_part(native))
    if content is not None:
        native_id = F.coalesce(native_id, F.concat(F.lit("sha256-"), F.sha2(c(content), 256)))
    return F.concat_ws(":", F.lit(namespace), id_part(source), F.coalesce(native_id, F.lit("unknown")))


def stable_id(*parts) -> Column:
    """SHA-256 over the trimmed parts, each followed by a zero byte."""
    joined = F.concat(*[y for p in parts for y in (F.trim(F.coalesce(c(p).cast("string"), F.lit(""))), F.lit("\0"))])
    return F.sha2(joined, 256)


def band(x, thresholds: list[tuple[float, str]], other: str) -> Column:
    """The name of the first threshold (falling) that x reaches, else other."""
    out = None
    for least, name in thresholds:
        out = F.when(c(x) >= least, name) if out is None else out.when(c(x) >= least, name)
    return out.otherwise(other)


def id_prefix(x, prefix: str) -> Column:
    """x with the prefix put before it unless it is there or x is blank."""
    v = F.trim(c(x))
    return F.when(v == "", v).when(v.startswith(prefix), v).otherwise(F.concat(F.lit(prefix), v))


def id_prefixes(xs, prefix: str) -> Column:
    return F.transform(c(xs), lambda x: id_prefix(x, prefix))


#: Query parameters that only track visitors.
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid")


def normalize_url(url) -> Column:
    """Lower scheme and host, no default port, user, fragment or tracking parameters, sorted query, one slash at most."""
    u = F.trim(c(url))
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    rest = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rest = F.regexp_replace(rest, r"#.*$", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, r"^([^/?]*)", 1), r"^.*@", ""))
    host = F.when(scheme == "http", F.regexp_replace(host, r":80$", "")).when(scheme == "https", F.regexp_replace(host, r":443$", "")).otherwise(host)
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), r"/{2,}", "/")
    path = F.when(F.length(path) > 1, F.regexp_replace(path, r"/$", "")).otherwise(path)
    path = F.when(path == "", "/").otherwise(path)
    query = F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).startswith("utm_") & ~F.lower(F.substring_index(p, "=", 1)).isin(*TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(scheme, F.lit("://"), host, path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def grid_cell(lat, lon, size: float) -> Column:
    return F.concat_ws(":", F.floor(c(lat) / size), F.floor(c(lon) / size))


def cosine(a, b) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(c(a), c(b)) / F.sqrt(dot(c(a), c(a)) * dot(c(b), c(b)))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(c(a), c(b), lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def euclidean(a, b) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(c(a), c(b), lambda p, q: F.pow(p.cast("double") - q.cast("double"), 2)), F.lit(0.0), lambda s, v: s + v))


DEGREE = math.pi / 180


def broadcast_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df with a broadcast hint if it has no more rows than that; else Spark joins it as it thinks best. Counts up to that many rows at once."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
