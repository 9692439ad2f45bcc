"""Raw bodies to rows: format sniffing, exploding, and the typed feeds."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from geoflume.sources import files
from geoflume.functions.cols import blank, c, non_blank, round4

MPS_KMH, KNOT_KMH = 3.6, 1.852


def load_staged_csv(spark: SparkSession, path: str, schema: StructType | str, loaded_from: str, now) -> DataFrame:
    """A headered CSV dataset with the time and the place it was loaded from; write it with mode overwrite."""
    return spark.read.csv(path, header=True, schema=schema).withColumn("loaded_at", F.lit(now).cast("timestamp")).withColumn("loaded_from", F.lit(loaded_from))


def write_table(df: DataFrame, path: str, mode: str = "append", partitions: list[str] = ()) -> None:
    """Append facts, overwrite full rebuilds; overwrite with partitions replaces only those that df has."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def stage_then_publish(df: DataFrame, target: str, token: str, mode: str = "append") -> bool:
    """Write rows under a token, then let them count: False, and nothing changes, if the token was published before.

    The rows are staged in a folder of the token, which a job that is run again
    writes anew. What counts is told by markers, which appear whole, after the
    rows: a job that fails half-way leaves the table as it was. `overwrite` makes
    the token's rows the whole table from then on. Read with `published`. One job
    at a time may publish a token.
    """
    spark, name = df.sparkSession, hashlib.sha256(token.encode()).hexdigest()[:32]
    have = files.names(spark, f"{target}/published")
    if any(x.endswith(name) for x in have):
        return False
    df.write.mode("overwrite").parquet(f"{target}/rows/{name}")
    at = int(have[-1].partition(".")[0]) + 1 if have else 0
    return files.put(spark, f"{target}/published/{at:012d}.{mode}.{name}", token)


def published(spark: SparkSession, target: str, schema: StructType | str) -> DataFrame:
    """The rows of all tokens since the last overwrite."""
    have = [x.split(".") for x in files.names(spark, f"{target}/published")]
    start = max((i for i, x in enumerate(have) if x[1] == "overwrite"), default=0)
    paths = [f"{target}/rows/{x[2]}" for x in have[start:]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def sniff_format(body) -> Column:
    """json, atom, rss, html, xml, tsv, csv or text, by the body's start and first line."""
    t = F.ltrim(F.regexp_replace(F.coalesce(c(body), F.lit("")), "^﻿", ""))
    head = F.lower(F.substring(t, 1, 512))
    line = F.substring_index(t, "\n", 1)
    return (
        F.when(t == "", "text")
        .when(t.startswith("{") | t.startswith("["), "json")
        .when(head.startswith("<!doctype html") | head.contains("<html"), "html")
        .when(head.contains("<rss"), "rss")
        .when(head.contains("<feed"), "atom")
        .when(head.startswith("<?xml") | head.startswith("<"), "xml")
        .when(F.instr(line, "\t") > 0, "tsv")
        .when(F.instr(line, ",") > 0, "csv")
        .otherwise("text")
    )


def explode_json_records(raw: DataFrame) -> DataFrame:
    """One row for each record of an object or array body; native id by id, guid, uuid, code, key. raw: raw_id, body."""
    t = F.ltrim(c("body"))
    items = F.when(t.startswith("["), F.from_json(t, "array<string>")).when(t.startswith("{"), F.array(t))
    x = raw.select("raw_id", F.posexplode(items).alias("record_index", "record"))
    return x.select("raw_id", "record_index", F.coalesce(non_blank(*[F.get_json_object("record", f"$.{k}") for k in ("id", "guid", "uuid", "code", "key")]), F.lit("")).alias("native_id"), "record")


def clean_header(x: Column, i: Column) -> Column:
    v = F.regexp_replace(F.lower(F.trim(x)), r"\s+", "_")
    return F.when(v == "", F.concat(F.lit("col_"), (i + 1).cast("string"))).otherwise(v)


def explode_delimited_records(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of bodies with a header line, tab, semicolon or comma separated; a line with another number of fields is a drift error."""
    lines = F.filter(F.split(c("body"), r"\r?\n"), lambda x: F.trim(x) != "")
    d = F.when(F.instr(F.get(lines, F.lit(0)), "\t") > 0, "\t").when(F.instr(F.get(lines, F.lit(0)), ";") > 0, ";").otherwise(",")
    x = raw.select("raw_id", lines.alias("lines"), d.alias("d")).where(F.size("lines") > 0)
    x = x.withColumn("names", F.transform(F.split(F.get("lines", F.lit(0)), F.col("d")), clean_header))
    x = x.select("raw_id", "names", "d", F.posexplode(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).alias("record_index", "line"))
    x = x.withColumn("fields", F.transform(F.split("line", F.col("d"), -1), lambda v: F.trim(v)))
    ok = F.size("fields") == F.size("names")
    rows = x.where(ok).select("raw_id", "record_index", F.map_from_arrays("names", "fields").alias("record"))
    errors = x.where(~ok).select("raw_id", "record_index", F.lit("schema_drift").alias("error"), F.size("names").alias("expected"), F.size("fields").alias("got"))
    return rows, errors


def flatten_state_vectors(b: DataFrame) -> DataFrame:
    """Track points of positional state arrays; rows without position go. b: raw_id, body {time, states: [[...]]}."""
    states = F.from_json(F.get_json_object("body", "$.states"), "array<array<string>>")
    x = b.select("raw_id", F.explode(states).alias("s"))
    at = lambda i: F.get("s", F.lit(i))
    num = lambda i: at(i).try_cast("double")
    x = x.select(
        "raw_id", F.lower(F.trim(at(0))).alias("icao24"), F.trim(F.coalesce(at(1), F.lit(""))).alias("callsign"), F.trim(F.coalesce(at(2), F.lit(""))).alias("origin_country"),
        F.timestamp_seconds(F.coalesce(at(3).try_cast("long"), at(4).try_cast("long"))).alias("observed_at"), num(6).alias("latitude"), num(5).alias("longitude"), num(7).alias("altitude_m"),
        F.coalesce(at(8) == "true", F.lit(False)).alias("on_ground"), round4(num(9) * MPS_KMH).alias("speed_kmh"), num(10).alias("heading_deg"), F.coalesce(at(14), F.lit("")).alias("squawk"), F.coalesce(at(17).try_cast("int"), F.lit(0)).alias("category"),
    )
    return x.where("latitude is not null and longitude is not null")


def _pick(col: str, *keys: str) -> Column:
    return non_blank(*[F.get_json_object(c(col), f"$.{k}") for k in keys])


def _items(*keys: str) -> Column:
    return F.coalesce(*[F.from_json(F.get_json_object("body", f"$.{k}"), "array<string>") for k in keys])


def flatten_adsb(b: DataFrame) -> DataFrame:
    """Track points of ac, aircraft or states lists with their alternative key names; knots to km/h."""
    x = b.select("raw_id", F.explode(_items("ac", "aircraft", "states")).alias("r"))
    num = lambda *k: _pick("r", *k).try_cast("double")
    x = x.select("raw_id", F.lower(F.trim(_pick("r", "hex", "icao24", "icao"))).alias("icao24"), num("lat", "latitude").alias("latitude"), num("lon", "lng", "longitude").alias("longitude"), round4(num("gs", "speed") * KNOT_KMH).alias("speed_kmh"), num("track", "heading").alias("heading_deg"))
    return x.where("latitude is not null and longitude is not null and icao24 is not null")


def flatten_ais_hub(b: DataFrame) -> DataFrame:
    """Track points of vessel rows with upper or lower case keys; the body is a list."""
    x = b.select("raw_id", F.explode(F.from_json("body", "array<string>")).alias("r"))
    num = lambda *k: _pick("r", *k).try_cast("double")
    x = x.select("raw_id", _pick("r", "MMSI", "mmsi").alias("mmsi"), num("LAT", "lat").alias("latitude"), num("LON", "lon").alias("longitude"), round4(num("SOG", "sog") * KNOT_KMH).alias("speed_kmh"), num("COG", "cog").alias("course_deg"))
    return x.where("latitude is not null and longitude is not null and mmsi is not null")


def flatten_reference_entities(b: DataFrame) -> DataFrame:
    """Entities of items lists, typed by a part of the URL."""
    x = b.select("raw_id", F.lower("url").alias("u"), F.explode(_items("items")).alias("r"))
    kind = F.when(x.u.contains("airspace"), "airspace").when(x.u.contains("airport"), "airport").when(x.u.contains("navaid"), "navaid").when(x.u.contains("reporting"), "reporting_point").otherwise("reference")
    return x.select("raw_id", kind.alias("entity_type"), _pick("r", "id", "_id").alias("native_id"), F.coalesce(_pick("r", "name"), F.lit("")).alias("name"), F.coalesce(_pick("r", "country"), F.lit("")).alias("country"))


#: Kind of row that each message type gives.
AIS_ROUTES = {
    "track_point": ("PositionReport", "StandardClassBPositionReport", "ExtendedClassBPositionReport", "LongRangeAisBroadcastMessage", "StandardSearchAndRescueAircraftReport"),
    "entity": ("ShipStaticData", "StaticDataReport"),
    "navigation_aid": ("AidsToNavigationReport",),
    "base_station": ("BaseStationReport",),
}


def ais_messages(raw: DataFrame) -> DataFrame:
    """A row per message of a batch with its route, key, position and static fields. raw: raw_id, body (list of messages)."""
    x = raw.select("raw_id", F.posexplode(F.from_json("body", "array<string>")).alias("message_no", "m"))
    x = x.withColumn("message_type", F.get_json_object("m", "$.MessageType")).withColumn("own", F.element_at(F.map_values(F.from_json(F.get_json_object("m", "$.Message"), "map<string,string>")), 1))
    own = lambda k: F.get_json_object("own", f"$.{k}")
    meta = lambda k: F.get_json_object("m", f"$.MetaData.{k}")
    route = F.lit("raw")
    for k, types in AIS_ROUTES.items():
        route = F.when(F.col("message_type").isin(*types), k).otherwise(route)
    mmsi = non_blank(meta("MMSI_String"), meta("MMSI"), own("UserID"))
    lat, lon = own("Latitude").try_cast("double"), own("Longitude").try_cast("double")
    lat, lon = F.coalesce(lat, meta("latitude").try_cast("double")), F.coalesce(lon, meta("longitude").try_cast("double"))
    fix = ~((lat == 0) & (lon == 0))
    at = F.try_to_timestamp(F.substring(meta("time_utc"), 1, 19), F.lit("yyyy-MM-dd HH:mm:ss"))
    imo = own("ImoNumber").try_cast("long")
    return x.select(
        "raw_id", "message_no", "message_type", route.alias("route"), mmsi.alias("mmsi"), at.alias("observed_at"), F.concat_ws(":", "message_type", mmsi, F.unix_millis(at)).alias("record_key"), F.when(fix, lat).alias("latitude"), F.when(fix, lon).alias("longitude"),
        round4(own("Sog").try_cast("double") * KNOT_KMH).alias("speed_kmh"), F.trim(F.coalesce(own("Name"), meta("ShipName"), F.lit(""))).alias("name"), F.when(imo > 0, F.concat(F.lit("imo:"), imo)).otherwise(F.concat(F.lit("mmsi:"), mmsi)).alias("vessel_id"),
    )


def route_ais_messages(raw: DataFrame) -> dict[str, DataFrame]:
    m = ais_messages(raw)
    out = {k: m.where(F.col("route") == k) for k in ("track_point", "entity", "navigation_aid", "base_station", "raw")}
    out["track_point"] = out["track_point"].where("latitude is not null and longitude is not null")
    return out


def entity_place_bridge(b: DataFrame) -> DataFrame:
    """Bridge rows of payload ids; blanks go. b: entity_id, payload_json."""
    x = b.select("entity_id", F.get_json_object("payload_json", "$.place_id").alias("place_id")).where(~blank("place_id"))
    return x.select(F.concat_ws(":", F.lit("bep"), "entity_id", "place_id").alias("bridge_id"), "entity_id", "place_id")


def places_from_dimension(d: DataFrame, id_col: str, name_col: str, kind: str) -> DataFrame:
    """Place rows of a dimension list, one per id."""
    x = d.select(F.concat(F.lit("plc:"), F.lit(kind), F.lit(":"), c(id_col)).alias("place_id"), c(name_col).alias("canonical_name"), F.lit(kind).alias("place_type")).where(~blank("canonical_name"))
    return x.groupBy("place_id", "place_type").agg(F.min("canonical_name").alias("canonical_name"))
