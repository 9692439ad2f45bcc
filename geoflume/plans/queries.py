"""Registered queries over the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoflume.functions import cols
from geoflume.operators import discovery, metrics, packs, places, promote, quality, serve, tracks, tree, versions
from geoflume.sources import ingest, views
from geoflume.sources.views import read_table, with_views
from geoflume.streaming.jobs import work_dir

NOW = "2024-01-20 00:00:00"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *needs: str):
    def put(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = with_views(sql, *needs)
        return f

    return put


def r4(x: str) -> str:
    return f"(round(({x}) * 10000) / 10000)"


def hav(a: str, b: str, x: str, y: str, r: float = 6371.0) -> str:
    h = f"(pow(sin(radians({x} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({x})) * pow(sin(radians({y} - {b}) / 2), 2))"
    return f"(2 * {r}::double * atan2(sqrt({h}), sqrt(greatest(0.0::double, 1 - {h}))))"


# sources


@query("ref_01_read_table", "select s_suppkey, s_name, s_acctbal from supplier where s_acctbal > 5000")
def _(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "supplier").where("s_acctbal > 5000").select("s_suppkey", "s_name", "s_acctbal")


@query("ref_02_load_staged_csv", "select s_suppkey, s_name, 'feed' as loaded_from, timestamp '2024-01-20 00:00:00' as loaded_at from supplier")
def _(s, d):
    """The table goes out as CSV files and comes back through the loader."""
    path = work_dir(s)
    read_table(s, d, "supplier").select("s_suppkey", "s_name").write.csv(path, header=True)
    return ingest.load_staged_csv(s, path, "s_suppkey long, s_name string", "feed", NOW)


@query("ref_09_write_table", "select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then 'again' else o_orderpriority end as note from orders")
def _(s, d):
    """A full write, then one part of it replaced twice: its rows are there once."""
    path, o = work_dir(s), read_table(s, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("note"), "o_orderstatus")
    ingest.write_table(o, path, "overwrite", ["o_orderstatus"])
    for _ in range(2):
        ingest.write_table(o.where("o_orderstatus = 'F'").withColumn("note", F.lit("again")), path, "overwrite", ["o_orderstatus"])
    return s.read.schema(o.schema).parquet(path)


@query("ref_10_stage_then_publish", "select event_id, user_id from events")
def _(s, d):
    """Two batches, one of them published twice: its rows are there once."""
    path, e = work_dir(s), read_table(s, d, "events").select("event_id", "user_id")
    for k in (0, 1, 0):
        ingest.stage_then_publish(e.where(F.col("event_id") % 2 == k), path, f"batch {k}")
    return ingest.published(s, path, e.schema)


_SNIFF = "case page_id % 7 when 0 then html when 1 then ' {\"id\": ' || page_id || '}' when 2 then 'a,b\n1,2' when 3 then '<?xml version=\"1.0\"?><rss></rss>' when 4 then 'a' || chr(9) || 'b' when 5 then '<feed></feed>' else 'plain' end"


@query("ref_03_sniff_format", "select page_id, case page_id % 7 when 0 then 'html' when 1 then 'json' when 2 then 'csv' when 3 then 'rss' when 4 then 'tsv' when 5 then 'atom' else 'text' end as format from pages")
def _(s, d):
    return read_table(s, d, "pages").select("page_id", ingest.sniff_format(F.expr(_SNIFF)).alias("format"))


@query("ref_04_explode_json", "select event_id as raw_id, i as record_index, case i when 0 then 'e' || event_id when 1 then 'g' || event_id else '' end as native_id from ev, (values (0), (1), (2)) t(i)", "ev")
def _(s, d):
    body = F.format_string('[{"id":"e%d","k":1},{"guid":"g%d"},{"x":2}]', "event_id", "event_id")
    return ingest.explode_json_records(read_table(s, d, "events").select(F.col("event_id").alias("raw_id"), body.alias("body"))).drop("record")


def _delimited(s, d):
    body = F.format_string("Name;Some Value;\n a%d; %d;x\n\nbroken;1\n", "user_id", "event_id")
    return ingest.explode_delimited_records(read_table(s, d, "events").select(F.col("event_id").alias("raw_id"), body.alias("body")))


@query("ref_05_explode_delimited", "select event_id as raw_id, 0 as record_index, 'a' || user_id as name, cast(event_id as varchar) as some_value, 'x' as col_3 from events")
def _(s, d):
    return _delimited(s, d)[0].select("raw_id", "record_index", *[F.col("record")[k].alias(k) for k in ("name", "some_value", "col_3")])


@query("ref_05_delimited_errors", "select event_id as raw_id, 1 as record_index, 'schema_drift' as error, 3 as expected, 2 as got from events")
def _(s, d):
    return _delimited(s, d)[1]


@query(
    "ref_06_state_vectors",
    f"""select event_id as raw_id, 'a' || user_id as icao24, 'CS' || k as callsign, 'X' as origin_country, make_timestamp(1700000000000000 + event_id * 1000000) as observed_at, k / 2.0::double as latitude, k / 4.0::double as longitude,
    case when k % 3 <> 0 then value end as altitude_m, k % 2 = 0 as on_ground, {r4("value * 3.6::double")} as speed_kmh, 90.5::double as heading_deg, '7000' as squawk, k % 9 as category from ev""",
    "ev",
)
def _(s, d):
    e = views._events(s, d)
    body = F.concat(
        F.lit('{"time":1,"states":[["A'), "user_id", F.lit(' ","CS'), "k", F.lit('","X",null,'), (F.col("event_id") + 1700000000).cast("string"), F.lit(","), (F.col("k") / 4.0).cast("string"), F.lit(","), (F.col("k") / 2.0).cast("string"), F.lit(","),
        F.when(F.col("k") % 3 != 0, F.col("value").cast("string")).otherwise("null"), F.lit(","), (F.col("k") % 2 == 0).cast("string"), F.lit(","), F.col("value").cast("string"), F.lit(',90.5,0,null,null,"7000",false,0,'), (F.col("k") % 9).cast("string"),
        F.lit('],["B","","",1,1,null,null,1,false,1,1,0,null,null,null,false,0]]}'),
    )
    return ingest.flatten_state_vectors(e.select(F.col("event_id").alias("raw_id"), body.alias("body")))


@query("ref_07a_adsb", f"select event_id as raw_id, 'h' || user_id as icao24, k / 2.0::double as latitude, k / 4.0::double as longitude, {r4('value * 1.852::double')} as speed_kmh, 10.0::double as heading_deg from ev", "ev")
def _(s, d):
    e = views._events(s, d)
    body = F.concat(F.when(F.col("k") % 2 == 0, '{"ac":[{"hex":"H').otherwise('{"aircraft":[{"icao24":"H'), "user_id", F.lit('","lat":'), (F.col("k") / 2.0).cast("string"), F.lit(',"lon":'), (F.col("k") / 4.0).cast("string"), F.lit(',"gs":'), F.col("value").cast("string"), F.lit(',"track":10},{"hex":"no"}]}'))
    return ingest.flatten_adsb(e.select(F.col("event_id").alias("raw_id"), body.alias("body")))


@query("ref_07b_ais_hub", f"select event_id as raw_id, '9' || user_id as mmsi, k / 2.0::double as latitude, k / 4.0::double as longitude, {r4('value * 1.852::double')} as speed_kmh, 5.0::double as course_deg from ev", "ev")
def _(s, d):
    e = views._events(s, d)
    body = F.concat(F.lit('[{"MMSI":9'), "user_id", F.lit(',"LAT":'), (F.col("k") / 2.0).cast("string"), F.lit(',"lon":'), (F.col("k") / 4.0).cast("string"), F.lit(',"SOG":'), F.col("value").cast("string"), F.lit(',"COG":5}]'))
    return ingest.flatten_ais_hub(e.select(F.col("event_id").alias("raw_id"), body.alias("body")))


@query("ref_07c_reference_entities", "select event_id as raw_id, case k % 3 when 0 then 'airport' when 1 then 'airspace' else 'navaid' end as entity_type, 'n' || event_id as native_id, 'Name ' || k as name, 'FR' as country from ev", "ev")
def _(s, d):
    e = views._events(s, d)
    url = F.concat(F.lit("https://x.org/"), F.element_at(F.array(F.lit("Airports"), F.lit("airspaces"), F.lit("navaids")), (F.col("k") % 3 + 1).cast("int")))
    return ingest.flatten_reference_entities(e.select(F.col("event_id").alias("raw_id"), url.alias("url"), F.format_string('{"items":[{"id":"n%d","name":"Name %d","country":"FR"}]}', "event_id", "k").alias("body")))


def _ais_body(s, d):
    e = views._events(s, d)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("PositionReport", "ShipStaticData", "AidsToNavigationReport", "Interrogation")]), (F.col("k") % 4 + 1).cast("int"))
    body = F.concat(
        F.lit('[{"MessageType":"'), kind, F.lit('","MetaData":{"MMSI":9'), "user_id", F.lit(',"ShipName":" S'), "k", F.lit(' ","latitude":'), (F.col("k") / 2.0).cast("string"), F.lit(',"longitude":1.5,"time_utc":"2024-01-01 00:00:0'), (F.col("k") % 10).cast("string"),
        F.lit('.123 +0000 UTC"},"Message":{"'), kind, F.lit('":{"Latitude":'), F.when(F.col("k") % 5 == 0, "0").otherwise((F.col("k") / 2.0).cast("string")), F.lit(',"Longitude":'), F.when(F.col("k") % 5 == 0, "0").otherwise("1.5"), F.lit(',"Sog":10,"ImoNumber":'), F.when(F.col("k") % 2 == 1, F.col("user_id")).otherwise(0), F.lit("}}}]"),
    )
    return e.select(F.col("event_id").alias("raw_id"), body.alias("body"))


@query(
    "ref_07d_ais_messages",
    """select event_id as raw_id, case k % 4 when 0 then 'track_point' when 1 then 'entity' when 2 then 'navigation_aid' else 'raw' end as route, '9' || user_id as mmsi, make_timestamp(2024, 1, 1, 0, 0, (k % 10)::double) as observed_at,
    case when k % 5 <> 0 then k / 2.0::double end as latitude, case when k % 5 <> 0 then 1.5::double end as longitude, 18.52::double as speed_kmh, 'S' || k as name, case when k % 2 = 1 and user_id > 0 then 'imo:' || user_id else 'mmsi:9' || user_id end as vessel_id from ev""",
    "ev",
)
def _(s, d):
    return ingest.ais_messages(_ais_body(s, d)).select("raw_id", "route", "mmsi", "observed_at", "latitude", "longitude", "speed_kmh", "name", "vessel_id")


def _bronze(s, d):
    e = views._events(s, d)
    payload = F.concat(F.when(F.col("k") % 4 == 0, F.lit('{"name":"N')).otherwise(F.concat(F.lit('{"place_id":"plc:'), F.col("user_id") % 25, F.lit('","name":"N'))), "k", F.lit('","value":'), F.col("value").cast("string"), F.lit("}"))
    cand = e.select(
        F.concat(F.lit("raw:"), "event_id").alias("raw_id"), F.concat(F.lit("src:"), "event_type").alias("source_id"), F.lit("p1").alias("parser_id"), F.lit("1").alias("parser_version"), (F.col("k") % 3).alias("source_record_index"),
        F.element_at(F.array(F.lit("observation"), F.lit("event"), F.lit("entity"), F.lit("other")), (F.col("k") % 4 + 1).cast("int")).alias("record_kind"), F.when(F.col("k") % 6 == 0, "").otherwise(F.concat(F.lit("n"), F.col("event_id") % 500)).alias("native_id"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("content_hash"), F.when(F.col("k") % 2 == 0, F.col("ts")).alias("observed_at"), F.col("ts").alias("occurred_at"), F.col("ts").alias("starts_at"), payload.alias("payload_json"),
    )
    return promote.build_bronze_rows(cand, NOW)


_BRONZE = """select 'raw:' || event_id as raw_id, 'src:' || event_type as source_id, case when k % 6 = 0 then sha256(cast(event_id as varchar)) else 'n' || (event_id % 500) end as native_id, k % 3 as source_record_index,
    case k % 4 when 0 then 'observation' when 1 then 'event' when 2 then 'entity' else 'other' end as record_kind, ts as occurred_at, timestamp '2024-01-20 00:00:00' as parsed_at,
    case when k % 4 = 0 then '' else 'plc:' || (user_id % 25) end as place_id, 'N' || k as name, value from ev"""


@query("ref_07e_82_bronze_input", f"select raw_id, source_id, native_id, record_kind, occurred_at, place_id, place_id <> '' as resolved, name, value from ({_BRONZE})", "ev")
def _(s, d):
    return promote.bronze_to_input(_bronze(s, d)).select("raw_id", "source_id", "native_id", "record_kind", "occurred_at", "place_id", "resolved", "name", "value")


# versions


@query("ref_08_latest_version", "select l_orderkey, l_linenumber, l_suppkey, l_quantity from (select *, row_number() over (partition by l_orderkey order by l_linenumber desc, l_suppkey desc, l_quantity desc) as rn from lineitem) where rn = 1")
def _(s, d):
    return versions.latest_version(read_table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"), ["l_orderkey"], "l_linenumber")


@query("ref_42_latest_by", "select l_orderkey, b.l_suppkey as l_suppkey, b.l_quantity as l_quantity from (select l_orderkey, max({'n': l_linenumber, 'l_suppkey': l_suppkey, 'l_quantity': l_quantity}) as b from lineitem group by l_orderkey)")
def _(s, d):
    return versions.latest_by(read_table(s, d, "lineitem"), ["l_orderkey"], ["l_suppkey", "l_quantity"], "l_linenumber")


@query("ref_41_upsert", "select o_orderkey, case when o_orderkey % 3 = 0 then 'X' else o_orderstatus end as o_orderstatus from orders union all select -1 - o_orderkey, 'N' from orders where o_orderkey % 50 = 0")
def _(s, d):
    o = read_table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    new = o.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("X")).union(o.where("o_orderkey % 50 = 0").select(-1 - F.col("o_orderkey"), F.lit("N")))
    return versions.upsert(o, new, ["o_orderkey"])


@query("ref_154_insert_if_absent", "select o_custkey, max(o_orderkey) as o_orderkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 2000) group by o_custkey")
def _(s, d):
    have = read_table(s, d, "customer").where("c_acctbal > 2000").select(F.col("c_custkey").alias("o_custkey"), F.lit(0).cast("long").alias("o_orderkey"))
    return versions.insert_if_absent(have, read_table(s, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"])


@query("ref_26_restrict_to", "select l_orderkey, l_partkey, l_quantity from lineitem where (l_returnflag, l_linestatus) in (select 'A', 'F' union all select 'R', 'O')")
def _(s, d):
    want = s.createDataFrame([("A", "F"), ("R", "O")], "l_returnflag string, l_linestatus string")
    return versions.restrict_to(read_table(s, d, "lineitem"), want, ["l_returnflag", "l_linestatus"]).select("l_orderkey", "l_partkey", "l_quantity")


@query("ref_33_backfill_marking", "select entity_id, d as marking, record_version + 1 as record_version from (select *, case record_version % 3 when 0 then '' when 1 then 'open' else 'closed' end as m, case entity_type when 'customer' then 'open' else 'closed' end as d from entities) where m <> d", "entities")
def _(s, d):
    e = views.entities(s, d).select("entity_id", F.col("entity_type").alias("source_id"), F.element_at(F.array(F.lit(""), F.lit("open"), F.lit("closed")), (F.col("record_version") % 3 + 1).cast("int")).alias("marking"), "record_version")
    src = s.createDataFrame([("customer", "open"), ("supplier", "closed")], "source_id string, default_marking string")
    return versions.backfill_marking(e, src).select("entity_id", "marking", "record_version")


@query("ref_149_merge_candidates", "select p_partkey as candidate_id, cast(p_size as varchar) as checksum, case when p_partkey % 4 = 0 then 1 else 8 end as record_version, case when p_partkey % 4 = 0 then 'pending' else 'approved' end as review_status from part where p_partkey % 4 = 0 or p_partkey % 3 = 0")
def _(s, d):
    p = read_table(s, d, "part").select(F.col("p_partkey").alias("candidate_id"), F.col("p_size").cast("string").alias("checksum"))
    old = p.where("candidate_id % 4 <> 0").select("candidate_id", F.when(F.col("candidate_id") % 3 == 0, "old").otherwise(F.col("checksum")).alias("checksum"), F.lit(7).alias("record_version"), F.lit("approved").alias("review_status"))
    return versions.merge_candidates(old, p, NOW).drop("updated_at")


@query("ref_152_named_version", "select name, version, l_suppkey from (select 'art' as name, l_linenumber as version, l_suppkey, row_number() over (order by l_linenumber desc, l_suppkey desc) as rn from lineitem) where rn = 1")
def _(s, d):
    return versions.named_version(read_table(s, d, "lineitem").select(F.lit("art").alias("name"), F.col("l_linenumber").alias("version"), "l_suppkey"), "art")


# reading


@query("ref_11_id_prefixes", "select o_orderkey, case when o_orderkey % 2 = 0 then 'plc:' || o_custkey else 'plc:' || o_custkey end as place_id, ['ent:a', 'ent:' || o_custkey] as refs from orders")
def _(s, d):
    o = read_table(s, d, "orders")
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" plc:"), "o_custkey")).otherwise(F.col("o_custkey").cast("string"))
    return o.select("o_orderkey", cols.id_prefix(raw, "plc:").alias("place_id"), cols.id_prefixes(F.array(F.lit("ent:a"), F.col("o_custkey").cast("string")), "ent:").alias("refs"))


@query("ref_12_list_rows", "select entity_id, canonical_name, risk_band from entities where entity_type = 'customer' and canonical_name ilike '%00%' and entity_id > 'ent:customer:1' order by entity_id limit 50 offset 5", "entities")
def _(s, d):
    return serve.list_rows(views.entities(s, d), "entity_id", {"entity_type": "customer"}, "00", ["canonical_name"], cursor="ent:customer:1", offset=5, fields=["entity_id", "canonical_name", "risk_band"])


@query("ref_13_search_regex", "select p_partkey, p_name from part where regexp_matches(p_name, '^(red|blue) ') or regexp_matches(p_type, 'ECO')")
def _(s, d):
    return serve.search(read_table(s, d, "part"), "^(red|blue) |ECO", ["p_name", "p_type"], "regex").select("p_partkey", "p_name")


@query("ref_14_detail", "select * from entities where entity_id = 'ent:supplier:7'", "entities")
def _(s, d):
    return serve.detail(views.entities(s, d), "entity_id", "ent:supplier:7")


@query("ref_15_total_count", "select count(*) as total from entities where risk_band = 'high' and lower(canonical_name) like '%customer%'", "entities")
def _(s, d):
    return serve.total_count(views.entities(s, d), {"risk_band": "high"}, "Customer", ["canonical_name"])


@query("ref_16_json_hot_columns", "select event_id, k as hot_k, cast(null as varchar) as note from ev", "ev")
def _(s, d):
    return serve.json_hot_columns(read_table(s, d, "events").select("event_id", "props"), "props", {"hot_k": ("int", ["$.missing", "$.k"]), "note": ("string", ["$.note"])}).drop("props")


@query("ref_17_valid_position", "select event_id, value * 2 as latitude, value * 4 as longitude from events where value * 2 between -90 and 90 and value * 4 between -180 and 180")
def _(s, d):
    return serve.valid_position(read_table(s, d, "events").select("event_id", (F.col("value") * 2).alias("latitude"), (F.col("value") * 4).alias("longitude")))


@query("ref_18_latest_parser", "select event_id, k from ev where k = (select max(k) from ev)", "ev")
def _(s, d):
    return serve.latest_parser_only(views._events(s, d).select("event_id", "k"), "k")


@query(
    "ref_19_normalize_url",
    r"""select page_id, scheme || '://' || host || path || case when q = '' then '' else '?' || q end as canonical_url from (select page_id, scheme, host, case when path = '' then '/' when length(path) > 1 then regexp_replace(path, '/$', '') else path end as path,
    coalesce(array_to_string(list_sort(list_filter(string_split(q0, '&'), lambda p: p <> '' and not starts_with(lower(p), 'utm_') and split_part(lower(p), '=', 1) not in ('fbclid', 'gclid', 'mc_cid', 'mc_eid'))), '&'), '') as q
    from (select page_id, lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) as scheme, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) as host, regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/{2,}', '/', 'g') as path, regexp_extract(url, '\?([^#]*)', 1) as q0 from pages))""",
)
def _(s, d):
    return read_table(s, d, "pages").select("page_id", cols.normalize_url("url").alias("canonical_url"))


@query("ref_20_credential_gate", "select event_id, k % 2 = 0 as gated from ev", "ev")
def _(s, d):
    e = views._events(s, d)
    attrs = F.when(F.col("k") % 2 == 0, F.when(F.col("k") % 4 == 0, '{"requires_api_key":true}').otherwise('{"auth_required":"true"}')).otherwise('{"auth_required":false}')
    return e.select("event_id", serve.credential_gate(attrs).alias("gated"))


@query("ref_65_page_after", "select o_orderkey, o_orderdate from orders where (o_orderdate, o_orderkey) < (timestamp '1998-01-01', 100) order by o_orderdate desc, o_orderkey desc limit 40")
def _(s, d):
    o = read_table(s, d, "orders").select("o_orderkey", "o_orderdate")
    import datetime

    return serve.page_after(o, ["o_orderdate", "o_orderkey"], [datetime.datetime(1998, 1, 1), 100], 40, desc=True)


def _logs(s, d):
    e = views._events(s, d).select("event_id", "ts", F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"), "k", "event_type")
    return e.where("k % 3 = 0").withColumnsRenamed({"event_id": "job_id", "ts": "started_at"}), e.where("k % 3 = 1").withColumnsRenamed({"event_id": "fetch_id", "ts": "fetched_at"}), e.where("k % 3 = 2").withColumnsRenamed({"event_id": "parse_id", "ts": "parsed_at"})


@query("ref_66_activity_tail", "select case k % 3 when 0 then 'job' when 1 then 'fetch' else 'parse' end as kind, cast(event_id as varchar) as id, ts as at, case event_type when 'error' then 'error' else 'success' end as status from ev", "ev")
def _(s, d):
    return serve.activity_tail(*_logs(s, d))


@query("ref_67_tracks_view", "select 'segment' as row_kind, track_id, count(*) as n, count(latitude) as with_lat from points group by track_id having count(*) >= 2 union all select 'point', track_id, 1, 1 from points", "points")
def _(s, d):
    p = views.points(s, d)
    seg = p.groupBy("track_id").agg(F.count("*").alias("n"), F.count("latitude").alias("with_lat")).where("n >= 2")
    return serve.tracks_view(seg, p.select("track_id", F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("with_lat")))


@query("ref_69b_combined_search", "select * from (select 'place' as class, place_id as id, canonical_name as name from places where place_id ilike '%1%' or canonical_name ilike '%1%' union all select 'entity', entity_id, canonical_name from entities where entity_id ilike '%1%' or canonical_name ilike '%1%') order by name, id limit 50", "places", "entities")
def _(s, d):
    return serve.combined_search(views.places(s, d), views.entities(s, d), "1")


@query("ref_46d_class_counts", "select 'entity' as kind, entity_type as class, count(*) as n from entities group by 2 union all select 'place', place_type, count(*) from places group by 2", "places", "entities")
def _(s, d):
    return serve.class_counts(views.entities(s, d), views.places(s, d))


# joins


@query("ref_21_entity_events", "select entity_id, f.event_id, role, event_type, starts_at from event_entities join facts f using (event_id)", "facts", "event_entities")
def _(s, d):
    return views.event_entities(s, d).join(views.facts(s, d), "event_id").select("entity_id", "event_id", "role", "event_type", "starts_at")


@query("ref_22_entity_places", "select e.entity_id, p.canonical_name as place_name from entities e join places p on primary_place_id = place_id", "entities", "places")
def _(s, d):
    e, p = views.entities(s, d), views.places(s, d)
    return e.join(p, F.col("primary_place_id") == F.col("place_id")).select("entity_id", p["canonical_name"].alias("place_name"))


@query("ref_25_documents_to_parse", "select event_id as raw_id from ev where k % 3 = 0 or (k % 3 = 1 and ts <= timestamp '2024-01-20 00:00:00')", "ev")
def _(s, d):
    e = views._events(s, d)
    led = e.where("k % 3 <> 0").select(F.col("event_id").alias("raw_id"), F.lit("p1").alias("parser_id"), F.when(F.col("k") % 3 == 1, "retry").otherwise("success").alias("status"), F.col("ts").alias("next_retry_at"))
    return promote.documents_to_parse(e.select(F.col("event_id").alias("raw_id")), led, "p1", NOW)


_IN = "latitude between min_lat and max_lat and longitude between min_lon and max_lon"


@query("ref_27_point_in_place", f"select point_id, place_id, admin_level from (select point_id, place_id, admin_level, row_number() over (partition by point_id order by admin_level desc, round((max_lat - min_lat) * (max_lon - min_lon), 9), place_id) as rn from points join places on {_IN}) where rn = 1", "points", "places")
def _(s, d):
    return places.point_in_place(views.points(s, d), views.places(s, d))


@query("ref_28_match_name", "select o_orderkey as hint_id, 'plc:' || (o_orderkey % 25) as place_id, 0 as admin_level, case when o_orderkey % 2 = 0 then 0.6::double else 0.45::double end as confidence from orders")
def _(s, d):
    p = views.places(s, d).where("place_type = 'country'").select("place_id", "canonical_name", F.array(F.concat(F.lit("Land "), "canonical_name")).alias("alternate_names"), "admin_level", F.col("place_id").alias("admin0_place_id"))
    h = read_table(s, d, "orders").select(F.col("o_orderkey").alias("hint_id"), F.concat(F.when(F.col("o_orderkey") % 3 == 0, "land  ").otherwise(""), F.lit("Nation_"), F.col("o_orderkey") % 25).alias("name"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("plc:"), F.col("o_orderkey") % 25)).otherwise("").alias("admin0_place_id"))
    return places.match_name(h, p)


_LOW = "(on_ground or coalesce(altitude_m, 99999) <= 1500)"
_NEAR = f"""near as (select point_id, site_id, site_place_id, distance_km from (select p.point_id, a.airport_id as site_id, a.place_id as site_place_id, {hav("p.latitude", "p.longitude", "a.latitude", "a.longitude")} as distance_km,
    row_number() over (partition by p.point_id order by {hav("p.latitude", "p.longitude", "a.latitude", "a.longitude")}, a.airport_id) as rn from points p join airports a on abs(p.latitude - a.latitude) < 0.3 where {_LOW}) where rn = 1 and distance_km <= 25)"""


@query("ref_29_nearest_within", f"select point_id, site_id, {r4('distance_km')} as distance_km from (with {_NEAR} select * from near)", "points", "airports")
def _(s, d):
    return tracks.nearest_within(views.points(s, d), views.airports(s, d)).select("point_id", "site_id", cols.round4("distance_km").alias("distance_km"))


@query("ref_30_min_distance", f"select a.entity_id, b.entity_id as peer_id, {r4('min(' + hav('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude') + ')')} as distance_km from points a join points b on a.entity_id <> b.entity_id and abs(epoch_ms(a.observed_at) - epoch_ms(b.observed_at)) <= 300000 and b.category = 7 group by all", "points")
def _(s, d):
    p = views.points(s, d)
    return tracks.min_distance(p, p.where("category = 7")).withColumn("distance_km", cols.round4("distance_km"))


@query("ref_31_asof_match", "select call_id, max(ends_at) as gap_end from stays s left join gaps g on g.entity_id = s.entity_id and g.ends_at < s.started_at group by call_id", "stays", "gaps")
def _(s, d):
    n = sum(read_table(s, d, x).count() for x in ("lineitem", "orders"))
    tasks = max(1, -(-n // tracks.ASOF_ROWS))
    st, g = views.stays(s, d, tasks), views.gaps(s, d, tasks).select("entity_id", F.timestamp_millis(F.unix_millis("ends_at") + 1).alias("t"), F.col("ends_at").alias("gap_end"))
    out = tracks.asof_match(st.select("call_id", "entity_id", "started_at"), g, "entity_id", "started_at", "t", keep=["gap_end"], rows=n)
    # dealt out before they are summed up: calls hardly repeat within a task, whose sort and table of calls would add up
    return out.select("call_id", "gap_end").repartition(tasks, "call_id").groupBy("call_id").agg(F.max("gap_end").alias("gap_end"))


@query("ref_32_route_sources", "select p_partkey, case when p_size % 2 = 0 then 'track' when p_size % 3 = 0 then 'event' else 'generic' end as shape, case when p_size % 2 = 0 then 'silver.track' when p_size % 3 = 0 then 'silver.event' else 'bronze' end as target from part")
def _(s, d):
    p = read_table(s, d, "part").select("p_partkey", F.filter(F.array(F.when(F.col("p_size") % 2 == 0, "ais"), F.when(F.col("p_size") % 3 == 0, "news")), lambda x: x.isNotNull()).alias("tags"))
    return quality.route_sources(p, [("track", ["ais", "adsb"], "silver.track"), ("event", ["news"], "silver.event")]).drop("tags")


# metrics


def _contributions(s, d, *only):
    return metrics.emit_contributions(views.records(s, d), only or None)


_DAY = "date_trunc('day', occurred_at)"
_WIN = {
    "day": (_DAY, f"{_DAY} + interval 24 hours"),
    "24h": ("date_trunc('hour', occurred_at) - interval 23 hours", "date_trunc('hour', occurred_at) + interval 1 hour"),
    "7d": (f"{_DAY} - interval 144 hours", f"{_DAY} + interval 24 hours"),
    "30d": (f"{_DAY} - interval 696 hours", f"{_DAY} + interval 24 hours"),
}
_VALUES = [
    ("obs_count", "record_type = 'observation'", "1", "1"), ("event_count", "record_type = 'event'", "1", "1"), ("confidence_weighted_activity", "true", "conf", "1"), ("source_diversity_score", "true", "1", "1"),
    ("trend_24h", "true", "1", "1"), ("trend_7d", "true", "1", "1"), ("acceleration_7d_vs_30d", "true", "acceleration_7d_vs_30d", "1"), ("geolocation_success_rate", "true", "geolocation_succeeded::int", "1"),
    ("evidence_density", "true", "evidence_count", "1"), ("dedup_rate", "true", "deduplicated::int", "1"), ("schema_drift_rate", "true", "schema_drift_detected::int", "1"), ("cross_source_confirmation_rate", "true", "(confirming_source_count > 1)::int", "1"),
    ("freshness_lag_minutes", "published_at is not null", "greatest(0::double, (epoch_ms(occurred_at) - epoch_ms(published_at)) / 60000.0::double)", "1"), ("burst_score", "true", "case when burst_score <= 0 then w else burst_score end * w", "w"),
    ("risk_composite_global", "true", "greatest(risk_score, 0::double) * w", "w"), ("anomaly_zscore_30d", "true", "anomaly_zscore_30d", "1"),
]
_GRAIN = {m: g for m, _, _, g in metrics.REGISTRY}
_SCOPED = """scoped as (select r.*, least(greatest(confidence, 0), 1) as conf, case when least(greatest(confidence, 0), 1) = 0 then 1::double else least(greatest(confidence, 0), 1) end as w, s.grain as subject_grain, s.id as subject_id
    from records r, lateral (select unnest(['place', 'admin0', 'continent', 'world']) as grain, unnest([place_id, admin0_place_id, continent_place_id, 'plc:world']) as id) s where s.id <> '')"""
_ONCE = "select '{m}' as metric_id, 'day' as window_grain, ws as window_start, ws + interval 24 hours as window_end, 1::double as contribution_value, 1::double as contribution_weight, record_id, source_id, subject_grain, subject_id from (select *, date_trunc('day', occurred_at) as ws, row_number() over (partition by subject_grain, subject_id, date_trunc('day', occurred_at), {k} order by occurred_at, record_id) as rn from scoped) where rn = 1"
_CONTRIB = _SCOPED + ", contrib as (" + " union all ".join(
    f"select '{m}' as metric_id, '{_GRAIN[m]}' as window_grain, {_WIN[_GRAIN[m]][0]} as window_start, {_WIN[_GRAIN[m]][1]} as window_end, {r4('(' + v + ')::double')} as contribution_value, {r4('(' + w + ')::double')} as contribution_weight, record_id, source_id, subject_grain, subject_id from scoped where {p}"
    for m, p, v, w in _VALUES
) + " union all " + _ONCE.format(m="entity_count_approx", k="entity_id") + " union all " + _ONCE.format(m="source_count_approx", k="source_id") + ")"
_REG = "registry(metric_id, metric_family, rollup_rule, window_grain) as (values " + ", ".join(str(x) for x in metrics.REGISTRY) + ")"
_STATE = "state as (select metric_id, subject_grain, subject_id, window_grain, window_start, max(window_end) as window_end, count(*) as n, sum(contribution_value) as value_sum, sum(contribution_weight) as weight_sum, max(contribution_value) as peak_value, count(distinct source_id) as sources from contrib group by all)"
_FINAL = f"final as (select s.*, metric_family, rollup_rule, {r4("case rollup_rule when 'weighted_avg' then case when weight_sum = 0 then 0 else value_sum / weight_sum end when 'distinct_sources_per_contribution' then sources / n::double else value_sum end")} as metric_value from state s join registry using (metric_id))"
_SNAP = f"snap as (select *, {r4('metric_value - coalesce(lag(metric_value) over (partition by metric_id, subject_grain, subject_id, window_grain order by window_start), 0)')} as metric_delta, row_number() over (partition by metric_id, subject_grain, window_grain, window_start order by metric_value desc, subject_id) as rank from final)"
_CHAIN = f"{_CONTRIB}, {_REG}, {_STATE}, {_FINAL}, {_SNAP}"


def _chain(sql: str) -> str:
    return f"select * from (with {_CHAIN} {sql})"


@query("ref_34_emit_contributions", _chain("select metric_id, window_grain, window_start, window_end, contribution_value, contribution_weight, record_id, source_id, subject_grain, subject_id from contrib"), "records")
def _(s, d):
    return _contributions(s, d).select("metric_id", "window_grain", "window_start", "window_end", "contribution_value", "contribution_weight", "record_id", "source_id", "subject_grain", "subject_id")


@query("ref_36_distinct_once", _chain("select metric_id, subject_grain, subject_id, record_id, window_start from contrib where metric_id in ('entity_count_approx', 'source_count_approx')"), "records")
def _(s, d):
    return _contributions(s, d, "entity_count_approx", "source_count_approx").select("metric_id", "subject_grain", "subject_id", "record_id", "window_start")


@query("ref_37_windows", f"select record_id, {', '.join(f'{a} as s_{k}, {b} as e_{k}' for k, (a, b) in _WIN.items())} from records", "records")
def _(s, d):
    w = {g: metrics.window_of("occurred_at", g) for g in ("day", "24h", "7d", "30d")}
    return views.records(s, d).select("record_id", *[x for g, (a, b) in w.items() for x in (a.alias(f"s_{g}"), b.alias(f"e_{g}"))])


@query("ref_38_metric_state", _chain(f"select metric_id, subject_grain, subject_id, window_start, n, {r4('value_sum')} as value_sum, {r4('weight_sum')} as weight_sum, peak_value, sources from state"), "records")
def _(s, d):
    """Built from halves and merged, which must equal one pass."""
    st = metrics.merge_state(metrics.partial_states(views.records(s, d), lambda r: F.pmod(F.xxhash64(r), F.lit(2))))
    return st.select("metric_id", "subject_grain", "subject_id", "window_start", "n", cols.round4("value_sum").alias("value_sum"), cols.round4("weight_sum").alias("weight_sum"), "peak_value", F.size("sources").cast("long").alias("sources"))


def _snapshots(s, d, rank=True):
    return metrics.build_snapshots(metrics.state_of_records(views.records(s, d)), metrics.registry(s), NOW, rank)


@query("ref_40_snapshots", _chain("select metric_id, subject_grain, subject_id, window_grain, window_start, metric_value, metric_delta, rank from snap"), "records")
def snapshots(s, d):
    return _snapshots(s, d).select("metric_id", "subject_grain", "subject_id", "window_grain", "window_start", "metric_value", "metric_delta", "rank")


_SURF = "surf as (select *, greatest(metric_delta, 0) as rise from snap where metric_value > 0 or metric_delta > 0)"
_HOT = f"""hot as (select metric_id, metric_family, subject_grain as scope_type, subject_id as scope_id, window_grain, window_start, rk as rank, population_size,
    {r4("case when most <= 0 then 0 else least(metric_value / most, 1) end * 60 + case when rise_most <= 0 then 0 else least(rise / rise_most, 1) end * 25 + case when population_size <= 1 then 15 else (1 - (rk - 1) / (population_size - 1)::double) * 15 end")} as hotspot_score
    from (select *, row_number() over (w order by metric_value desc, subject_id) as rk, max(metric_value) over w as most, max(rise) over w as rise_most, count(*) over w as population_size from surf window w as (partition by metric_id, subject_grain, window_grain, window_start)))"""


@query("ref_50_hotspots", f"select * from (with {_CHAIN}, {_SURF}, {_HOT} select * from hot)", "records")
def hotspots(s, d):
    return metrics.hotspots(metrics.latest_surface(_snapshots(s, d, rank=False)), metrics.registry(s)).drop("hotspot_id", "place_id")


@query(
    "ref_51_cross_domain",
    f"""select * from (with {_CHAIN}, {_SURF}, comp as (select *, {r4("(case when m <= 0 then 0 else least(metric_value / m, 1) end * 0.7::double + case when rm <= 0 then 0 else least(rise / rm, 1) end * 0.3::double) * 100")} as component from (select *, max(metric_value) over w as m, max(rise) over w as rm from surf window w as (partition by metric_id, window_grain, window_start)))
    select subject_grain, subject_id, window_grain, window_start, list_sort(list(distinct metric_family)) as domains, {r4("round(sum(cast(round(component * 10000) as bigint)) / count(*)::double) / 10000" + " + least((count(distinct metric_family) - 1) * 5.0::double, 10)")} as composite_score from comp group by subject_grain, subject_id, window_grain, window_start)""",
    "records",
)
def _(s, d):
    return metrics.cross_domain(metrics.latest_surface(_snapshots(s, d, rank=False)), metrics.registry(s)).drop("cross_domain_id", "metric_ids")


@query("ref_23_with_family", _chain("select subject_id, metric_id, window_start, metric_family from final where subject_grain = 'world'"), "records")
def _(s, d):
    c = metrics.partial_states(views.records(s, d)).where("subject_grain = 'world'")
    return metrics.with_family(c, metrics.registry(s)).select("subject_id", "metric_id", "window_start", "metric_family")


@query("ref_61_rollup_places", f"select * from (with {_CHAIN}, cl as (select place_id as d, place_id as a from places union all select place_id, parent_place_id from places where parent_place_id <> '' union all select p.place_id, q.parent_place_id from places p join places q on p.parent_place_id = q.place_id where q.parent_place_id <> '') select metric_id, window_start, a as ancestor_id, {r4('sum(metric_value)')} as metric_value from snap join cl on subject_id = d where subject_grain = 'place' and metric_id = 'obs_count' group by all)", "records", "places")
def _(s, d):
    snap = metrics.build_snapshots(metrics.build_state(_contributions(s, d, "obs_count")), metrics.registry(s), NOW)
    return metrics.rollup_places(snap, places.closure(views.places(s, d))).select("metric_id", "window_start", "ancestor_id", "metric_value")


@query("ref_141_time_series", _chain("select metric_id || '|' || subject_grain || '|' || subject_id || '|' || window_grain as series, window_start, metric_value from snap where metric_id = 'trend_7d'"), "records")
def _(s, d):
    return metrics.time_series(metrics.build_snapshots(metrics.build_state(_contributions(s, d, "trend_7d")), metrics.registry(s), NOW)).select("series", "window_start", "metric_value")


@query("ref_140_backfill_explain", "select p_partkey, p_size % 2 = 0 as had, case when p_size % 2 = 0 then 'own' else cast(p_partkey as varchar) end as summary from part")
def _(s, d):
    attrs = F.when(F.col("p_size") % 2 == 0, '{"explainability":{"summary":"own"}}').when(F.col("p_size") % 3 == 0, "{}").otherwise('{"a":1}')
    p = read_table(s, d, "part").select("p_partkey", (F.col("p_size") % 2 == 0).alias("had"), F.col("p_partkey").cast("string").alias("metric_id"), attrs.alias("attrs"))
    return metrics.backfill_explain(p).select("p_partkey", "had", F.get_json_object("attrs", "$.explainability.summary").alias("summary"))


@query("ref_43_count_flags", "select count(*) filter (event_type = 'error') as errors, count(*) filter (value > 50) as large, count(*) as total from events")
def _(s, d):
    return quality.count_flags(read_table(s, d, "events"), {"errors": F.col("event_type") == "error", "large": F.col("value") > 50, "total": F.lit(True)})


@query("ref_44_distinct_count", "select event_type, count(distinct user_id) as n_distinct from events group by 1")
def _(s, d):
    return quality.distinct_count(read_table(s, d, "events"), ["event_type"], "user_id")


@query("ref_46_saturating_score", f"select user_id, {r4('least(100, sum(greatest(value, 0)))')} as score, list_sort(list(distinct event_type)) as sources from events group by 1")
def _(s, d):
    return metrics.saturating_score(read_table(s, d, "events"), ["user_id"], "value", "event_id", "event_type").drop("event_ids")


@query("ref_46b_lag_summary", "select cast(floor(quantile_cont(k, 0.5)) as bigint) as median, max(k) as maximum, count(*) filter (k > 60) as over_threshold from ev", "ev")
def _(s, d):
    return quality.lag_summary(views._events(s, d), "k", 60)


@query("ref_46c_top_failures", "select 'f' || (k % 10) as failure, count(*) as n, min('src:' || user_id) as example_source from ev where event_type = 'error' group by 1 order by n desc, failure limit 5", "ev")
def _(s, d):
    log = views._events(s, d).select(F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"), F.concat(F.lit("f"), F.col("k") % 10).alias("failure"), F.concat(F.lit("src:"), "user_id").alias("source_id"))
    return quality.top_failures(log)


# tracks

_T = "with p as (select *, lag(observed_at) over w as b_at, lag(on_ground) over w as b_ground, lag(point_id) over w as b_id, lag(altitude_m) over w as b_alt, (epoch_ms(observed_at) - epoch_ms(lag(observed_at) over w)) / 1000.0::double as dt from points window w as (partition by track_id order by observed_at, point_id))"


@query("ref_52_gap_events", f"{_T} select track_id, point_id, b_at as started_at, observed_at as ended_at, {r4('dt / 3600')} as gap_hours, (not on_ground and coalesce(altitude_m, 0) > 0) or (not b_ground and coalesce(b_alt, 0) > 0) as in_flight from p where dt > 1200".replace("with p as", "select * from (with p as") + ")", "points")
def _(s, d):
    return tracks.gap_events(views.points(s, d)).select("track_id", "point_id", "started_at", "ended_at", "gap_hours", "in_flight")


_SEG = _T.replace("with p as", "p as") + ", sp as (select *, cast(sum(case when dt > 7200 or (on_ground and b_ground and dt > 10800) then 1 else 0 end) over (partition by track_id order by observed_at, point_id rows unbounded preceding) + 1 as bigint) as segment_no from p)"


@query("ref_53_segment_tracks", f"select * from (with {_SEG} select point_id, track_id, segment_no from sp)", "points")
def _(s, d):
    return tracks.segment_tracks(views.points(s, d), 120, 180).select("point_id", "track_id", "segment_no")


_SEG20 = _SEG.replace("7200", "1200").replace("10800", "2700")
_BEAR = "((degrees(atan2(sin(radians(lo2 - lo1)) * cos(radians(la2)), cos(radians(la1)) * sin(radians(la2)) - sin(radians(la1)) * cos(radians(la2)) * cos(radians(lo2 - lo1)))) + 360) % 360)"
_GEO = f"""{_SEG20}, st as (select *, lag(latitude) over w as la1, lag(longitude) over w as lo1, latitude as la2, longitude as lo2, lead(dt) over (partition by track_id order by observed_at, point_id) > 1200 as gap_after from sp window w as (partition by track_id, segment_no order by observed_at, point_id)),
    hd as (select *, {hav("la1", "lo1", "la2", "lo2")} as step, case when la1 is not null then {_BEAR} end as head from st), tn as (select *, abs(head - lag(head) over (partition by track_id, segment_no order by observed_at, point_id)) as hd0 from hd),
    seg as (select track_id, entity_id, segment_no, count(*) as point_count, min(observed_at) as started_at, max(observed_at) as ended_at, sum(step) as km, count(*) filter ((case when hd0 > 180 then 360 - hd0 else hd0 end) > 45) as turn_count, max(coalesce(gap_after, false)::int) as gap_count,
    arg_min(latitude, (observed_at, point_id)) as fla, arg_min(longitude, (observed_at, point_id)) as flo, arg_max(latitude, (observed_at, point_id)) as tla, arg_max(longitude, (observed_at, point_id)) as tlo, arg_min(point_id, (observed_at, point_id)) as first_id, arg_max(point_id, (observed_at, point_id)) as last_id
    from tn group by track_id, entity_id, segment_no having count(*) >= 2),
    sg as (select *, {hav("fla", "flo", "tla", "tlo")} as direct_km, case when {hav("fla", "flo", "tla", "tlo")} >= 1 then km / {hav("fla", "flo", "tla", "tlo")} else 1 end as detour, (epoch_ms(ended_at) - epoch_ms(started_at)) / 3600000.0::double as h from seg),
    segments as (select track_id, entity_id, segment_no, started_at, ended_at, point_count, {r4("km")} as distance_km, {r4("case when h > 0 then km / h else 0 end")} as avg_speed_kph, {r4("detour")} as detour_ratio, turn_count, gap_count,
    {r4("least(1, greatest(0, 0.7::double * least(1, greatest(0, (detour - 1) / 0.8::double)) + 0.3::double * case when point_count > 2 then turn_count / (point_count - 2)::double else 0 end + least(0.3::double, gap_count * 0.15::double)))")} as route_irregularity, first_id, last_id from sg)"""
_GAPQ = f"gp as (select track_id, entity_id, point_id, {r4('dt / 3600')} as gap_hours, (not on_ground and coalesce(altitude_m, 0) > 0) or (not b_ground and coalesce(b_alt, 0) > 0) as in_flight from p where dt > 1200)"


@query("ref_54_segment_geometry", f"select * from (with {_GEO} select track_id, segment_no, point_count, distance_km, avg_speed_kph, detour_ratio, turn_count, gap_count, route_irregularity from segments)", "points")
def _(s, d):
    return tracks.segment_geometry(views.points(s, d)).select("track_id", "segment_no", "point_count", "distance_km", "avg_speed_kph", "detour_ratio", "turn_count", "gap_count", "route_irregularity")


_AIR = f"{_GEO}, {_GAPQ}, {_NEAR}, sa as (select s.*, coalesce(a.site_id, '') as from_airport_id, coalesce(b.site_id, '') as to_airport_id from segments s left join near a on a.point_id = first_id left join near b on b.point_id = last_id)"


def _air(s, d):
    p, a = views.points(s, d), views.airports(s, d)
    return p, a, tracks.segment_geometry(p, a), tracks.gap_events(p)


@query("ref_86_airport_events", f"select * from (with {_AIR} select track_id, segment_no, 'departure' as kind, from_airport_id as airport_id, started_at as at from sa where from_airport_id <> '' union all select track_id, segment_no, 'arrival', to_airport_id, ended_at from sa where to_airport_id <> '')", "points", "airports")
def _(s, d):
    return tracks.airport_events(_air(s, d)[2]).select("track_id", "segment_no", "kind", "airport_id", "at")


@query("ref_87_route_irregularity", f"select * from (with {_GEO}, {_GAPQ}, b as (select entity_id, sum(route_irregularity * greatest(point_count - 1, 1)) / sum(greatest(point_count - 1, 1)) as base from segments group by 1), g as (select entity_id, sum(gap_hours) as h, count(*) as n from gp group by 1) select entity_id, {r4('least(1, base + least(0.35::double, coalesce(h, 0) / 2.5::double + coalesce(n, 0) * 0.1::double))')} as metric_value from b left join g using (entity_id))", "points")
def _(s, d):
    p = views.points(s, d)
    return tracks.route_irregularity(tracks.segment_geometry(p), tracks.gap_events(p))


@query("ref_89_transponder_gap_hours", f"select * from (with {_T.removeprefix('with ')}, {_GAPQ} select entity_id, {r4('sum(gap_hours)')} as metric_value, count(*) as gap_events, count(*) filter (in_flight) as in_flight_gaps, {r4('max(gap_hours)')} as longest_gap_hours from gp group by 1)", "points")
def _(s, d):
    return tracks.transponder_gap_hours(tracks.gap_events(views.points(s, d)))


@query("ref_90_altitude_variance", f"select entity_id, {r4('least(1, coalesce(stddev_pop(altitude_m), 0) / 3000)')} as metric_value, count(altitude_m) as altitude_samples from points group by 1", "points")
def _(s, d):
    return tracks.altitude_variance(views.points(s, d))


@query("ref_91_change_rate", f"select * from (with x as (select *, lag(squawk) over (partition by track_id order by observed_at, point_id) as b from points where squawk <> ''), h as (select entity_id, (epoch_ms(max(observed_at)) - epoch_ms(min(observed_at))) / 3600000.0::double as h from points group by 1) select entity_id, count(*) filter (squawk <> b) as changes, {r4('case when any_value(h) > 0 then count(*) filter (squawk <> b) / greatest(any_value(h), 1) else 0 end')} as metric_value from h left join x using (entity_id) group by 1)", "points")
def _(s, d):
    return tracks.change_rate(views.points(s, d))


@query("ref_92_hold_pattern", f"select * from (with {_AIR} select entity_id, {r4('count(*) filter (turn_count >= 2 and detour_ratio >= 1.1::double and to_airport_id <> chr(39) || chr(39)) / count(*)').replace('chr(39) || chr(39)', chr(39) * 2)} as metric_value, count(*) as total_segments from sa group by 1)", "points", "airports")
def _(s, d):
    return tracks.hold_pattern_frequency(_air(s, d)[2]).drop("holding_segments")


@query(
    "ref_93_diversions",
    f"""select * from (with {_AIR}, o as (select *, nullif(to_airport_id, '') as t, row_number() over (partition by entity_id, nullif(to_airport_id, '') order by started_at, track_id, segment_no) = 1 as first from sa),
    v as (select *, count(t) over (partition by entity_id order by started_at, track_id, segment_no rows between unbounded preceding and 1 preceding) as earlier, lag(t) over (partition by entity_id order by started_at, track_id, segment_no) as lt from o),
    g as (select entity_id, count(*) filter (in_flight) as fly from gp group by 1),
    n as (select entity_id, count(*) filter ((t is not null and first and earlier > 0) or t <> lt or (gap_count > 0 and from_airport_id <> '' and t is not null and from_airport_id <> t)) as n, count(*) as total_segments from v group by 1)
    select entity_id, case when n = 0 and coalesce(fly, 0) > 0 and total_segments > 1 then 1 else n end as diverted_segments, total_segments, {r4("case when n = 0 and coalesce(fly, 0) > 0 and total_segments > 1 then 1 else n end / total_segments::double")} as metric_value from n left join g using (entity_id))""",
    "points", "airports",
)
def _(s, d):
    p, a, seg, gap = _air(s, d)
    return tracks.diversions(seg, gap)


def _number(x):
    return F.substring(x, 5, 20).cast("long")


def _registry_of(s, d):
    return views.points(s, d).select("entity_id").distinct().select("entity_id", F.when(_number("entity_id") % 4 == 0, "Royal Air Force").when(_number("entity_id") % 4 == 1, "Blue Airlines Inc").otherwise("").alias("registrant_name"), F.when(_number("entity_id") % 8 == 2, "Government").otherwise("").alias("registrant_type"))


_MIL = f"""lk as (select entity_id, callsign, coalesce(visits, 0) as visits, strong, case when civil then case when strong then raw - 0.25 else least(raw - 0.25, 0.45) end else raw end as score from (
        select q.*, visits, u % 4 = 0 or u % 8 = 2 as strong, u % 4 = 1 as civil, case when u % 4 = 0 or u % 8 = 2 then 0.65::double else 0 end + case when callsign like 'RCH%' then 0.2::double else 0 end + least(coalesce(visits, 0) * 0.1::double, 0.2::double) + case when fast then 0.05::double else 0 end as raw
        from (select entity_id, cast(substr(entity_id, 5) as bigint) as u, coalesce(arg_max(callsign, (observed_at, callsign)) filter (callsign <> ''), '') as callsign, max(category in (7, 8)) as fast from points group by 1) q
        left join (select entity_id, count(*) as visits from (select entity_id, from_airport_id as x from sa union all select entity_id, to_airport_id from sa) join airports on airport_id = x where use in ('military', 'joint_use') group by 1) using (entity_id))),
    ml as (select entity_id, callsign, visits, strong, {r4("least(1, greatest(0, score))")} as metric_value from lk),
    mi as (select entity_id, callsign, visits, metric_value, case when strong and metric_value >= 0.85 then 'likely_military' when strong and metric_value >= 0.55 then 'possible_military' else 'unknown' end as status from ml)"""


@query("ref_88_military_likelihood", f"select * from (with {_AIR}, {_MIL} select * from mi)", "points", "airports")
def _(s, d):
    p, a, seg, _g = _air(s, d)
    return tracks.military_likelihood(p, _registry_of(s, d), seg, a)


@query("ref_94_proximity", f"select * from (with pr as (select a.entity_id, b.entity_id as peer_id, min({hav('a.latitude', 'a.longitude', 'b.latitude', 'b.longitude')}) as dk from points a join points b on a.entity_id <> b.entity_id and abs(epoch_ms(a.observed_at) - epoch_ms(b.observed_at)) <= 300000 and b.entity_id in (select entity_id from points where category in (7, 8)) group by 1, 2) select entity_id, coalesce({r4('min(dk)')}, 0) as minimum_distance_km, coalesce({r4('least(1, greatest(0, 1 - min(dk) / 50))')}, 0) as metric_value from (select distinct entity_id from points) left join pr using (entity_id) group by 1)", "points")
def _(s, d):
    p = views.points(s, d)
    return tracks.proximity(p, p.where("category in (7, 8)")).drop("closest_peer_id")


@query(
    "ref_95_aircraft_entities",
    f"""select * from (with {_AIR}, {_MIL}, mm as (select entity_id, 'altitude_variance_score' as metric_id, {r4("least(1, greatest(0, coalesce(stddev_pop(altitude_m), 0) / 3000))")} as metric_value from points group by 1
        union all select entity_id, 'transponder_gap_hours', {r4("sum(gap_hours)")} from gp group by 1)
    select entity_id, metric_id, mm.metric_value, row_number() over (partition by metric_id order by mm.metric_value desc, entity_id) as rank, case when mi.metric_value >= 0.8 then 'high' when mi.metric_value >= 0.45 then 'medium' else 'low' end as risk_band, status from mm join mi using (entity_id))""",
    "points", "airports",
)
def _(s, d):
    p, a, seg, gap = _air(s, d)
    m = tracks.altitude_variance(p).select("entity_id", F.lit("altitude_variance_score").alias("metric_id"), "metric_value").union(tracks.transponder_gap_hours(gap).select("entity_id", F.lit("transponder_gap_hours"), "metric_value"))
    return tracks.aircraft_entities(tracks.military_likelihood(p, _registry_of(s, d), seg, a), m)


@query("ref_59_last_non_blank", "select entity_id, coalesce(arg_max(callsign, (observed_at, callsign)) filter (callsign <> ''), '') as callsign from points group by 1", "points")
def _(s, d):
    return tracks.last_non_blank(views.points(s, d), ["entity_id"], "observed_at", ["callsign"])


@query("ref_56_islands", f"select * from (with x as (select *, row_number() over (partition by track_id order by observed_at, point_id) as a from points), y as (select *, a - row_number() over (partition by track_id order by observed_at, point_id) as g from x where on_ground) select track_id, min(observed_at) as starts_at, max(observed_at) as ends_at, count(*) as samples, {r4('(epoch_ms(max(observed_at)) - epoch_ms(min(observed_at))) / 1000.0::double + 60')} as duration_s from y group by track_id, g)", "points")
def _(s, d):
    return tracks.islands(views.points(s, d), ["track_id"], "on_ground", "observed_at").withColumn("duration_s", cols.round4("duration_s"))


def _windows(s, d):
    w = tracks.islands(views.points(s, d).withColumn("place_id", F.concat(F.lit("plc:"), _number("track_id") % 20)).withColumn("satellite_id", F.col("track_id")), ["place_id", "satellite_id"], "on_ground", "observed_at")
    return w


_WQ = """ws as (select *, row_number() over (partition by track_id order by observed_at, point_id) as a from points), wy as (select *, a - row_number() over (partition by track_id order by observed_at, point_id) as g from ws where on_ground),
    wins as (select track_id, min(observed_at) as starts_at, max(observed_at) as ends_at from wy group by track_id, g)"""


def gaps_sql(k: str, wins: str) -> str:
    """Gaps of January 2024 by key k of the windows, as common table expressions gz, gh and gaps."""
    return f"""gz as (select *, coalesce(max(ends_at) over (partition by {k} order by starts_at, ends_at rows between unbounded preceding and 1 preceding), timestamp '2024-01-01') as p, lead(starts_at) over (partition by {k} order by starts_at, ends_at) is null as l, max(ends_at) over (partition by {k}) as m
        from (select {k}, greatest(starts_at, timestamp '2024-01-01') as starts_at, least(ends_at, timestamp '2024-01-31') as ends_at from {wins}) where starts_at <= ends_at),
    gh as (select {k}, (epoch_ms(starts_at) - epoch_ms(p)) / 3600000.0::double as h from gz union all select {k}, (epoch_ms(timestamp '2024-01-31') - epoch_ms(m)) / 3600000.0::double from gz where l),
    gaps as (select {k}, coalesce({r4("max(greatest(h, 0))")}, 720) as largest_gap_hours, coalesce({r4("avg(greatest(h, 0))")}, 720) as mean_gap_hours, greatest(count(h), 1) as gaps from (select distinct {k} from {wins}) left join gh using ({k}) group by 1)"""


PLACE_WINDOWS = f"""{_WQ}, pw as (select 'plc:' || (cast(substr(track_id, 5) as bigint) % 20) as place_id, track_id as satellite_id, starts_at, ends_at from wins)"""


@query("ref_57_coverage_gaps", f"select * from (with {_WQ}, {gaps_sql('track_id', 'wins')} select * from gaps)", "points")
def _(s, d):
    w = tracks.islands(views.points(s, d), ["track_id"], "on_ground", "observed_at")
    return tracks.coverage_gaps(w, ["track_id"], "2024-01-01", "2024-01-31")


@query("ref_106_place_intersections", f"select point_id, a.place_id, {r4(hav('p.latitude', 'p.longitude', 'a.latitude', 'a.longitude', 6378.137))} as distance_km from points p, airports a where {hav('p.latitude', 'p.longitude', 'a.latitude', 'a.longitude', 6378.137)} <= 400", "points", "airports")
def _(s, d):
    return tracks.place_intersections(views.points(s, d), views.airports(s, d).withColumn("radius_km", F.lit(400.0)))


@query("ref_146_join_registry", "select entity_id, case when user_id % 2 = 0 then 'owner2' end as owner from (select distinct 'ent:' || user_id as entity_id, user_id from events)")
def _(s, d):
    u = read_table(s, d, "events").select("user_id").distinct()
    reg = u.where("user_id % 2 = 0").select(F.concat(F.lit(" H"), "user_id").alias(" HEX "), F.lit("owner1").alias("Owner"), F.lit(1).alias("Row No")).union(u.where("user_id % 2 = 0").select(F.concat(F.lit("h"), "user_id", F.lit(" ")), F.lit("owner2"), F.lit(2)))
    return tracks.join_registry(u.select(F.concat(F.lit("ent:"), "user_id").alias("entity_id"), F.concat(F.lit("h"), "user_id").alias("hex")), reg).select("entity_id", "owner")


# places


@query("ref_60_closure", "select * from (with recursive c(ancestor_id, descendant_id, depth) as (select place_id, place_id, 0 from places union all select parent_place_id, descendant_id, depth + 1 from c join places on place_id = ancestor_id where parent_place_id <> '') select *, depth = 1 as direct from c)", "places")
def _(s, d):
    return places.closure(views.places(s, d))


@query("ref_61_lineage", "select p.place_id, case p.place_type when 'world' then p.place_id when 'continent' then p.parent_place_id || '>' || p.place_id else 'plc:world>' || p.parent_place_id || '>' || p.place_id end as path, case when p.admin_level = 0 then p.place_id else '' end as admin0_place_id, case p.place_type when 'country' then p.parent_place_id when 'continent' then p.place_id else '' end as continent_place_id, p.admin_level as deepest_level from places p", "places")
def _(s, d):
    return places.lineage(views.places(s, d)).select("place_id", "path", "admin0_place_id", "continent_place_id", "deepest_level")


_DEEP = """deep as (select place_id, parent_place_id, place_type, admin_level, min_lat, min_lon, max_lat, max_lon from places
    union all select 'plc:c:' || c_custkey, 'plc:' || c_nationkey, 'area', 1, (c_custkey % 180 - 90)::double, (c_custkey % 360 - 180)::double, (c_custkey % 180 - 90)::double, (c_custkey % 360 - 180)::double from customer
    union all select 'plc:o:' || o_orderkey, 'plc:c:' || o_custkey, 'site', 3, (o_orderkey % 180 - 90)::double, (o_orderkey % 360 - 180)::double, (o_orderkey % 180 - 90)::double, (o_orderkey % 360 - 180)::double from orders)"""
_MOVED = "tree as (select * replace (case when c_nationkey is null then parent_place_id else 'plc:' || (c_nationkey + 1) % 25 end as parent_place_id) from deep left join (select 'plc:c:' || c_custkey as place_id, c_nationkey from customer where c_acctbal < 0) using (place_id))"


def _up(tree: str) -> str:
    """The SQL of all (a, p) of an ancestor a of p, itself included, in k steps."""
    return f"up as (select place_id as a, place_id as p, 0 as k from {tree} union all select parent_place_id, p, k + 1 from up join {tree} on a = place_id where parent_place_id <> '')"


def _deep(s, d):
    """The places with each customer as an area of its nation and each order as a site of its customer: a tree that grows with the tables."""
    c, o = read_table(s, d, "customer"), read_table(s, d, "orders")

    def leaves(df, key, to, kind, level):
        at = lambda m: (F.col(key) % m - m // 2).cast("double")
        return df.select(F.concat(F.lit(f"plc:{key[0]}:"), key).alias("place_id"), to.alias("parent_place_id"), F.lit(kind).alias("place_type"), F.lit(level).alias("admin_level"), at(180).alias("min_lat"), at(360).alias("min_lon"), at(180).alias("max_lat"), at(360).alias("max_lon"))

    areas = leaves(c, "c_custkey", F.concat(F.lit("plc:"), "c_nationkey"), "area", 1)
    return views.places(s, d).drop("canonical_name").unionByName(areas).unionByName(leaves(o, "o_orderkey", F.concat(F.lit("plc:c:"), "o_custkey"), "site", 3))


@query("ref_61_tree_lineage", f"select * from (with recursive {_DEEP}, {_up('deep')} select p as place_id, string_agg(a, '>' order by k desc) as path, coalesce(max(a) filter (admin_level = 0), '') as admin0_place_id, coalesce(max(a) filter (admin_level = 1), '') as admin1_place_id, coalesce(max(a) filter (place_type = 'continent'), '') as continent_place_id, max(admin_level) as deepest_level from up join deep on a = place_id group by 1)", "places")
def _(s, d):
    return tree.lineage(tree.labels(_deep(s, d))).select("place_id", "path", "admin0_place_id", "admin1_place_id", "continent_place_id", "deepest_level")


@query("ref_62_tree_bounds", f"select * from (with recursive {_DEEP}, {_up('deep')} select a as place_id, min(min_lat) as min_lat, min(min_lon) as min_lon, max(max_lat) as max_lat, max(max_lon) as max_lon, max(admin_level) as deepest_level, count(*) as n_places from up join deep on p = place_id group by 1)", "places")
def _(s, d):
    return tree.bounds(tree.labels(_deep(s, d)))


@query("ref_60_moved_branches", f"select * from (with recursive {_DEEP}, {_MOVED}, {_up('tree')}, way as (select p, string_agg(a, '>' order by k desc) as path from up group by 1), tot as (select a, min(min_lat) as min_lat, max(max_lon) as max_lon, count(*) as n_places from up join tree on p = place_id group by 1) select way.p as place_id, path, min_lat, max_lon, n_places from way join tot on way.p = a)", "places")
def _(s, d):
    """Customers in debt move to the next nation; the tree after that, of which only their branches and ancestors are made anew."""
    moves = read_table(s, d, "customer").where("c_acctbal < 0").selectExpr("concat('plc:c:', c_custkey) as place_id", "concat('plc:', (c_nationkey + 1) % 25) as parent_place_id")
    t = tree.labels(_deep(s, d))
    new = tree.relabel(t, moves)
    after = t.join(new, "place_id", "left_anti").unionByName(new)
    return after.select("place_id", "path", F.col("sub_min_lat").alias("min_lat"), F.col("sub_max_lon").alias("max_lon"), "n_places")


@query("ref_61_tree_rollup", f"select * from (with recursive {_DEEP}, {_up('deep')} select date_trunc('month', o_orderdate)::timestamp as window_start, a as ancestor_id, sum(floor(o_totalprice))::double as metric_value from orders join up on p = 'plc:o:' || o_orderkey group by 1, 2)", "places")
def _(s, d):
    spent = read_table(s, d, "orders").select(F.lit("spent").alias("metric_id"), F.lit("month").alias("window_grain"), F.date_trunc("month", F.col("o_orderdate").cast("timestamp")).alias("window_start"), F.lit("place").alias("subject_grain"), F.concat(F.lit("plc:o:"), "o_orderkey").alias("place_id"), F.floor("o_totalprice").cast("double").alias("metric_value"))
    return tree.rollup(tree.labels(_deep(s, d)), spent).select("window_start", "ancestor_id", "metric_value")


@query("ref_62_bounds", "select p.place_id, min(q.min_lat) as min_lat, max(q.max_lat) as max_lat, max(q.admin_level) as deepest_level, count(*) as n_places from places p join places q on p.place_id = q.place_id or q.parent_place_id = p.place_id or (p.place_id = 'plc:world' and q.place_type = 'country') group by 1", "places")
def _(s, d):
    return places.bounds_and_depth(views.places(s, d)).select("place_id", "min_lat", "max_lat", "deepest_level", "n_places")


@query("ref_150_grid_cells", "select place_id, y || ':' || x as cell from (select place_id, unnest(range(cast(floor(min_lat / 5) as bigint), cast(floor(max_lat / 5) as bigint) + 1)) as y, min_lon, max_lon from places where place_type = 'country'), lateral (select unnest(range(cast(floor(min_lon / 5) as bigint), cast(floor(max_lon / 5) as bigint) + 1)) as x)", "places")
def _(s, d):
    return places.grid_cells(views.places(s, d).where("place_type = 'country'"), 5.0).select("place_id", "cell")


def _ring(x, y, w, h):
    pt = lambda a, b: F.struct(b.alias("lat"), a.alias("lon"))
    return F.array(pt(x, y), pt(x + w, y), pt(x + w, y + h), pt(x, y + h), pt(x, y))


@query("ref_78_centroid", "select event_id, k + 2.0::double as lat, value + 1.0::double as lon from ev", "ev")
def _(s, d):
    e = views._events(s, d)
    r = _ring(F.col("value"), F.col("k").cast("double"), F.lit(2.0), F.lit(4.0))
    return e.select("event_id", places.centroid(r).alias("c")).select("event_id", F.round("c.lat", 6).alias("lat"), F.round("c.lon", 6).alias("lon"))


@query("ref_63_valid_polygons", "select event_id from ev where k % 3 = 0", "ev")
def _(s, d):
    e = views._events(s, d)
    x, y = F.col("value"), F.col("k").cast("double")
    pt = lambda a, b: F.struct(b.alias("lat"), a.alias("lon"))
    bow = F.array(pt(x, y), pt(x + 2, y + 2), pt(x + 2, y), pt(x, y + 2), pt(x, y))
    ring = F.when(F.col("k") % 3 == 0, _ring(x, y, F.lit(2.0), F.lit(2.0))).when(F.col("k") % 3 == 1, bow).otherwise(F.slice(_ring(x, y, F.lit(2.0), F.lit(2.0)), 1, 4))
    return places.valid_polygons(e.select("event_id", ring.alias("ring"))).select("event_id")


def _inputs(s, d):
    p = views.points(s, d)
    m = F.col("point_id") % 6
    return p.select(
        F.col("point_id").alias("subject_id"), F.lit("src").alias("source_id"), F.when(m == 0, F.col("latitude")).alias("latitude"), F.when(m == 0, F.col("longitude")).alias("longitude"), F.lit(None).cast("double").alias("polygon_lat"), F.lit(None).cast("double").alias("polygon_lon"),
        F.when(m == 1, F.col("latitude")).alias("bbox_lat"), F.when(m == 1, F.col("longitude")).alias("bbox_lon"), F.when(m == 2, "plc:3").alias("name_place_id"), F.when(m == 2, 0.6).alias("name_score"), F.when(m >= 2, F.lit(95.0)).alias("reverse_lat"), F.when(m >= 2, F.lit(0.0)).alias("reverse_lon"),
        F.when(m == 3, "plc:4").otherwise("").alias("track_place_id"), F.when(m == 4, "plc:5").otherwise("").alias("home_place_id"), F.lit("").alias("jurisdiction_place_id"),
    )


_ATT = f"""select point_id as subject_id, case m when 0 then 'coordinate' when 1 then 'bbox' when 2 then 'name' when 3 then 'track' when 4 then 'home' else 'none' end as method, case when m <= 1 then place_id when m = 2 then 'plc:3' when m = 3 then 'plc:4' when m = 4 then 'plc:5' else '' end as place_id,
    case m when 0 then 0.99::double when 1 then 0.93::double when 2 then 0.6::double when 3 then 0.74::double when 4 then 0.7::double else 0::double end as confidence, m not in (2, 5) as resolved
    from (select p.point_id, p.point_id % 6 as m, place_id, row_number() over (partition by point_id order by admin_level desc, round((max_lat - min_lat) * (max_lon - min_lon), 9), place_id) as rn from points p join places on {_IN}) where rn = 1"""


@query("ref_77_attribute", _ATT, "points", "places")
def _(s, d):
    return places.attribute(_inputs(s, d), views.places(s, d)).drop("source_id")


@query("ref_79_unresolved", f"select subject_id, case when place_id = '' then 'no_match' else 'low_confidence' end as reason, confidence, case when subject_id % 4 = 0 then 3 else 1 end as attempts from ({_ATT}) where not resolved", "points", "places")
def _(s, d):
    a = places.attribute(_inputs(s, d), views.places(s, d))
    prev = views.points(s, d).where("point_id % 4 = 0").select(F.lit("src").alias("source_id"), F.col("point_id").alias("subject_id"), F.lit("2023-01-01").cast("timestamp").alias("first_failed_at"), F.lit(2).alias("attempts"))
    return places.unresolved(a, NOW, prev).select("subject_id", "reason", "confidence", "attempts")


@query("ref_138_geo_coverage", f"select method, count(*) as subjects, count(*) filter (resolved) as resolved, round(count(*) filter (resolved) * 1000000.0::double / count(*)) / 10000 as coverage_pct from ({_ATT}) group by 1", "points", "places")
def _(s, d):
    return places.coverage(places.attribute(_inputs(s, d), views.places(s, d)), "method")


def _queue(s, d):
    return views._events(s, d).select(F.concat(F.lit("q:"), "event_id").alias("queue_id"), F.when(F.col("k") % 2 == 0, "open").otherwise("closed").alias("state"), F.col("ts").alias("next_retry_at"), (F.col("k") % 12).alias("attempts"), (F.col("k") % 5 * 10).alias("priority"))


@query("ref_75_retry_due", "select 'q:' || event_id as queue_id, epoch_ms(cast(epoch_ms(timestamp '2024-01-20') + least(power(k % 12 + 1, 2) * 5, 360) * 60000 as bigint)) as then_retry_at from ev where k % 2 = 0 and ts <= timestamp '2024-01-20'", "ev")
def _(s, d):
    return places.retry_due(_queue(s, d), NOW).select("queue_id", "then_retry_at")


@query("ref_80_queue_order", "select 'q:' || event_id as queue_id, k % 5 * 10 as priority from ev", "ev")
def _(s, d):
    return places.queue_order(_queue(s, d)).select("queue_id", "priority")


# promotion

_P = f"""b as ({_BRONZE}), fx as (select *, row_number() over (partition by record_kind, source_id, native_id, occurred_at order by parsed_at desc, raw_id desc) as rn from b where record_kind in ('observation', 'event') and place_id <> '')"""


@query("ref_81_promote_facts", f"select * from (with {_P} select raw_id, record_kind, native_id, place_id, 'high' as confidence_band from fx where rn = 1)", "ev")
def _(s, d):
    out = promote.promote(promote.bronze_to_input(_bronze(s, d)), NOW)
    return out["observations"].union(out["events"]).select("raw_id", "record_kind", "native_id", "place_id", "confidence_band")


@query("ref_81_promote_rejects", f"select * from (with {_P} select raw_id from b where record_kind = 'other')", "ev")
def _(s, d):
    return promote.promote(promote.bronze_to_input(_bronze(s, d)), NOW)["rejects"].select("raw_id")


@query("ref_81_promote_unresolved", f"select * from (with {_P} select distinct source_id, native_id, 'no_match' as reason, 90 as priority from b where record_kind in ('observation', 'event') and place_id = '')", "ev")
def _(s, d):
    return promote.promote(promote.bronze_to_input(_bronze(s, d)), NOW)["unresolved"].select("source_id", "native_id", "reason", "priority")


@query("ref_84_merge_entities", f"select * from (with {_P} select 'ent:' || replace(source_id, ':', '_') || ':' || native_id as entity_id, arg_min(name, (raw_id, source_record_index)) as name, coalesce(arg_min(place_id, (raw_id, source_record_index)) filter (place_id <> ''), '') as place_id, min(occurred_at) as valid_from, count(*) as inputs from b where record_kind = 'entity' group by 1)", "ev")
def _(s, d):
    return promote.promote(promote.bronze_to_input(_bronze(s, d)), NOW)["entities"].select("entity_id", "name", "place_id", "valid_from", "inputs")


@query("ref_83_stable_id", "select o_orderkey, sha256('order' || chr(0) || o_orderkey || chr(0) || o_orderstatus || chr(0)) as record_id from orders")
def _(s, d):
    return read_table(s, d, "orders").select("o_orderkey", cols.stable_id(F.lit(" order"), "o_orderkey", "o_orderstatus").alias("record_id"))


@query("ref_85_bands", "select event_id, case when value / 100 >= 0.9 then 'high' when value / 100 >= 0.75 then 'medium' else 'low' end as band from events")
def _(s, d):
    return read_table(s, d, "events").select("event_id", cols.band(F.col("value") / 100, promote.CONFIDENCE_BANDS, "low").alias("band"))


@query("ref_148_envelope", "select 'doc:' || s_suppkey as source_id, case when s_suppkey % 2 = 0 then 'evt:doc_' || s_suppkey || ':n' || s_suppkey else 'evt:doc_' || s_suppkey || ':sha256-' || sha256(body) end as id, case when s_suppkey % 2 = 0 then 'native_id' else 'content_hash' end as id_strategy, sha256(body) as content_hash from (select *, '{\"s_suppkey\":' || s_suppkey || ',\"s_name\":\"' || s_name || '\"}' as body from supplier)")
def _(s, d):
    x = read_table(s, d, "supplier").select(F.concat(F.lit("doc:"), "s_suppkey").alias("source_id"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("n"), "s_suppkey")).otherwise("").alias("native_id"), "s_suppkey", "s_name")
    return promote.envelope(x, "evt", ["s_suppkey", "s_name"]).select("source_id", "id", "id_strategy", "content_hash")


@query("ref_151_parse_ledger", "select event_id as raw_id, k % 4 + 1 as attempts, case when event_type <> 'error' then 'success' when k % 4 + 1 >= 3 then 'dead_letter' else 'retry' end as status, case when event_type = 'error' and k % 4 + 1 < 3 then epoch_ms(cast(epoch_ms(timestamp '2024-01-20') + power(k % 4 + 1, 2) * 300000 as bigint)) end as next_retry_at from ev", "ev")
def _(s, d):
    e = views._events(s, d)
    res = e.select(F.col("event_id").alias("raw_id"), F.lit("p").alias("parser_id"), (F.col("event_type") != "error").alias("ok"))
    prev = e.where("k % 4 > 0").select(F.col("event_id").alias("raw_id"), F.lit("p").alias("parser_id"), (F.col("k") % 4).alias("attempts"))
    return promote.parse_ledger(res, prev, NOW).drop("parser_id")


@query("ref_144_entity_place_bridge", "select 'bep:' || event_id || ':plc:' || k as bridge_id, cast(event_id as varchar) as entity_id, 'plc:' || k as place_id from ev where k % 3 <> 0", "ev")
def _(s, d):
    e = views._events(s, d)
    return ingest.entity_place_bridge(e.select(F.col("event_id").cast("string").alias("entity_id"), F.when(F.col("k") % 3 == 0, '{"place_id":" "}').otherwise(F.format_string('{"place_id":"plc:%d"}', "k")).alias("payload_json")))


@query("ref_143_places_from_dimension", "select 'plc:brand:' || p_brand as place_id, 'brand' as place_type, min(p_type) as canonical_name from part group by p_brand")
def _(s, d):
    return ingest.places_from_dimension(read_table(s, d, "part"), "p_brand", "p_type", "brand").select("place_id", "place_type", "canonical_name")
