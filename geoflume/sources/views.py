"""The given tables as canonical inputs. VIEWS_SQL says the same in SQL, for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with its zone-less times as UTC instants; sessions run in UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def events_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream of its files."""
    path = f"{d}/events.parquet"
    e = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 100).parquet(f"{d}/event[s].parquet")  # a pattern may name one file
    return e.withColumn("ts", F.col("ts").cast("timestamp"))


def _events(spark: SparkSession, d: str, e: DataFrame | None = None) -> DataFrame:
    e = read_table(spark, d, "events") if e is None else e
    return e.select(
        "event_id", F.timestamp_millis(F.unix_millis("ts")).alias("ts"), "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def records(spark: SparkSession, d: str, events: DataFrame | None = None) -> DataFrame:
    """Metric input records from events (a stream, if given); nations are both the place and its admin level 0."""
    e, n = _events(spark, d, events), read_table(spark, d, "nation")
    place = F.concat(F.lit("plc:"), F.col("user_id") % 25)
    region = n.select(F.col("n_nationkey").cast("long").alias("nk"), F.concat(F.lit("plc:continent:"), "n_regionkey").alias("continent_place_id"))
    j = e.join(F.broadcast(region), F.col("user_id") % 25 == F.col("nk"), "left")
    return j.select(
        F.concat(F.lit("obs:"), "event_id").alias("record_id"),
        F.when(F.col("event_type") == "purchase", "event").otherwise("observation").alias("record_type"),
        F.concat(F.lit("ent:"), "user_id").alias("entity_id"),
        place.alias("place_id"), place.alias("admin0_place_id"), "continent_place_id",
        F.concat(F.lit("src:"), "event_type").alias("source_id"),
        F.col("ts").alias("occurred_at"),
        F.when(F.col("k") % 7 != 0, F.timestamp_millis(F.unix_millis("ts") - (F.col("k") - 20).cast("long") * 60000)).alias("published_at"),
        (F.col("user_id") % 3 != 0).alias("geolocation_succeeded"), (F.col("event_id") % 4 == 0).alias("deduplicated"), (F.col("event_id") % 10 == 0).alias("schema_drift_detected"),
        (F.col("k") % 4).alias("confirming_source_count"), (F.col("value") / 100).alias("confidence"), (F.col("k") % 5).alias("evidence_count"),
        (F.col("value") / 50 - 0.2).alias("burst_score"), ((F.col("value") - 20) / 80).alias("risk_score"),
        ((F.col("k") - 50) / 100.0).alias("acceleration_7d_vs_30d"), ((F.col("k") % 30) / 10.0).alias("anomaly_zscore_30d"),
    )


def places(spark: SparkSession, d: str) -> DataFrame:
    """World, continents and nations with ten-degree boxes; the table is a dimension of a few rows per nation."""
    n, r = read_table(spark, d, "nation"), read_table(spark, d, "region")
    lat, lon = (F.floor(F.col("n_nationkey") / 5) * 10 - 25).cast("double"), (F.col("n_regionkey") * 10 - 25).cast("double")
    box = lambda a, b, x, y: [F.lit(v).cast("double").alias(k) if not hasattr(v, "alias") else v.alias(k) for k, v in (("min_lat", a), ("min_lon", b), ("max_lat", x), ("max_lon", y))]
    world = r.limit(1).select(F.lit("plc:world").alias("place_id"), F.lit("").alias("parent_place_id"), F.lit("World").alias("canonical_name"), F.lit("world").alias("place_type"), F.lit(-2).alias("admin_level"), *box(-90.0, -180.0, 90.0, 180.0))
    continents = r.select(F.concat(F.lit("plc:continent:"), "r_regionkey"), F.lit("plc:world"), F.col("r_name"), F.lit("continent"), F.lit(-1), *box(-25.0, (F.col("r_regionkey") * 10 - 25).cast("double"), 25.0, (F.col("r_regionkey") * 10 - 15).cast("double")))
    nations = n.select(F.concat(F.lit("plc:"), "n_nationkey"), F.concat(F.lit("plc:continent:"), "n_regionkey"), F.col("n_name"), F.lit("country"), F.lit(0), *box(lat, lon, lat + 10, lon + 10))
    return world.union(continents).union(nations)


def points(spark: SparkSession, d: str) -> DataFrame:
    """Track points from events: a slow walk per user, gaps as the events have them."""
    e = _events(spark, d)
    return e.select(
        F.col("event_id").alias("point_id"), F.concat(F.lit("trk:"), "user_id").alias("track_id"), F.concat(F.lit("ent:"), "user_id").alias("entity_id"), F.col("ts").alias("observed_at"),
        (((F.col("user_id") * 7 + F.col("event_id") % 97) % 500) / 10.0 - 25).alias("latitude"), (((F.col("user_id") * 11 + F.col("event_id") % 89) % 500) / 10.0 - 25).alias("longitude"),
        F.when(F.col("k") % 11 != 0, F.col("value") * 60).alias("altitude_m"), (F.col("value") < 12).alias("on_ground"),
        F.when(F.col("k") % 3 == 0, "").otherwise((F.col("k") % 4 + 7000).cast("string")).alias("squawk"), (F.col("k") % 9).alias("category"),
        F.when(F.col("k") % 5 == 0, "").otherwise(F.concat(F.when(F.col("user_id") % 9 == 0, "RCH").otherwise("AAL"), F.col("k"))).alias("callsign"),
    )


def airports(spark: SparkSession, d: str) -> DataFrame:
    """Airports beside some of the tracks' points, one for each place that such a point has."""
    p = points(spark, d).where("point_id % 20 = 0")
    g = p.groupBy("latitude", "longitude").agg(F.min("point_id").alias("n"))
    return g.select(
        F.concat(F.lit("apt:"), "n").alias("airport_id"), F.concat(F.lit("plc:"), F.col("n") % 25).alias("place_id"), F.when(F.col("n") % 6 == 0, "military").otherwise("public").alias("use"),
        (F.col("latitude") + 0.031).alias("latitude"), (F.col("longitude") - 0.017).alias("longitude"),
    )


def entities(spark: SparkSession, d: str) -> DataFrame:
    cu, su = read_table(spark, d, "customer"), read_table(spark, d, "supplier")
    pick = lambda df, kind, p: df.select(
        F.concat(F.lit(f"ent:{kind}:"), f"{p}_{'cust' if p == 'c' else 'supp'}key").alias("entity_id"), F.lit(kind).alias("entity_type"), F.col(f"{p}_name").alias("canonical_name"),
        F.concat(F.lit("plc:"), f"{p}_nationkey").alias("primary_place_id"), F.when(F.col(f"{p}_acctbal") > 8000, "high").when(F.col(f"{p}_acctbal") > 4000, "medium").otherwise("low").alias("risk_band"),
        F.col(f"{p}_acctbal").alias("balance"), F.col(f"{p}_{'cust' if p == 'c' else 'supp'}key").alias("record_version"),
    )
    return pick(cu, "customer", "c").union(pick(su, "supplier", "s"))


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Event facts from orders."""
    o, cu = read_table(spark, d, "orders"), read_table(spark, d, "customer")
    return o.join(cu, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("evt:"), "o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("event_type"), F.col("o_orderstatus").alias("status"), F.concat(F.lit("plc:"), "c_nationkey").alias("place_id"),
        F.concat(F.lit("ent:customer:"), "o_custkey").alias("customer_id"), F.col("o_orderdate").alias("starts_at"), (F.col("o_totalprice") / 500000).alias("impact_score"),
    )


def event_entities(spark: SparkSession, d: str) -> DataFrame:
    li = read_table(spark, d, "lineitem")
    return li.select(F.concat(F.lit("evt:"), "l_orderkey").alias("event_id"), F.concat(F.lit("ent:supplier:"), "l_suppkey").alias("entity_id"), F.col("l_returnflag").alias("role"), F.col("l_linenumber").alias("n"))


def stays(spark: SparkSession, d: str, tasks: int | None = None) -> DataFrame:
    """Port calls from lineitem: from order to shipment, at the supplier's nation. Given tasks, lines meet their orders in so many."""
    li, o, s = (read_table(spark, d, t) for t in ("lineitem", "orders", "supplier"))
    if tasks:
        li, o = li.repartition(tasks, "l_orderkey"), o.repartition(tasks, "o_orderkey")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return j.select(
        F.concat_ws(":", F.lit("call"), "l_orderkey", "l_linenumber").alias("call_id"), F.concat(F.lit("ent:customer:"), "o_custkey").alias("entity_id"), F.concat(F.lit("plc:"), "s_nationkey").alias("place_id"),
        F.when(F.col("l_returnflag") == "A", "North Anchorage").otherwise("Main Port").alias("port_name"), F.col("o_orderdate").alias("started_at"), F.col("l_shipdate").alias("ended_at"),
    )


def gaps(spark: SparkSession, d: str, tasks: int | None = None) -> DataFrame:
    """Gaps between consecutive orders of a customer. Given tasks, customers are dealt over so many."""
    from pyspark.sql import Window

    o = read_table(spark, d, "orders")
    o = o.repartition(tasks, "o_custkey") if tasks else o
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    g = o.select(F.concat(F.lit("gap:"), "o_orderkey").alias("gap_id"), F.concat(F.lit("ent:customer:"), "o_custkey").alias("entity_id"), F.lag("o_orderdate").over(w).alias("starts_at"), F.col("o_orderdate").alias("ends_at"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("plc:"), F.col("o_orderkey") % 25)).alias("next_known_port_id"))
    return g.where(F.col("starts_at").isNotNull() & (F.col("ends_at") > F.col("starts_at")))


VIEWS_SQL = {
    "ev": "select event_id, date_trunc('millisecond', ts) as ts, user_id, event_type, value, cast(json_extract_string(props, '$.k') as integer) as k from events",
    "records": """select 'obs:' || event_id as record_id, case when event_type = 'purchase' then 'event' else 'observation' end as record_type, 'ent:' || user_id as entity_id,
        'plc:' || (user_id % 25) as place_id, 'plc:' || (user_id % 25) as admin0_place_id, 'plc:continent:' || n_regionkey as continent_place_id, 'src:' || event_type as source_id, ts as occurred_at,
        case when k % 7 <> 0 then epoch_ms(cast(epoch_ms(ts) - (k - 20) * 60000 as bigint)) end as published_at,
        user_id % 3 <> 0 as geolocation_succeeded, event_id % 4 = 0 as deduplicated, event_id % 10 = 0 as schema_drift_detected, k % 4 as confirming_source_count, value / 100 as confidence, k % 5 as evidence_count,
        value / 50 - 0.2::double as burst_score, (value - 20) / 80 as risk_score, (k - 50) / 100.0::double as acceleration_7d_vs_30d, (k % 30) / 10.0::double as anomaly_zscore_30d
        from ev left join nation on user_id % 25 = n_nationkey""",
    "places": """select 'plc:world' as place_id, '' as parent_place_id, 'World' as canonical_name, 'world' as place_type, -2 as admin_level, -90.0::double as min_lat, -180.0::double as min_lon, 90.0::double as max_lat, 180.0::double as max_lon
        union all select 'plc:continent:' || r_regionkey, 'plc:world', r_name, 'continent', -1, -25, r_regionkey * 10 - 25, 25, r_regionkey * 10 - 15 from region
        union all select 'plc:' || n_nationkey, 'plc:continent:' || n_regionkey, n_name, 'country', 0, (n_nationkey // 5) * 10 - 25, n_regionkey * 10 - 25, (n_nationkey // 5) * 10 - 15, n_regionkey * 10 - 15 from nation""",
    "points": """select event_id as point_id, 'trk:' || user_id as track_id, 'ent:' || user_id as entity_id, ts as observed_at, ((user_id * 7 + event_id % 97) % 500) / 10.0::double - 25 as latitude, ((user_id * 11 + event_id % 89) % 500) / 10.0::double - 25 as longitude,
        case when k % 11 <> 0 then value * 60 end as altitude_m, value < 12 as on_ground, case when k % 3 = 0 then '' else cast(k % 4 + 7000 as varchar) end as squawk, k % 9 as category,
        case when k % 5 = 0 then '' else (case when user_id % 9 = 0 then 'RCH' else 'AAL' end) || k end as callsign from ev""",
    "airports": "select 'apt:' || n as airport_id, 'plc:' || (n % 25) as place_id, case when n % 6 = 0 then 'military' else 'public' end as use, latitude + 0.031::double as latitude, longitude - 0.017::double as longitude from (select latitude, longitude, min(point_id) as n from points where point_id % 20 = 0 group by 1, 2)",
    "entities": """select 'ent:customer:' || c_custkey as entity_id, 'customer' as entity_type, c_name as canonical_name, 'plc:' || c_nationkey as primary_place_id, case when c_acctbal > 8000 then 'high' when c_acctbal > 4000 then 'medium' else 'low' end as risk_band, c_acctbal as balance, c_custkey as record_version from customer
        union all select 'ent:supplier:' || s_suppkey, 'supplier', s_name, 'plc:' || s_nationkey, case when s_acctbal > 8000 then 'high' when s_acctbal > 4000 then 'medium' else 'low' end, s_acctbal, s_suppkey from supplier""",
    "facts": "select 'evt:' || o_orderkey as event_id, o_orderpriority as event_type, o_orderstatus as status, 'plc:' || c_nationkey as place_id, 'ent:customer:' || o_custkey as customer_id, o_orderdate as starts_at, o_totalprice / 500000 as impact_score from orders join customer on o_custkey = c_custkey",
    "event_entities": "select 'evt:' || l_orderkey as event_id, 'ent:supplier:' || l_suppkey as entity_id, l_returnflag as role, l_linenumber as n from lineitem",
    "stays": """select 'call:' || l_orderkey || ':' || l_linenumber as call_id, 'ent:customer:' || o_custkey as entity_id, 'plc:' || s_nationkey as place_id, case when l_returnflag = 'A' then 'North Anchorage' else 'Main Port' end as port_name, o_orderdate as started_at, l_shipdate as ended_at
        from lineitem join orders on l_orderkey = o_orderkey join supplier on l_suppkey = s_suppkey""",
    "gaps": """select * from (select 'gap:' || o_orderkey as gap_id, 'ent:customer:' || o_custkey as entity_id, lag(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as starts_at, o_orderdate as ends_at,
        case when o_orderkey % 3 = 0 then '' else 'plc:' || (o_orderkey % 25) end as next_known_port_id from orders) where starts_at is not null and ends_at > starts_at""",
}
_NEEDS = {"records": ["ev"], "points": ["ev"], "airports": ["ev", "points"]}


def with_views(sql: str, *names: str) -> str:
    """sql with the named views before it as common table expressions."""
    order: list[str] = []
    for n in names:
        order += [x for x in (*_NEEDS.get(n, []), n) if x not in order]
    return "with recursive " + ", ".join(f"{n} as ({VIEWS_SQL[n]})" for n in order) + " " + sql if order else sql
