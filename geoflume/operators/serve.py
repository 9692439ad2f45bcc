"""Read queries: lists, search, pages, unions of views, and vector search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoflume.functions.cols import blank, c, cosine, dot, euclidean


def search(df: DataFrame, text: str, cols: list[str], mode: str = "fuzzy") -> DataFrame:
    """Rows in which a column holds the text, whatever its case, or matches the pattern."""
    hit = F.lit(False)
    for x in cols:
        hit = hit | (F.coalesce(c(x), F.lit("")).rlike(text) if mode == "regex" else F.lower(F.coalesce(c(x), F.lit(""))).contains(text.lower()))
    return df.where(hit)


def filtered(df: DataFrame, filters: dict | None = None, text: str = "", cols: list[str] = (), mode: str = "fuzzy") -> DataFrame:
    for k, v in (filters or {}).items():
        df = df.where(c(k) == v)
    return search(df, text, list(cols), mode) if text else df


def list_rows(df: DataFrame, id_col: str, filters: dict | None = None, text: str = "", cols: list[str] = (), mode: str = "fuzzy", cursor: str | None = None, offset: int = 0, limit: int = 50, fields: list[str] | None = None) -> DataFrame:
    """A page ordered by id after the cursor; only the fields asked for are read."""
    out = filtered(df, filters, text, cols, mode)
    if cursor is not None:
        out = out.where(c(id_col) > cursor)
    return out.select(*(fields or df.columns)).orderBy(id_col).offset(offset).limit(limit)


def detail(df: DataFrame, id_col: str, value) -> DataFrame:
    return df.where(c(id_col) == value).limit(1)


def total_count(df: DataFrame, filters: dict | None = None, text: str = "", cols: list[str] = (), mode: str = "fuzzy") -> DataFrame:
    return filtered(df, filters, text, cols, mode).agg(F.count("*").alias("total"))


def page_after(df: DataFrame, keys: list[str], cursor: list | None, limit: int, desc: bool = False) -> DataFrame:
    """The page after a cursor of several keys; all keys rise or all fall."""
    if cursor is not None:
        after, same = F.lit(False), F.lit(True)
        for k, v in zip(keys, cursor):
            after = after | (same & ((c(k) < F.lit(v)) if desc else (c(k) > F.lit(v))))
            same = same & (c(k) == F.lit(v))
        df = df.where(after)
    return df.orderBy(*[F.desc(k) if desc else F.asc(k) for k in keys]).limit(limit)


def activity_tail(jobs: DataFrame, fetch: DataFrame, parse: DataFrame) -> DataFrame:
    """Three logs in one shape: kind, id, at, status."""
    pick = lambda df, kind, key, at: df.select(F.lit(kind).alias("kind"), c(key).cast("string").alias("id"), c(at).alias("at"), "status")
    return pick(jobs, "job", "job_id", "started_at").union(pick(fetch, "fetch", "fetch_id", "fetched_at")).union(pick(parse, "parse", "parse_id", "parsed_at"))


def tracks_view(segments: DataFrame, points: DataFrame) -> DataFrame:
    """Segments and points as rows of one view; what a kind doesn't have is null."""
    return segments.withColumn("row_kind", F.lit("segment")).unionByName(points.withColumn("row_kind", F.lit("point")), allowMissingColumns=True)


def combined_search(places: DataFrame, entities: DataFrame, text: str, limit: int = 50, cls: str | None = None) -> DataFrame:
    p = search(places, text, ["place_id", "canonical_name"]).select(F.lit("place").alias("class"), F.col("place_id").alias("id"), F.col("canonical_name").alias("name"))
    e = search(entities, text, ["entity_id", "canonical_name"]).select(F.lit("entity"), "entity_id", "canonical_name")
    both = p.union(e)
    return (both.where(F.col("class") == cls) if cls else both).orderBy("name", "id").limit(limit)


def class_counts(entities: DataFrame, places: DataFrame) -> DataFrame:
    pick = lambda df, kind, col: df.groupBy(c(col).alias("class")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "class", "n")
    return pick(entities, "entity", "entity_type").union(pick(places, "place", "place_type"))


def json_hot_columns(df: DataFrame, col: str, spec: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Typed columns from JSON: name -> (type, paths in order); blank texts count as absent."""
    made = [F.coalesce(*[F.when(~blank(F.get_json_object(c(col), p)), F.get_json_object(c(col), p)) for p in paths]).try_cast(kind).alias(name) for name, (kind, paths) in spec.items()]
    return df.select(*[x for x in df.columns if x not in spec], *made)


def valid_position(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.where(c(lat).between(-90, 90) & c(lon).between(-180, 180))


def latest_parser_only(df: DataFrame, col: str = "parser_version") -> DataFrame:
    """Rows of the greatest parser version: the maximum is one row, whatever the input."""
    return df.join(F.broadcast(df.agg(F.max(col).alias("__m"))), c(col) == F.col("__m")).drop("__m")


def credential_gate(attrs) -> Column:
    """Whether any of the flags that ask for credentials is set."""
    out = F.lit(False)
    for k in ("requires_credentials", "requires_api_key", "auth_required"):
        out = out | (F.coalesce(F.get_json_object(c(attrs), f"$.{k}"), F.lit("")) == "true")
    return out


# vectors


def check_space(emb: DataFrame, dims: int) -> DataFrame:
    """Rows whose vector hasn't the space's number of dimensions."""
    return emb.where(F.coalesce(F.size("embedding"), F.lit(-1)) != dims)


def knn(emb: DataFrame, query: list[float] | Column, metric: str = "cosine", k: int = 10, kind: str | None = None, exclude: list = (), min_score: float | None = None) -> DataFrame:
    """Exact nearest vectors: a scan and a bounded top-k per task. emb: entity_id, entity_type, embedding."""
    if not 1 <= k <= 1000:
        raise ValueError("k is 1 to 1000")
    q = query if isinstance(query, Column) else F.array(*[F.lit(float(x)) for x in query])
    e = emb.where(c("entity_type") == kind) if kind is not None else emb
    if exclude:
        e = e.where(~c("entity_id").isin(*exclude))
    d = {"cosine": lambda: 1 - cosine("embedding", q), "euclidean": lambda: euclidean("embedding", q), "dot": lambda: dot("embedding", q)}[metric]()
    score = {"cosine": F.greatest(F.lit(0.0), 1 - F.col("raw")), "euclidean": 1 / (1 + F.col("raw")), "dot": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("raw")))}[metric]
    out = e.select("entity_id", d.alias("raw")).withColumn("score", score)
    if min_score is not None:
        out = out.where(F.col("score") >= min_score)
    return out.orderBy(F.desc("raw") if metric == "dot" else F.asc("raw"), "entity_id").limit(k)


def knn_batch(emb: DataFrame, seeds: DataFrame, k: int = 10, block: int = 1000) -> DataFrame:
    """Cosine neighbours of each seed: products of blocks of seeds and Arrow batches, of which a task keeps the best of each seed.

    seeds: seed_id, seed_vector, in any number; they go through the vectors in
    blocks of `block`, about. A task sends k rows a seed and a few that are as
    good but for rounding; their scores are then computed as `knn` does.
    """
    spark, kind = emb.sparkSession, emb.schema["entity_id"].dataType.simpleString()
    n = max(1, -(-seeds.count() // block))
    own = seeds.select("seed_id", "seed_vector", F.pmod(F.xxhash64("seed_id"), F.lit(n)).alias("g"))
    found = None
    for g in range(n):
        rows = own.where(F.col("g") == g).collect()  # a block
        if not rows:
            continue
        held = spark.sparkContext.broadcast(([r["seed_id"] for r in rows], [r["seed_vector"] for r in rows]))

        def best(batches, held=held):
            import numpy as np
            import pandas as pd

            ids, vectors = held.value
            q = np.array(vectors, np.float64)
            q = q / np.sqrt((q * q).sum(1, keepdims=True))
            keep: list = [(np.zeros(0), []) for _ in ids]
            for p in batches:
                e = np.array(p["entity_id"], object)
                x = np.array(p["embedding"].tolist(), np.float64)
                with np.errstate(invalid="ignore", divide="ignore"):
                    score = q @ (x / np.sqrt((x * x).sum(1, keepdims=True))).T
                score[np.isnan(score)] = -2
                top = min(k + 1, score.shape[1])  # a seed may meet itself
                least = np.partition(score, -top, 1)[:, -top] - 1e-9
                for i in range(len(ids)):
                    at = np.flatnonzero(score[i] >= least[i])
                    s, names = np.r_[keep[i][0], score[i][at]], [*keep[i][1], *e[at]]
                    if len(s) > 2 * (k + 1):
                        ok = np.flatnonzero(s >= np.partition(s, -(k + 1))[-(k + 1)] - 1e-9)
                        s, names = s[ok], [names[j] for j in ok]
                    keep[i] = (s, names)
            yield pd.DataFrame([(ids[i], x) for i, (_, names) in enumerate(keep) for x in names], columns=["seed_id", "entity_id"])

        part = emb.where(c("embedding").isNotNull()).select("entity_id", c("embedding").cast("array<double>").alias("embedding")).mapInPandas(best, f"seed_id {seeds.schema['seed_id'].dataType.simpleString()}, entity_id {kind}")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = emb.select(F.lit(None).cast(seeds.schema["seed_id"].dataType).alias("seed_id"), "entity_id").where("false")
    pairs = found.where("seed_id <> entity_id").join(seeds.select("seed_id", "seed_vector"), "seed_id").join(emb.select("entity_id", "embedding"), "entity_id")
    scored = pairs.select("seed_id", "entity_id", cosine("embedding", "seed_vector").alias("score"))
    w = Window.partitionBy("seed_id").orderBy(F.desc("score"), "entity_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def resolve_seeds(emb: DataFrame, ids: list, mode: str = "each") -> DataFrame:
    """The vectors of ids, each by itself or as their mean; `missing_seeds` tells the rest."""
    found = emb.where(c("entity_id").isin(*ids))
    if mode != "centroid":
        return found.select(F.col("entity_id").alias("seed_id"), F.col("embedding").alias("seed_vector"))
    pos = found.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return pos.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("seed_vector")).select(F.lit("centroid").alias("seed_id"), "seed_vector")


def missing_seeds(emb: DataFrame, ids: list) -> DataFrame:
    asked = emb.sparkSession.createDataFrame([(i,) for i in ids], "entity_id " + emb.schema["entity_id"].dataType.simpleString())
    return asked.join(emb.where(c("entity_id").isin(*ids)), "entity_id", "left_anti")


def needs_embedding(entities: DataFrame, emb: DataFrame) -> DataFrame:
    """Entities whose text has no stored vector with its hash: entity_id, source_text, source_text_sha256."""
    text = F.concat(F.col("canonical_name"), F.lit(" ["), F.col("entity_type"), F.lit("]"))
    e = entities.select("entity_id", text.alias("source_text")).withColumn("source_text_sha256", F.sha2("source_text", 256))
    return e.join(emb.select("entity_id", "source_text_sha256"), ["entity_id", "source_text_sha256"], "left_anti")


def embed(selection: DataFrame, model) -> DataFrame:
    """Vectors of the selected texts by the user's model, a function from a pandas Series of texts to one of lists."""
    fn = F.pandas_udf(model, "array<double>")
    return selection.withColumn("embedding", fn("source_text"))
