"""Embedding near-duplicates over a robust-pruned flat graph.

Vectors of one label are dealt into cluster shards of bounded size, which overlap
by the link radius: a vector's home shard holds every vector linked to it. Where
clusters can't be told apart at that radius (one large group of near copies, or
vectors without structure), blocks of the vectors are compared pair by pair.
Each shard builds a flat graph by robust pruning; a vector's adjacency lists
from its shards are united. Every vector then searches its shards greedily from
the medoids of all clusters that may hold a link of it and, once it meets
vectors in range, expands the range through their neighbours. Pairs count only after an exact cosine in double precision.

A vector is searched and counted in the shard that is its home only, where all its
links are, so both ends of a link count it; of the links only a spanning forest
leaves a shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoflume.llm.common import connected_components, stage

#: Members of a shard that isn't split further; shards split in one round, parts of each, and members sampled for their centres.
SHARD, SPLITS, WAYS, SAMPLE = 2000, 1024, 8, 64
#: Splits that lie above a shard at most; what is still large then is compared in blocks.
DEPTH = 40
#: Rows that a split may make of one on average; beyond it a shard is compared in blocks.
COPIES = 2
#: Edges of a node in one shard, candidates for them, slack of the pruning, and width of the search beam.
DEGREE, CANDIDATES, ALPHA, BEAM = 24, 64, 1.2, 32
#: Edges of a node that are kept for far vectors.
LONG = 4
#: Vectors this far below the threshold are still expanded, as they may lead to others in range.
SLACK = 0.06


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centres(x: np.ndarray, k: int) -> np.ndarray:
    """A few rounds of k-means from far-apart starting points."""
    c = [x[0]]
    far = ((x - c[0]) ** 2).sum(1)
    while len(c) < min(k, len(x)) and far.max() > 0:
        c.append(x[int(np.argmax(far))])
        far = np.minimum(far, ((x - c[-1]) ** 2).sum(1))
    c = np.array(c)
    for _ in range(5):
        near = np.argmax(x @ c.T - (c**2).sum(1) / 2, 1)
        c = np.array([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
    return c


def _parts(x: np.ndarray, c: np.ndarray, radius: float) -> np.ndarray:
    """reach[i, b]: whether part b of the centres c may hold a vector within radius of row i, by the distance to each of b's borders."""
    d = ((x[:, None] - c) ** 2).sum(2)
    apart = 2 * np.linalg.norm(c[:, None] - c, axis=2)
    return (d[:, :, None] - d[:, None, :] <= radius * apart + 1e-9).all(2)


_PLACED = "cls long, v array<double>, shard string, home boolean"


def _split_rows(held):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radius = held.value
        for b in batches:
            out: list[tuple] = []
            for cls, v, shard, home in zip(*(c.to_pylist() for c in b.columns)):
                c = centres.get(shard)
                if c is None:
                    out.append((cls, v, shard, home))
                    continue
                x = _unit(np.array([v]))
                own = int(np.argmin(((c - x) ** 2).sum(1)))
                out += ((cls, v, f"{shard}.{i}", home and i == own) for i in np.flatnonzero(_parts(x, c, radius)[0]).tolist())
            kinds = (pa.int64(), pa.list_(pa.float64()), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)], ["cls", "v", "shard", "home"])

    return rows


def _cut(sample: np.ndarray, radius: float) -> np.ndarray | None:
    """Centres of a split, or None if they'd copy a vector too often; they are fitted to one half of the sample and tried on the other."""
    x = _unit(sample)
    c = _centres(x[::2], WAYS)
    return c if len(c) > 1 and len(x) > 1 and _parts(x[1::2], c, radius).sum(1).mean() <= COPIES else None


def shards(vectors: DataFrame, least: float) -> tuple[DataFrame, dict[str, int]]:
    """((cls, v, shard, home), rows of each shard that is left too large) from (cls, label, v).

    At each split a vector's home row goes on in its nearest part, and every row
    is copied to all parts that may hold a vector linked to it.
    """
    spark = vectors.sparkSession
    radius = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9
    now = stage(vectors.select("cls", "v", F.col("label").cast("string").alias("shard"), F.lit(True).alias("home")), "graph-shards")
    whole: dict[str, int] = {}
    while True:
        large = now.groupBy("shard").count().where(F.col("count") > SHARD)
        large = large.where(~F.col("shard").isin(list(whole))) if whole else large
        big = {r.shard: r["count"] for r in large.orderBy(F.desc("count"), "shard").limit(SPLITS).collect()}
        if not big:
            return now, whole
        ranked = now.where(F.col("shard").isin(list(big))).groupBy("shard", F.pmod(F.xxhash64("cls"), F.lit(SAMPLE)).alias("k")).agg(F.min_by("v", F.xxhash64("cls", F.lit(3))).alias("v"))
        sample: dict[str, list] = {s: [] for s in big}
        for r in ranked.orderBy("shard", "k").collect():  # SAMPLE vectors for each of SPLITS shards at most
            sample[r.shard].append(r.v)
        cuts = {s: _cut(np.array(x), radius) if s.count(".") < DEPTH else None for s, x in sample.items()}
        whole |= {s: big[s] for s, c in cuts.items() if c is None}
        centres = {s: c for s, c in cuts.items() if c is not None}
        if centres:
            held = spark.sparkContext.broadcast((centres, radius))
            now = stage(now.mapInArrow(_split_rows(held), _PLACED), "graph-shards")


def robust_prune(x: np.ndarray, p: int, cand: np.ndarray, degree: int, alpha: float) -> list[int]:
    """Neighbours of p out of cand: the nearest first, dropping what a kept one is alpha times nearer to."""
    d = ((x[cand] - x[p]) ** 2).sum(1)
    order = np.argsort(d, kind="stable")
    cand, d = cand[order], d[order]
    alive, out = cand != p, []
    y = x[cand]
    for i in range(len(cand)):
        if alive[i]:
            out.append(int(cand[i]))
            if len(out) == degree:
                break
            alive &= alpha * alpha * ((y - y[i]) ** 2).sum(1) > d
    return out


def cover(x: np.ndarray, least: float) -> np.ndarray:
    """Medoids of a shard's clusters: every vector has a cosine of `least` with one of them, none of them with another."""
    left, out = np.ones(len(x), bool), []
    while left.any():
        m = int(np.argmax(left))
        out.append(m)
        left &= x @ x[m] < least
        left[m] = False
    return np.array(out, np.int64)


def build(x: np.ndarray, medoids: np.ndarray | None = None) -> list[list[int]]:
    """Adjacency lists of a shard's flat graph, pruned to DEGREE in both directions.

    Most edges come from the nearest vectors. LONG of them are kept for far
    ones, of which random vectors and the nearest medoids are the candidates: in
    a group of many near copies the nearest alone would never lead out of it.
    """
    n = len(x)
    medoids = cover(x, 0.92) if medoids is None else medoids
    near = np.empty((n, min(CANDIDATES, n)), np.int64)
    hubs = np.empty((n, min(8, len(medoids))), np.int64)
    for s in range(0, n, 512):
        sim = x[s : s + 512] @ x.T
        near[s : s + 512] = np.argpartition(-sim, near.shape[1] - 1, 1)[:, : near.shape[1]] if n > near.shape[1] else np.arange(n)
        hubs[s : s + 512] = medoids[np.argsort(-sim[:, medoids], 1)[:, : hubs.shape[1]]]
    rng = np.random.default_rng(n)

    def both_kinds(p: int, close: np.ndarray) -> list[int]:
        far = robust_prune(x, p, np.unique(np.concatenate([hubs[p], rng.integers(0, n, 8)])), LONG, ALPHA)
        return list(dict.fromkeys(far + robust_prune(x, p, close, DEGREE - LONG, ALPHA)))

    out = [both_kinds(p, near[p]) for p in range(n)]
    back: list[list[int]] = [[] for _ in range(n)]
    for p, ns in enumerate(out):
        for q in ns:
            back[q].append(p)
    for p in range(n):
        both = list(dict.fromkeys(out[p] + back[p]))
        out[p] = both if len(both) <= DEGREE else both_kinds(p, np.array(both))
    return out


def range_search(x: np.ndarray, graph: list[np.ndarray], starts: np.ndarray, q: int, least: float) -> np.ndarray:
    """Nodes whose cosine with node q is `least` at least: greedy search from the starts, then range expansion."""
    seen = np.zeros(len(x), bool)
    seen[starts] = True
    ids, sims, done = starts.tolist(), (x[starts] @ x[q]).tolist(), [False] * len(starts)
    while True:
        order = np.argsort(-np.array(sims), kind="stable")[:BEAM]
        best = next((i for i in order if not done[i]), None)
        if best is None:
            break
        done[best] = True
        new = [j for j in graph[ids[best]] if not seen[j]]
        if new:
            seen[new] = True
            ids += new
            sims += (x[new] @ x[q]).tolist()
            done += [False] * len(new)
    # the starts are opened whatever their cosine: a linked vector's medoid may be farther than SLACK
    edge = list(dict.fromkeys([ids[i] for i in range(len(ids)) if sims[i] >= least - SLACK] + starts.tolist()))
    hit = [ids[i] for i in range(len(ids)) if sims[i] >= least]
    while edge:
        new = np.unique(np.concatenate([graph[j] for j in edge]))
        new = new[~seen[new]]
        seen[new] = True
        s = x[new] @ x[q]
        hit += new[s >= least].tolist()
        edge = new[s >= least - SLACK].tolist()
    return np.array(hit, np.int64)


def starts_of(x: np.ndarray, medoids: np.ndarray, q: int, least: float, held: float) -> np.ndarray:
    """The medoids among whose vectors one may be linked with q: by the angles of a link and of a cluster, q's own among them."""
    reach = np.cos(min(np.pi, np.arccos(min(1.0, least)) + np.arccos(held))) - 1e-9
    return medoids[x[medoids] @ x[q] >= reach]


def _build_shard(p: pd.DataFrame) -> pd.DataFrame:
    x = _unit(np.stack(p["v"].to_numpy()).astype(np.float64))
    ids = p["cls"].to_numpy()
    return pd.DataFrame({"cls": ids, "near": [ids[ns].tolist() for ns in build(x)]})


def _linked(ids: np.ndarray, home: np.ndarray, times: np.ndarray, adj: np.ndarray) -> pd.DataFrame:
    """Links of the home rows, and a component's first row for each row that is linked."""
    np.fill_diagonal(adj, False)
    links = np.where(home, adj @ times.astype(np.float64), 0)
    some = adj.any(1)
    root = np.full(len(ids), -1)
    for i in np.flatnonzero(some):
        edge = np.array([i]) if root[i] < 0 else ()
        while len(edge):
            root[edge] = i
            edge = np.flatnonzero(adj[edge].any(0) & (root < 0))
    return pd.DataFrame({"cls": ids[some], "links": links[some].round().astype(np.int64), "root": ids[root[some]]})


def _search_shard(least: float):
    def search(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("cls")
        x = _unit(np.stack(p["v"].to_numpy()).astype(np.float64))
        ids, home, times = p["cls"].to_numpy(), p["home"].to_numpy(), p["times"].to_numpy()
        graph = []
        for ns in p["near"]:
            ns = np.unique(np.asarray(ns if ns is not None else [], np.int64))
            at = np.searchsorted(ids, ns)
            at = at[at < len(ids)]
            graph.append(at[np.isin(ids[at], ns)])
        medoids = cover(x, least - SLACK)
        adj = np.zeros((len(x), len(x)), bool)
        for q in np.flatnonzero(home):
            adj[q, range_search(x, graph, starts_of(x, medoids, q, least, least - SLACK), q, least)] = True
        # a link over a border is met by both ends in different graphs, so it is compared directly
        adj[np.ix_(home, ~home)] = x[home] @ x[~home].T >= least
        adj |= adj.T
        return _linked(ids, home, times, adj)

    return search


def _compare_blocks(least: float):
    """Links between the two blocks of a pair, or within a block that is paired with itself."""

    def compare(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("cls")
        x = _unit(np.stack(p["v"].to_numpy()).astype(np.float64))
        ids, home, times, blk = (p[k].to_numpy() for k in ("cls", "home", "times", "blk"))
        adj = np.zeros((len(x), len(x)), bool)
        one = blk == blk.min()
        if one.all():
            adj = x @ x.T >= least
            adj |= adj.T
        else:
            hit = x[one] @ x[~one].T >= least
            adj[np.ix_(one, ~one)], adj[np.ix_(~one, one)] = hit, hit.T
        return _linked(ids, home, times, adj)

    return compare


def _blocks(placed: DataFrame, whole: dict[str, int]) -> DataFrame:
    """Rows of shards that are too large, once for each pair of blocks that theirs is part of: shard, i, j and blk besides."""
    size = F.create_map(*[F.lit(x) for s, n in whole.items() for x in (s, -(-2 * n // SHARD))])
    out = placed.withColumn("n", F.element_at(size, F.col("shard"))).withColumn("blk", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("n")).cast("int"))
    out = out.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return out.withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other"))


def near_duplicates(emb: DataFrame, least: float = 0.98) -> DataFrame:
    """Link vectors of equal label whose cosine is `least` at least.

    emb: vec_id, embedding, label; other columns are ignored. Returns a row per
    input row: vec_id, n_links, component_id, kept. Vectors that are null,
    empty, zero or not finite in a component, and those without label or
    vec_id, link with nothing. Equal vectors are linked to each other and
    searched once. Vectors of other dimension than the label's commonest are
    apart from it. An empty table gives no rows.
    """
    e = emb.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.transform(F.col("embedding"), lambda x: x.cast("double")).alias("v"))
    fine = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    e = e.withColumn("fine", F.coalesce(fine, F.lit(False)))
    part = F.concat_ws("/", F.col("label").cast("string"), F.size("v").cast("string"))
    classes = e.where("fine").groupBy(part.alias("label"), "v").agg(F.min("vec_id").alias("cls"), F.count("*").alias("times"))
    classes = stage(classes.select("cls", "label", "v", "times"), "graph-vectors")
    placed, whole = shards(classes, least)
    large = F.col("shard").isin(list(whole)) if whole else F.lit(False)
    apart, placed = placed.where(large), placed.where(~large)
    lists = placed.groupBy("shard").applyInPandas(_build_shard, "cls long, near array<long>")
    union = lists.groupBy("cls").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    ready = placed.join(union, "cls").join(classes.select("cls", "times"), "cls")
    found = ready.groupBy("shard").applyInPandas(_search_shard(least), "cls long, links long, root long")
    if whole:
        pairs = _blocks(apart.join(classes.select("cls", "times"), "cls"), whole).select("shard", "i", "j", "blk", "cls", "v", "home", "times")
        found = found.union(pairs.groupBy("shard", "i", "j").applyInPandas(_compare_blocks(least), "cls long, links long, root long"))
    found = stage(found, "graph-found")
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    parts = connected_components(found.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "cls")
    by_class = classes.join(links, "cls", "left").join(parts, "cls", "left").select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("links"), F.coalesce("component_id", "cls").alias("component"))
    alone = e.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    rest = e.where("fine").select("vec_id", part.alias("label"), "v").join(by_class, ["label", "v"]).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    return rest.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def audit_recall(emb: DataFrame, result: DataFrame, least: float = 0.98, every: int = 20, block: int = 1000) -> float:
    """Share of true links found, for the query set of ids divisible by `every` against all rows in blocks.

    Queries of one label and hash block meet the rows of that label once per
    block; `result` is what near_duplicates returned for emb.
    """
    e = emb.select("vec_id", "label", "embedding").where("vec_id is not null and label is not null and embedding is not null")
    q = e.where(f"vec_id % {every} = 0")
    blocks = max(1, round(q.count() / block))
    q = q.select("label", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("blk"), F.col("vec_id").alias("q_id"), F.col("embedding").alias("q_v"))
    qs = q.groupBy("label", "blk").agg(F.collect_list("q_id").alias("q_ids"), F.collect_list("q_v").alias("q_vs"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            for ids, vs, vec, v in zip(p["q_ids"], p["q_vs"], p["vec_id"], p["embedding"]):
                m, y = np.stack(vs).astype(np.float64), np.asarray(v, np.float64)
                with np.errstate(all="ignore"):
                    c = (m @ y) / (np.linalg.norm(m, axis=1) * np.linalg.norm(y))
                hit = np.asarray(ids)[(c >= least) & (np.asarray(ids) != vec)]
                yield pd.DataFrame({"vec_id": hit, "n": np.ones(len(hit), np.int64)})

    true = e.join(qs, "label").select("q_ids", "q_vs", "vec_id", "embedding").mapInPandas(count, "vec_id long, n long").groupBy("vec_id").agg(F.sum("n").alias("n"))
    got = true.join(result, "vec_id", "left").agg(F.sum("n"), F.sum(F.least("n", F.coalesce("n_links", F.lit(0))))).first()
    return got[1] / got[0] if got[0] else 1.0


def op7_embedding_graph(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
