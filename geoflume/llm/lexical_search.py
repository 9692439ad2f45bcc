"""Ranked lexical search of a set of items over all documents, by dual trees.

A text's terms are counted once, in an index of the terms that some item may
have (a fixed bitmap decides, so what is sent to tasks doesn't grow). Items go
through the documents in blocks. In a task, documents and items of a block are
the leaves of two trees whose nodes hold the greatest value that each term has
below them. The sum of products of two nodes bounds every score between them;
pairs of nodes whose bound is under the weakest kth score of the items below
aren't opened. A first search over a hashed share of the documents gives those
kth scores a start, which only ever rises, so the result is exact.

Edge cases: a null or termless text has no terms and isn't counted in N; an
item without terms, or whose terms no document has, has no rows; so has every
item of empty tables. Repeated rows of a document are documents of their own,
and tie by doc_id; a document without doc_id counts in N, L and df but can't be
named, so it isn't ranked. Repeated rows of an item (id and text) are one item;
rows of one id with different texts are ranked each by itself. Columns beyond
the id and the text are left out.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoflume.llm.common import stage, table

K = 20
#: Bits of the map of item terms: 2 MB.
BITS = 1 << 24
#: Terms of the items of one block, about; a block is what a task holds of the items.
BLOCK_TERMS = 1 << 18
#: Documents that give the first kth scores, about, and documents that a task makes one tree of.
SEEDS, FOREST = 20_000, 8192
#: Documents and items of a leaf, and leaves of a node.
DOC_LEAF, ITEM_LEAF, FAN = 8, 1, 8

_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of letters, digits and bytes of non-ASCII characters; only A-Z in lower case."""
    return text.translate(_FOLD).split()


def _counted(df: DataFrame, id_col: str, text_col: str, bitmap: bytes | None = None) -> DataFrame:
    """(id, n, terms, counts) of every row; with a bitmap, only of terms whose bit is set. n counts all terms."""
    held = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        import zlib

        import pyarrow as pa

        bits = held.value
        for b in batches:
            n, terms, counts, ends = [], [], [], [0]
            for t in b.column(1).to_pylist():
                words = terms_of(t or b"")
                n.append(len(words))
                for w, c in Counter(words).items():
                    if bits is None or bits[(h := zlib.crc32(w) & (BITS - 1)) >> 3] >> (h & 7) & 1:
                        terms.append(w)
                        counts.append(c)
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(terms, pa.binary())), pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], ["id", "n", "terms", "counts"])

    x = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return x.mapInArrow(run, "id long, n long, terms array<binary>, counts array<long>")


def _bitmap(terms: DataFrame) -> bytes:
    """A bit for each term's crc32; 512 rows of 4 kB at most come to the driver."""
    h = terms.select(F.crc32("term").bitwiseAND(BITS - 1).alias("h"))
    rows = h.groupBy(F.expr("bitmap_bucket_number(h + 1)").alias("k")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(h + 1))").alias("b")).collect()
    out = bytearray(BITS >> 3)
    for r in rows:
        out[(r["k"] - 1) << 12 : r["k"] << 12] = r["b"]
    return bytes(out)


class _Postings:
    """Entries (term, node, value), for each term and node the greatest value, found by term."""

    def __init__(self, term: np.ndarray, node: np.ndarray, value: np.ndarray, n_terms: int, n_nodes: int):
        order = np.lexsort((node, term))
        term, node, value = term[order], node[order], value[order]
        first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (node[1:] != node[:-1])]) if len(term) else np.zeros(0, int)
        self.term, self.node, self.n = term[first], node[first], n_nodes
        self.value = np.maximum.reduceat(value, first) if len(first) else value
        self.start = np.searchsorted(self.term, np.arange(n_terms + 1))

    def meet(self, term: np.ndarray, value: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, node, product) for all entries of the rows' terms."""
        n = self.start[term + 1] - self.start[term]
        at = np.repeat(self.start[term] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return np.repeat(row, n), self.node[at], np.repeat(value, n) * self.value[at]


class ItemTree:
    """The items of a block: postings of items, leaves and nodes. rows: (item, item_id, term, weight)."""

    def __init__(self, rows: list[tuple]):
        heavy: dict = {}
        for key, _, term, w in rows:
            heavy[key] = max(heavy.get(key, (0, b"")), (w, term))
        keys = sorted(heavy, key=lambda k: (heavy[k][1], k))  # items with the same telling term lie together
        place = {k: i for i, k in enumerate(keys)}
        self.keys, self.n = keys, len(keys)
        self.ids: list = [None] * self.n
        self.vocabulary: dict[bytes, int] = {}
        item, term, value = (np.empty(len(rows), np.int64) for _ in range(3))
        for i, (key, item_id, t, w) in enumerate(rows):
            self.ids[place[key]] = item_id
            item[i], term[i], value[i] = place[key], self.vocabulary.setdefault(t, len(self.vocabulary)), w
        v, self.leaves = len(self.vocabulary), -(-self.n // ITEM_LEAF)
        self.nodes = -(-self.leaves // FAN)
        self.items = _Postings(term, item, value, v, self.n)
        self.leaf = _Postings(term, item // ITEM_LEAF, value, v, self.leaves)
        self.node = _Postings(term, item // ITEM_LEAF // FAN, value, v, self.nodes)


def _least(x: np.ndarray, group: int, n: int) -> np.ndarray:
    return np.minimum.reduceat(x, np.arange(0, len(x), group))[:n]


class Search:
    """The k best documents of each item so far, and the score that a further one must reach."""

    def __init__(self, tree: ItemTree, floor: np.ndarray, k: int):
        self.tree, self.k, self.kth = tree, k, np.maximum(floor, 1)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.opened = self.pairs = 0

    def forest(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """Search documents, given as entries (doc index, term, impact) in order of doc."""
        tree = self.tree
        if not len(doc) or not tree.n:
            return
        # documents whose most telling term is the same lie together
        weight = impact * np.maximum.reduceat(tree.items.value, tree.items.start[:-1])[term]
        best = np.lexsort((-weight, doc))
        head = best[np.r_[True, doc[best][1:] != doc[best][:-1]]]
        order = head[np.lexsort((-weight[head], term[head]))]
        rank = np.zeros(len(ids), np.int64)
        rank[doc[order]] = np.arange(len(order))
        ids, entry = ids[doc[order]], np.argsort(rank[doc], kind="stable")
        row, term, impact = rank[doc][entry], term[entry], impact[entry]
        n_leaves = -(-len(order) // DOC_LEAF)
        leaf = _Postings(row // DOC_LEAF, term, impact, n_leaves, 0)  # by leaf: its terms and their greatest impacts
        node = _Postings(leaf.term // FAN, leaf.node, leaf.value, -(-n_leaves // FAN), 0)
        ends = np.searchsorted(row, np.arange(0, n_leaves + 1) * DOC_LEAF)
        for d in range(-(-n_leaves // FAN)):
            s = slice(node.start[d], node.start[d + 1])
            live = self._alive(tree.node, tree.nodes, node.node[s], node.value[s], ITEM_LEAF * FAN)
            if not live.any():
                continue
            under = np.repeat(live, FAN)[: tree.leaves]
            for e in range(d * FAN, min((d + 1) * FAN, n_leaves)):
                s = slice(leaf.start[e], leaf.start[e + 1])
                open_ = under & self._alive(tree.leaf, tree.leaves, leaf.node[s], leaf.value[s], ITEM_LEAF)
                self.pairs += tree.leaves
                if open_.any():
                    self.opened += int(open_.sum())
                    self._leaf(ids, row, term, impact, slice(ends[e], ends[e + 1]), e * DOC_LEAF, np.repeat(open_, ITEM_LEAF)[: tree.n])
            self._keep()

    def _alive(self, postings: _Postings, n: int, term: np.ndarray, value: np.ndarray, items: int) -> np.ndarray:
        _, node, product = postings.meet(term, value, term)
        bound = np.bincount(node, product.astype(np.float64), n) * (1 + 1e-9)  # doubles may round a sum down
        return bound >= _least(self.kth, items, n)

    def _leaf(self, ids, row, term, impact, s: slice, base: int, wanted: np.ndarray) -> None:
        r, item, product = self.tree.items.meet(term[s], impact[s], row[s] - base)
        ok = wanted[item]
        total = np.zeros((DOC_LEAF, self.tree.n), np.int64)
        np.add.at(total, (r[ok], item[ok]), product[ok])
        r, item = np.nonzero(total >= self.kth)
        self.item, self.score, self.doc = np.r_[self.item, item], np.r_[self.score, total[r, item]], np.r_[self.doc, ids[base + r]]

    def _keep(self) -> None:
        order = np.lexsort((self.doc, -self.score, self.item))
        self.item, self.score, self.doc = self.item[order], self.score[order], self.doc[order]
        first = np.searchsorted(self.item, np.arange(self.tree.n))
        at = np.arange(len(self.item)) - first[self.item]
        full = at == self.k - 1
        self.kth[self.item[full]] = np.maximum(self.kth[self.item[full]], self.score[full])
        ok = at < self.k
        self.item, self.score, self.doc = self.item[ok], self.score[ok], self.doc[ok]


def _search(index: DataFrame, tree: ItemTree, floor: np.ndarray, k: int) -> DataFrame:
    """(item, item_id, doc_id, score): the k best of each task that reach the items' floor."""
    held = index.sparkSession.sparkContext.broadcast((tree, floor))

    def run(batches):
        import pyarrow as pa

        tree, floor = held.value
        find, known = Search(tree, floor, k), tree.vocabulary
        ids, doc, term, impact = [], [], [], []

        def flush():
            if ids:
                find.forest(np.array(ids, np.int64), np.array(doc, np.int64), np.array(term, np.int64), np.array(impact, np.int64))
                for x in (ids, doc, term, impact):
                    x.clear()

        for b in batches:
            for i, m, words, counts in zip(*(c.to_pylist() for c in b.columns)):
                here = len(term)
                for w, c in zip(words, counts):
                    if (t := known.get(w)) is not None:
                        doc.append(len(ids))
                        term.append(t)
                        impact.append(1_000_000_000 * c // (1000 * c + 12 * m))
                if len(term) > here:
                    ids.append(i)
                    if len(ids) >= FOREST:
                        flush()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([tree.keys[i] for i in find.item], pa.string()), pa.array([tree.ids[i] for i in find.item], pa.int64()), pa.array(find.doc, pa.int64()), pa.array(find.score, pa.int64())], ["item", "item_id", "doc_id", "score"])

    return index.select("id", "m", "terms", "counts").mapInArrow(run, "item string, item_id long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, equal scores by doc_id."""
    key = F.sha2(F.concat_ws("\0", F.coalesce(F.col(item_id).cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))), 256)
    own = items.select(F.col(item_id).cast("long").alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), key.alias("item")).dropDuplicates(["item"])
    rows = own.withColumn("row", F.xxhash64("item"))
    spread = _counted(rows, "row", "text").select(F.col("id").alias("row"), F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    asked = stage(spread.select("row", F.col("x.terms").alias("term"), F.col("x.counts").alias("q")).join(rows.select("row", "item", "item_id"), "row"), "search-items")
    index = stage(_counted(docs, doc_id, text, _bitmap(asked)), "search-index")
    n, total = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    size = asked.count()
    df = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(F.log((2.0 * n + 2) / (2 * F.col("df") + 1)) * 1000).cast("long")
    blocks = max(1, -(-size // BLOCK_TERMS))
    weighed = stage(asked.join(df, "term").select("item", "item_id", "term", (F.col("q") * weight).alias("w"), F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")).where("w > 0"), "search-weights")
    index = index.where("id is not null and n > 0 and size(terms) > 0").withColumn("m", F.expr(f"75 + (25 * n * {n}L) div {max(total, 1)}L"))
    some = index.where(F.pmod(F.xxhash64("id"), F.lit(max(1, n // SEEDS))) == 0)
    found = None
    for b in range(blocks):
        tree = ItemTree([tuple(r) for r in weighed.where(F.col("block") == b).drop("block").select("item", "item_id", "term", "w").collect()])
        floor = np.zeros(tree.n, np.int64)
        if n > 2 * SEEDS:
            place = {key: i for i, key in enumerate(tree.keys)}
            for r in _best(_search(some, tree, floor, k), k).where(F.col("rank") == k).select("item", "score").collect():
                floor[place[r["item"]]] = r["score"]
        part = _search(index, tree, floor, k)
        found = part if found is None else found.unionByName(part)
    return _best(found, k).select("item_id", "rank", "doc_id", "score")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of each benchmark item."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
