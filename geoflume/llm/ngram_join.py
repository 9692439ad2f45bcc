"""N-gram Jaccard join with PartEnum signatures.

A document's set holds its distinct word n-grams. Sets are dealt into bands of
similar size. Two linkable sets of a band differ in at most k elements; the
feature domain is cut into partitions of two cells each, so that of all subsets
that leave one cell of a partition out, more than a known number are equal in
both sets. Each set sends all but that number of its subsets, the least
telling ones first left out by a rank that depends on the subset alone, so
linkable sets share a signature.

Copies are collapsed before the join, and a task sends a signature once,
whatever number of its sets have it. Signatures with the same first and last
holder, or the same first holder and as many to a power of two, make one bucket. Within a bucket, parity sketches tell which sets can't
be linked; of the others each set names one partner first, and only sets that
are still in different components after that name more. Named pairs are
compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoflume.llm.common import connected_components, drop, mix64, stage, texts, words_of

#: Members of a bucket that are compared in one group; a larger one is split into parts of about this size.
PART = 2048
#: Documents up to which a list of ids is broadcast (8 bytes each); beyond, it is joined by shuffle.
BROADCAST_IDS = 500_000
#: Holders of a signature beyond which its bucket is that of its first holder and their magnitude.
SOME = 32
#: Signatures that a task sorts at once.
FLUSH = 1_000_000
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; with fewer words, of the whole sequence; none without words."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < n:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes() + b"short")], np.uint64)
    with np.errstate(over="ignore"):
        s = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            s = mix64(s * _K[0] + h[i : len(h) - n + 1 + i])
    return np.unique(s)


@cache
def _bands(num: int, den: int) -> list[tuple[int, int, int, int, int]]:
    """(smallest size, largest size of its core, largest size, cells, elements in which linkable sets differ at most) of each band."""
    out, low = [], 1
    while low < 1 << 40:
        core = max(low, int(low * (den / num) ** (3 if num / den > 0.85 else 2)) - 1)
        k = core * (den - num) // num
        out.append((low, core, core * den // num, 2 * (k // 2 + 1 + max(1, k // 8)), k))
        low = core + 1
    return out


def signatures(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """PartEnum signatures of a set of hashes, as signed 64-bit values.

    With c cells, linkable sets share c - k of them at least. Both leave out the
    c - k - 1 that rank lowest by size and hash, so the highest of the shared
    ones is sent by both. A band in which only equal sets link has none.
    """
    out = []
    with np.errstate(over="ignore"):
        for i, (low, _, high, cells, k) in enumerate(_bands(num, den)):
            if low > len(s):
                break
            if len(s) > high or not k:
                continue
            cell = (mix64(s ^ _K[2]) % np.uint64(cells)).astype(np.int64)
            v = mix64(s + _K[1])
            lo = np.bincount(cell, (v & np.uint64(0xFFFFFFFF)).astype(np.float64), cells).astype(np.uint64)
            hi = np.bincount(cell, (v >> np.uint64(32)).astype(np.float64), cells).astype(np.uint64)
            where = np.arange(cells, dtype=np.uint64) + np.uint64(i << 40)
            sig = mix64(mix64((hi << np.uint64(32)) + lo) ^ mix64(where + _K[2]))
            out.append(sig[np.lexsort((sig, np.bincount(cell, minlength=cells)))[cells - k - 1 :]])
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def sketch(s: np.ndarray, num: int, den: int) -> bytes:
    """Parity of the elements that hash to each bit: two sketches differ in no more bits than the sets in elements.

    There are eight times as many bits as elements in which linked sets of this size may differ, rounded up to a power of two.
    """
    bits = max(64, 1 << (16 * len(s) * (den - num) // (den + num)).bit_length())
    return np.packbits((np.bincount((mix64(s + _K[0]) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def _set_hash(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _set_rows(n: int, num: int, den: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, h1, h2, sk = [], [], [], []
            for t in b.column(1):
                s = shingles(t.as_py(), n)
                size.append(len(s))
                h1.append(_set_hash(s))
                h2.append(xxhash.xxh64_intdigest(s.tobytes(), 7) - (1 << 63))
                sk.append(sketch(s, num, den))
            cols = [b.column(0), *(pa.array(x, pa.int64()) for x in (size, h1, h2)), pa.array(sk, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_shingles", "h1", "h2", "sk"])

    return rows


def _starts(x: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def _signature_batch(sigs: list[np.ndarray], sets: list[int]) -> pa.RecordBatch:
    """A row per signature: who holds it, a set or, if several do, a group of sets, whose members come with its first signature."""
    sig = np.concatenate(sigs)
    holder = np.repeat(np.array(sets, np.int64), [len(x) for x in sigs])
    order = np.lexsort((holder, sig))
    sig, holder = sig[order], holder[order]
    start = _starts(sig)
    end = np.concatenate([start[1:], [len(sig)]])
    first, last = holder[start], holder[end - 1]
    many = np.flatnonzero(first != last)
    size = end - start
    # groups of some size often lack a member or two: the first one and the magnitude stand for them
    other = np.where(size[many] > SOME, np.log2(size[many]).astype(np.int64), last[many])
    with np.errstate(over="ignore"):
        group = mix64(mix64(first[many].view(np.uint64) + _K[0]) ^ other.view(np.uint64)).view(np.int64)
    holds = first.copy()
    holds[many] = group
    members: list[np.ndarray | None] = [None] * len(start)
    order = np.argsort(group, kind="stable")
    cut = _starts(group[order]) if len(order) else order
    for s, e in zip(cut, np.concatenate([cut[1:], [len(order)]]).tolist() if len(order) else ()):
        of = many[order[s:e]]
        members[of[0]] = np.unique(np.concatenate([holder[start[i] : end[i]] for i in of]))
    return pa.RecordBatch.from_arrays([pa.array(sig[start]), pa.array(holds), pa.array(members, pa.list_(pa.int64())), pa.array(first), pa.array(size, pa.int32())], ["sig", "grp", "members", "first", "size"])


def _signature_rows(n: int, num: int, den: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a copy within the task adds nothing
        sets, sigs, held = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                s = shingles(t.as_py(), n)
                if i is None or not len(s) or (key := _set_hash(s)) in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(key)
                x = signatures(s, num, den)
                if len(x):
                    sets.append(key)
                    sigs.append(x)
                    held += len(x)
                if held > FLUSH:
                    yield _signature_batch(sigs, sets)
                    sets, sigs, held = [], [], 0
        if held:
            yield _signature_batch(sigs, sets)

    return rows


def _shingle_rows(n: int):
    """(cls, text, h1) -> the set of the class; rows that bear its id but hold another set are left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t.as_py(), n) for t in b.column(1)]
            own = pa.array([_set_hash(s) == h for s, h in zip(sets, b.column(2).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], ["cls", "s"]).filter(own)

    return rows


def _linked(num: int, den: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                both = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)])
                both.sort()
                common = np.count_nonzero(both[1:] == both[:-1])
                keep.append(den * common >= num * (len(both) - common))
            yield batch.select([0, 1]).append_column("linked", pa.array(keep, pa.bool_()))

    return rows


class _Near:
    """Which sets of a bucket may be linked by their sizes and sketches."""

    def __init__(self, size: np.ndarray, sketches: list[bytes], num: int, den: int):
        self.size, self.num, self.den = size.astype(np.int64), num, den
        self.words = np.array([len(x) // 8 for x in sketches])
        self.by: dict[int, np.ndarray] = {}
        for w in np.unique(self.words).tolist():
            m = np.zeros((len(sketches), w), np.uint64)
            for v in np.unique(self.words[self.words >= w]).tolist():
                at = np.flatnonzero(self.words == v)
                x = np.frombuffer(b"".join(sketches[i] for i in at), np.uint64).reshape(len(at), v // w, w)
                m[at] = np.bitwise_xor.reduce(x, 1)  # a wider sketch folds to a narrower one
            self.by[w] = m

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """may[x, y]: whether i[x] and j[y] may be linked."""
        out = np.zeros((len(i), len(j)), bool)
        for w, m in self.by.items():
            for a, b in ((np.flatnonzero(self.words[i] == w), np.flatnonzero(self.words[j] >= w)), (np.flatnonzero(self.words[i] > w), np.flatnonzero(self.words[j] == w))):
                step = max(1, 2_000_000 // max(1, len(b) * w))
                for s in range(0, len(a) if len(b) else 0, step):
                    at = a[s : s + step]
                    p, q = self.size[i[at]][:, None], self.size[j[b]][None]
                    differ = np.zeros((len(at), len(b)), np.int64)
                    for k in range(w):
                        differ += np.bitwise_count(m[i[at], k][:, None] ^ m[j[b], k][None])
                    out[np.ix_(at, b)] = (differ * (self.num + self.den) <= (self.den - self.num) * (p + q)) & (self.den * np.minimum(p, q) >= self.num * np.maximum(p, q))
        return out


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Runs of rows with equal first columns."""
    held: list[tuple] = []
    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if held and r[:keys] != held[0][:keys]:
                yield held
                held = []
            held.append(r)
    if held:
        yield held


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for r in rows:
        out.append(r)
        if len(out) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


_ROW = ["bucket", "part", "cls", "n", "sk"]
_PARTNER = pa.schema([("bucket", pa.int64()), ("cls", pa.int64()), ("near", pa.int64())])
_NAMED = pa.schema([("bucket", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("more", pa.bool_())])


def _partner_rows(num: int, den: int):
    """bucket, part, cls, n, sk, split; sorted -> each member with the least partner that it may be linked to.

    Members without one are left out, unless the bucket was split and theirs may be in another part.
    """

    def named(group: list[tuple]) -> Iterator[tuple]:
        ids = [r[2] for r in group]
        if len(group) > 1:
            near = _Near(np.array([r[3] for r in group]), [r[4] for r in group], num, den)
            at = np.arange(len(group))
            to_first = near.of(at, at[:1])[:, 0]
            to_first[0] = False
            partner = np.where(to_first, 0, -1)
            rest = np.flatnonzero(~to_first)
            if len(rest):
                may = near.of(rest, at)
                may[np.arange(len(rest)), rest] = False
                partner[rest] = np.where(may.any(1), may.argmax(1), -1)
        else:
            partner = np.full(1, -1)
        for i, p in enumerate(partner.tolist()):
            if p >= 0 or group[i][5]:
                yield group[i][0], ids[i], ids[p] if p >= 0 else None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((x for g in _groups(batches, 2) for x in named(g)), _PARTNER)

    return rows


def _named_rows(num: int, den: int, most: int):
    """bucket, i, j, part, cls, label, n, sk; sorted -> pairs of members in different components that may be linked.

    A member outside the bucket's commonest component names `most` partners of each other component at most; `more` tells that it has others.
    """

    def pairs(group: list[tuple]) -> Iterator[tuple]:
        ids = np.array([r[4] for r in group])
        label = np.array([r[5] for r in group])
        part = np.array([r[3] for r in group])
        near = _Near(np.array([r[6] for r in group]), [r[7] for r in group], num, den)
        left = np.flatnonzero(part == group[0][1])
        right = np.flatnonzero(part == group[0][2])
        # the commonest component is compared with the others only
        kinds, times = np.unique(label, return_counts=True)
        l_most, r_most = label[left] == kinds[times.argmax()], label[right] == kinds[times.argmax()]
        may = np.zeros((len(left), len(right)), bool)
        may[~l_most] = near.of(left[~l_most], right)
        may[np.ix_(l_most, ~r_most)] = near.of(left[l_most], right[~r_most])
        may &= label[left][:, None] != label[right][None]
        if group[0][1] == group[0][2]:
            may &= left[:, None] < right[None]
        out: dict[tuple[int, int], bool] = {}
        for own, other, hits in ((left, right, may), (right, left, may.T)):
            for x in np.flatnonzero(hits.any(1) & (label[own] != kinds[times.argmax()])):
                hit = other[hits[x]]
                for k in np.unique(label[hit]).tolist():
                    named = hit[label[hit] == k]
                    for y in named[:most].tolist():
                        pair = min(ids[own[x]], ids[y]), max(ids[own[x]], ids[y])
                        out[pair] = out.get(pair, False) or len(named) > most
        for (a, b), more in out.items():
            yield group[0][0], int(a), int(b), more

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches((x for g in _groups(batches, 3) for x in pairs(g)), _NAMED)

    return rows


def _tiles(members: DataFrame) -> DataFrame:
    """members (bucket, cls, label, parts, ...) with the group (i, j) of each comparison that a member takes part in, and its own part.

    A bucket of one part is group (0, 0). In a larger one the members of the commonest component, in parts below 0, meet the
    others only: they go to each part of the others, so with few others they are sent once or twice however many they are.
    """
    n = members.where("parts > 1").groupBy("bucket", "label").agg(F.count("*").alias("n"))
    n = n.groupBy("bucket").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("common"), F.max("n").alias("most"), F.sum("n").alias("all"))
    n = n.select("bucket", "common", F.ceil(F.col("most") / PART).alias("c"), F.ceil((F.col("all") - F.col("most")) / PART).alias("o"))
    x = members.join(n, "bucket", "left").where("o is null or o > 0")
    h, same, zero = F.xxhash64("cls"), F.col("label") == F.col("common"), F.lit(0).cast("long")
    x = x.withColumn("part", F.when(F.col("o").isNull(), zero).when(same, -1 - F.pmod(h, F.col("c"))).otherwise(F.pmod(h, F.col("o"))))
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    others, commons = F.sequence(zero, F.col("o") - 1), F.sequence(zero, F.col("c") - 1)
    met = F.concat(F.transform(others, lambda k: pair(F.least("part", k), F.greatest("part", k))), F.transform(commons, lambda k: pair(-1 - k, F.col("part"))))
    groups = F.when(F.col("o").isNull(), F.array(pair(zero, zero))).when(same, F.transform(others, lambda k: pair(F.col("part"), k))).otherwise(met)
    return x.withColumn("at", F.explode(groups)).withColumns({"i": F.col("at.i"), "j": F.col("at.j")}).drop("at", "common", "c", "o")


def ngram_components(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Components of documents whose n-gram sets have Jaccard similarity of num / den at least.

    docs: doc_id, text; other columns are ignored. Returns a row per input row:
    doc_id, n_shingles, class_id (smallest doc_id with an equal set) and
    component_id. A null or blank text has an empty set and is alone; so is a
    row without doc_id, whose class and component are null. Repeated rows are
    copies of each other. An empty table gives no rows.
    """
    spark, t = docs.sparkSession, texts(docs)
    sets = stage(t.mapInArrow(_set_rows(n, num, den), "doc_id long, n_shingles long, h1 long, h2 long, sk binary"), "ngram-sets")
    full = sets.where("n_shingles > 0 and doc_id is not null")
    classes = stage(full.groupBy("h1", "h2").agg(F.min("doc_id").alias("cls"), F.first("n_shingles").alias("n"), F.first("sk").alias("sk")), "ngram-classes")

    w = Window.partitionBy("sig")
    sigs = t.mapInArrow(_signature_rows(n, num, den), "sig long, grp long, members array<long>, first long, size int")
    sigs = sigs.withColumn("lo", F.min("grp").over(w)).withColumn("hi", F.max("grp").over(w)).where("lo < hi or size > 1")
    sigs = sigs.withColumn("m", F.sum("size").over(w)).withColumn("least", F.min("first").over(w))
    bucket = F.when(F.col("m") > SOME, F.xxhash64("least", F.floor(F.log2("m")))).otherwise(F.xxhash64("lo", "hi"))
    shared = stage(sigs.select(bucket.alias("bucket"), "grp", "members"), "ngram-shared")
    members = shared.where("members is not null").select("grp", F.explode("members").alias("h1")).distinct()
    held = shared.select("bucket", "grp").distinct().join(members, "grp", "left").select("bucket", F.coalesce("h1", "grp").alias("h1")).distinct()
    ids = stage(held.join(classes.select("h1", "cls"), "h1").select("bucket", "cls").distinct(), "ngram-buckets")
    large = ids.groupBy("bucket").agg(F.count("*").alias("m"), F.min("cls").alias("first")).where(F.col("m") > PART).select("bucket", F.ceil(F.col("m") / PART).alias("parts"), "first")
    large = stage(large, "ngram-large")
    info = classes.select("cls", "n", "sk")
    own = F.pmod(F.xxhash64("cls"), F.col("parts"))
    where = F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).when(F.col("cls") == F.col("first"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array(own))
    placed = ids.join(large, "bucket", "left").select("bucket", "cls", F.col("parts").isNotNull().alias("split"), F.explode(where).alias("part")).join(info, "cls")
    placed = placed.select(*_ROW, "split").repartition("bucket", "part").sortWithinPartitions("bucket", "part", "cls")
    close = stage(placed.mapInArrow(_partner_rows(num, den), "bucket long, cls long, near long"), "ngram-close")
    drop(shared, ids)

    wanted = close.select("cls").union(close.select("near")).distinct().join(classes.select("cls", "h1"), "cls").select(F.col("cls").alias("doc_id"), "h1")
    wanted = stage(wanted, "ngram-wanted")
    texts_of = t.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted, "doc_id").select("doc_id", "text", "h1")
    shingled = stage(texts_of.mapInArrow(_shingle_rows(n), "cls long, s binary"), "ngram-shingles")

    def verified(pairs: DataFrame) -> DataFrame:
        x = pairs.where("a <> b").join(shingled.select(F.col("cls").alias("b"), F.col("s").alias("sb")), "b")
        x = x.join(shingled.select(F.col("cls").alias("a"), F.col("s").alias("sa")), "a").select("a", "b", "sa", "sb")
        return stage(x.mapInArrow(_linked(num, den), "a long, b long, linked boolean"), "ngram-pairs")

    first = close.where("near is not null").groupBy("cls").agg(F.min("near").alias("near"))
    tested = verified(first.select(F.least("cls", "near").alias("a"), F.greatest("cls", "near").alias("b")).distinct())
    most, members, go_on = 4, stage(close.select("bucket", "cls").distinct().join(large, "bucket", "left").select("bucket", "cls", F.coalesce("parts", F.lit(1).cast("long")).alias("parts")), "ngram-members"), None
    while True:
        parts = connected_components(tested.where("linked"))
        labels = parts.select(F.col("id").alias("cls"), F.col("component_id").alias("label"))
        left = stage(members.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls")), "ngram-left")
        if go_on is None:
            go_on = left.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("bucket")
        x = _tiles(left.join(go_on, "bucket", "left_semi").join(info, "cls")).select("bucket", "i", "j", "part", "cls", "label", "n", "sk")
        x = x.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "cls")
        named = stage(x.mapInArrow(_named_rows(num, den, most), "bucket long, a long, b long, more boolean"), "ngram-named")
        new = named.select("a", "b").distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti")
        last = verified(new)
        tested = tested.union(last)
        again = named.where("more")
        if again.isEmpty():
            break
        # a bucket whose members named all their partners in other components has no untested pair, now or later
        go_on = again.select("bucket").distinct()
        most *= 64
    if not last.where("linked").isEmpty():
        parts = connected_components(tested.where("linked"))
    drop(close, members, shingled, wanted)
    key = F.when(F.col("doc_id").isNotNull(), F.coalesce("cls", "doc_id")).alias("class_id")
    member = sets.select("doc_id", "n_shingles", "h1", "h2").join(classes.select("h1", "h2", "cls"), ["h1", "h2"], "left").select("doc_id", "n_shingles", key)
    parts = parts.select(F.col("id").alias("class_id"), F.col("component_id"))
    return member.join(parts, "class_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "class_id").alias("component_id"), "class_id")


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, num=9, den=10)
