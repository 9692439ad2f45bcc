"""Brown class-based bigram model scored over a corpus.

Units are the commonest words, each by itself, and groups of all other words by
a hash of their last bytes, so that every word's class is known from the word.
Exchange clustering over the units' bigram counts (a matrix of fixed size)
assigns units to classes. Then each further common word leaves its group for the
class that its own neighbours' classes make likeliest, one exchange step against
fixed classes, taken where the word's counts meet. P(w | prev) = P(class(w) |
class(prev)) P(w | class(w)), with the same additive smoothing per class as the
base model.

Texts are turned into numbers of common words once, as a table in the shared
folder. Counts of common words are dense arrays; those of all others meet in one
shuffle by word, in which each task sends one row per distinct word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoflume.llm.common import stage, texts, words_of

#: Words kept as units and groups of the other words; words whose counts are dense arrays; classes besides that of the end.
UNIT_WORDS, UNIT_GROUPS, COMMON, CLASSES = 512, 512, 16_384, 64
ALPHA, BETA = 0.1, 1.0
#: Tokens after which a task sends what it has counted.
FLUSH = 3_000_000
_UNITS = UNIT_WORDS + UNIT_GROUPS


def held_out(col: str = "doc_id"):
    return F.coalesce(F.expr(f"crc32(cast({col} as string)) % 10 = 0"), F.lit(True))


def _group(word: bytes) -> int:
    return UNIT_WORDS + zlib.crc32(word.rstrip(b".,;:!?")[-3:]) % UNIT_GROUPS


class _Units:
    """word -> its number among the common words, or -1 - its group's unit."""

    def __init__(self, common: list[bytes]):
        self.common = {w: i for i, w in enumerate(common)}
        self.known: dict[bytes, int] = {}
        self.unit = np.array([i if i < UNIT_WORDS else _group(w) for i, w in enumerate(common)] or [0], np.int64)

    def of(self, words: list[bytes]) -> np.ndarray:
        common, known, out = self.common, self.known, []
        if len(known) > 300_000:
            known.clear()
        for w in words:
            i = common.get(w)
            if i is None:
                i = known.get(w)
                if i is None:
                    i = known[w] = -1 - _group(w)
            out.append(i)
        return np.array(out, np.int64)


def _top_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count: Counter = Counter()
    seen = 0

    def out() -> pa.RecordBatch:
        top = count.most_common(COMMON + COMMON // 4)
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    for b in batches:
        for t in b.column(1):
            words = words_of(t.as_py())
            count.update(words)
            seen += len(words)
        if seen > FLUSH:
            yield out()
            count, seen = Counter(), 0
    yield out()


def _id_rows(common):
    """Each text as numbers of its words: int32 values, -1 - its group's unit where a word isn't common."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _Units(common.value)
        for b in batches:
            ids = [units.of(words_of(t.as_py())).astype("<i4").tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), pa.array(ids, pa.binary())], ["doc_id", "row_key", "learn", "ids"])

    return rows


def _ids(x) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), "<i4")


def _units_of(idx: np.ndarray) -> np.ndarray:
    """The unit of each word; common words beyond the first UNIT_WORDS are told apart as units after those of the groups."""
    return np.where(idx < 0, -1 - idx, np.where(idx < UNIT_WORDS, idx, idx + _UNITS - UNIT_WORDS + 1))


def _stream(column) -> np.ndarray:
    """Texts as one sequence of units; the end, which also starts it, is unit _UNITS."""
    end = np.array([_UNITS])
    return np.concatenate([end, *(y for t in column for y in (_units_of(_ids(t)), end))])


def _bigram_rows(common):
    """(a, b, n): counts of unit bigrams, and with b = -1 of common words; common words count as their groups in bigrams."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = _Units(common.value).unit
        pairs = np.zeros((_UNITS + 1) ** 2, np.int64)
        words_n = np.zeros(max(1, len(common.value)), np.int64)
        for b in batches:
            seqs = []
            for t in b.column(0):
                idx = _ids(t)
                words_n += np.bincount(idx[idx >= 0], minlength=len(words_n))
                seqs += [np.where(idx < 0, -1 - idx, unit[np.maximum(idx, 0)]), np.array([_UNITS])]
            if seqs:
                s = np.concatenate([[_UNITS], *seqs])
                pairs += np.bincount(s[:-1] * (_UNITS + 1) + s[1:], minlength=len(pairs))
        k, w = np.flatnonzero(pairs), np.flatnonzero(words_n)
        cols = [np.concatenate([k // (_UNITS + 1), w]), np.concatenate([k % (_UNITS + 1), np.full(len(w), -1)]), np.concatenate([pairs[k], words_n[w]])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b", "n"])

    return rows


def _neighbour_rows(held):
    """(word, at, n): for each common word that isn't a unit, how often a class follows it (at < k), precedes it (at < 2 k), and it follows itself (2 k)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, n_common, k = held.value
        first, width = _UNITS + 1, 2 * k + 1
        cells = np.zeros(max(0, n_common - UNIT_WORDS) * width, np.int64)
        for b in batches:
            s = _stream(b.column(0))
            c, before, after = cls[s], s[:-1], s[1:]
            w = np.flatnonzero(before >= first)
            at = [(before[w] - first) * width + c[1:][w]]
            w = np.flatnonzero(after >= first)
            at.append((after[w] - first) * width + k + c[:-1][w])
            w = np.flatnonzero((before == after) & (after >= first))
            at.append((after[w] - first) * width + 2 * k)
            cells += np.bincount(np.concatenate(at), minlength=len(cells)) if len(cells) else cells
        full = np.flatnonzero(cells)
        word = full // width
        start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(full) else np.empty(0, np.int64)
        ends = pa.array(np.concatenate([start, [len(full)]]), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (full % width, cells[full])] if len(full) else [pa.array([], pa.list_(pa.int64()))] * 2
        yield pa.RecordBatch.from_arrays([pa.array(word[start], pa.int64()), *lists], ["word", "at", "n"])

    return rows


def _class_rows(held):
    """(word, cls) of the words that a task has, from all their rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, n_common, k, g = held.value
        width = 2 * k + 1
        sums = np.zeros(max(0, n_common - UNIT_WORDS) * width)
        for b in batches:
            at, n, words = b.column(1), b.column(2), b.column(0).to_numpy()
            many = np.diff(at.offsets.to_numpy())
            np.add.at(sums, np.repeat(words, many) * width + at.flatten().to_numpy(), n.flatten().to_numpy())
        cells = sums.reshape(-1, width)
        have = np.flatnonzero(cells.any(1))
        made = [_best(g, cells[w, :k], cells[w, k : 2 * k], cells[w, 2 * k], int(cls[_UNITS + 1 + w])) for w in have]
        yield pa.RecordBatch.from_arrays([pa.array(have, pa.int64()), pa.array(made, pa.int64())], ["word", "cls"])

    return rows


def _pair_rows(held):
    """(a, b, n): counts of class bigrams."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, k = held.value
        pairs = np.zeros(k * k, np.int64)
        for b in batches:
            if b.num_rows:
                c = cls[_stream(b.column(0))]
                pairs += np.bincount(c[:-1] * k + c[1:], minlength=k * k)
        full = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (full // k, full % k, pairs[full])], ["a", "b", "n"])

    return rows


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def _gains(g: np.ndarray, right: np.ndarray, left: np.ndarray, own: float) -> np.ndarray:
    """What the bigram log likelihood of the class counts g gains if a unit that isn't in g joins each class."""
    f, fg, d = _xlogx, _xlogx(g), np.diag(g)
    rows, cols = g.sum(1) + left, g.sum(0) + right  # of the classes that it meets, whichever it joins
    out_n, in_n = right.sum() + own, left.sum() + own
    gain = (f(g + right) - fg).sum(1) + (f(g + left[:, None]) - fg).sum(0)
    gain += f(d + right + left + own) - f(d + right) - f(d + left) + f(d)
    gain -= f(rows + out_n) - f(rows) + f(cols + in_n) - f(cols)
    gain[-1] = -np.inf  # the end's class
    return gain


def _best(g: np.ndarray, right: np.ndarray, left: np.ndarray, own: float, old: int) -> int:
    """The class of a word that is counted in class old of g and may leave it; ties go to the old class."""
    g, right, left = g.copy(), right.copy(), left.copy()
    right[old] -= own
    left[old] -= own
    g[old] -= right
    g[:, old] -= left
    g[old, old] -= own
    gain = _gains(g, right, left, own)
    new = int(np.argmax(gain))
    return new if gain[new] > gain[old] + 1e-9 else old


def exchange(pairs: np.ndarray, classes: int, rounds: int = 8) -> np.ndarray:
    """Class of each unit: units move, commonest first, to the class that raises the bigram likelihood most.

    pairs[a, b] counts unit a before unit b; the last unit is the end and keeps a class of its own (number `classes`).
    """
    n = len(pairs) - 1
    m = pairs.astype(np.float64)
    freq = m.sum(0)
    order = np.argsort(-freq[:n], kind="stable")
    cls = np.empty(n + 1, np.int64)
    cls[order] = np.arange(n) % classes
    cls[n] = classes
    k = classes + 1
    hot = np.zeros((n + 1, k))
    hot[np.arange(n + 1), cls] = 1
    g = hot.T @ m @ hot
    for _ in range(rounds):
        moved = 0
        for u in order:
            if not freq[u] and not m[u].any():
                continue
            old, own = cls[u], m[u, u]
            right = np.bincount(cls, m[u], k)
            left = np.bincount(cls, m[:, u], k)
            right[old] -= own
            left[old] -= own
            g[old] -= right
            g[:, old] -= left
            g[old, old] -= own
            gain = _gains(g, right, left, own)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            g[new] += right
            g[:, new] += left
            g[new, new] += own
            cls[u] = new
            moved += new != old
        if not moved:
            break
    return cls


def _class_table(pairs: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 P(class | class before), and tokens of each class."""
    k = int(cls[-1]) + 1
    hot = np.zeros((len(cls), k))
    hot[np.arange(len(cls)), cls] = 1
    g = hot.T @ pairs @ hot
    size = g.sum(0)
    prior = (size + ALPHA) / (size.sum() + ALPHA * k)
    return np.log10((g + BETA * prior) / (g.sum(1, keepdims=True) + BETA)), size


_DOC = "doc_id long, row_key long, n_tokens long, common_tokens long, common_score double, transitions double, classes array<int>"


def _doc_rows(held):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts, cls, trans = held.value
        k = len(trans)
        log_counts = np.log10(counts + ALPHA) if len(counts) else np.zeros(1)
        for b in batches:
            out: list[tuple] = []
            for i, key, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                idx = _ids(t)
                c = np.concatenate([cls[_units_of(idx)], [k - 1]])
                top = idx[idx >= 0]
                out.append((i, key, len(idx) + 1, len(top), float(log_counts[top].sum()), float(trans[np.concatenate([[k - 1], c[:-1]]), c].sum()), np.bincount(c, minlength=k).tolist()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out) if out else [[]] * 7, kinds)], [x.split()[0] for x in _DOC.split(", ")])

    return rows


_WORD = "word long, cls int, n_train long, rows array<long>, times array<int>"


def _word_rows(held):
    """Each distinct word that isn't common: its count in training rows and the rows that have it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, _, cls, _ = held.value
        known = dict.fromkeys(common, True)
        parts: list[tuple] = []
        n = 0

        def out() -> Iterator[pa.RecordBatch]:
            word, unit, row, learn = (np.concatenate([p[i] for p in parts]) for i in range(4))
            order = np.lexsort((row, word))
            word, unit, row, learn = word[order], unit[order], row[order], learn[order]
            cell = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (row[1:] != row[:-1])]))
            times = np.diff(np.concatenate([cell, [len(word)]]))
            first = np.flatnonzero(np.concatenate([[True], word[cell][1:] != word[cell][:-1]]))
            n_train = np.add.reduceat(times * learn[cell], first)
            for s in range(0, len(first), 50_000):
                at = first[s : s + 50_001]
                end = at[-1] if len(at) > 50_000 else len(cell)
                at = at[:50_000]
                offsets = pa.array(np.concatenate([at, [end]]) - at[0], pa.int32())
                rows_ = pa.ListArray.from_arrays(offsets, pa.array(row[cell][at[0] : end], pa.int64()))
                times_ = pa.ListArray.from_arrays(offsets, pa.array(times[at[0] : end], pa.int32()))
                cols = [pa.array(word[cell][at]), pa.array(cls[unit[cell][at]].astype(np.int32)), pa.array(n_train[s : s + len(at)], pa.int64()), rows_, times_]
                yield pa.RecordBatch.from_arrays(cols, ["word", "cls", "n_train", "rows", "times"])

        for b in batches:
            for t, key, learn in zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist()):
                words = [w for w in words_of(t.as_py()) if w not in known]
                if words:
                    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)
                    u = np.fromiter(map(_group, words), np.int32, len(words))
                    parts.append((h, u, np.full(len(h), key, np.int64), np.full(len(h), learn, np.int8)))
                    n += len(h)
            if n > FLUSH // 2:
                yield from out()
                parts, n = [], 0
        if parts:
            yield from out()

    return rows


def score(docs: DataFrame, classes: int = CLASSES) -> DataFrame:
    """Score every text of docs (doc_id, text; other columns are ignored) by a model learned from rows that aren't held out.

    Returns a row per input row: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score and perplexity (of the model, per token).
    A null or blank text is its end token alone; repeated rows score the same
    and count as often as they occur; a row without doc_id is held out. Words
    are told apart by 64-bit hashes. An empty table gives no rows.
    """
    spark = docs.sparkSession
    t = texts(docs).select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"), (~held_out()).alias("learn"))
    train = t.where("learn").select("doc_id", "text")
    top = train.mapInArrow(_top_rows, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    common = [bytes(r.word) for r in top.orderBy(F.desc("n"), "word").limit(COMMON).collect()]
    sc = spark.sparkContext
    ids = stage(t.mapInArrow(_id_rows(sc.broadcast(common)), "doc_id long, row_key long, learn boolean, ids binary"), "brown-ids")
    learn = ids.where("learn").select("ids")
    cells = learn.mapInArrow(_bigram_rows(sc.broadcast(common)), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    got = cells.toArrow()  # (_UNITS + 1) ** 2 + COMMON rows at most
    a, b, n = (got.column(i).to_numpy() for i in range(3))
    pairs, counts = np.zeros((_UNITS + 1, _UNITS + 1)), np.zeros(len(common))
    pairs[a[b >= 0], b[b >= 0]] = n[b >= 0]
    counts[a[b < 0]] = n[b < 0]
    unit_cls = exchange(pairs, classes)
    k = classes + 1
    hot = np.eye(k)[unit_cls]
    # units, the end, then the common words that aren't units
    cls = np.concatenate([unit_cls, unit_cls[_Units(common).unit[UNIT_WORDS:]]])
    moves = learn.mapInArrow(_neighbour_rows(sc.broadcast((cls, len(common), k))), "word long, at array<long>, n array<long>")
    moves = moves.repartition("word").mapInArrow(_class_rows(sc.broadcast((cls, len(common), k, hot.T @ pairs @ hot))), "word long, cls long").toArrow()  # COMMON rows at most
    cls[_UNITS + 1 + moves.column(0).to_numpy()] = moves.column(1).to_numpy()
    got = learn.mapInArrow(_pair_rows(sc.broadcast((cls, k))), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()  # k * k rows at most
    g = np.zeros((k, k))
    g[got.column(0).to_numpy(), got.column(1).to_numpy()] = got.column(2).to_numpy()
    trans, size = _class_table(g, np.arange(k))
    known_types = np.bincount(cls[_units_of(np.arange(len(common)))], minlength=k)
    known_types[classes] = 1 if pairs.any() else 0
    held = sc.broadcast((common, counts, cls, trans))

    by_doc = ids.select("doc_id", "row_key", "ids").mapInArrow(_doc_rows(held), _DOC)
    w = Window.partitionBy("word")
    words = t.mapInArrow(_word_rows(held), _WORD)
    words = words.withColumn("c", F.sum("n_train").over(w)).withColumn("nth", F.row_number().over(w.orderBy("cls")))
    types = words.where("nth = 1 and c > 0").groupBy("cls").agg(F.count("*").alias("v"))
    types = types.agg(F.map_from_entries(F.collect_list(F.struct("cls", "v"))).alias("types"))
    cell = words.select("c", F.explode(F.arrays_zip("rows", "times")).alias("x")).select("c", F.col("x.rows").alias("row_key"), F.col("x.times").alias("times"))
    rare = cell.groupBy("row_key").agg(F.sum(F.col("times") * F.log10(F.col("c") + ALPHA)).alias("rare_score"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"))

    total = float(size.sum())
    same = F.count("*").over(Window.partitionBy("row_key"))  # equal rows meet in the sums above
    ends = float(np.log10(size[classes] + ALPHA))
    vocab = F.array(*[F.lit(int(v)) + F.coalesce(F.element_at("types", F.lit(k)), F.lit(0)) for k, v in enumerate(known_types)])
    logs = F.transform(F.arrays_zip(vocab.alias("v"), F.array(*[F.lit(float(s)) for s in size]).alias("n")), lambda x: F.log10(x["n"] + ALPHA * (x["v"] + 1)))
    one = types.select(logs.alias("logs"), F.aggregate(vocab, F.lit(0).cast("long"), lambda s, x: s + x).alias("v"))
    j = by_doc.withColumn("same", same).join(rare, "row_key", "left").crossJoin(F.broadcast(one))  # one row
    counted = F.col("common_score") + F.coalesce(F.col("rare_score") / F.col("same"), F.lit(0.0)) + F.lit(ends)
    emitted = F.aggregate(F.zip_with("classes", "logs", lambda c, x: c * x), F.lit(0.0), lambda s, x: s + x)
    j = j.withColumn("base_score", counted - F.col("n_tokens") * F.log10(F.lit(total) + ALPHA * (F.col("v") + 1))).withColumn("score", counted - emitted + F.col("transitions"))
    known = F.col("common_tokens") + F.coalesce(F.col("rare_known") / F.col("same"), F.lit(0)) + F.lit(1 if size[classes] else 0)
    return j.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", known.cast("long").alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def op3_brown_lm(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
