"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question whose values
were changed keeps its template. Windows of template tokens are hash-joined
between items and documents; matched windows are chained in order over
neighbouring diagonals, as an inserted or removed word shifts what follows it.
The item's tokens that the chain covers count, and the slots it holds must map
item values to document values one to one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoflume.llm.common import stage, texts

#: Tokens of a window; the share of an item's tokens that a document must hold in one chain of windows.
WINDOW, COVERAGE = 8, 0.6
#: Plain tokens that a window needs for its values to differ between item and document.
MIN_PLAIN = 2
#: Tokens by which a chain may shift from one of its runs to the next.
SHIFT = 8
#: Item windows up to which the windows are broadcast (16 MB); beyond, they are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000
#: Lower-case words of the benchmark up to which they are broadcast; beyond, each text is joined to those of its own that it needs.
BROADCAST_WORDS = 1_000_000
#: Words that stand for units of measure.
_UNITS = frozenset(
    "mm cm m km mg g kg t ml l s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years "
    "inch inches ft foot feet yd yard yards mile miles mph kmh lb lbs oz pound pounds ounce ounces gram grams kilogram kilograms meter meters metre metres "
    "kilometer kilometers kilometre kilometres centimeter centimeters liter liters litre litres dollar dollars euro euros cent cents usd eur percent degree degrees".split()
)
#: Words that belong to the number before them.
_SCALES = frozenset("hundred hundreds thousand thousands million millions billion billions trillion trillions dozen".split())
#: Numbers in words.
_NUMBERS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10,
    "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19,
    "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90,
}
#: Leading bits of a window's hash that a task looks up before the hash itself.
FILTER_BITS = 22
_SHIFT = np.uint64(64 - FILTER_BITS)
_TOKEN = re.compile(r"[.!?\n:;|\"]|[$€£%°]|\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*")
_NUM, _NAME, _UNIT = (np.uint64(x) for x in (11, 13, 17))  # hashes of words are far above


#: Hashes of words that one Python worker keeps: marks that end a sentence are 0, capitalised words are odd, others even.
CACHE = 300_000
_BREAKS = dict.fromkeys(".!?\n:;|\"", 0)
_words: dict[str, int] = dict(_BREAKS)


def _word_hash(w: str) -> int:
    """The hash of a word in lower case, above those of placeholders and even."""
    return xxhash.xxh3_64_intdigest(w.lower()) & ~1 | 1 << 63


def _figures(run: str) -> str:
    """A run of number tokens with its words as figures: `twenty five million` is `25 million`."""
    out: list[str] = []
    tens = False
    for w in run.split(" "):
        v = _NUMBERS.get(w)
        if v is not None and 0 < v < 10 and tens:
            out[-1] = str(int(out[-1]) + v)
        elif w != "and":
            out.append(w if v is None else str(v))
        tens = v is not None and v >= 20
    return " ".join(out)


def canonical(text: str, plain: frozenset[str] | None = None) -> tuple[np.ndarray, list[str | None]]:
    """Hashes of the template's tokens, and the value of each placeholder (None for plain words).

    A name is a capitalised word, at the start of a sentence only if it isn't
    one of the words in `plain` (without them, never there); texts whose words
    are mostly in upper case are shouting and have no names. A run of names, or
    of numbers and the words of scale after them, is one placeholder. Numbers in
    words are numbers, with their figures as values.
    """
    if len(_words) > CACHE:
        _words.clear()
        _words.update(_BREAKS)
    toks = _TOKEN.findall(text)
    hashes = list(map(_words.get, toks))
    slots: dict[int, str] = {}
    spelled = False
    for i in [i for i, h in enumerate(hashes) if h is None] if None in hashes else ():
        w = toks[i]
        if w[0].isdigit():
            hashes[i], slots[i] = int(_NUM), w
        elif w in "$€£%°" or w.lower() in _UNITS:
            hashes[i], slots[i] = int(_UNIT), w.lower()
        elif w.lower() in _NUMBERS:
            hashes[i], slots[i], spelled = int(_NUM), w.lower(), True
            if i - 2 in slots and toks[i - 1] == "and" and toks[i - 2].lower() in _SCALES:
                hashes[i - 1], slots[i - 1] = int(_NUM), "and"
        elif w.lower() in _SCALES:
            number = i and hashes[i - 1] == int(_NUM)
            hashes[i] = int(_NUM) if number else _word_hash(w)
            if number:
                slots[i] = w.lower()
        else:
            hashes[i] = _words[w] = _word_hash(w) | w[0].isupper()
    h = np.array(hashes, np.uint64)
    word = np.flatnonzero(h)
    caps = np.flatnonzero(h > np.uint64(1 << 63)) if len(h) else word
    caps = caps[(h[caps] & np.uint64(1)) == 1].tolist()
    h[caps] &= ~np.uint64(1)
    if sum(toks[i].isupper() and len(toks[i]) > 1 for i in caps) * 2 <= len(word):
        names = [i for i in caps if i and h[i - 1] or plain is not None and toks[i].lower() not in plain]
        slots |= {i: toks[i] for i in names}
        h[names] = _NAME
    drop = []
    for i in sorted(slots, reverse=True):
        if i - 1 in slots and h[i] == h[i - 1] and h[i] != _UNIT:
            slots[i - 1] += " " + slots.pop(i)
            drop.append(i)
    if drop:
        h[drop] = 0
        word = np.flatnonzero(h)
    if spelled:
        slots = {i: _figures(v) if h[i] == _NUM else v for i, v in slots.items()}
    values: list[str | None] = [None] * len(word)
    for i, k in zip(slots, np.searchsorted(word, list(slots)).tolist()):
        values[k] = slots[i]
    return h[word], values


def plain_words(text: str) -> set[str]:
    """Words that text has in lower case."""
    return {w for w in _TOKEN.findall(text) if w[0].islower()}


def _capital_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, word) of each text with the hashes a and b: its distinct capitalised words, in lower case."""
    for b in batches:
        out = []
        for x, y, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
            out += ((x, y, w) for w in {w.lower() for w in _TOKEN.findall(t.as_py().decode("utf-8", "replace")) if w[0].isupper()})
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 3, (pa.int64(), pa.int64(), pa.string()))], ["a", "b", "word"])


def _with_plain(t: DataFrame, words: DataFrame) -> DataFrame:
    """t (doc_id, text) with the words of `words` that the text has as capitalised ones."""
    t = t.select("doc_id", F.xxhash64("text").alias("a"), F.xxhash64(F.lit(7), "text").alias("b"), "text")
    has = t.mapInArrow(_capital_rows, "a long, b long, word string").distinct().join(words, "word").groupBy("a", "b").agg(F.collect_set("word").alias("plain"))
    return t.join(has, ["a", "b"], "left").select("doc_id", "text", F.coalesce("plain", F.array().cast("array<string>")).alias("plain"))


def _plain_of(b: pa.RecordBatch, plain) -> Iterator:
    """The plain words for each row: the broadcast ones, or the row's own."""
    return repeat(plain.value, b.num_rows) if plain is not None else (frozenset(x.as_py()) for x in b.column(2))


def window_size(n: int, size: int) -> int:
    """Tokens of the windows of an item of n tokens: so few that the windows beside one changed word still cover COVERAGE of it."""
    return n if n < size else min(size, max(3, int(n * (1 - COVERAGE))))


def windows(h: np.ndarray, values: list[str | None], sizes: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(size, hash of every window of so many template tokens) for each of the sizes, which rise; none where the text is shorter.

    A window with fewer than MIN_PLAIN plain tokens says little about a question, so its values are part of its hash.
    """
    if not len(h) or not sizes:
        return
    plain = np.concatenate([[0], np.cumsum((h != _NUM) & (h != _NAME) & (h != _UNIT))])
    s = np.full(len(h) + 1, np.uint64(1))
    with np.errstate(over="ignore"):
        for k in range(1, min(sizes[-1], len(h)) + 1):
            s = s[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[k - 1 :]
            if k in sizes:
                out = s
                few = np.flatnonzero(plain[k:] - plain[:-k] < MIN_PLAIN)
                if len(few):
                    out = s.copy()
                    out[few] ^= np.array([xxhash.xxh3_64_intdigest("\0".join(v or "" for v in values[i : i + k]).lower()) | 1 for i in few.tolist()], np.uint64)
                yield k, out


_ITEM = "item_id long, w long, at int, size int, n int, slots array<string>"


def _plain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = set().union(*(plain_words(t.as_py().decode("utf-8", "replace")) for t in b.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(words), pa.string())], ["word"])


def _item_rows(size: int, plain):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i, t, known in zip(b.column(0).to_pylist(), b.column(1), _plain_of(b, plain)):
                h, values = canonical(t.as_py().decode("utf-8", "replace"), known)
                k = window_size(len(h), size)
                for _, w in windows(h, values, [k] if i is not None else []):
                    out += ((i, x, at, k, len(h), values[at : at + k]) for at, x in enumerate(w.view(np.int64).tolist()))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 6, kinds)], ["item_id", "w", "at", "size", "n", "slots"])

    return rows


def _doc_rows(sizes: list[int], held, plain):
    """Windows of texts, of each size that items have: (doc_id, row, w, at, slots); with `held` only those it holds."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if held is None else held.value
        if known is not None:
            near = np.zeros(1 << FILTER_BITS, bool)
            near[(known >> _SHIFT).astype(np.int64)] = True
        for b in batches:
            out: list[tuple] = []
            for i, t, lower in zip(b.column(0).to_pylist(), b.column(1), _plain_of(b, plain)):
                raw = t.as_py()
                h, values = canonical(raw.decode("utf-8", "replace"), lower)
                key = xxhash.xxh3_64_intdigest(raw) - (1 << 63)
                for k, w in windows(h, values, sizes):
                    if known is None:
                        hits = range(len(w))
                    else:
                        hits = np.flatnonzero(near[w >> _SHIFT])
                        hits = hits[np.take(known, np.searchsorted(known, w[hits]), mode="clip") == w[hits]] if len(known) else ()
                    out += ((i, key, int(w[p].view(np.int64)), int(p), values[p : p + k]) for p in hits)
                if len(out) > 50_000:
                    yield _doc_batch(out)
                    out = []
            if out:
                yield _doc_batch(out)

    return rows


def _doc_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc_id", "text_key", "w", "pos", "doc_slots"])


def consistent_share(pairs: list[tuple[str, str]]) -> float:
    """Share of slots that agree with the commonest one-to-one mapping of item values to document values; 1 without slots."""
    if not pairs:
        return 1.0
    count = Counter(pairs)
    left: set[str] = set()
    right: set[str] = set()
    kept = 0
    for (a, b), n in sorted(count.items(), key=lambda x: (-x[1], x[0])):
        if a not in left and b not in right:
            left.add(a)
            right.add(b)
            kept += n
    return kept / len(pairs)


_MATCH = "doc_id long, text_key long, item_id long, coverage double, slot_consistency double, reparameterised boolean"


def best_chain(rows: list[tuple]) -> tuple[float, float, bool]:
    """(coverage, consistency, whether a value differs) of the best chain of the matched windows (diagonal, at, n, slots, doc_slots), in order."""
    runs: list[list] = []  # diagonal, first token, end, (item value, document value) of each token
    for diag, at, _, slots, doc_slots in rows:
        if not runs or runs[-1][0] != diag or at > runs[-1][2]:
            runs.append([diag, at, at, []])
        run = runs[-1]
        new = at + len(slots) - run[2]
        run[3] += list(zip(slots, doc_slots))[len(slots) - new :] if new > 0 else []
        run[2] += max(0, new)
    runs.sort(key=lambda r: (r[1], r[0]))
    by_diag: dict[int, list[int]] = {}
    covered, before, skipped = [], [], []
    for k, (diag, start, end, _) in enumerate(runs):
        best = (end - start, -1, 0)
        for d in range(diag - SHIFT, diag + SHIFT + 1):
            for i in by_diag.get(d, ()):
                skip = max(0, runs[i][2] - start, runs[i][2] + d - start - diag)
                if runs[i][1] < start and runs[i][1] + d < start + diag and skip < end - start:
                    best = max(best, (covered[i] + end - start - skip, i, skip))
        covered.append(best[0])
        before.append(best[1])
        skipped.append(best[2])
        by_diag.setdefault(diag, []).append(k)
    top, found = max(covered), []
    for k in (k for k, c in enumerate(covered) if c == top):
        pairs: list[tuple[str, str]] = []
        while k >= 0:
            pairs += [(a, b) for a, b in runs[k][3][skipped[k] :] if a is not None and b is not None]
            k = before[k]
        found.append((top / rows[0][2], consistent_share(pairs), any(a != b for a, b in pairs)))
    return max(found)


def _match_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (doc_id, text_key, item_id, diagonal, at, n, slots, doc_slots) -> the best chain of each document and item."""

    def best(rows: list[tuple]) -> tuple:
        return (*rows[0][:3], *best_chain([r[3:] for r in rows]))

    held: list[tuple] = []
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_())
    names = [x.split()[0] for x in _MATCH.split(", ")]
    for b in batches:
        out = []
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if held and r[:3] != held[0][:3]:
                out.append(best(held))
                held = []
            held.append(r)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*[best(held)]), kinds)], names)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, consistency: float = 0.75, broadcast_windows: int = BROADCAST_WINDOWS, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """Documents that hold a benchmark item's template: doc_id, text_key (hash of the text), item_id, coverage, slot_consistency, reparameterised.

    docs: doc_id, text; benchmark: item_id, text; other columns are ignored. A
    row per pair of which the document holds `coverage` of the item's tokens
    in one chain of windows and whose slots map one to one in `consistency` of the
    places; reparameterised tells whether a value differs. Items shorter than
    the window are one window; where next to all of a window is placeholders, its values must be equal. Null and blank texts and rows without an id of
    an item match nothing; repeated rows give equal pairs once. On ties the
    more consistent chain counts. Empty tables give no rows.
    """
    spark = docs.sparkSession
    words = stage(texts(benchmark, "item_id").mapInArrow(_plain_rows, "word string").distinct(), "bench-words")
    few = words.count() <= broadcast_words
    plain = spark.sparkContext.broadcast(frozenset(r.word for r in words.collect())) if few else None
    read = (lambda t: t) if few else lambda t: _with_plain(t, words)
    items = stage(read(texts(benchmark, "item_id")).mapInArrow(_item_rows(window, plain), _ITEM), "bench-windows")
    sizes = sorted(r.size for r in items.select("size").distinct().collect())  # at most `window` of them
    held = None
    if items.count() <= broadcast_windows:
        held = spark.sparkContext.broadcast(np.unique(np.array([r.w for r in items.select("w").distinct().collect()], np.int64).view(np.uint64)))
    d = read(texts(docs)).mapInArrow(_doc_rows(sizes, held, plain), "doc_id long, text_key long, w long, pos int, doc_slots array<string>")
    j = d.join(items, "w").where("size(slots) = size(doc_slots)").select("doc_id", "text_key", "item_id", (F.col("pos") - F.col("at")).alias("diagonal"), "at", "n", "slots", "doc_slots")
    j = j.repartition("doc_id", "text_key", "item_id").sortWithinPartitions("doc_id", "text_key", "item_id", "diagonal", "at")
    return j.mapInArrow(_match_rows, _MATCH).where((F.col("coverage") >= coverage) & (F.col("slot_consistency") >= consistency))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs that match no benchmark item, with all their columns."""
    found = stage(matches(docs, benchmark, **options).select(F.col("doc_id").alias("__id")).distinct(), "bench-found")
    return docs.join(F.broadcast(found) if found.count() <= 100_000 else found, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left_anti")


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    """A row per document: whether it holds a benchmark item, the best item and how it matches."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    m = stage(matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "bench-matches")
    best = m.groupBy(F.col("doc_id").alias("m_id")).agg(F.count("*").alias("n_items"), F.max_by(F.struct("item_id", "coverage", "slot_consistency", "reparameterised"), F.struct("coverage", "slot_consistency", -F.col("item_id"))).alias("b"))
    out = docs.select("doc_id").join(best, F.col("doc_id").eqNullSafe(F.col("m_id")), "left")
    return out.select("doc_id", F.col("m_id").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "b.item_id", "b.coverage", "b.slot_consistency", "b.reparameterised")
