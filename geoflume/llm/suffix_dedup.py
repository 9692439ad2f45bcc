"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

The suffixes of all texts are ordered only through their first `window` bytes,
most significant digit first. The first digit of a suffix is the minimiser of
its window: the least hash of a fixed-length gram, leftmost on ties, which
equal windows share at the same place. Suffixes whose minimiser is alone in
the corpus need no further pass. The others are dealt out by minimiser, and the
next digits, two 64-bit hashes of the window's halves, order each bucket;
groups equal in all digits are the repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoflume.llm.common import mix64, stage, texts

#: Bytes of the gram that a minimiser hashes, as a share of the window.
GRAM = 4
#: Owners that one task compares at once; a minimiser with more is split by the next digit.
HOT = 4096
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MUL2 = np.uint64(0xD6E8FEB86659FD93)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))


class _Rolling:
    """Hashes of all grams of one length, for texts of any length."""

    def __init__(self, length: int, base: np.uint64):
        self.length, self.base, self.pow = length, base, _powers(1 << 12, base)
        self.inv = np.uint64(pow(int(base), -1, 1 << 64))
        self.ipow = _powers(1 << 12, self.inv)

    def of(self, t: np.ndarray) -> np.ndarray:
        n, k = len(t), self.length
        if len(self.pow) <= n:
            self.pow, self.ipow = _powers(2 * n, self.base), _powers(2 * n, self.inv)
        with np.errstate(over="ignore"):
            c = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[t] * self.pow[:n])])
            return (c[k:] - c[:-k]) * self.ipow[: n - k + 1]


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Least value of each run of w values."""
    done, m = 1, v
    while done * 2 <= w:
        m = np.minimum(m[: len(m) - done], m[done:])
        done *= 2
    rest = w - done
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def owners(t: np.ndarray, window: int, gram: _Rolling) -> tuple[np.ndarray, ...]:
    """(minimiser's hash, first window, windows, more than one place) of each run of windows that one minimiser owns; neighbours with equal hashes are one run."""
    h = mix64(gram.of(t))
    w = window - gram.length + 1
    m = _sliding_min((h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64), w)
    at = (m & np.uint64(0xFFFFFFFF)).astype(np.int64)
    key = h[at]
    first = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    moved = np.add.reduceat(np.concatenate([[0], at[1:] != at[:-1]]), first)
    moved[1:] -= 1  # the step into the run
    return key[first].view(np.int64), first, np.diff(np.concatenate([first, [len(at)]])), moved > 0


def _owner_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = _Rolling(window // GRAM, _MUL)
        for b in batches:
            out = []
            for r1, r2, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                t = np.frombuffer(x.as_buffer(), np.uint8)
                if len(t) >= window:
                    k, f, c, many = owners(t, window, gram)
                    out.append((k, np.full(len(k), r1, np.int64), np.full(len(k), r2, np.int64), f.astype(np.int32), c.astype(np.int32), many))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["key", "r1", "r2", "first", "n", "many"])

    return rows


_BUCKET = "key long, part int, r1 long, r2 long, first int, n int, data binary"
_RUN = "r1 long, r2 long, first int, n int"
#: Windows of hot minimisers that a task compares itself before it sends them.
_LOCAL = 200_000


def _batch(cols, kinds, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


_KINDS = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
_NAMES = ["key", "part", "r1", "r2", "first", "n", "data"]


def _bucket_rows(window: int):
    """r1, r2, text, runs [(key, first, n, parts)] -> bucket rows.

    A run of an ordinary minimiser is one row of part 0 with the bytes of its
    windows. Windows of a hot one are compared within the task first: repeated
    ones are rows of part -1, already known, and one of each goes on as digits
    and position, to the part that its digits name.
    """
    half = window // 2

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _Rolling(half, _MUL), _Rolling(window - half, _MUL2)
        hot: list[tuple] = []
        held = 0

        def compared() -> Iterator[pa.RecordBatch]:
            n = [len(x[4]) for x in hot]
            run = np.repeat(np.arange(len(hot)), n)
            key = np.repeat([x[0] for x in hot], n)
            parts = np.repeat([x[1] for x in hot], n).astype(np.uint64)
            pos, a, c = (np.concatenate([x[i] for x in hot]) for i in (4, 5, 6))
            order = np.lexsort((c, a, key))
            new = np.concatenate([[True], (key[order][1:] != key[order][:-1]) | (a[order][1:] != a[order][:-1]) | (c[order][1:] != c[order][:-1])])
            size = np.diff(np.concatenate([np.flatnonzero(new), [len(order)]]))
            twice = np.zeros(len(order), bool)
            twice[order] = np.repeat(size, size) > 1
            r1, r2 = (np.array([x[i] for x in hot], np.int64)[run] for i in (2, 3))
            if twice.any():
                out = list(_runs(r1[twice], r2[twice], pos[twice]))
                yield _batch([out[0], np.full(len(out[0]), -1), *out, [None] * len(out[0])], _KINDS, _NAMES)
            go = order[new]
            part = (mix64(a[go] ^ mix64(c[go])) % parts[go]).astype(np.int64) + 1
            go = go[np.lexsort((part, run[go]))]
            part = (mix64(a[go] ^ mix64(c[go])) % parts[go]).astype(np.int64) + 1
            cut = np.flatnonzero(np.concatenate([[True], (run[go][1:] != run[go][:-1]) | (part[1:] != part[:-1])]))
            ends = np.concatenate([cut[1:], [len(go)]])
            data = np.stack([a[go], c[go], pos[go].astype(np.uint64)], 1)
            yield _batch([key[go][cut], part[cut], r1[go][cut], r2[go][cut], np.zeros(len(cut), np.int32), ends - cut, [data[s:e].tobytes() for s, e in zip(cut, ends)]], _KINDS, _NAMES)

        for b in batches:
            out: list[tuple] = []
            for r1, r2, x, runs in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist()):
                t = memoryview(x.as_buffer())
                for r in runs:
                    ctx = t[r["first"] : r["first"] + r["n"] + window - 1]
                    if r["parts"] == 1:
                        out.append((r["key"], 0, r1, r2, r["first"], r["n"], bytes(ctx)))
                        continue
                    u = np.frombuffer(ctx, np.uint8)
                    hot.append((r["key"], r["parts"], r1, r2, np.arange(r["first"], r["first"] + r["n"]), one.of(u)[: r["n"]], two.of(u)[half : half + r["n"]]))
                    held += r["n"]
                if len(out) > 10_000:
                    yield _batch(zip(*out), _KINDS, _NAMES)
                    out = []
            if out:
                yield _batch(zip(*out), _KINDS, _NAMES)
            if held > _LOCAL:
                yield from compared()
                hot, held = [], 0
        if hot:
            yield from compared()

    return rows


def _runs(r1: np.ndarray, r2: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """Window positions, sorted within each text, as runs (r1, r2, first, n)."""
    s = np.flatnonzero(np.concatenate([[True], (r1[1:] != r1[:-1]) | (r2[1:] != r2[:-1]) | (pos[1:] != pos[:-1] + 1)]))
    return r1[s], r2[s], pos[s], np.diff(np.concatenate([s, [len(pos)]]))


def _repeat_rows(window: int):
    """Bucket rows, sorted by key and part -> runs of windows that are in two places at least."""
    half = window // 2

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = _Rolling(half, _MUL), _Rolling(window - half, _MUL2)

        def solve(g: list[tuple]) -> Iterator[pa.RecordBatch]:
            if len(g) < 2 and (g[0][1] or g[0][5] < 2):
                return
            pos, d1, d2 = [], [], []
            for _, part, _, _, first, n, data in g:
                if part:
                    u = np.frombuffer(data, np.uint64).reshape(n, 3)
                    d1.append(u[:, 0])
                    d2.append(u[:, 1])
                    pos.append(u[:, 2].astype(np.int64))
                else:
                    u = np.frombuffer(data, np.uint8)
                    d1.append(one.of(u)[:n])
                    d2.append(two.of(u)[half : half + n])
                    pos.append(np.arange(first, first + n))
            row = np.repeat(np.arange(len(g)), [len(x) for x in d1])
            a, c, at = np.concatenate(d1), np.concatenate(d2), np.concatenate(pos)
            order = np.lexsort((c, a))
            same = (a[order][1:] == a[order][:-1]) & (c[order][1:] == c[order][:-1])
            hit = np.zeros(len(a), bool)
            hit[order[1:][same]] = hit[order[:-1][same]] = True
            if hit.any():
                r1, r2 = (np.array([x[i] for x in g], np.int64)[row[hit]] for i in (2, 3))
                yield _batch(_runs(r1, r2, at[hit]), _KINDS[2:6], _NAMES[2:6])

        group: list[tuple] = []
        for b in batches:
            known: list[tuple] = []
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[1] < 0:
                    known.append(r[2:6])
                    continue
                if group and r[:2] != group[0][:2]:
                    yield from solve(group)
                    group = []
                group.append(r)
            if known:
                yield _batch(zip(*known), _KINDS[2:6], _NAMES[2:6])
        if group:
            yield from solve(group)

    return rows


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_KEPT = "r1 long, r2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _kept_rows(window: int):
    """r1, r2, text, number of copies, runs -> what stays of the text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for r1, r2, x, copies, runs in zip(*(b.column(i).to_pylist() for i in (0, 1)), b.column(2), *(b.column(i).to_pylist() for i in (3, 4))):
                t = memoryview(x.as_buffer())
                spans: list[list[int]] = [[0, len(t)]] if copies > 1 and len(t) >= window else []
                for first, n in sorted((r["first"], r["n"]) for r in runs or ()) if not spans else ():
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], first + n + window - 1)
                    else:
                        spans.append([first, first + n + window - 1])
                h, at = hashlib.sha256(), 0
                for s, e in spans:
                    h.update(t[at:s])
                    at = e
                h.update(t[at:])
                out.append((r1, r2, len(t), sum(e - s for s, e in spans), len(spans), h.hexdigest(), [{"start": s, "end": e} for s, e in spans]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), _SPANS)
            yield _batch(zip(*out) if out else [[]] * 7, kinds, ["r1", "r2", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return rows


def repeated_windows(docs: DataFrame, window: int = 400) -> DataFrame:
    """Bytes of each text that lie in a window of bytes which also starts elsewhere, in any row.

    docs: doc_id, text; other columns are ignored. Returns a row per input row:
    doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start, end in
    bytes). Null texts are empty; texts shorter than the window lose nothing;
    repeated rows lose all if they are long enough, as each window is in both.
    A null doc_id is kept. An empty table gives no rows.
    """
    # a text is addressed by 128 bits of hash; of its copies one goes through the passes
    t = texts(docs).select("doc_id", F.xxhash64("text").alias("r1"), F.xxhash64(F.lit(7), "text").alias("r2"), "text")
    whole = t.groupBy("r1", "r2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    runs = t.select("r1", "r2", "text").mapInArrow(_owner_rows(window), "key long, " + _RUN + ", many boolean")
    w = Window.partitionBy("key")
    place = F.struct("r1", "r2", "first")
    runs = runs.withColumn("lo", F.min(place).over(w)).withColumn("hi", F.max(place).over(w)).withColumn("g", F.count("*").over(w))
    # the windows of a minimiser in one place all differ
    runs = runs.where((F.col("lo") < F.col("hi")) | F.col("many"))
    runs = runs.groupBy("r1", "r2").agg(F.collect_set(F.struct("key", "first", "n", F.ceil(F.col("g") / HOT).cast("int").alias("parts"))).alias("runs"))
    buckets = whole.join(runs, ["r1", "r2"]).select("r1", "r2", "text", "runs").mapInArrow(_bucket_rows(window), _BUCKET)
    found = buckets.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(_repeat_rows(window), _RUN)
    found = stage(found, "suffix-repeats").groupBy("r1", "r2").agg(F.collect_set(F.struct("first", "n")).alias("found"))
    kept = whole.join(found, ["r1", "r2"], "left").select("r1", "r2", "text", "copies", "found").mapInArrow(_kept_rows(window), _KEPT)
    return t.select("doc_id", "r1", "r2").join(kept, ["r1", "r2"]).drop("r1", "r2")


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return repeated_windows(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")
