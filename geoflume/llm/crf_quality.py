"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of itself and its
neighbours. In training a line carries its document's label. A document's
score is the mean of its lines' forward-backward marginals, weighted by
length, put through a logistic calibration fitted on the same sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoflume.llm.common import texts

#: Labelled documents that training reads at most, half of them of each label.
TRAIN_DOCS = 3000
#: Lines longer than this many bytes are measured and labelled in parts, so a text without line ends is a chain too.
LINE_BYTES = 2000


def lines_of(text: bytes) -> list[bytes]:
    out = []
    for line in text.split(b"\n"):
        if line.strip():
            out += [line[i : i + LINE_BYTES] for i in range(0, len(line), LINE_BYTES)] if len(line) > LINE_BYTES else [line]
    return out


_CLASS = np.zeros(256, np.int8)
for _c in range(256):
    _ch = chr(_c)
    _CLASS[_c] = 1 if "a" <= _ch <= "z" else 2 if "A" <= _ch <= "Z" else 3 if "0" <= _ch <= "9" else 4 if _c in b" \t\r\x0b\x0c" else 5 if _ch in ".,;:'-?" else 6 if _ch in "!|#$%&*+=<>[]{}~^_@\\/" else 0


def _own(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line by itself, and byte lengths."""
    n = len(lines)
    size = np.fromiter(map(len, lines), np.int64, n)
    buf = _CLASS[np.frombuffer(b"".join(lines), np.uint8)]
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    share = lambda k: np.add.reduceat((buf == k).astype(np.int64), starts) / size
    lower, upper, digit, space, mild, odd = (share(k) for k in range(1, 7))
    words = [x.split() for x in lines]
    count = np.maximum(1, np.fromiter(map(len, words), np.int64, n))
    distinct = np.fromiter((len(set(w)) for w in words), np.int64, n) / count
    seen: dict[bytes, int] = {}
    again = np.zeros(n)
    for i, x in enumerate(lines):
        again[i] = x in seen
        seen[x] = i
    f = np.stack([
        np.log1p(size) / 8, np.log1p(count) / 6, lower, upper, digit, space, mild, np.minimum(odd * 5, 1), (odd > 0.05).astype(float),
        size / count / 20, distinct, again, (upper > 0.4).astype(float), (distinct < 0.5) & (count > 12),
    ], 1)
    return f, size


def features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A row per line: its own features, those of the lines before and after, whether it is first or last, and 1."""
    own, size = _own(lines)
    zero = np.zeros((1, own.shape[1]))
    edge = np.zeros((len(own), 3))
    edge[0, 0] = edge[-1, 1] = edge[:, 2] = 1
    return np.hstack([own, np.vstack([zero, own[:-1]]), np.vstack([own[1:], zero]), edge]), size


def forward_backward(unary: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals (lines x 2), summed pair marginals (2 x 2) and log Z of a chain with log potentials."""
    n = len(unary)
    t = np.exp(trans - trans.max())
    top = unary.max(1, keepdims=True)
    e = np.exp(unary - top)
    a, b, scale = np.empty((n, 2)), np.ones((n, 2)), np.empty(n)
    cur = e[0]
    for i in range(n):
        if i:
            cur = (a[i - 1] @ t) * e[i]
        scale[i] = cur.sum()
        a[i] = cur / scale[i]
    for i in range(n - 2, -1, -1):
        b[i] = (t @ (e[i + 1] * b[i + 1])) / scale[i + 1]
    pairs = np.zeros((2, 2))
    if n > 1:
        pairs = np.einsum("ni,ij,nj->ij", a[:-1], t, e[1:] * b[1:] / scale[1:, None])
    return a * b, pairs, float(np.log(scale).sum() + top.sum() + (n - 1) * trans.max())


def _marginal_good(unary: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(good) of each line with plain floats: chains are mostly short."""
    n = len(unary)
    t00, t01, t10, t11 = np.exp(trans).ravel().tolist()
    r = np.exp(np.clip(unary[:, 1] - unary[:, 0], -50, 50)).tolist()
    fwd, q = [], r[0]
    for i in range(n):
        if i:
            q = (t01 + q * t11) / (t00 + q * t10) * r[i]
        q = min(max(q, 1e-30), 1e30)
        fwd.append(q)
    out, back = [0.0] * n, 1.0
    for i in range(n - 1, -1, -1):
        x = fwd[i] * back
        out[i] = x / (1 + x)
        back = (t10 + t11 * r[i] * back) / (t00 + t01 * r[i] * back)
        back = min(max(back, 1e-30), 1e30)
    return np.array(out)


def train(rows: list[tuple[bytes, int]], steps: int = 60, l2: float = 1e-3) -> dict:
    """Fit weights by gradient ascent with per-weight step sizes on the conditional likelihood of all chains.

    Chains of one label are weighted so that both labels count the same; without both labels a constant model results.
    """
    data = [(*features(x), int(y)) for t, y in rows if (x := lines_of(t))]
    total = [sum(len(f) for f, _, y in data if y == k) for k in (0, 1)]
    if not all(total):
        return {"w": None, "p": 1.0 if total[1] else 0.0 if total[0] else 0.5}
    flat = np.vstack([f for f, _, _ in data])
    mean, dev = flat.mean(0), flat.std(0)
    dev[dev < 1e-9] = 1
    mean[-1], dev[-1] = 0, 1
    weight = [sum(total) / 2 / t for t in total]
    starts = np.cumsum([0, *(len(f) for f, _, _ in data)])
    x = (flat - mean) / dev
    lab = np.repeat([y for _, _, y in data], np.diff(starts))
    cw = np.array(weight)[lab]
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    mom, var, n = 0.0, 0.0, cw.sum()
    true = np.zeros((2, 2))
    for (f, _, y) in data:
        true[y, y] += (len(f) - 1) * weight[y]
    for step in range(1, steps + 1):
        un = np.stack([np.zeros(len(x)), x @ w], 1)
        good, pairs = np.empty(len(x)), np.zeros((2, 2))
        for k, (f, _, y) in enumerate(data):
            m, p, _ = forward_backward(un[starts[k] : starts[k + 1]], trans)
            good[starts[k] : starts[k + 1]] = m[:, 1]
            pairs += p * weight[y]
        g = np.concatenate([x.T @ (cw * (lab - good)) / n - l2 * w, ((true - pairs) / n).ravel() - l2 * trans.ravel()])
        mom, var = 0.9 * mom + 0.1 * g, 0.99 * var + 0.01 * g * g
        move = 0.15 * (mom / (1 - 0.9**step)) / (np.sqrt(var / (1 - 0.99**step)) + 1e-8)
        w, trans = w + move[:-4], np.clip(trans + move[-4:].reshape(2, 2), -4, 4)
    model = {"w": w, "trans": trans, "mean": mean, "dev": dev, "cal": (1.0, 0.0)}
    s = np.array([_raw(model, f, size) for f, size, _ in data])
    y = np.array([y for _, _, y in data], float)
    dw = np.array([len(y) / 2 / max(1, (y == k).sum()) for k in (0, 1)])[y.astype(int)]
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(a * s + b)))
        a, b = max(0.05, a + 0.02 * (np.average((y - p) * s, weights=dw) - 0.01 * (a - 1))), b + 0.2 * np.average(y - p, weights=dw)
    model["cal"] = (float(a), float(b))
    return model


def _raw(model: dict, f: np.ndarray, size: np.ndarray) -> float:
    u = ((f - model["mean"]) / model["dev"]) @ model["w"]
    p = float(np.average(_marginal_good(np.stack([np.zeros(len(u)), u], 1), model["trans"]), weights=size))
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def score(model: dict, text: bytes) -> float:
    """0 to 1, higher: good likelier. Without lines 0, as nothing there is worth keeping."""
    if model["w"] is None:
        return float(model["p"])
    lines = lines_of(text)
    if not lines:
        return 0.0
    a, b = model["cal"]
    return 1 / (1 + math.exp(-(a * _raw(model, *features(lines)) + b)))


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> dict:
    """Learn from labelled rows whose crc32(doc_id) mod 3 is not 1: train_docs at most, in the order of a hash of doc_id; of rows with equal doc_id, the least text."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    lab = lab.where("doc_id is not null and y in (0, 1) and crc32(cast(doc_id as string)) % 3 <> 1").groupBy("doc_id").agg(F.max("y").alias("y"))
    half = [lab.where(F.col("y") == k).orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(train_docs // 2) for k in (0, 1)]
    picked = {r.doc_id: r.y for part in half for r in part.collect()}
    ids = docs.sparkSession.createDataFrame(list(picked.items()) or [(-1, 0)], "doc_id long, y int").where("y is not null")
    # one text per id, so that repeated rows don't make the sample larger
    rows = texts(docs).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return train([(bytes(r.text), r.y) for r in sorted(rows.collect(), key=lambda r: (r.doc_id, bytes(r.text)))] if picked else [])


def classify(docs: DataFrame, model: dict) -> DataFrame:
    """Score every row of docs (doc_id, text; other columns are ignored): doc_id, score, predicted.

    A null or blank text scores 0. Rows are scored each on its own, so ties and
    repeated rows score the same; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [score(held.value, t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())], ["doc_id", "score", "predicted"])

    return texts(docs).mapInArrow(rows, "doc_id long, score double, predicted int")


def op5_crf_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.expr("coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)")
    return classify(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")
