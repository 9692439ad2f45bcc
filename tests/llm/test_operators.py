"""Training-data operators against brute force on small tables, and the cases every operator must stand."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from geoflume.llm import brown_lm, crf_quality, decontaminate, embedding_graph, html_extract, ngram_join, packing, pii, suffix_dedup, warc

MID = "/root/testdata/sf0.01"


def rows(sql):
    return duckdb.sql(sql).fetchall()


def table_of(name, cols, d=MID):
    return rows(f"select {cols} from '{d}/{name}.parquet'")


def components(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def word_sets(docs, n):
    out = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    return out


def brute_links(sets, num, den):
    index = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            index[x].append(i)
    common = Counter()
    for ids in index.values():
        common.update(combinations(sorted(ids), 2))
    return [(a, b) for (a, b), c in common.items() if den * c >= num * (len(sets[a]) + len(sets[b]) - c)]


EDGE = [(1, None, "x"), (2, "", "x"), (3, "   \n\t ", "x"), (4, "one", "x"), (5, "ONE", "x"), (6, "one two", "x"), (7, "one two three four five six", None), (7, "one two three four five six", None), (None, "one two three four five six", "y"), (8, "w " * 30_000, "z")]
EDGE_SCHEMA = "doc_id long, text string, sig string"


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5)])
def test_ngram_components_equal_brute_force(spark, n, num, den):
    docs = table_of("documents", "doc_id, text")
    got = {r.doc_id: r for r in ngram_join.ngram_components(spark.read.parquet(f"{MID}/documents.parquet"), n, num, den).collect()}
    sets = word_sets(docs, n)
    want = components(sets, brute_links(sets, num, den))
    assert len(got) == len(docs)
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("part", [2048, 20])
def test_ngram_components_of_a_drifting_group(spark, part, monkeypatch):
    """Near copies of near copies: most pairs of the group are no links, and chains matter; with 20, in a split bucket."""
    monkeypatch.setattr(ngram_join, "PART", part)
    rng, docs = random.Random(3), []
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    for i in range(150):
        words = list(base if i % 3 else rng.choice(docs)[1].split() if docs else base)
        for _ in range(rng.randrange(1, 7)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    sets = word_sets(docs, 5)
    want = components(sets, brute_links(sets, 4, 5))
    got = ngram_join.ngram_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert 1 < len(set(want.values())) < 150


def test_ngram_tiles_let_all_components_meet(spark, monkeypatch):
    """Members of different components meet in one group; those of the commonest are sent once if few others are left."""
    monkeypatch.setattr(ngram_join, "PART", 10)
    label = {1: lambda i: int(i == 77), 2: lambda i: i % 7, 3: lambda i: i, 4: lambda i: 5, 5: lambda i: i % 2}
    data = [(b, i, f(i), 1 if b == 5 else 10) for b, f in label.items() for i in range(100)]
    got = ngram_join._tiles(spark.createDataFrame(data, "bucket long, cls long, label long, parts long")).collect()
    groups = defaultdict(list)
    for r in got:
        groups[r.bucket, r.i, r.j].append((r.part, r.cls))
    met = Counter()
    for (b, i, j), members in groups.items():
        left, right = ([c for p, c in members if p == k] for k in (i, j))
        assert len(left) + len(right) == len(members) * (1 + (i == j))
        met.update({(b, min(x, y), max(x, y)) for x in left for y in right if label[b](x) != label[b](y)})
    assert met == Counter((b, x, y) for b, f in label.items() for x, y in combinations(range(100), 2) if f(x) != f(y))
    sent = Counter(r.bucket for r in got)
    assert sent[1] == 99 + 10 + 1 and sent[4] == 0 and sent[5] == 100 and sent[3] <= 100 * 11


def test_ngram_edge_cases(spark):
    got = ngram_join.ngram_components(spark.createDataFrame(EDGE, EDGE_SCHEMA), 3, 9, 10).collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r.component_id for r in got}
    assert by[4] == by[5] == 4 and by[1] == 1 and by[2] == 2 and by[7] == 7 and by[8] == 8
    assert ngram_join.ngram_components(spark.createDataFrame([], EDGE_SCHEMA)).count() == 0


def signature_shared(a, b, num, den):
    return bool(set(ngram_join.signatures(a, num, den).tolist()) & set(ngram_join.signatures(b, num, den).tolist()))


def test_linkable_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for num, den in ((9, 10), (4, 5)):
        for size in [*range(4, 40), 57, 101, 250, 999]:
            for _ in range(6):
                s = rng.integers(0, 2**63, size).astype(np.uint64)
                drop = size * (den - num) // den
                cut = rng.integers(0, drop + 1)
                grow = (den * (size - cut)) // num - size
                a = np.unique(s)
                b = np.unique(np.concatenate([s[cut:], rng.integers(0, 2**63, max(0, grow)).astype(np.uint64)]))
                inter = len(np.intersect1d(a, b))
                if den * inter >= num * (len(a) + len(b) - inter) and len(np.union1d(a, b)) > inter:
                    assert signature_shared(a, b, num, den), (num, den, size, cut, grow)


def test_brown_scores(spark):
    docs = table_of("documents", "doc_id, text")
    got = {r.doc_id: r for r in brown_lm.score(spark.read.parquet(f"{MID}/documents.parquet")).collect()}
    count, n = Counter(), 0
    toks = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for i, t in docs}
    learn = {i: zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in docs}
    for i, w in toks.items():
        if learn[i]:
            count.update(w)
            n += len(w)
    log_all = math.log10(n + 0.1 * (len(count) + 1))
    gain = {True: 0.0, False: 0.0}
    for i, w in toks.items():
        r = got[i]
        assert (r.n_tokens, r.train_tokens, r.held_out) == (len(w), n, not learn[i])
        assert r.n_known == sum(count[x] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(math.log10(count[x] + 0.1) - log_all for x in w), rel=1e-9)
        assert r.score < 0
        gain[r.held_out] += r.score - r.base_score
    assert gain[True] > 0 and gain[False] > 0


def test_brown_model_is_a_distribution():
    """Class transitions sum to one, and emissions of a class over its seen words and one unseen word too."""
    pairs = np.random.default_rng(0).integers(0, 5, (41, 41)).astype(float)
    cls = brown_lm.exchange(pairs, 6)
    trans, size = brown_lm._class_table(pairs, cls)
    assert np.allclose((10**trans).sum(1), 1)
    assert size.sum() == pairs.sum() and cls[-1] == 6 and set(cls[:-1]) <= set(range(6))


def test_exchange_raises_likelihood():
    rng = np.random.default_rng(5)
    group = np.arange(40) % 4
    pairs = np.zeros((41, 41))
    for a in range(40):
        for b in range(40):
            pairs[a, b] = rng.poisson(20 if group[b] == (group[a] + 1) % 4 else 0.2)
    pairs[40, :40] = 1
    cls = brown_lm.exchange(pairs, 4)
    assert all(len(set(cls[:40][group == g])) == 1 for g in range(4))


def test_common_words_take_the_class_of_their_own_neighbours():
    """Counts of a word's neighbours, and the class chosen from them, equal a plain count and the likelihood of every choice."""
    import pyarrow as pa

    class Held:
        def __init__(self, *value):
            self.value = value

    rng = np.random.default_rng(8)
    k, n_common, first = 5, brown_lm.UNIT_WORDS + 6, brown_lm._UNITS + 1
    cls = np.concatenate([rng.integers(0, k - 1, brown_lm._UNITS), [k - 1], rng.integers(0, k - 1, 6)])
    texts_ = [rng.choice([*range(4), *range(brown_lm.UNIT_WORDS, n_common), -1 - brown_lm.UNIT_WORDS - 7], n).astype("<i4") for n in (0, 1, 40, 400, 3)]
    batches = [pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in x], pa.binary())], ["ids"]) for x in (texts_[:3], texts_[3:])]
    seqs = [np.concatenate([[brown_lm._UNITS], brown_lm._units_of(t), [brown_lm._UNITS]]) for t in texts_]
    bigrams = Counter((int(a), int(b)) for s in seqs for a, b in zip(s[:-1], s[1:]))
    want = defaultdict(Counter)
    for (a, b), n in bigrams.items():
        if a >= first:
            want[a - first][int(cls[b])] += n
        if b >= first:
            want[b - first][k + int(cls[a])] += n
        if a == b >= first:
            want[a - first][2 * k] += n
    rows_ = [b for one in batches for b in brown_lm._neighbour_rows(Held(cls, n_common, k))(iter([one]))]
    got = defaultdict(Counter)
    for b in rows_:
        for w, at, n in zip(*(c.to_pylist() for c in b.columns)):
            got[w].update(dict(zip(at, n)))
    assert got == want

    def classes_of(c):
        g = np.zeros((k, k))
        for (a, b), n in bigrams.items():
            g[c[a], c[b]] += n
        return g

    g = classes_of(cls)
    (pairs,) = brown_lm._pair_rows(Held(cls, k))(iter(batches))
    made = np.zeros((k, k))
    made[pairs.column(0).to_numpy(), pairs.column(1).to_numpy()] = pairs.column(2).to_numpy()
    # the end that starts a batch's first text takes part in its own batch only
    assert np.array_equal(made, g)
    f = lambda x: float((x * np.log(np.maximum(x, 1e-300))).sum())
    (chosen,) = brown_lm._class_rows(Held(cls, n_common, k, g))(iter(rows_))
    moved = 0
    for w, c in zip(*(x.to_pylist() for x in chosen.columns)):
        value = []
        for new in range(k - 1):
            other = cls.copy()
            other[first + w] = new
            h = classes_of(other)
            value.append(f(h) - f(h.sum(0)) - f(h.sum(1)))
        assert value[c] == pytest.approx(max(value), abs=1e-6)
        moved += c != cls[first + w]
    assert moved


def test_brown_edge_cases(spark):
    got = brown_lm.score(spark.createDataFrame(EDGE, EDGE_SCHEMA)).collect()
    assert len(got) == len(EDGE) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    twice = [r for r in got if r.doc_id == 7]
    assert len(twice) == 2 and twice[0] == twice[1]
    assert brown_lm.score(spark.createDataFrame([], EDGE_SCHEMA)).count() == 0


def test_packing_round_trip(spark):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    docs = dict(table_of("documents", "doc_id, text"))
    got = packing.pack(spark.read.parquet(f"{MID}/documents.parquet"), P.path("word_bpe_49k.json")).collect()
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in docs.items()}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        pieces[r.doc_id].append((r.start, r.length))
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for i, p in pieces.items():
        assert [s for s, _ in sorted(p)] == list(np.cumsum([0, *(n for _, n in sorted(p))])[:-1]) and sum(n for _, n in p) == len(ids[i])
    for b in bins.values():
        assert [s for s, _ in sorted(b)] == list(np.cumsum([0, *(n for _, n in sorted(b))])[:-1]) and sum(n for _, n in b) <= 4096
    total = sum(map(len, ids.values()))
    assert len(bins) <= total / 4096 * 1.01 + 1


def test_chunks_equal_the_tokenizer():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    tok, chunks, rng = Tokenizer.from_file(path), packing.Chunks(path), random.Random(4)
    parts = ["The", "thea,", "naïve", "e\u0301te", "ÉTÉ", "İx", "ß", "ΣΑΣ", "don't", "'s", "12", "a1", "...", "<|endoftext|>", "日本", "\u00a0", "\x1c", "ﬁ", "ŉ", "x\u0308", "Ĳ", "!", "|", "\u0085y", "ſ", "K"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) + rng.choice(["", " ", "\n", "", "."]) for _ in range(rng.randrange(1, 9)))
        assert chunks.encode(t.encode()) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_first_fit_decreasing_equals_the_plain_loop():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 100, 300)
    bins, offsets = packing.first_fit_decreasing(lengths, 100)
    free, want = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        k = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
        if k == len(free):
            free.append(100)
        want[int(i)] = (k, 100 - free[k])
        free[k] -= int(lengths[i])
    assert want == {i: (int(b), int(o)) for i, (b, o) in enumerate(zip(bins, offsets))}


def test_packing_edge_cases(spark):
    import public_tokenizers as P

    got = packing.pack(spark.createDataFrame(EDGE, EDGE_SCHEMA), P.path("word_bpe_49k.json")).collect()
    assert sum(r.doc_tokens for r in got if r.start == 0) == sum(r.length for r in got)
    assert len([r for r in got if r.doc_id == 7]) == 2 and len([r for r in got if r.doc_id is None]) == 1
    assert [r.length for r in got if r.doc_id == 1] == [1]
    assert packing.pack(spark.createDataFrame([], EDGE_SCHEMA), P.path("word_bpe_49k.json")).count() == 0


def test_quality_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")
    got = crf_quality.classify(docs, crf_quality.fit(docs, labels)).join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 3 = 1").collect()
    right = [r.predicted == r.quality for r in got]
    assert len(got) > 50 and sum(right) / len(right) > 0.95


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    un, tr = rng.normal(size=(5, 2)), rng.normal(size=(2, 2))
    z, m, pairs = 0.0, np.zeros((5, 2)), np.zeros((2, 2))
    for code in range(32):
        y = [(code >> i) & 1 for i in range(5)]
        p = math.exp(sum(un[i, v] for i, v in enumerate(y)) + sum(tr[a, b] for a, b in zip(y, y[1:])))
        z += p
        for i, v in enumerate(y):
            m[i, v] += p
        for a, b in zip(y, y[1:]):
            pairs[a, b] += p
    got, gp, logz = crf_quality.forward_backward(un, tr)
    assert np.allclose(got, m / z) and np.allclose(gp, pairs / z) and logz == pytest.approx(math.log(z))
    un[:, 1] -= un[:, 0]
    un[:, 0] = 0
    assert np.allclose(crf_quality._marginal_good(un, tr), crf_quality.forward_backward(un, tr)[0][:, 1])


def plain_line(line, before):
    """Features of one line, byte by byte."""
    share = lambda chars: sum(c in chars for c in line) / len(line)
    low, up, dig = (bytes(range(ord(x), ord(y) + 1)) for x, y in ("az", "AZ", "09"))
    upper, odd, words = share(up), share(b"!|#$%&*+=<>[]{}~^_@\\/"), line.split()
    count = max(1, len(words))
    distinct = len(set(words)) / count
    return [
        math.log(1 + len(line)) / 8, math.log(1 + count) / 6, share(low), upper, share(dig), share(b" \t\r\x0b\x0c"), share(b".,;:'-?"), min(odd * 5, 1),
        float(odd > 0.05), len(line) / count / 20, distinct, float(line in before), float(upper > 0.4), float(distinct < 0.5 and count > 12),
    ]


def plain_quality(model, text):
    """The score by summing over all labellings of the lines."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    own = [plain_line(x, lines[:i]) for i, x in enumerate(lines)]
    n, zero = len(own), [0.0] * 14
    full = [own[i] + (own[i - 1] if i else zero) + (own[i + 1] if i + 1 < n else zero) + [float(i == 0), float(i == n - 1), 1.0] for i in range(n)]
    unary = [sum((x - m) / d * w for x, m, d, w in zip(f, model["mean"], model["dev"], model["w"])) for f in full]
    z, good = 0.0, [0.0] * n
    for code in range(2**n):
        y = [(code >> i) & 1 for i in range(n)]
        p = math.exp(sum(u for u, v in zip(unary, y) if v) + sum(model["trans"][a][b] for a, b in zip(y, y[1:])))
        z += p
        good = [g + p * v for g, v in zip(good, y)]
    p = sum(g / z * len(x) for g, x in zip(good, lines)) / sum(map(len, lines))
    p = min(max(p, 1e-6), 1 - 1e-6)
    return 1 / (1 + math.exp(-(model["cal"][0] * math.log(p / (1 - p)) + model["cal"][1])))


def test_quality_score_equals_sum_over_labellings(spark):
    rng = random.Random(8)
    piece = lambda: rng.choice(["word", "Title", "SHOUT", "12,5", "a|b#c", "été", "word word", "x" * 30, "\t", "ok."])
    line = lambda: " ".join(piece() for _ in range(rng.randrange(0, 30)))
    docs = []
    for i in range(40):
        lines = [line() for _ in range(rng.randrange(1, 8))]
        docs.append((i, "\n".join(lines + lines[:2])))
    docs = [(i, t) for i, t in docs if t.strip()]
    g = np.random.default_rng(8)
    model = {"w": g.normal(size=45) / 3, "mean": g.normal(size=45) / 5, "dev": 0.5 + g.random(45), "trans": g.normal(size=(2, 2)), "cal": (0.8, -0.3)}
    got = {r.doc_id: r for r in crf_quality.classify(spark.createDataFrame(docs, "doc_id long, text string"), model).collect()}
    want = {i: plain_quality(model, t.encode()) for i, t in docs}
    assert set(got) == set(want) and len({round(x, 3) for x in want.values()}) > 20
    assert all(abs(got[i].score - want[i]) < 1e-9 and got[i].predicted == (want[i] >= 0.5) for i in want)


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame(EDGE, EDGE_SCHEMA)
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 0), (None, 1, 0), (6, None, None)], "doc_id long, quality int, toxic int")
    model = crf_quality.fit(docs, labels)
    got = crf_quality.classify(docs, model).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    none = crf_quality.fit(docs, labels.limit(0))
    assert crf_quality.classify(docs.limit(0), none).count() == 0 and {r.score for r in crf_quality.classify(docs, none).collect()} == {0.5}


def brute_repeats(docs, window):
    seen = defaultdict(list)
    for k, (_, t) in enumerate(docs):
        for p in range(len(t) - window + 1):
            seen[t[p : p + window]].append((k, p))
    cover = [bytearray(len(t)) for _, t in docs]
    for places in seen.values():
        if len(places) > 1:
            for k, p in places:
                cover[k][p : p + window] = b"\1" * window
    out = []
    for (i, t), c in zip(docs, cover):
        kept = bytes(b for b, x in zip(t, c) if not x)
        spans = len(re.findall(rb"\x01+", bytes(c)))
        out.append((i, len(t), sum(c), spans, hashlib.sha256(kept).hexdigest()))
    return out


def compare_repeats(spark, docs, window):
    df = spark.createDataFrame([(i, t.decode() if t is not None else None) for i, t in docs], "doc_id long, text string")
    got = suffix_dedup.repeated_windows(df, window).drop("spans").collect()
    want = brute_repeats([(i, t or b"") for i, t in docs], window)
    assert Counter(map(tuple, got)) == Counter(want)


def passages(seed, n, window):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7)))
    shared = [" ".join(word() for _ in range(rng.randrange(window // 8, window))) for _ in range(5)]
    docs = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randrange(0, window))) for _ in range(rng.randrange(1, 6))]
        if rng.random() < 0.2:
            parts.append(rng.choice(["ab", "a", "abc ", "x"]) * rng.randrange(1, window * 2))
        docs.append((i, " ".join(parts).encode()))
    return docs + [(n + k, docs[k][1]) for k in range(3)] + [(n + 9, None), (n + 10, b"")]


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeated_windows_equal_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "_LOCAL", 300)
    compare_repeats(spark, passages(hot, 60, 40), 40)
    compare_repeats(spark, passages(hot + 1, 60, 24), 24)


def test_repeated_windows_of_the_tables(spark):
    docs = [(i, (t or "").encode()) for i, t in table_of("documents", "doc_id, text", "/root/testdata/sf0.001")]
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = suffix_dedup.repeated_windows(df).drop("spans").collect()
    assert Counter(map(tuple, got)) == Counter(brute_repeats(docs, 400))
    assert sum(r.n_removed for r in got) > 0


def test_repeated_windows_edge_cases(spark):
    got = suffix_dedup.repeated_windows(spark.createDataFrame(EDGE, EDGE_SCHEMA)).collect()
    assert len(got) == len(EDGE) and {r.doc_id: r.n_removed for r in got}[8] == 60_000
    assert suffix_dedup.repeated_windows(spark.createDataFrame([], EDGE_SCHEMA)).count() == 0


def brute_vectors(data, least=0.98):
    fine = {i: np.asarray(v, float) for i, v, lab in data if lab is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    by = defaultdict(list)
    for i, v, lab in data:
        if i in fine:
            by[lab].append(i)
    links = []
    for ids in by.values():
        m = np.stack([fine[i] / np.linalg.norm(fine[i]) for i in ids])
        a, b = np.nonzero(np.triu(m @ m.T >= least, 1))
        links += [(ids[x], ids[y]) for x, y in zip(a, b)]
    return links


def test_embedding_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_graph, "SHARD", 60)
    data = table_of("embeddings", "vec_id, embedding, label")
    emb = spark.read.parquet(f"{MID}/embeddings.parquet")
    out = embedding_graph.near_duplicates(emb)
    got = {r.vec_id: r for r in out.collect()}
    links = brute_vectors(data)
    want = components([i for i, _, _ in data], links)
    degree = Counter(x for p in links for x in p)
    assert len(got) == len(data)
    assert all(got[i].n_links <= degree[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.95 * sum(degree.values())
    assert sum(got[i].component_id == want[i] for i in want) >= 0.98 * len(want)
    assert embedding_graph.audit_recall(emb, out) >= 0.9


def test_embedding_large_group_keeps_all_links(spark, monkeypatch):
    monkeypatch.setattr(embedding_graph, "SHARD", 200)
    r = np.random.default_rng(5)
    near = r.normal(size=(1, 64)) + 0.1 * r.normal(size=(900, 64))  # near copies of each other, many on either side of the threshold
    tight = r.normal(size=(20, 1, 64)) + 0.05 * r.normal(size=(20, 30, 64))  # groups that a split tells apart
    data = [(i, x.tolist(), 1) for i, x in enumerate(near)] + [(1000 + i, x.tolist(), 2) for i, x in enumerate(tight.reshape(-1, 64))]
    emb = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    out = embedding_graph.near_duplicates(emb)
    got = {x.vec_id: x for x in out.collect()}
    links = brute_vectors(data)
    degree = Counter(x for p in links for x in p)
    want = components([i for i, _, _ in data], links)
    assert sum(degree.values()) > 200_000
    assert all(got[i].n_links == degree[i] for i in got if i < 1000)
    assert sum(got[i].n_links for i in got if i >= 1000) >= 0.99 * sum(degree[i] for i in degree if i >= 1000)
    assert all(got[i].component_id == want[i] for i in want)
    assert embedding_graph.audit_recall(emb, out) >= 0.99


@pytest.mark.parametrize("n, groups, noise", [(1900, 12, 0.11), (1900, 20, 0.05), (1500, 20, 0.11)])
def test_embedding_groups_larger_than_the_candidates(spark, n, groups, noise):
    """Shards of the real size, with groups of more near copies than a node has candidates: links and components equal brute force."""
    r = np.random.default_rng(n + groups)
    unit = lambda v: v / np.linalg.norm(v, axis=1, keepdims=True)
    x = unit(unit(r.normal(size=(groups, 64)))[np.arange(n) % groups] + noise * unit(r.normal(size=(n, 64))))
    emb = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    out = embedding_graph.near_duplicates(emb).cache()
    recall = embedding_graph.audit_recall(emb, out)
    print(f"recall {recall} of {groups} groups of {n} vectors")
    assert recall >= 0.99
    sim = x @ x.T
    np.fill_diagonal(sim, 0)
    link = sim >= 0.98
    sure = not (np.abs(sim - 0.98) < 1e-12).any()
    want = components(range(n), np.argwhere(np.triu(link)).tolist())
    got = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert sure and {i: c for i, (_, c) in got.items()} == want
    lost = sum(int(link[i].sum()) - got[i][0] for i in range(n))
    assert 0 <= lost <= 0.01 * link.sum()


def test_embedding_links_count_at_both_ends(spark, monkeypatch):
    monkeypatch.setattr(embedding_graph, "SHARD", 100)
    x = np.random.default_rng(6).normal(size=(800, 3))  # evenly over a sphere, so many links cross a border
    data = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = {r.vec_id: r.n_links for r in embedding_graph.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")).collect()}
    degree = Counter(i for p in brute_vectors(data) for i in p)
    assert all(got[i] <= degree[i] for i in got)
    assert sum(got.values()) % 2 == 0 and sum(got.values()) >= 0.99 * sum(degree.values())


def test_embedding_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    data = [(1, v, 1), (2, v, 1), (3, v, 2), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 1.0], 1), (7, [float("nan")] * 3, 1), (8, v, None), (9, [], 1), (10, [1.0, 2.0], 1), (11, [float("inf"), 1.0, 1.0], 1), (12, [1.0, 2.0, 3.01], 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_graph.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")).collect()}
    assert got.pop(1) == (2, 1, True) and got.pop(2) == (2, 1, False) and got.pop(12) == (2, 1, False)
    assert got == {i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)}
    assert embedding_graph.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0


def test_warc_round_trip(spark, monkeypatch):
    from geoflume.llm.queries import QUERIES

    got = {r.page_id: r for r in QUERIES["op8_warc"](spark, MID).collect()}
    data = {i: (h or "").encode() for i, h in table_of("pages", "page_id, html")}
    last = {}
    for i, h in data.items():
        last[h] = max(i, last.get(h, i))
    assert set(got) == set(data)
    for i, h in data.items():
        r = got[i]
        copy = len(h) >= 1000 and last[h] != i
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.intact) == (len(h), hashlib.sha1(h).hexdigest(), "revisit" if copy else "response", last[h] if copy else None, True)


def test_warc_large_and_odd_payloads(spark, tmp_path):
    big = ("line\r\n\r\n" * 70_000) + "x" * 3_000_000 + "\r\n"
    data = [(1, "http://a/", big, 0), (2, "http://b/\n", big, 0), (3, None, None, 0), (4, "u", "", 0), (5, "u", "a\r\n\r\n", 0), (6, "u", "\n", 0), (7, "u", "WARC/1.1\r\n\r\n", 0), (8, "é", "é" * 999, 0), (None, "u", "x", 0)]
    path = "file://" + str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(data, "page_id long, url string, html string, digest int"), path)
    got = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 8}
    for i, _, h, _ in data[:-1]:
        h = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].intact) == (len(h), hashlib.sha1(h).hexdigest(), True)
    assert (got[1].record_type, got[1].refers_to, got[2].record_type) == ("revisit", 2, "response")
    assert warc.read_chunks(spark, path).where("page_id = 2").count() > 3


def plain_warc(data):
    """(headers, block) of each record of a file of gzip members, one member per record, read with nothing of the library."""
    out = []
    while data:
        z = zlib.decompressobj(31)
        rec = z.decompress(data)
        assert z.eof and rec.startswith(b"WARC/1.1\r\n")
        data = z.unused_data
        head, _, block = rec.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        assert block.endswith(b"\r\n\r\n") and len(block) == int(fields["Content-Length"]) + 4
        out.append((fields, block[:-4]))
    return out


def test_warc_files_stand_another_reader(spark, tmp_path):
    big = "x" * 2_500_000
    data = [(1, "http://a/", big), (2, "http://b/", big), (2, "http://b/", big), (3, "http://c/", "tiny"), (3, "http://c/", "tiny"), (3, "http://d/", None)]
    warc.write_archives(spark.createDataFrame(data, "page_id long, url string, html string"), "file://" + str(tmp_path / "w"), "2020-01-02T03:04:05Z")
    found = [r for f in sorted((tmp_path / "w").glob("*.warc.gz")) for r in plain_warc(f.read_bytes())]
    ids = [f["WARC-Record-ID"] for f, _ in found]
    assert len(set(ids)) == len(ids)
    for f, _ in found:
        assert f["WARC-Date"] == "2020-01-02T03:04:05Z" and (f["WARC-Type"] == "continuation") != ("Content-Type" in f)
        assert f.get("WARC-Refers-To", ids[0]) in ids and f.get("WARC-Segment-Origin-ID", ids[0]) in ids
    kinds = Counter((f["WARC-Type"], f["X-Page-Id"]) for f, _ in found)
    assert kinds == {("response", "2"): 1, ("continuation", "2"): 2, ("revisit", "1"): 1, ("revisit", "2"): 1, ("response", "3"): 3}
    parts = sorted((int(f["WARC-Segment-Number"]), b, f) for f, b in found if f.get("WARC-Segment-Number"))
    assert b"".join(b for _, b, _ in parts).partition(b"\r\n\r\n")[2] == big.encode()
    assert int(parts[-1][2]["WARC-Segment-Total-Length"]) == sum(len(b) for _, b, _ in parts)
    got = warc.read_archives(spark, "file://" + str(tmp_path / "w")).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == [(1, 2_500_000, "revisit", 2), (2, 2_500_000, "response", None), (2, 2_500_000, "revisit", 2), (3, 0, "response", None), (3, 4, "response", None), (3, 4, "response", None)]


def test_warc_of_an_empty_table(spark, tmp_path):
    path = "file://" + str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def brute_pii(t):
    out = []
    for k, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m[0])
            if k == "email" or k == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or k == "card" and 13 <= len(d) <= 19 and luhn(d) or k == "phone" and 9 <= len(d) <= 15:
                out.append(f"{k}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans_equal_the_patterns(spark):
    got = {r.doc_id: r for r in pii.find(spark.read.parquet(f"{MID}/documents.parquet")).collect()}
    docs = table_of("documents", "doc_id, text")
    assert len(got) == len(docs)
    for i, t in docs:
        want = brute_pii(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert got[i].spans.split(",")[: len(want)] == want or not want and "term" in got[i].spans or not got[i].spans
        assert got[i].n_email == sum(x.startswith("email") for x in want)


def test_pii_patterns_on_odd_texts():
    rng = random.Random(0)
    for _ in range(4000):
        t = "".join(rng.choice("ab1@@..-+ ()9%é5") for _ in range(rng.randrange(1, 40)))
        assert [f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in pii.base_spans(t)] == brute_pii(t), t


def test_pii_very_long_numbers():
    assert pii.base_spans("9" * 6000 + ".1.1.1") == [] and pii.base_spans("0" * 6000 + "1.1.1.255") == [(1, 0, 6009)]


def test_pii_revealing_terms(spark):
    docs = [(i, f"about nothing {i} of note") for i in range(40)] + [(100 + i, f"call zanzibar at joe@x.org today {i}") for i in range(3)] + [(200, "today at call")]
    df = spark.createDataFrame([(i, t, "e", 1) for i, t in docs], "doc_id long, text string, e string, n_chars long")
    got = {r.doc_id: r for r in pii.find(df).collect()}
    assert "term:5:13" in got[100].spans and got[0].spans == "" and got[200].spans == ""
    clean = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert clean[100].startswith("call <TERM> at <EMAIL> ") or clean[100].startswith("<TERM> <TERM>") and clean[5] == "about nothing 5 of note"
    assert pii.sanitise(df).columns == df.columns


def test_pii_terms_go_wherever_they_stand(spark):
    """Against a plain recount: terms near an entity, its information, and all places in the documents that hold it."""
    rng = random.Random(4)
    vocab = [f"w{k}x" for k in range(60)] + ["O'Brien", "Smith-Jones", "user84"]
    docs = []
    for i in range(120):
        words = [rng.choice(vocab[:60]) for _ in range(40)]
        if i % 6 == 0:
            who = (i // 6) % 3
            words[10:10] = [vocab[60 + who], f"u{who}@mail.org", "end."]
            words += [vocab[60 + who] + ",", "tail"]
        docs.append((i, " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    near, count, holds = defaultdict(set), Counter(), defaultdict(set)
    for i, t in docs:
        count.update({w.strip(".,").lower() for w in t.split()})
        words = t.split()
        for k, w in enumerate(words):
            if "@" in w:
                holds[w].add(i)
                for x in words[max(0, k - 5) : k] + words[k + 1 : k + 6]:
                    near[w, x.strip(".,").lower()].add(i)
    reveal = defaultdict(set)
    for (e, x), ids in near.items():
        if len(ids) >= 2 and math.log(len(ids) * 120 / (len(holds[e]) * count[x])) / math.log(120 / len(holds[e])) >= 0.9:
            for i in holds[e]:
                reveal[i].add(x)
    assert any(reveal.values())
    got = {r.doc_id: r.spans for r in pii.find(df).collect()}
    for i, t in docs:
        want = [f"term:{m.start()}:{m.start() + len(m[0].rstrip('.,'))}" for m in re.finditer(r"\S+", t) if m[0].strip(".,").lower() in reveal[i]]
        assert [x for x in got[i].split(",") if x.startswith("term")] == want
    assert "O'Brien" not in {r.doc_id: r.text for r in pii.sanitise(df).collect()}[0]


def test_pii_edge_cases(spark):
    df = spark.createDataFrame(EDGE, EDGE_SCHEMA)
    got = pii.find(df).collect()
    assert len(got) == len(EDGE) and all(r.spans == "" for r in got)
    assert pii.sanitise(df).count() == len(EDGE)
    assert pii.find(df.limit(0)).count() == 0


def test_html_pages(spark):
    got = {r.page_id: r for r in html_extract.extract(spark.read.parquet(f"{MID}/pages.parquet")).collect()}
    for i, u, h in table_of("pages", "page_id, url, html"):
        body = h[h.index("<article>") : h.index("</article>")]
        body = re.sub(r"<h1>|</h1>|</?p>", "\0", body)
        import html

        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b))).strip() for b in body.split("\0")]
        want = "\n\n".join(b for b in blocks if b)
        assert got[i].text == want
        assert got[i].n_chars == len(got[i].text) and got[i].url == u


PAGE = """<html><head><title>t</title><style>.x{}</style></head><body><header>Site</header><nav><a>Home</a></nav>
<div class="cookie-notice">We use cookies</div><aside>Side</aside><main><article><header><h1>Head &amp; line</h1></header><p>First&nbsp;par
a <b>bold</b>x<p>Second<ul><li>one<li>two</ul><script>x("</p>")</script><div class="ad">Buy</div><table><tr><td>c1<td>c2</table></article>
<section class="comments"><p>Nice</p></section><form><input>Search</form></main><footer>&copy; x</footer></body></html>"""


def test_html_structure_and_templates(spark):
    data = [(1, "http://solo/", PAGE, "h")] + [(k, "http://h.org/a", f"<body><div>Menu here</div><div>Always the same</div><p>Text {k}</p></body>", "x") for k in range(10, 16)]
    data += [(20, None, None, "x"), (21, "nourl", "", "x"), (22, "http://h2/", "plain text < 5 and > 3 &lt;b&gt;", "x"), (23, "http://h3/", "<p>cut <b>off</b> <di", "x")]
    data += [(30 + k, "http://copies/", "<p>all the same page</p><p>again</p>", "x") for k in range(6)]
    df = spark.createDataFrame(data, "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got[1] == "Head & line\n\nFirst par a boldx\n\nSecond\n\none\n\ntwo\n\nc1\n\nc2"
    assert all(got[k] == f"Text {k}" for k in range(10, 16))
    assert got[20] == got[21] == "" and got[22] == "plain text < 5 and > 3 <b>" and got[23] == "cut off"
    assert got[30] == "all the same page\n\nagain"
    assert html_extract.extract(df.limit(0)).count() == 0


def test_html_keeps_article_text_and_reads_odd_markup():
    page = """<body><form action="/"><article><div class="entry-header"><h1>My title</h1></div><div class="article-header">Lede</div><svg class="icon"/>
<p class="related-work">Related work</p><div id="search-methods">Methods<svg><title>x</title></svg></div><p>Let <math><mi>x</mi></math> be</p><object>shown</object><canvas><p>Body</article></form>
<div class="comment-list">c</div><div id="cookie_notice">n</div><div class="site-footer">f</div><form><label>q</label>Find</form><iframe src="x"><p>After</body>"""
    assert [x[2] for x in html_extract.tokens_of(page)[1]] == ["My title", "Lede", "Related work", "Methods", "Let x be", "shown", "Body", "After"]


@pytest.mark.parametrize("page", ["<a " * 330_000, '<a "' * 250_000, "<a '\"" * 200_000 + ">", "<form>x" * 140_000 + "<h1>", "<div>" * 200_000, "<b>" * 100_000 + "<p>" * 100_000, "<!" * 500_000, "<title>" * 140_000], ids=["a", "quote", "quotes", "form", "deep", "inline", "mark", "title"])
def test_html_long_odd_pages_take_linear_time(page):
    def seconds(text):
        begin = time.process_time()
        html_extract.tokens_of(text)
        return time.process_time() - begin

    # a tenth of the page in about a tenth of the time; quadratic time would be a hundredth
    assert seconds(page) < 40 * max(seconds(page[: len(page) // 10]), 0.02)


def test_html_numbers_of_any_length():
    assert html_extract.unescape("&#" + "9" * 6000 + "; &#" + "0" * 6000 + "65; &#0000000000; &#x41; &amp;") == "\ufffd A \ufffd A &"


def test_html_template_of_made_hosts(spark):
    """Names tell nothing here: what recurs is template text, except in articles; pages of one text count once."""
    frame = "<body><div class=a>Shop of things</div><div class=b><span>Since 1999</span></div><div class=c>{}</div><div class=a>All rights</div></body>"
    data = [(k, "http://two/", frame.format(f"<p>One {k}<p>Two {k}")) for k in range(2)]
    data += [(10 + k, "http://art/", f"<div>Top</div><article><p>Our motto<p>Story {k}</article>") for k in range(5)]
    data += [(20 + k, "http://same/", f"<!-- ad {k} --><div>Head</div><p>Same text<script>track({k})</script>") for k in range(5)]
    data += [(30 + k, "http://moved/", f"<div>Top</div><ul>{'<li>x' * k}</ul>{'<p>' if k % 2 else '<ul><li>'}Strays{'</p>' if k % 2 else '</ul>'}<p>Text {k}") for k in range(4)]
    data.append((40, "http://long/", "<p>" + "word " * 400_000))
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in (0, 1)] == ["One 0\n\nTwo 0", "One 1\n\nTwo 1"]
    assert got[11] == "Our motto\n\nStory 1" and got[23] == "Head\n\nSame text"
    assert "Strays" in got[32] and "Top" not in got[32] and len(got[40]) == 5 * 400_000 - 1


def test_decontamination_of_short_items_and_long_texts(spark):
    """Templates that are all placeholders match by value; a very long text is read to its end."""
    items = [(1, "42"), (2, "7 8 9 10 11 12 13 14 15 16"), (3, "Tom runs"), (4, "How many apples does Tom have if he buys 3 more apples after lunch")]
    docs = [(1, "there are 17 of them and 18 of us"), (2, "the answer is 42 here"), (3, "1 2 3 4 5 6 7 8 9 10 21 22 23"), (4, "see 7 8 9 10 11 12 13 14 15 16 there"), (5, "and Ann runs off"), (6, "so Tom runs off")]
    docs += [(7, "word " * 300_000 + "how many apples does Ann have if she buys 9 more apples after lunch")]
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.reparameterised) for r in got) == [(2, 1, False), (4, 2, False), (6, 3, False), (7, 4, True)]


def test_decontamination_finds_all_items(spark):
    docs, items = table_of("documents", "doc_id, text"), table_of("benchmark", "item_id, text")
    norm = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    want = {(i, k) for i, t in docs for k, x in items if f" {norm(x)} " in f" {norm(t)} "}
    d, b = spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.matches(d, b).collect()}
    assert want and got == want
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(d, b, broadcast_windows=0).collect()} == want
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(d, b, broadcast_words=0).collect()} == want


@pytest.mark.parametrize(
    "changed",
    [
        "Tom has 3 red apples in his small basket and he really gives 2 of them to the girl next door every single morning",
        "Tom has 3 red apples in his small basket and gives 2 of them to the girl next door every single morning",
        "Mary Ann has 3 red apples in his small basket and he gives 2 of them to the girl next door every single morning",
        "Tom has 5 million red apples in his small basket and he gives 2 of them to the girl next door every single morning",
        "Tom has 3 red apples in his small basket and he sells 2 of them to the girl next door every single morning",
    ],
)
def test_decontamination_after_one_edit(spark, changed):
    item = "Tom has 3 red apples in his small basket and he gives 2 of them to the girl next door every single morning"
    d = spark.createDataFrame([(1, f"some words before . {changed} . and some after"), (2, "Bob has 7 blue cars in the large garage of the house and sells none to any boy")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.matches(d, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()] == [(1, 9)]


def test_decontamination_edit_of_any_word():
    words = [f"w{chr(97 + i)}x" for i in range(26)]
    for n in range(8, 27):
        k = decontaminate.window_size(n, 8)
        for e in range(n):
            rows = [(0, at, n, [None] * k, [None] * k) for at in range(n - k + 1) if not at <= e < at + k]
            assert decontaminate.best_chain(rows)[0] >= 0.6, (n, e)
    h, values = decontaminate.canonical("Tom has 3. Tom buys 4.", frozenset(words))
    g, others = decontaminate.canonical("Mary Ann has 5 million. Mary Ann buys 6.", frozenset(words))
    assert h.tolist() == g.tolist() and values == ["Tom", None, "3", "Tom", None, "4"] and others == ["Mary Ann", None, "5 million", "Mary Ann", None, "6"]


def test_decontamination_of_numbers_in_words(spark):
    """Numbers in words are placeholders like figures, with the same values; a run of them is one."""
    values = lambda t: [v for v in decontaminate.canonical(t, frozenset({"a", "the"}))[1] if v]
    assert values("the twenty-five men of two hundred and five saw 3 and four; nine million or 9 million") == ["25", "2 hundred 5", "3", "4", "9 million", "9 million"]
    assert values("the forty two and zero ten") == ["42", "0 10"]
    items = [(1, "A train travels 60 miles in 2 hours before it stops at the old station, how fast is it?"), (2, "Name three primary colors used in painting."), (3, "See no one at all on the long road to the town today")]
    docs = [
        (1, "Look. A train travels sixty miles in two hours before it stops at the old station, how fast is it? Good."),
        (2, "A train travels ninety-five miles in three hours before it stops at the old station, how fast is it?"),
        (3, "So. Name four primary colors used in painting. Done"), (4, "Primary colors are used in painting, as four men say."),
        (5, "See no one at all on the long road to the town today"), (6, None),
    ]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = [(1, 1, False), (2, 1, True), (3, 2, True), (5, 3, False)]
    for limit in (1_000_000, 0):  # broadcast, and joined
        got = decontaminate.matches(d, b, broadcast_words=limit, broadcast_windows=limit).collect()
        assert sorted((r.doc_id, r.item_id, r.reparameterised) for r in got) == want


def test_decontamination_of_changed_parameters(spark):
    item = "If Tom has 12 apples and gives Anna 5 of the 12 apples, how many km must Tom then walk to find 7 more apples today?"
    docs = [
        (1, "Well then. If Bob has 31 apples and gives Mary 8 of the 31 apples, how many miles must Bob then walk to find 9 more apples today? Yes."),
        (2, "If Bob has 31 apples and gives Mary 8 of the 44 apples, how many miles must Joe then walk to find 8 more apples today?"),
        (3, "A text about other things that never asks how many apples there are."), (4, None), (5, ""), (None, item), (6, item), (6, item),
    ]
    d = spark.createDataFrame([(i, t, "q") for i, t in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(1, item), (2, None), (None, "x y"), (3, "")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.matches(d, b, consistency=0.9).collect()}
    assert set(got) == {1, 6, None}
    assert got[1].reparameterised and not got[6].reparameterised
    assert {r.doc_id for r in decontaminate.decontaminate(d, b, consistency=0.9).collect()} == {2, 3, 4, 5}
    assert decontaminate.matches(d.limit(0), b).count() == 0 and decontaminate.matches(d, b.limit(0)).count() == 0
