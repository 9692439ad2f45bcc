"""Conversation repair, ranked search and language identification against brute force."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoflume.llm import language_id, lexical_search, pii, turn_repair
from geoflume.llm.queries import QUERIES

MID = "/root/testdata/sf0.01"
NEXT = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def damaged(conv, rows):
    out = []
    for turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return sorted(out, key=lambda d: (d[0] is not None, d[0] or 0, d[1].encode(), d[2].encode()))


def plain_repair(conv, rows):
    """The whole table of whole strings, row by row."""
    rows = damaged(conv, rows)
    turns = [t for t, _, _ in rows if t is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {0: (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def put(s, way):
            new[s] = min(new.get(s, way), way)

        for s, (cost, audit, lines) in best.items():
            for _ in range(5):
                put(s, (cost + 2, audit + "D", lines))
                if fault not in ("blank", "duplicate"):
                    e, (name, t) = 5 * (fault == "truncated"), NEXT[s]
                    put(t, (cost + 1 + e, audit + "R", lines + (f"{name}:{text}",)))
                    if role[:1] == name[0]:
                        put(t, (cost + e, audit + "K", lines + (f"{role}:{text}",)))
                    if role[:1] == "s" and s == 0:
                        put(1, (cost + e, audit + "K", lines + (f"{role}:{text}",)))
                s, cost, audit, lines = NEXT[s][1], cost + 5, audit + "I", lines + (NEXT[s][0] + ":",)
        best = new
    ends = []
    for s, (cost, audit, lines) in best.items():
        while s not in (0, 3):
            s, cost, audit, lines = NEXT[s][1], cost + 5, audit + "I", lines + (NEXT[s][0] + ":",)
        ends.append((cost, audit, lines))
    cost, audit, lines = min(ends)
    first = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def repaired(spark, path):
    return {r[0]: tuple(r[1:]) for r in turn_repair.op11_turn_repair(spark, str(path)).collect()}


def by_conversation(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(row)
    return {c: plain_repair(c, r) for c, r in out.items()}


def test_repair_equals_plain_tables(spark, tmp_path, monkeypatch):
    """Few texts, odd roles, nulls, ties and repeats, one conversation over many stretches of 16 rows."""
    rng = random.Random(5)
    text = lambda: rng.choice(["a.", "b", "c!", "", " \t", None, "d?\nx", "ü.", f"t{rng.random()}.", f"{rng.random()}"])
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, *range(300)]), rng.choice(["system", "user", "assistant", "tool", None, ""]), text()) for _ in range(1500)]
    rows += [(k, t, rng.choice(["system", "user", "assistant"]), text()) for k in range(10, 80) for t in range(rng.randrange(7))]
    rows += [(4, 1, "user", "same.")] * 300 + [(5, 2**60 + k, "user", "x" * 200_000 + ".") for k in range(3)]
    zero = next(k for k in range(1000, 9999) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)  # all of its rows are dropped
    rows.append((zero, 0, "user", "gone."))
    monkeypatch.setattr(turn_repair, "ROWS", 16)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("k", F.lit(1)).withColumn("pid", F.lit("x")).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got, want = repaired(spark, tmp_path), by_conversation(rows)
    assert got == want and got[zero] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repair_of_the_given_table(spark):
    rows = spark.read.parquet(f"{MID}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert repaired(spark, MID) == by_conversation(map(tuple, rows))


def test_repair_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert repaired(spark, tmp_path) == {}


@pytest.mark.parametrize("cut", [1, 2, 3, 50])
def test_halves_meet_where_the_whole_table_crosses(cut):
    """solve() and joined stretches against all edit strings of short sequences."""
    rng = random.Random(cut)
    for _ in range(300):
        kinds = bytes(rng.randrange(8) for _ in range(rng.randrange(1, 9)))
        ways = {0: {(0, "")}}
        for k in kinds:
            new = {}
            for (s, t), (cost, edits) in turn_repair.steps(k).items():
                for c, a in ways.get(s, ()):
                    new.setdefault(t, set()).add((c + cost, a + edits))
            ways = {t: set(sorted(w)[:50]) for t, w in new.items()}
        cost, audit, _ = min((c + 5 * turn_repair.TAIL[t], a + "I" * turn_repair.TAIL[t], t) for t, w in ways.items() for c, a in w)
        parts = [kinds[i : i + cut] for i in range(0, len(kinds), cut)]
        total, border = turn_repair.join_stretches([turn_repair.across(p) for p in parts])
        got = "".join("".join(turn_repair.solve(p, s, t)) for p, s, t in zip(parts, border, border[1:]))
        assert (total, got + "I" * turn_repair.TAIL[border[-1]]) == (cost, audit)


def plain_ranks(docs, items, k):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    have = [(i, Counter(words(t))) for i, t in docs]
    n, total = sum(bool(c) for _, c in have), sum(sum(c.values()) for _, c in have)
    df = Counter(w for _, c in have for w in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in have:
            m = 75 + (25 * sum(c.values()) * n) // max(total, 1)
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 12 * m)) for w, q in Counter(words(text)).items() if w in c)
            if s > 0 and i is not None:
                scores.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_search_equals_plain_ranking(spark, monkeypatch):
    """Small trees, several blocks of items and forests of documents, a seeded start; nulls, ties, repeats and odd characters."""
    monkeypatch.setattr(lexical_search, "FOREST", 50)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 60)
    monkeypatch.setattr(lexical_search, "SEEDS", 40)
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(60)] + ["Éa", "éa", "ÉA", "x y", "İs"]
    text = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choice(vocabulary[: rng.choice([5, 20, 65])]) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 60))) for i in range(400)] + [(400 + k, "w1 W2 w3") for k in range(60)] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 w2 w59"), (900, None), (901, ""), (902, "... !"), (903, "w2 " * 20000)]
    items = [(i, text(rng.randrange(1, 9))) for i in range(25)] + [(30, None), (31, "none here"), (32, "w1 w1 w2"), (32, "w1 w1 w2"), (33, "w3"), (33, "w4"), (None, "w5")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("x")).repartition(6)
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("m", F.lit(1))
    got = sorted(map(tuple, lexical_search.ranked_search(d, i, 20).collect()), key=str)
    assert got == plain_ranks(docs, items, 20)
    assert lexical_search.ranked_search(d.where("false"), i).count() == 0 and lexical_search.ranked_search(d, i.where("false")).count() == 0


def test_search_leaves_pairs_of_nodes_closed():
    """With kth scores known, most pairs of leaves aren't opened and nothing is lost."""
    rng = random.Random(3)
    rows = [(str(k), k, f"t{rng.randrange(200)}".encode(), rng.randrange(1, 9000)) for k in range(64) for _ in range(6)]
    rows = list({(a, t): (a, b, t, w) for a, b, t, w in rows}.values())
    tree = lexical_search.ItemTree(rows)
    names = {t: i for t, i in tree.vocabulary.items()}
    docs = [sorted(rng.sample(sorted(names.values()), 3)) for _ in range(2000)]
    doc, term = np.repeat(np.arange(2000), 3), np.array(docs).ravel()
    impact = np.array([rng.randrange(1, 10**6) for _ in term])
    first = lexical_search.Search(tree, np.zeros(tree.n, np.int64), 20)
    first.forest(np.arange(2000), doc, term, impact)
    again = lexical_search.Search(tree, first.kth.copy(), 20)
    again.forest(np.arange(2000), doc, term, impact)
    assert sorted(zip(first.item, first.score, first.doc)) == sorted(zip(again.item, again.score, again.doc))
    assert again.opened < 0.2 * again.pairs


def test_language_of_held_out_documents(spark):
    d = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op13_language_id"](spark, MID).join(d, "doc_id").collect()
    assert len(got) == d.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert sum(r.rejected for r in held) <= 0.05 * len(held)


def test_language_edge_cases(spark):
    words = {"x": "alpha beta gamma delta epsilon zeta", "y": "uno dos tres cuatro cinco seis"}
    rng = random.Random(1)
    say = lambda k, n: " ".join(rng.choice(words[k].split()) for _ in range(n))
    train = spark.createDataFrame([(k, say(k, 80)) for k in ("x", "x", "y") for _ in range(60)] + [("x", None), (None, "uno"), ("x", words["x"])], "lang string, text string")
    model = language_id.fit(train)
    assert [m[0] for m in model] == ["x", "y"] and language_id.fit(train.repartition(7)) == model
    docs = spark.createDataFrame([(1, say("y", 40)), (2, None), (3, ""), (4, "12 34 !? _"), (5, say("x", 30_000) + " " + say("y", 9000)), (5, "Dos tres"), (None, "tres cuatro " * 9), (6, "½²")], "doc_id long, text string").withColumn("score", F.lit(1))
    got = sorted(((r.doc_id or 0, r.lang_pred, r.rejected) for r in language_id.identify(docs, model, ["doc_id"]).collect()))
    assert [g[:2] for g in got] == [(0, "y"), (1, "y"), (2, "und"), (3, "und"), (4, "und"), (5, "x"), (5, "x"), (6, "und")]
    assert all(g[2] for g in got if g[1] == "und") and not got[1][2] and [g[2] for g in got if g[0] == 5] == [False, True]  # two words are too close a call
    assert {r.lang_pred for r in language_id.identify(docs, language_id.fit(train.where("false")), ["doc_id"]).collect()} == {"und"}
    assert language_id.identify(docs.where("false"), model, ["doc_id"]).count() == 0


def test_addresses_in_long_numbers():
    """The same matches as the stated pattern, and a megabyte of digits in under a second."""
    plain = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(2)
    for _ in range(20_000):
        t = "".join(rng.choice("0123.....a") for _ in range(rng.randrange(40)))
        assert [m.span() for m in pii._IP.finditer(t)] == [m.span() for m in plain.finditer(t)]
    began = time.perf_counter()
    assert pii.base_spans("7" * 1_000_000 + " 1.2.3.4 " + "1." * 3 + "9" * 200_000) == [(1, 1_000_001, 1_000_008)]
    assert time.perf_counter() - began < 1
