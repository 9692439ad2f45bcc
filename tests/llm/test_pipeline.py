"""Each stage of the pipeline against a plain version of itself, on its own input."""

import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline as cp
from geoflume.llm import crf_quality, packing
from tests.llm.test_operators import brute_links, brute_pii, components, word_sets


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, f in cp.STAGES:
        after = cp.stage(f(spark, docs, sf), "test-stage")
        out.append((docs, after))
        docs = after
    return out


def table(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_all_but_the_last_keep_the_columns(steps):
    names = ["quality", "near copies", "benchmark leaks", "personal data", "packing"]
    assert [n for n, _ in cp.STAGES] == names
    first = steps[0][0]
    assert all([(f.name, f.dataType) for f in after.schema] == [(f.name, f.dataType) for f in first.schema] for _, after in steps[:-1])


def test_quality_keeps_good_documents(spark, sf, steps):
    before, after = (table(x) for x in steps[0])
    model = crf_quality.fit(steps[0][0], spark.read.parquet(f"{sf}/labels.parquet"))
    assert set(after) == {i for i, t in before.items() if crf_quality.score(model, (t or "").encode()) >= 0.5}
    good = {r[0] for r in duckdb.sql(f"select doc_id from '{sf}/labels.parquet' where quality = 1").fetchall()}
    assert len(good & set(after)) >= 0.97 * len(good)


def test_one_of_each_near_copy_stays(steps):
    before, after = (table(x) for x in steps[1])
    sets = word_sets(before.items(), 5)
    comp = components(sets, brute_links(sets, 4, 5))
    assert set(after) == {i for i in before if comp[i] == i}


def test_leaks_go(sf, steps):
    before, after = (table(x) for x in steps[2])
    norm = lambda t: " " + " ".join(re.findall(r"\w+", t.lower())) + " "
    items = [norm(t) for (t,) in duckdb.sql(f"select text from '{sf}/benchmark.parquet'").fetchall()]
    assert set(after) == {i for i, t in before.items() if not any(x in norm(t) for x in items)}


def test_personal_data_is_replaced(steps):
    before, after = (table(x) for x in steps[3])
    assert set(before) == set(after)
    for i, t in before.items():
        spans = brute_pii(t)
        assert not spans and after[i] == t or spans and not brute_pii(after[i])
    assert any(after[i] != t for i, t in before.items())
    assert all(r.n_chars == len(r.text) for r in steps[3][1].collect())


def test_packing_keeps_every_token(steps):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    tok, before = Tokenizer.from_file(P.path("word_bpe_49k.json")), table(steps[4][0])
    got = steps[4][1].collect()
    ids = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4") for i, t in before.items()}
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    assert all(r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) for r in got)


def test_run_gives_the_last_stage(spark, sf, steps):
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(cp.run(spark, sf)) == key(steps[-1][1])


def test_stages_stand_empty_and_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    odd = spark.createDataFrame([(None, "x", None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "Good day to all of you here today.", "en", "s", 1), (3, "Good day to all of you here today.", "en", "s", 1)], docs.schema)
    none = docs.limit(0)
    for _, f in cp.STAGES:
        none = cp.stage(f(spark, none, sf), "test-none")
        assert none.count() == 0
    alone = {name: cp.stage(f(spark, odd, sf), "test-odd") for name, f in cp.STAGES}
    key = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    learned = cp.quality(spark, docs.unionByName(odd), sf)
    assert docs.where("text is null or text = ''").count() + odd.where("text is null or text = ''").count() >= 2 and learned.where("text is null or text = ''").count() == 0
    # nothing here is a near copy of another id, a benchmark item or personal data
    assert key(alone["near copies"]) == key(alone["benchmark leaks"]) == key(odd)
    assert [(i, t or "") for i, t in key(alone["personal data"])] == [(i, t or "") for i, t in key(odd)]
    pieces = alone["packing"].collect()
    assert sorted((r.doc_id for r in pieces), key=repr) == sorted((r.doc_id for r in odd.collect()), key=repr)
    assert all(r.length == r.doc_tokens for r in pieces) and {r.doc_tokens for r in pieces if r.doc_id in (1, 2)} == {1}
    rows = odd
    for _, f in cp.STAGES:
        rows = cp.stage(f(spark, rows, sf), "test-odd")
    kept = {r.doc_id for r in rows.collect()}
    assert kept == {r.doc_id for r in alone["quality"].collect()}  # no labels, so one score for all: all stay or none


def test_batches_for_python_are_bounded_by_bytes(spark, sf):
    """Long texts came 10,000 rows at a time."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    docs = spark.range(0, 400, 1, 1).selectExpr("id as doc_id", "repeat('a word ', 10000) as text", "'en' as lang", "'s' as source", "70000L as n_chars")
    for name, f in cp.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        f(spark, docs.limit(0), sf)
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
        assert sum(r.n for r in sizes) > 28e6 and max(r.n for r in sizes) < 2 * cp.BATCH_BYTES, name


def test_a_packing_worker_holds_two_generations_of_chunks(monkeypatch):
    """Words were held beside the chunks that they stand in, in two generations of their own."""
    import public_tokenizers as P

    monkeypatch.setattr(packing, "CACHE", 100)
    path = P.path("word_bpe_49k.json")
    chunks = packing.Chunks(path)
    text = " ".join(f"{a}{b}{c}{m}" for a in "kmnprst" for b in "aeiou" for c in "klmnrst" for m in ("", ",", ".")).encode()
    for _ in range(2):
        got = chunks.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == chunks.tok.encode(text.decode(), add_special_tokens=False).ids
        assert len(chunks) + sum(len(x) for x in vars(chunks).values() if isinstance(x, dict) and x is not chunks.letters and x is not chunks.marks) <= 2 * 101
