"""Tables behind streams, metric streams, the run ledger and publishing, with crashes at every step."""

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from geoflume.operators import metrics
from geoflume.sources import files, ingest, views
from geoflume.streaming import jobs, ledger
from geoflume.streaming import metrics as streams
from geoflume.streaming.tables import BucketTable, newest, summed

NOW = datetime(2024, 1, 20)


def pairs(spark, rows):
    return spark.createDataFrame(rows, "k long, v long")


def test_bucket_table_equals_a_fold_of_all_batches(spark, tmp_path):
    t = BucketTable(spark, str(tmp_path / "t"), ["k"], newest(["k"], "v"), 4)
    assert t.read() is None
    want = {}
    for e in range(6):
        rows = [(k % (7 + e), (k * 37 + e * 11) % 50) for k in range(20)]
        assert t.merge(pairs(spark, rows), e)
        for k, v in rows:
            want[k] = max(want.get(k, v), v)
        assert {r.k: r.v for r in t.read().collect()} == want
    assert not t.merge(pairs(spark, [(0, 10**6)]), 5)  # an epoch that a restart plays again
    assert {r.k: r.v for r in t.read().collect()} == want and len(t.epochs()) == 2
    assert t.merge(pairs(spark, []), 6) and {r.k: r.v for r in t.read().collect()} == want


def test_bucket_table_writes_what_a_batch_touches(spark, tmp_path):
    """A small batch on a large table writes a few rows; over many batches a row is written again a few times; old files go."""
    path = str(tmp_path / "t")
    t = BucketTable(spark, path, ["k"], summed(["k"], "v"), 8)
    t.merge(pairs(spark, [(k, 1) for k in range(4000)]), 0)
    wrote = []
    for e in range(1, 13):
        t.merge(pairs(spark, [(k * 331 % 4000, 1) for k in range(e * 10, e * 10 + 10)]), e)
        wrote.append(spark.read.parquet(f"{path}/data/epoch={e}").count())
    assert max(wrote) <= 200 and sum(wrote) < 12 * 10 * 6
    got = t.read().agg(F.count("*"), F.sum("v")).first()
    assert tuple(got) == (4000, 4120)
    _, m = t.last()
    live = {(b, e) for k in t.epochs() for b, rs in t.manifest(k)["runs"].items() for e, _ in rs}
    have = {(b.partition("=")[2], int(e.partition("=")[2])) for e in files.names(spark, f"{path}/data") for b in files.names(spark, f"{path}/data/{e}")}
    assert have == live and max(len(r) for r in m["runs"].values()) <= 8


def test_bucket_table_after_a_crash_before_the_manifest(spark, tmp_path, monkeypatch):
    t = BucketTable(spark, str(tmp_path / "t"), ["k"], summed(["k"], "v"), 4)
    t.merge(pairs(spark, [(1, 1), (2, 1)]), 0)
    put = files.put
    monkeypatch.setattr(files, "put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        t.merge(pairs(spark, [(2, 5), (3, 5)]), 1)
    assert {r.k: r.v for r in t.read().collect()} == {1: 1, 2: 1}
    monkeypatch.setattr(files, "put", put)
    t.merge(pairs(spark, [(2, 5), (3, 5)]), 1)
    assert {r.k: r.v for r in t.read().collect()} == {1: 1, 2: 6, 3: 5}


def keyed(df):
    return {r.materialization_key: (r.n, round(r.value_sum, 6), round(r.weight_sum, 6), r.peak_value, tuple(sorted(r.sources)), r.window_end) for r in df.collect()}


def test_metric_streams_equal_the_batch(spark, sf, tmp_path, monkeypatch):
    """All 18 metrics: first the later part of the records, then the earlier part, repeats, and earlier first records of another source; and timed snapshots."""
    monkeypatch.setattr(streams, "BUCKETS", 2)
    monkeypatch.setattr(streams, "SHARES", 4)
    rec = views.records(spark, sf).orderBy("record_id").limit(60)
    early = rec.limit(20).withColumns({"record_id": F.concat(F.lit("early:"), "record_id"), "source_id": F.lit("src:other"), "occurred_at": F.date_trunc("day", "occurred_at")})
    src, path = str(tmp_path / "in"), str(tmp_path / "m")

    def play(rows):
        rows.coalesce(1).write.mode("append").parquet(src)
        stream = jobs.read_stream(spark, src, rec.schema)
        for q in (streams.start_sums(stream, path, f"{path}-a"), streams.start_firsts(stream, path, f"{path}-b")):
            assert q.awaitTermination(240)

    late = F.pmod(F.hash("record_id"), F.lit(3)) == 1
    play(rec.where(~late))
    assert keyed(streams.metric_state(spark, path)) == keyed(metrics.state_of_records(rec.where(~late)))
    refresh = streams.start_refresh(spark, path, f"{path}-c", {"processingTime": "1 second"}, dict.fromkeys(streams.CADENCE, 3.0))
    try:
        snaps = streams.snapshots_table(spark, path)
        until = time.time() + 40
        while not snaps.epochs() and time.time() < until:
            time.sleep(1)
        first = snaps.epochs()
        play(rec.where(late).unionByName(rec.limit(30)).unionByName(early))
        state = metrics.state_of_records(rec.unionByName(early))
        assert keyed(streams.metric_state(spark, path)) == keyed(state)
        want = {r.snapshot_id: r.metric_value for r in metrics.build_snapshots(state, metrics.registry(spark), NOW).collect()}
        same = lambda got: got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1.5e-4 for k in want)  # noqa: E731  a sum's order may turn a rounding
        got, until = {}, time.time() + 40
        while not same(got) and time.time() < until:
            time.sleep(2)
            got = {r.snapshot_id: r.metric_value for r in snaps.read().collect()}
        assert first and same(got)  # a timer brought the second refresh
    finally:
        refresh.stop()


def test_first_records_are_kept_by_places_in_few_files(spark, sf, tmp_path, monkeypatch):
    """No row for each scope, and one file a bucket for a small batch, however many tasks made it."""
    monkeypatch.setattr(streams, "SHARES", 2)
    rec, src, path = views.records(spark, sf).orderBy("record_id").limit(200), str(tmp_path / "in"), str(tmp_path / "m")
    rec.unionByName(rec).coalesce(1).write.parquet(src)
    assert streams.start_firsts(jobs.read_stream(spark, src, rec.schema), path, f"{path}-b").awaitTermination(240)
    keys = lambda k: rec.select("place_id", "admin0_place_id", "continent_place_id", F.date_trunc("day", "occurred_at"), k).distinct().count()
    data = f"{path}/firsts/data/epoch=0"
    assert spark.read.parquet(data).count() == keys("entity_id") + keys("source_id")
    assert all(len([x for x in files.names(spark, f"{data}/{b}") if x.endswith(".parquet")]) == 1 for b in ("bucket=0", "bucket=1"))


def test_publishing_twice_is_once(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    read = lambda: sorted(r.k for r in ingest.published(spark, target, "k long, v long").collect())
    assert read() == []
    assert ingest.stage_then_publish(pairs(spark, [(1, 1)]), target, "a") and not ingest.stage_then_publish(pairs(spark, [(9, 1)]), target, "a")
    put = files.put
    monkeypatch.setattr(files, "put", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        ingest.stage_then_publish(pairs(spark, [(2, 1), (3, 1)]), target, "b")
    monkeypatch.setattr(files, "put", put)
    assert read() == [1]
    for _ in range(2):
        ingest.stage_then_publish(pairs(spark, [(2, 1), (3, 1)]), target, "b")
    assert read() == [1, 2, 3]
    ingest.stage_then_publish(pairs(spark, [(7, 1)]), target, "c", "overwrite")
    ingest.stage_then_publish(pairs(spark, [(8, 1)]), target, "d")
    assert read() == [7, 8]


@pytest.mark.parametrize("crash", ["claimed", "written", "marked", "rows"])
def test_a_run_that_stops_leaves_no_row_twice_and_none_lost(spark, tmp_path, crash):
    t = lambda h: NOW + timedelta(hours=h)
    rows = spark.createDataFrame([(f"s{k % 3}", "b", k, t(k)) for k in range(40)], "source_id string, table_name string, id long, parsed_at timestamp")
    parses = rows.select("source_id", "table_name", "parsed_at", F.lit("success").alias("status"))
    fetches = spark.createDataFrame([("s0", t(-5), True), ("s3", t(1), True), ("s4", t(1), False)], "source_id string, fetched_at timestamp, success boolean")
    registry = spark.createDataFrame([("s0", "b", "http", True), ("s3", "b", "http", True), ("s4", "b", "http", True), ("s5", " ", "http", True)], "source_id string, table_name string, transport_type string, enabled boolean")
    changed = ledger.changes(parses, fetches, registry)
    book, target = ledger.Ledger(spark, str(tmp_path / "l")), str(tmp_path / "t")
    work = lambda x: x.select("id")

    def stop(step):
        if step == crash:
            raise InterruptedError

    def broken(x):
        return x.select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))

    with pytest.raises(Exception):
        ledger.run(book, rows, changed, broken if crash == "rows" else work, target, t(20), step=stop)
    assert ledger.run(book, rows, changed, work, target, t(30)) == (1 if crash == "marked" else 2)
    ledger.run(book, rows, changed, work, target, t(30))
    ledger.run(book, rows, changed, work, target, t(50))
    assert sorted(r.id for r in ingest.published(spark, target, "id long").collect()) == list(range(40))
    done = {(r.source_id, r.window_start, r.window_end): (r.status, r.input_rows) for r in book.read().collect()}
    assert done["s0", t(-5), t(20)] == ("success", 7) and done["s3", t(1), t(20)] == ("success", 0) and ("s4", t(1), t(20)) not in done
    assert all(s == "success" for s, _ in done.values()) and sum(n for _, n in done.values()) == 40
    again = str(tmp_path / "range")
    for _ in range(2):  # an explicit range is a window of its own, and runs once too
        ledger.run(book, rows, changed, work, again, t(60), t(3), t(6))
    assert sorted(r.id for r in ingest.published(spark, again, "id long").collect()) == [3, 4, 5]
    with pytest.raises(ValueError):
        ledger.windows(changed, t(60), t(3))
