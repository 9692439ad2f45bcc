"""Subtree labels against the closure, before and after moves."""

import random

import pytest
from pyspark.sql import functions as F

from geoflume.operators import metrics, places, tree

SCHEMA = "place_id string, parent_place_id string, admin_level int, place_type string, min_lat double, min_lon double, max_lat double, max_lon double"


def made(spark, parents):
    rnd = random.Random(5)
    rows = []
    for k, p in parents.items():
        lat, lon = rnd.uniform(-80, 80), rnd.uniform(-170, 170)
        rows.append((k, p, rnd.choice([0, 1, 2, 3, None]), rnd.choice(["continent", "area", "area", None]), lat, lon, lat + 1, lon + 1))
    return spark.createDataFrame(rows, SCHEMA)


def parents_of(n=60):
    rnd = random.Random(3)
    out = {"p0": "", "p1": "gone", "p2": " "}
    for k in range(3, n):
        out[f"p{k}"] = f"p{rnd.randrange(max(0, k - 12), k)}"
    return out


def rows_of(df, cols):
    return {r.place_id: tuple(r[c] for c in cols) for r in df.collect()}


LINE = ["path", *[f"admin{k}_place_id" for k in range(5)], "continent_place_id", "deepest_level", "parent_missing"]
BOX = ["min_lat", "min_lon", "max_lat", "max_lon", "deepest_level", "n_places"]


def test_labels_equal_the_closure(spark):
    p = made(spark, parents_of())
    t = tree.labels(p)
    assert rows_of(tree.lineage(t), LINE) == rows_of(places.lineage(p), LINE)
    known = p.select("place_id")
    assert rows_of(tree.bounds(t), BOX) == rows_of(places.bounds_and_depth(p).join(known, "place_id"), BOX)
    below = {r.descendant_id for r in places.closure(p).where("ancestor_id = 'p5'").collect()}
    key = t.where("place_id = 'p5'").first().key
    assert {r.place_id for r in tree.subtree(t, key).collect()} == below


def test_moves_change_only_branches_and_ancestors(spark):
    parents = parents_of()
    t = tree.labels(made(spark, parents))
    old = rows_of(t, t.columns)
    leaf = max(parents, key=lambda k: old[k][t.columns.index("depth")])
    moves = {leaf: "p0", "p7": leaf, "p2": "p1", "nobody": "p0"}
    up = lambda k, of: {k} | (up(of[k], of) if of.get(k, "").strip() in of else set())
    after = {**parents, **{k: v for k, v in moves.items() if k in parents}}
    if leaf in up("p7", parents) or "p7" in up(leaf, after) - {leaf}:
        pytest.fail("the moves of this test make a cycle")
    m = spark.createDataFrame(list(moves.items()), "place_id string, parent_place_id string")
    changed = tree.relabel(t, m)
    got = rows_of(t.join(changed, "place_id", "left_anti").unionByName(changed), t.columns)
    assert got == rows_of(tree.labels(made(spark, after)), t.columns)
    touched = {r.place_id for r in changed.select("place_id").collect()}
    gone = set(moves) & set(parents)
    allowed = {k for k in parents if up(k, parents) & gone or up(k, after) & gone} | {x for k in gone for x in up(k, parents) | up(k, after)}
    assert touched <= allowed and len(touched) < len(parents)
    assert tree.relabel(t, m.where("false")).count() == 0
    with pytest.raises(ValueError):
        tree.relabel(t, spark.createDataFrame([("p0", "p7")], m.schema), 20).count()


def test_places_without_others_below_are_not_looked_up(spark, monkeypatch):
    """The last level is neither joined nor totalled: no empty round, and tables of totals and labels hold inner places only; moves don't write the tree's keys anew."""
    wrote, real = [], tree.staged
    monkeypatch.setattr(tree, "staged", lambda df, name="x": (lambda out: wrote.append((name, out.count(), out.columns)) or out)(real(df, name)))
    t = tree.labels(made(spark, {"w": "", "c": "w", "d": "w", **{f"o{k}": "c" for k in range(40)}}))
    assert sorted(r.n_places for r in t.collect()) == [1] * 41 + [41, 43]
    assert [n for name, n, _ in wrote if name == "tree"] == [1, 2, 40]
    assert sum(n for name, n, _ in wrote if name in ("tree-totals", "tree-labels")) == 4
    wrote.clear()
    moved = tree.relabel(t, spark.createDataFrame([("o1", "d")], "place_id string, parent_place_id string"))
    assert {r.place_id: (r.path, r.n_places) for r in moved.collect()} == {"o1": ("w>d>o1", 1), "w": ("w", 43), "c": ("w>c", 40), "d": ("w>d", 2)}
    assert not any(n > 10 and "key" in cols for _, n, cols in wrote)


def test_cycles_empty_tables_and_deep_trees(spark):
    with pytest.raises(ValueError, match="cycle"):
        tree.labels(made(spark, {"a": "b", "b": "a", "c": ""}))
    assert tree.labels(made(spark, {"a": ""}).where("false")).count() == 0
    deep = tree.labels(made(spark, {f"d{k:02}": f"d{k - 1:02}" if k else "" for k in range(9)}))
    assert [r.n_places for r in deep.orderBy("depth").collect()] == list(range(9, 0, -1))


def test_rollup_by_levels_equals_the_closure(spark):
    p = made(spark, parents_of(25))
    s = p.select(F.lit("m").alias("metric_id"), F.lit("day").alias("window_grain"), F.timestamp_seconds(F.lit(0)).alias("window_start"), F.lit("place").alias("subject_grain"), "place_id", F.length("place_id").cast("double").alias("metric_value"))
    s = s.unionByName(s.where("place_id > 'p2'").withColumn("metric_id", F.lit("o")))
    key = ["metric_id", "ancestor_id", "metric_value"]
    known = p.select(F.col("place_id").alias("ancestor_id"))
    want = metrics.rollup_places(s, places.closure(p)).join(known, "ancestor_id", "left_semi")
    assert {tuple(r) for r in tree.rollup(tree.labels(p), s).select(*key).collect()} == {tuple(r) for r in want.select(*key).collect()}
