"""Subtree labels: a place tree of any size walked level by level, and branches labelled anew when they move.

closure() of operators.places makes a row for every place and ancestor. Here a
place has one row: its lineage, a key that makes its subtree a range, and the
box, deepest level and size of its subtree. A key is the ids from the root, each
ended by SEP, so the subtree of x is all keys that start with x's key, and in the
order of keys it is one unbroken range.

Labels go down from the roots and totals come up from the leaves, a level a
round; a round's rows are those of its level, so all rounds together hold each
place once. Tables of rounds go to the shared folder. Ids must be unique and
hold no SEP. A place that no root leads to lies on a cycle, which is an error.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoflume.functions.cols import blank, round4
from geoflume.operators.places import MAX_LEVELS
from geoflume.sources.files import staged

SEP = "\x01"
_OWN = ["place_id", "parent_place_id", "admin_level", "place_type", "min_lat", "min_lon", "max_lat", "max_lon"]
_LINE = ["depth", "key", "path", *[f"admin{k}_place_id" for k in range(5)], "continent_place_id", "deepest_level", "parent_missing"]
_TOTALS = ["sub_min_lat", "sub_min_lon", "sub_max_lat", "sub_max_lon", "sub_level", "n_places"]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _nodes(places: DataFrame) -> DataFrame:
    parent = F.when(blank("parent_place_id"), F.lit("")).otherwise(F.col("parent_place_id"))
    return places.where(~blank("place_id")).withColumn("parent_place_id", parent).select(*_OWN)


def _root_line() -> list[Column]:
    """What a root inherits."""
    text = lambda k: F.lit("").alias(k)
    return [F.lit(-1).alias("depth"), text("key"), F.lit(None).cast("string").alias("path"), *[text(f"admin{k}_place_id") for k in range(5)], text("continent_place_id"), F.lit(None).cast("int").alias("deepest_level"), (F.col("parent_place_id") != "").alias("parent_missing")]


def _inherit(rows: DataFrame) -> DataFrame:
    """Lines of places (alias n) from the lines of their parents (alias p)."""
    me, kind = F.col("n.place_id"), F.col("n.place_type")
    own = lambda when: F.when(when, me).otherwise(F.lit(""))
    admin = [F.greatest(F.col(f"p.admin{k}_place_id"), own((F.col("n.admin_level") == k) & (kind != "continent"))).alias(f"admin{k}_place_id") for k in range(5)]
    return rows.select(
        *[F.col(f"n.{x}") for x in (*_OWN, "inner")], (F.col("p.depth") + 1).alias("depth"), F.concat("p.key", me, F.lit(SEP)).alias("key"), F.concat_ws(">", "p.path", me).alias("path"), *admin,
        F.greatest(F.col("p.continent_place_id"), own(kind == "continent")).alias("continent_place_id"), F.greatest("p.deepest_level", F.col("n.admin_level").cast("int")).alias("deepest_level"), F.col("p.parent_missing").alias("parent_missing"),
    )


def _down(first: DataFrame, nodes: DataFrame, max_levels: int) -> list[DataFrame]:
    """Lines of the first places and of all below them, a table a level. nodes: with inner, whether a place has others below it; the rest is never looked up."""
    levels = [staged(first, "tree")]
    while not (above := levels[-1].where("inner")).isEmpty():
        if len(levels) > max_levels:
            raise ValueError(f"more than {max_levels} levels of places, or a cycle")
        kids = nodes.alias("n").join(above.alias("p"), F.col("n.parent_place_id") == F.col("p.place_id"))
        levels.append(staged(_inherit(kids), "tree"))
    return levels


def _own(level: DataFrame) -> DataFrame:
    """A place's own part of its totals."""
    return level.select("place_id", "parent_place_id", *[F.col(x).alias(f"sub_{x}") for x in _OWN[4:]], F.col("admin_level").alias("sub_level"), F.lit(1).cast("long").alias("n_places"))


def _up(levels: list[DataFrame], kept: list[DataFrame | None]) -> DataFrame:
    """Totals of the inner places of the levels, deepest last; those of others are their own. kept[i]: places below level i that are no rows of a level, with totals that hold."""
    box = [F.min("sub_min_lat"), F.min("sub_min_lon"), F.max("sub_max_lat"), F.max("sub_max_lon"), F.max("sub_level"), F.sum("n_places")]
    done: list[DataFrame] = []
    below: list[DataFrame] = []
    for level, others in zip(reversed(levels), reversed(kept)):
        inner = _own(level.where("inner"))
        parts = [x.select(F.col("parent_place_id").alias("place_id"), *_TOTALS) for x in (*below, *([] if others is None else [others]))]
        total = _union([inner.select("place_id", *_TOTALS), *parts]).groupBy("place_id").agg(*[a.alias(n) for a, n in zip(box, _TOTALS)])
        done.append(staged(total.join(inner.select("place_id", "parent_place_id"), "place_id"), "tree-totals"))
        below = [done[-1], _own(level.where("not inner"))]
    return _union(done).select("place_id", *_TOTALS)


def labels(places: DataFrame, max_levels: int = MAX_LEVELS) -> DataFrame:
    """A row per place: its own columns, _LINE and _TOTALS. Blank ids are left out; a parent that isn't there makes a root with parent_missing."""
    return _labels(places, max_levels).select(*_OWN, *_LINE, *_TOTALS)


def _labels(places: DataFrame, max_levels: int) -> DataFrame:
    """labels, with inner. Places without others below them, mostly the larger part, are read from their level's table as it was written."""
    nodes = _nodes(places)
    ids = nodes.select(F.col("parent_place_id").alias("place_id")).distinct().withColumn("inner", F.lit(True))
    nodes = staged(nodes.join(ids, "place_id", "left").withColumn("inner", F.coalesce("inner", F.lit(False))).select(*_OWN, "inner"), "tree-nodes")
    known = nodes.where("inner").select(F.col("place_id").alias("parent_place_id"))
    roots = nodes.join(known, "parent_place_id", "left_anti").select(*_OWN, "inner")
    first = roots.alias("n").join(roots.select(F.col("place_id"), *_root_line()).alias("p"), "place_id")
    levels = _down(_inherit(first), nodes, max_levels)
    lines = _union(levels)
    if lines.count() != nodes.count():
        raise ValueError("places on a cycle, or ids that aren't unique")
    inner = staged(lines.where("inner").join(_up(levels, [None] * len(levels)), "place_id").select(*_OWN, "inner", *_LINE, *_TOTALS), "tree-labels")
    own = dict(zip(_TOTALS, [F.col(x).alias(f"sub_{x}") for x in _OWN[4:]] + [F.col("admin_level").alias("sub_level"), F.lit(1).cast("long").alias("n_places")]))
    return inner.unionByName(lines.where("not inner").select(*_OWN, "inner", *_LINE, *own.values()))


def lineage(tree: DataFrame) -> DataFrame:
    """The columns of places.lineage."""
    return tree.select("place_id", *[x for x in _LINE if x not in ("depth", "key")])


def bounds(tree: DataFrame) -> DataFrame:
    """The columns of places.bounds_and_depth."""
    return tree.select("place_id", *[F.col(f"sub_{x}").alias(x) for x in _OWN[4:]], F.col("sub_level").alias("deepest_level"), "n_places")


def subtree(tree: DataFrame, key: str) -> DataFrame:
    """The place of this key and all below it: one range of keys, which reaches the scan as a filter."""
    return tree.where(F.col("key").startswith(key))


def relabel(tree: DataFrame, moves: DataFrame, max_levels: int = MAX_LEVELS) -> DataFrame:
    """Only the rows of a tree that change when places get new parents (place_id, parent_place_id; the last place of a chain of moves may hang below another moved one).

    Branches that move get new lines. Totals are made anew only for the
    ancestors, old and new, of what moved, out of the totals of their children.
    Moves of unknown places are ignored; a move below itself is an error. Write
    the rows with versions.upsert on place_id.
    """
    new = staged(moves.select("place_id", F.when(blank("parent_place_id"), F.lit("")).otherwise(F.col("parent_place_id")).alias("to")), "tree-moves")
    goals = new.select(F.col("to").alias("place_id")).distinct().withColumn("goal", F.lit(True))
    # a place that may have others below it: it has had, or some move there. Keys and paths, the wide part of a row, stay in the tree
    now = tree.select(*_OWN, *_TOTALS).join(new, "place_id", "left").join(goals, "place_id", "left").withColumn("parent_place_id", F.coalesce("to", "parent_place_id"))
    now = staged(now.select(*_OWN, *_TOTALS, ((F.col("n_places") > 1) | F.col("goal").isNotNull()).alias("inner"), F.col("to").isNotNull().alias("moved")), "tree-moved")
    moved = now.where("moved").select(*_OWN, "inner")
    lines = tree.join(goals, "place_id", "left_semi").select(F.col("place_id").alias("at"), *_LINE)
    start = moved.join(lines, F.col("parent_place_id") == F.col("at"), "left")
    root = [F.when(F.col("at").isNull(), r).otherwise(F.col(x)).alias(x) for x, r in zip(_LINE, _root_line())]
    first = moved.alias("n").join(start.select("place_id", *root).alias("p"), "place_id")
    walks = _down(_inherit(first), now.select(*_OWN, "inner"), max_levels)
    # of a place that several walks met, the walk from the topmost moved place took most steps, and only that one began at a line that holds
    walked = _union([w.withColumn("step", F.lit(i)) for i, w in enumerate(walks)])
    own = [*_OWN, "inner"]
    lined = staged(walked.groupBy("place_id").agg(F.max_by(F.struct(*own[1:], *_LINE), "step").alias("x")).select("place_id", "x.*"), "tree-lines")

    ids = lambda df: df.select(F.explode(F.split("key", SEP)).alias("place_id")).where("place_id <> ''")
    mine = new.select("place_id")
    todo = staged(ids(tree.join(mine, "place_id", "left_semi")).union(ids(lined.join(mine, "place_id", "left_semi"))).distinct(), "tree-ids")
    still = tree.select(*_OWN, *_LINE).join(todo, "place_id", "left_semi").join(lined.select("place_id"), "place_id", "left_anti").withColumn("inner", F.lit(True))
    todo = staged(lined.join(todo, "place_id", "left_semi").unionByName(still), "tree-todo")
    most = todo.agg(F.max("depth")).first()[0]
    if most is None:
        return tree.limit(0)
    above = todo.select(F.col("place_id").alias("parent_place_id"), (F.col("depth") + 1).alias("depth"))
    kept = now.select("place_id", "parent_place_id", *_TOTALS).join(above, "parent_place_id").join(todo.select("place_id"), "place_id", "left_anti")
    kept = staged(kept.select("place_id", "parent_place_id", "depth", *_TOTALS), "tree-kept")
    totals = _up([todo.where(F.col("depth") == d) for d in range(most + 1)], [kept.where(F.col("depth") == d + 1) for d in range(most + 1)])
    totals = totals.select("place_id", *[F.col(x).alias(f"new_{x}") for x in _TOTALS])
    rows = lined.unionByName(todo.join(lined.select("place_id"), "place_id", "left_anti"))
    out = rows.join(now.select("place_id", *_TOTALS), "place_id").join(totals, "place_id", "left")
    fresh = F.col("new_n_places").isNotNull()
    return staged(out.select(*_OWN, *_LINE, *[F.when(fresh, F.col(f"new_{x}")).otherwise(F.col(x)).alias(x) for x in _TOTALS]), "tree-changed")


def rollup(tree: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Values of places summed into all of their ancestors, as metrics.rollup_places has it: level by level, so sums go up and not rows."""
    keys = ["metric_id", "window_grain", "window_start"]
    up = tree.select("place_id", "parent_place_id", "depth")
    own = staged(snapshots.where("subject_grain = 'place'").groupBy(*keys, "place_id").agg(F.sum("metric_value").alias("v")).join(up, "place_id"), "tree-values")
    done: list[DataFrame] = []
    for d in range(own.agg(F.max("depth")).first()[0] or 0, -1, -1):
        level = own.where(F.col("depth") == d).select(*keys, "place_id", "v")
        if done:
            level = level.unionByName(done[-1].select(*keys, F.col("parent_place_id").alias("place_id"), "v"))
        level = level.groupBy(*keys, "place_id").agg(F.sum("v").alias("v"))
        done.append(staged(level.join(up.where(F.col("depth") == d), "place_id"), "tree-values"))
    return _union(done).select(*keys, F.col("place_id").alias("ancestor_id"), round4(F.col("v")).alias("metric_value"))
