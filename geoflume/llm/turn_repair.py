"""Conversations brought back to the form system? (user assistant)+ by the fewest edits, found by divide and conquer.

A repaired conversation is a word of a small automaton: START, after system,
after user, after assistant. Over a stretch of rows, forward and backward
vectors of four costs meet in its middle; the state in which the sum is least,
and among those the one with the ASCII-least audit, is where the best repair
crosses. Both halves are then solved between fixed states (Hirschberg), so
nothing but vectors and the answer is kept. To choose among ties without
strings, a forward vector also ranks the least audits of its states: these are
never prefixes of each other, so ranks of prefixes decide before what follows.

The same works between tasks. Rows are dealt by range of (conversation, turn,
role, text) and cut into bounded stretches; each gives its 4 x 4 costs and ranks,
a conversation's stretches are joined in order, and each is solved by itself
between the states where the best repair enters and leaves it. So a
conversation may be of any length; only its audit and digest are made in one
place, from a row per stretch.

Edge cases: a null conv_id is a conversation of its own; a null turn comes
first, and null roles and texts are one space. Rows of one turn are ordered by
role, then text; equal rows are kept as one with a count, so any number of them
weighs as one. Texts may be empty or of any length. Columns beyond the four are
left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoflume.llm.common import drop, stage, table

#: Rows and bytes of text of a stretch, about: what a task holds at once.
ROWS, BYTES = 1024, 8 << 20
#: Costs of the edits.
RENAME, DELETE, INSERT, BROKEN = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: The role that may come next in each state (system only at the start, and only by keeping a row).
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Inserts that end a conversation in each state.
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: Characters that are no text.
_SPACE = " \t\n\x0b\x0c\r"


def _move(state: int, n: int) -> int:
    for _ in range(n):
        state = _NEXT[state]
    return state


@lru_cache(None)
def steps(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """(state before, after) -> the cheapest (cost, ASCII-least edits) over a row. kind: 2 * its initial's state (0: other) + whether it is truncated."""
    own, broken = kind >> 1, kind & 1
    out: dict[tuple[int, int], tuple[int, str]] = {}
    for s in STATES:
        for n in range(3):
            at = _move(s, n)
            ways = [(at, DELETE, "D"), (_NEXT[at], RENAME + BROKEN * broken, "R")]
            if own == _NEXT[at] or (own == SYSTEM and at == START):
                ways.append((own, BROKEN * broken, "K"))
            for t, cost, edit in ways:
                way = (cost + INSERT * n, "I" * n + edit)
                out[s, t] = min(out.get((s, t), way), way)
    return out


#: A forward vector: for each state the cost and the rank of its least audit, or None.
Vector = tuple


def _ranked(best: dict[int, tuple]) -> tuple[int, Vector]:
    """(least cost, vector) of state -> (cost, what orders the audits)."""
    order = {x: i for i, x in enumerate(sorted(v[1:] for v in best.values()))}
    base = min(v[0] for v in best.values())
    return base, tuple((best[t][0] - base, order[best[t][1:]]) if t in best else None for t in STATES)


@lru_cache(None)
def forward(v: Vector, kind: int) -> tuple[int, Vector]:
    """The vector after a row, less its least cost. There are few different vectors, so this is a lookup."""
    best: dict[int, tuple] = {}
    for (s, t), (cost, edits) in steps(kind).items():
        if v[s] is not None:
            way = (v[s][0] + cost, v[s][1], edits)
            best[t] = min(best.get(t, way), way)
    return _ranked(best)


@lru_cache(None)
def backward(v: tuple, kind: int) -> tuple:
    """Costs to the end from before a row, from those after it, less the least."""
    out = [min((cost + v[t] for (a, t), (cost, _) in steps(kind).items() if a == s and v[t] is not None), default=None) for s in STATES]
    base = min(x for x in out if x is not None)
    return tuple(None if x is None else x - base for x in out)


def only(s: int) -> Vector:
    return tuple((0, 0) if t == s else None for t in STATES)


def across(kinds: bytes) -> tuple[list[int], list[int]]:
    """Costs and ranks, four by four, from every state before the rows to every one after them; -1 where there is no way."""
    costs, ranks = [], []
    for s in STATES:
        v, total = only(s), 0
        for k in kinds:
            base, v = forward(v, k)
            total += base
        costs += [-1 if x is None else total + x[0] for x in v]
        ranks += [-1 if x is None else x[1] for x in v]
    return costs, ranks


def solve(kinds: bytes, s: int, t: int) -> list[str]:
    """The edits of each row, with its inserts before it, of the cheapest, then ASCII-least way from state s to state t."""
    out: list[str] = []
    todo = [(0, len(kinds), s, t)]
    while todo:
        low, high, s, t = todo.pop()
        if high - low == 1:
            out.append(steps(kinds[low])[s, t][1])
        elif high > low:
            mid = (low + high) // 2
            v = only(s)
            for i in range(low, mid):
                v = forward(v, kinds[i])[1]
            w = tuple(0 if x == t else None for x in STATES)
            for i in range(high - 1, mid - 1, -1):
                w = backward(w, kinds[i])
            _, _, x = min((v[x][0] + w[x], v[x][1], x) for x in STATES if v[x] is not None and w[x] is not None)
            todo += [(mid, high, x, t), (low, mid, s, x)]
    return out


def join_stretches(parts: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """(cost, state at each border) of the best repair over stretches given by their costs and ranks; the first border is START."""
    v: dict[int, tuple[int, int]] = {START: (0, 0)}
    came = []
    for costs, ranks in parts:
        best: dict[int, tuple] = {}
        for s, (cost, rank) in v.items():
            for t in STATES:
                if costs[4 * s + t] >= 0:
                    way = (cost + costs[4 * s + t], rank, ranks[4 * s + t], s)
                    best[t] = min(best.get(t, way), way)
        came.append({t: w[3] for t, w in best.items()})
        order = {x: i for i, x in enumerate(sorted(w[1:3] for w in best.values()))}
        v = {t: (w[0], order[w[1:3]]) for t, w in best.items()}
    cost, _, t = min((c + INSERT * TAIL[t], r, t) for t, (c, r) in v.items())
    border = [t]
    for back in reversed(came):
        border.append(back[border[-1]])
    return cost, border[::-1]


def edit_lines(edits: str, state: int, role: str, text: str) -> tuple[int, list[str]]:
    """The state after a row's edits, and the lines that they leave of it."""
    lines = []
    for e in edits:
        if e == "D":
            continue
        if e == "K":
            state = _INITIAL[role[:1]]
            lines.append(f"{role}:{text}")
        else:
            state = _NEXT[state]
            lines.append(f"{_ROLE[state]}:{text if e == 'R' else ''}")
    return state, lines


def damage(df: DataFrame) -> DataFrame:
    """The stated damage, by crc32 of `conv_id:turn`: a row dropped, emptied, without sentence marks, repeated, or given to the user. `copies` counts equal rows."""
    of = F.pmod(F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" "))).cast("binary")), F.lit(20))
    x = _filled(df).withColumn("of", of).where("of <> 0")
    text = F.when(F.col("of") == 1, "").when(F.col("of") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return x.select("conv_id", "turn", F.when(F.col("of") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("of") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _filled(df: DataFrame) -> DataFrame:
    return df.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(x).cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")])


def _key() -> Column:
    """A text key of conv_id under which null is a value too."""
    return F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))


def _ordered(rows: DataFrame) -> DataFrame:
    """The rows in their order, each with its task, place and stretch, and whether the task hasn't met its role and text before."""
    x = rows.groupBy(_key().alias("k"), "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    bare = F.rtrim("text", F.lit(_SPACE))
    x = x.withColumns({"blank": bare == "", "broken": ~F.right(bare, F.lit(1)).isin(".", "!", "?"), "h": F.sha2(F.concat_ws("\0", "role", "text"), 256)})
    order = ["k", F.asc_nulls_first("turn"), "role", "text"]
    x = x.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()).drop("turn")

    def run(batches):
        seen, last, at, seg, rows_, bytes_ = set(), None, 0, 0, 0, 0
        for p in batches:
            idx, segs, first = [], [], []
            for k, h, blank, text in zip(p["k"], p["h"], p["blank"], p["text"]):
                if k != last:
                    seen, last = set(), k
                if rows_ >= ROWS or bytes_ >= BYTES:
                    seg, rows_, bytes_ = seg + 1, 0, 0
                rows_, bytes_ = rows_ + 1, bytes_ + len(text)
                idx.append(at)
                segs.append(seg)
                first.append(not blank and h not in seen)
                seen.add(h)
                at += 1
            yield p.assign(idx=idx, seg=segs, first=first)

    return x.mapInPandas(run, "k string, role string, text string, copies long, blank boolean, broken boolean, h string, pid int, idx long, seg long, first boolean")


def _stretches(df: DataFrame):
    """df dealt by stretch and sorted; what marks a row (order 0) comes before it (order 1)."""
    return df.repartition("pid", "seg", "k").sortWithinPartitions("pid", "seg", "k", "idx", "mark")


def _runs(batches, key: list[str]):
    """(key, rows as dicts) of consecutive rows with the same key."""
    now, held = None, []
    for p in batches:
        for r in p.to_dict("records"):
            k = tuple(r[x] for x in key)
            if k != now and held:
                yield now, held
                held = []
            now = k
            held.append(r)
    if held:
        yield now, held


def _read(rows: list[dict]) -> tuple[bytes, list[dict], dict | None]:
    """(kinds of the rows that may stay, all rows, the stretch's marker): rows said to come late are duplicates."""
    late, kinds, out, marker = -1, bytearray(), [], None
    for r in rows:
        if r["mark"] == 0:
            if r["idx"] < 0:
                marker = r
            late = r["idx"]
            continue
        r["stays"] = bool(r["first"]) and r["idx"] != late
        if r["stays"]:
            kinds.append(2 * _INITIAL.get(r["role"][:1], 0) + bool(r["broken"]))
        out.append(r)
    return bytes(kinds), out, marker


_LEGAL = ("su", "ua", "au")


def _summary(batches):
    """For each conversation and stretch: costs, ranks, counts, and the first and last role's initial."""
    import pandas as pd

    got = []
    for (pid, seg, k), rows in _runs(batches, ["pid", "seg", "k"]):
        kinds, rows, _ = _read(rows)
        costs, ranks = across(kinds)
        initials = [r["role"][:1] for r in rows]
        blank = sum(r["copies"] for r in rows if r["blank"])
        duplicate = sum(r["copies"] - r["stays"] for r in rows if not r["blank"])
        illegal = sum(r["copies"] - 1 for r in rows) + sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
        got.append((k, pid, seg, costs, ranks, blank, duplicate, sum(x & 1 for x in kinds), illegal, initials[0], initials[-1]))
        if len(got) >= 4096:
            yield pd.DataFrame(got, columns=_SUMMARY)
            got = []
    yield pd.DataFrame(got, columns=_SUMMARY)


_SUMMARY = ["k", "pid", "seg", "costs", "ranks", "blank", "duplicate", "truncated", "illegal", "head", "tail"]


def _borders(batches):
    """For each stretch the states where the best repair enters and leaves it; a conversation's last stretch holds its totals."""
    import pandas as pd

    cols = ["k", "pid", "seg", "enter", "leave", "last", "blank", "duplicate", "truncated", "illegal", "cost"]
    got = []
    for (k,), parts in _runs(batches, ["k"]):
        cost, border = join_stretches([(p["costs"], p["ranks"]) for p in parts])
        blank, duplicate, truncated, illegal = (sum(p[x] for p in parts) for x in ("blank", "duplicate", "truncated", "illegal"))
        illegal += sum(a["tail"] + b["head"] not in _LEGAL for a, b in zip(parts, parts[1:]))
        for i, p in enumerate(parts):
            end = i == len(parts) - 1
            got.append((k, p["pid"], p["seg"], border[i], border[i + 1], end, *((blank, duplicate, truncated, illegal, cost + DELETE * (blank + duplicate)) if end else (0,) * 5)))
        if len(got) >= 4096:
            yield pd.DataFrame(got, columns=cols)
            got = []
    yield pd.DataFrame(got, columns=cols)


def _repaired(batches):
    """A row for each conversation and stretch: its audit and its lines."""
    import pandas as pd

    got, size = [], 0
    for (pid, seg, k), rows in _runs(batches, ["pid", "seg", "k"]):
        kinds, rows, marker = _read(rows)
        state, edits = int(marker["enter"]), iter(solve(kinds, int(marker["enter"]), int(marker["leave"])))
        audit, lines = [], []
        for r in rows:
            if r["stays"]:
                e = next(edits)
                state, made = edit_lines(e, state, r["role"], r["text"])
                audit.append(e)
                lines += made
            audit.append("D" * (r["copies"] - r["stays"]))
        if marker["last"]:
            audit.append("I" * TAIL[state])
            lines += edit_lines(audit[-1], state, "", "")[1]
        got.append((k, pid, seg, "".join(audit), len(lines), "\n".join(lines)))
        size += len(got[-1][-1])
        if len(got) >= 4096 or size >= BYTES:
            yield pd.DataFrame(got, columns=_PIECE)
            got, size = [], 0
    yield pd.DataFrame(got, columns=_PIECE)


_PIECE = ["k", "pid", "seg", "audit", "n", "body"]


def _joined(batches):
    """Audit and digest of each conversation, stretch by stretch."""
    import pandas as pd

    now, audit, digest, some, got = None, [], None, False, []
    for p in batches:
        for k, a, n, body in zip(p["k"], p["audit"], p["n"], p["body"]):
            if k != now:
                if now is not None:
                    got.append((now, "".join(audit), digest.hexdigest()))
                now, audit, digest, some = k, [], hashlib.sha256(), False
            audit.append(a)
            if n:
                digest.update(("\n" * some + body).encode())
                some = True
        if len(got) >= 4096:
            yield pd.DataFrame(got, columns=["k", "audit", "repaired_sha256"])
            got = []
    if now is not None:
        got.append((now, "".join(audit), digest.hexdigest()))
    yield pd.DataFrame(got, columns=["k", "audit", "repaired_sha256"])


def _marked(t: DataFrame):
    late = t.where("first").groupBy("k", "h").agg(F.min(F.struct("pid", "idx")).alias("f"), F.collect_list(F.struct("pid", "idx", "seg")).alias("all"))
    late = late.where(F.size("all") > 1).select("k", "f", F.explode("all").alias("x")).where((F.col("x.pid") != F.col("f.pid")) | (F.col("x.idx") != F.col("f.idx")))
    return late.select("k", "x.pid", "x.seg", "x.idx", F.lit(0).alias("mark"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(audits, pieces): k, audit, repaired_sha256, blank, duplicate, truncated, illegal, cost of each conversation; and its repaired text by stretch.

    rows: conv_id, turn, role, text, copies. k is the conversation's key, '=' and its conv_id, or '' for null.
    """
    t = stage(_ordered(rows), "turns")
    late = stage(_marked(t), "turns-late")  # one row a task for each text that is met again, at most
    cols = ["k", "pid", "seg", "idx", "mark", "role", "copies", "blank", "broken", "first"]
    own = t.withColumn("mark", F.lit(1))
    small = own.select(*cols).unionByName(late, allowMissingColumns=True)
    schema = "k string, pid int, seg long, costs array<long>, ranks array<int>, blank long, duplicate long, truncated long, illegal long, head string, tail string"
    parts = _stretches(small.withColumn("copies", F.coalesce("copies", F.lit(0)))).mapInPandas(_summary, schema)
    parts = parts.repartition("k").sortWithinPartitions("k", "pid", "seg")
    borders = stage(parts.mapInPandas(_borders, "k string, pid int, seg long, enter int, leave int, last boolean, blank long, duplicate long, truncated long, illegal long, cost long"), "turns-borders")
    whole = own.select(*cols, "text").unionByName(late, allowMissingColumns=True).withColumn("copies", F.coalesce("copies", F.lit(0)))
    whole = whole.unionByName(borders.select("k", "pid", "seg", F.lit(-1).cast("long").alias("idx"), F.lit(0).alias("mark"), "enter", "leave", "last"), allowMissingColumns=True)
    whole = whole.withColumn("copies", F.coalesce("copies", F.lit(0)))
    pieces = stage(_stretches(whole).mapInPandas(_repaired, "k string, pid int, seg long, audit string, n long, body string"), "turns-repaired")
    audits = pieces.repartition("k").sortWithinPartitions("k", "pid", "seg").mapInPandas(_joined, "k string, audit string, repaired_sha256 string")
    drop(t, late)
    return audits.join(borders.where("last").select("k", "blank", "duplicate", "truncated", "illegal", "cost"), "k"), pieces


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damages the conversations, repairs them, and reports a row for each original one."""
    c = table(spark, sf_dir, "conversations")
    rows = damage(c)
    audits, _ = repair(rows)
    turns = rows.groupBy(_key().alias("k")).agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0).cast("long")).alias("gaps"))
    out = c.select("conv_id").distinct().withColumn("k", _key()).join(turns, "k", "left").join(audits, "k", "left")
    zero = [F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
