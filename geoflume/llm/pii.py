"""Personal data: fixed patterns, and terms that reveal what the patterns protect.

Every pattern match is a protected entity. How much a nearby term t tells about
an entity e is their pointwise mutual information over the corpus's documents,
as a share of the entity's own information: log(n(e,t) D / (n(e) n(t))) /
log(D / n(e)). Terms whose share reaches the threshold are generalised too.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoflume.llm.common import stage, texts

KINDS = ("email", "ip", "card", "phone")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: The stated pattern begins at a run's first digit or nowhere in it, and takes whole runs: said so, a long number is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Terms are words within so many characters of an entity, at most so many on each side.
CONTEXT_CHARS, CONTEXT_WORDS = 120, 5
#: A term is generalised from this share of the entity's information on, if both met in so many documents.
THRESHOLD, SUPPORT = 0.9, 2
_TRIM = ".,;:!?()[]{}\"'"
_TRIM_BYTES = _TRIM.encode()
#: A term has three characters at least and a letter; apostrophes and hyphens may join its parts.
_TERM = re.compile(r"(?=.{3})(?=.*[^\W\d_])[^\W_]+(?:['’-][^\W_]+)*", re.S)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Documents with revealing terms up to which their terms are broadcast; beyond, they are joined by shuffle.
BROADCAST_DOCS = 100_000


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(t: str) -> Iterator[tuple[int, int]]:
    """The matches of local part and domain, found from each @ outwards, so plain words cost nothing."""
    at, end = t.find("@"), 0
    while at >= 0:
        start = at
        while start > end and t[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(t, at)):
            yield start, m.end()
            end = m.end()
        at = t.find("@", max(at + 1, end))


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(kind's number, start, end) in code points, by kind, then start."""
    out = [(0, s, e) for s, e in _emails(t)]
    if _DIGIT.search(t):
        out += [(1, *m.span()) for m in _IP.finditer(t) if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 13 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                out.append((2, *m.span()))
        if "+" in t:
            out += [(3, *m.span()) for m in _PHONE.finditer(t) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


def _hash(x: bytes) -> int:
    return xxhash.xxh3_64_intdigest(x) - (1 << 63)


def context_terms(t: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(entity, term, start, end) of the words near each span that no span covers."""
    out = []
    covered = [(s, e) for _, s, e in spans]
    for k, s, e in spans:
        entity = _hash(f"{KINDS[k]}:{t[s:e].lower()}".encode())
        low, high = max(0, s - CONTEXT_CHARS), min(len(t), e + CONTEXT_CHARS)
        before = [(m.start() + low, m.end() + low) for m in _WORD.finditer(t[low:s])]
        after = [(m.start() + e, m.end() + e) for m in _WORD.finditer(t[e:high])]
        if before and before[0][0] == low and low and t[low - 1] not in " \t\n\x0b\x0c\r":
            before.pop(0)
        if after and after[-1][1] == high and high < len(t) and t[high] not in " \t\n\x0b\x0c\r":
            after.pop()
        for a, b in before[-CONTEXT_WORDS:] + after[:CONTEXT_WORDS]:
            word = t[a:b].lstrip(_TRIM)
            a = b - len(word)
            word = word.rstrip(_TRIM)
            b = a + len(word)
            if _TERM.fullmatch(word) and not any(x < b and a < y for x, y in covered):
                out.append((entity, _hash(word.encode().lower()), a, b))
    return out


def _find_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    near = pa.list_(pa.struct([("e", pa.int64()), ("t", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        counts, base, shas, terms = [[] for _ in KINDS], [], [], []
        for raw in b.column(1):
            t = raw.as_py().decode("utf-8", "replace")
            spans = base_spans(t)
            n = Counter(k for k, _, _ in spans)
            for k, c in enumerate(counts):
                c.append(n[k])
            base.append(",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans))
            shas.append(hashlib.sha256(base[-1].encode()).hexdigest())
            terms.append([dict(zip(("e", "t", "start", "end"), x)) for x in context_terms(t, spans)] if spans else [])
        cols = [b.column(0), b.column(2), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas, pa.string()), pa.array(base, pa.string()), pa.array(terms, near)]
        yield pa.RecordBatch.from_arrays(cols, ["doc_id", "text_key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "near"])


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, text_key, terms -> every place of the terms in the text that no base span covers."""
    place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for b in batches:
        found = []
        for raw, terms in zip(b.column(1), b.column(3).to_pylist()):
            t, terms, out = raw.as_py().decode("utf-8", "replace"), set(terms), []
            covered = sorted((s, e) for _, s, e in base_spans(t))
            k, known = 0, {}
            for m in _WORD.finditer(t):
                word = m[0].lstrip(_TRIM)
                start = m.end() - len(word)
                word = word.rstrip(_TRIM)
                if word not in known:
                    known[word] = _hash(word.encode().lower()) in terms
                if known[word]:
                    end = start + len(word)
                    while k < len(covered) and covered[k][1] <= start:
                        k += 1
                    if not any(s < end and start < e for s, e in covered[k:]):
                        out.append({"start": start, "end": end})
            found.append(out)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(found, place)], ["r_id", "r_key", "terms"])


_FOUND = "doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, near array<struct<e:long,t:long,start:long,end:long>>"
#: Bits of the filter that keeps only words near entities in the corpus count: 2 MB whatever the input.
FILTER_BITS = 1 << 24


def _frequency_rows(held):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, count = held.value, Counter()
        for b in batches:
            for t in b.column(1):
                for h in {_hash(w.strip(_TRIM_BYTES)) for w in set(t.as_py().lower().split())}:
                    x = h % FILTER_BITS
                    if bits[x >> 3] >> (x & 7) & 1:
                        count[h] += 1
            if len(count) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.int64()), pa.array(count.values(), pa.int64())], ["t", "n"])
                count = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(count.keys()), pa.int64()), pa.array(list(count.values()), pa.int64())], ["t", "n"])

    return rows


def _bits(terms: DataFrame) -> bytes:
    """The filter's bits: 512 bitmaps of 4 kB at most reach the driver."""
    x = terms.select((F.pmod("t", F.lit(FILTER_BITS))).alias("x"))
    maps = x.groupBy(F.expr("x div 32768").alias("k")).agg(F.expr("bitmap_construct_agg(x % 32768)").alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for r in maps.collect():
        out[r.k * 4096 : (r.k + 1) * 4096] = r.bits
    return bytes(out)


def find(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """Personal data in every text of docs (doc_id, text; other columns are ignored).

    Returns a row per input row: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans (kind:start:end, comma-joined; last, as kind term, every
    place of a revealing term in a document with the entity that it reveals) and text_key (a hash of the text). Null and blank texts have no
    spans, repeated rows the same spans; a term that reveals several entities
    counts once. An empty table gives no rows.
    """
    t = texts(docs).withColumn("text_key", F.xxhash64("text"))
    found = stage(t.mapInArrow(_find_rows, _FOUND), "pii-found")
    near = found.where(F.size("near") > 0).select("doc_id", "text_key", F.explode("near").alias("x")).select("doc_id", "text_key", "x.*")
    once = near.select("doc_id", "text_key", "e", "t").distinct()
    pairs = stage(once.groupBy("e", "t").agg(F.count("*").alias("n_et")).where(F.col("n_et") >= support), "pii-pairs")
    entities = once.select("doc_id", "text_key", "e").distinct().groupBy("e").agg(F.count("*").alias("n_e"))
    held = docs.sparkSession.sparkContext.broadcast(_bits(pairs.select("t").distinct()))
    n_t = texts(docs).mapInArrow(_frequency_rows(held), "t long, n long").groupBy("t").agg(F.sum("n").alias("n_t"))
    total = float(docs.count())
    # copies of a row are one document in n_et and n_e, so n_t may exceed them but never falls below
    share = F.log(F.col("n_et") * total / (F.col("n_e") * F.col("n_t"))) / F.log(F.lit(total) / F.col("n_e"))
    revealing = pairs.join(n_t, "t").join(entities, "e").where((F.col("n_e") < total) & (share >= threshold)).select("e", "t")
    # a term goes wherever it stands in a document that holds the entity it reveals
    terms = near.select("doc_id", "text_key", "e").distinct().join(revealing, "e").groupBy("doc_id", "text_key").agg(F.collect_set("t").alias("terms"))
    terms = stage(terms.select(F.col("doc_id").alias("h_id"), F.col("text_key").alias("h_key"), "terms"), "pii-terms")
    holders = F.broadcast(terms) if terms.count() <= BROADCAST_DOCS else terms
    held_by = t.join(holders, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_key") == F.col("h_key"))).select("doc_id", "text", "text_key", "terms")
    r = held_by.mapInArrow(_term_rows, "r_id long, r_key long, terms array<struct<start:long,end:long>>").dropDuplicates(["r_id", "r_key"])
    out = found.join(r, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_key") == F.col("r_key")), "left")
    term_text = F.array_join(F.transform("terms", lambda x: F.concat(F.lit("term:"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.when(F.size("terms") > 0, term_text))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"), "text_key")


def redact(t: str, spans: str) -> str:
    """t with every span replaced by its kind in angle brackets; overlapping spans become one."""
    cut = sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(",") if x))
    out, at = [], 0
    for s, e, k in cut:
        if s < at:
            at = max(at, e)
            continue
        out += [t[at:s], f"<{k.upper()}>"]
        at = e
    return "".join(out) + t[at:]


def sanitise(docs: DataFrame, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """docs with personal data and revealing terms in text replaced; all columns and rows stay."""
    spans = find(docs, threshold, support).where("spans <> ''").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__spans")).distinct()

    @F.pandas_udf("string")
    def cut(text, spans):
        import pandas as pd

        return pd.Series([x if s is None or x is None else redact(x, s) for x, s in zip(text, spans)], dtype=object)

    keyed = docs.withColumn("__k", F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b""))))
    j = keyed.join(spans, keyed["doc_id"].cast("long").eqNullSafe(spans["__id"]) & (keyed["__k"] == spans["__key"]), "left")
    return j.select(*[F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut("text", "__spans")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def op9_pii(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_key")
