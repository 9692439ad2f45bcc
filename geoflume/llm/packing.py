"""Packing of tokenised documents by first-fit decreasing in randomised groups.

Only piece lengths travel: the tokens are made, cut and summed up in the scan.
A group's free bins are the leaves of a tournament tree of capacities, so the
first bin with room is found in logarithmic time.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoflume.llm.common import texts

#: Encoded chunks, words among them, that one Python worker keeps in each of two generations, which take some 200 bytes each.
CACHE = 300_000
#: Marks that may follow a word; an apostrophe isn't among them, as the vocabulary has endings that begin with one.
_MARKS = '.,;:!?"*$%&#@()[]{}/\\|+=<>~^_-`'
_state: dict = {}


class Tournament:
    """Bins of equal size; `first(n)` is the leftmost bin with room for n, or -1."""

    def __init__(self, bins: int, size: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [size] * (2 * self.leaves)

    def first(self, n: int) -> int:
        if self.best[1] < n:
            return -1
        at = 1
        while at < self.leaves:
            at *= 2
            if self.best[at] < n:
                at += 1
        return at - self.leaves

    def take(self, leaf: int, n: int) -> None:
        at = leaf + self.leaves
        self.best[at] -= n
        while at > 1:
            at //= 2
            self.best[at] = max(self.best[2 * at], self.best[2 * at + 1])


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces come in the order of falling length, ties in the given order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree = Tournament(len(lengths), size)
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        b = tree.first(n)
        bins[i], offsets[i] = b, size - tree.best[tree.leaves + b]
        tree.take(b, n)
    return bins, offsets


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> dict[int, int]:
    """Byte -> the letter that byte-level vocabularies write for it: itself if printable, else the next above 255."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = (256 + k for k in range(256))
    return {b: b if b in shown else next(other) for b in range(256)}


class Chunks(dict):
    """Chunk between ASCII white space -> its token ids as little-endian uint32 bytes.

    The vocabulary's pre-tokeniser drops white space and cuts between letters
    and marks, so a word and the marks after it are encoded apart. A plain Latin
    word in lower case is what the normaliser makes of it and goes straight to
    the merges; anything else goes through the whole tokenizer. Words are kept
    as chunks too, so a word that also stands alone is held once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.marks: dict[str, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def whole(self, s: str) -> bytes:
        return _packed(self.tok.encode(s, add_special_tokens=False).ids)

    def keep(self, chunk: bytes, ids: bytes) -> bytes:
        if len(self) > CACHE:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def word(self, low: bytes) -> bytes:
        ids = self.get(low) or self.old.get(low)
        return ids or self.keep(low, _packed([t.id for t in self.tok.model.tokenize(low.decode("latin-1").translate(self.letters))]))

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            s = chunk.decode("utf-8", "replace")
            word = s.rstrip(_MARKS)
            if word.isalpha() and (word.isascii() or max(word) < "\u0180" and unicodedata.is_normalized("NFC", word)) and len(low := word.lower()) == len(word):
                ids = self.word(low.encode())
                if len(word) < len(s):
                    marks = s[len(word) :]
                    if len(self.marks) > CACHE:
                        self.marks.clear()
                    ids += self.marks.get(marks) or self.marks.setdefault(marks, self.whole(marks))
            else:
                ids = self.whole(s)
        return self.keep(chunk, ids)

    def encode(self, text: bytes) -> bytes:
        return b"".join([self[c] for c in text.split()])


def _encoder(path: str) -> Chunks:
    """One cache for each Python worker, which Spark keeps between tasks."""
    if path not in _state:
        _state[path] = Chunks(path)
    return _state[path]


def _piece_rows(path: str, size: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path).encode
        for b in batches:
            out: list[tuple] = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(t.as_py()) + end
                n = len(ids) // 4
                out += ((i, at, min(size, n - at), zlib.crc32(ids[4 * at : 4 * (at + size)]), n) for at in range(0, n, size))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return rows


def _pieces(docs: DataFrame, size: int) -> float:
    """About as many pieces as docs will have, from the bytes of its texts, of which a token takes four or so."""
    return docs.agg(F.sum(1 + F.floor(F.coalesce(F.octet_length(F.col("text").cast("binary")), F.lit(0)) / (4 * size)))).first()[0] or 0


def pack(docs: DataFrame, vocabulary: str, size: int = 4096, end_id: int = 2, group_size: int = 4000, seed: int = 17) -> DataFrame:
    """Cut tokenised documents into pieces of at most size tokens and pack them into sequences.

    docs: doc_id, text; other columns are ignored. Returns a row per piece:
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null
    or blank text is the end token alone; repeated rows are packed each on its
    own; a null doc_id is kept. An empty table gives no rows. Groups hold about
    group_size pieces whatever the size of the input.
    """
    parts = texts(docs).mapInArrow(_piece_rows(vocabulary, size, end_id), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")
    groups = max(1, round(_pieces(docs, size) / group_size))
    parts = parts.withColumn("grp", F.pmod(F.xxhash64("doc_id", "start", "doc_tokens", F.lit(seed)), F.lit(groups)))

    def pack_group(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["doc_id", "start", "ids_crc32"], kind="stable")
        bins, offsets = first_fit_decreasing(p["length"].to_numpy(), size)
        return p.drop(columns="grp").assign(doc_id=p["doc_id"].astype("Int64"), sequence_id=p["grp"].to_numpy() * (1 << 32) + bins, offset=offsets)

    return parts.groupBy("grp").applyInPandas(pack_group, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
