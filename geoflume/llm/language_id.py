"""Language identification by compression: each text is encoded with one dictionary per language, and the smallest encoding wins.

A language's dictionary is raw content for zstandard: pieces of training texts,
chosen by hash over the whole table (a bounded sample, PIECES of PIECE
characters at most). A whole text is encoded block by block, so that the
dictionary weighs as much at its end as at its start. A language is rejected
where others come close: `score` is the share of the winner among weights that
halve with every few bytes, and `rejected` says that it is under MIN_SCORE.

Edge cases: a null text, or one without a letter, is `und` with score 0 and
rejected; so is every text if there is no labelled training row. Equal sizes go
to the language with more training rows, then to the lesser name. Repeated rows
give repeated results, rows without lang aren't learned from, a null doc_id is
the empty string for the split, columns beyond doc_id, text and lang are left
out, an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoflume.llm.common import table

#: Pieces of a dictionary, and characters of a piece: the bound of what is fitted.
PIECES, PIECE = 256, 256
#: Bytes encoded at once, and the encoder's level.
BLOCK, LEVEL = 2048, 6
#: Dictionaries are broadcast: languages times PIECES times PIECE characters. More languages are an error.
MAX_LANGUAGES = 2000
#: A winner with a smaller score is rejected.
MIN_SCORE = 0.6

_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The text in lower case with one space for each run of anything but letters."""
    return _OTHER.sub(" ", text.lower()).encode()


def fit(train: DataFrame) -> list[tuple[str, int, bytes]]:
    """(language, training rows, dictionary), the commonest language first. train: text, lang; rows with a null are left out.

    Every distinct piece of a language has the same chance, wherever its text
    stands and however often it is copied.
    """
    t = train.where("text is not null and lang is not null").select("lang", "text")
    counts = t.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    start = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - PIECE, F.lit(1)).cast("long")) + 1
    pieces = t.select("lang", F.substring("text", start.cast("int"), F.lit(PIECE)).alias("piece")).distinct().withColumn("h", F.xxhash64("piece"))
    w = Window.orderBy("h", "piece")
    # a language's rows meet in tasks by their hash first, so a common language isn't ranked by one task
    some = pieces.withColumn("n", F.row_number().over(w.partitionBy("lang", F.pmod("h", F.lit(64))))).where(F.col("n") <= PIECES).drop("n")
    some = some.withColumn("n", F.row_number().over(w.partitionBy("lang"))).where(F.col("n") <= PIECES)
    got: dict[str, list] = {r["lang"]: [] for r in counts}
    for r in some.select("lang", "h", "piece").collect():
        got[r["lang"]].append((r["h"], r["piece"]))
    order = sorted(counts, key=lambda r: (-r["count"], r["lang"]))
    return [(r["lang"], r["count"], b"".join(letters(p) + b" " for _, p in sorted(got[r["lang"]]))) for r in order]


class Encoders:
    """The compressors of a model; made once in each Python worker."""

    def __init__(self, model: list[tuple[str, int, bytes]]):
        import zstandard

        self.names = [name for name, _, _ in model]
        par = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, window_log=18)
        self.of = []
        for _, _, content in model:
            d = zstandard.ZstdCompressionDict(content.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.of.append(zstandard.ZstdCompressor(dict_data=d, compression_params=par))

    def sizes(self, text: str) -> list[int]:
        """Bytes of the whole text under each language's dictionary."""
        b = letters(text)
        blocks = [b[i : i + BLOCK] for i in range(0, len(b), BLOCK)]
        return [sum(len(c.compress(x)) for x in blocks) for c in self.of]

    def predict(self, text: str | None) -> tuple[str, float, int]:
        """(language, score, margin in bytes)."""
        if not self.of or text is None or not any(map(str.isalpha, text)):
            return "und", 0.0, 0
        sizes = self.sizes(text)
        least = min(sizes)
        scale = 1 + least / 100
        score = 1 / sum(math.exp((least - s) / scale) for s in sizes)
        return self.names[sizes.index(least)], score, min((s for i, s in enumerate(sizes) if i != sizes.index(least)), default=least) - least


def identify(docs: DataFrame, model: list[tuple[str, int, bytes]], id_cols: list[str], text_col: str = "text") -> DataFrame:
    """id_cols with lang_pred, score, margin_bytes and rejected, a row for each row of docs."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    made: list[Encoders] = []

    def run(batches):
        import pandas as pd

        if not made:
            made.append(Encoders(held.value))
        for p in batches:
            out = [made[0].predict(None if t is None else bytes(t).decode("utf-8", "replace")) for t in p.pop("__text")]
            got = pd.DataFrame(out, columns=["lang_pred", "score", "margin_bytes"], index=p.index)
            yield pd.concat([p, got, (got["score"] < MIN_SCORE).rename("rejected")], axis=1)

    x = docs.select(*id_cols, F.col(text_col).cast("binary").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in x.schema.fields[:-1]) + ", lang_pred string, score double, margin_bytes long, rejected boolean"
    return x.mapInPandas(run, schema)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from two thirds of the documents by doc_id and predicts the language of all."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1
    model = fit(docs.where(~held))
    return identify(docs.withColumn("held_out", held), model, ["doc_id", "held_out"])
