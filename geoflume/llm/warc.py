"""WARC archives through a chunked record table.

A payload travels as rows of record identifier and chunk number, never as a
whole record; each chunk row carries the SHA-1 of the payload up to its end.
On disk the first chunk is a response (or the whole is a revisit) and the rest
are continuation records, which the format has for segmented payloads. Every
record is a gzip member of its own, so a reader can seek to any of them.
Reading back is a stream of lines per file.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoflume.llm.common import shared_dir

#: Payload bytes of a chunk, and payloads that are short enough to be kept twice.
CHUNK_BYTES, MIN_REVISIT = 1 << 20, 1000
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(*key: object) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, '/'.join(map(str, key))).urn}>"


def _headers(fields: list[tuple[str, object]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields)).encode("utf-8", "replace") + b"\r\n"


def _member(head: bytes, block: bytes | memoryview) -> bytes:
    """A record as a gzip member without its last byte, which is 0, as records are far below 16 MB; the writer's separator supplies it."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return (z.compress(head) + z.compress(block) + z.compress(_END) + z.flush())[:-1]


def chunks(payload: pa.BinaryScalar, size: int = CHUNK_BYTES) -> Iterator[tuple[int, memoryview, str]]:
    """(chunk number, bytes, SHA-1 of all bytes so far); an empty payload is one empty chunk."""
    view, sha = memoryview(payload.as_buffer()), hashlib.sha1()
    for k, at in enumerate(range(0, max(1, len(view)), size)):
        part = view[at : at + size]
        sha.update(part)
        yield k, part, sha.hexdigest()


def _write_rows(date: str, run: str):
    """Rows page_id, url, html, digest, refers_to -> one row for each WARC record.

    A class of equal payloads has one response, whose id follows from the digest; if several of its rows bear the
    largest page_id, which are all in one task, the first is the response.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        written: set[str] = set()
        for b in batches:
            out, held = [], 0
            for page, url, payload, digest, last in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), b.column(4).to_pylist()):
                total, number = len(payload.as_buffer()), number + 1
                url = "".join(c for c in url or "" if c not in "\r\n") or f"urn:page:{page}"
                named = [("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Page-Id", page), ("X-Payload-Length", total)]
                if last is not None and (page != last or digest in written):
                    fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", _record_id(run, task, number)), *named, ("WARC-Profile", _PROFILE), ("WARC-Refers-To", _record_id(run, digest, total, 0)), ("X-Refers-To-Page-Id", last)]
                    out.append(_member(_headers([*fields, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", 0)]), b""))
                    continue
                if last is not None:
                    written.add(digest)
                key = (run, task, number) if last is None else (run, digest, total)
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {total}\r\n\r\n".encode()
                parts = max(1, -(-total // CHUNK_BYTES))
                for k, part, so_far in chunks(payload):
                    fields = [("WARC-Type", "continuation" if k else "response"), ("WARC-Record-ID", _record_id(*key, k)), *named, ("X-Prefix-Digest", f"sha1:{so_far}")]
                    if parts > 1:
                        fields.append(("WARC-Segment-Number", k + 1))
                    if k:
                        fields.append(("WARC-Segment-Origin-ID", _record_id(*key, 0)))
                    if k and k == parts - 1:
                        fields.append(("WARC-Segment-Total-Length", len(http) + total))
                    block = part if k else http + bytes(part)
                    fields += [] if k else [("Content-Type", "application/http; msgtype=response")]
                    out.append(_member(_headers([*fields, ("Content-Length", len(block))]), block))
                    held += len(out[-1])
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                        out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    return rows


def write_archives(pages: DataFrame, path: str, date: str | None = None) -> None:
    """Write pages (page_id, url, html; other columns are ignored) as gzipped WARC files below path, a record per row.

    Of rows with equal payloads of MIN_REVISIT bytes or more, the one with the
    largest page_id is the response and the others are revisits of it; of
    repeated rows of that page_id one is the response. A null html is an empty
    payload. Rows without page_id are not written, as nothing could name them.
    An empty table writes no record. date (ISO 8601; by default that of the
    call) is the records' WARC-Date.
    """
    spark = pages.sparkSession
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    p = pages.where("page_id is not null").select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html")).withColumn("digest", F.sha1("html"))
    keys = p.select("page_id", "digest", F.octet_length("html").alias("size")).where(F.col("size") >= MIN_REVISIT)
    last = keys.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    known = keys.join(last, ["digest", "size"]).select("page_id", "digest", "refers_to").distinct()
    rows = p.repartition("page_id", "digest").join(known, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")
    text = rows.mapInArrow(_write_rows(date, uuid.uuid4().hex), "record binary").select(F.col("record").cast("string").alias("value"))
    text.write.option("lineSep", "\0").text(path)
    jvm = spark._jvm.org.apache.hadoop.fs
    fs = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(jvm.Path(path)):
        if (name := f.getPath().getName()).endswith(".txt"):
            fs.rename(f.getPath(), jvm.Path(path, name.removesuffix(".txt") + ".warc.gz"))


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of archives, in order -> a row per chunk. Holds one record's headers and a piece of its payload."""
    head: dict[str, str] = {}
    state, left, got, sha = "start", 0, 0, hashlib.sha1()
    out: list[tuple] = []
    for b in batches:
        for v in b.column(0):
            line = bytes(v.as_buffer()) + b"\n"
            if state == "start" and line.startswith(b"WARC/"):
                head, state = {}, "head"
            elif state == "head":
                text = line.rstrip(b"\r\n")
                if text:
                    k, _, x = text.decode("utf-8", "replace").partition(": ")
                    head[k] = x
                    continue
                left, got, first = int(head["Content-Length"]), 0, head["WARC-Type"] != "continuation"
                if first:
                    sha = hashlib.sha1()
                state = "http" if first and left else "body"
                line = b""
            elif state == "http":
                left -= len(line)
                state = "http" if line != b"\r\n" else "body"
                line = b""
            if state == "body":
                part = line[:left]
                sha.update(part)
                left -= len(part)
                got += len(part)
                if not left:
                    kind, refers = head["WARC-Type"], head.get("X-Refers-To-Page-Id")
                    digest = head["WARC-Payload-Digest"] if kind == "revisit" else sha.hexdigest()
                    out.append((head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]), int(head["X-Page-Id"]), int(head.get("WARC-Segment-Number", 1)) - 1, kind, got, digest.removeprefix("sha1:"), head.get("X-Prefix-Digest", "").removeprefix("sha1:"), int(head["X-Payload-Length"]), int(refers) if refers else None))
                    state = "start"
        if out:
            yield _chunk_batch(out)
            out = []


def _chunk_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["record", "page_id", "chunk", "kind", "bytes", "digest", "declared", "total", "refers_to"])


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunk rows of the archives below path: record (its first chunk's id), page_id, chunk, kind, bytes, digest (computed SHA-1 of the payload so far), declared (the one written), total, refers_to."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(_read_rows, "record string, page_id long, chunk int, kind string, bytes long, digest string, declared string, total long, refers_to long")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, and intact (each chunk has the digest written with it)."""
    c = read_chunks(spark, path)
    last = F.max_by("digest", "chunk")
    rows = c.groupBy("record").agg(
        F.first("page_id").alias("page_id"),
        F.when(F.max("refers_to").isNull(), F.sum("bytes")).otherwise(F.max("total")).alias("payload_bytes"),
        last.alias("payload_digest"),
        F.min_by("kind", "chunk").alias("record_type"),
        F.max("refers_to").alias("refers_to"),
        F.bool_and((F.col("kind") == "revisit") | (F.col("digest") == F.col("declared"))).alias("intact"),
    )
    return rows.drop("record")


def op8_warc(spark, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_archives(spark, path)
