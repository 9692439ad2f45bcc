"""A keyed table behind a stream: rows in hash buckets, a manifest per epoch, and work that follows the batch, not the table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoflume.sources import files

#: Epochs whose files are kept: readers that began under the last manifest can finish.
KEPT = 2
#: Rows of a bucket that one task writes.
ROWS = 500_000


class BucketTable:
    """Rows with one value per key, as `fold` makes it of any rows of the key.

    fold: DataFrame -> DataFrame of the same columns, with one row per key; it
    must give the same whether applied at once or to parts first. Each epoch
    writes one run of rows per touched bucket. A run takes in the runs before it
    that are at most twice its size, so a row is written again only about
    log2(table / batch) times, and a bucket has about as many runs at most.

    The manifest is put in place, whole, after an epoch's data: until then, the
    epoch hasn't happened, and running it again writes the same files anew.
    Running an epoch again after its manifest changes nothing. The table and
    the stream's checkpoint belong together: epochs must rise.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], fold: Callable[[DataFrame], DataFrame], buckets: int = 64):
        self.spark, self.path, self.keys, self.fold, self.buckets = spark, path.rstrip("/"), keys, fold, buckets

    def epochs(self) -> list[int]:
        return [int(x) for x in files.names(self.spark, f"{self.path}/manifest")]

    def manifest(self, epoch: int) -> dict:
        """schema, and for each bucket its runs as [epoch, rows], the oldest first."""
        return json.loads(files.get(self.spark, f"{self.path}/manifest/{epoch:012d}"))

    def last(self) -> tuple[int, dict]:
        """The last finished epoch and its manifest; -1 before the first."""
        have = self.epochs()
        return (have[-1], self.manifest(have[-1])) if have else (-1, {"schema": None, "runs": {}})

    def _rows(self, schema: str, runs: list[tuple[str, int]]) -> DataFrame:
        paths = [f"{self.path}/data/epoch={e}/bucket={b}" for b, e in sorted(set(runs))]
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self) -> DataFrame | None:
        """The table as of the last finished epoch, or None before the first."""
        _, m = self.last()
        runs = [(b, e) for b, rs in m["runs"].items() for e, _ in rs]
        return self.fold(self._rows(m["schema"], runs)) if runs else None

    def merge(self, batch: DataFrame, epoch: int) -> bool:
        """Fold a batch in; False if the epoch was finished before."""
        now, m = self.last()
        if epoch <= now:
            return False
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        batch = self.fold(batch)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in batch.schema)
        batch = batch.persist()  # counted, then written
        try:
            fresh = {str(r["b"]): r["n"] for r in batch.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()}  # a row a bucket at most
            runs, taken = dict(m["runs"]), []
            for b, n in fresh.items():
                before = list(runs.get(b, []))
                while before and before[-1][1] <= 2 * n:
                    e, k = before.pop()
                    taken.append((b, e))
                    n += k
                runs[b] = [*before, [epoch, n]]
            if fresh:
                out = self.fold(batch.unionByName(self._rows(m["schema"], taken))) if taken else batch
                # the bucket alone would be one task each for a hot one, so rows are dealt by key within it, as many shares as they fill
                shares = 1 + max(rs[-1][1] for b, rs in runs.items() if b in fresh) // ROWS
                out = out.withColumn("bucket", bucket).repartition("bucket", F.pmod(F.xxhash64(F.lit(7), *self.keys), F.lit(shares)))
                out.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/epoch={epoch}")
            done = files.put(self.spark, f"{self.path}/manifest/{epoch:012d}", json.dumps({"schema": m["schema"] or schema, "runs": runs}))
        finally:
            batch.unpersist()
        self._forget()
        return done

    def _forget(self) -> None:
        """Delete what only manifests older than KEPT epochs name."""
        have = self.epochs()
        old, kept = have[:-KEPT], have[-KEPT:]
        used = {(b, e) for k in kept for b, rs in self.manifest(k)["runs"].items() for e, _ in rs}
        for k in old:
            for b, rs in self.manifest(k)["runs"].items():
                for e, _ in rs:
                    if (b, e) not in used:
                        files.delete(self.spark, f"{self.path}/data/epoch={e}/bucket={b}")
            files.delete(self.spark, f"{self.path}/manifest/{k:012d}")


def newest(keys: list[str], version: str) -> Callable[[DataFrame], DataFrame]:
    """A fold that keeps the row of the greatest version per key, ties by all other columns."""

    def fold(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        order = [version, *[c for c in rest if c != version]]
        best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__b"))
        return best.select(*[F.col(c) if c in keys else F.col(f"__b.{c}").alias(c) for c in df.columns])

    return fold


def summed(keys: list[str], *values: str) -> Callable[[DataFrame], DataFrame]:
    """A fold that adds the values up per key."""
    return lambda df: df.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values])


