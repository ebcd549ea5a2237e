"""Keyed upsert store (last write wins per key).

``KeyedStore`` is the interface a key-value backend implements; the shipped
backend keeps the store as parquet folders, one per hash bucket and version,
and a numbered manifest that names the folders in force:

    <path>/data/<write>/bucket=<b>/...      never changed once written
    <path>/manifests/<n>.json               {"n_buckets": ..., "buckets": {b: write}}

* a batch is first reduced to one change per key (``max_by`` on the sequence
  column, combined map-side before the shuffle);
* only the buckets it touches are read, merged with a full outer join on the
  key (a change wins when its sequence is not older than the stored one) and
  written to a new folder;
* one manifest, renamed into place last, puts them in force.  A crash before
  that leaves the store as it was, in any process; a replayed batch merges
  again with the same result, since older sequences never win.

The bucket count is the store's, fixed by its first manifest.  One writer at a
time, as for any streaming sink.
"""

from __future__ import annotations

import json
import uuid
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascata.operators.keyed import latest_per_key
from cascata.sinks import paths

BUCKET = "bucket"
# Manifests kept, so that a reader that has just opened an older one still finds its folders.
KEEP_MANIFESTS = 3


class KeyedStore(Protocol):
    def upsert(self, changes: DataFrame, batch_id: int | None = None) -> None: ...

    def read(self, spark: SparkSession) -> DataFrame: ...


class ParquetKeyedStore:
    def __init__(self, path: str, n_buckets: int = 64, key: str = "key", value: str = "value",
                 seq: str = "seq") -> None:
        self.path = path.rstrip("/")
        self.n_buckets = n_buckets
        self.key, self.value, self.seq = key, value, seq

    # -- manifests ----------------------------------------------------------------
    def _numbers(self, spark: SparkSession) -> list[int]:
        names = paths.children(spark, f"{self.path}/manifests")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, spark: SparkSession) -> dict:
        numbers = self._numbers(spark)
        if not numbers:
            return {"number": -1, "n_buckets": self.n_buckets, "buckets": {}}
        text = paths.read_text(spark, f"{self.path}/manifests/{numbers[-1]}.json")
        return json.loads(text) | {"number": numbers[-1]}

    def _folders(self, manifest: dict, buckets=None) -> list[str]:
        return [f"{self.path}/data/{write}/{BUCKET}={b}" for b, write in sorted(manifest["buckets"].items())
                if buckets is None or int(b) in buckets]

    def _rows(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        schema = f"{self.key} string, {self.value} string, {self.seq} bigint"
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    # -- interface ------------------------------------------------------------------
    def read(self, spark: SparkSession) -> DataFrame:
        """Current ``(key, value, seq)`` rows."""
        return self._rows(spark, self._folders(self._manifest(spark)))

    def upsert(self, changes: DataFrame, batch_id: int | None = None) -> None:
        """Apply ``changes`` (``key, value, seq``); applying a batch again changes nothing."""
        spark = changes.sparkSession
        manifest = self._manifest(spark)
        k, v, s = self.key, self.value, self.seq
        bucket = F.pmod(F.xxhash64(F.col(k)), F.lit(manifest["n_buckets"])).cast("int")
        latest = latest_per_key(changes.select(F.col(k).cast("string").alias(k), F.col(v).cast("string").alias(v),
                                               F.col(s).cast("bigint").alias(s)), k, v, s, keep_seq=True)
        latest = latest.select(k, v, s, bucket.alias(BUCKET))
        touched = {r[0] for r in latest.select(BUCKET).distinct().collect()}       # <= n_buckets values
        if not touched and manifest["number"] >= 0:
            return
        current = self._rows(spark, self._folders(manifest, touched))
        c = current.select(F.col(k).alias("_ck"), F.col(v).alias("_cv"), F.col(s).alias("_cs"))
        merged = c.join(latest, c["_ck"].eqNullSafe(latest[k]), "full_outer")
        newer = F.col(s).isNotNull() & (F.col("_cs").isNull() | (F.col(s) >= F.col("_cs")))
        merged = merged.select(F.when(newer, F.col(k)).otherwise(F.col("_ck")).alias(k),
                               F.when(newer, F.col(v)).otherwise(F.col("_cv")).alias(v),
                               F.when(newer, F.col(s)).otherwise(F.col("_cs")).alias(s))
        write = uuid.uuid4().hex
        (merged.withColumn(BUCKET, bucket).repartition(BUCKET).write.partitionBy(BUCKET)
         .parquet(f"{self.path}/data/{write}"))
        buckets = manifest["buckets"] | {str(b): write for b in touched}
        number = manifest["number"] + 1
        text = json.dumps({"n_buckets": manifest["n_buckets"], "buckets": buckets})
        paths.write_text(spark, f"{self.path}/manifests/{number}.json", text)
        self._prune(spark)

    def _prune(self, spark: SparkSession) -> None:
        """Remove old manifests and the writes that none of the kept ones names."""
        numbers = self._numbers(spark)
        for n in numbers[:-KEEP_MANIFESTS]:
            paths.delete(spark, f"{self.path}/manifests/{n}.json")
        kept = [json.loads(paths.read_text(spark, f"{self.path}/manifests/{n}.json"))
                for n in numbers[-KEEP_MANIFESTS:]]
        named = {w for m in kept for w in m["buckets"].values()}
        for write in paths.children(spark, f"{self.path}/data"):
            if write not in named:
                paths.delete(spark, f"{self.path}/data/{write}")

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        self.upsert(changes, batch_id)
