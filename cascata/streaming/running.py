"""Running totals that continue across micro-batches.

``RunningTotalsWriter`` is a ``foreachBatch`` function.  Inside a micro-batch
the running values are computed by ``running_totals`` (range-bucketed, so a
hot key is not one task); the per-group totals of all earlier batches are
carried in a versioned state table and added as offsets.

State: groups are hashed into buckets, and a batch reads and rewrites only the
buckets its own groups fall into.

    <state>/v=<batch>/bucket=<k>/...    totals per group, never changed once written
    <state>/v=<batch>/manifest.json     {"n_buckets": ..., "buckets": {k: version that holds it}}, written last

Recovery: batch ``b`` reads the newest complete version ``< b`` (normally
``b-1``) and overwrites both its own output (``batch_id=b``) and state version
``v=b``.  Spark replays an unfinished batch with the same input, so a replay
rewrites identical rows: the sink is idempotent by ``batch_id``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cascata.operators.prefix import (SKETCH_FAN_IN, bucket_boundaries, dense_boundaries, order_boundaries,
                                      running_totals)
from cascata.operators.running import snapshot_per_event
from cascata.operators.sequence import replicate
from cascata.operators.sharding import NUM, shard_task
from cascata.sinks import paths
from cascata.sinks.files import BatchPartitionSink


STATE_BUCKET = "bucket"


def _addend(e: Column | str) -> Column:
    return F.coalesce(F.col(e) if isinstance(e, str) else e, F.lit(0))


class RunningTotalsWriter:
    """``foreachBatch`` writer of running totals with carried per-group state."""

    def __init__(self, sums: Mapping[str, Column | str], order_by: Sequence[str],
                 sink: Callable[[DataFrame, int], None] | str, state_path: str,
                 partition_by: Sequence[str] = (), retain: int = 2,
                 prepare: Callable[[DataFrame], DataFrame] | None = None, state_buckets: int = 64) -> None:
        # ``prepare`` runs on each micro-batch before it is persisted (e.g. to
        # number rows, which a streaming frame cannot do)
        self.prepare = prepare
        self.sums = dict(sums)
        self.order_by = list(order_by)
        self.partition_by = list(partition_by)
        # a path means "parquet table partitioned by batch_id"
        self.sink = BatchPartitionSink(sink) if isinstance(sink, str) else sink
        self.state_path = state_path.rstrip("/")
        self.retain = max(2, retain)
        self.state_buckets = state_buckets if self.partition_by else 1

    # -- state ------------------------------------------------------------------
    def _version(self, version: int) -> str:
        return f"{self.state_path}/v={version}"

    def _read_manifest(self, spark: SparkSession, version: int) -> dict | None:
        path = f"{self._version(version)}/manifest.json"
        return json.loads(paths.read_text(spark, path)) if paths.is_file(spark, path) else None

    def manifest_before(self, spark: SparkSession, batch_id: int) -> dict | None:
        """The newest complete version below ``batch_id``."""
        found = paths.versions(spark, self.state_path)
        if any(v > batch_id for v in found):
            # Spark replays at most the latest batch, so a newer version can
            # only come from another run: refuse rather than prune it as stale
            raise RuntimeError(f"state folder {self.state_path} holds versions after batch {batch_id}: "
                               "it belongs to another stream checkpoint")
        for v in reversed([v for v in found if v < batch_id]):
            manifest = self._read_manifest(spark, v)
            if manifest is not None:
                return manifest
        return None

    def _bucket(self, n_buckets: int) -> Column:
        if not self.partition_by:
            return F.lit(0)
        return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in self.partition_by]), F.lit(n_buckets)).cast("int")

    def _totals(self, spark: SparkSession, manifest: dict | None, touched: list[int]) -> DataFrame | None:
        """Earlier totals of the groups in the touched buckets."""
        held = manifest["buckets"] if manifest else {}
        folders = [f"{self._version(held[str(b)])}/{STATE_BUCKET}={b}" for b in touched if str(b) in held]
        return spark.read.parquet(*folders) if folders else None

    def _save(self, batch: DataFrame, prev: DataFrame | None, manifest: dict | None, touched: list[int],
              n_buckets: int, batch_id: int) -> None:
        """Write the touched buckets' totals after this batch, then the manifest.

        One aggregation over (earlier totals + batch rows), combined map-side; a null group is a group like any other.
        """
        spark = batch.sparkSession
        names = list(self.sums)
        keys = self.partition_by
        rows = batch.select(*keys, *(_addend(e).alias(n) for n, e in self.sums.items()))
        if prev is not None:
            rows = rows.unionByName(prev.select(*keys, *names))
        state = rows.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in names))
        paths.delete(spark, self._version(batch_id))
        (state.withColumn(STATE_BUCKET, self._bucket(n_buckets)).write.partitionBy(STATE_BUCKET)
         .parquet(self._version(batch_id)))
        held = (manifest["buckets"] if manifest else {}) | {str(b): batch_id for b in touched}
        text = json.dumps({"n_buckets": n_buckets, "buckets": held})
        paths.write_text(spark, f"{self._version(batch_id)}/manifest.json", text)

    def _prune(self, spark: SparkSession) -> None:
        """Remove what none of the newest ``retain`` versions holds."""
        versions = paths.versions(spark, self.state_path)
        kept = versions[-self.retain:]
        named = {(v, f"{STATE_BUCKET}={b}") for k in kept
                 for b, v in (self._read_manifest(spark, k) or {"buckets": {}})["buckets"].items()}
        for v in versions[:-self.retain]:
            folders = [f for f in paths.children(spark, self._version(v)) if f.startswith(STATE_BUCKET)]
            if not any((v, f) in named for f in folders):
                paths.delete(spark, self._version(v))
                continue
            for f in folders:
                if (v, f) not in named:
                    paths.delete(spark, f"{self._version(v)}/{f}")

    # -- foreachBatch ---------------------------------------------------------------
    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        batch = (self.prepare(batch_df) if self.prepare else batch_df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            manifest = self.manifest_before(spark, batch_id)
            n_buckets = manifest["n_buckets"] if manifest else self.state_buckets
            touched = sorted(r[0] for r in batch.select(self._bucket(n_buckets)).distinct().collect())  # <= n_buckets
            prev = self._totals(spark, manifest, touched)
            dtype = dict(batch.dtypes)[self.order_by[0]]
            if self.partition_by:
                bounds = None           # sought only if a group is large
            elif len(self.order_by) == 1 and dtype not in ("string", "binary"):
                # the persisted batch is cheap to re-read: count and boundaries in one pass, if few sketches meet
                few = batch.rdd.getNumPartitions() <= SKETCH_FAN_IN
                bounds = bucket_boundaries(batch, self.order_by[0], bounded_input=few)
            else:
                bounds = order_boundaries(batch, self.order_by)
            out = running_totals(batch, self.sums, self.order_by, self.partition_by, initial=prev,
                                 boundaries=bounds)
            self.sink(out, batch_id)
            self._save(batch, prev, manifest, touched, n_buckets, batch_id)
            self._prune(spark)
        finally:
            batch.unpersist()


class ShuffledSumWriter(RunningTotalsWriter):
    """``foreachBatch``: shuffle grouping over ``n_tasks`` tasks, rows dealt evenly in order, one running sum per task.

    Two steps in one micro-batch: a row's dense number over the whole stream, whatever its ids, then the running sum of
    the task ``number mod n_tasks``.  Both continue from one state table, a row per task with its rows and its sum: the
    rows of all tasks together are the last number given.  So there is one state version per batch, written last, and no
    crash leaves one step ahead of the other.

    With ``instances`` the source runs that many times, as in ``replicated_source_sharded_sum``: row ``n`` (from 0) of
    copy ``i`` has position ``instances * n + i`` and goes to task ``position mod n_tasks``.  A checkpoint's number of
    instances and tasks stays as it was when its state was begun.
    """

    ROWS = "_rows"

    def __init__(self, value: str, order_by: Sequence[str], n_tasks: int, sink: Callable[[DataFrame, int], None] | str,
                 state_path: str, name: str = "running_sum", task_name: str = "task", retain: int = 2,
                 prepare: Callable[[DataFrame], DataFrame] | None = None, instances: int | None = None,
                 instance_name: str = "instance") -> None:
        super().__init__({name: value, self.ROWS: F.lit(1)}, order_by, sink, state_path, [task_name], retain, prepare,
                         state_buckets=1)
        self.n_tasks = n_tasks
        self.task_name = task_name
        self.name = name
        self.instances = instances
        self.instance_name = instance_name

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        batch = (self.prepare(batch_df) if self.prepare else batch_df).persist(StorageLevel.MEMORY_AND_DISK)
        dealt = None
        try:
            manifest = self.manifest_before(spark, batch_id)
            prev = self._totals(spark, manifest, [0])
            given = prev.agg(F.coalesce(F.sum(self.ROWS), F.lit(0))).first()[0] if prev is not None else 0
            given //= self.instances or 1           # the state counts every copy
            new = batch.count()
            numbered = running_totals(batch, {NUM: F.lit(1)}, self.order_by,
                                      boundaries=order_boundaries(batch, self.order_by, rows=new))
            numbered = numbered.withColumn(NUM, F.col(NUM) + F.lit(given).cast("bigint"))
            order, position = [NUM], F.col(NUM)
            if self.instances:
                numbered = replicate(numbered, self.instances, self.instance_name)
                order = [NUM, self.instance_name]
                position = (F.col(NUM) - 1) * F.lit(self.instances) + F.col(self.instance_name)
            dealt = (numbered.withColumn(self.task_name, shard_task(position, self.n_tasks))
                     .persist(StorageLevel.MEMORY_AND_DISK))
            bounds = [b + given for b in dense_boundaries(new, min_buckets=spark.sparkContext.defaultParallelism)]
            out = running_totals(dealt, {self.name: self.sums[self.name]}, order, [self.task_name],
                                 initial=None if prev is None else prev.select(self.task_name, self.name),
                                 boundaries=bounds, split_all=True)
            self.sink(out.drop(NUM), batch_id)
            self._save(dealt, prev, manifest, [0], 1, batch_id)
            self._prune(spark)
        finally:
            if dealt is not None:
                dealt.unpersist()
            batch.unpersist()


class SnapshotWriter(RunningTotalsWriter):
    """``foreachBatch``: after every event the whole count map, over all events of the stream so far.

    A micro-batch's events are written out by ``snapshot_per_event`` from the counts that earlier batches left.  All of
    those are read, as every event shows every key; only the buckets of the batch's own keys are written anew.
    """

    def __init__(self, key: str, order_by: Sequence[str], sink: Callable[[DataFrame, int], None] | str, state_path: str,
                 name: str = "count", retain: int = 2, prepare: Callable[[DataFrame], DataFrame] | None = None,
                 state_buckets: int = 64) -> None:
        super().__init__({name: F.lit(1)}, order_by, sink, state_path, [key], retain, prepare, state_buckets)
        self.key = key
        self.name = name

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        batch = (self.prepare(batch_df) if self.prepare else batch_df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            manifest = self.manifest_before(spark, batch_id)
            n_buckets = manifest["n_buckets"] if manifest else self.state_buckets
            touched = sorted(r[0] for r in batch.select(self._bucket(n_buckets)).distinct().collect())  # <= n_buckets
            every = self._totals(spark, manifest, list(range(n_buckets)))
            self.sink(snapshot_per_event(batch, self.key, self.order_by, self.name, initial=every), batch_id)
            self._save(batch, self._totals(spark, manifest, touched), manifest, touched, n_buckets, batch_id)
            self._prune(spark)
        finally:
            batch.unpersist()


def start_running_totals(stream: DataFrame, writer: RunningTotalsWriter, checkpoint: str,
                         query_name: str | None = None, available_now: bool = False,
                         processing_time: str | None = None):
    """Start the streaming query that feeds ``writer``."""
    w = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
