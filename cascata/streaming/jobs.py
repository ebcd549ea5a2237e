"""Streaming jobs built from the operators.

* word count: lines -> comma tokens -> count per word (state store);
  ``update`` emits changed counts per micro-batch, ``complete`` the whole
  table (the snapshot form);
* outcome routing: per micro-batch receipts, acknowledged rows and dead
  letters, each written to its own ``batch_id`` partition;
* message decoding: binary payload -> text with ack / fail;
* request -> response by named function, unknown functions to dead letters.

Every writer is a ``foreachBatch`` function that replaces its own batch's
output, so a replayed micro-batch does not duplicate rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cascata.functions.routing import ACK, decode_outcome, range_outcome
from cascata.functions.text import decode_utf8
from cascata.operators.counting import tokens, word_count
from cascata.operators.requests import FunctionRegistry, respond
from cascata.sinks import paths
from cascata.sinks.files import BatchPartitionSink


def start(stream: DataFrame, sink, checkpoint: str, output_mode: str = "append",
          query_name: str | None = None, available_now: bool = False, processing_time: str | None = None):
    """Start ``stream`` into ``sink``: a foreachBatch function or a format name."""
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.foreachBatch(sink) if callable(sink) else w.format(sink)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


# ---- word count ---------------------------------------------------------------

def word_count_stream(lines: DataFrame, line_col: str = "line", name: str = "word_count") -> DataFrame:
    """Running word counts of a line stream (partial counts before the state shuffle)."""
    return word_count(tokens(lines, line_col), "word", name)


def count_changes(counts_batch: DataFrame, batch_id: int, name: str = "word_count") -> DataFrame:
    """An ``update``-mode batch of counts as keyed changes ``(key, value, seq)``."""
    return counts_batch.select(F.col("word").alias("key"), F.col(name).cast("string").alias("value"),
                               F.lit(batch_id).cast("bigint").alias("seq"))


# ---- outcome routing and dead letters ------------------------------------------

class BatchCommits:
    """Which micro-batches are complete: a marker per batch, written after all of its outputs.

    Batches of a stream come one after the other, so all up to the newest marker are complete; ``committed`` reads only
    those, and a reader never sees a batch of which one output is there and another isn't.  Markers hold the batch's
    counts; ``KEPT`` of them stay.
    """

    KEPT = 100

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def numbers(self, spark: SparkSession) -> list[int]:
        names = paths.children(spark, self.path)
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def last(self, spark: SparkSession) -> int | None:
        found = self.numbers(spark)
        return found[-1] if found else None

    def counts(self, spark: SparkSession, batch_id: int) -> dict:
        return json.loads(paths.read_text(spark, f"{self.path}/{batch_id}.json"))

    def mark(self, spark: SparkSession, batch_id: int, counts: dict) -> None:
        paths.write_text(spark, f"{self.path}/{batch_id}.json", json.dumps(counts))
        for old in self.numbers(spark)[:-self.KEPT]:
            paths.delete(spark, f"{self.path}/{old}.json")

    def committed(self, spark: SparkSession, table: str) -> DataFrame:
        """The rows of the table's complete batches (partitions beyond are not read)."""
        last = self.last(spark)
        return spark.read.parquet(table).where(F.col("batch_id") <= F.lit(-1 if last is None else last))


class OutcomeRouter:
    """``foreachBatch``: receipts, acknowledged rows and dead letters per batch.

    ``outcome`` maps the batch to a column holding ``ack`` / ``fail``;
    ``reason`` (optional) explains a failure.  The batch is persisted once
    because three outputs read it.  With ``commits`` the three become visible
    together (``BatchCommits``): the marker, with the number of messages per
    outcome as observed while the receipts were written, comes last, and a
    batch that has one is not written again.
    """

    def __init__(self, id_cols: list[str], outcome: Callable[[DataFrame], Column], receipts_path: str,
                 ok_sink, dead_path: str, reason: Callable[[DataFrame], Column] | None = None,
                 prepare: Callable[[DataFrame], DataFrame] | None = None, commits: str | None = None) -> None:
        self.id_cols = id_cols
        self.prepare = prepare
        self.outcome = outcome
        self.receipts = BatchPartitionSink(receipts_path)
        self.ok = BatchPartitionSink(ok_sink) if isinstance(ok_sink, str) else ok_sink
        self.dead = BatchPartitionSink(dead_path)
        self.reason = reason
        self.commits = BatchCommits(commits) if commits else None

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        if self.commits and batch_id in self.commits.numbers(spark):
            return
        batch = self.prepare(batch_df) if self.prepare else batch_df
        routed = batch.withColumn("outcome", self.outcome(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ack = F.col("outcome") == F.lit(ACK)
            receipts, seen = routed.select(*self.id_cols, "outcome"), None
            if self.commits:
                seen = Observation(f"outcomes-{uuid.uuid4().hex}")
                receipts = receipts.observe(seen, F.count_if(ack).alias("ack"), F.count_if(~ack).alias("fail"))
            self.receipts(receipts, batch_id)
            self.ok(routed.where(ack).drop("outcome"), batch_id)
            reason = self.reason(routed) if self.reason else F.col("outcome")
            dead = routed.where(~ack).withColumn("reason", reason).drop("outcome")
            self.dead(dead, batch_id)
            if self.commits:
                self.commits.mark(spark, batch_id, dict(seen.get))
        finally:
            routed.unpersist()


def range_router(id_col: str, num_col: str, receipts_path: str, ok_sink, dead_path: str,
                 commits: str | None = None) -> OutcomeRouter:
    """Success when ``0 < num <= 10``; everything else is a dead letter."""
    return OutcomeRouter([id_col], lambda df: range_outcome(num_col), receipts_path, ok_sink, dead_path, commits=commits)


def resolve_dead_letters(dead: DataFrame, outcome: Callable[[DataFrame], Column]) -> tuple[DataFrame, DataFrame]:
    """Re-run dead letters: (now acknowledged, still failing)."""
    base = dead.drop("reason", "batch_id")
    routed = base.withColumn("outcome", outcome(base))
    ok = routed.where(F.col("outcome") == F.lit(ACK)).drop("outcome")
    still = routed.where(F.col("outcome") != F.lit(ACK)).withColumnRenamed("outcome", "reason")
    return ok, still


def unresolved_dead_letters(spark: SparkSession, dead_path: str, resolved_path: str,
                            id_cols: list[str]) -> DataFrame:
    """Dead letters not yet resolved by a replay (anti-join on the message id)."""
    dead = spark.read.parquet(dead_path)
    if paths.exists(spark, resolved_path):
        resolved = spark.read.parquet(resolved_path).select(*id_cols)
        dead = dead.join(resolved, id_cols, "left_anti")
    return dead


def replay_dead_letters(spark: SparkSession, dead_path: str, resolved_path: str, id_cols: list[str],
                        outcome: Callable[[DataFrame], Column], ok_sink, replay_id: int) -> int:
    """Re-route the unresolved dead letters; those that now succeed go to ``ok_sink``.

    Resolutions are appended to ``resolved_path`` (partition ``replay_id``),
    so the dead-letter table itself is never rewritten and re-running a
    replay id replaces its own rows.  Returns the number resolved.
    """
    pending = unresolved_dead_letters(spark, dead_path, resolved_path, id_cols)
    ok, _ = resolve_dead_letters(pending, outcome)
    ok = ok.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sink = BatchPartitionSink(ok_sink, column="replay_id") if isinstance(ok_sink, str) else ok_sink
        sink(ok, replay_id)
        BatchPartitionSink(resolved_path, column="replay_id")(ok.select(*id_cols), replay_id)
        return ok.count()
    finally:
        ok.unpersist()


class DeadLetterBook:
    """Dead letters with the number of times each has failed; those that were resolved are gone.

        <path>/open/replay_id=<r>/...       letters still failing after replay r, with ``attempts``
        <path>/replays/<r>.json             {"through": last batch of arrivals taken in}, written last

    Replay ``r`` reads what replay ``r - 1`` left and the arrivals (``dead_path``, committed batches only) since; each
    letter is tried once, in a map: what succeeds goes to the sink, the rest into the next folder with one attempt more.
    Nothing is joined or shuffled, and old arrivals and resolved letters are never read again.  A replay that dies before
    its marker is repeated with the same rows; one that has its marker is over.
    """

    def __init__(self, path: str, dead_path: str, commits: str) -> None:
        self.path = path.rstrip("/")
        self.dead_path = dead_path
        self.commits = BatchCommits(commits)
        self.replays = BatchCommits(f"{self.path}/replays")

    def letters(self, spark: SparkSession) -> DataFrame:
        """All letters not resolved: their columns, ``reason`` and ``attempts``."""
        return self._pending(spark, self.replays.last(spark))[0]

    def _pending(self, spark: SparkSession, last: int | None) -> tuple[DataFrame, int]:
        through = -1 if last is None else self.replays.counts(spark, last)["through"]
        newest = self.commits.last(spark)
        newest = -1 if newest is None else newest
        arrived = spark.read.parquet(self.dead_path).where(F.col("batch_id").between(through + 1, newest)).drop("batch_id")
        pending = arrived.withColumn("attempts", F.lit(1))
        if last is not None:
            left = spark.read.schema(pending.schema).parquet(f"{self.path}/open/replay_id={last}")
            pending = left.unionByName(pending)
        return pending, newest

    def replay(self, spark: SparkSession, replay_id: int, outcome: Callable[[DataFrame], Column], ok_sink) -> dict:
        """Try every letter again; returns the numbers resolved and still failing."""
        last = self.replays.last(spark)
        if last is not None and last >= replay_id:
            return {k: v for k, v in self.replays.counts(spark, last).items() if k != "through"} if last == replay_id else {}
        if last is None and not any(n.startswith("batch_id=") for n in paths.children(spark, self.dead_path)):
            return {"resolved": 0, "failing": 0}        # no message has failed so far
        pending, newest = self._pending(spark, last)
        tried = pending.withColumn("outcome", outcome(pending)).withColumn("attempts", F.col("attempts") + 1)
        tried = tried.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ok = F.col("outcome") == F.lit(ACK)
            resolved, failing = Observation(f"resolved-{uuid.uuid4().hex}"), Observation(f"open-{uuid.uuid4().hex}")
            sink = BatchPartitionSink(ok_sink, column="replay_id") if isinstance(ok_sink, str) else ok_sink
            sink(tried.where(ok).drop("outcome", "reason").observe(resolved, F.count(F.lit(1)).alias("n")), replay_id)
            (tried.where(~ok).drop("outcome").observe(failing, F.count(F.lit(1)).alias("n"))
             .write.mode("overwrite").parquet(f"{self.path}/open/replay_id={replay_id}"))
            counts = {"resolved": resolved.get["n"], "failing": failing.get["n"]}
        finally:
            tried.unpersist()
        self.replays.mark(spark, replay_id, counts | {"through": newest})
        if last is not None:
            paths.delete(spark, f"{self.path}/open/replay_id={last}")
        return counts


# ---- messages -------------------------------------------------------------------

def decode_messages(messages: DataFrame, strict: bool = False) -> DataFrame:
    """Message rows -> ``(topic, partition, offset, text, outcome)``."""
    return messages.select("topic", "partition", "offset", decode_utf8("value").alias("text"),
                           decode_outcome("value", strict).alias("outcome"))


def message_router(receipts_path: str, ok_sink, dead_path: str, strict: bool = False) -> OutcomeRouter:
    """Decode each message; undecodable ones go to the dead letters with their bytes."""
    def prepare(df):
        return df.select("topic", "partition", "offset", "value", decode_utf8("value").alias("text"))

    return OutcomeRouter(["topic", "partition", "offset"], lambda df: decode_outcome("value", strict),
                         receipts_path, ok_sink, dead_path, prepare=prepare)


# ---- requests -------------------------------------------------------------------

class ResponseWriter:
    """``foreachBatch``: responses ``(id, result)`` and dead letters per batch."""

    def __init__(self, responses_path: str, dead_path: str, registry: FunctionRegistry | None = None) -> None:
        self.responses = BatchPartitionSink(responses_path)
        self.dead = BatchPartitionSink(dead_path)
        self.registry = registry

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            responses, dead = respond(batch, self.registry)
            self.responses(responses, batch_id)
            self.dead(dead, batch_id)
        finally:
            batch.unpersist()


def responses_for(responses: DataFrame, requests: DataFrame, id_col: str = "id") -> DataFrame:
    """Hand each request its response by id (left join: pending ones get null)."""
    return requests.join(responses.select(id_col, "result"), id_col, "left")
