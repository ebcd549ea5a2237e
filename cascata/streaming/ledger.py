"""Directory lines with a ledger of files: a file that fails is kept and tried again.

The file source alone either stops the query at an unreadable file or, told to
ignore such files, forgets them.  Here the stream carries file *names*: a
micro-batch reads its files and the failed ones of earlier batches, and the
ledger says of each what came of it.

    <ledger>/batch_id=<b>/...       (path, length, state done|failed, attempts) of the files tried in batch b
    <ledger>/_commits/<b>.json      written after the lines and the ledger of batch b

A file is whole when the lines read from it make up its length; a file that
stops in the middle leaves no line in the output, so that its lines come once,
when it can be read to its end.  Empty files have no lines, and the file source
does not list them; a byte order mark, which the reader drops, does not count.  A file that is gone fails like any other.

The driver holds the names of one micro-batch's files (``maxFilesPerTrigger``)
and of at most as many failed ones; contents are read by tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cascata.functions.text import drop_final_empty, line_parts
from cascata.sinks import paths
from cascata.sinks.files import BatchPartitionSink
from cascata.streaming.jobs import BatchCommits

DONE, FAILED = "done", "failed"
FILES_PER_TRIGGER = 1_000
BYTE_ORDER_MARK = 3
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
LEDGER_SCHEMA = "path string, length bigint, state string, attempts int, batch_id bigint"


class FileLedger:
    """``foreachBatch`` over file names (``path``, ``length``); lines of whole files go to ``sink`` as (path, line)."""

    def __init__(self, path: str, sink: Callable[[DataFrame, int], None] | str, staging: str,
                 max_files: int = FILES_PER_TRIGGER) -> None:
        self.path = path.rstrip("/")
        self.sink = BatchPartitionSink(sink) if isinstance(sink, str) else sink
        self.staging = staging.rstrip("/")
        self.commits = BatchCommits(f"{self.path}/_commits")
        self.max_files = max_files

    def read(self, spark: SparkSession) -> DataFrame:
        """(path, length, state, attempts): the newest entry of every file that was tried."""
        if not any(n.startswith("batch_id=") for n in paths.children(spark, self.path)):
            return spark.createDataFrame([], LEDGER_SCHEMA).drop("batch_id")
        rows = spark.read.schema(LEDGER_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(self.path)
        last = self.commits.last(spark)
        rows = rows.where(F.col("batch_id") <= F.lit(-1 if last is None else last))
        newest = rows.groupBy("path").agg(F.max_by(F.struct("length", "state", "attempts"), "batch_id").alias("e"))
        return newest.select("path", "e.length", "e.state", "e.attempts")

    def __call__(self, files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        if batch_id in self.commits.numbers(spark):
            return
        again = (self.read(spark).where(F.col("state") == FAILED)
                 .orderBy("attempts", "path").limit(self.max_files).select("path", "length", "attempts"))
        new = files.select("path", F.col("length").cast("bigint").alias("length"), F.lit(0).alias("attempts"))
        self._try(spark, [tuple(r) for r in again.unionByName(new).collect()], batch_id)

    def retry(self, spark: SparkSession) -> None:
        """Try the failed files when no new ones arrive: an empty batch numbered after the last."""
        last = self.commits.last(spark)
        self(spark.createDataFrame([], "path string, length bigint"), 0 if last is None else last + 1)

    def _try(self, spark: SparkSession, listed: list[tuple[str, int, int]], batch_id: int) -> None:
        # a mended file may have another length now
        now = {p: paths.length(spark, p) for p, _, attempts in listed if attempts}
        known = spark.createDataFrame([(p, now.get(p, n) if now.get(p, n) is not None else n, a) for p, n, a in listed],
                                      "path string, length bigint, attempts int")
        there = [p for p, _, _ in listed if now.get(p, 0) is not None]
        staged = f"{self.staging}/{uuid.uuid4().hex}"
        if there:
            # one separator: what a line lacks of the file's bytes is one each, or none after the last
            raw = (spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", "true")
                   .option("ignoreMissingFiles", "true").text(there))
            raw.select(F.col("_metadata.file_path").alias("path"), "value").write.parquet(staged)
            lines = spark.read.schema("path string, value string").parquet(staged)
        else:
            lines = spark.createDataFrame([], "path string, value string")
        # the reader names a file by its encoded URI, the listing does not
        bytes_ = (lines.groupBy(_plain(F.try_url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))).alias("_plain"))
                  .agg(F.sum(F.octet_length("value") + 1).alias("_bytes")))
        known = known.withColumn("_plain", _plain(F.col("path")))
        missing = F.col("length") - F.coalesce("_bytes", F.lit(0))
        found = F.lit(there != []) & F.col("path").isin(there)
        whole_file = F.col("_bytes").isNotNull() & missing.isin(0, -1, BYTE_ORDER_MARK, BYTE_ORDER_MARK - 1)
        judged = known.join(bytes_, "_plain", "left").withColumn(
            "state", F.when(found & whole_file, DONE).otherwise(FAILED))
        entries = judged.select("path", "length", "state", (F.col("attempts") + 1).cast("int").alias("attempts"), "_plain")
        held = entries.collect()        # a micro-batch's files
        done = spark.createDataFrame([(r["_plain"], r["path"]) for r in held if r["state"] == DONE],
                                     "_plain string, _path string")
        whole = (lines.withColumn("_plain", _plain(F.try_url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))))
                 .join(F.broadcast(done), "_plain")
                 .select(F.col("_path").alias("path"), F.explode(_lines_of("value")).alias("line")))
        self.sink(whole, batch_id)
        ledger = spark.createDataFrame([(r["path"], r["length"], r["state"], r["attempts"]) for r in held],
                                       "path string, length bigint, state string, attempts int")
        BatchPartitionSink(self.path)(ledger, batch_id)
        self.commits.mark(spark, batch_id, {s: sum(r["state"] == s for r in held) for s in (DONE, FAILED)})
        paths.delete(spark, staged)


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def _lines_of(value: str) -> Column:
    """The lines inside a text between two newlines: one, unless it holds carriage returns."""
    text = F.col(value)
    return F.when(text == F.lit(""), F.array(F.lit(""))).otherwise(drop_final_empty(line_parts(value)))


def start_ledgered_lines(spark: SparkSession, directory: str, ledger: FileLedger, checkpoint: str,
                         extension: str = "txt", available_now: bool = False, processing_time: str | None = None):
    """Stream the names of ``*.<extension>`` files under ``directory`` (contents are not read here) to the ledger."""
    names = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true")
             .option("pathGlobFilter", f"*.{extension}").option("maxFilesPerTrigger", ledger.max_files)
             .load(directory).select("path", "length"))
    w = names.writeStream.foreachBatch(ledger).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
