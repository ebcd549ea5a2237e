"""File sinks: per-batch table partitions and rolling delimited text files."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata.functions.text import delimited_columns
from cascata.operators.prefix import running_totals

# Fixed values that must equal the reference's for right results.
ROLL_BYTES = 5 * 1024 * 1024   # a new file is started at 5 MB


class BatchPartitionSink:
    """Write each micro-batch to ``<path>/batch_id=<id>`` (replaces only that batch).

    Dynamic partition overwrite makes a replayed batch replace its own rows
    instead of adding a second copy.
    """

    def __init__(self, path: str, fmt: str = "parquet", column: str = "batch_id") -> None:
        self.path = path
        self.fmt = fmt
        self.column = column

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        (df.withColumn(self.column, F.lit(batch_id).cast("bigint")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(self.column)
         .format(self.fmt).save(self.path))


def records_per_file(mean_record_bytes: float, roll_bytes: int = ROLL_BYTES) -> int:
    """Records per output file so that a file rolls at about ``roll_bytes``."""
    return max(1, math.floor(roll_bytes / max(1.0, float(mean_record_bytes))))


def mean_record_bytes(records: DataFrame, column: str = "value", fraction: float = 0.01,
                      seed: int = 11) -> float:
    """Mean UTF-8 size of a line (record + newline) from a sample (one small aggregate)."""
    sample = records.sample(withReplacement=False, fraction=fraction, seed=seed) if fraction < 1 else records
    row = sample.agg(F.avg(F.octet_length(column) + F.lit(1)).alias("m")).first()
    if row["m"] is None and fraction < 1:
        row = records.agg(F.avg(F.octet_length(column) + F.lit(1)).alias("m")).first()
    return float(row["m"] or 1.0)


def delimited_records(df: DataFrame, fields: list[str] | None = None, sep: str = "|") -> DataFrame:
    """One text column ``value``: the fields joined by ``sep`` (no escaping, null -> ``null``)."""
    return df.select(delimited_columns(df, fields, sep=sep).alias("value"))


def write_rolling_text(df: DataFrame, path: str, max_records_per_file: int, mode: str = "append") -> None:
    """Batch twin of the rolling file sink."""
    df.write.mode(mode).option("maxRecordsPerFile", max_records_per_file).text(path)


def start_rolling_text(records: DataFrame, path: str, checkpoint: str, max_records_per_file: int,
                       available_now: bool = False, processing_time: str | None = None,
                       query_name: str | None = None):
    """Append a stream of ``value`` records to text files under ``path``.

    The file sink commits once per micro-batch (its log makes replays
    exactly-once); ``maxRecordsPerFile`` rolls to a new file inside a batch.
    """
    w = (records.writeStream.format("text").option("path", path)
         .option("checkpointLocation", checkpoint)
         .option("maxRecordsPerFile", max_records_per_file).outputMode("append"))
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


# ---- rolling by the bytes written -----------------------------------------------

FILE = "file"


def with_file_number(records: DataFrame, order_by: Sequence[str], value: str = "value", roll_bytes: int = ROLL_BYTES,
                     name: str = FILE, **kw) -> DataFrame:
    """Adds the number (from 0) of the file each record belongs to when records are written in order, one a line.

    A record's place is the bytes of all records before it (a running total, so no task sees them all); file ``n`` takes
    those that start in its ``roll_bytes``.  So every file but the last is within one record of ``roll_bytes``, whatever
    the records' lengths.  A null record is an empty line.
    """
    size = F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(1)
    ends = running_totals(records, {"_end": size}, order_by, **kw)
    return ends.withColumn(name, F.floor((F.col("_end") - size) / roll_bytes).cast("bigint")).drop("_end")


def _write_numbered(numbered: DataFrame, path: str, order_by: Sequence[str], value: str, name: str) -> None:
    """One text file per file number, its records in order; a task writes one file after another."""
    placed = numbered.repartitionByRange(name).sortWithinPartitions(name, *order_by)
    placed.select(F.coalesce(F.col(value), F.lit("")).alias("value"), name).write.mode("overwrite").partitionBy(name).text(path)


def write_rolled_text(records: DataFrame, path: str, order_by: Sequence[str], value: str = "value",
                      roll_bytes: int = ROLL_BYTES, name: str = FILE, **kw) -> None:
    """Write the records as text files ``<path>/file=<n>/`` that roll at ``roll_bytes`` (replaces ``path``).

    All records that start in one file's bytes go to one task: at most ``roll_bytes`` and one record.
    """
    _write_numbered(with_file_number(records, order_by, value, roll_bytes, name, **kw), path, order_by, value, name)


class RollingTextWriter:
    """``foreachBatch``: each micro-batch as rolled text files ``<path>/batch_id=<b>/file=<n>/``.

    A batch starts a new file, as its files are committed with it; a replayed batch replaces its own.  ``order_by`` is
    the order of the records; ``render`` turns a batch into them (a ``value`` column beside the order columns).
    """

    def __init__(self, path: str, order_by: Sequence[str], render: Callable[[DataFrame], DataFrame] | None = None,
                 value: str = "value", roll_bytes: int = ROLL_BYTES) -> None:
        self.path = path.rstrip("/")
        self.order_by = list(order_by)
        self.render = render
        self.value = value
        self.roll_bytes = roll_bytes

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        batch = (self.render(batch_df) if self.render else batch_df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_rolled_text(batch, f"{self.path}/batch_id={batch_id}", self.order_by, self.value, self.roll_bytes)
        finally:
            batch.unpersist()
