"""Table sources (batch and streaming) with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from cascata.sinks import paths

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Explicit schemas for the tables the operators read (no inference on a
# streaming source; batch reads take the parquet footer's schema).
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp"),
}


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Batch read of ``<base>/<name>.parquet`` (filters and columns pushed to the scan)."""
    return spark.read.parquet(table_path(base, name))


def schema_of(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def stream_table(spark: SparkSession, directory: str, name: str, schema: str | StructType | None = None,
                 max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Streaming read of the parquet files for ``name`` in ``directory``.

    A file source needs a directory, so one table file is selected with a
    glob filter (default ``<name>.parquet``; use ``*.parquet`` for a folder of
    parts).  One file is at least one micro-batch.
    """
    reader = (spark.readStream.format("parquet")
              .schema(schema if schema is not None else schema_of(name))
              .option("pathGlobFilter", glob or f"{name}.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def stream_parquet(spark: SparkSession, path: str, schema: str | StructType | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of a parquet folder, or of one parquet file.

    A file source only accepts folders, so a single file is read as its
    parent folder filtered to that file name.  Without ``schema`` the schema
    is taken from a batch read of the same path (its footers only).
    """
    schema = schema if schema is not None else spark.read.parquet(path).schema
    reader = spark.readStream.format("parquet").schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if paths.is_file(spark, path):
        parent, _, name = path.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).load(parent)
    return reader.load(path)
