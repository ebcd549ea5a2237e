"""Small helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Hashable, Iterable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cascata
from cascata.session import checkpoint_root

# Rows and bytes per Arrow batch handed to a Python worker: bound its memory, by bytes where texts are long.
ARROW_ROWS = 500
ARROW_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Before Python workers run: small Arrow batches, so that a worker holds few whole texts at a time, and the
    package among the session's Python files, so that workers can import it wherever the driver did."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_shipped_package", None) is None:
        root = Path(cascata.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / "cascata_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent).as_posix())
        sc.addPyFile(str(archive))      # served to the executors by the driver
        sc._shipped_package = archive.name


def gathered(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``size`` bytes, but the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """``make()``, remembered by this Python worker until another key is asked for.

    Workers outlive their stage: the tables and memos of one operator must not stay beside those of the next.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, deleted when the driver's JVM ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return path


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once to the shared folder as Parquet, and read back (cuts the lineage)."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct called ``row``: other columns beside it cannot clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def held_out(id_col: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves no remainder mod 5 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0
