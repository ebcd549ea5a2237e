"""Small file-system helpers over the cluster's Hadoop FileSystem.

Works for any URI the session can write to (HDFS, object stores, local
files); nothing here reads data, it only lists, tests and removes folders.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.getFileStatus(p).isFile())


def length(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file, None when there is none."""
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getLen() if fs.exists(p) else None


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of ``path`` ([] when it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def versions(spark: SparkSession, path: str, prefix: str = "v=") -> list[int]:
    """Sorted integer versions of the ``<prefix><n>`` folders under ``path``."""
    out = []
    for name in children(spark, path):
        if name.startswith(prefix) and name[len(prefix):].isdigit():
            out.append(int(name[len(prefix):]))
    return sorted(out)


def prune_versions(spark: SparkSession, path: str, keep: int, prefix: str = "v=") -> None:
    """Remove all but the newest ``keep`` versions."""
    for v in versions(spark, path, prefix)[:-keep] if keep > 0 else []:
        delete(spark, f"{path.rstrip('/')}/{prefix}{v}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name and rename it into place; an existing file is an error."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(part, p):
        fs.delete(part, False)
        raise RuntimeError(f"{path} exists already: another writer was faster")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename_parts(spark: SparkSession, folder: str, extension: str) -> None:
    """Give the part files of a folder another extension."""
    for name in children(spark, folder):
        if name.startswith("part-"):
            fs, p = _fs(spark, f"{folder}/{name}")
            _, q = _fs(spark, f"{folder}/{name.rsplit('.', 1)[0]}{extension}")
            fs.rename(p, q)


def _checksum(path: str) -> str:
    folder, _, name = path.rpartition("/")
    return f"{folder}/.{name}.crc"


def spoil(spark: SparkSession, path: str) -> None:
    """Make a local file unreadable, for trying out what happens then: its checksums no longer fit."""
    fs, p = _fs(spark, _checksum(path))
    if fs.exists(p) and hasattr(fs, "getRawFileSystem"):
        raw = fs.getRawFileSystem()
        size = raw.getFileStatus(p).getLen()
        out = raw.create(p, True)
        out.write(bytearray(b"crc\x00\x00\x00\x02\x00" + b"\xff" * (size - 8)))
        out.close()


def mend(spark: SparkSession, path: str) -> None:
    """Undo ``spoil``: the file stays as it is, without checksums."""
    fs, p = _fs(spark, _checksum(path))
    if hasattr(fs, "getRawFileSystem"):
        fs.getRawFileSystem().delete(p, False)
