"""Keyed last-write-wins reduction (what a hash upsert leaves behind)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_value(df: DataFrame, key: Column | str, value: Column | str, seq: str) -> DataFrame:
    """Map rows to ``(key, value-as-text, seq)``."""
    k = F.col(key) if isinstance(key, str) else key
    v = F.col(value) if isinstance(value, str) else value
    return df.select(k.alias("key"), v.cast("string").alias("value"), F.col(seq).alias("seq"))


def latest_per_key(changes: DataFrame, key: str = "key", value: str = "value", seq: str = "seq",
                   keep_seq: bool = False) -> DataFrame:
    """Last value per key by ``seq`` (partial ``max_by`` before the shuffle).

    With a fixed-width value (a number) Spark aggregates by hash; a string
    value makes it sort each partition first, so reduce before rendering
    text when the value starts out numeric.
    """
    cols = [F.max_by(value, seq).alias(value)]
    if keep_seq:
        cols.append(F.max(seq).alias(seq))
    return changes.groupBy(key).agg(*cols)
