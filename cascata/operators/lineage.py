"""Lineage cuts.

A DataFrame that is read several times by the next operator (for example a
running total computed from another running total: boundaries, window and
totals each read it) is written once to the cluster's checkpoint folder and
read back, instead of being recomputed per read.  ``checkpoint()`` is
reliable: the data lives in ``spark.checkpoint.dir``, so a lost executor does
not lose it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cascata.session import checkpoint_root


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder now and continue from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
