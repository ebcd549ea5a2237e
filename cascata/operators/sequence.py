"""Sequence numbering and replication.

* ``sequence_number`` — dense 1-based numbers in order (not
  ``monotonically_increasing_id``, which is not dense, and not an
  unpartitioned ``row_number`` window, which runs in one task).
* ``keyed_sequence`` — number plus the flag computed from the value before
  the increment: ``flag = (num - 1) % modulus``.
* ``replicate`` — every row once per replica, as a generator (no join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata.operators.prefix import running_totals


def sequence_number(df: DataFrame, order_by: Sequence[str], name: str = "num",
                    partition_by: Sequence[str] = (), **kw) -> DataFrame:
    """Add a dense 1-based row number in ``order_by`` order (per partition)."""
    return running_totals(df, {name: F.lit(1)}, order_by, partition_by, **kw)


def keyed_sequence(df: DataFrame, order_by: Sequence[str], modulus: int = 2,
                   num: str = "num", flag: str = "flag", **kw) -> DataFrame:
    """Add ``num`` (1-based sequence) and ``flag = (num - 1) % modulus``."""
    numbered = sequence_number(df, order_by, num, **kw)
    return numbered.withColumn(flag, F.pmod(F.col(num) - 1, F.lit(modulus)))


def replicate(df: DataFrame, copies: int, name: str = "instance") -> DataFrame:
    """Every row ``copies`` times with replica index ``name`` in 0..copies-1."""
    if copies < 1:
        raise ValueError("copies must be >= 1")
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
