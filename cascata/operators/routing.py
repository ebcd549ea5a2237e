"""Receipts, outcome splits and dead letters.

No row is ever dropped: every message gets a receipt ``(msg_id, outcome)``;
failed messages go to a dead-letter frame with a reason, the others go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.functions.routing import ACK, FAIL, range_outcome


def with_outcome(df: DataFrame, outcome: Column, name: str = "outcome") -> DataFrame:
    return df.withColumn(name, outcome)


def receipts(df: DataFrame, msg_id: str, outcome: Column, name: str = "outcome") -> DataFrame:
    """One ``(msg_id, outcome)`` row per message."""
    return df.select(F.col(msg_id).alias("msg_id"), outcome.alias(name))


def split_outcomes(df: DataFrame, outcome: str = "outcome", reason: Column | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """(acknowledged rows, dead letters with a ``reason`` column).

    Both halves read the same input; persist it first when it is expensive
    (the streaming dead-letter job does so per micro-batch).
    """
    ok = df.where(F.col(outcome) == F.lit(ACK)).drop(outcome)
    bad = df.where(F.col(outcome) != F.lit(ACK))
    bad = bad.withColumn("reason", reason if reason is not None else F.lit(FAIL)).drop(outcome)
    return ok, bad


def outcome_counts(df: DataFrame, value: str, name: str = "n", outcome: str = "outcome") -> DataFrame:
    """Messages per range outcome."""
    return (df.select(range_outcome(value).alias(outcome))
            .groupBy(outcome).agg(F.count(F.lit(1)).alias(name)))
