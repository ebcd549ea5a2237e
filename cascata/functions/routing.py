"""Success / failure routing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cascata.functions.text import is_valid_utf8

# Fixed values that must equal the reference's for right results.
ACK = "ack"
FAIL = "fail"
RANGE_LOW_EXCLUSIVE = 0        # success when LOW < num <= HIGH
RANGE_HIGH_INCLUSIVE = 10


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_outcome(num: Column | str, low: int = RANGE_LOW_EXCLUSIVE,
                  high: int = RANGE_HIGH_INCLUSIVE) -> Column:
    """``ack`` when ``low < num <= high``, otherwise ``fail`` (null -> fail)."""
    num = _col(num)
    return F.when((num > low) & (num <= high), F.lit(ACK)).otherwise(F.lit(FAIL))


def decode_outcome(payload: Column | str, strict: bool = False) -> Column:
    """Outcome of decoding a binary payload.

    Decoding replaces malformed bytes, so only a missing payload fails.  With
    ``strict=True`` malformed UTF-8 fails as well.
    """
    payload = _col(payload)
    bad = payload.isNull()
    if strict:
        bad = bad | ~F.coalesce(is_valid_utf8(payload), F.lit(False))
    return F.when(bad, F.lit(FAIL)).otherwise(F.lit(ACK))
