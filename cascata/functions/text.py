"""Text expressions with exactly specified edge cases (all JVM-side).

Each function returns a ``Column``; none uses a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
TOKEN_SEPARATOR = ","          # tokens are split on a comma
RECORD_SEPARATOR = "|"         # delimited records join fields with a bar
NULL_TEXT = "null"             # how a missing value is rendered in text


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_tokens(line: Column | str) -> Column:
    """Comma tokens of ``line`` with the JVM ``String.split(",")`` rules.

    Trailing empty tokens are dropped, leading and inner ones kept:
    ``"a,b,,"`` -> ``[a, b]``, ``""`` -> ``[""]``, ``","`` -> ``[]``,
    ``",a"`` -> ``["", a]``, ``"a,,b"`` -> ``[a, "", b]``.  A null line gives
    null (no rows once exploded).  No trimming, no case folding.

    Built from a trailing trim and a single-character split (no regular
    expression is evaluated per line).
    """
    line = _col(line)
    return tokens_of_trimmed(line, F.rtrim(line, F.lit(TOKEN_SEPARATOR)))


def tokens_of_trimmed(line: Column | str, kept: Column | str) -> Column:
    """``split_tokens`` given ``kept`` = ``line`` without its trailing separators."""
    line, kept = _col(line), _col(kept)
    only_separators = (kept == F.lit("")) & (line != F.lit(""))
    return (F.when(line.isNull(), F.lit(None).cast("array<string>"))
            .when(only_separators, F.array().cast("array<string>"))
            .otherwise(F.split(kept, TOKEN_SEPARATOR, -1)))


def split_lines(text: Column | str) -> Column:
    """Lines of a text the way a line reader returns them.

    Terminators are ``\\n``, ``\\r\\n`` and ``\\r``; one final terminator does
    not start an extra empty line and an empty text has no lines.  Texts
    without ``\\r`` (the usual case) take a single-character split; only the
    others are normalised with a regular expression first.
    """
    return drop_final_empty(line_parts(text))


def line_parts(text: Column | str) -> Column:
    """Text split at every line terminator (an empty text gives no parts)."""
    text = _col(text)
    normal = (F.when(F.instr(text, "\r") > 0, F.regexp_replace(text, "\r\n?", "\n"))
              .otherwise(text))
    return F.when(text == F.lit(""), F.array().cast("array<string>")).otherwise(F.split(normal, "\n", -1))


def drop_final_empty(parts: Column | str) -> Column:
    """Drop the empty part a final line terminator leaves behind."""
    parts = _col(parts)
    return (F.when(F.try_element_at(parts, F.lit(-1)) == F.lit(""), F.slice(parts, 1, F.size(parts) - 1))
            .otherwise(parts))


def decode_utf8(payload: Column | str) -> Column:
    """Bytes -> text; malformed sequences become U+FFFD, never an error."""
    return F.make_valid_utf8(_col(payload).cast("string"))


def is_valid_utf8(payload: Column | str) -> Column:
    """True when the bytes are well-formed UTF-8 (null for null)."""
    return F.is_valid_utf8(_col(payload).cast("string"))


def as_text(value: Column | str) -> Column:
    """Value rendered as text, a missing value as ``null``."""
    return F.coalesce(_col(value).cast("string"), F.lit(NULL_TEXT))


def utc_timestamp_text(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` of a timestamp's UTC wall clock.

    Built from epoch microseconds, so it does not depend on the session time
    zone (a plain cast renders in the session zone).  Fractional seconds are
    shown without trailing zeros, as a cast shows them.
    """
    micros = F.unix_micros(_col(ts))
    day = F.floor(micros / F.lit(86_400_000_000)).cast("int")
    of_day = micros - day.cast("bigint") * F.lit(86_400_000_000)
    secs = F.floor(of_day / F.lit(1_000_000)).cast("bigint")
    frac = of_day - secs * F.lit(1_000_000)

    def two(x):
        return F.lpad(x.cast("string"), 2, "0")

    clock = F.concat_ws(":", two(F.floor(secs / 3600)), two(F.floor(secs / 60) % 60), two(secs % 60))
    fraction = F.when(frac == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.rtrim(F.lpad(frac.cast("string"), 6, "0"), F.lit("0"))))
    return F.concat(F.date_from_unix_date(day).cast("string"), F.lit(" "), clock, fraction)


def column_text(dtype: str, c: Column | str) -> Column:
    """Text of a column given its Spark type name (timestamps in UTC, nulls as ``null``)."""
    if dtype == "timestamp":
        return F.coalesce(utc_timestamp_text(c), F.lit(NULL_TEXT))
    return as_text(c)


def prefixed(prefix: str, value: Column | str) -> Column:
    """``prefix + value`` with string-concatenation rules (null -> ``null``)."""
    return F.concat(F.lit(prefix), as_text(value))


def delimited(*fields: Column | str, sep: str = RECORD_SEPARATOR) -> Column:
    """Fields joined with ``sep``; no quoting or escaping, null -> ``null``.

    Fields are rendered with ``as_text``; pass ``column_text`` results to
    render timestamps in UTC.
    """
    return F.concat_ws(sep, *(f if isinstance(f, Column) else as_text(f) for f in fields))


def delimited_columns(df, fields=None, sep: str = RECORD_SEPARATOR) -> Column:
    """``delimited`` over columns of ``df``, each rendered by its type."""
    types = dict(df.dtypes)
    return delimited(*(column_text(types[f], f) for f in (fields or df.columns)), sep=sep)
