"""Scalar expressions: the exact edge cases of FIXTURES.md §2."""

import pytest
from pyspark.sql import functions as F

from cascata import functions as X

TOKEN_CASES = [
    ("a,b,,", ["a", "b"]),
    ("", [""]),
    (",", []),
    (",,", []),
    (",a", ["", "a"]),
    ("a,,b", ["a", "", "b"]),
    ("a", ["a"]),
    (" a , B ", [" a ", " B "]),      # no trim, no case folding
    ("a,b,c", ["a", "b", "c"]),
]


@pytest.mark.parametrize("line,expected", TOKEN_CASES)
def test_split_tokens_java_rules(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(X.split_tokens("line").alias("t")).first().t == expected


def test_split_tokens_null_line_gives_no_rows(spark):
    df = spark.createDataFrame([(None,)], "line string")
    assert df.select(F.explode(X.split_tokens("line"))).count() == 0


@pytest.mark.parametrize("text,expected", [
    ("a\nb", ["a", "b"]), ("a\nb\n", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]),
    ("a\n\nb", ["a", "", "b"]), ("", []), ("\n", [""]), ("x", ["x"]),
])
def test_split_lines(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(X.split_lines("text").alias("l")).first().l == expected


def test_decode_replaces_malformed_bytes(spark):
    df = spark.createDataFrame([(bytes([0xFF, 0xFE, 0x41]),), ("héllo".encode(),), (None,)], "v binary")
    rows = df.select(X.decode_utf8("v").alias("t"), X.decode_outcome("v").alias("o"),
                     X.decode_outcome("v", strict=True).alias("s")).collect()
    assert rows[0].t == "��A" and rows[0].o == "ack" and rows[0].s == "fail"
    assert rows[1].t == "héllo" and rows[1].o == "ack" and rows[1].s == "ack"
    assert rows[2].t is None and rows[2].o == "fail" and rows[2].s == "fail"


def test_range_outcome(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (10,), (11,), (None,)], "num bigint")
    got = [r.o for r in df.select(X.range_outcome("num").alias("o")).collect()]
    assert got == ["fail", "fail", "ack", "ack", "fail", "fail"]


def test_prefixed_and_delimited_render_null(spark):
    df = spark.createDataFrame([("a", None, "x|y")], "a string, b string, c string")
    row = df.select(X.prefixed("add user:", "a").alias("p"), X.prefixed("add user:", "b").alias("q"),
                    X.delimited("a", "b").alias("d"), X.delimited("a", "c").alias("e")).first()
    assert row.p == "add user:a" and row.q == "add user:null"
    assert row.d == "a|null"
    assert row.e == "a|x|y"      # no escaping


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_timestamp_text_ignores_session_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = spark.createDataFrame([(0,), (1_700_000_000_500_000,), (-1,), (86_399_999_999,), (None,)], "us bigint")
        got = [r.t for r in df.select(X.utc_timestamp_text(F.timestamp_micros("us")).alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["1970-01-01 00:00:00", "2023-11-14 22:13:20.5", "1969-12-31 23:59:59.999999",
                   "1970-01-01 23:59:59.999999", None]
