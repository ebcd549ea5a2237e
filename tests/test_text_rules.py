"""Randomised check of the text rules against a direct model of them."""

import random
import re

from cascata import functions as X


def java_split_comma(s: str) -> list[str]:
    """``String.split(",")``: no match -> the whole string; trailing empties dropped."""
    if s == "":
        return [""]
    parts = s.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def reader_lines(text: str) -> list[str]:
    """Lines as a line reader returns them (\\n, \\r\\n, \\r; no extra final line)."""
    if text == "":
        return []
    parts = re.split(r"\r\n|\n|\r", text)
    if parts[-1] == "":
        parts.pop()
    return parts


def _random_strings(alphabet, n, max_len, seed):
    rng = random.Random(seed)
    return [("".join(rng.choice(alphabet) for _ in range(rng.randint(0, max_len)))) for _ in range(n)]


def test_split_tokens_matches_the_jvm_rule(spark):
    samples = _random_strings(["a", "b", ",", ",", " ", "é", "\t", "日"], 2000, 12, seed=3)
    df = spark.createDataFrame([(s,) for s in samples], "line string")
    got = [r.t for r in df.select(X.split_tokens("line").alias("t")).collect()]
    assert got == [java_split_comma(s) for s in samples]


def test_split_lines_matches_a_line_reader(spark):
    samples = _random_strings(["a", ",", "\n", "\n", "\r", "\r\n", " ", "é"], 2000, 10, seed=5)
    df = spark.createDataFrame([(s,) for s in samples], "text string")
    got = [r.l for r in df.select(X.split_lines("text").alias("l")).collect()]
    assert got == [reader_lines(s) for s in samples]
