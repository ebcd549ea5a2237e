"""Range buckets over order tuples: monotone, balanced, and the same as comparing tuples."""

import random

import pytest
from pyspark.sql import functions as F

from cascata import operators as O
from cascata.operators.ranges import tuple_boundaries, with_tuple_bucket


def check(df, order_by, buckets, balance=None):
    bounds = tuple_boundaries(df, order_by, buckets)
    out = with_tuple_bucket(df, order_by, bounds, "b").orderBy(*order_by).select("b", *order_by).collect()
    got = [r["b"] for r in out]
    assert got == sorted(got)                       # never decreases along the order
    assert max(got, default=0) <= len(bounds)
    if balance:
        sizes = [got.count(x) for x in set(got)]
        assert len(sizes) > 1 and max(sizes) <= balance * len(got) / buckets
    return bounds


def test_common_prefixes_are_split(spark):
    df = spark.range(0, 2000).select(F.format_string("Customer#%09d", "id").alias("name"))
    assert len(check(df, ["name"], 8, balance=2)) == 7


def test_few_first_values_are_split_by_the_next_column(spark):
    df = spark.range(0, 3000).select((F.col("id") % 2).cast("int").alias("day"), "id", F.lit("hot").alias("word"))
    check(df, ["day", "id"], 10, balance=2)
    check(df, ["word", "id"], 10, balance=2)
    check(df.withColumn("word", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.lit(None))), ["word", "id"], 12, balance=2)


def test_mixed_tuples_with_nulls_ties_and_large_numbers(spark):
    rng = random.Random(5)
    words = [None, "", "a", "a\0", "ab", "é", "x" * 400, "x" * 400 + "y", "common prefix 1", "common prefix 2"]
    rows = [(rng.choice(words), rng.choice([None, -(1 << 62), (1 << 53) + rng.randint(0, 3), rng.randint(-5, 5)]),
             rng.choice([None, float("nan"), float("inf"), -float("inf"), 0.5, rng.random()]), rng.randint(0, 9 << 40))
            for _ in range(1500)]
    df = spark.createDataFrame(rows, "w string, n bigint, d double, i bigint")
    for order in (["w", "n", "i"], ["n", "w", "i"], ["n", "i"], ["i"], ["d", "i"], ["w"], ["n", "d", "w"]):
        check(df, order, 9)
    check(df.select(F.col("w").cast("binary").alias("w"), F.to_date(F.lit("2020-01-01")).alias("t"), "i"), ["t", "w", "i"], 9)
    check(df.select(F.timestamp_micros("i").alias("t"), "i"), ["t", "i"], 9)


def test_empty_and_constant_inputs(spark):
    df = spark.range(0, 50).select(F.lit("same").alias("w"), F.lit(1).alias("n"))
    assert len(check(df, ["w", "n"], 5)) <= 1
    assert tuple_boundaries(df.limit(0), ["w", "n"], 5) == []


def test_running_values_over_tuples_equal_a_plain_window(spark):
    rng = random.Random(8)
    rows = [(f"prefix {rng.choice('ab')}", i, rng.randint(-9, 9)) for i in rng.sample(range(10 ** 6), 800)]
    df = spark.createDataFrame(rows, "w string, i bigint, v int")
    got = {(r.w, r.i): r.s for r in O.running_sum(df, "v", ["w", "i"], "s", min_buckets=7).collect()}
    want, total = {}, 0
    for w, i, v in sorted(rows):
        total += v
        want[w, i] = total
    assert got == want


@pytest.mark.parametrize("order", [["w"], ["day", "i"]])
def test_sequence_numbers_are_split_evenly(spark, order):
    df = spark.range(0, 4000).select(F.format_string("Customer#%09d", "id").alias("w"), F.col("id").alias("i"),
                                     F.date_add(F.lit("2024-01-01"), (F.col("id") % 3).cast("int")).alias("day"))
    bounds = O.order_boundaries(df, order, min_buckets=16)
    sizes = [r["count"] for r in O.with_order_bucket(df, order, bounds).groupBy("_bucket").count().collect()]
    assert max(sizes) < 2 * 4000 / 16
