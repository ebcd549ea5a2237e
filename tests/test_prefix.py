"""running_totals equals the plain one-window running value in every shape."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cascata.operators.prefix import bucket_boundaries, running_totals


def _window(df, value, order, part):
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("rs", F.sum(F.coalesce(F.col(value), F.lit(0))).over(w))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("min_buckets", [1, 3, 17])
@pytest.mark.parametrize("part", [[], ["event_type"]])
def test_matches_window(events, min_buckets, part):
    ev = events.select("event_id", "event_type", "user_id")
    got = running_totals(ev, {"rs": "user_id"}, ["event_id"], part, min_buckets=min_buckets)
    assert _same(got, _window(ev, "user_id", ["event_id"], part))


def test_skewed_key_is_split_over_buckets(spark, events):
    # one key holds well over a third of the rows
    ev = events.select("event_id", F.when(F.col("event_id") % 3 != 0, F.lit("hot"))
                       .otherwise(F.col("event_type")).alias("k"), "user_id")
    b = bucket_boundaries(ev, "event_id", min_buckets=8)
    assert len(b) >= 6
    got = running_totals(ev, {"rs": "user_id"}, ["event_id"], ["k"], boundaries=b)
    assert _same(got, _window(ev, "user_id", ["event_id"], ["k"]))


def test_null_keys_and_values(spark):
    rows = [(i, None if i % 4 == 0 else f"k{i % 2}", None if i % 5 == 0 else i) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "seq bigint, k string, v bigint")
    got = running_totals(df, {"rs": "v"}, ["seq"], ["k"], min_buckets=5)
    assert got.count() == 199
    assert _same(got, _window(df, "v", ["seq"], ["k"]))


def test_wide_values_do_not_wrap(spark):
    df = spark.range(1, 65537).select(F.col("id").alias("seq"), F.col("id").cast("int").alias("num"))
    got = running_totals(df, {"rs": "num"}, ["seq"], min_buckets=4)
    assert got.agg(F.max("rs")).first()[0] == 2147516416


def test_carried_offsets(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", i) for i in range(1, 11)], "seq bigint, k string, v bigint")
    init = spark.createDataFrame([("a", 100), ("c", 5)], "k string, rs bigint")
    got = {r.seq: r.rs for r in running_totals(df, {"rs": "v"}, ["seq"], ["k"], initial=init, min_buckets=3).collect()}
    assert got[1] == 101 and got[3] == 104 and got[2] == 2 and got[10] == 30


def test_empty_input(spark):
    df = spark.createDataFrame([], "seq bigint, v bigint")
    assert running_totals(df, {"rs": "v"}, ["seq"]).count() == 0


def test_timestamp_order_column(events):
    ev = events.select("ts", "event_id", "user_id")
    got = running_totals(ev, {"rs": "user_id"}, ["ts", "event_id"], min_buckets=5)
    assert _same(got, _window(ev, "user_id", ["ts", "event_id"], []))


def test_hot_key_window_partitions_are_bounded(spark):
    """One key holds ~40% of the rows; no (group, bucket) partition exceeds ~2x the target."""
    from cascata.operators.prefix import BUCKET, with_bucket

    n, target = 400_000, 10_000
    df = spark.range(0, n, numPartitions=16).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 5 < 2, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("k"))
    b = bucket_boundaries(df, "seq", rows_per_bucket=target, min_buckets=4)
    assert len(b) >= n // target - 5
    sizes = with_bucket(df, "seq", b).groupBy("k", BUCKET).count()
    assert sizes.agg(F.max("count")).first()[0] <= 2 * target * 0.4 + 1
    hot = sizes.where("k = 'hot'")
    assert hot.count() >= n // target - 5          # the hot key is spread over all buckets


def test_string_order_column_is_bucketed(spark):
    words = ["apple", "b", "banana", "ba", "zz", "é", "a", "", "apples", "Apple", "日本", "zzz"]
    rows = [(f"{w}{i:04d}", i % 3, i) for i, w in enumerate(words * 30)]
    df = spark.createDataFrame(rows, "s string, k int, v bigint")
    b = bucket_boundaries(df, "s", min_buckets=6)
    assert len(b) >= 4
    got = running_totals(df, {"rs": "v"}, ["s"], ["k"], boundaries=b)
    assert _same(got, _window(df, "v", ["s"], ["k"]))


def test_key_forms_non_nullable_and_complex(spark):
    base = spark.range(1, 301).select(F.col("id").alias("seq"), F.col("id").bitwiseAND(3).alias("k"),
                                      F.col("id").alias("v"))
    assert not base.schema["k"].nullable
    got = running_totals(base, {"rs": "v"}, ["seq"], ["k"], min_buckets=5)
    assert _same(got, _window(base, "v", ["seq"], ["k"]))
    arr = base.withColumn("a", F.when(F.col("k") == 0, F.lit(None)).otherwise(F.array("k")))
    got = running_totals(arr, {"rs": "v"}, ["seq"], ["a"], min_buckets=5)
    assert _same(got, _window(arr, "v", ["seq"], ["a"]))


def test_carried_offsets_with_non_nullable_key(spark):
    df = spark.range(1, 11).select(F.col("id").alias("seq"), F.col("id").bitwiseAND(1).alias("k"), F.col("id").alias("v"))
    init = spark.createDataFrame([(1, 100), (None, 7)], "k bigint, rs bigint")
    got = {r.seq: r.rs for r in running_totals(df, {"rs": "v"}, ["seq"], ["k"], initial=init, min_buckets=3).collect()}
    assert got[1] == 101 and got[3] == 104 and got[2] == 2 and got[10] == 30
    assert not df.schema["k"].nullable


def test_double_order_column_with_nan_and_null(spark):
    rows = [(float(i) if i % 17 else float("nan"), i % 3, i) for i in range(1, 400)] + [(None, 1, 5), (None, 2, 6)]
    df = spark.createDataFrame(rows, "x double, k int, v bigint").withColumn("i", F.col("v") * 1000 + F.col("k"))
    got = running_totals(df, {"rs": "v"}, ["x", "i"], ["k"], min_buckets=6)
    assert _same(got, _window(df, "v", ["x", "i"], ["k"]))


def test_decimal_addend_is_exact(spark, events):
    ev = events.select("event_id", "event_type", F.col("value").cast("decimal(12,2)").alias("v"))
    got = running_totals(ev, {"rs": "v"}, ["event_id"], ["event_type"], min_buckets=7)
    assert dict(got.dtypes)["rs"].startswith("decimal")
    assert _same(got, _window(ev, "v", ["event_id"], ["event_type"]))


def test_binary_order_column_and_unsupported_types(spark):
    rows = [(bytes([i % 7, i // 7, 3]), i % 2, i) for i in range(200)]
    df = spark.createDataFrame(rows, "b binary, k int, v bigint")
    got = running_totals(df, {"rs": "v"}, ["b"], ["k"], min_buckets=5)
    assert _same(got, _window(df, "v", ["b"], ["k"]))
    arr = spark.createDataFrame([([1], 1)], "a array<int>, v bigint")
    with pytest.raises(ValueError):
        running_totals(arr, {"rs": "v"}, ["a"])


def test_randomised_cases_against_pandas(spark):
    """300 random cases in one job (case id is a partition column): null keys,
    null values, negative and large order keys; checked with pandas cumsum."""
    import random

    import pandas as pd

    rng = random.Random(11)
    rows = []
    for case in range(300):
        orders = rng.sample(range(-10**12, 10**12), rng.randint(0, 40))
        for o in orders:
            rows.append((case, o, rng.choice(["x", "y", "z", None]),
                         None if rng.random() < 0.1 else rng.randint(-1000, 1000)))
    df = spark.createDataFrame(rows, "case int, o bigint, k string, v bigint")
    got = running_totals(df, {"rs": "v"}, ["o"], ["case", "k"], min_buckets=9).toPandas()
    pdf = pd.DataFrame(rows, columns=["case", "o", "k", "v"]).sort_values("o")
    pdf["rs"] = pdf["v"].fillna(0).astype("int64").groupby([pdf["case"], pdf["k"].fillna("\0")]).cumsum()
    merged = got.merge(pdf, on=["case", "o"], suffixes=("", "_want"))
    assert len(merged) == len(rows) == len(got)
    assert (merged["rs"] == merged["rs_want"]).all()


def test_two_level_boundaries_for_many_buckets(spark):
    from cascata.operators.prefix import BUCKET, SINGLE_LEVEL_BUCKETS, with_bucket

    n, target = 100_000, 20
    df = spark.range(0, n, numPartitions=8).select(((F.col("id") * 7919) % n).alias("seq"),
                                                   (F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    b = bucket_boundaries(df, "seq", rows_per_bucket=target, min_buckets=4)
    assert len(b) + 1 > SINGLE_LEVEL_BUCKETS            # the two-level path ran
    sizes = with_bucket(df, "seq", b).groupBy(BUCKET).count()
    assert sizes.agg(F.max("count")).first()[0] <= 3 * target
    got = running_totals(df, {"rs": "v"}, ["seq"], ["k"], boundaries=b)
    assert _same(got, _window(df, "v", ["seq"], ["k"]))
