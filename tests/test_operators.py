"""Operator semantics on the small fixtures of FIXTURES.md §2."""

import pytest
from pyspark.sql import functions as F

from cascata import operators as O

# Fixed input: the reference's sample word file (4 lines, no final newline).
SAMPLE_LINES = ["1wjoie,wjoeig,weoijgw", "111,111,wejfw", "111,wjgoiw,wegowj", "jwieog,weogw"]


def test_word_count_sample(spark):
    lines = spark.createDataFrame([(l,) for l in SAMPLE_LINES], "line string")
    toks = O.tokens(lines, "line")
    assert toks.count() == 11
    counts = {r.word: r.word_count for r in O.word_count(toks).collect()}
    assert len(counts) == 9
    assert counts["111"] == 3
    assert sum(1 for v in counts.values() if v == 1) == 8


def test_sequence_and_keyed_sequence(spark):
    df = spark.createDataFrame([(40,), (10,), (30,), (20,)], "t bigint")
    rows = O.keyed_sequence(df, ["t"], min_buckets=2).orderBy("t").collect()
    assert [r.num for r in rows] == [1, 2, 3, 4]
    assert [r.flag for r in rows] == [0, 1, 0, 1]


def test_outcome_and_running_sum_with_failures(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([-1, 0, 1, 10, 11])], "seq bigint, num bigint")
    rows = O.running_sum_with_outcome(df, "num", ["seq"], min_buckets=2).orderBy("seq").collect()
    assert [r.outcome for r in rows] == ["fail", "fail", "ack", "ack", "fail"]
    assert [r.running_sum for r in rows] == [-1, -1, 0, 10, 21]


def test_shuffle_grouping_three_tasks(spark):
    df = spark.createDataFrame([(n,) for n in range(1, 7)], "num bigint")
    out = O.sharded_running_sum(df, "num", ["num"], O.shard_task("num", 3), min_buckets=2)
    per_task = {}
    for r in out.orderBy("num").collect():
        per_task.setdefault(r.task, []).append(r.running_sum)
    assert per_task == {0: [3, 9], 1: [1, 5], 2: [2, 7]}
    assert O.merged_shard_total(out, ["num"]).first().total == 21


def test_shuffle_grouping_is_even_for_sparse_orders(spark):
    df = spark.range(0, 3000, 3).select(F.col("id").alias("seq"), F.col("id").alias("num"))
    out = O.shuffled_running_sum(df, "num", ["seq"], 3, min_buckets=4)
    assert out.columns == ["seq", "num", "task", "running_sum"]
    sizes = [r["count"] for r in out.groupBy("task").count().collect()]
    assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
    last = {r.task: r.m for r in out.groupBy("task").agg(F.max("running_sum").alias("m")).collect()}
    assert last == {t: sum(3 * (n - 1) for n in range(1, 1001) if n % 3 == t) for t in range(3)}


def test_fields_grouping_takes_keys_of_any_type(spark):
    import hashlib
    df = spark.createDataFrame([(i, w, 1) for i, w in enumerate(["a", "b", None, "a", "zz"])], "seq int, w string, v int")
    got = {r.w: r.task for r in df.withColumn("task", O.key_task(df, "w", 3)).collect()}
    assert got == {w: int(hashlib.md5((w or "").encode()).hexdigest()[:8], 16) % 3 for w in ("a", "b", None, "zz")}
    assert df.select(O.key_task(df, "seq", 2).alias("t")).collect()[3].t == 1


def test_all_grouping_replicas(spark):
    df = spark.createDataFrame([(n,) for n in range(1, 7)], "num bigint")
    out = O.replicated_running_sum(df, "num", ["num"], 3, min_buckets=2)
    for task in range(3):
        got = [r.running_sum for r in out.where(F.col("task") == task).orderBy("num").collect()]
        assert got == [1, 3, 6, 10, 15, 21]


def test_replicated_source_sharded(spark):
    df = spark.createDataFrame([(n, n) for n in range(1, 5)], "seq bigint, num bigint")
    out = O.replicated_source_sharded_sum(df, "num", "seq", 2, 4, min_buckets=2)
    assert out.count() == 8
    # position 2*(n-1)+instance mod 4: task 0 gets (1,0),(3,0)
    got = [r.running_sum for r in out.where("task = 0").orderBy("seq").collect()]
    assert got == [1, 4]
    assert out.groupBy("task").agg(F.max("running_sum").alias("m")).agg(F.sum("m")).first()[0] == 20


def test_fields_grouping_keys_share_task(spark):
    df = spark.createDataFrame([(i, i % 2, i) for i in range(1, 9)], "seq bigint, flag bigint, num bigint")
    out = O.sharded_running_sum(df, "num", ["seq"], O.shard_task("flag", 3), min_buckets=2)
    tasks = {r.flag: r.task for r in out.select("flag", "task").distinct().collect()}
    assert tasks == {0: 0, 1: 1}
    assert out.where("seq = 8").first().running_sum == 2 + 4 + 6 + 8


def test_running_count_changelog_and_latest(spark):
    words = spark.createDataFrame([(i, w) for i, w in enumerate("a b a c a b".split())], "seq bigint, word string")
    log = O.running_count(words, "word", ["seq"], "count", min_buckets=3).orderBy("seq").collect()
    assert [(r.word, r["count"]) for r in log] == [("a", 1), ("b", 1), ("a", 2), ("c", 1), ("a", 3), ("b", 2)]
    kv = O.running_count(words, "word", ["seq"], "count", min_buckets=3)
    latest = {r.key: r.value for r in O.latest_per_key(O.key_value(kv, "word", "count", "seq")).collect()}
    assert latest == {"a": "3", "b": "2", "c": "1"}


def test_snapshot_per_event(spark):
    words = spark.createDataFrame([(i, w) for i, w in enumerate("a b a".split())], "seq bigint, word string")
    snap = O.snapshot_per_event(words, "word", ["seq"], min_buckets=2).orderBy("seq", "word").collect()
    assert [(r.seq, r.word, r["count"]) for r in snap] == [(0, "a", 1), (1, "a", 1), (1, "b", 1),
                                                           (2, "a", 2), (2, "b", 1)]


def test_snapshot_of_many_keys(spark):
    df = spark.range(0, 1500).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("word"))
    snap = O.snapshot_per_event(df, "word", ["seq"], min_buckets=6)
    assert snap.count() == 1500 * 1501 // 2
    assert snap.where("seq = 700").agg(F.min("count"), F.max("count"), F.count("*")).first() == (1, 1, 701)


def test_snapshot_of_many_keys_is_dealt_evenly_over_tasks(spark):
    df = spark.range(0, 50_000).select(F.col("id").alias("seq"), (F.col("id") % 5_000).alias("k"))
    snap = O.snapshot_per_event(df, "k", ["seq"], min_buckets=2, events_per_page=1_000)
    written = [r["count"] for r in snap.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(written) == 5_000 * 5_001 // 2 + 45_000 * 5_000
    assert max(written) < sum(written) / 8
    few = O.snapshot_per_event(df.withColumn("k", F.col("k") % 3), "k", ["seq"], min_buckets=2, events_per_page=1_000)
    assert few.rdd.getNumPartitions() <= max(3, spark.sparkContext.defaultParallelism)


def test_request_response_and_dead_letter(spark):
    req = spark.createDataFrame([("1", "addUser", "ann"), ("2", "addUser", None), ("3", "dropUser", "bob")],
                                "id string, func string, args string")
    responses, dead = O.respond(req)
    assert {r.id: r.result for r in responses.collect()} == {"1": "add user:ann", "2": "add user:null"}
    d = dead.collect()
    assert [(r.id, r.reason) for r in d] == [("3", "unknown function")]


def test_split_outcomes_keeps_every_row(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([-1, 5, 11, 3])], "msg_id bigint, num bigint")
    routed = df.withColumn("outcome", O.routing.range_outcome("num"))
    ok, bad = O.split_outcomes(routed)
    assert ok.count() + bad.count() == 4
    assert sorted(r.msg_id for r in bad.collect()) == [0, 2]


def test_last_running_value_is_the_total(spark, events):
    ev = events.select("event_id", "user_id", "event_type")
    total = O.total_sum(ev, "user_id").first().total
    rs = O.running_sum(ev, "user_id", ["event_id"])
    assert rs.orderBy(F.desc("event_id")).first().running_sum == total
    per_key = O.running_sum(ev, "user_id", ["event_id"], partition_by=["event_type"])
    last = per_key.groupBy("event_type").agg(F.max_by("running_sum", "event_id").alias("last"))
    assert last.agg(F.sum("last")).first()[0] == total
    shards = O.sharded_running_sum(ev, "user_id", ["event_id"], O.shard_task("event_id", 3))
    assert O.merged_shard_total(shards, ["event_id"]).first().total == total
