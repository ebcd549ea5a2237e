"""Structured Streaming operators: stream result == batch result, replays add nothing."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from cascata import operators as O
from cascata import streaming as S
from cascata.sinks import (BatchPartitionSink, JdbcChangelogSink, ParquetKeyedStore, delimited_records,
                           read_jdbc, start_rolling_text)
from cascata.sinks import paths
from cascata.sources.messages import MESSAGE_SCHEMA
from cascata.sources.tables import stream_table
from cascata.sources.text import directory_lines

BASE = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def event_slices(spark, tmp_path_factory):
    """events split by event_id range into 4 files written one after another."""
    d = str(tmp_path_factory.mktemp("event_slices"))
    ev = spark.read.parquet(f"{BASE}/events.parquet")
    bounds = [0, 250, 500, 750, 10**9]
    for i in range(4):
        part = ev.where((F.col("event_id") >= bounds[i]) & (F.col("event_id") < bounds[i + 1]))
        part.coalesce(1).write.mode("append").parquet(d)
        time.sleep(1.1)
    return d


def _events_stream(spark, d, files_per_batch=1):
    return stream_table(spark, d, "events", max_files_per_trigger=files_per_batch, glob="*.parquet")


def _run(query):
    query.awaitTermination(300)
    assert query.exception() is None


def test_directory_lines_consumed_once(spark, tmp_path):
    src = tmp_path / "in"
    (src / "sub").mkdir(parents=True)
    (src / "a.txt").write_text("x,y\nz")
    (src / "sub" / "b.txt").write_text("111,111\n")
    (src / "c.TXT").write_text("no")
    (src / "d.txt123").write_text("no")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    lines = directory_lines(spark, str(src))
    _run(S.start(lines, BatchPartitionSink(out), ck, available_now=True))
    got = sorted(r.line for r in spark.read.parquet(out).collect())
    assert got == ["111,111", "x,y", "z"]
    # a second run on the same checkpoint reads nothing new
    _run(S.start(directory_lines(spark, str(src)), BatchPartitionSink(out), ck, available_now=True))
    assert spark.read.parquet(out).count() == 3


def test_stream_word_count_matches_batch(spark, tmp_path):
    docs = stream_table(spark, BASE, "documents")
    lines = O.lines(docs, "text")
    counts = S.word_count_stream(lines)
    name = f"wc_{uuid.uuid4().hex[:8]}"
    q = S.start(counts, "memory", str(tmp_path / "ck"), output_mode="complete", query_name=name,
                available_now=True)
    _run(q)
    batch = O.word_count(O.tokenize_text(spark.read.parquet(f"{BASE}/documents.parquet"), "text"))
    assert _same(spark.table(name), batch)


def test_stream_keyed_upsert(spark, event_slices, tmp_path):
    store = ParquetKeyedStore(str(tmp_path / "store"), n_buckets=4)
    stream = _events_stream(spark, event_slices).select(F.col("event_type").alias("line"))
    counts = S.word_count_stream(stream)

    def upsert(batch, batch_id):
        store.upsert(S.count_changes(batch, batch_id), batch_id)

    _run(S.start(counts, upsert, str(tmp_path / "ck"), output_mode="update", available_now=True))
    ev = spark.read.parquet(f"{BASE}/events.parquet")
    expected = ev.groupBy(F.col("event_type").alias("key")).agg(F.count("*").cast("string").alias("value"))
    assert _same(store.read(spark).select("key", "value"), expected)
    # re-applying a batch changes nothing
    before = sorted(tuple(r) for r in store.read(spark).select("key", "value").collect())
    store.upsert(spark.createDataFrame([("view", "1", 0)], "key string, value string, seq bigint"), 0)
    assert sorted(tuple(r) for r in store.read(spark).select("key", "value").collect()) == before


def test_stream_running_count_across_batches(spark, event_slices, tmp_path):
    out, state, ck = str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "ck")
    writer = S.RunningTotalsWriter({"word_count": F.lit(1)}, ["event_id"], out, state, partition_by=["word"])
    stream = _events_stream(spark, event_slices).select("event_id", F.col("event_type").alias("word"))
    _run(S.start_running_totals(stream, writer, ck, available_now=True))
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == 4
    batch = O.running_count(spark.read.parquet(f"{BASE}/events.parquet")
                            .select("event_id", F.col("event_type").alias("word")), "word", ["event_id"], "word_count")
    assert _same(got.drop("batch_id"), batch)
    assert len(paths.versions(spark, state)) == 2
    # restart from the checkpoint: nothing new, nothing duplicated
    _run(S.start_running_totals(_events_stream(spark, event_slices).select(
        "event_id", F.col("event_type").alias("word")), writer, ck, available_now=True))
    assert spark.read.parquet(out).count() == batch.count()


def test_stream_global_running_sum_and_replay(spark, event_slices, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    writer = S.RunningTotalsWriter({"running_sum": "user_id"}, ["event_id"], out, state)
    stream = _events_stream(spark, event_slices).select("event_id", "user_id")
    _run(S.start_running_totals(stream, writer, str(tmp_path / "ck"), available_now=True))
    ev = spark.read.parquet(f"{BASE}/events.parquet").select("event_id", "user_id")
    expected = O.running_sum(ev, "user_id", ["event_id"])
    assert _same(spark.read.parquet(out).drop("batch_id"), expected)
    # replaying the last batch by hand rewrites the same rows
    last = spark.read.parquet(out).agg(F.max("batch_id")).first()[0]
    replay = ev.where("event_id >= 750")
    writer(replay, last)
    assert _same(spark.read.parquet(out).drop("batch_id"), expected)


def test_stream_dead_letter(spark, event_slices, tmp_path):
    rec, ok, dead = str(tmp_path / "receipts"), str(tmp_path / "ok"), str(tmp_path / "dead")
    router = S.range_router("event_id", "user_id", rec, ok, dead)
    stream = _events_stream(spark, event_slices).select("event_id", "user_id")
    ck = str(tmp_path / "ck")
    _run(S.start(stream, router, ck, available_now=True))
    ev = spark.read.parquet(f"{BASE}/events.parquet")
    n = ev.count()
    n_ok = ev.where("user_id > 0 and user_id <= 10").count()
    assert spark.read.parquet(rec).count() == n
    assert spark.read.parquet(ok).count() == n_ok
    assert spark.read.parquet(dead).count() == n - n_ok
    assert {r.reason for r in spark.read.parquet(dead).select("reason").distinct().collect()} == {"fail"}
    _run(S.start(_events_stream(spark, event_slices).select("event_id", "user_id"), router, ck, available_now=True))
    assert spark.read.parquet(rec).count() == n
    # dead letters re-run with a wider rule: the ones that now pass are resolved
    resolved, still = S.resolve_dead_letters(spark.read.parquet(dead),
                                             lambda df: O.routing.range_outcome("user_id", 0, 1000))
    assert resolved.count() == n - n_ok - still.count()


def test_stream_jdbc_changelog(spark, event_slices, tmp_path):
    url = f"jdbc:derby:memory:wc{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    sink = JdbcChangelogSink(url, "wc", props, max_connections=2)
    writer = S.RunningTotalsWriter({"word_count": F.lit(1)}, ["event_id"],
                                   lambda df, b: sink(df.select("word", "word_count"), b),
                                   str(tmp_path / "state"), partition_by=["word"])
    stream = _events_stream(spark, event_slices).select("event_id", F.col("event_type").alias("word"))
    _run(S.start_running_totals(stream, writer, str(tmp_path / "ck"), available_now=True))
    table = read_jdbc(spark, url, "wc", props)
    ev = spark.read.parquet(f"{BASE}/events.parquet")
    assert table.count() == ev.count()
    finals = table.groupBy("word").agg(F.max("word_count").alias("n"))
    assert _same(finals, ev.groupBy(F.col("event_type").alias("word")).agg(F.count("*").alias("n")))
    # a retried batch replaces its own rows
    some = spark.createDataFrame(table.where("batch_id = 1").select("word", "word_count").collect(),
                                 "word string, word_count bigint")
    sink(some, 1)
    assert read_jdbc(spark, url, "wc", props).count() == ev.count()


def test_stream_rolling_delimited_files(spark, tmp_path):
    out = str(tmp_path / "files")
    orders = stream_table(spark, "/root/testdata/sf0.01", "orders")
    records = delimited_records(orders)
    _run(start_rolling_text(records, out, str(tmp_path / "ck"), max_records_per_file=4000, available_now=True))
    files = [f for f in os.listdir(out) if f.endswith(".txt") or f.startswith("part-")]
    back = spark.read.text(out)
    assert back.count() == 15000
    assert len(files) >= 4          # 15,000 records, at most 4,000 per file
    first = back.first().value
    assert first.count("|") == 5


def test_stream_request_response(spark, tmp_path):
    reqs_dir = tmp_path / "reqs"
    cust = spark.read.parquet(f"{BASE}/customer.parquet")
    reqs = cust.select(F.col("c_custkey").cast("string").alias("id"), F.lit("addUser").alias("func"),
                       F.col("c_name").alias("args"))
    extra = spark.createDataFrame([("x1", "dropUser", "bob")], "id string, func string, args string")
    reqs.unionByName(extra).write.parquet(str(reqs_dir))
    stream = spark.readStream.schema("id string, func string, args string").parquet(str(reqs_dir))
    resp, dead = str(tmp_path / "resp"), str(tmp_path / "dead")
    _run(S.start(stream, S.ResponseWriter(resp, dead), str(tmp_path / "ck"), available_now=True))
    responses = spark.read.parquet(resp)
    assert responses.count() == cust.count()
    joined = S.responses_for(responses, reqs)
    assert joined.where("result is null").count() == 0
    assert joined.where("result = concat('add user:', args)").count() == cust.count()
    assert [r.id for r in spark.read.parquet(dead).collect()] == ["x1"]


def test_stream_message_decode(spark, tmp_path):
    msgs = spark.createDataFrame(
        [(None, "héllo".encode(), "logs", 0, 0, None, 0), (None, bytes([0xFF, 0xFE, 0x41]), "logs", 0, 1, None, 0),
         (None, None, "logs", 0, 2, None, 0)], MESSAGE_SCHEMA)
    d = str(tmp_path / "msgs")
    msgs.write.parquet(d)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(d)
    rec, ok, dead = str(tmp_path / "rec"), str(tmp_path / "ok"), str(tmp_path / "dead")
    _run(S.start(stream, S.message_router(rec, ok, dead), str(tmp_path / "ck"), available_now=True))
    assert sorted(r.text for r in spark.read.parquet(ok).collect()) == ["héllo", "��A"]
    assert [r.offset for r in spark.read.parquet(dead).collect()] == [2]
    # strict mode also rejects malformed bytes
    rec2, ok2, dead2 = str(tmp_path / "rec2"), str(tmp_path / "ok2"), str(tmp_path / "dead2")
    _run(S.start(spark.readStream.schema(MESSAGE_SCHEMA).parquet(d), S.message_router(rec2, ok2, dead2, strict=True),
                 str(tmp_path / "ck2"), available_now=True))
    assert sorted(r.offset for r in spark.read.parquet(dead2).collect()) == [1, 2]


def test_stream_sharded_and_replicated_sums(spark, event_slices, tmp_path):
    """Shuffle grouping (3 tasks) and all grouping (3 replicas) as streams."""
    ev = spark.read.parquet(f"{BASE}/events.parquet").select("event_id", F.col("user_id").alias("num"))
    task = O.shard_task("event_id", 3)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    writer = S.RunningTotalsWriter({"running_sum": "num"}, ["event_id"], out, state, partition_by=["task"])
    stream = _events_stream(spark, event_slices).select("event_id", F.col("user_id").alias("num"))
    _run(S.start_running_totals(stream.withColumn("task", task), writer, str(tmp_path / "ck"), available_now=True))
    expected = O.sharded_running_sum(ev, "num", ["event_id"], task)
    assert _same(spark.read.parquet(out).drop("batch_id").select(*expected.columns), expected)

    out2, state2 = str(tmp_path / "out2"), str(tmp_path / "state2")
    writer2 = S.RunningTotalsWriter({"running_sum": "num"}, ["event_id"], out2, state2, partition_by=["task"])
    replicas = O.replicate(_events_stream(spark, event_slices).select("event_id", F.col("user_id").alias("num")),
                           3, "task")
    _run(S.start_running_totals(replicas, writer2, str(tmp_path / "ck2"), available_now=True))
    expected2 = O.replicated_running_sum(ev, "num", ["event_id"], 3)
    assert _same(spark.read.parquet(out2).drop("batch_id").select(*expected2.columns), expected2)


def test_dead_letter_replay_is_idempotent(spark, event_slices, tmp_path):
    rec, ok, dead, resolved = (str(tmp_path / x) for x in ("receipts", "ok", "dead", "resolved"))
    router = S.range_router("event_id", "user_id", rec, ok, dead)
    _run(S.start(_events_stream(spark, event_slices).select("event_id", "user_id"), router,
                 str(tmp_path / "ck"), available_now=True))
    ev = spark.read.parquet(f"{BASE}/events.parquet")
    wider = lambda df: O.routing.range_outcome("user_id", 0, 100)
    fixable = ev.where("user_id > 10 and user_id <= 100").count()
    n_dead = spark.read.parquet(dead).count()
    assert S.replay_dead_letters(spark, dead, resolved, ["event_id"], wider, str(tmp_path / "ok2"), 0) == fixable
    pending = S.unresolved_dead_letters(spark, dead, resolved, ["event_id"])
    assert pending.count() == n_dead - fixable
    # a second replay finds nothing new; re-running replay 0 replaces its own rows
    assert S.replay_dead_letters(spark, dead, resolved, ["event_id"], wider, str(tmp_path / "ok2"), 1) == 0
    assert spark.read.parquet(resolved).count() == fixable


@pytest.mark.parametrize("files_per_batch,batches", [(4, 1), (2, 2), (1, 4)])
def test_stream_equals_batch_for_1_2_k_batches(spark, event_slices, tmp_path, files_per_batch, batches):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    writer = S.RunningTotalsWriter({"rs": "user_id"}, ["event_id"], out, state, partition_by=["event_type"])
    stream = _events_stream(spark, event_slices, files_per_batch).select("event_id", "event_type", "user_id")
    _run(S.start_running_totals(stream, writer, str(tmp_path / "ck"), available_now=True))
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() == batches
    ev = spark.read.parquet(f"{BASE}/events.parquet").select("event_id", "event_type", "user_id")
    assert _same(got.drop("batch_id"), O.running_sum(ev, "user_id", ["event_id"], "rs", ["event_type"]))


def _store_rows(rows):
    return [(f"k{i}", str(i), 0) for i in range(rows)]


def test_keyed_store_survives_a_crash_before_the_manifest(spark, tmp_path, monkeypatch):
    store = ParquetKeyedStore(str(tmp_path / "store"), n_buckets=4)
    schema = "key string, value string, seq bigint"
    store.upsert(spark.createDataFrame(_store_rows(40), schema), 0)
    change = spark.createDataFrame([("k1", "100", 1), ("k2", "200", 1)], schema)

    def crash(*_):
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(paths, "write_text", crash)
        with pytest.raises(OSError):
            store.upsert(change, 1)
    # the store is as it was, for any process; the replay applies the batch
    again = ParquetKeyedStore(str(tmp_path / "store"), n_buckets=4)
    assert {r.key: r.value for r in again.read(spark).collect()} == {k: v for k, v, _ in _store_rows(40)}
    again.upsert(change, 1)
    again.upsert(change, 1)
    want = {k: v for k, v, _ in _store_rows(40)} | {"k1": "100", "k2": "200"}
    assert {r.key: r.value for r in again.read(spark).collect()} == want
    assert again.read(spark).count() == 40


def test_keyed_store_keeps_its_bucket_count(spark, tmp_path):
    schema = "key string, value string, seq bigint"
    ParquetKeyedStore(str(tmp_path / "s"), n_buckets=8).upsert(spark.createDataFrame(_store_rows(20), schema), 0)
    wider = ParquetKeyedStore(str(tmp_path / "s"), n_buckets=64)
    wider.upsert(spark.createDataFrame(_store_rows(20), schema), 1)
    assert wider.read(spark).count() == 20


def test_keyed_store_of_a_new_stream_applies_its_own_batches(spark, tmp_path):
    store = ParquetKeyedStore(str(tmp_path / "s"), n_buckets=2)
    schema = "key string, value string, seq bigint"
    for value in ("1", "2", "3", "4", "5", "6"):         # batch ids start again: nothing of an earlier run is reused
        store.upsert(spark.createDataFrame([("k", value, int(value)), (None, value, 0)], schema), 0)
    assert {(r.key, r.value) for r in store.read(spark).collect()} == {("k", "6"), (None, "6")}
    assert len(paths.children(spark, f"{store.path}/manifests")) <= 4


def test_jdbc_sink_with_schema_qualified_table(spark):
    url = f"jdbc:derby:memory:q{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    sink = JdbcChangelogSink(url, "app.wc2", props)
    rows = spark.createDataFrame([("a", 1), ("b", 1)], "word string, word_count bigint")
    sink(rows, 3)
    sink(rows, 3)          # a retried batch replaces its rows
    assert read_jdbc(spark, url, "app.wc2", props).count() == 2


def test_stream_sequence_numbers_and_replicated_source(spark, event_slices, tmp_path):
    ev = spark.read.parquet(f"{BASE}/events.parquet").select("event_id", F.col("user_id").alias("num"))
    # S4/S5: numbering continues across micro-batches; the flag is derived in the sink
    out = str(tmp_path / "seq")

    def flagged(df, b):
        BatchPartitionSink(out)(df.withColumn("flag", F.pmod(F.col("seq") - 1, F.lit(2))), b)

    writer = S.RunningTotalsWriter({"seq": F.lit(1)}, ["event_id"], flagged, str(tmp_path / "state"))
    _run(S.start_running_totals(_events_stream(spark, event_slices).select("event_id"), writer,
                                str(tmp_path / "ck"), available_now=True))
    expected = O.keyed_sequence(ev.select("event_id"), ["event_id"], num="seq")
    assert _same(spark.read.parquet(out).drop("batch_id").select(*expected.columns), expected)

    # G5: two source instances into four tasks
    out2 = str(tmp_path / "g5")
    copies = O.replicate(_events_stream(spark, event_slices).select("event_id", F.col("user_id").alias("num")),
                         2, "instance")
    tasks = copies.withColumn("task", O.shard_task(F.col("event_id") * 2 + F.col("instance"), 4))
    writer2 = S.RunningTotalsWriter({"running_sum": "num"}, ["event_id", "instance"], out2,
                                    str(tmp_path / "state2"), partition_by=["task"])
    _run(S.start_running_totals(tasks, writer2, str(tmp_path / "ck2"), available_now=True))
    expected2 = O.replicated_source_sharded_sum(ev, "num", "event_id", 2, 4)
    assert _same(spark.read.parquet(out2).drop("batch_id").select(*expected2.columns), expected2)


def test_running_writer_refuses_a_state_folder_of_another_run(spark, tmp_path):
    state = tmp_path / "state"
    (state / "v=7").mkdir(parents=True)
    writer = S.RunningTotalsWriter({"n": F.lit(1)}, ["seq"], str(tmp_path / "out"), str(state))
    batch = spark.createDataFrame([(1,), (2,)], "seq bigint")
    with pytest.raises(RuntimeError):
        writer(batch, 0)


def test_a_small_batch_rewrites_only_its_state_buckets(spark, tmp_path):
    state = str(tmp_path / "state")
    writer = S.RunningTotalsWriter({"n": F.lit(1)}, ["seq"], str(tmp_path / "out"), state, partition_by=["k"],
                                   state_buckets=16)
    writer(spark.range(0, 20_000).select(F.col("id").alias("seq"), F.col("id").cast("string").alias("k")), 0)
    assert len([f for f in paths.children(spark, f"{state}/v=0") if f.startswith("bucket=")]) == 16
    writer(spark.createDataFrame([(20_000, "7"), (20_001, "7"), (20_002, "new")], "seq bigint, k string"), 1)
    assert 1 <= len([f for f in paths.children(spark, f"{state}/v=1") if f.startswith("bucket=")]) <= 2
    writer(spark.createDataFrame([(20_003, "7"), (20_004, "19999"), (20_005, None)], "seq bigint, k string"), 2)
    writer(spark.createDataFrame([(20_006, None), (20_007, "new")], "seq bigint, k string"), 3)
    got = {r.seq: r.n for r in spark.read.parquet(str(tmp_path / "out")).where("seq >= 20000").collect()}
    assert got == {20_000: 2, 20_001: 3, 20_002: 1, 20_003: 4, 20_004: 2, 20_005: 1, 20_006: 2, 20_007: 2}
