"""Crash in the middle of a micro-batch, restart from the checkpoint: no loss, no duplicates."""

import time

import pytest
from pyspark.sql import functions as F

from cascata import operators as O
from cascata import streaming as S
from cascata.sources.tables import stream_table

BASE = "/root/testdata/sf0.001"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def slices(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("recovery_slices"))
    ev = spark.read.parquet(f"{BASE}/events.parquet")
    for lo, hi in [(0, 300), (300, 600), (600, 10**9)]:
        ev.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1).write.mode("append").parquet(d)
        time.sleep(1.1)
    return d


class CrashOnce:
    """Wraps a foreachBatch function; the first time batch ``at`` runs, the
    wrapped sink writes its output and then the job dies."""

    def __init__(self, writer, at):
        self.writer, self.at, self.crashed = writer, at, False

    def __call__(self, df, batch_id):
        if batch_id == self.at and not self.crashed:
            self.crashed = True
            sink = self.writer.sink
            self.writer.sink = lambda out, b: (sink(out, b), (_ for _ in ()).throw(RuntimeError("crash")))
            try:
                self.writer(df, batch_id)
            finally:
                self.writer.sink = sink
        return self.writer(df, batch_id)


def _stream(spark, d):
    return (stream_table(spark, d, "events", max_files_per_trigger=1, glob="*.parquet")
            .select("event_id", F.col("event_type").alias("word")))


def test_running_count_survives_a_crash_between_output_and_state(spark, slices, tmp_path):
    out, state, ck = str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "ck")
    writer = S.RunningTotalsWriter({"word_count": F.lit(1)}, ["event_id"], out, state, partition_by=["word"])
    q = S.start_running_totals(_stream(spark, slices), CrashOnce(writer, at=1), ck, available_now=True)
    with pytest.raises(Exception):
        q.awaitTermination(300)
    # batch 1 wrote its output, its state was never saved; restart replays it
    q = S.start_running_totals(_stream(spark, slices), writer, ck, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(out)
    expected = O.running_count(spark.read.parquet(f"{BASE}/events.parquet")
                               .select("event_id", F.col("event_type").alias("word")), "word", ["event_id"], "word_count")
    assert got.count() == expected.count()
    assert _same(got.drop("batch_id"), expected)


def test_router_survives_a_crash_after_receipts(spark, slices, tmp_path):
    rec, ok, dead, ck = (str(tmp_path / x) for x in ("rec", "ok", "dead", "ck"))
    router = S.range_router("event_id", "user_id", rec, ok, dead)
    crashed = {"done": False}

    def flaky(df, batch_id):
        if batch_id == 2 and not crashed["done"]:
            crashed["done"] = True
            router.receipts(df.select("event_id", O.routing.range_outcome("user_id").alias("outcome")), batch_id)
            raise RuntimeError("crash after receipts")
        router(df, batch_id)

    stream = lambda: stream_table(spark, slices, "events", max_files_per_trigger=1,
                                  glob="*.parquet").select("event_id", "user_id")
    q = S.start(stream(), flaky, ck, available_now=True)
    with pytest.raises(Exception):
        q.awaitTermination(300)
    q = S.start(stream(), router, ck, available_now=True)
    q.awaitTermination(300)
    ev = spark.read.parquet(f"{BASE}/events.parquet")
    n, n_ok = ev.count(), ev.where("user_id > 0 and user_id <= 10").count()
    assert spark.read.parquet(rec).count() == n
    assert spark.read.parquet(ok).count() == n_ok
    assert spark.read.parquet(dead).count() == n - n_ok
