"""Operators against a direct brute-force computation on random small fixtures."""

import random
from collections import defaultdict

from cascata import operators as O


def _events(seed, n):
    rng = random.Random(seed)
    ids = rng.sample(range(10**6), n)
    return [(i, rng.choice(["a", "b", "c", None]), rng.randint(-50, 50)) for i in ids]


def test_snapshot_per_event_brute_force(spark):
    rows = _events(1, 300)
    df = spark.createDataFrame(rows, "seq bigint, k string, v bigint")
    got = {(r.seq, r.k, r.n) for r in O.snapshot_per_event(df, "k", ["seq"], name="n", min_buckets=5).collect()}
    want, counts = set(), defaultdict(int)
    for seq, k, _ in sorted(rows):
        counts[k] += 1
        want |= {(seq, key, c) for key, c in counts.items()}
    assert got == want


def test_shard_and_replica_sums_brute_force(spark):
    rows = _events(2, 400)
    df = spark.createDataFrame(rows, "seq bigint, k string, v bigint")
    ordered = sorted(rows)

    def brute(task_of, copies=1):
        sums, out = defaultdict(int), set()
        for seq, _, v in ordered:
            for inst in range(copies):
                t = task_of(seq, inst)
                sums[t] += v
                out.add((seq, inst, t, sums[t]))
        return out

    got = {(r.seq, 0, r.task, r.running_sum)
           for r in O.sharded_running_sum(df, "v", ["seq"], O.shard_task("seq", 3), min_buckets=6).collect()}
    assert got == brute(lambda s, i: s % 3)
    got = {(r.seq, 0, r.task, r.running_sum)
           for r in O.replicated_running_sum(df, "v", ["seq"], 3, min_buckets=6).collect()}
    want = {(s, 0, t, rs) for s, _, _, rs in brute(lambda s, i: 0) for t in range(3)}
    assert got == want
    got = {(r.seq, r.instance, r.task, r.running_sum)
           for r in O.replicated_source_sharded_sum(df, "v", "seq", 2, 4, min_buckets=6).collect()}
    place = {seq: n for n, (seq, _, _) in enumerate(ordered)}
    assert got == brute(lambda s, i: (2 * place[s] + i) % 4, copies=2)
    got = {(r.seq, 0, r.task, r.running_sum)
           for r in O.shuffled_running_sum(df, "v", ["seq"], 3, min_buckets=6).collect()}
    assert got == brute(lambda s, i: (place[s] + 1) % 3)


def test_outcome_sum_sequence_and_latest_brute_force(spark):
    rows = _events(3, 300)
    df = spark.createDataFrame(rows, "seq bigint, k string, v bigint")
    ordered = sorted(rows)
    got = {(r.seq, r.outcome, r.running_sum)
           for r in O.running_sum_with_outcome(df, "v", ["seq"], min_buckets=5).collect()}
    want, total = set(), 0
    for seq, _, v in ordered:
        total += v
        want.add((seq, "ack" if 0 < v <= 10 else "fail", total))
    assert got == want
    got = {(r.seq, r.num, r.flag) for r in O.keyed_sequence(df.select("seq"), ["seq"], min_buckets=5).collect()}
    assert got == {(seq, i + 1, i % 2) for i, (seq, _, _) in enumerate(ordered)}
    log = O.running_count(df, "k", ["seq"], "n", min_buckets=5)
    latest = {r.key: r.value for r in O.latest_per_key(
        log.select(log.k.alias("key"), log.n.alias("value"), log.seq.alias("seq"))).collect()}
    counts = defaultdict(int)
    for _, k, _ in ordered:
        counts[k] += 1
    assert latest == dict(counts)
