"""Scale probe: plain window vs bucketed running totals on enlarged events.

The input is ``events`` replicated ``COPIES`` times by a generator
(``seq = copy * 10^7 + event_id`` keeps a unique total order), so it grows
with the given table.  Prints seconds for a global running sum and a per-key
running count, each as a plain window and as ``running_totals``.

usage: python tools/scale_probe.py [sf_dir] [copies] [cpus] [--verify]

``--verify`` also checks, with ~100k-row buckets, that ``running_totals``
equals the plain window on every row (count + order-independent hashes).
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cascata.operators.prefix import running_totals  # noqa: E402
from cascata.session import get_session  # noqa: E402


def verify(big, part) -> bool:
    def digest(df):
        h = F.xxhash64("seq", *part, "rs")
        return df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
                      F.sum(h.cast("decimal(38,0)")).alias("s")).first()

    frame = Window.partitionBy(*part).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    ours = digest(running_totals(big, {"rs": "user_id"}, ["seq"], part, rows_per_bucket=100_000))
    return ours == digest(big.withColumn("rs", F.sum("user_id").over(frame)))


def main(argv):
    check = "--verify" in argv
    argv = [a for a in argv if a != "--verify"]
    base = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    copies = int(argv[2]) if len(argv) > 2 else 200
    cpus = int(argv[3]) if len(argv) > 3 else 8
    spark = get_session(f"local[{cpus}]", cpus * 2, extra={"spark.ui.showConsoleProgress": "false",
                                                           "spark.driver.memory": "16g"})
    ev = spark.read.parquet(f"{base}/events.parquet").select("event_id", "user_id", "event_type")
    big = (ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
           .select((F.col("copy").cast("bigint") * F.lit(10_000_000) + F.col("event_id")).alias("seq"),
                   "user_id", "event_type"))

    def timed(label, build, runs=2):
        best = float("inf")
        for _ in range(runs):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        print(f"{label:44s} {best:7.2f}s (best of {runs})", flush=True)

    rows = big.count()
    print(f"rows={rows} cpus={cpus}")
    frame = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    timed("global running sum, plain window (1 task)", lambda: big.withColumn("rs", F.sum("user_id").over(frame)))
    timed("global running sum, running_totals", lambda: running_totals(big, {"rs": "user_id"}, ["seq"]))
    keyed = Window.partitionBy("event_type").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    timed("per-key running count, plain window", lambda: big.withColumn("n", F.count(F.lit(1)).over(keyed)))
    timed("per-key running count, running_totals",
          lambda: running_totals(big, {"n": F.lit(1)}, ["seq"], ["event_type"]))
    hot = big.withColumn("k", F.when(F.col("user_id") % 5 < 2, F.lit("hot")).otherwise(F.col("event_type")))
    share = hot.where("k = 'hot'").count() / rows
    hot_frame = Window.partitionBy("k").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    timed(f"hot key ({share:.0%}) running sum, plain window", lambda: hot.withColumn("rs", F.sum("user_id").over(hot_frame)))
    timed(f"hot key ({share:.0%}) running sum, running_totals",
          lambda: running_totals(hot, {"rs": "user_id"}, ["seq"], ["k"]))
    if check:
        print("verify global: same as plain window =", verify(hot, []))
        print("verify hot key: same as plain window =", verify(hot, ["k"]))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
