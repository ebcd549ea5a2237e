"""Streaming throughput: running count per key over events split into k files.

Writes ``events`` of one scale as k range slices (one file each, in order)
to a fresh scratch folder, then runs the running-count stream with
``maxFilesPerTrigger=1`` and ``availableNow`` (k micro-batches) and the
streaming word count over the same rows.  Prints rows/s.

usage: python tools/stream_probe.py [sf_dir] [k] [cpus] [scratch_parent]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cascata import streaming as S  # noqa: E402
from cascata.session import get_session  # noqa: E402
from cascata.sources.tables import stream_table  # noqa: E402


def main(argv):
    base = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    k = int(argv[2]) if len(argv) > 2 else 4
    cpus = int(argv[3]) if len(argv) > 3 else 4
    scratch = tempfile.mkdtemp(prefix="stream-probe-", dir=argv[4] if len(argv) > 4 else None)
    spark = get_session(f"local[{cpus}]", cpus, extra={"spark.ui.showConsoleProgress": "false"})
    ev = spark.read.parquet(f"{base}/events.parquet")
    n = ev.count()
    lo, hi = ev.agg(F.min("event_id"), F.max("event_id")).first()
    step = (hi - lo + 1 + k - 1) // k
    slices = f"{scratch}/slices"
    for i in range(k):
        part = ev.where((F.col("event_id") >= lo + i * step) & (F.col("event_id") < lo + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(slices)
        time.sleep(1.1)          # file source orders files by modification time

    def stream():
        return stream_table(spark, slices, "events", max_files_per_trigger=1, glob="*.parquet")

    writer = S.RunningTotalsWriter({"word_count": F.lit(1)}, ["event_id"], f"{scratch}/out", f"{scratch}/state",
                                   partition_by=["word"])
    t0 = time.perf_counter()
    q = S.start_running_totals(stream().select("event_id", F.col("event_type").alias("word")), writer,
                               f"{scratch}/ck", available_now=True)
    q.awaitTermination()
    dt = time.perf_counter() - t0
    print(f"running count per key: {n} rows, {k} batches, {dt:.2f}s, {n / dt:,.0f} rows/s")

    counts = S.word_count_stream(stream().select(F.col("event_type").alias("line")))
    t0 = time.perf_counter()
    q = S.start(counts, "noop", f"{scratch}/ck2", output_mode="update", available_now=True)
    q.awaitTermination()
    dt = time.perf_counter() - t0
    print(f"word count (update):   {n} rows, {k} batches, {dt:.2f}s, {n / dt:,.0f} rows/s")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
