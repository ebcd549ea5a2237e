"""Run in its own process: master local[4,4] lets failed tasks be retried.

The input carries a column computed by a function that fails the first
attempt of partition 0 in every stage reading it; the running totals must
still equal the plain window (recomputation is deterministic: boundaries are
literals, buckets a pure function of the row).
"""

import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cascata.operators.prefix import running_totals  # noqa: E402

spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")


MARKS = sys.argv[3]


@F.udf("bigint")
def flaky(v):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        open(f"{MARKS}/stage-{ctx.stageId()}", "w").close()
        raise RuntimeError("injected task failure")
    return v


ev = spark.read.parquet(f"{sys.argv[2]}/events.parquet").repartition(4, "event_id")
ev = ev.select("event_id", "event_type", flaky("user_id").alias("v"))
got = running_totals(ev, {"rs": "v"}, ["event_id"], ["event_type"], min_buckets=6)
frame = Window.partitionBy("event_type").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
want = ev.withColumn("rs", F.sum("v").over(frame))
same = got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
import os  # noqa: E402

print("RESULT", same, got.count())
print("FAILURES", len(os.listdir(MARKS)))
