"""Command-line jobs (``spark-submit cascata/cli.py <job> ...``).

Each job wires a source, the operators and a sink; streaming jobs take a
checkpoint folder (one per job) and run until stopped, or once over what is
available with ``--available-now``.

  word-count       text files -> comma tokens -> counts per word (update: keyed store; complete: parquet snapshot)
  running-count    text lines -> per-record running count per line (changelog) -> JDBC table or parquet;
                   --snapshots: after every line the counts of all lines so far -> parquet
  rolling-files    parquet table -> delimited records -> rolling text files
  running-sum      parquet table -> running sum (global, per key, per shard, replicated);
                   with --checkpoint and --state a stream whose sums continue from batch to batch
  tracked-sum      parquet table -> running sum of messages with ids -> receipts, acknowledged rows, dead letters
  replay           dead letters of a tracked-sum, each tried once more   [batch]
  decode-messages  message topic -> text, receipts, dead letters
  requests         request files (id, func, args) -> responses and dead letters
"""

from __future__ import annotations

import argparse
import json
import os
import sys

if __package__ in (None, ""):       # run as a file (spark-submit cascata/cli.py): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from cascata import operators as O  # noqa: E402
from cascata import streaming as S  # noqa: E402
from cascata.functions.routing import RANGE_HIGH_INCLUSIVE, RANGE_LOW_EXCLUSIVE, range_outcome  # noqa: E402
from cascata.session import get_session  # noqa: E402
from cascata.sinks import BatchPartitionSink, JdbcChangelogSink, ParquetKeyedStore, delimited_records, paths  # noqa: E402
from cascata.sinks.files import mean_record_bytes, records_per_file, start_rolling_text  # noqa: E402
from cascata.sources.messages import MESSAGE_SCHEMA, kafka_options, read_kafka  # noqa: E402
from cascata.sources.tables import stream_parquet  # noqa: E402
from cascata.sources.text import directory_lines  # noqa: E402


def _trigger(args) -> dict:
    return {"available_now": args.available_now, "processing_time": args.trigger}


def word_count(spark, args):
    counts = S.word_count_stream(directory_lines(spark, args.input, args.extension, args.max_files))
    if args.mode == "complete":
        sink = BatchPartitionSink(args.output)
        return S.start(counts, sink, args.checkpoint, output_mode="complete", **_trigger(args))
    store = ParquetKeyedStore(args.output)
    return S.start(counts, lambda df, b: store.upsert(S.count_changes(df, b), b), args.checkpoint,
                   output_mode="update", **_trigger(args))


def jdbc_connection(spark, url, driver, properties_file) -> tuple[str | None, dict]:
    """(url, properties) from a Java properties file, so that no password stands on the command line.

    The file may hold ``url`` and ``driver`` too; the options win over it.
    """
    found = {}
    if properties_file:
        jvm = spark.sparkContext._jvm
        loaded = jvm.java.util.Properties()
        loaded.load(jvm.java.io.StringReader(paths.read_text(spark, properties_file)))
        found = {str(k): str(loaded.getProperty(k)) for k in loaded.stringPropertyNames()}
    own_url = found.pop("url", None)
    if driver:
        found["driver"] = driver
    return url or own_url, found


def running_count(spark, args):
    lines = directory_lines(spark, args.input, args.extension, args.max_files)
    # A total order inside each micro-batch (split index, then position in
    # the split).  The writer persists the batch, so the ids are read once;
    # recomputing a lost split gives the same ids.  The multiset of
    # (word, count) changes does not depend on the order chosen.
    def number(batch):
        return batch.select(F.monotonically_increasing_id().alias("seq"), F.col("line").alias("word"))
    if args.snapshots:
        writer = S.SnapshotWriter("word", ["seq"], args.output, args.state, name="word_count", prepare=number)
        return S.start_running_totals(lines, writer, args.checkpoint, **_trigger(args))
    url, properties = jdbc_connection(spark, args.jdbc_url, args.jdbc_driver, args.jdbc_properties)
    if url:
        jdbc = JdbcChangelogSink(url, args.jdbc_table, properties)
        sink = lambda df, b: jdbc(df.select("word", F.col("word_count")), b)
    else:
        sink = args.output
    writer = S.RunningTotalsWriter({"word_count": F.lit(1)}, ["seq"], sink, args.state, partition_by=["word"],
                                   prepare=number)
    return S.start_running_totals(lines, writer, args.checkpoint, **_trigger(args))


def rolling_files(spark, args):
    table = stream_parquet(spark, args.input)
    per_file = args.records_per_file or records_per_file(
        mean_record_bytes(delimited_records(spark.read.parquet(args.input))))
    return start_rolling_text(delimited_records(table), args.output, args.checkpoint, per_file, **_trigger(args))


def running_sum(spark, args):
    if args.grouping in ("key", "fields") and not args.key:
        raise SystemExit(f"running-sum: --key is required with --grouping {args.grouping}")
    if args.checkpoint:
        return running_sum_stream(spark, args)
    df = spark.read.parquet(args.input)
    if args.grouping == "key":
        out = O.running_sum(df, args.value, [args.order], partition_by=[args.key])
    elif args.grouping == "shuffle":
        out = O.shuffled_running_sum(df, args.value, [args.order], args.tasks)
    elif args.grouping == "fields":
        out = O.sharded_running_sum(df, args.value, [args.order], O.key_task(df, args.key, args.tasks))
    elif args.grouping == "replicated-source":
        out = O.replicated_source_sharded_sum(df, args.value, args.order, args.copies, args.tasks)
    elif args.grouping == "all":
        out = O.replicated_running_sum(df, args.value, [args.order], args.tasks)
    else:
        out = O.running_sum(df, args.value, [args.order])
    out.write.mode("overwrite").parquet(args.output)


def running_sum_stream(spark, args):
    """The same groupings over rows as they arrive: by micro-batch, and by ``--order`` inside one."""
    if not args.state:
        raise SystemExit("running-sum: --state is required with --checkpoint")
    rows = stream_parquet(spark, args.input, max_files_per_trigger=args.max_files)
    order, sums = [args.order], {"running_sum": args.value}
    if args.grouping in ("shuffle", "replicated-source"):
        instances = args.copies if args.grouping == "replicated-source" else None
        writer = S.ShuffledSumWriter(args.value, order, args.tasks, args.output, args.state, instances=instances)
    elif args.grouping == "fields":
        writer = S.RunningTotalsWriter(sums, order, args.output, args.state, partition_by=["task"],
                                       prepare=lambda df: df.withColumn("task", O.key_task(df, args.key, args.tasks)))
    elif args.grouping == "key":
        writer = S.RunningTotalsWriter(sums, order, args.output, args.state, partition_by=[args.key])
    elif args.grouping == "all":
        # one sum for all replicas, copied when it is written
        table = BatchPartitionSink(args.output)
        writer = S.RunningTotalsWriter(sums, order, lambda df, b: table(O.replicate(df, args.tasks, "task"), b), args.state)
    else:
        writer = S.RunningTotalsWriter(sums, order, args.output, args.state)
    return S.start_running_totals(rows, writer, args.checkpoint, **_trigger(args))


def tracked_sum(spark, args):
    """Messages with ids: each adds to the running sum, then succeeds if ``low < value <= high`` or becomes a dead letter.

    Receipts, acknowledged rows and dead letters of a micro-batch become visible together; all carry the sum so far.
    """
    rows = stream_parquet(spark, args.input, max_files_per_trigger=args.max_files)
    router = S.OutcomeRouter([args.id], lambda df: range_outcome(args.value, args.low, args.high), f"{args.output}/receipts",
                             f"{args.output}/ok", f"{args.output}/dead", commits=f"{args.output}/commits")
    writer = S.RunningTotalsWriter({"running_sum": args.value}, [args.order or args.id], router, args.state)
    return S.start_running_totals(rows, writer, args.checkpoint, **_trigger(args))


def replay(spark, args):
    book = S.DeadLetterBook(f"{args.output}/letters", f"{args.output}/dead", f"{args.output}/commits")
    last = book.replays.last(spark)
    replay_id = args.replay_id if args.replay_id is not None else 0 if last is None else last + 1
    counts = book.replay(spark, replay_id, lambda df: range_outcome(args.value, args.low, args.high),
                         f"{args.output}/replayed")
    print(json.dumps({"replay_id": replay_id, **counts}))


def decode_messages(spark, args):
    if args.kafka_servers:
        if not args.topic:
            raise SystemExit("decode-messages: --topic is required with --kafka-servers")
        messages = read_kafka(spark, kafka_options(args.kafka_servers, args.topic))
    elif not args.input:
        raise SystemExit("decode-messages: give --kafka-servers/--topic or --input")
    else:
        messages = stream_parquet(spark, args.input, MESSAGE_SCHEMA)
    router = S.message_router(f"{args.output}/receipts", f"{args.output}/ok", f"{args.output}/dead", args.strict)
    return S.start(messages, router, args.checkpoint, **_trigger(args))


def requests(spark, args):
    reqs = stream_parquet(spark, args.input, "id string, func string, args string")
    writer = S.ResponseWriter(f"{args.output}/responses", f"{args.output}/dead")
    return S.start(reqs, writer, args.checkpoint, **_trigger(args))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="cascata", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="job", required=True)

    def streaming(name, fn, input_required=True, **kw):
        s = sub.add_parser(name, **kw)
        s.add_argument("--input", required=input_required)
        s.add_argument("--output", required=True)
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--available-now", action="store_true")
        s.add_argument("--trigger", help="processing-time trigger, e.g. '10 seconds'")
        s.set_defaults(run=fn)
        return s

    s = streaming("word-count", word_count)
    s.add_argument("--mode", choices=["update", "complete"], default="update")
    s.add_argument("--extension", default="txt")
    s.add_argument("--max-files", type=int)
    s = streaming("running-count", running_count)
    s.add_argument("--state", required=True)
    s.add_argument("--extension", default="txt")
    s.add_argument("--max-files", type=int)
    s.add_argument("--jdbc-url")
    s.add_argument("--jdbc-table", default="wc")
    s.add_argument("--jdbc-driver")
    s.add_argument("--jdbc-properties", help="file of connection properties (user, password, ...; also url and driver)")
    s.add_argument("--snapshots", action="store_true", help="after every line, the counts of all lines so far")
    s = streaming("rolling-files", rolling_files)
    s.add_argument("--records-per-file", type=int)
    s = streaming("decode-messages", decode_messages, input_required=False)
    s.add_argument("--kafka-servers")
    s.add_argument("--topic")
    s.add_argument("--strict", action="store_true")
    streaming("requests", requests)

    def outcome_range(s):
        s.add_argument("--value", required=True)
        s.add_argument("--low", type=int, default=RANGE_LOW_EXCLUSIVE, help="a value above it ...")
        s.add_argument("--high", type=int, default=RANGE_HIGH_INCLUSIVE, help="... and up to this one succeeds")

    s = streaming("tracked-sum", tracked_sum)
    s.add_argument("--state", required=True)
    s.add_argument("--id", required=True)
    s.add_argument("--order", help="order inside a micro-batch (the id if not given)")
    s.add_argument("--max-files", type=int)
    outcome_range(s)
    r = sub.add_parser("replay")
    r.add_argument("--output", required=True, help="the tracked-sum's output folder")
    r.add_argument("--replay-id", type=int, help="one more than the last if not given; an id that is done does nothing")
    outcome_range(r)
    r.set_defaults(run=replay)

    b = sub.add_parser("running-sum")
    b.add_argument("--input", required=True)
    b.add_argument("--output", required=True)
    b.add_argument("--order", required=True)
    b.add_argument("--value", required=True)
    b.add_argument("--key")
    b.add_argument("--grouping", choices=["global", "key", "shuffle", "fields", "all", "replicated-source"],
                   default="global")
    b.add_argument("--tasks", type=int, default=3)
    b.add_argument("--copies", type=int, default=2, help="source instances of replicated-source")
    b.add_argument("--checkpoint", help="run as a stream (with --state)")
    b.add_argument("--state")
    b.add_argument("--available-now", action="store_true")
    b.add_argument("--trigger")
    b.add_argument("--max-files", type=int)
    b.set_defaults(run=running_sum)
    return p


def main(argv=None) -> int:
    args = parser().parse_args(argv)
    spark = get_session(app_name=f"cascata-{args.job}")
    query = args.run(spark, args)
    if query is not None:
        query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
