"""The named batch queries and their SQL oracles.

Each query takes ``(spark, base_dir)`` and returns a lazy DataFrame over the
driver tables in ``base_dir``; the oracle is an independent SQL statement
(DuckDB dialect) over the same tables.  Column names and types agree.

Conventions: ``events`` is the default message stream — its unique,
time-ordered ``event_id`` is the arrival order, ``user_id`` the number being
summed and ``event_type`` the word/key being counted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cascata import functions as X
from cascata import operators as O
from cascata import streaming as S
from cascata.functions import sql as sql_functions
from cascata.session import scratch_folder
from cascata.sinks import (ParquetKeyedStore, RollingTextWriter, paths, records_per_file, start_rolling_text,
                           write_rolled_text)
from cascata.sources.tables import read_table, stream_table
from cascata.sources.text import directory_lines

Query = Callable[[SparkSession, str], DataFrame]

N_SHARDS = 3            # tasks for the shuffle / fields / all groupings
SOURCE_COPIES = 2       # replicated source instances
COPIES_TASKS = 4        # tasks fed by the replicated source

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None):
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle.strip()
        return fn
    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def _events(spark, base):
    return read_table(spark, base, "events")


# ---- tokenising and counting ------------------------------------------------

_TOKENS_SQL = r"""
WITH doc_lines AS (
  SELECT doc_id,
         unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     ELSE string_split_regex(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r')
                END) AS line
  FROM documents),
doc_tokens AS (
  SELECT doc_id,
         unnest(CASE WHEN regexp_full_match(line, ',+') THEN []::VARCHAR[]
                     ELSE string_split(regexp_replace(line, ',+$', ''), ',') END) AS word
  FROM doc_lines)
"""


@query("word_count", _TOKENS_SQL + "SELECT word, count(*) AS word_count FROM doc_tokens GROUP BY word")
def word_count(spark, base):
    """P1 + A4: comma tokens of every document line, counted per word (flagship)."""
    docs = read_table(spark, base, "documents")
    return O.word_count(O.tokenize_text(docs, "text"), "word", "word_count")


@query("tokenize", _TOKENS_SQL + "SELECT doc_id, word FROM doc_tokens")
def tokenize(spark, base):
    """P1: one row per comma token of every document line."""
    docs = read_table(spark, base, "documents")
    return O.tokenize_text(docs, "text", keep=["doc_id"])


@query("document_lines", r"""
SELECT doc_id,
       unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                   ELSE string_split_regex(regexp_replace(text, '(\r\n|\n|\r)$', ''), '\r\n|\n|\r')
              END) AS line
FROM documents""")
def document_lines(spark, base):
    """The line source over whole document texts (batch twin of the directory source)."""
    return O.lines(read_table(spark, base, "documents"), "text", keep=["doc_id"])


# ---- sequence numbering -----------------------------------------------------

@query("sequence_number",
       "SELECT event_id, row_number() OVER (ORDER BY event_id) AS num FROM events")
def sequence_number(spark, base):
    """S4: dense 1-based numbers in event order."""
    return O.sequence_number(_events(spark, base).select("event_id"), ["event_id"], "num")


@query("keyed_sequence", """
SELECT (num - 1) % 2 AS flag, num
FROM (SELECT row_number() OVER (ORDER BY event_id) AS num FROM events)""")
def keyed_sequence(spark, base):
    """S5: sequence number and flag = (num - 1) % 2."""
    seq = O.keyed_sequence(_events(spark, base).select("event_id"), ["event_id"], modulus=2)
    return seq.select("flag", "num")


# ---- running and final sums -------------------------------------------------

@query("running_sum", """
SELECT event_id,
       CAST(sum(user_id) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS running_sum
FROM events""")
def running_sum(spark, base):
    """A1: running global sum in event order."""
    ev = _events(spark, base).select("event_id", "user_id")
    return O.running_sum(ev, "user_id", ["event_id"]).select("event_id", "running_sum")


@query("total_sum", "SELECT CAST(coalesce(sum(user_id), 0) AS BIGINT) AS total FROM events")
def total_sum(spark, base):
    """A2: final total of the running sum."""
    return O.total_sum(_events(spark, base), "user_id", "total")


@query("running_count_by_key", """
SELECT event_id, event_type AS word,
       count(*) OVER (PARTITION BY event_type ORDER BY event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS word_count
FROM events""")
def running_count_by_key(spark, base):
    """P2 + A3: per-record changelog of the count per key."""
    words = O.rename(_events(spark, base), "event_type", "word", keep=["event_id"])
    return O.running_count(words, "word", ["event_id"], "word_count").select("event_id", "word", "word_count")


@query("running_sum_by_key", """
SELECT event_id, event_type AS word,
       CAST(sum(user_id) OVER (PARTITION BY event_type ORDER BY event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM events""")
def running_sum_by_key(spark, base):
    """G2 (per-key form): running sum per key."""
    ev = _events(spark, base).select("event_id", F.col("event_type").alias("word"), "user_id")
    return O.running_sum(ev, "user_id", ["event_id"], partition_by=["word"]).select(
        "event_id", "word", "running_sum")


@query("snapshot_per_event", """
SELECT event_id, word, word_count FROM (
  SELECT e.event_id, k.word,
         CAST(sum(CASE WHEN e.event_type IS NOT DISTINCT FROM k.word THEN 1 ELSE 0 END)
              OVER (PARTITION BY k.word ORDER BY e.event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS word_count
  FROM events e CROSS JOIN (SELECT DISTINCT event_type AS word FROM events) k)
WHERE word_count > 0""")
def snapshot_per_event(spark, base):
    """A5: the whole count map after every event."""
    ev = _events(spark, base).select("event_id", "event_type")
    return O.snapshot_per_event(ev, "event_type", ["event_id"], name="word_count", key_name="word")


@query("running_sum_with_outcome", """
SELECT event_id,
       CASE WHEN user_id > 0 AND user_id <= 10 THEN 'ack' ELSE 'fail' END AS outcome,
       CAST(sum(user_id) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS running_sum
FROM events""")
def running_sum_with_outcome(spark, base):
    """A6: running sum over all rows with each row's range outcome."""
    ev = _events(spark, base).select("event_id", "user_id")
    return O.running_sum_with_outcome(ev, "user_id", ["event_id"]).select(
        "event_id", "outcome", "running_sum")


# ---- routing, receipts, dead letters -----------------------------------------

@query("outcome_routing", """
SELECT event_id AS msg_id, user_id AS num,
       CASE WHEN user_id > 0 AND user_id <= 10 THEN 'ack' ELSE 'fail' END AS outcome
FROM events""")
def outcome_routing(spark, base):
    """F1 + T2/T3: a receipt (msg_id, outcome) for every message."""
    ev = _events(spark, base)
    return ev.select(F.col("event_id").alias("msg_id"), F.col("user_id").alias("num"),
                     X.range_outcome("user_id").alias("outcome"))


@query("dead_letter", """
SELECT event_id AS msg_id, user_id AS num, 'fail' AS reason
FROM events WHERE NOT (user_id > 0 AND user_id <= 10) OR user_id IS NULL""")
def dead_letter(spark, base):
    """T4: messages that failed the range check, with a reason."""
    routed = _events(spark, base).select(F.col("event_id").alias("msg_id"), F.col("user_id").alias("num"),
                                         X.range_outcome("user_id").alias("outcome"))
    _, dead = O.split_outcomes(routed)
    return dead


@query("outcome_counts", """
SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'ack' ELSE 'fail' END AS outcome,
       count(*) AS n
FROM lineitem GROUP BY 1""")
def outcome_counts(spark, base):
    """messages per outcome."""
    return O.outcome_counts(read_table(spark, base, "lineitem"), "l_quantity", "n")


# ---- functions by name, long lines ------------------------------------------------

@query("sql_tokenize", _ORACLES["tokenize"])
def sql_tokenize(spark, base):
    """P1 through the SQL surface: table functions called by name, inlined by Catalyst."""
    sql_functions.register(spark)
    read_table(spark, base, "documents").select("doc_id", "text").createOrReplaceTempView("_tokenized_documents")
    return spark.sql("SELECT d.doc_id, t.word FROM _tokenized_documents AS d, LATERAL text_tokens(d.text) AS t")


@query("sql_functions", """
SELECT event_id, CASE WHEN user_id > 0 AND user_id <= 10 THEN 'ack' ELSE 'fail' END AS outcome,
       'add user:' || coalesce(event_type, 'null') AS result,
       CASE WHEN event_type IS NULL THEN 'fail' ELSE 'ack' END AS decoded, event_type AS text FROM events""")
def sql_functions_by_name(spark, base):
    """F1, F2, P3 and P4 as SQL functions."""
    sql_functions.register(spark)
    _events(spark, base).createOrReplaceTempView("_function_events")
    return spark.sql("""SELECT event_id, range_outcome(user_id) AS outcome, add_user(event_type) AS result,
                               decode_outcome(CAST(event_type AS BINARY)) AS decoded,
                               decode_text(CAST(event_type AS BINARY)) AS text FROM _function_events""")


@query("range_tokenize", r"""
WITH t AS (SELECT doc_id, CASE WHEN regexp_full_match(text, ',+') THEN [] ELSE string_split(rtrim(text, ','), ',') END AS w
           FROM documents WHERE text IS NOT NULL)
SELECT doc_id, word, CAST(position AS BIGINT) AS position
FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS position FROM t)""")
def range_tokenize(spark, base):
    """P1 on whole texts as single lines, cut into ranges that are split in parallel."""
    docs = read_table(spark, base, "documents").select("doc_id", "text")
    out = O.range_tokens(docs, "text", ["doc_id"], range_bytes=512, position="position")
    return out.select("doc_id", "word", F.col("position").cast("bigint").alias("position"))


# ---- per-task state -----------------------------------------------------------

@query("sharded_running_sum", f"""
SELECT event_id, CAST(n % {N_SHARDS} AS INTEGER) AS task, user_id AS num,
       CAST(sum(user_id) OVER (PARTITION BY n % {N_SHARDS} ORDER BY event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM (SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) AS n FROM events)""")
def sharded_running_sum(spark, base):
    """G1: shuffle grouping (dense number mod 3), one running sum per task."""
    ev = _events(spark, base).select("event_id", F.col("user_id").alias("num"))
    out = O.shuffled_running_sum(ev, "num", ["event_id"], N_SHARDS)
    return out.select("event_id", "task", "num", "running_sum")


@query("sparse_sharded_running_sum", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(n % {N_SHARDS} AS INTEGER) AS task,
       CAST(sum(l_partkey) OVER (PARTITION BY n % {N_SHARDS} ORDER BY n
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
             row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) AS n
      FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem))""")
def sparse_sharded_running_sum(spark, base):
    """G1 over a sparse order of several columns: the split is even all the same."""
    li = read_table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").distinct()
    out = O.shuffled_running_sum(O.materialize(li), "l_partkey", ["l_orderkey", "l_linenumber", "l_partkey"], N_SHARDS)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "task", "running_sum")


@query("text_key_shard_running_sum", f"""
SELECT event_id, event_type, CAST(t AS INTEGER) AS task,
       CAST(sum(user_id) OVER (PARTITION BY t ORDER BY event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM (SELECT event_id, event_type, user_id,
             CAST(concat('0x', substr(md5(coalesce(event_type, '')), 1, 8)) AS BIGINT) % {N_SHARDS} AS t FROM events)""")
def text_key_shard_running_sum(spark, base):
    """G2 on a text key: tasks by the key's hash, one running sum per task."""
    ev = _events(spark, base).select("event_id", "event_type", "user_id")
    out = O.sharded_running_sum(ev, "user_id", ["event_id"], O.key_task(ev, "event_type", N_SHARDS))
    return out.select("event_id", "event_type", "task", "running_sum")


@query("keyed_shard_running_sum", f"""
SELECT event_id, CAST(((user_id % {N_SHARDS}) + {N_SHARDS}) % {N_SHARDS} AS INTEGER) AS task,
       user_id AS num,
       CAST(sum(user_id) OVER (PARTITION BY ((user_id % {N_SHARDS}) + {N_SHARDS}) % {N_SHARDS}
                               ORDER BY event_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM events""")
def keyed_shard_running_sum(spark, base):
    """G2: fields grouping over 3 tasks (keys sharing a task share its sum)."""
    ev = _events(spark, base).select("event_id", F.col("user_id").alias("num"))
    out = O.sharded_running_sum(ev, "num", ["event_id"], O.shard_task("num", N_SHARDS))
    return out.select("event_id", "task", "num", "running_sum")


@query("replicated_running_sum", f"""
SELECT e.event_id, CAST(t.task AS INTEGER) AS task, e.user_id AS num,
       CAST(sum(e.user_id) OVER (PARTITION BY t.task ORDER BY e.event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM events e CROSS JOIN range({N_SHARDS}) t(task)""")
def replicated_running_sum(spark, base):
    """G3: all grouping, every task sees every row."""
    ev = _events(spark, base).select("event_id", F.col("user_id").alias("num"))
    out = O.replicated_running_sum(ev, "num", ["event_id"], N_SHARDS)
    return out.select("event_id", "task", "num", "running_sum")


@query("replicated_source_sharded_sum", f"""
SELECT event_id, instance, task, num,
       CAST(sum(num) OVER (PARTITION BY task ORDER BY event_id, instance
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM (SELECT e.event_id, CAST(i.instance AS INTEGER) AS instance, e.user_id AS num,
             CAST(((e.n - 1) * {SOURCE_COPIES} + i.instance) % {COPIES_TASKS} AS INTEGER) AS task
      FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS n FROM events) e
      CROSS JOIN range({SOURCE_COPIES}) i(instance))""")
def replicated_source_sharded_sum(spark, base):
    """S6 + G5: two source instances into four tasks."""
    ev = _events(spark, base).select("event_id", F.col("user_id").alias("num"))
    out = O.replicated_source_sharded_sum(ev, "num", "event_id", SOURCE_COPIES, COPIES_TASKS)
    return out.select("event_id", "instance", "task", "num", "running_sum")


@query("replicated_source_two_tasks", f"""
SELECT event_id, instance, task, num,
       CAST(sum(num) OVER (PARTITION BY task ORDER BY event_id, instance
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM (SELECT e.event_id, CAST(i.instance AS INTEGER) AS instance, e.user_id AS num,
             CAST(((e.n - 1) * {SOURCE_COPIES} + i.instance) % {SOURCE_COPIES} AS INTEGER) AS task
      FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS n FROM events) e
      CROSS JOIN range({SOURCE_COPIES}) i(instance))""")
def replicated_source_two_tasks(spark, base):
    """Two source instances into a 2-task sum (one task per instance copy)."""
    ev = _events(spark, base).select("event_id", F.col("user_id").alias("num"))
    out = O.replicated_source_sharded_sum(ev, "num", "event_id", SOURCE_COPIES, SOURCE_COPIES)
    return out.select("event_id", "instance", "task", "num", "running_sum")


@query("flag_shard_running_sum", f"""
SELECT num, flag, CAST(flag % {N_SHARDS} AS INTEGER) AS task,
       CAST(sum(num) OVER (PARTITION BY flag % {N_SHARDS} ORDER BY num
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM (SELECT num, (num - 1) % 2 AS flag
      FROM (SELECT row_number() OVER (ORDER BY event_id) AS num FROM events))""")
def flag_shard_running_sum(spark, base):
    """Keyed sequence (flag, num) routed by ``flag`` to 3 tasks, one sum per task."""
    events = _events(spark, base).select("event_id")
    seq = O.keyed_sequence(events, ["event_id"], modulus=2).select("num", "flag")
    # num is 1..N without gaps: its boundaries are arithmetic, the sum reads the sequence twice and no sample of it
    bounds = O.dense_boundaries(events.count(), min_buckets=max(2, spark.sparkContext.defaultParallelism))
    out = O.running_totals(seq.withColumn("task", O.shard_task("flag", N_SHARDS)), {"running_sum": "num"}, ["num"],
                           ["task"], boundaries=bounds, split_all=True)
    return out.select("num", "flag", "task", "running_sum")


@query("merged_shard_total", f"""
SELECT CAST(coalesce(sum(last_sum), 0) AS BIGINT) AS total FROM (
  SELECT task, arg_max(running_sum, event_id) AS last_sum FROM (
    SELECT event_id, n % {N_SHARDS} AS task,
           sum(user_id) OVER (PARTITION BY n % {N_SHARDS}
                              ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_sum
    FROM (SELECT event_id, user_id, row_number() OVER (ORDER BY event_id) AS n FROM events)) GROUP BY task)""")
def merged_shard_total(spark, base):
    """G6: sum over tasks of each task's last running value."""
    return O.merged_shard_total(sharded_running_sum(spark, base), ["event_id"])


@query("sequence_by_name",
       "SELECT c_custkey, row_number() OVER (ORDER BY c_name, c_custkey) AS num FROM customer")
def sequence_by_name(spark, base):
    """S4 ordered by names with a long common prefix."""
    cust = read_table(spark, base, "customer").select("c_custkey", "c_name")
    return O.sequence_number(cust, ["c_name", "c_custkey"], "num").select("c_custkey", "num")


@query("sequence_by_day_and_id",
       "SELECT event_id, row_number() OVER (ORDER BY CAST(ts AS DATE), event_id DESC) AS num FROM events")
def sequence_by_day_and_id(spark, base):
    """S4 ordered by a first column of few values (the day), then by a second."""
    ev = _events(spark, base).select("event_id", F.to_date("ts").alias("day"), (-F.col("event_id")).alias("late"))
    return O.sequence_number(ev, ["day", "late"], "num").select("event_id", "num")


@query("snapshot_per_event_many_keys", """
SELECT event_id, user_id, n FROM (
  SELECT e.event_id, k.user_id,
         CAST(sum(CASE WHEN e.user_id IS NOT DISTINCT FROM k.user_id THEN 1 ELSE 0 END)
              OVER (PARTITION BY k.user_id ORDER BY e.event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n
  FROM events e CROSS JOIN (SELECT DISTINCT user_id FROM events) k)
WHERE n > 0""")
def snapshot_per_event_many_keys(spark, base):
    """A5 keyed by user: the count map after every event, 150 keys."""
    ev = _events(spark, base).select("event_id", "user_id")
    return O.snapshot_per_event(ev, "user_id", ["event_id"], name="n")


# ---- decoding, requests, rendering, keyed store --------------------------------

def _payloads(spark, base):
    """Message payloads: the document's bytes; every 7th id ends in a malformed byte, every 11th has none."""
    docs = read_table(spark, base, "documents")
    raw = F.encode("text", "UTF-8")
    broken = F.when(F.col("doc_id") % 7 == 0, F.concat(raw, F.lit(b"\xff"))).otherwise(raw)
    return docs.select("doc_id", F.when(F.col("doc_id") % 11 != 0, broken).alias("value"))


@query("decode_bytes", """
SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN text || chr(65533) ELSE text END AS text
FROM documents""")
def decode_bytes(spark, base):
    """S3 (downstream) + P3: bytes to text with U+FFFD for malformed input."""
    return _payloads(spark, base).select("doc_id", X.decode_utf8("value").alias("text"))


@query("decode_outcome", """
SELECT doc_id, CASE WHEN text IS NULL OR doc_id % 11 = 0 THEN 'fail' ELSE 'ack' END AS outcome FROM documents""")
def decode_outcome(spark, base):
    """decoding outcome (a missing payload fails)."""
    return _payloads(spark, base).select("doc_id", X.decode_outcome("value").alias("outcome"))


@query("decode_outcome_strict", """
SELECT doc_id, CASE WHEN text IS NULL OR doc_id % 11 = 0 OR doc_id % 7 = 0 THEN 'fail' ELSE 'ack' END AS outcome
FROM documents""")
def decode_outcome_strict(spark, base):
    """F2, strict: malformed UTF-8 fails too."""
    return _payloads(spark, base).select("doc_id", X.decode_outcome("value", strict=True).alias("outcome"))


def _segment_requests(spark, base):
    """Requests derived from customers: the market segment names the function
    (segment BUILDING calls addUser, every other segment an unknown one)."""
    cust = read_table(spark, base, "customer")
    func = F.when(F.col("c_mktsegment") == F.lit("BUILDING"), F.lit(O.requests.ADD_USER)).otherwise(
        F.col("c_mktsegment"))
    return cust.select(F.col("c_custkey").alias("id"), func.alias("func"), F.col("c_name").alias("args"))


@query("request_dead_letter", """
SELECT c_custkey AS id, c_mktsegment AS func, c_name AS args, 'unknown function' AS reason
FROM customer WHERE c_mktsegment IS DISTINCT FROM 'BUILDING'""")
def request_dead_letter(spark, base):
    """S7 + K4: requests naming an unknown function go to the dead letters."""
    _, dead = O.respond(_segment_requests(spark, base))
    return dead


@query("request_response", """
SELECT c_custkey AS id, 'add user:' || coalesce(c_name, 'null') AS result FROM customer""")
def request_response(spark, base):
    """S7 + P4 + K4: requests answered by the function registry."""
    cust = read_table(spark, base, "customer")
    requests = cust.select(F.col("c_custkey").alias("id"), F.lit(O.requests.ADD_USER).alias("func"),
                           F.col("c_name").alias("args"))
    responses, _ = O.respond(requests)
    return responses


_ORDER_FIELDS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("delimited_record", "SELECT o_orderkey, concat_ws('|', "
       + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in _ORDER_FIELDS)
       + ") AS record FROM orders")
def delimited_record(spark, base):
    """P8 / K3: '|'-delimited record per order, null rendered as text."""
    orders = read_table(spark, base, "orders")
    return orders.select("o_orderkey", X.delimited_columns(orders, list(_ORDER_FIELDS)).alias("record"))


_LINE_FIELDS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
ROLL_AT = 256 * 1024        # smaller than the sink's 5 MB, so that files roll on the small tables too

_ROLLED_SQL = ("WITH r AS (SELECT l_orderkey, l_linenumber, concat_ws('|', "
               + ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'null')" for c in _LINE_FIELDS) + f""") AS record FROM lineitem),
s AS (SELECT strlen(record) + 1 AS size, sum(strlen(record) + 1) OVER (ORDER BY l_orderkey, l_linenumber, record
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM r)
SELECT CAST((upto - size) // {ROLL_AT} AS BIGINT) AS file, count(*) AS records, CAST(sum(size) AS BIGINT) AS bytes
FROM s GROUP BY 1""")


@query("rolled_files", _ROLLED_SQL)
def rolled_files(spark, base):
    """K3: '|'-delimited lineitem records written in order to files that roll by their bytes; the files read back."""
    items = read_table(spark, base, "lineitem")
    records = items.select("l_orderkey", "l_linenumber", X.delimited_columns(items, list(_LINE_FIELDS)).alias("value"))
    folder = f"{scratch_folder(spark, 'rolled')}/files"
    write_rolled_text(records, folder, ["l_orderkey", "l_linenumber", "value"], roll_bytes=ROLL_AT)
    return (spark.read.schema("value string, file bigint").text(folder).groupBy("file")
            .agg(F.count(F.lit(1)).alias("records"), F.sum(F.octet_length("value") + 1).cast("bigint").alias("bytes")))


@query("latest_per_key", """
SELECT key, arg_max(value, seq) AS value FROM (
  SELECT event_type AS key, event_id AS seq,
         CAST(count(*) OVER (PARTITION BY event_type ORDER BY event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS value
  FROM events) GROUP BY key""")
def latest_per_key(spark, base):
    """P5 + K2: last value per key of the running-count changelog."""
    words = O.rename(_events(spark, base), "event_type", "word", keep=["event_id"])
    changelog = O.running_count(words, "word", ["event_id"], "count")
    # reduce on the numeric count (fixed-width buffer: hash aggregation), then
    # render the value as text; the last write per key is the same either way
    latest = O.latest_per_key(changelog.select(F.col("word").alias("key"), F.col("count").alias("value"),
                                               F.col("event_id").alias("seq")))
    return latest.select("key", F.col("value").cast("string").alias("value"))


# ---- the same results computed by streaming jobs ---------------------------------
#
# These let the table arrive in ``SLICES`` parts, in order; after each part the
# Structured Streaming job runs over what is new (``availableNow``, the same
# checkpoint), so totals are carried over micro-batches and restarts.  They
# return what the job wrote.  Their oracle is the batch query's: a stream must
# give the batch result.

STREAMED = ("stream_running_count_by_key", "stream_word_count", "stream_running_sum", "stream_dead_letter",
            "stream_request_response", "stream_latest_per_key", "stream_sharded_running_sum",
            "stream_delimited_record", "stream_directory_lines", "stream_sparse_sharded_running_sum",
            "stream_receipts", "stream_rolled_records", "stream_failing_files")


SLICES = 4


def _in_slices(spark, base, table, order, run) -> str:
    """``run(stream, scratch)`` starts the job; it is run to its end after each slice.  Returns the scratch folder."""
    scratch = scratch_folder(spark, "streamed")
    rows = read_table(spark, base, table)
    cuts = rows.agg(F.percentile_approx(order, [i / SLICES for i in range(1, SLICES)])).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    for lo, hi in zip(edges, edges[1:]):
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (F.col(order) > lo)
        if hi is not None:
            inside = inside & (F.col(order) <= hi)
        rows.where(inside).write.mode("append").parquet(f"{scratch}/slices")
        run(stream_table(spark, f"{scratch}/slices", table, glob="*.parquet"), scratch).awaitTermination()
    return scratch


@query("stream_running_count_by_key", _ORACLES["running_count_by_key"])
def stream_running_count_by_key(spark, base):
    """A3 + T1 as a stream: the running-count changelog carried across micro-batches."""
    def run(events, scratch):
        writer = S.RunningTotalsWriter({"word_count": F.lit(1)}, ["event_id"], f"{scratch}/out", f"{scratch}/state",
                                       partition_by=["word"])
        return S.start_running_totals(events.select("event_id", F.col("event_type").alias("word")), writer,
                                      f"{scratch}/checkpoint", available_now=True)

    scratch = _in_slices(spark, base, "events", "event_id", run)
    return spark.read.parquet(f"{scratch}/out").select("event_id", "word", "word_count")


@query("stream_word_count", _ORACLES["word_count"])
def stream_word_count(spark, base):
    """A4 as a stream: word counts of document lines in complete mode, a new version of the table per micro-batch."""
    def run(docs, scratch):
        def snapshot(df, batch_id):
            df.write.mode("overwrite").parquet(f"{scratch}/out/v={batch_id}")
            paths.prune_versions(spark, f"{scratch}/out", 2)

        return S.start(S.word_count_stream(O.lines(docs, "text")), snapshot, f"{scratch}/checkpoint",
                       output_mode="complete", available_now=True)

    out = f"{_in_slices(spark, base, 'documents', 'doc_id', run)}/out"
    return spark.read.parquet(f"{out}/v={paths.versions(spark, out)[-1]}").select("word", "word_count")


@query("stream_running_sum", _ORACLES["running_sum"])
def stream_running_sum(spark, base):
    """A1 + T1 as a stream: the global running sum carried across micro-batches."""
    def run(events, scratch):
        writer = S.RunningTotalsWriter({"running_sum": "user_id"}, ["event_id"], f"{scratch}/out", f"{scratch}/state")
        return S.start_running_totals(events.select("event_id", "user_id"), writer, f"{scratch}/checkpoint",
                                      available_now=True)

    scratch = _in_slices(spark, base, "events", "event_id", run)
    return spark.read.parquet(f"{scratch}/out").select("event_id", "running_sum")


@query("stream_snapshot_per_event", _ORACLES["snapshot_per_event"])
def stream_snapshot_per_event(spark, base):
    """A5 as a stream: the whole count map after every event, counts carried across micro-batches."""
    def run(events, scratch):
        writer = S.SnapshotWriter("word", ["event_id"], f"{scratch}/out", f"{scratch}/state", name="word_count")
        return S.start_running_totals(events.select("event_id", F.col("event_type").alias("word")), writer,
                                      f"{scratch}/checkpoint", available_now=True)

    scratch = _in_slices(spark, base, "events", "event_id", run)
    return spark.read.parquet(f"{scratch}/out").select("event_id", "word", "word_count")


@query("stream_replicated_source_sharded_sum", _ORACLES["replicated_source_sharded_sum"])
def stream_replicated_source_sharded_sum(spark, base):
    """G5 as a stream: two copies of the source dealt over four tasks, numbers and sums carried in one state."""
    def run(events, scratch):
        writer = S.ShuffledSumWriter("num", ["event_id"], COPIES_TASKS, f"{scratch}/out", f"{scratch}/state",
                                     instances=SOURCE_COPIES)
        rows = events.select("event_id", F.col("user_id").alias("num"))
        return S.start_running_totals(rows, writer, f"{scratch}/checkpoint", available_now=True)

    scratch = _in_slices(spark, base, "events", "event_id", run)
    return spark.read.parquet(f"{scratch}/out").select("event_id", "instance", "task", "num", "running_sum")


@query("stream_dead_letter", _ORACLES["dead_letter"])
def stream_dead_letter(spark, base):
    """T3/T4 as a stream: receipts, acknowledged rows and dead letters per micro-batch."""
    def run(events, scratch):
        router = S.range_router("msg_id", "num", f"{scratch}/receipts", f"{scratch}/ok", f"{scratch}/dead")
        return S.start(events.select(F.col("event_id").alias("msg_id"), F.col("user_id").alias("num")), router,
                       f"{scratch}/checkpoint", available_now=True)

    scratch = _in_slices(spark, base, "events", "event_id", run)
    return spark.read.parquet(f"{scratch}/dead").select("msg_id", "num", "reason")


@query("stream_request_response", _ORACLES["request_response"])
def stream_request_response(spark, base):
    """S7/K4 as a stream: responses per micro-batch, idempotent by batch id."""
    def run(customers, scratch):
        requests = customers.select(F.col("c_custkey").alias("id"), F.lit(O.requests.ADD_USER).alias("func"),
                                    F.col("c_name").alias("args"))
        return S.start(requests, S.ResponseWriter(f"{scratch}/responses", f"{scratch}/dead"), f"{scratch}/checkpoint",
                       available_now=True)

    scratch = _in_slices(spark, base, "customer", "c_custkey", run)
    return spark.read.parquet(f"{scratch}/responses").select("id", "result")


@query("stream_latest_per_key", _ORACLES["latest_per_key"])
def stream_latest_per_key(spark, base):
    """K2: the running-count changelog upserted into the keyed store, batch by batch."""
    def run(events, scratch):
        store = ParquetKeyedStore(f"{scratch}/store", n_buckets=8)

        def upsert(changelog, batch_id):
            store.upsert(changelog.select(F.col("word").alias("key"), F.col("count").cast("string").alias("value"),
                                          F.col("event_id").alias("seq")), batch_id)

        writer = S.RunningTotalsWriter({"count": F.lit(1)}, ["event_id"], upsert, f"{scratch}/state",
                                       partition_by=["word"])
        return S.start_running_totals(events.select("event_id", F.col("event_type").alias("word")), writer,
                                      f"{scratch}/checkpoint", available_now=True)

    scratch = _in_slices(spark, base, "events", "event_id", run)
    return ParquetKeyedStore(f"{scratch}/store").read(spark).select("key", "value")


@query("stream_sharded_running_sum", _ORACLES["sharded_running_sum"])
def stream_sharded_running_sum(spark, base):
    """Shuffle grouping over 3 tasks, each task's sum carried across micro-batches.

    The stream's ids are dense from 0, so its dense number is id + 1.
    """
    def run(events, scratch):
        tasks = events.select("event_id", F.col("user_id").alias("num"),
                              O.shard_task(F.col("event_id") + 1, N_SHARDS).alias("task"))
        writer = S.RunningTotalsWriter({"running_sum": "num"}, ["event_id"], f"{scratch}/out", f"{scratch}/state",
                                       partition_by=["task"])
        return S.start_running_totals(tasks, writer, f"{scratch}/checkpoint", available_now=True)

    scratch = _in_slices(spark, base, "events", "event_id", run)
    return spark.read.parquet(f"{scratch}/out").select("event_id", "task", "num", "running_sum")


@query("stream_delimited_record", _ORACLES["delimited_record"])
def stream_delimited_record(spark, base):
    """K3 as a stream: '|'-delimited order records through the rolling text sink (the 5 MB rule), read back."""
    def run(orders, scratch):
        records = orders.select(X.delimited_columns(orders, list(_ORDER_FIELDS)).alias("value"))
        mean = delimited_record(spark, base).agg(F.avg(F.octet_length("record") + 1)).first()[0] or 1.0
        return start_rolling_text(records, f"{scratch}/files", f"{scratch}/checkpoint",
                                  max_records_per_file=records_per_file(mean), available_now=True)

    scratch = _in_slices(spark, base, "orders", "o_orderkey", run)
    text = spark.read.text(f"{scratch}/files")
    return text.select(F.split("value", r"\|", 2).getItem(0).cast("bigint").alias("o_orderkey"),
                       F.col("value").alias("record"))


@query("stream_directory_lines", _ORACLES["document_lines"].replace("SELECT doc_id,", "SELECT").replace(
    "FROM documents", "FROM documents WHERE text IS NOT NULL"))
def stream_directory_lines(spark, base):
    """S1 + S2 + F3: documents written as .txt files among decoys, streamed twice on one checkpoint."""
    scratch = scratch_folder(spark, "directory")
    docs = read_table(spark, base, "documents").where(F.col("text").isNotNull())
    docs.select("text").write.option("lineSep", "\n").text(f"{scratch}/in/texts")          # part-*.txt
    decoys = docs.select(F.lit("decoy").alias("value")).limit(3)
    for name in ("a.TXT", "b.txt123"):
        decoys.write.text(f"{scratch}/in/{name}")
    paths.rename_parts(spark, f"{scratch}/in/a.TXT", ".TXT")
    paths.rename_parts(spark, f"{scratch}/in/b.txt123", ".txt123")

    def keep(df, batch_id):
        df.write.mode("overwrite").parquet(f"{scratch}/out/batch_id={batch_id}")

    for _ in range(2):      # the second run finds nothing new
        lines = directory_lines(spark, f"{scratch}/in")
        S.start(lines, keep, f"{scratch}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{scratch}/out").select("line")


@query("dead_letter_replay", """
SELECT event_id AS msg_id, user_id AS num FROM events WHERE user_id > 10 AND user_id <= 20""")
def dead_letter_replay(spark, base):
    """T4: dead letters replayed under a wider range; the messages that this resolves, with their numbers."""
    scratch = scratch_folder(spark, "replay")
    router = S.range_router("msg_id", "num", f"{scratch}/receipts", f"{scratch}/ok", f"{scratch}/dead")
    router(_events(spark, base).select(F.col("event_id").alias("msg_id"), F.col("user_id").alias("num")), 0)

    def wider(df):
        return F.when((F.col("num") > 0) & (F.col("num") <= 20), F.lit("ack")).otherwise(F.lit("fail"))

    for replay_id in (0, 1):        # the second replay finds nothing left that it could resolve
        S.replay_dead_letters(spark, f"{scratch}/dead", f"{scratch}/resolved", ["msg_id"], wider, f"{scratch}/replayed",
                              replay_id)
    return spark.read.parquet(f"{scratch}/replayed").select("msg_id", "num")


@query("stream_sparse_sharded_running_sum", f"""
SELECT event_id, num, CAST(n % {N_SHARDS} AS INTEGER) AS task,
       CAST(sum(num) OVER (PARTITION BY n % {N_SHARDS} ORDER BY n
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_sum
FROM (SELECT event_id, user_id AS num, row_number() OVER (ORDER BY event_id) AS n FROM events WHERE user_id % 7 <> 0)""")
def stream_sparse_sharded_running_sum(spark, base):
    """G1 as a stream over ids with gaps: dense number, then the sum per task, both carried in one state."""
    def run(events, scratch):
        writer = S.ShuffledSumWriter("num", ["event_id"], N_SHARDS, f"{scratch}/out", f"{scratch}/state")
        rows = events.where(F.col("user_id") % 7 != 0).select("event_id", F.col("user_id").alias("num"))
        return S.start_running_totals(rows, writer, f"{scratch}/checkpoint", available_now=True)

    scratch = _in_slices(spark, base, "events", "event_id", run)
    return spark.read.parquet(f"{scratch}/out").select("event_id", "num", "task", "running_sum")


@query("stream_receipts", """
SELECT msg_id, outcome, CAST(count(*) OVER (PARTITION BY outcome) AS BIGINT) AS n FROM (
  SELECT event_id AS msg_id, CASE WHEN user_id > 0 AND user_id <= 10 THEN 'ack' ELSE 'fail' END AS outcome FROM events)""")
def stream_receipts(spark, base):
    """T2/T3 + T5: receipts of committed batches, with the messages per outcome as the commits observed them."""
    def run(events, scratch):
        router = S.range_router("msg_id", "num", f"{scratch}/receipts", f"{scratch}/ok", f"{scratch}/dead",
                                commits=f"{scratch}/commits")
        return S.start(events.select(F.col("event_id").alias("msg_id"), F.col("user_id").alias("num")), router,
                       f"{scratch}/checkpoint", available_now=True)

    scratch = _in_slices(spark, base, "events", "event_id", run)
    commits = S.BatchCommits(f"{scratch}/commits")
    seen = [commits.counts(spark, b) for b in commits.numbers(spark)]
    n = F.when(F.col("outcome") == "ack", sum(c["ack"] for c in seen)).otherwise(sum(c["fail"] for c in seen))
    return commits.committed(spark, f"{scratch}/receipts").select("msg_id", "outcome", n.cast("bigint").alias("n"))


@query("dead_letter_attempts", """
SELECT event_id AS msg_id, CASE WHEN user_id <= 20 THEN 'resolved' ELSE 'open' END AS state,
       CAST(CASE WHEN user_id <= 15 THEN 2 ELSE 3 END AS INTEGER) AS attempts
FROM events WHERE NOT (user_id > 0 AND user_id <= 10) AND user_id > 0""")
def dead_letter_attempts(spark, base):
    """T4: dead letters replayed twice under wider ranges, with the times that each was tried."""
    scratch = scratch_folder(spark, "attempts")
    router = S.range_router("msg_id", "num", f"{scratch}/receipts", f"{scratch}/ok", f"{scratch}/dead",
                            commits=f"{scratch}/commits")
    messages = _events(spark, base).where("user_id > 0").select(F.col("event_id").alias("msg_id"), F.col("user_id").alias("num"))
    book = S.DeadLetterBook(f"{scratch}/book", f"{scratch}/dead", f"{scratch}/commits")
    router(messages, 0)
    for replay_id, top in ((0, 15), (1, 20)):
        book.replay(spark, replay_id, lambda df, top=top: F.when(F.col("num").between(1, top), "ack").otherwise("fail"),
                    f"{scratch}/replayed")
    done = spark.read.parquet(f"{scratch}/replayed").select("msg_id", F.lit("resolved").alias("state"), "attempts")
    return done.unionByName(book.letters(spark).select("msg_id", F.lit("open").alias("state"), "attempts"))


@query("stream_rolled_records", _ORACLES["delimited_record"])
def stream_rolled_records(spark, base):
    """K3 as a stream: order records into files that roll by their bytes, a new file per micro-batch, read back."""
    def run(orders, scratch):
        writer = RollingTextWriter(
            f"{scratch}/files", ["o_orderkey", "value"], roll_bytes=ROLL_AT,
            render=lambda df: df.select("o_orderkey", X.delimited_columns(df, list(_ORDER_FIELDS)).alias("value")))
        return S.start(orders, writer, f"{scratch}/checkpoint", available_now=True)

    scratch = _in_slices(spark, base, "orders", "o_orderkey", run)
    text = spark.read.text(f"{scratch}/files")
    return text.select(F.split("value", r"\|", 2).getItem(0).cast("bigint").alias("o_orderkey"),
                       F.col("value").alias("record"))


# Bytes of text in one of the files of stream_failing_files, about; there are four files at least.
TEXT_FILE_BYTES = 64 << 20


@query("stream_failing_files", _ORACLES["stream_directory_lines"])
def stream_failing_files(spark, base):
    """S2's failure path: one text file cannot be read at first; the stream goes on and reads it once it is mended."""
    scratch = scratch_folder(spark, "failing")
    docs = read_table(spark, base, "documents").where(F.col("text").isNotNull())
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    files = max(4, -(-size // TEXT_FILE_BYTES))     # a task writes, or reads, one file's texts
    docs.select("text").repartition(files).write.option("lineSep", "\n").text(f"{scratch}/in/texts")
    texts = f"{scratch}/in/texts"
    bad = sorted(n for n in paths.children(spark, texts) if n.startswith("part-"))[0]
    paths.spoil(spark, f"{texts}/{bad}")
    ledger = S.FileLedger(f"{scratch}/ledger", f"{scratch}/out", f"{scratch}/staged")
    S.start_ledgered_lines(spark, f"{scratch}/in", ledger, f"{scratch}/checkpoint", available_now=True).awaitTermination()
    ledger.retry(spark)         # still as bad
    paths.mend(spark, f"{texts}/{bad}")
    ledger.retry(spark)
    ledger.retry(spark)         # nothing is left to be tried
    return spark.read.parquet(f"{scratch}/out").select("line")
