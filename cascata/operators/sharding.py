"""State kept per task: the grouping decides the answer.

A stream processor that keeps one accumulator per task gives one running sum
per task.  Tasks are made explicit and deterministic here as a ``task``
column; physical placement is left to Spark.

* shuffle grouping  — ``task = pmod(num, n)`` of the dense sequence number: an
  even split over n tasks whatever the order column holds
* fields grouping   — ``task = pmod(key, n)`` of an integer key, or of a hash
  of any other: equal keys share a task and keys on one task share its sum
* all grouping      — every task sees every row: n identical running sums
* replicated source — the input appears once per source instance and the
  interleaved copies are spread over n tasks
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.operators.prefix import ROWS_PER_BUCKET, dense_boundaries, running_totals
from cascata.operators.sequence import replicate, sequence_number

NUM = "_num"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shard_task(value: Column | str, n_tasks: int) -> Column:
    """Deterministic task index in ``0..n_tasks-1`` (non-negative modulo)."""
    return F.pmod(_col(value), F.lit(n_tasks)).cast("int")


def key_task(df: DataFrame, key: str, n_tasks: int) -> Column:
    """Task index of a key of any type: integers by modulo, others by the first 8 hex digits of their text's md5.

    A null key is the empty text, or 0.
    """
    if dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint"):
        return shard_task(F.coalesce(F.col(key), F.lit(0)), n_tasks)
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return shard_task(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint"), n_tasks)


def shuffled_running_sum(df: DataFrame, value: str, order_by: Sequence[str], n_tasks: int,
                         name: str = "running_sum", task_name: str = "task", **kw) -> DataFrame:
    """Shuffle grouping: rows dealt evenly in order over ``n_tasks``, one running sum per task.

    The dense numbers give the second pass its range boundaries by arithmetic; it reads no sample.
    """
    numbered, bounds = _numbered(df, order_by, **kw)
    with_task = numbered.withColumn(task_name, shard_task(NUM, n_tasks))
    out = running_totals(with_task, {name: value}, [NUM], [task_name], boundaries=bounds, split_all=True)
    return out.drop(NUM)


def _numbered(df: DataFrame, order_by: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET,
              min_buckets: int | None = None) -> tuple[DataFrame, list[float]]:
    """(df with the dense number ``NUM``, boundaries of those numbers)."""
    if min_buckets is None:
        min_buckets = max(2, df.sparkSession.sparkContext.defaultParallelism)
    numbered = sequence_number(df, order_by, NUM, rows_per_bucket=rows_per_bucket, min_buckets=min_buckets)
    return numbered, dense_boundaries(df.count(), rows_per_bucket, min_buckets)


def sharded_running_sum(df: DataFrame, value: str, order_by: Sequence[str], task: Column,
                        name: str = "running_sum", task_name: str = "task", **kw) -> DataFrame:
    """One running sum per task (``task`` is any deterministic expression)."""
    with_task = df.withColumn(task_name, task)
    return running_totals(with_task, {name: value}, order_by, [task_name], split_all=True, **kw)


def replicated_running_sum(df: DataFrame, value: str, order_by: Sequence[str], n_tasks: int,
                           name: str = "running_sum", task_name: str = "task", **kw) -> DataFrame:
    """All grouping: each of ``n_tasks`` tasks sees every row.

    All replicas hold the same sum, so it is computed once and the rows are
    replicated afterwards (n-fold less shuffle and sort than replicating first).
    """
    summed = running_totals(df, {name: value}, order_by, **kw)
    out = replicate(summed, n_tasks, task_name)
    return out.select(*df.columns, task_name, name)


def replicated_source_sharded_sum(df: DataFrame, value: str, order_by: Sequence[str] | str, instances: int,
                                  n_tasks: int, name: str = "running_sum",
                                  instance_name: str = "instance", task_name: str = "task",
                                  **kw) -> DataFrame:
    """A source run ``instances`` times feeding an even split over ``n_tasks``.

    Copies arrive interleaved: row number ``num`` (from 0, dense in the order)
    of copy ``instance`` has position ``instances * num + instance``, and
    position ``p`` goes to task ``p mod n_tasks``; each task keeps its own sum.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    numbered, bounds = _numbered(df, order_by, **kw)
    copies = replicate(numbered, instances, instance_name)
    position = (F.col(NUM) - 1) * F.lit(instances) + F.col(instance_name)
    with_task = copies.withColumn(task_name, shard_task(position, n_tasks))
    return running_totals(with_task, {name: value}, [NUM, instance_name], [task_name], boundaries=bounds,
                          split_all=True).drop(NUM)


def merged_shard_total(sums: DataFrame, order_by: Sequence[str], task: str = "task", running: str = "running_sum",
                       name: str = "total") -> DataFrame:
    """Sum over tasks of each task's last running value; ``sums`` is a sharded running sum.

    The last value per task is taken by ``max_by``, combined before the shuffle.
    """
    last = sums.groupBy(task).agg(F.max_by(running, order_by[0] if len(order_by) == 1 else F.struct(*order_by)).alias("_last"))
    return last.agg(F.coalesce(F.sum("_last"), F.lit(0)).cast("bigint").alias(name))
