"""Running totals that never collapse to one task.

A running value ("sum so far, in arrival order") is the frame
``ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW``.  Written naively as a
Spark window it is partitioned by the grouping key only, so a global running
sum runs in a single task and a key that holds a third of the rows runs in one
task holding a third of the data.

``running_totals`` splits every group by *range buckets of the order key*:

1. bucket boundaries, collected once as literals, so bucket assignment is
   deterministic when a lost task is recomputed: ``percentile_approx`` where
   one number, date or timestamp is the whole order, else order tuples of a
   sorted sample (``ranges``), so that a first column with few values and long
   common prefixes are split by what follows;
2. local running value: window over ``(group..., bucket)`` ordered by the
   order columns — every window partition holds at most ~N/B rows whatever
   the key skew.  Only groups that a sample shows to hold half a bucket or
   more are cut into buckets; smaller ones are one window partition, and with
   none to cut the plan is the plain keyed window;
3. bucket totals: ``groupBy(group..., bucket).sum`` (partial aggregation
   before the shuffle), then an *exclusive* running sum over buckets per
   group.  This table has (#groups x B) rows;
4. join the offsets back on ``(group..., bucket)`` and add.

Cost: a count and a sampled sketch for the boundaries, one hash shuffle of
the rows for the window, a narrow re-read combined map-side for the bucket
totals, and a shuffle or broadcast of the (#groups x B)-row offsets table.

The order columns must give a total order inside each group (ties would make
any running value, including the plain window's, arbitrary).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cascata.operators.lineage import materialize as materialize_frame
from cascata.operators.ranges import tuple_boundaries, with_tuple_bucket

BUCKET = "_bucket"
GROUP = "_group"
HOT = "_hot"
# Rows per (group, bucket) window partition we aim for on a cluster.  Bucket
# count is ceil(rows / ROWS_PER_BUCKET), but never below the cluster's default
# parallelism so small inputs still use every core.
ROWS_PER_BUCKET = 4_000_000
# Sampled keys per bucket when sketching boundaries (enough for ~+-25% balance).
SAMPLES_PER_BUCKET = 64
# Partial quantile sketches merged by the final aggregate at most.
SKETCH_FAN_IN = 64
# Above this many buckets the quantiles are computed in two levels.
SINGLE_LEVEL_BUCKETS = 2048
# Largest ungrouped offsets table (one row per bucket, ~24 bytes) broadcast explicitly.
BROADCAST_MAX_BUCKETS = 1_000_000


def _order_value(df: DataFrame, column: str) -> Column:
    """Numeric image of the first order column (monotone, never null)."""
    dtype = dict(df.dtypes)[column]
    c = F.col(column)
    if dtype.startswith("timestamp"):
        c = F.unix_micros(c.cast("timestamp"))
    elif dtype == "date":
        c = F.unix_date(c)
    elif dtype in ("string", "binary"):
        # strings compare by UTF-8 bytes, binaries by bytes: the first 6 bytes
        # as a 48-bit number are monotone in that order and exact as a double
        raw = F.encode(c, "UTF-8") if dtype == "string" else c
        c = F.conv(F.rpad(F.hex(F.substring(raw, 1, 6)), 12, "0"), 16, 10)
    elif not (dtype in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double")
              or dtype.startswith("decimal")):
        raise ValueError(f"order column {column!r} of type {dtype} cannot be range-bucketed; "
                         "order by a number, date, timestamp, string or binary column")
    # nulls sort first in an ascending window: put them in the first bucket
    return F.coalesce(c.cast("double"), F.lit(float("-inf")))


def _grid(buckets: int) -> list[float]:
    return [i / buckets for i in range(1, buckets)]


def _clean(values) -> list[float]:
    return sorted({float(x) for x in (values or []) if x is not None and not math.isinf(float(x))})


def bucket_boundaries(df: DataFrame, order_col: str, rows_per_bucket: int = ROWS_PER_BUCKET,
                      min_buckets: int | None = None, samples_per_bucket: int = SAMPLES_PER_BUCKET,
                      seed: int = 7, bounded_input: bool = False, rows: int | None = None) -> list[float]:
    """Approximate equi-depth boundaries of ``order_col`` (sorted, distinct).

    Pass 1 counts the rows, which fixes ``B = max(min_buckets,
    ceil(rows / rows_per_bucket))``.  Pass 2 sketches the quantiles of at
    most ``samples_per_bucket * B`` keys (a sample when the input is larger),
    moved to at most ``SKETCH_FAN_IN`` (and at most the cluster's default
    parallelism) tasks first: the final aggregate merges partial sketches one
    at a time, so this bounds both the fan-in and the sketch size however
    many splits the input has.  Above ``SINGLE_LEVEL_BUCKETS`` buckets the
    quantiles come in two levels (about sqrt(B) coarse ranges, then about
    sqrt(B) quantiles inside each range, grouped by range), so no plan holds a
    literal list of B probabilities.  Boundaries only have to balance the
    buckets roughly; results never depend on them.

    ``bounded_input=True`` is for input that is cheap to read and has few
    partitions (a persisted micro-batch): the count and a ``min_buckets``
    grid then come from one aggregate, and the sampled pass runs only when
    the data needs more buckets than that.
    """
    spark = df.sparkSession
    if min_buckets is None:
        min_buckets = max(2, spark.sparkContext.defaultParallelism)
    key = df.select(_order_value(df, order_col).alias("_k"))
    first = None
    if bounded_input and min_buckets > 1:
        row = key.agg(F.count(F.lit(1)).alias("n"),
                      F.percentile_approx("_k", _grid(min_buckets), max(10_000, 4 * min_buckets)).alias("q")).first()
        n, first = row["n"], row["q"]
    else:
        n = key.count() if rows is None else rows
    if n == 0:
        return []
    buckets = max(1, min(n, max(min_buckets, math.ceil(n / rows_per_bucket))))
    if buckets == 1:
        return []
    if first is not None and buckets <= min_buckets:
        return _clean(first)
    fraction = samples_per_bucket * buckets / n
    if fraction < 1.0:
        key = key.sample(withReplacement=False, fraction=fraction, seed=seed)
    fan_in = max(1, min(SKETCH_FAN_IN, spark.sparkContext.defaultParallelism))
    sample = key.repartition(fan_in)
    if buckets <= SINGLE_LEVEL_BUCKETS:
        q = sample.agg(F.percentile_approx("_k", _grid(buckets), max(10_000, 4 * buckets)).alias("q")).first()["q"]
        return _clean(q)

    coarse = math.ceil(math.sqrt(buckets))
    fine = math.ceil(buckets / coarse)
    sample = sample.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        top = _clean(sample.agg(F.percentile_approx("_k", _grid(coarse), max(10_000, 4 * coarse)).alias("q"))
                     .first()["q"])
        inner = (with_bucket(sample, "_k", top).groupBy(BUCKET)
                 .agg(F.percentile_approx("_k", _grid(fine), max(10_000, 4 * fine)).alias("q")).collect())
    finally:
        sample.unpersist()
    return _clean([*top, *(x for row in inner for x in (row["q"] or []))])


def with_bucket(df: DataFrame, order_col: str, boundaries: Sequence[float]) -> DataFrame:
    """Add the integer range-bucket column ``_bucket`` (binary search, JVM side)."""
    if not boundaries:
        return df.withColumn(BUCKET, F.lit(0))
    tmp = "_bucket_key"
    # NaN sorts after every number in Spark: "keep" puts it in one extra last bucket
    bucketizer = Bucketizer(splits=[float("-inf"), *boundaries, float("inf")],
                            inputCol=tmp, outputCol=BUCKET, handleInvalid="keep")
    keyed = df.withColumn(tmp, _order_value(df, order_col))
    # non-nullable, so joins on it infer no extra filter that re-runs the search
    bucket = F.coalesce(F.col(BUCKET).cast("int"), F.lit(0))
    return bucketizer.transform(keyed).withColumn(BUCKET, bucket).drop(tmp)


def dense_boundaries(n: int, rows_per_bucket: int = ROWS_PER_BUCKET, min_buckets: int = 2) -> list[float]:
    """Boundaries of the dense numbers 1..n: arithmetic, nothing is read."""
    buckets = max(1, min(n, max(min_buckets, math.ceil(n / rows_per_bucket))))
    return sorted({float(i * n // buckets + 1) for i in range(1, buckets)})


def order_boundaries(df: DataFrame, order_by: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET,
                     min_buckets: int | None = None, rows: int | None = None) -> list:
    """Boundaries over the whole order: numbers for a single numeric order column, else order tuples.

    ``rows`` is the number of rows where it is known already.
    """
    dtype = dict(df.dtypes)[order_by[0]]
    if len(order_by) == 1 and dtype not in ("string", "binary"):
        return bucket_boundaries(df, order_by[0], rows_per_bucket, min_buckets, rows=rows)
    if min_buckets is None:
        min_buckets = max(2, df.sparkSession.sparkContext.defaultParallelism)
    n = df.count() if rows is None else rows
    return tuple_boundaries(df, order_by, max(1, min(n, max(min_buckets, math.ceil(n / rows_per_bucket)))))


def with_order_bucket(df: DataFrame, order_by: Sequence[str], boundaries: Sequence) -> DataFrame:
    """Adds ``_bucket`` for boundaries from ``order_boundaries`` or ``bucket_boundaries``."""
    if boundaries and isinstance(boundaries[0], tuple):
        return with_tuple_bucket(df, order_by, boundaries, BUCKET)
    return with_bucket(df, order_by[0], boundaries)


def _zero(dtype: T.DataType) -> Column | None:
    """A non-null stand-in value of ``dtype`` (None for complex types)."""
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        zero = F.lit(0) if isinstance(dtype, T.NumericType) else F.lit("1970-01-01")
        return zero.cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.lit(bytearray())
    return None


def group_keys(df: DataFrame, partition_by: Sequence[str], schema: T.StructType | None = None
               ) -> tuple[dict[str, Column], dict[str, Column]]:
    """Null-safe key columns for ``partition_by`` and how to rebuild the originals.

    Joins need plain equality to reuse a hash partitioning, and plain
    equality drops null keys.  A non-nullable column is its own key; a
    nullable one becomes ``(coalesce(c, zero), isnull(c))``; a complex type
    is wrapped in a struct (never null, equal when fields are equal).
    ``schema`` (default: ``df``'s) decides the form, so a second frame can
    be keyed exactly like the first.
    """
    keys: dict[str, Column] = {}
    restore: dict[str, Column] = {}
    schema = schema or df.schema
    for c in partition_by:
        field = schema[c]
        if not field.nullable:
            keys[c] = F.col(c)
            continue
        zero = _zero(field.dataType)
        if zero is None:
            keys[f"_ks_{c}"] = F.struct(F.col(c).alias("v"))
            restore[c] = F.col(f"_ks_{c}").getField("v")
        else:
            keys[f"_kc_{c}"] = F.coalesce(F.col(c), zero)
            keys[f"_kn_{c}"] = F.col(c).isNull()
            restore[c] = (F.when(F.col(f"_kn_{c}"), F.lit(None).cast(field.dataType))
                          .otherwise(F.col(f"_kc_{c}")))
    return keys, restore


def hot_groups(df: DataFrame, keys: Mapping[str, Column], buckets: int, n: int,
               samples_per_bucket: int = SAMPLES_PER_BUCKET, seed: int = 11) -> list[int]:
    """Hashes of the groups that hold half a bucket of the ``n`` rows or more, as far as a sample tells.

    At most ``2 * buckets`` values come back.  A group missed or named by mistake is only computed the other way,
    with the same result.
    """
    if n == 0 or buckets <= 1:
        return []
    rows = df.select(F.xxhash64(*keys.values()).alias("_h"))
    share = samples_per_bucket * buckets / n
    if share < 1.0:
        rows = rows.sample(withReplacement=False, fraction=share, seed=seed)
    least = min(share, 1.0) * n / buckets / 2
    found = rows.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    return sorted(r["_h"] for r in found.limit(4 * buckets).collect())


def running_totals(df: DataFrame, sums: Mapping[str, Column | str], order_by: Sequence[str],
                   partition_by: Sequence[str] = (), *, initial: DataFrame | None = None,
                   boundaries: Sequence | None = None,
                   rows_per_bucket: int = ROWS_PER_BUCKET, min_buckets: int | None = None,
                   materialize: bool = False, split_all: bool = False) -> DataFrame:
    """Add one running-sum column per entry of ``sums``.

    ``sums`` maps output name -> addend (column or column name); a null addend
    counts as 0, so ``{"n": F.lit(1)}`` is a 1-based running count.
    ``initial`` (optional) holds carried offsets per group — columns
    ``partition_by`` + the output names — as left by earlier micro-batches.

    ``split_all`` says that every group is large (tasks, not keys), so that no
    sample of the groups is taken.

    The input is read four times (count, boundary sample, window, totals); with
    groups, a sample of their keys tells whether any is large enough to be cut,
    and if none is (always, where all rows fit one bucket) it is read twice:
    count and window; pass ``materialize=True`` when it is expensive to recompute (joins,
    aggregations, another running total) to write it once to the checkpoint
    folder and read that instead.

    Plan: the rows are hash-shuffled once on ``(group keys, bucket)`` for the
    window; the bucket totals come from a narrow second read aggregated
    map-side; the join back on the same keys keeps the rows where the window
    left them (only the small offsets table moves).  Group keys are made
    null-safe by ``group_keys`` so that the join can use plain equality.
    """
    order_by = list(order_by)
    partition_by = list(partition_by)
    names = list(sums)
    if materialize:
        df = materialize_frame(df)
    addends = {f"_v_{n}": F.coalesce(F.col(e) if isinstance(e, str) else e, F.lit(0))
               for n, e in sums.items()}
    gkeys, restore = group_keys(df, partition_by)
    hot = None          # which groups are cut: None means all, of whatever size
    if partition_by and not split_all:
        # first, as mostly there are none: then no boundaries are sought, and a group is one window partition.  A group
        # is small when it fits one bucket, whatever the number of cores, as there are other groups for those
        n = df.count()
        hot = hot_groups(df, gkeys, min(n, max(min_buckets or 1, math.ceil(n / rows_per_bucket))), n)
        if hot != [] and boundaries is None:
            boundaries = order_boundaries(df, order_by, rows_per_bucket, min_buckets, rows=n)
    elif boundaries is None:
        boundaries = order_boundaries(df, order_by, rows_per_bucket, min_buckets)
    if not gkeys:
        gkeys = {GROUP: F.lit(0)}
    group = list(gkeys)
    base = df.withColumns(addends).withColumns(gkeys)
    if hot != []:
        base = with_order_bucket(base, order_by, boundaries)
    if hot:
        # groups of less than half a bucket stay whole: one window partition each, no offsets
        base = base.withColumn(HOT, F.xxhash64(*group).isin(hot))
        base = base.withColumn(BUCKET, F.when(F.col(HOT), F.col(BUCKET)).otherwise(F.lit(0)))
    base = base.drop(*restore)          # rebuilt from the key columns after the join
    keys = group if hot == [] else [*group, BUCKET]

    frame = (Window.partitionBy(*keys).orderBy(*order_by)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = base.withColumns({n: F.sum(f"_v_{n}").over(frame) for n in names})
    columns = [*(c for c in df.columns if c not in names), *names]
    carried = None
    if initial is not None and partition_by:
        ikeys, _ = group_keys(initial, partition_by, df.schema)
        carried = initial.select(*(e.alias(k) for k, e in ikeys.items()), *(F.col(n).alias(f"_c_{n}") for n in names))
    if hot == []:
        if carried is not None:
            local = local.join(carried, group, "left").withColumns(
                {n: F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)) for n in names})
        return local.withColumns(restore).select(*columns)

    # narrow second read: only keys, bucket and addends, combined map-side
    totals = (base.where(HOT) if hot else base).groupBy(*keys).agg(*(F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names))
    earlier = (Window.partitionBy(*group).orderBy(BUCKET)
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, *(F.coalesce(F.sum(f"_t_{n}").over(earlier),
                                                F.lit(0)).alias(f"_o_{n}") for n in names))
    if initial is not None:
        if carried is not None:
            offsets = offsets.join(carried, group, "left")
        else:
            # a single carried row: read it as literals instead of joining
            row = initial.select(*names).first()
            offsets = offsets.withColumns({f"_c_{n}": F.lit(row[n] if row else 0) for n in names})
        offsets = offsets.withColumns({f"_o_{n}": F.col(f"_o_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0))
                                       for n in names}).drop(*(f"_c_{n}" for n in names))
        if hot:
            # the other groups have what was carried, and no buckets
            whole = carried.where(~F.xxhash64(*group).isin(hot))
            offsets = offsets.unionByName(whole.select(*group, F.lit(0).alias(BUCKET),
                                                       *(F.col(f"_c_{n}").alias(f"_o_{n}") for n in names)))
    if not partition_by and len(boundaries) + 1 <= BROADCAST_MAX_BUCKETS:
        # one row per bucket: the size is known before the join and checked here;
        # beyond the limit Spark (AQE) decides from the measured size
        offsets = F.broadcast(offsets)

    out = local.join(offsets, keys, "left" if hot else "inner")
    out = out.withColumns({n: F.col(n) + F.coalesce(F.col(f"_o_{n}"), F.lit(0)) for n in names}).withColumns(restore)
    return out.select(*columns)
