"""Range buckets over a whole order tuple.

A row's order key is read as a sequence of *digits*, numbers that compare like
the key: a date or an int is one digit, a long two (its double image and what
the image lost), a string one digit per six bytes and then, where that is not
enough, how it compares with a boundary's full string.  Boundaries are order
tuples taken from a sorted sample, so a first column with few values, or long
common prefixes, are split by what follows.

A row's bucket is the number of boundaries at or below it.  It is found digit
by digit: ``state`` says where the digits so far lie among the boundaries'
(equal to one's, or in the gap between two), the next digit is placed among the
boundaries' digits the same way, and the pair is placed among the boundaries'
pairs.  Each placing is a JVM binary search (``Bucketizer``) over at most
2B + 2 splits, and only as many digits are used as tell the boundaries apart.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 6           # bytes per digit of a string: 48 bits are exact as a double
MAX_CHUNKS = 64     # beyond 384 common bytes the full comparison decides
SAMPLES_PER_BUCKET = 32


def _is_text(dtype: str) -> bool:
    return dtype in ("string", "binary")


def _chunk(raw: Column, i: int) -> Column:
    return F.conv(F.rpad(F.hex(F.substring(raw, 1 + CHUNK * i, CHUNK)), 2 * CHUNK, "0"), 16, 10).cast("double")


def _digits(column: str, dtype: str, chunks: int) -> tuple[list[Column], bool]:
    """(digits, exact): exact if equal digits mean equal values, so that a further column may decide."""
    c = F.col(f"`{column}`")
    low = F.lit(-1.7976931348623157e308)        # nulls come first
    if _is_text(dtype):
        raw = F.encode(c, "UTF-8") if dtype == "string" else c
        return [F.when(c.isNull(), F.lit(-1.0)).otherwise(_chunk(raw, i)) for i in range(chunks)], False
    if dtype.startswith("timestamp"):
        c = F.unix_micros(c.cast("timestamp"))
        dtype = "bigint"
    if dtype == "bigint":
        image = c.cast("double")
        lost = (c.cast("decimal(20,0)") - image.cast("decimal(20,0)")).cast("double")
        return [F.coalesce(image, low), F.coalesce(lost, F.lit(0.0))], True
    if dtype == "date":
        return [F.coalesce(F.unix_date(c).cast("double"), low)], True
    if dtype in ("boolean", "tinyint", "smallint", "int"):
        return [F.coalesce(c.cast("int").cast("double"), low)], True
    if dtype in ("float", "double") or dtype.startswith("decimal"):
        image = c.cast("double")
        return [F.when(image.isNull(), low).when(F.isnan(image), -low)
                .otherwise(F.greatest(low, F.least(-low, image)))], False
    raise ValueError(f"order column {column!r} of type {dtype} cannot be range-bucketed; "
                     "order by a number, date, timestamp, string or binary column")


def tuple_boundaries(df: DataFrame, order_by: Sequence[str], buckets: int, seed: int = 7) -> list[tuple]:
    """About equi-depth boundaries: at most ``buckets - 1`` distinct order tuples of a sorted sample.

    The sample has ``SAMPLES_PER_BUCKET`` rows per bucket, so sorting it and keeping every n-th row stays small
    however large the input is; only the boundaries come to the driver.
    """
    keys = df.select(*order_by)
    n = keys.count()
    if n == 0 or buckets <= 1:
        return []
    share = SAMPLES_PER_BUCKET * buckets / n
    if share < 1.0:
        keys = keys.sample(withReplacement=False, fraction=share, seed=seed)
    numbered = keys.withColumn("_rn", F.row_number().over(Window.orderBy(*order_by)))
    numbered = numbered.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy()))
    # the row that opens bucket i, for i = 1 .. buckets - 1
    cut = F.floor((F.col("_rn") - 1) * buckets / F.col("_n"))
    before = F.floor((F.col("_rn") - 2) * buckets / F.col("_n"))
    rows = numbered.where((F.col("_rn") > 1) & (cut > before)).drop("_rn", "_n").distinct().collect()
    return [tuple(r) for r in rows]


def _search(df: DataFrame, value: Column, splits: Sequence[float], out: str) -> DataFrame:
    """Adds ``out``: the number i of the interval [splits[i], splits[i + 1]) that ``value`` lies in."""
    tmp = "_range_value"
    search = Bucketizer(splits=list(splits), inputCol=tmp, outputCol=out, handleInvalid="keep")
    return search.transform(df.withColumn(tmp, value)).drop(tmp)


def _splits(known: Sequence[float]) -> list[float]:
    """Splits that give each of the sorted ``known`` an interval of its own, and one to each gap between."""
    return sorted({-math.inf, math.inf, *known, *(math.nextafter(x, math.inf) for x in known)})


def with_tuple_bucket(df: DataFrame, order_by: Sequence[str], boundaries: Sequence[tuple], name: str) -> DataFrame:
    """Adds the bucket number ``name`` (int): how many boundaries are at or below the row's order tuple."""
    if not boundaries:
        return df.withColumn(name, F.lit(0))
    dtypes = dict(df.dtypes)
    spark = df.sparkSession
    longest = [max((len(b[i].encode() if isinstance(b[i], str) else b[i]) for b in boundaries if b[i] is not None),
                   default=0) if _is_text(dtypes[c]) else 0 for i, c in enumerate(order_by)]
    fields = [T.StructField(f.name, f.dataType, True) for f in df.select(*order_by).schema]
    bounds = spark.createDataFrame([(*b, i) for i, b in enumerate(boundaries)],
                                   T.StructType([*fields, T.StructField("_b", T.IntegerType())]))
    steps: list[tuple] = []         # ("digit", column) or ("full", position of a text column)
    for i, c in enumerate(order_by):
        chunks = min(MAX_CHUNKS, max(1, -(-longest[i] // CHUNK)))
        digits, exact = _digits(c, dtypes[c], chunks)
        steps += [("digit", d) for d in digits]
        if _is_text(dtypes[c]):
            steps.append(("full", i))
        elif not exact:
            break
    kinds = [s for s in steps if s[0] == "digit"]
    rows = bounds.select("_b", *[d.alias(f"_d{i}") for i, (_, d) in enumerate(kinds)]).collect()
    values = {r["_b"]: list(r)[1:] for r in rows}

    out = df.withColumn(name, F.lit(0.0))
    state = dict.fromkeys(values, 0)                # boundary -> its state, odd once a digit is placed
    digit = 0
    for what, arg in steps:
        if digit and len(set(state.values())) == len({boundaries[b] for b in state}):
            break                                   # the digits so far tell all boundaries apart
        if what == "digit":
            splits = _splits({v[digit] for v in values.values()})
            rank = {x: i for i, x in enumerate(splits)}
            mine = {b: rank[v[digit]] for b, v in values.items()}
            radix = len(splits) + 1
            out = _search(out, arg, splits, "_range_digit")
            digit += 1
        else:
            # equal in every chunk to a boundary: compare with its full text (one boundary text per state is enough
            # to keep the order; texts that differ only beyond the chunks share a side)
            full = {}
            for b in sorted(state, key=lambda b: boundaries[b][arg] or ("" if dtypes[order_by[arg]] == "string" else b"")):
                full.setdefault(state[b], boundaries[b][arg])
            known_states = sorted(full)
            texts = F.array(*[F.lit(full[s]).cast(dtypes[order_by[arg]]) for s in known_states])
            at = F.array_position(F.array(*[F.lit(float(s)) for s in known_states]), F.col(name)).cast("int")
            own, other = F.col(f"`{order_by[arg]}`"), F.get(texts, at - 1)
            out = out.withColumn("_range_digit", F.when(at == 0, 0.0).when(own.eqNullSafe(other), 1.0).when(
                own.isNull() | (own < other), 0.0).otherwise(2.0))
            mine = {b: (1 if boundaries[b][arg] == full[state[b]] else 2) for b in state}
            radix = 3
        pair = {b: float(state[b] * radix + mine[b]) for b in state}
        splits = _splits(set(pair.values()))
        out = _search(out, F.col(name) * radix + F.col("_range_digit"), splits, "_range_state")
        out = out.withColumn(name, F.col("_range_state")).drop("_range_digit", "_range_state")
        place = {x: i for i, x in enumerate(splits)}
        state = {b: place[p] for b, p in pair.items()}
        if what == "full" and 2 in mine.values():
            break           # texts that differ beyond the chunks: what follows must not decide between them
    out = _search(out, F.col(name), [-math.inf, *sorted({float(s) for s in state.values()}), math.inf], "_range_state")
    # non-nullable, so joins on it infer no filter that repeats the search
    return out.withColumn(name, F.coalesce(F.col("_range_state").cast("int"), F.lit(0))).drop("_range_state")
