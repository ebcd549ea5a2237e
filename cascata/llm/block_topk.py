"""Exact top-k search by inner product with block-at-a-time pruning.

Candidates are ordered by id and cut into shards, shards into blocks of
``BLOCK`` consecutive vectors.  A block keeps its vectors (its forward index)
and, per dimension, the largest and smallest component.  A query's bound for a
block sums, over its dimensions, the larger of component * maximum and
component * minimum; no vector of the block can score more.  A task holds one
shard and one group of queries: each query visits blocks by descending bound,
scores a block through its forward index, and stops at the first bound below
its k-th score.  Blocks whose bound equals it are still scored, so ties go to
the smaller id.

Queries are a stated set; both sides are packed into rows of at most
``QUERY_GROUP`` and ``SHARD`` vectors first.  Query groups are copied to every
shard and shards to every group by a generator over their numbers, one task
per pair: memory is bounded by one shard and one group.  Each task returns k
rows a query, and a partial top-k merge follows.

Defined results: vectors that are null, empty, or hold null or non-finite
components take no part, nor do null ids; vectors of another length than the
query's are no candidates; a query is never its own candidate, rows that share
an id are all excluded for it; fewer than k candidates give fewer rows; repeated
candidate rows each take a rank; different queries that share an id are ranked
together; scores are exact integers, kept within a
long; an empty table gives none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascata.llm.common import prepare, written

BLOCK = 256
SHARD = 1 << 16
QUERY_GROUP = 1 << 14
LONG_MAX = (1 << 63) - 1


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component as long, null unless the vector is usable."""
    usable = (vector.isNotNull() & (F.size(vector) > 0)
              & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                         & (F.abs(x.cast("double")) < float("inf"))))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


class Shard:
    """Consecutive candidates, cut into blocks with their component bounds."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block: int = BLOCK):
        self.ids = ids
        self.vectors = vectors
        cuts = np.arange(0, len(ids), block)
        self.edges = [*cuts.tolist(), len(ids)]
        self.high = np.maximum.reduceat(vectors, cuts, axis=0)
        self.low = np.minimum.reduceat(vectors, cuts, axis=0)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query row, candidate ids, scores), at most k each, best first, ties to the smaller id."""
        largest = max(int(np.abs(self.vectors).max(initial=0)), 1) * max(int(np.abs(queries).max(initial=0)), 1)
        # sums below 2^53 are exact in floating point, where the products are fastest
        kind = (np.float64 if largest * queries.shape[1] < 1 << 53 else
                np.int64 if largest * queries.shape[1] < 1 << 62 else object)
        vectors, q = self.vectors.astype(kind), queries.astype(kind)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        bounds = up @ self.high.astype(kind).T + down @ self.low.astype(kind).T
        order = np.argsort(-bounds, axis=1, kind="stable")
        n = len(q)
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, kind))] * n
        active = np.arange(n)
        for turn in range(bounds.shape[1]):
            at = order[active, turn]
            going = np.array([len(best[i][0]) < k or bounds[i, b] >= best[i][1][-1] for i, b in zip(active, at)], bool)
            active, at = active[going], at[going]
            if not len(active):
                break
            for b in np.unique(at):
                rows = active[at == b]
                ids = self.ids[self.edges[b]:self.edges[b + 1]]
                scores = q[rows] @ vectors[self.edges[b]:self.edges[b + 1]].T
                for i, s in zip(rows, scores):
                    ok = ids != query_ids[i]
                    if len(best[i][0]) >= k:
                        ok &= s >= best[i][1][-1]
                    if not ok.any():
                        continue
                    all_ids = np.concatenate([best[i][0], ids[ok]])
                    all_scores = np.concatenate([best[i][1], s[ok]])
                    top = np.lexsort((all_ids, -all_scores))[:k]
                    best[i] = all_ids[top], all_scores[top]
        for i, (ids, scores) in enumerate(best):
            if len(ids):
                yield i, ids, np.array([min(max(int(s), -LONG_MAX - 1), LONG_MAX) for s in scores], np.int64)


def _packed(rows: DataFrame, size: int, parts: int, name: str) -> DataFrame:
    """(dim, <name>, ids, components): at most ``size`` vectors of one length per row, in order of their ids.

    ``rows`` has id, v, dim.  Ranges come from a sort by (dim, id); a partition packs its own rows, so a pack may be
    smaller, never larger.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        parts: list[np.ndarray] = []
        dim = None
        for batch in batches:
            for i, d, v in zip(batch.column("id").to_pylist(), batch.column("dim").to_pylist(),
                               batch.column("v").to_pylist()):
                if ids and (d != dim or len(ids) >= size):
                    yield _pack_row(dim, ids, parts)
                    ids, parts = [], []
                dim = d
                ids.append(i)
                parts.append(np.array(v, "<i8"))
        if ids:
            yield _pack_row(dim, ids, parts)

    packed = rows.repartitionByRange(parts, "dim", "id").sortWithinPartitions("dim", "id").mapInArrow(
        run, "dim int, ids binary, components binary")
    number = F.monotonically_increasing_id()
    return written(packed.withColumn(name, number), name)


def _pack_row(dim: int, ids: list[int], parts: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([np.array(ids, "<i8").tobytes()]), pa.array([_small(parts)])],
        ["dim", "ids", "components"])


def _small(parts: list[np.ndarray]) -> bytes:
    """All components as 2-byte integers if they fit, else 8-byte ones; the first byte says which."""
    whole = np.concatenate(parts)
    if whole.min() >= -(1 << 15) and whole.max() < 1 << 15:
        return b"2" + whole.astype("<i2").tobytes()
    return b"8" + whole.tobytes()


def _unpack(ids: bytes, components: bytes) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, "<i8")
    flat = np.frombuffer(components, "<i2" if components[:1] == b"2" else "<i8", offset=1).astype(np.int64)
    return own, flat.reshape(len(own), -1)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 256.0, shard: int = SHARD, query_group: int = QUERY_GROUP) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row for which ``queries`` holds."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v"),
                          queries.alias("is_query"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()).withColumn("dim", F.size("v"))
    # rows that share id and vector are one query
    asked = rows.where("is_query").select("id", "v", "dim").distinct()
    n = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if("is_query").alias("asked")).first()
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = _packed(rows.drop("is_query"), shard, max(1, min(spread, n["all"] // BLOCK), -(-n["all"] // shard)), "shard")
    groups = _packed(asked, query_group, max(1, -(-n["asked"] // query_group)), "grp")
    pairs = groups.select("dim", "grp").join(shards.select("dim", "shard"), "dim")      # numbers only
    left = shards.join(pairs, ["dim", "shard"]).select("shard", "grp", "ids", "components", F.lit(True).alias("doc"))
    right = groups.join(pairs, ["dim", "grp"]).select("shard", "grp", "ids", "components", F.lit(False).alias("doc"))

    def cell(frame: pd.DataFrame) -> pd.DataFrame:
        doc, ask = frame[frame.doc].iloc[0], frame[~frame.doc].iloc[0]
        ids, candidates = _unpack(doc.ids, doc.components)
        query_ids, asked_vectors = _unpack(ask.ids, ask.components)
        found = [(query_ids[i], c, s) for i, cs, ss in Shard(ids, candidates).search(query_ids, asked_vectors, k)
                 for c, s in zip(cs, ss)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    best = left.unionAll(right).groupBy("shard", "grp").applyInPandas(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
