"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Terms are runs of character classes (4-grams over 16 classes of bytes, which
tell prose from tables, symbol noise and shouting), character bigrams, and
counts of repeated words and lines.  Their log-weighted, idf-scaled counts are
projected on the leading singular vectors of a bounded labelled sample; the
sample's unit vectors and labels are broadcast.  Every document's cosines with
the whole sample are computed exactly, a block of documents times the sample
matrix at a time; the k nearest vote with their label, weighted by similarity.

Bounds: the fit reads ``per_class`` distinct labelled texts per label, those of
lowest hash of id and text.  They are chosen by hashes alone: a cut of the hash
that leaves about ``SLACK`` times as many, set from the counted classes, comes
before the ranking, and only the chosen texts are fetched.  So the fit neither
grows with the corpus nor depends on its order.  ``KEPT_TERMS`` commonest terms
of the sample (a documented parameter of the fit; a rarer class 4-gram is in few
texts and has no axis) are projected.  The broadcast is 2 * per_class * dims
floats.  Scoring is a map over whole texts: no shuffle.

Defined results: a null or empty text has the zero vector and gets the
sample's share of label 1 (prior); cosines are rounded to ``DECIMALS``, so that
equal vectors are equally similar whatever block they are in, and similarities
tie by sample order, which is by hash of id and text; a
sample without rows gives every text 0.5; repeated rows give repeated rows; an
empty table gives none; labels, lang, source and ids never enter a vector;
other columns are kept only by ``classify``'s caller, never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cascata.llm.common import as_row, prepare, written

PER_CLASS = 2500
DIMS = 48
NEIGHBOURS = 25
CLASSES = 16
GRAM = 4
BIGRAM_BITS = 10
TERMS = CLASSES ** GRAM + (1 << BIGRAM_BITS) + 16
# Vectors are compared in blocks of this many documents.
BLOCK = 256
# Terms of the sample that are projected.
KEPT_TERMS = 4000
# Rows a class that a cut of the hash leaves for the ranking, as a multiple of those wanted.
SLACK = 8
# Places of a cosine that count.
DECIMALS = 6
# Sharpness of the similarity weights.
POWER = 8.0


def _byte_classes() -> np.ndarray:
    """Byte -> one of 16 classes."""
    table = np.full(256, 15, np.uint8)
    table[ord("a"):ord("z") + 1] = 0
    table[ord("A"):ord("Z") + 1] = 1
    table[ord("0"):ord("9") + 1] = 2
    for cls, chars in ((3, " "), (4, "\n\r"), (5, "."), (6, ","), (7, "!?"), (8, "|"), (9, "#$%&*@^~"), (10, ";:"),
                       (11, "'\"`"), (12, "()[]{}<>"), (13, "-_/\\+="), ):
        for c in chars:
            table[ord(c)] = cls
    table[128:] = 14
    return table


_CLASS = _byte_classes()


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(term numbers, weights) of one whole text; no terms for a null or empty one."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    n = len(raw)
    if not n:
        return np.empty(0, np.int64), np.empty(0)
    cls = _CLASS[raw].astype(np.int64)
    grams = np.zeros(max(0, n - GRAM + 1), np.int64)
    for i in range(GRAM):
        grams = grams * CLASSES + cls[i:n - GRAM + 1 + i] if n >= GRAM else grams
    pairs = ((raw[:-1].astype(np.int64) * 31 + raw[1:]) * 2654435761 >> 7) & ((1 << BIGRAM_BITS) - 1)
    counts = np.bincount(np.concatenate([grams, pairs + CLASSES ** GRAM]))
    ids = np.flatnonzero(counts)
    weights = counts[ids] / n                          # shares: the length of a text says nothing
    # words and lines that repeat their predecessor or anything before them
    words = text.split()
    lines = text.split("\n")
    w = max(1, len(words))
    shares = np.array([sum(a == b for a, b in zip(words, words[1:])) / w, 1 - len(set(words)) / w,
                       1 - len(set(lines)) / max(1, len(lines)), max(map(len, words), default=0) / n,
                       sum(map(str.isupper, words)) / w, sum(map(str.islower, words)) / w])
    buckets = np.concatenate([shares[:3], (shares[3:] > (0.5, 0.5, 0.5)).astype(float)])
    special = CLASSES ** GRAM + (1 << BIGRAM_BITS) + np.arange(len(buckets))
    return np.concatenate([ids, special]), np.concatenate([weights, buckets])


@dataclass
class Model:
    projection: np.ndarray      # TERMS x dims, idf folded in
    mean: np.ndarray            # dims
    vectors: np.ndarray         # sample x dims, unit rows
    labels: np.ndarray          # sample, 0 or 1
    weight: np.ndarray          # sample, evens out the classes' sampling rates
    prior: float
    neighbours: int = NEIGHBOURS

    def vector(self, text: str | None) -> np.ndarray:
        ids, weights = term_counts(text)
        if not len(ids):
            return np.zeros(len(self.mean), np.float32)
        v = np.sqrt(weights) @ self.projection[ids] - self.mean
        return (v / max(1e-12, float(np.linalg.norm(v)))).astype(np.float32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Share of label 1 among each text's nearest sample rows, weighted by similarity."""
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        out = np.empty(len(texts))
        k = min(self.neighbours, len(self.labels))
        sample = self.vectors.astype(np.float64).T
        for i in range(0, len(texts), BLOCK):
            block = np.stack([self.vector(t) for t in texts[i:i + BLOCK]]).astype(np.float64)
            cosines = np.round(block @ sample, DECIMALS)
            near = nearest(cosines, k)
            near_cos = np.take_along_axis(cosines, near, 1)
            vote = np.clip(near_cos, 0, 1) ** POWER * self.weight[near]
            total = vote.sum(axis=1)
            ones = (vote * self.labels[near]).sum(axis=1)
            known = (np.abs(block).sum(axis=1) > 0) & (total > 0)
            out[i:i + BLOCK] = np.where(known, ones / np.where(total > 0, total, 1), self.prior)
        return out


def nearest(cosines: np.ndarray, k: int) -> np.ndarray:
    """Per row, the places of the k largest, equal ones by place, in order of place."""
    bar = np.partition(cosines, cosines.shape[1] - k, axis=1)[:, -k][:, None]
    at = cosines == bar
    taken = (cosines > bar) | at & (np.cumsum(at, axis=1) <= k - (cosines > bar).sum(axis=1, keepdims=True))
    return np.nonzero(taken)[1].reshape(len(cosines), k)


def sample_keys(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, per_class: int
                ) -> tuple[DataFrame, dict[int, int]]:
    """((y, id, t, h) of the sampled distinct texts, t and h being hashes of the text, and of it and the id; distinct
    labelled texts of each class).  Ids and hashes are shuffled, no text."""
    wanted = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1))
    ids = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("t"))
    keys = written(ids.distinct().join(wanted.distinct(), "id").withColumn("h", F.xxhash64("id", "t")), "labelled-keys")
    totals = {r["y"]: r["n"] for r in keys.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    lowest, span = -(1 << 63), (1 << 64) - 1
    cut = F.lit(None).cast("long")
    for y, n in totals.items():
        cut = F.when(F.col("y") == y, lowest + min(span, span * SLACK * per_class // n)).otherwise(cut)
    rank = F.row_number().over(Window.partitionBy("y").orderBy("h", "id"))
    chosen = keys.where(F.col("h") <= cut).withColumn("r", rank).where(F.col("r") <= per_class).drop("r")
    return written(chosen, "sample-keys"), totals


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        per_class: int = PER_CLASS, dims: int = DIMS, neighbours: int = NEIGHBOURS, kept_terms: int = KEPT_TERMS) -> Model:
    """Latent-semantic vectors of at most ``per_class`` texts of each label (0 and 1); ``labels`` has ids and labels."""
    prepare(docs.sparkSession)
    keys, totals = sample_keys(docs, labels, label_col, id_col, text_col, per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [term_counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("h"), pa.array([g[0].astype(np.int32) for g in got],
                                                                pa.list_(pa.int32())),
                 pa.array([np.sqrt(g[1]).astype(np.float32) for g in got], pa.list_(pa.float32()))],
                ["y", "h", "ids", "weights"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = texts.withColumn("t", F.xxhash64("text")).join(F.broadcast(keys.select("id", "t").distinct()), ["id", "t"], "left_semi")
    sample = (texts.groupBy("id", "t").agg(F.first("text").alias("text")).join(F.broadcast(keys), ["id", "t"])
              .select("y", "h", "text"))
    got = sample.mapInArrow(run, "y int, h long, ids array<int>, weights array<float>").toArrow()
    order = np.lexsort((got.column("y").to_numpy(), got.column("h").to_numpy()))
    y = got.column("y").to_numpy()[order].astype(np.float64)
    n = len(y)
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    if n == 0:
        return Model(np.zeros((TERMS, 1)), np.zeros(1), np.zeros((0, 1), np.float32), y, y, 0.5, neighbours)
    lists = got.column("ids").combine_chunks()
    lens = np.diff(lists.offsets.to_numpy())
    row_of = np.repeat(np.arange(n), lens)
    ids = lists.values.to_numpy()[lists.offsets[0].as_py():]
    values = got.column("weights").combine_chunks().values.to_numpy()
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    used, column = np.unique(ids, return_inverse=True)
    df = np.bincount(column, minlength=len(used))
    idf = np.log((1 + n) / (1 + df)) + 0.5
    keep = np.argsort(-df, kind="stable")[:kept_terms]     # the commonest terms carry the shape of a text
    place = np.full(len(used), -1)
    place[keep] = np.arange(len(keep))
    matrix = np.zeros((n, len(keep)), np.float32)
    inside = place[column] >= 0
    matrix[at[row_of[inside]], place[column[inside]]] = values[inside] * idf[column[inside]]
    mean = matrix.mean(axis=0)
    centred = matrix - mean
    _, vectors = np.linalg.eigh((centred.T @ centred).astype(np.float64) / n)
    axes = vectors[:, ::-1][:, :min(dims, len(keep))]
    projection = np.zeros((TERMS, axes.shape[1]), np.float32)
    projection[used[keep]] = axes * idf[keep][:, None]
    latent = centred @ axes
    norm = np.linalg.norm(latent, axis=1, keepdims=True)
    latent = (latent / np.maximum(norm, 1e-12)).astype(np.float32)
    sampled = {c: float((y == c).sum()) for c in (0, 1)}
    rate = {c: totals.get(c, 0) / sampled[c] if sampled[c] else 0.0 for c in (0, 1)}
    weight = np.where(y == 1, rate[1], rate[0])
    return Model(projection, mean @ axes, latent, y, weight, prior, neighbours)


def classify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): the weighted share of label 1 among every whole text's nearest neighbours."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)
    dtype = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())],
                                             ["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dtype}, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; same columns, a map without a shuffle."""
    rows = docs.select(as_row(docs), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.scores(batch.column("text").to_pylist())
            yield batch.select(["row"]).filter(pa.array(scores >= threshold))

    kept = rows.mapInArrow(run, rows.select("row").schema)
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
