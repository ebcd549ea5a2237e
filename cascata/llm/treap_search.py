"""Ranked lexical search on K2-treaps over the term-document grid.

1. A map over whole texts makes, per document, its length in terms and its
   occurrences of the items' terms (no other term can score), and writes them
   once.  Three aggregates over all documents follow: documents with a term,
   all terms, and the documents holding each of the items' terms.
2. A task cuts its documents into blocks of at most ``BLOCK_DOCS`` documents or
   ``BLOCK_POSTINGS`` grid points.  A block is one K2-treap: rows are terms,
   columns are documents, a point's weight is the term's impact on the
   document.  The grid is halved both ways down to single points; cells without
   a point are left out (a four-bit mask and the place of the first child per
   cell), and every cell keeps the largest impact inside it.  Terms lie
   ``SPACING`` rows apart, so that a cell of up to as many columns holds one
   term only and bounds grow tight early.  Columns are ordered by each
   document's strongest terms, so that a term's large impacts lie side by side;
   any spacing and order are exact.
3. An item descends the rows of all its terms jointly, best first over ranges
   of documents: a range's bound is the sum, over the terms, of the maximum of
   the cell that holds the term's row and the range.  The best ranges are
   halved next, a batch at a time; a range of one document has its exact score.
   The item is done when no bound reaches its k-th score, which carries over
   from block to block of a task.  Bounds that equal it are still opened, so
   ties go to the smaller id.
4. Each task returns k rows an item; a ranked merge follows.

Scores: weight w = floor(1000 ln((2N+2)/(2 df+1))) in doubles, all else 64-bit
integers; with m = 100 - 90 + (90 n N div L) a term adds
w * (10^9 tf div (1000 tf + 8 m)).

Memory of a task: one block.  Items are a stated set: their terms are broadcast
in groups of about ``GROUP_TERMS`` (item, term) pairs, each group a search of
its own.

Defined results: terms are folded in A-Z only; null and empty texts and texts
without a term are no documents of the statistics and never results; items
without a term, or none of whose terms scores, have no rows; rows that share an
item id are one item with the terms of all; every row of the documents is a
document of its own, so repeated rows each take a rank; a null doc_id ranks
last among equal scores; rows that are equal in all of this take their ranks in
no set order; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cascata.llm.common import prepare, written

BLOCK_DOCS = 1 << 14
BLOCK_POSTINGS = 1 << 20
GROUP_TERMS = 500_000
BATCH = 64              # ranges halved at once
SPACING = 1 << 8        # rows from one term to the next
PIECE = 1 << 20         # bytes of a text split into terms at once

# The characters of a term, and the constants of its score.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE, TF_WEIGHT, LENGTH_WEIGHT, LENGTH_SHARE = 10 ** 9, 1000, 8, 90

# the same rule on UTF-8 bytes: A-Z folded, other ASCII that is no digit or letter a blank, the rest as it is
FOLD = bytes(c | 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))

# STEP[mask, quadrant]: how many children lie before it, or -1 where it is empty
STEP = np.array([[bin(m & ((1 << q) - 1)).count("1") if m >> q & 1 else -1 for q in range(4)] for m in range(16)], np.int64)


def terms(text: Column) -> Column:
    """The terms of a text in order, as an array."""
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({TERM})"), F.lit(1))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, some at a time."""
    folded, at = text.translate(FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def postings(docs: DataFrame, rows: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, term_rows, counts) per document: its length in terms and its counts of the known terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of = rows.value.get
        for batch in batches:
            length, found, counts = [], [], []
            for text in batch.column("text").to_pylist():
                n, known = 0, []
                for words in words_of(text or b""):
                    n += len(words)
                    known += [r for r in map(row_of, words) if r is not None]
                row, count = np.unique(np.array(known, np.int32), return_counts=True)
                length.append(n)
                found.append(row)
                counts.append(count.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(length, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "n", "term_rows", "counts"])

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return base.mapInArrow(run, "doc_id long, n long, term_rows array<int>, counts array<int>")


class Treap:
    """The grid points (row, column, weight > 0) of a block as a compressed quadtree of maxima.

    ``mask`` has a cell's four-bit child mask, ``first`` the place of its first child, ``high`` the largest weight
    in it.  Place 0 is the root, the last place an empty cell that stands for all that are left out.
    """

    def __init__(self, row: np.ndarray, column: np.ndarray, weight: np.ndarray):
        self.depth = max(int(max(row.max(initial=0), column.max(initial=0))).bit_length(), 1)
        code = np.zeros(len(row), np.uint64)
        for bit in range(self.depth):
            code |= (column.astype(np.uint64) >> np.uint64(bit) & np.uint64(1)) << np.uint64(2 * bit)
            code |= (row.astype(np.uint64) >> np.uint64(bit) & np.uint64(1)) << np.uint64(2 * bit + 1)
        order = np.argsort(code, kind="stable")
        code, high = code[order], weight[order].astype(np.int64)
        levels = [(np.zeros(len(code), np.uint8), np.zeros(len(code), np.int64), high)]
        for _ in range(self.depth):
            parent = code >> np.uint64(2)
            first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            bits = np.uint8(1) << (code & np.uint64(3)).astype(np.uint8)
            high = np.maximum.reduceat(high, first)
            levels.append((np.bitwise_or.reduceat(bits, first), first, high))
            code = parent[first]
        levels.reverse()
        start = np.cumsum([0] + [len(high) for _, _, high in levels])
        self.empty = int(start[-1])
        self.mask = np.concatenate([m for m, _, _ in levels] + [np.zeros(1, np.uint8)])
        self.first = np.concatenate([f + s for (_, f, _), s in zip(levels, start[1:])] + [np.full(1, self.empty)]).astype(np.int32)
        self.high = np.concatenate([h for _, _, h in levels] + [np.zeros(1, np.int64)])

    def halves(self, places: np.ndarray, rows: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms' cells in both halves of each range: (range, half, term), and the halves' bounds.

        ``places`` has the terms' cells of each range, ``level`` how far down a range is.
        """
        down = (rows[None, :] >> (self.depth - 1 - level)[:, None]) & 1
        quadrant = 2 * down[:, None, :] + np.array([0, 1])[None, :, None]
        step = STEP[self.mask[places][:, None, :], quadrant]
        cells = np.where(step < 0, self.empty, self.first[places][:, None, :] + step)
        return cells, self.high[cells].sum(axis=2)

    def best(self, rows: np.ndarray, k: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(columns, scores) of some columns, among them the best k and all as good as these, if they reach ``least``."""
        top: list[int] = []                     # the best k scores so far, smallest first
        root = np.zeros(len(rows), np.int64)
        frontier = [(-int(self.high[root].sum()), 0, 0, root)]
        while frontier:
            bar = max(least, top[0] if len(top) == k else 1)
            batch = []
            while frontier and len(batch) < BATCH and -frontier[0][0] >= bar:
                batch.append(heapq.heappop(frontier))
            if not batch:
                return
            level = np.array([b[1] for b in batch])
            start = np.array([b[2] for b in batch])
            cells, bounds = self.halves(np.stack([b[3] for b in batch]), rows, level)
            columns = 2 * start[:, None] + np.array([0, 1])
            single = (level + 1 == self.depth)[:, None] & (bounds >= bar)
            if single.any():
                scores = bounds[single]
                yield columns[single], scores
                for s in scores.tolist():
                    if len(top) < k:
                        heapq.heappush(top, s)
                    elif s > top[0]:
                        heapq.heapreplace(top, s)
                bar = max(least, top[0] if len(top) == k else 1)
            for i, half in zip(*np.nonzero((level + 1 < self.depth)[:, None] & (bounds >= bar))):
                heapq.heappush(frontier, (-int(bounds[i, half]), int(level[i]) + 1, int(columns[i, half]), _Cells(cells[i, half])))


class _Cells(np.ndarray):
    """Cells of a range; where bound, level and range are equal, so are they, and their order is of no account."""

    def __new__(cls, cells: np.ndarray):
        return cells.view(cls)

    def __lt__(self, other) -> bool:
        return False


def _impacts(weight: np.ndarray, doc: np.ndarray, row: np.ndarray, count: np.ndarray, n: np.ndarray, n_docs: int,
             n_terms: int) -> np.ndarray:
    long = [100 - LENGTH_SHARE + LENGTH_SHARE * x * n_docs // n_terms for x in n.tolist()]    # may pass 64 bits on the way
    return weight[row] * (SCALE * count // (TF_WEIGHT * count + LENGTH_WEIGHT * np.array(long, np.int64)[doc]))


def _columns(doc: np.ndarray, row: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
    """The column of each document: by its strongest term, then its second strongest."""
    order = np.lexsort((row, -impact, doc))
    at = np.searchsorted(doc[order], np.arange(n_docs + 1))
    ranked = np.append(row[order], -1)
    first = np.where(at[1:] > at[:-1], ranked[at[:-1]], -1)
    second = np.where(at[1:] > at[:-1] + 1, ranked[np.minimum(at[:-1] + 1, len(order))], -1)
    column = np.empty(n_docs, np.int64)
    column[np.lexsort((second, first))] = np.arange(n_docs)
    return column


class _Search:
    """All items over the blocks of one task: the k best documents of each so far."""

    def __init__(self, items: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, k: int):
        self.items, self.weight, self.k = items, weight, k
        self.n_docs, self.n_terms = n_docs, n_terms
        self.found: list[list[tuple[int, bool, int]]] = [[] for _ in items]

    def block(self, ids: list[int | None], n: list[int], rows: list[np.ndarray], counts: list[np.ndarray]) -> None:
        row, count = np.concatenate(rows).astype(np.int64), np.concatenate(counts).astype(np.int64)
        doc = np.repeat(np.arange(len(ids)), [len(r) for r in rows])
        impact = _impacts(self.weight, doc, row, count, np.array(n, np.int64), self.n_docs, self.n_terms)
        scoring = impact > 0
        if not scoring.any():
            return
        doc, row, impact = doc[scoring], row[scoring], impact[scoring]
        column = _columns(doc, row, impact, len(ids))
        back = np.empty_like(column)
        back[column] = np.arange(len(ids))
        treap = Treap(row * SPACING, column[doc], impact)
        present = np.zeros(len(self.weight), bool)
        present[row] = True
        for i, own in enumerate(self.items):
            own = own[present[own]]
            if not len(own):
                continue
            best = self.found[i]
            least = -best[-1][0] if len(best) == self.k else 1
            for columns, scores in treap.best(own * SPACING, self.k, least):
                best += [(-s, ids[d] is None, ids[d] or 0) for s, d in zip(scores.tolist(), back[columns].tolist())]
                if len(best) > 8 * self.k:
                    best = sorted(best)[:self.k]
            self.found[i] = sorted(best)[:self.k]

    def rows(self) -> pa.RecordBatch:
        flat = [(i, None if missing else d, -s) for i, best in enumerate(self.found) for s, missing, d in best]
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in flat], pa.int32()), pa.array([f[1] for f in flat], pa.int64()),
                                           pa.array([f[2] for f in flat], pa.int64())], ["item", "doc_id", "score"])


def _scored(held: DataFrame, sent: Broadcast, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _Search(*sent.value, k)
        ids, n, rows, counts, points = [], [], [], [], 0
        for batch in batches:
            for i, length, row, count in zip(batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(),
                                             batch.column("term_rows"), batch.column("counts")):
                if ids and (len(ids) >= BLOCK_DOCS or points + len(row) > BLOCK_POSTINGS):
                    search.block(ids, n, rows, counts)
                    ids, n, rows, counts, points = [], [], [], [], 0
                ids.append(i)
                n.append(length)
                rows.append(np.array(row.values))
                counts.append(np.array(count.values))
                points += len(row)
        if ids:
            search.block(ids, n, rows, counts)
        yield search.rows()

    return held.mapInArrow(run, "item int, doc_id long, score long")


def _search_group(docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``search`` for one group of items: ``wanted`` has (item_id, term), each once."""
    spark = docs.sparkSession
    listed = wanted.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")).collect()
    # rows in order of the first item that asks for them: an item's own terms are neighbours in the grid
    row_of: dict[bytes, int] = {}
    items = [np.array([row_of.setdefault(t.encode(), len(row_of)) for t in r["terms"]], np.int64) for r in listed]
    rows = spark.sparkContext.broadcast(row_of)
    held = written(postings(docs, rows, id_col, text_col), "term-counts")
    n_docs, n_terms = held.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(row_of), np.int64)
    for r in held.select(F.explode("term_rows").alias("row")).groupBy("row").count().collect():
        holding[r["row"]] = r["count"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)
    sent = spark.sparkContext.broadcast((items, weight, n_docs, n_terms))
    best = _scored(held.where(F.size("term_rows") > 0), sent, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(listed)],
                                  f"item int, item_id {wanted.schema['item_id'].dataType.simpleString()}")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, of those with a score above 0."""
    prepare(docs.sparkSession)
    wanted = items.select(F.col(item_col).alias("item_id"), F.explode(terms(F.col(item_text_col).cast("string"))).alias("term"))
    wanted = written(wanted.distinct(), "item-terms")
    groups = max(1, math.ceil(wanted.count() / GROUP_TERMS))
    number = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    out = None
    for g in range(groups):
        part = _search_group(docs, wanted.where(number == g), k, id_col, text_col)
        out = part if out is None else out.unionAll(part)
    return out
