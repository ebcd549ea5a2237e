"""N-gram Jaccard join: T-occurrence search over inverted lists (DivideSkip), and its components.

1. A map over whole texts makes each document's set of distinct word k-shingles
   (64-bit hashes) and a 128-bit digest of the set, and counts all shingles by
   ``SLOTS`` slots of their hashes.  Equal digests are one class; from here on a
   class is its smallest id, so exact copies cost one row each.
2. Blocking, exact by the prefix principle: under one global order of shingles
   two sets with Jaccard >= t share one of each one's first
   |x| - ceil(t |x|) + 1 shingles.  The order puts shingles of full slots last
   (the slots' counts, summed over all documents, are a broadcast of one byte a
   slot whatever the data's size; it only saves work, any order is exact).  A
   slot's chance neighbours add to it by the square root of the corpus, a
   passage of many documents in proportion, so passages stand out more as the
   corpus grows.  Prefix postings are narrow rows (shingle, class, size);
   those without another class of their shingle whose size allows a link drop
   out, so most of what is shared by chance goes no further.
3. Search cells: each shingle's smallest class (the pivot) with its other
   classes, at most ``CELL`` and about ``CELL_SHINGLES`` shingles at a time.  A cell first sees its sets' histograms
   (counts per range of shingle hashes, 1/32 of a set's bytes): the sum of the
   smaller counts is an upper bound of an overlap, so sets without a partner
   that could reach the threshold leave before any set is fetched.  Then an
   inverted index over its
   sets is searched with each set by T-occurrence: the longest lists are set
   aside, the short ones heap-merged, survivors binary-probed in the long
   ones, and those that reach the required overlap are links.  Pairs already
   connected inside the cell are not looked up again, so a cell returns at most
   one edge per set.
4. Links become components.  Where a shingle's classes other than its pivot
   still lie in more than one component, pairs that met no pivot remain.  Classes
   without one of another component whose size allows a link drop out; the
   others of all shingles with the same largest component are put together, each
   class once with its shingles there.  Those of the largest component and the
   rest are cut into blocks of ``BLOCK`` classes or about ``CELL_SHINGLES``
   shingles, every pair of blocks but two of the largest component is a cell, and
   the cell's sets are searched that have a partner of another component within
   reach of their histograms and share such a shingle with it.  Rows are classes
   of a cell, never pairs nor one for each shingle: they grow with a group's size
   times the blocks of its classes outside its largest component.  So each pair
   that shares a prefix shingle is searched, already connected, or ruled out by
   its sizes or histograms.
5. Where all links are asked for (``linked``, the links counted by ``join``):
   a link lies within a component, so each component's classes are dealt by
   hash to blocks of about ``LINK_BLOCK`` or ``CELL_SHINGLES`` shingles, every
   pair of blocks is a cell, and each pair of classes meets in one cell, whatever
   connects it.  There each set is searched by T-occurrence as before.  Counts
   of links are summed within the cell; pairs leave it only for ``linked``.

Nothing is collected but the slots' counts, one byte each.  For components
alone, a group of thousands of near copies costs cells in proportion to its
size, as its pivots connect it; its links number up to the square of its
size, and so do the comparisons and the rows of ``linked`` (the counts don't).

Words are runs of characters other than space and \\t \\n \\v \\f \\r, A-Z in lower
case.  Defined results: a text with fewer than k words is one shingle of all
its words; null texts and texts without words have an empty set and no link;
rows with a null id are classes of their own without links and get a null
component; repeated rows (same id) are one document; an empty table gives none;
other columns are not read.  64-bit shingle hashes may collide (odds under
10^-9 per compared pair).
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cascata.llm.common import as_row, kept, prepare, written
from cascata.llm.components import connected_components

CELL = 48
# Shingles of a cell's sets, about; a larger set is alone with its partner.
CELL_SHINGLES = 1 << 20
# Cost of probing a long list against that of merging it: lists are probed one by one, arrays with all candidates at once.
LIST_PROBE, ARRAY_PROBE = 0.1, 0.002
# Classes of a shingle in a block of those that are compared by their histograms.
BLOCK = 2048
# Classes of a component in a block of the search for all its links.
LINK_BLOCK = 512
# Ids of the documents whose sets a search fetches, 8 bytes each, up to which they are broadcast.
BROADCAST_IDS = 2_000_000
# Slots of shingle hashes whose documents are counted, and of a slice of them: 4 bytes each in a task, 1 in the broadcast.
SLOTS = 1 << 22
SLICE = 1 << 16
# Shingles counted at a time within a task.
COUNT_BUFFER = 1_000_000
# Sets' digests that a task remembers, so as not to send a copy's prefix again.
SEEN_DIGESTS = 200_000
_MEMO_WORDS = 100_000


class Shingler:
    """Distinct shingle hashes of texts; word hashes are remembered up to a bound."""

    def __init__(self, k: int):
        self.k = k
        self.memo: dict[bytes, int] = {}

    def hashes(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes of a whole text's k-word shingles."""
        words = (text or "").encode().lower().split()      # bytes: ASCII letters and white space only
        if not words:
            return np.empty(0, np.uint64)
        if len(self.memo) > _MEMO_WORDS:
            self.memo.clear()
        memo, digest = self.memo, xxhash.xxh3_64_intdigest
        for w in set(words).difference(memo):
            memo[w] = digest(w)
        h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        width = min(self.k, len(words))
        out = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            out ^= h[i:len(h) - width + 1 + i]
            out *= np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return np.unique(out)


def shingler(k: int) -> Shingler:
    """One per Python worker."""
    return kept(("ngram_join", k), lambda: Shingler(k))


def histogram(hashes: np.ndarray) -> bytes:
    """Counts of a set's hashes in 2^b equal ranges, about 2 to a range; the first byte is the counts' width."""
    bits = max(0, len(hashes).bit_length() - 2)
    ranges = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    counts = np.bincount(ranges, minlength=1 << bits)
    width = 1 if counts.max() < 256 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1)


def could_link(histograms: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """The pairs whose sizes and histograms leave the threshold within reach."""
    return [(i, j) for i, others in within_reach(histograms, threshold) for j in others.tolist()]


def within_reach(histograms: list[np.ndarray], threshold: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): every pair whose sizes and histograms leave the threshold within reach, once."""
    sizes = np.array([int(h.sum()) for h in histograms])
    order = np.argsort(sizes, kind="stable")
    ascending = sizes[order]
    # partners of larger size, as far as the sizes allow
    last = np.searchsorted(100 * ascending, 100 * (100 * ascending // threshold), side="right")
    # larger sets have as many ranges or more: sets of equally many lie one after the other
    widths = np.array([len(histograms[i]) for i in order])
    first = np.flatnonzero(np.diff(widths, prepend=0))
    tables = [(a, b, np.stack([histograms[i] for i in order[a:b]]).astype(np.int32))
              for a, b in zip(first.tolist(), [*first[1:].tolist(), len(order)])]
    width = 0
    for p, i in enumerate(order.tolist()):
        if last[p] <= p + 1:
            continue
        if widths[p] != width:
            # fold the finer ones: a range of the smaller set's histogram is the sum of its parts
            width = int(widths[p])
            folded = [(a, b, t.reshape(b - a, width, -1).sum(axis=2, dtype=np.int32))
                      for a, b, t in tables if t.shape[1] >= width and a < last[p:][widths[p:] == width].max()]
            own_at, own = next((a, t) for a, _, t in folded)
        most = np.concatenate([np.minimum(own[p - own_at], t[max(0, p + 1 - a):last[p] - a]).sum(axis=1, dtype=np.int64)
                               for a, b, t in folded if b > p + 1 and a < last[p]])
        others = order[p + 1:last[p]]
        within = 100 * most >= threshold * (sizes[i] + sizes[others] - most)
        if within.any():
            yield i, others[within]


def overlap_needed(a: int, b: int, threshold: int) -> int:
    """Least intersection of sets of a and b shingles with 100 * intersection >= threshold * union."""
    return -(-threshold * (a + b) // (100 + threshold))


def prefix_size(n: int, threshold: int) -> int:
    return n - -(-threshold * n // 100) + 1


def divide_skip(query: np.ndarray, index: dict, needed: int, allowed: np.ndarray) -> list[tuple[int, int]]:
    """(set number, overlap) of the indexed sets that hold at least ``needed`` of the query's shingles.

    ``index`` maps a shingle to the ascending numbers of the sets that hold it, all lists or all arrays; ``allowed``
    marks numbers of interest, of arrays those beyond its end are of none.
    """
    lists = sorted((index[s] for s in query.tolist() if s in index), key=len)
    if len(lists) < needed:
        return []
    # L long lists: survivors of the short ones must occur there at least needed - L times
    longest = len(lists[-1])
    arrays = not isinstance(lists[-1], list)
    n_long = min(needed - 1, int(needed / ((ARRAY_PROBE if arrays else LIST_PROBE) * math.log2(longest + 1) + 1)))
    short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
    if not arrays:
        found, counts = [], []
        for number, run in groupby(heapq.merge(*short)):
            count = len(list(run))
            if count >= needed - n_long and allowed[number]:
                found.append(number)
                counts.append(count)
        return [(number, total) for number, count in zip(found, counts)
                if (total := _probed(long, number, count, needed)) >= needed]
    # arrays are merged by counting, and all candidates probe a long one at once
    merged = np.concatenate([entry[:np.searchsorted(entry, len(allowed))] for entry in short])
    totals = np.bincount(merged, minlength=len(allowed))
    candidates = np.flatnonzero((totals >= needed - n_long) & allowed)
    if not len(candidates):
        return []
    totals = totals[candidates]
    for left, entry in zip(range(n_long - 1, -1, -1), long):
        at = np.searchsorted(entry, candidates)
        totals += entry[np.minimum(at, len(entry) - 1)] == candidates
        within = totals + left >= needed
        if not within.all():
            candidates, totals = candidates[within], totals[within]
            if not len(candidates):
                break
    return list(zip(candidates.tolist(), totals.tolist()))


def _probed(long: list[list[int]], number: int, count: int, needed: int) -> int:
    left = len(long)
    for entry in long:
        at = bisect_left(entry, number)
        count += at < len(entry) and entry[at] == number
        left -= 1
        if count + left < needed:
            break
    return count


def search(sets: list[np.ndarray], threshold: int, group: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(i, j, overlap): enough links i, j to connect whatever the links among the sets connect.

    ``group`` numbers sets that are known to be connected already.
    """
    n = len(sets)
    first: dict[int, int] = {}
    parent = list(range(n)) if group is None else [first.setdefault(g, i) for i, g in enumerate(group)]

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes = np.array([len(s) for s in sets])
    # shingles that one set holds alone can't add to an overlap
    values, counts = np.unique(np.concatenate(sets), return_counts=True) if n else (np.empty(0), np.empty(0))
    shared = set(values[counts > 1].tolist())
    kept = [[s for s in own.tolist() if s in shared] for own in sets]
    order = sorted(range(n), key=lambda i: (sizes[i], i))
    index: dict[int, list[int] | np.ndarray] = {}
    links = []
    place = {i: p for p, i in enumerate(order)}
    many = n > CELL + 1
    if many:            # arrays, as in ``all_links``: numbers from the query's own on are not allowed
        index = inverted([np.array(kept[i], np.uint64) for i in order])
    roots = np.array([place[root(i)] for i in order])
    for p, i in enumerate(order):
        own = sizes[i]
        smaller = sizes[order[:p]]
        fit = 100 * smaller >= threshold * own                     # sizes that can reach the threshold
        allowed = fit & (roots[:p] != roots[p])
        if allowed.any():
            needed = overlap_needed(int(smaller[allowed].min()), int(own), threshold)
            if len(kept[i]) >= needed:
                for q, count in divide_skip(np.array(kept[i], np.uint64), index, needed, allowed):
                    j = order[q]
                    if count >= overlap_needed(int(sizes[j]), int(own), threshold) and roots[p] != roots[q]:
                        links.append((i, j, count))
                        roots[roots == roots[q]] = roots[p]
        for s in () if many else kept[i]:
            index.setdefault(s, []).append(p)
    return links


def inverted(sets: list[np.ndarray]) -> dict[int, np.ndarray]:
    """shingle -> ascending numbers of the sets that hold it."""
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    holders = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]
    distinct, at = np.unique(values[order], return_index=True)
    return dict(zip(distinct.tolist(), np.split(holders, at[1:])))


def slots_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """Rows (id, n, digest_a, digest_b, ranges) per document and (slice, counts) per task and slice of slots."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingler(k)
        counts = np.zeros(SLOTS, np.uint32)
        held: list[np.ndarray] = []
        size = 0
        names = ["id", "n", "digest_a", "digest_b", "ranges", "slice", "counts"]
        for batch in batches:
            sets = [make.hashes(t) for t in batch.column("text").to_pylist()]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(pairs[:, 0]),
                 pa.array(pairs[:, 1]), pa.array([histogram(s) if len(s) else None for s in sets], pa.binary()),
                 pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
            held += sets
            size += sum(map(len, sets))
            if size > COUNT_BUFFER:
                _count(counts, held)
                held, size = [], 0
        _count(counts, held)
        packed = [(i, _pack(counts[at:at + SLICE])) for i, at in enumerate(range(0, SLOTS, SLICE))
                  if counts[at:at + SLICE].any()]
        none = pa.nulls(len(packed), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.nulls(len(packed), pa.binary()), pa.array([i for i, _ in packed], pa.int32()),
             pa.array([c for _, c in packed], pa.binary())], names)

    return docs.select("id", "text").mapInArrow(
        run, "id long, n long, digest_a long, digest_b long, ranges binary, slice int, counts binary")


def _count(counts: np.ndarray, sets: list[np.ndarray]) -> None:
    if sets:
        np.add.at(counts, slots_of(np.concatenate(sets)), np.uint32(1))       # in place: a bincount takes 48 MB


def _pack(counts: np.ndarray) -> bytes:
    """A slice's counts in the narrowest integers that hold them; compressed."""
    most = int(counts.max())
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(counts.astype(f"<u{width}").tobytes())


def slot_ranks(counted: DataFrame) -> np.ndarray:
    """One byte per slot from rows (slice, counts): eight steps to a doubling of the slot's count over all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                own = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), f"<u{packed[0]}")
                if i not in sums:
                    sums[i] = np.zeros(SLICE, np.uint64)
                sums[i] += own
        ranks = [np.minimum(8 * np.log2(s + 1.0), 255).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(ranks, pa.binary())],
                                         ["slice", "ranks"])

    out = np.zeros(SLOTS, np.uint8)
    # a task sums its slices as they come; at most SLOTS bytes reach the driver
    for row in counted.select("slice", "counts").repartition("slice").mapInArrow(run, "slice int, ranks binary").collect():
        out[row["slice"] * SLICE:(row["slice"] + 1) * SLICE] = np.frombuffer(row["ranks"], np.uint8)
    return out


def prefixes(docs: DataFrame, k: int, threshold: int, ranks) -> DataFrame:
    """(shingle, digest_a, digest_b, n): each document's first shingles under the global order, by its set's digest.

    Rows of equal sets may come once or more often.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingler(k)
        rank = ranks.value
        seen: set[bytes] = set()
        for batch in batches:
            digests, shingles, sizes = [], [], []
            for text in batch.column("text").to_pylist():
                own = make.hashes(text)
                n = len(own)
                if not n:
                    continue
                digest = xxhash.xxh3_128_digest(own.tobytes())
                if digest in seen:
                    continue
                if len(seen) >= SEEN_DIGESTS:
                    seen.clear()
                seen.add(digest)
                take = prefix_size(n, threshold)
                digests.append(np.tile(np.frombuffer(digest, "<i8"), (take, 1)))
                shingles.append(own[np.lexsort((own, rank[slots_of(own)]))[:take]].view(np.int64))
                sizes.append(np.full(take, n, np.int32))
            if shingles:
                pairs = np.concatenate(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(shingles)), pa.array(pairs[:, 0]), pa.array(pairs[:, 1]),
                     pa.array(np.concatenate(sizes))], ["shingle", "digest_a", "digest_b", "n"])

    return docs.select("text").mapInArrow(run, "shingle long, digest_a long, digest_b long, n int")


def _by_cell(rows: DataFrame, work, schema: str) -> DataFrame:
    """``work(members)`` for each cell of ``rows`` (cell, id, grp, data); members are (id, grp, data), ids distinct.

    Cells are small and many, so a partition runs through its sorted cells instead of being grouped row by row.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members, out = None, {}, []
        for batch in batches:
            for cell, i, g, data in zip(*(batch.column(c).to_pylist() for c in ("cell", "id", "grp", "data"))):
                if cell != current:
                    out += [(current, *r) for r in work(list(members.values()))] if members else []
                    current, members = cell, {}
                members[i] = (i, g, data)
            if len(out) > 10_000:
                yield _rows(out)
                out = []
        out += [(current, *r) for r in work(list(members.values()))] if members else []
        yield _rows(out)

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:4]], ["cell", "a", "b", "c"])

    ordered = rows.select("cell", "id", "grp", "data").repartition("cell").sortWithinPartitions("cell", "id")
    names = schema.split(", ")
    return ordered.mapInArrow(run, "cell long, a long, b long, c long").toDF("cell", *names)


def hopeful(cells: DataFrame, histograms: DataFrame, threshold: int) -> DataFrame:
    """The rows of ``cells`` (cell, id, grp) that have a partner within reach."""
    def work(members: list[tuple]) -> list[tuple]:
        near = {x for i, others in within_reach([_counts(d) for _, _, d in members], threshold) for x in (i, *others.tolist())}
        return [(*members[i][:2], 0) for i in sorted(near)]

    rows = cells.join(histograms.select("id", F.col("ranges").alias("data")), "id")
    return _by_cell(rows, work, "id, grp, none").select("cell", "id", "grp")


def hopeful_across(cells: DataFrame, histograms: DataFrame, threshold: int) -> DataFrame:
    """The rows of ``cells`` (cell, id, grp, shingles) that have a partner of another ``grp`` within reach which shares
    one of their ``shingles``."""
    def work(members: list[tuple]) -> list[tuple]:
        shingles = [frozenset(d["shingles"]) for _, _, d in members]
        groups = np.array([g for _, g, _ in members])
        near = set()
        for i, others in within_reach([_counts(d["ranges"]) for _, _, d in members], threshold):
            met = [j for j in others[groups[others] != groups[i]].tolist() if not shingles[i].isdisjoint(shingles[j])]
            near.update(met, [i] if met else [])
        return [(*members[i][:2], 0) for i in sorted(near)]

    rows = cells.join(histograms.select("id", "ranges"), "id")
    rows = rows.select("cell", "id", "grp", F.struct("ranges", "shingles").alias("data"))
    return _by_cell(rows, work, "id, grp, none").select("cell", "id", "grp")


class Found(NamedTuple):
    """What the search for components leaves: (id, text), documents' sets, classes and linked classes' components."""
    base: DataFrame
    sets: DataFrame
    classes: DataFrame
    parts: DataFrame


def _with_sets(cells: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``cells`` (cell, id, grp) with each member's shingles as ``data``."""
    members = cells.select("id").distinct()
    side = F.broadcast(members) if members.count() <= BROADCAST_IDS else members
    sets = docs.join(side, "id", "left_semi")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingler(k)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([make.hashes(t).tobytes() for t in batch.column("text").to_pylist()],
                                              pa.binary())], ["id", "data"])

    return cells.join(sets.select("id", "text").mapInArrow(hashed, "id long, data binary"), "id")


def search_cells(cells: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """(a, b, overlap): connecting links of every cell; ``cells`` has (cell, id, grp), a row per member.

    ``grp`` numbers members known to be connected, or equals the id.
    """
    def work(members: list[tuple]) -> list[tuple]:
        ids = [i for i, _, _ in members]
        links = search([np.frombuffer(d, np.uint64) for _, _, d in members], threshold, [g for _, g, _ in members])
        return [(ids[i], ids[j], c) for i, j, c in links]

    return _by_cell(_with_sets(cells, docs, k), work, "a, b, overlap").select("a", "b", "overlap")


def all_links(sets: list[np.ndarray], sides: list[int], threshold: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(i, others, overlaps): every link of the sets, once; only those across, where there are two sides."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order])
    side = np.array(sides)[order]
    two = bool((side != side[0]).any())
    values, local, counts = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    ends = np.concatenate([[0], np.cumsum(counts)])
    # the inverted lists, one after the other: sets by their place in the order of sizes
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(local, kind="stable")]
    index = {v: holders[ends[v]:ends[v + 1]] for v in np.flatnonzero(counts > 1).tolist()}
    at = np.concatenate([[0], np.cumsum(sizes)])
    for p, i in enumerate(order.tolist()):
        allowed = 100 * sizes[:p] >= threshold * sizes[p]          # smaller sets that can reach the threshold
        if two:
            allowed &= side[:p] != side[p]
        if not allowed.any():
            continue
        needed = overlap_needed(int(sizes[:p][allowed].min()), int(sizes[p]), threshold)
        found = [(q, c) for q, c in divide_skip(local[at[p]:at[p + 1]], index, needed, allowed)
                 if c >= overlap_needed(int(sizes[q]), int(sizes[p]), threshold)]
        if found:
            others, overlaps = np.array(found, np.int64).T
            yield i, order[others], overlaps


def _links(found: Found, k: int, threshold: int, count: bool) -> DataFrame:
    """(a, b, overlap), a < b, of all linked classes, or with ``count`` (id, n_links) of those with a link."""
    weighed = found.parts.join(found.classes.select(F.col("class_id").alias("node"), "n"), "node")
    sizes = weighed.groupBy("component").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / LINK_BLOCK, 2 * F.sum("n") / CELL_SHINGLES)).cast("int").alias("blocks"))
    placed = found.parts.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = other.select(F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
                         F.col("node").alias("id"), (F.col("block") > F.col("other")).cast("long").alias("grp"))
    cells = written(cells, "link-cells")

    def work(members: list[tuple]) -> list[tuple]:
        ids = [i for i, _, _ in members]
        links = all_links([np.frombuffer(d, np.uint64) for _, _, d in members], [g for _, g, _ in members], threshold)
        if not count:
            return [(min(ids[i], ids[j]), max(ids[i], ids[j]), c)
                    for i, others, overlaps in links for j, c in zip(others.tolist(), overlaps.tolist())]
        number = np.zeros(len(ids), np.int64)
        for i, others, _ in links:
            number[i] += len(others)
            number[others] += 1
        return [(i, n, 0) for i, n in zip(ids, number.tolist()) if n]

    got = _by_cell(_with_sets(cells, found.base, k), work, "a, b, overlap").select("a", "b", "overlap")
    return got.groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("n_links")) if count else got


def _part(order: WindowSpec, most: int = CELL) -> Column:
    """The cell of a pivot's partner: at most ``most`` of them, and about CELL_SHINGLES shingles (of ``n`` each)."""
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    return F.struct(F.floor((F.row_number().over(order) - 1) / most), F.floor(before / CELL_SHINGLES))


def _size_partner(threshold: int, *order: str, among: Column | None = None) -> Column:
    """Whether another row of the shingle (one of ``among``) has a size ``n`` that allows a link; ``order`` breaks ties."""
    size = F.col("n") if among is None else F.when(among, F.col("n"))
    ends = Window.unboundedPreceding, -1
    # the nearest smaller and the nearest larger size, each from the rows before in one order
    below = F.max(size).over(Window.partitionBy("shingle").orderBy("n", *order).rowsBetween(*ends))
    above = F.min(size).over(Window.partitionBy("shingle").orderBy(F.desc("n"), *map(F.desc, order)).rowsBetween(*ends))
    return F.coalesce(100 * below >= threshold * F.col("n"), F.lit(False)) | F.coalesce(
        100 * F.col("n") >= threshold * above, F.lit(False))


def _open_shingles(shared: DataFrame, parts: DataFrame, threshold: int) -> DataFrame:
    """(largest, id, n, grp, main, shingles): classes of shingles that several components share, pivots aside.

    A class comes once for each component that is the largest of some of its shingles, with those shingles.
    """
    placed = (shared.where("m > 2 and id <> pivot").join(parts, F.col("id") == F.col("node"), "left")
              .select("shingle", "id", "n", F.coalesce("component", "id").alias("grp")))
    open_ = placed.groupBy("shingle").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).where("lo <> hi")
    rest = placed.join(open_.select("shingle"), "shingle")
    # pairs within the shingle's largest component need no search
    largest = (rest.groupBy("shingle", "grp").agg(F.count(F.lit(1)).alias("members")).groupBy("shingle")
               .agg(F.max_by("grp", F.struct("members", "grp")).alias("largest")))
    rest = rest.join(largest, "shingle").withColumn("main", F.col("grp") == F.col("largest"))
    rest = rest.withColumn("partner", F.when(F.col("main"), _size_partner(threshold, "id", among=~F.col("main")))
                           .otherwise(_size_partner(threshold, "id"))).where("partner")
    return rest.groupBy("largest", "id", "n", "grp", "main").agg(F.collect_list("shingle").alias("shingles"))


def _components(docs: DataFrame, k: int, threshold: int, id_col: str, text_col: str) -> Found:
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # the texts are read three times: for the sets' digests, for their prefixes, and those of the cells for their sets
    first = written(shingle_sets(base, k), "shingle-sets")
    sets = first.where("n is not null").select("id", "n", "digest_a", "digest_b")
    sent = spark.sparkContext.broadcast(slot_ranks(first.where("slice is not null")))

    usable = sets.where("id is not null and n > 0")
    classes = written(usable.groupBy("digest_a", "digest_b", "n").agg(F.min("id").alias("class_id")), "classes")
    grouped = Window.partitionBy("shingle")
    keys = ["digest_a", "digest_b", "n"]
    # one shuffle, on shingles, serves the distinct rows as well as the windows
    shared = prefixes(base.where("id is not null"), k, threshold, sent).repartition("shingle").distinct()
    # the nearest sizes, one before and one after
    by_size = Window.partitionBy("shingle").orderBy("n", "digest_a", "digest_b")
    shared = (shared.withColumns({"below": F.lag("n").over(by_size), "above": F.lead("n").over(by_size)})
              .where((100 * F.col("below") >= threshold * F.col("n")) | (100 * F.col("n") >= threshold * F.col("above")))
              .withColumn("m", F.count(F.lit(1)).over(grouped)).drop("below", "above")
              .join(classes, keys).withColumnRenamed("class_id", "id"))
    shared = written(shared.select("shingle", "id", "n", "m", F.min("id").over(grouped).alias("pivot")),
                     "shared-prefixes")
    histograms = (first.select("id", "n", "ranges").join(classes.select(F.col("class_id").alias("id")), "id", "left_semi")
                  .dropDuplicates(["id"]))

    # pivots with their classes, a bounded cell at a time
    sizes = shared.groupBy("id").agg(F.first("n").alias("pivot_n")).withColumnRenamed("id", "pivot")
    spokes = shared.where("id <> pivot").select("pivot", "id", "n").distinct().join(sizes, "pivot")
    spokes = spokes.where(F.least("n", "pivot_n") * 100 >= threshold * F.greatest("n", "pivot_n"))
    spokes = spokes.select("pivot", "id", _part(Window.partitionBy("pivot").orderBy("n", "id")).alias("part"))
    cells = spokes.select(F.xxhash64("pivot", "part").alias("cell"), "id").unionAll(
        spokes.select(F.xxhash64("pivot", "part").alias("cell"), F.col("pivot").alias("id")).distinct())
    cells = written(hopeful(cells.withColumn("grp", F.col("id")), histograms, threshold), "cells")
    links = written(search_cells(cells, base, k, threshold).select("a", "b"), "links")
    parts = written(connected_components(links, "a", "b"), "components")

    # classes that aren't all connected, and had pairs without their pivot
    rest = _open_shingles(shared, parts, threshold)
    block = _part(Window.partitionBy("largest", "main").orderBy("n", "id"), BLOCK)
    rest = written(rest.withColumn("block", F.struct("main", block.alias("part"))).drop("main"), "open-shingles")
    # only pairs of blocks whose sizes can reach the threshold
    blocks = rest.groupBy("largest", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    side = lambda x: blocks.select("largest", *(F.col(c).alias(f"{c}_{x}") for c in ("block", "lo", "hi")))
    pairs = side("i").join(side("j"), "largest").where(
        "block_i <= block_j and not (block_i.main and block_j.main)").where(
        (F.col("hi_i") * 100 >= threshold * F.col("lo_j")) & (F.col("hi_j") * 100 >= threshold * F.col("lo_i")))
    cells = pairs.select("largest", F.xxhash64("largest", "block_i", "block_j").alias("cell"),
                         F.explode(F.array_distinct(F.array("block_i", "block_j"))).alias("block"))
    cells = cells.join(rest, ["largest", "block"]).select("cell", "id", "grp", "shingles")
    cells = written(hopeful_across(cells, histograms, threshold), "more-cells")
    more = written(search_cells(cells, base, k, threshold).select("a", "b"), "more-links")
    if not more.isEmpty():
        parts = written(connected_components(links.unionAll(more), "a", "b"), "components")

    return Found(base, sets, classes, parts)


def _membership(found: Found, counts: DataFrame | None = None) -> DataFrame:
    sets, own = found.sets, F.col("class_id")
    classes = found.classes.join(found.parts, own == F.col("node"), "left")
    columns = ["digest_a", "digest_b", F.col("n").alias("n_class"), "class_id",
               F.coalesce("component", "class_id").alias("component_id")]
    if counts is not None:
        classes = classes.join(counts, own == counts["id"], "left")
        columns.append(F.coalesce("n_links", F.lit(0)).alias("n_links"))
    classes = classes.select(*columns)
    out = sets.join(classes, (sets["digest_a"] == classes["digest_a"]) & (sets["digest_b"] == classes["digest_b"])
                    & (sets["n"] == classes["n_class"]) & sets["id"].isNotNull(), "left")
    # the empty set's rows stand alone
    kept = [F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("class_id", "id").alias("class_id"),
            F.coalesce("component_id", "id").alias("component_id")]
    return out.select(*kept, *([] if counts is None else [F.coalesce("n_links", F.lit(0)).alias("n_links")]))


def join(docs: DataFrame, k: int = 3, threshold: int = 90, id_col: str = "doc_id", text_col: str = "text",
         count_links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every document; ``threshold`` in hundredths.

    ``class_id`` is the smallest id with an equal set, ``component_id`` the smallest id reachable by links.
    ``count_links`` adds ``n_links``: how many other classes its class is linked with.
    """
    found = _components(docs, k, threshold, id_col, text_col)
    return _membership(found, _links(found, k, threshold, count=True) if count_links else None)


def linked(docs: DataFrame, k: int = 3, threshold: int = 90, id_col: str = "doc_id",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """((class_a, class_b, overlap) of all linked classes, class_a < class_b; what ``join`` returns)."""
    found = _components(docs, k, threshold, id_col, text_col)
    links = _links(found, k, threshold, count=False)
    return links.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"), "overlap"), _membership(found)


def keep_one(docs: DataFrame, k: int = 5, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each component; same columns.

    Rows that share the kept id all stay; so do rows without an id.
    """
    found = join(docs, k, threshold, id_col, text_col)
    gone = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "copies")
    side = F.broadcast(gone) if gone.count() <= 1_000_000 else gone
    rows = docs.select(as_row(docs), F.col(id_col).cast("long").alias("gone"))
    return rows.join(side, "gone", "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
