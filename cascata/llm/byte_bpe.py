"""Byte-level BPE encoding and decoding by a two-tier lookup.

Every match of the public pre-token pattern is looked up whole in a minimal
perfect hash over the vocabulary; only misses are merged, by a heap of
adjacent pairs over a doubly linked list of bytes (lowest rank first, ties to
the left), which is O(n log n) for a pre-token of n bytes.

Rows are independent: a map over Arrow batches, no shuffle, nothing kept
between tasks but a bounded memo, so a lost executor costs only its tasks.

Defined results: a null or empty text has no ids and decodes to no bytes;
repeated rows give repeated rows; an empty table gives none; other columns of
the input are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata.llm.chunk_memo import ChunkMemo
from cascata.llm.common import kept, prepare

_MASK = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys, n slots, one displacement per bucket of about 2 keys.

    Large buckets are placed first by trying displacements; buckets of one key
    store their slot itself (as -slot - 1).  A lookup hashes once and compares
    one key.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        n = self.n = len(keys)
        self.buckets = max(1, n // 2)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            groups[h % self.buckets].append(i)
        for b in sorted((b for b, g in enumerate(groups) if len(g) > 1), key=lambda b: -len(groups[b])):
            d = 0
            while True:
                slots = {self._slot(hashes[i], d) for i in groups[b]}
                if len(slots) == len(groups[b]) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
            self.shift[b] = d
            for i in groups[b]:
                self._put(self._slot(hashes[i], d), keys[i], values[i])
        free = (s for s, k in enumerate(self.keys) if k is None)
        singles = [(b, g[0], s) for (b, g), s in zip(((b, g) for b, g in enumerate(groups) if len(g) == 1),
                                                     list(free))]
        for b, i, s in singles:
            self.shift[b] = -s - 1
            self._put(s, keys[i], values[i])

    def _slot(self, h: int, d: int) -> int:
        x = (h ^ (d * 0x9E3779B97F4A7C15)) & _MASK
        x = ((x ^ (x >> 31)) * 0xD6E8FEB86659FD93) & _MASK
        return ((x >> 32) * self.n) >> 32

    def _put(self, slot: int, key: bytes, value: int) -> None:
        self.keys[slot] = key
        self.values[slot] = value

    def get(self, key: bytes) -> int | None:
        if not self.n:
            return None
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        slot = -d - 1 if d < 0 else self._slot(h, d)
        return self.values[slot] if self.keys[slot] == key else None


NO_RANK = 1 << 40


def merge_bytes(piece: bytes, ranks: dict[bytes, int], byte_pairs: list[int]) -> list[int]:
    """Ids of one pre-token that is no vocabulary entry: merge the adjacent pair of lowest rank until none is left.

    ``byte_pairs`` has the rank of each pair of bytes (or ``NO_RANK``).  Heap entries are rank * 2^k + start in one
    integer, so equal ranks come out leftmost first; a rank is the merged part's id.
    """
    n = len(piece)
    bits = n.bit_length()
    mask = (1 << bits) - 1
    limit = NO_RANK << bits
    get, push, pop = ranks.get, heapq.heappush, heapq.heappop
    ends = list(range(1, n + 1))            # ends[i]: end of the part that starts at i
    before = list(range(-1, n))
    # the live heap entry of the pair that starts at i
    pair = [byte_pairs[a << 8 | b] << bits | i for i, (a, b) in enumerate(zip(piece, piece[1:]))]
    heap = [entry for entry in pair if entry < limit]
    pair.append(-1)
    ids: dict[int, int] = {}                # start -> id of a merged part
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        i = entry & mask
        if pair[i] != entry:
            continue
        j = ends[i]
        ids[i] = entry >> bits
        pair[j] = -1
        end = ends[i] = ends[j]
        before[end] = i
        r = get(piece[i:ends[end]]) if end < n else None
        if r is None:
            pair[i] = -1
        else:
            pair[i] = entry = r << bits | i
            push(heap, entry)
        k = before[i]
        if k >= 0:
            r = get(piece[k:end])
            if r is None:
                pair[k] = -1
            else:
                pair[k] = entry = r << bits | k
                push(heap, entry)
    out, i = [], 0
    while i < n:
        end = ends[i]
        out.append(ids[i] if end - i > 1 else ranks[piece[i:end]])
        i = end
    return out


class ByteBpe:
    """Encoder and decoder of one vocabulary of ``base64 rank`` lines."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
        self.byte_pairs = [self.ranks.get(bytes((a, b)), NO_RANK) for a in range(256) for b in range(256)]
        self.table = {r: t for t, r in self.ranks.items()}
        self.whole = PerfectHash(list(self.ranks), list(self.ranks.values()))
        self.find = regex.compile(pattern).findall
        self.memo = ChunkMemo(lambda cuts: [self.cut(c) for c in cuts])

    def cut(self, cut: str) -> bytes:
        ids: list[int] = []
        for piece in self.find(cut):
            raw = piece.encode()
            known = self.whole.get(raw)
            if known is not None:
                ids.append(known)
            else:
                ids.extend(merge_bytes(raw, self.ranks, self.byte_pairs))
        return array("I", ids).tobytes()

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        return self.memo.texts(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def coder(path: str, pattern: str) -> ByteBpe:
    """One coder per Python worker and vocabulary."""
    return kept(("byte_bpe", path, pattern), lambda: ByteBpe(path, pattern))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids are little-endian unsigned 32-bit integers in one binary."""
    prepare(docs.sparkSession)
    dtype = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            ids = bpe.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dtype}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encode``'s rows with ``decoded`` (bytes) instead of ``ids``."""
    dtype = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            raw = [bpe.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"),
                                              pa.array(raw, pa.binary())], ["doc_id", "n_tokens", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(run, f"doc_id {dtype}, n_tokens long, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids, in one pass over the rows."""
    prepare(docs.sparkSession)
    dtype = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in batches:
            ids = bpe.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                 pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dtype}, n_tokens long, ids_sha256 string, decoded_sha256 string")
