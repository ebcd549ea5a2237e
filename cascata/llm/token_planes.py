"""Token ids as bit-plane shuffled, zstandard-compressed chunks with an index.

File format: a Parquet folder of chunk rows, written and committed by Spark
(so it works on every store Spark can write, and lost or repeated tasks leave
no trace).  One row holds a run of whole documents in ascending order:

    shard, chunk        ascending with the document order
    first               ids of the same shard before this chunk
    n_ids, width        ids in the chunk, planes kept (the all-zero high ones are dropped)
    plane_sizes         compressed bytes of each plane, i.e. the index into ``payload``
    payload             the planes, each compressed by zstandard
    doc_ids, doc_sizes  the chunk's documents and their numbers of ids (the document index)

Ids are cut into blocks of ``BLOCK`` ids; each block is transposed so that bit
b (or byte b) of all its ids lies together, and plane b of the chunk is the
concatenation of its blocks' planes.  A chunk is self-contained: reading one
document reads one row.

Order: shards are ranges of the document id whose boundaries come from a
quantile sketch of the id column alone, so the texts are tokenized once and
only their ids (2 bytes each while the vocabulary allows) are shuffled.  A
document's global start is the sum of the earlier shards' totals (one row per
shard) plus its place in the shard.

Defined results: a null or empty text has only the end id; null document ids
come first; rows that repeat an id are ordered by their ids; an empty table
gives an empty file; other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cascata.llm.chunk_memo import ChunkMemo
from cascata.llm.common import gathered, kept, prepare
from cascata.operators.prefix import BUCKET, bucket_boundaries, with_bucket

BLOCK = 4096
CHUNK_IDS = 1 << 17
# Documents per shard: bounds a shard's share of the order, not its result.
ROWS_PER_SHARD = 200_000
# New words that go through the library as one string.
RUN_WORDS = 500
# How byte-level vocabularies write a space and a line break.
_SPACE, _BREAK = "\u0120", "\u010a"
# Bytes of rows that are encoded together: words repeat, and each different one is looked up once.
GATHER_BYTES = 4 << 20
CHUNK_SCHEMA = ("shard int, chunk int, first long, n_ids long, width int, planes string, plane_sizes array<int>, "
                "payload binary, doc_ids array<long>, doc_sizes array<long>")


class LibraryCoder:
    """The tokenizers library's encoder behind a bounded memo of chunks; gives 2 or 4 bytes per id.

    A call of the library costs more than a word's merges, so words are encoded ``RUN_WORDS`` to a string, each behind
    its own space or, if it has none, a line break that is dropped again: the pattern cuts the string before each of
    these, and an id whose piece starts with a space or is the line break is the first of a word.
    """

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True     # special strings inside a text are ordinary text
        self.dtype = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        pieces = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(pieces.values(), default=0) + 1, bool)
        self.opens[[i for piece, i in pieces.items() if piece[:1] == _SPACE or piece == _BREAK]] = True
        self.memo = ChunkMemo(self.cuts)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def cuts(self, cuts: list[str]) -> list[bytes]:
        code = "H" if self.dtype == "<u2" else "I"
        out = [b""] * len(cuts)
        alone, words, bare = [], [], []
        for i, c in enumerate(cuts):
            parts = c.split()
            spaces = len(c) - len(parts[0]) if len(parts) == 1 else 2
            if not spaces or spaces == 1 and c[0] == " ":
                words.append(i)
                bare.append(not spaces)
            else:
                alone.append(i)
        for at in range(0, len(words), RUN_WORDS):
            run, dropped = words[at:at + RUN_WORDS], bare[at:at + RUN_WORDS]
            text = "".join(["\n" + cuts[i] if d else cuts[i] for i, d in zip(run, dropped)])
            raw = array(code, self.ids([text])[0]).tobytes()
            ids = np.frombuffer(raw, self.dtype)
            firsts = np.flatnonzero(self.opens[ids])
            if len(firsts) != len(run):     # a vocabulary that has no such pieces
                alone += run
                continue
            size = ids.itemsize
            starts, ends = ((firsts + dropped) * size).tolist(), [*(firsts[1:] * size).tolist(), len(raw)]
            for i, a, b in zip(run, starts, ends):
                out[i] = raw[a:b]
        for i, ids in zip(alone, self.ids([cuts[i] for i in alone])):
            out[i] = array(code, ids).tobytes()
        return out


def library_coder(path: str) -> LibraryCoder:
    return kept(("token_planes", path), lambda: LibraryCoder(path))


def split_planes(ids: np.ndarray, planes: str = "bit") -> tuple[int, list[bytes]]:
    """(width, planes): blocks of ``BLOCK`` ids transposed into bit or byte planes, high planes of zeros dropped."""
    n = len(ids)
    top = int(ids.max()) if n else 0
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, "<u4")
    padded[:n] = ids
    raw = padded.view(np.uint8).reshape(blocks, BLOCK, 4)
    if planes == "byte":
        width = (top.bit_length() + 7) // 8
        return width, [raw[:, :, b].tobytes() for b in range(width)]
    width = top.bit_length()
    out = []
    for b in range(width):
        if b % 8 == 0:
            byte = np.ascontiguousarray(raw[:, :, b // 8])
        out.append(np.packbits(byte & (1 << b % 8), axis=1, bitorder="little").tobytes())
    return width, out


def join_planes(n: int, parts: list[bytes], planes: str = "bit") -> np.ndarray:
    """``split_planes`` undone: the chunk's n ids."""
    blocks = -(-n // BLOCK)
    raw = np.zeros((blocks, BLOCK, 4), np.uint8)
    if planes == "byte":
        for b, part in enumerate(parts):
            raw[:, :, b] = np.frombuffer(part, np.uint8).reshape(blocks, BLOCK)
    else:
        for b in range(0, len(parts), 8):
            byte = np.zeros((blocks, BLOCK), np.uint8)
            for k, part in enumerate(parts[b:b + 8]):
                bits = np.frombuffer(part, np.uint8).reshape(blocks, BLOCK // 8)
                byte |= np.unpackbits(bits, axis=1, bitorder="little") << k
            raw[:, :, b // 8] = byte
    return raw.reshape(-1, 4).view("<u4").reshape(-1)[:n]


def encode(docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, packed): the library's ids of every whole text and the end id, 2 or 4 bytes each."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_coder(path)
        end = np.array([end_id], coder.dtype).tobytes()
        size = len(end)
        for batch in gathered(batches, GATHER_BYTES):
            ids = [x + end for x in coder.memo.texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_bucket"), pa.array([len(x) // size for x in ids], pa.int64()),
                 pa.array(ids, pa.binary())], ["doc_id", "shard", "n_tokens", "packed"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bounds = bucket_boundaries(rows, "doc_id", ROWS_PER_SHARD,
                               int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = with_bucket(rows, "doc_id", bounds).select("doc_id", "text", F.col(BUCKET).cast("int").alias("_bucket"))
    return rows.mapInArrow(run, "doc_id long, shard int, n_tokens long, packed binary")


def write(encoded: DataFrame, folder: str, planes: str = "bit", level: int = 3) -> None:
    """Write ``encode``'s rows in ascending document order to ``folder``."""
    spark = encoded.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=level)
        shard = chunk = first = 0
        held: list[np.ndarray] = []
        docs: list[int | None] = []
        total = 0

        def flush() -> pa.RecordBatch:
            nonlocal chunk, first, total, held, docs
            ids = np.concatenate(held).astype("<u4")
            width, parts = split_planes(ids, planes)
            pressed = [press.compress(p) for p in parts]
            row = {"shard": shard, "chunk": chunk, "first": first, "n_ids": len(ids), "width": width,
                   "planes": planes, "plane_sizes": [len(p) for p in pressed], "payload": b"".join(pressed),
                   "doc_ids": docs, "doc_sizes": [len(h) for h in held]}
            chunk, first, total, held, docs = chunk + 1, first + len(ids), 0, [], []
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        for batch in batches:
            for s, d, n, raw in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "n_tokens", "packed"))):
                if held and (s != shard or total >= CHUNK_IDS):
                    yield flush()
                if s != shard:
                    shard, chunk, first = s, 0, 0
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4")
                held.append(ids)
                docs.append(d)
                total += n
        if held:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (encoded.repartition(parts, "shard")
            .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "packed"))
    rows.mapInArrow(run, CHUNK_SCHEMA).write.option("compression", "none").parquet(folder)


_ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                    ("width", pa.int32()), ("planes", pa.string()), ("plane_sizes", pa.list_(pa.int32())),
                    ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64()))])


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(CHUNK_SCHEMA).parquet(folder)


def chunk_ids(n: int, sizes: list[int], payload: bytes, planes: str) -> np.ndarray:
    """One chunk row's ids."""
    open_ = zstandard.ZstdDecompressor()
    parts, at = [], 0
    for size in sizes:
        parts.append(open_.decompress(payload[at:at + size]))
        at += size
    return join_planes(n, parts, planes)


def read(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; with ``digest``, ids_crc32 instead of ids."""
    chunks = read_chunks(spark, folder)
    # one row per shard; the window over them runs in one task
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = totals.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shard_start"))
    last = "ids_crc32" if digest else "ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = chunk_ids(row["n_ids"], row["plane_sizes"], row["payload"], row["planes"])
                sizes = np.array(row["doc_sizes"], np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                raw = ids.tobytes()
                docs = [raw[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"] + row["shard_start"]),
                     pa.array(sizes), pa.array([zlib.crc32(x) for x in docs], pa.int64()) if digest
                     else pa.array(docs, pa.binary())], ["doc_id", "start", "n_tokens", last])

    rows = (chunks.join(before, "shard")
            .select("first", "n_ids", "planes", "plane_sizes", "payload", "doc_ids", "doc_sizes", "shard_start"))
    return rows.mapInArrow(run, f"doc_id long, start long, n_tokens long, {last} {'long' if digest else 'binary'}")
