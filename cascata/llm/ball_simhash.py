"""SimHash near-duplicates by meet-in-the-middle ball hashing.

1. A map over whole texts hashes every word shingle (XXH64 of its UTF-8 bytes,
   repeats included) and sets a fingerprint bit where more than half of the
   hashes have it.  Rows of (id, fingerprint) are written once; from here on a
   fingerprint that many documents share is one row.
2. Two fingerprints that differ in at most ``radius`` bits have a word half-way
   between them: every distinct fingerprint emits all variants within
   ceil(radius / 2) bits of itself (65 for a radius of 2).
3. Shuffled on variants, fingerprints that share one are neighbours in sort
   order; each is paired with the earlier ones of its variant.  A variant is
   near so few words (65) that its group is bounded whatever the data hold.
   Pairs met under several variants are one, and are verified by their
   differing bits.
4. Links between fingerprints become components; a document's component is the
   smallest id in it.

Defined results: A-Z is folded, words are runs of anything but blanks and
U+0009 to U+000D; a text of fewer words than a shingle is one shingle, a null,
empty or blank text has fingerprint zero and is linked like any other; every
row of the table is returned, repeated rows as often as they come; rows with a
null id get a fingerprint, take no part in links and have a null component; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cascata.llm.common import prepare, written
from cascata.llm.components import connected_components

SEED = 42
BITS = 64
PIECE = 1 << 16         # hashes of a text that are counted at once
HOT_ROWS = 1_000        # a fingerprint of fewer rows is never broadcast with its component,
MOST_HOT = 100_000      # nor are more fingerprints than this


def shingle_hashes(text: bytes, k: int) -> Iterator[np.ndarray]:
    """XXH64 of every k-word shingle of a UTF-8 text, repeats included, some at a time."""
    words = text.lower().split()        # bytes: A-Z only, and the six ASCII blanks
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - k + 1)
    last = ends[min(k, len(words)) - 1:]
    for at in range(0, n, PIECE):
        spans = zip(starts[at:min(at + PIECE, n)].tolist(), last[at:at + PIECE].tolist())
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(text: bytes, k: int) -> int:
    """The 64-bit SimHash of a text, unsigned."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, k):
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print) of every document, the fingerprint as a signed long."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t or b"", k) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return base.mapInArrow(run, "doc_id long, print long")


def ball(radius: int) -> list[int]:
    """Every word of at most ``radius`` set bits, as signed longs: what to flip."""
    words = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return [w - (1 << BITS) if w >> (BITS - 1) else w for w in words]


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b, distance): every pair of different values of ``print`` at most ``radius`` bits apart, once."""
    if not 1 <= radius <= 4:
        raise ValueError("radius must be 1 to 4: beyond, a ball has more than 2,081 words")
    flips = F.explode(F.array(*[F.lit(w) for w in ball((radius + 1) // 2)]))
    near = (prints.select("print").distinct().select("print", flips.alias("flip"))
            .select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("variant")))
    of_variant = Window.partitionBy("variant").orderBy("print")
    before = F.lag("print").over(of_variant)
    after = F.lead("print").over(of_variant)
    met = (near.withColumn("before", before).withColumn("after", after)
           .where("before is not null or after is not null").select("variant", "print"))
    earlier = F.collect_list("print").over(of_variant.rowsBetween(Window.unboundedPreceding, -1))
    pairs = met.withColumn("earlier", earlier).select(F.explode("earlier").alias("a"), F.col("print").alias("b")).distinct()
    return (pairs.withColumn("distance", F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).cast("int"))
            .where(F.col("distance") <= radius))


def _hex(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def near_duplicates(docs: DataFrame, k: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    prints = written(fingerprints(docs, k, id_col, text_col), "fingerprints")
    classes = (prints.where("doc_id is not null").groupBy("print")
               .agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")))
    classes = written(classes, "fingerprint-classes")
    found = links(classes, radius)
    for side in ("a", "b"):         # from here on a fingerprint is its smallest id
        found = found.join(classes.select(F.col("print").alias(side), F.col("least").alias(f"least_{side}")), side)
    parts = connected_components(written(found.select("least_a", "least_b"), "fingerprint-links"), "least_a", "least_b")
    named = classes.join(parts, F.col("least") == F.col("node"), "left").select(
        "print", "copies", F.coalesce("component", "least").alias("component_id"))
    return _attached(prints, written(named, "fingerprint-components")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def _attached(prints: DataFrame, named: DataFrame) -> DataFrame:
    """``prints`` with the component of its fingerprint, null where the id is null.

    Fingerprints of many rows, ``MOST_HOT`` at most, are broadcast; the others, none with more than a small share of
    all rows, meet their component by a shuffle.
    """
    rows = named.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = F.col("copies") >= max(HOT_ROWS, rows // MOST_HOT)
    held = prints.where("doc_id is not null")
    often = F.broadcast(named.where(hot).select("print", "component_id"))
    return (held.join(often, "print").select("doc_id", "print", "component_id")
            .unionAll(held.join(often, "print", "left_anti").join(named.where(~hot), "print")
                      .select("doc_id", "print", "component_id"))
            .unionAll(prints.where("doc_id is null").select("doc_id", "print", F.lit(None).cast("long"))))
