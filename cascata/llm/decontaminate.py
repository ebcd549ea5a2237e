"""Benchmark decontamination with DataFrame operations only.

Every window of ``n`` consecutive benchmark words (a shorter item is one
window) is hashed and kept with its words; the set of windows is broadcast
while it has at most ``BROADCAST_WINDOWS`` rows, which is counted first, and
joined by shuffle beyond.  Every window of every document is hashed in one
generated stage (scan, split, explode of positions, hash, hash lookup), so
only rows that hit leave it; a hit is verified word for word.

Hits of one document are bounded by its own words; they are grouped by
document after the broadcast lookup, so a passage that a third of the
documents share spreads over those documents.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower
case.  Defined results: a null or empty text has no words and no hit; a
benchmark without words leaves everything clean; repeated benchmark items
count by their id; null item ids count as none; repeated documents that share
an id are judged row by row (rows are numbered inside); an empty table gives
none; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.llm.common import as_row, written

WINDOW = 13
# About 300 bytes a window: 200 MB at most is sent to an executor.
BROADCAST_WINDOWS = 500_000
# About 40 bytes a row.
BROADCAST_ROWS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """Array of a text's words in their own case; empty for a null text."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS), "")


def folded(text: Column) -> Column:
    """The words after full lower-casing, a coarser form than A-Z only, and much cheaper: it only picks candidates.

    Lower-casing turns no word character into a separator, so words keep their numbers.  A capital sigma, the one
    letter whose lower case depends on what is around it, separators too, is replaced first: equal words fold equally.
    """
    return split_words(F.lower(F.replace(text.cast("string"), F.lit("\u03a3"), F.lit("\u03c3"))))


def exact(words: Column) -> Column:
    """Words with A-Z in lower case, joined by spaces (no word holds one): the form in which windows are equal."""
    return F.translate(F.array_join(words, " "), UPPER, LOWER)


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW, id_col: str = "item_id", text_col: str = "text"
                      ) -> DataFrame:
    """(size, hash, window, items): distinct windows and the sorted distinct ids of the items that hold them."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), split_words(F.col(text_col)).alias("w"),
                            folded(F.col(text_col)).alias("f"))
    rows = rows.where(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(n)))
    rows = rows.select("item", "size", "w", "f",
                       F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("p"))
    rows = rows.select("item", "size", exact(F.slice("w", F.col("p"), F.col("size"))).alias("window"),
                       F.xxhash64(F.slice("f", F.col("p"), F.col("size"))).alias("hash"))
    return rows.groupBy("size", "hash", "window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame | None:
    """(doc, p, size, items) of each verified window occurrence, None without windows.

    ``docs`` has doc (any key), w (words) and f (their folded form).
    """
    known = windows.agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("size")).alias("sizes")).first()
    if known["n"] > BROADCAST_WINDOWS:
        return _shuffled_hits(docs, windows, known["sizes"])
    side = F.broadcast(windows)
    found = None
    for size in known["sizes"]:
        # one pass per window size that occurs: at most n, and items shorter than n words are rare
        at = docs.where(F.size("w") >= size).select(
            "doc", "w", "f", F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("p"))
        at = at.select("doc", "p", "w", F.xxhash64(F.slice("f", F.col("p"), F.lit(size))).alias("hash"))
        own = side.where(F.col("size") == size).drop("size")
        # between: an equality would become a join key and be computed for every position
        same = exact(F.slice("w", F.col("p"), F.lit(size))).between(F.col("window"), F.col("window"))
        hit = at.join(own, "hash").where(same).select("doc", "p", F.lit(size).alias("size"), "items")
        found = hit if found is None else found.unionAll(hit)
    return found


def _shuffled_hits(docs: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """``hits`` of more windows than are broadcast: only (doc, size, p, hash) of each position is shuffled, in one scan
    for all sizes; the words of documents with a candidate are fetched to verify it."""
    def positions(size: Column) -> Column:
        last = F.size("w") - size + 1
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda p: F.struct(
            size.alias("size"), p.alias("p"), F.xxhash64(F.slice("f", p, size)).alias("hash"))))

    at = docs.select("doc", F.explode(F.flatten(F.filter(F.array(*[positions(F.lit(s)) for s in sizes]),
                                                         lambda x: x.isNotNull()))).alias("at")).select("doc", "at.*")
    close = written(at.join(windows, ["size", "hash"]).select("doc", "p", "size", "window", "items").distinct(), "candidates")
    texts = docs.select("doc", "w").join(close.select("doc").distinct(), "doc", "left_semi").dropDuplicates(["doc"])
    same = exact(F.slice("w", F.col("p"), F.col("size"))).between(F.col("window"), F.col("window"))
    return close.join(texts, "doc").where(same).select("doc", "p", "size", "items")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (id and a hash of the text: rows that share an id stay apart), w, f."""
    return docs.select(_key(id_col, text_col).alias("doc"), split_words(F.col(text_col)).alias("w"),
                       folded(F.col(text_col)).alias("f"))


def _key(id_col: str, text_col: str) -> Column:
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"))


def hit_words(spans: Column) -> Column:
    """Number of words inside any of the spans, an array of (p, size) sorted by p."""
    step = F.aggregate(
        spans, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["p"] + s["size"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["p"] + s["size"] - F.greatest(acc["end"], s["p"]))).alias("n")))
    return step["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, spans, contaminated), a row per document row.

    ``spans`` holds the hit windows as (p, size), p counting words from 1; ``items`` the benchmark ids found.
    """
    found = hits(_keyed(docs, id_col, text_col), benchmark_windows(benchmark, n))
    rows = docs.select(F.col(id_col).alias("doc_id"), _key(id_col, text_col).alias("key"),
                       F.size(split_words(F.col(text_col))).cast("long").alias("n_words"))
    spans = F.array().cast("array<struct<p:int,size:int>>")
    items = F.array().cast("array<string>")
    if found is not None:
        per_doc = found.groupBy("doc").agg(
            F.array_sort(F.collect_set(F.struct("p", "size"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        rows = rows.join(per_doc, F.col("key") == F.col("doc"), "left")
        spans, items = F.coalesce("spans", spans), F.coalesce("items", items)
    rows = rows.select("doc_id", "n_words", spans.alias("spans"), items.alias("items"))
    rows = rows.withColumn("n_hit", hit_words(F.col("spans")))
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans",
                       is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def remove_documents(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` without its contaminated rows; same columns."""
    found = hits(_keyed(docs, id_col, text_col), benchmark_windows(benchmark, n))
    if found is None:
        return docs
    per_doc = found.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("p", "size"))).alias("spans"))
    # few rows, written once so that their number is known before the join
    sizes = docs.select(_key(id_col, text_col).alias("key"), F.size(split_words(F.col(text_col))).alias("n_words"))
    bad = written(sizes.join(per_doc, F.col("key") == F.col("doc"))
                  .where(is_contaminated(hit_words(F.col("spans")), F.col("n_words")))
                  .select("key").distinct(), "contaminated")
    side = F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad
    rows = docs.select(as_row(docs), _key(id_col, text_col).alias("key"))
    return rows.join(side, "key", "left_anti").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``docs`` with every hit word cut out of its text (with the separators before it); same columns."""
    found = hits(_keyed(docs, id_col, text_col), benchmark_windows(benchmark, n))
    if found is None:
        return docs
    per_doc = found.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("p", "size"))).alias("spans"))
    names = docs.columns
    joined = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), _key(id_col, text_col).alias("key"))
    joined = joined.join(per_doc, F.col("key") == F.col("doc"), "left").select("row", "spans")
    text = F.col("row").getField(text_col)
    cut = F.when(F.col("spans").isNull(), text).otherwise(cut_words(text, F.col("spans")))
    return joined.select(*[(cut if c == text_col else F.col("row").getField(c)).alias(c) for c in names])


def cut_words(text: Column, spans: Column) -> Column:
    """The text without the words that any span covers; each word goes with the separators before it."""
    units = F.regexp_extract_all(text, F.lit(r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[0-9A-Za-z\x{80}-\x{10FFFF}]+)"), F.lit(1))
    rest = F.regexp_extract(text, r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*)\z", 1)
    inside = lambda i: F.exists(spans, lambda s: (i + 1 >= s["p"]) & (i + 1 < s["p"] + s["size"]))
    return F.concat(F.array_join(F.filter(units, lambda u, i: ~inside(i)), ""), rest)
