"""Line splitting, comma tokenising and word counting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cascata.functions.text import TOKEN_SEPARATOR, drop_final_empty, line_parts, tokens_of_trimmed

# Bytes of a long line that one task splits at a time.
RANGE_BYTES = 32 * 1024 * 1024


def lines(df: DataFrame, text_col: str, keep: Sequence[str] = (), name: str = "line") -> DataFrame:
    """One row per line of ``text_col`` (whole texts, every line)."""
    # split once into a column, then trim: the split is not re-evaluated per branch
    parts = df.select(*keep, line_parts(text_col).alias("_parts"))
    return parts.select(*keep, F.explode(drop_final_empty("_parts")).alias(name))


def tokens(df: DataFrame, line_col: str, keep: Sequence[str] = (), name: str = "word") -> DataFrame:
    """One row per comma token of ``line_col`` (flat-map with JVM split rules)."""
    trimmed = df.select(*keep, F.col(line_col).alias("_line"),
                        F.rtrim(line_col, F.lit(TOKEN_SEPARATOR)).alias("_kept"))
    return trimmed.select(*keep, F.explode(tokens_of_trimmed("_line", "_kept")).alias(name))


def range_tokens(df: DataFrame, line_col: str, key: Sequence[str], range_bytes: int = RANGE_BYTES,
                 name: str = "word", position: str | None = None, spread: int | None = None) -> DataFrame:
    """``tokens`` of lines that are too long for one task: ``key`` columns, token, and its ``position`` (from 0) if named.

    A line is cut into ranges of ``range_bytes`` bytes, wherever these end (moved on to the next character), and the
    ranges are dealt over the tasks and split there.  A range's separators give the positions of its tokens: those
    before it add up to its offset.  The first and last piece of a range may be parts of a token, so pieces at one
    position are put together again; a token may run over any number of ranges.  The last position with a token that
    is not empty, over all ranges, ends the line: empty tokens after it are dropped, as ``tokens`` drops them.

    Only the ranges are shuffled, and per range one row of numbers; the task that cuts a line must hold it, but not its
    tokens.  ``key`` must identify the line; null lines give no rows.
    """
    ids = list(key)
    raw = df.where(F.col(line_col).isNotNull()).select(
        F.struct(*ids).alias("_id"), F.encode(line_col, "UTF-8").alias("_raw"))
    last = F.greatest(F.ceil(F.octet_length("_raw") / range_bytes).cast("int"), F.lit(1)) - 1
    ranges = raw.select("_id", "_raw", F.explode(F.sequence(F.lit(0), last)).alias("_range"), last.alias("_last"))

    def start(number):
        # a character's bytes after its first are 80 to BF: at most three are skipped
        at = number * range_bytes + 1
        inside = F.regexp_extract(F.hex(F.substring(F.col("_raw"), at, F.lit(3))), "^((?:[89AB][0-9A-F])*)", 1)
        return at + F.when(number > 0, F.length(inside) / 2).otherwise(0).cast("int")

    begin, end = start(F.col("_range")), start(F.col("_range") + 1)
    text = F.substring(F.col("_raw"), begin, end - begin).cast("string")
    spread = spread or df.sparkSession.sparkContext.defaultParallelism
    cut = ranges.select("_id", "_range", "_last", text.alias("_text")).repartition(spread, "_id", "_range")
    cut = cut.withColumn("_pieces", F.split("_text", TOKEN_SEPARATOR, -1))
    kept = F.rtrim("_text", F.lit(TOKEN_SEPARATOR))
    # separators of the range, and the place of its last piece that is not empty (null when all are)
    numbers = cut.select("_id", "_range", (F.size("_pieces") - 1).alias("_separators"),
                         F.when(kept != "", F.size(F.split(kept, TOKEN_SEPARATOR, -1)) - 1).alias("_filled"))
    before = Window.partitionBy("_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_id")
    numbers = numbers.withColumn("_offset", F.coalesce(F.sum("_separators").over(before), F.lit(0)))
    numbers = numbers.select("_id", "_range", "_offset", F.max(F.col("_offset") + F.col("_filled")).over(whole).alias("_end"),
                             F.sum("_separators").over(whole).alias("_all"))
    # a merge join: the ranges stay in their tasks, whatever their size
    placed = cut.join(numbers.hint("merge"), ["_id", "_range"]).select(
        "_id", "_range", "_last", "_offset", F.size("_pieces").alias("_n"),
        # a line without separators is one token, empty or not
        F.when(F.col("_all") == 0, 0).otherwise(F.coalesce("_end", F.lit(-1))).alias("_end"), F.posexplode("_pieces"))
    placed = placed.withColumn("_at", F.col("_offset") + F.col("pos")).where("_at <= _end")
    border = ((F.col("pos") == 0) & (F.col("_range") > 0)) | ((F.col("pos") == F.col("_n") - 1) & (F.col("_range") < F.col("_last")))
    inner = placed.where(~border).select("_id", "_at", F.col("col").alias(name))
    joined = (placed.where(border).groupBy("_id", "_at")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_range", "col"))), lambda x: x["col"]), "")
                   .alias(name)))
    out = inner.unionAll(joined)
    return out.select(*(F.col(f"_id.`{c}`").alias(c) for c in ids), name, *([F.col("_at").alias(position)] if position else []))


def rename(df: DataFrame, source: str, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """Pass-through rename (``line`` -> ``word``) without splitting."""
    return df.select(*keep, F.col(source).alias(target))


def tokenize_text(df: DataFrame, text_col: str, keep: Sequence[str] = (), name: str = "word") -> DataFrame:
    """Text -> lines -> tokens; two generators fused in one stage."""
    return tokens(lines(df, text_col, keep, "_line"), "_line", keep, name)


def word_count(words: DataFrame, word_col: str = "word", name: str = "word_count") -> DataFrame:
    """Final count per word (partial counts are combined before the shuffle,
    so a very frequent word costs one row per map task, not one per use)."""
    return words.groupBy(word_col).agg(F.count(F.lit(1)).alias(name))
