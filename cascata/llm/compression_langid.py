"""Language identification by compression.

Per language, the words of a bounded sample of labelled texts become a
zstandard raw-content dictionary: rarest first, so the commonest are nearest
to the text, and without words that another language uses more than twice as
often (a wrongly labelled copy of a text would otherwise compress its
original).  Frequencies are shares of the language's sample texts, shrunk as if
``SMOOTHING`` more texts without the word had been seen, so that a label with a
single text takes no common word from the others.  A text is normalised (lower
case, letters only), cut into blocks, and each block is compressed once with
every dictionary and once without.

Each language keeps its own words up to ``DICTIONARY_BYTES`` bytes, whatever the
others have.  What a dictionary saves by chance grows with its length, so each
is charged its own allowance: the share it saves on the commonest words of the
other languages.  The language with the smallest size, allowance added, wins;
where no language saves more than its allowance, the smallest size as it is.
When the runner-up needs less than ``min_margin`` more bytes, the text is
rejected.

The training sample is the ``per_language`` distinct labelled rows of lowest id
hash per language (a documented bound on rows); ranking is over hashes and is
pruned before the shuffle, so a hot language costs each map task at most
``per_language`` rows.  The sampled rows' whole texts are counted inside tasks,
and the driver gets the words that fit the dictionaries: languages x
``DICTIONARY_BYTES`` at most, and never more than ``ALL_DICTIONARY_BYTES``,
which are broadcast for prediction, a map over Arrow batches.

Defined results: null texts, texts without a letter and every text when no
label was learned give ``und`` with score 0; equal sizes go to the first
language in alphabetical order; repeated rows give repeated rows; an empty
table none; other columns are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cascata.llm.common import prepare, written

UND = "und"
PER_LANGUAGE = 1000
DICTIONARY_BYTES = 110_000
# Texts without the word that a language's frequencies are shrunk by.
SMOOTHING = 20
# Words of each other language that an allowance is measured on, in characters.
FOREIGN_CHARS = 2 * 2048
BLOCK_CHARS = 2048
LEVEL = 9
MIN_MARGIN = 0.02
# Bytes of all dictionaries together: beyond a thousand languages, each gets an equal part of them.
ALL_DICTIONARY_BYTES = 110_000_000
# Distinct words counted at a time within a task.
COUNT_BUFFER = 500_000
# Bits of size difference that make the runner-up half as likely, for the score.
SCORE_BITS = 64.0

# all but letters: what is no word character, the digits, and the few other numeric signs among word characters; those
# are sought apart, as a class of all three tries each sign at every character
_NO_LETTER = re.compile(r"[\W\d_]+")
_SIGNS = frozenset(c for c in map(chr, range(sys.maxunicode + 1))
                   if c.isalnum() and not c.isdecimal() and unicodedata.category(c)[0] != "L")


def normalise(text: str | None) -> str:
    """Lower-case words of letters, one space between; empty when there is no letter."""
    plain = (text or "").lower()
    for sign in _SIGNS.intersection(plain):
        plain = plain.replace(sign, " ")
    return _NO_LETTER.sub(" ", plain).strip()


def word_counts(labelled: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
                per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, word, n): in how many of a language's sampled texts a word occurs; the word '' counts the texts."""
    prepare(labelled.sparkSession)
    text = F.col(text_col).cast("string")
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col)).alias("h"),
                           F.xxhash64(text).alias("t"), text.alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))
    keys = rows.select("lang", "h", "t").distinct().withColumn("r", rank).where(F.col("r") <= per_language).drop("r")
    keys = written(keys, "language-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                 pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

        for batch in batches:
            for lang, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                seen.update((lang, w) for w in {"", *normalise(t).split()})
            if len(seen) > COUNT_BUFFER:
                yield counted()
                seen = Counter()
        yield counted()

    sample = rows.join(F.broadcast(keys), ["lang", "h", "t"], "left_semi").groupBy("lang", "h", "t").agg(
        F.first("text").alias("text"))
    counts = sample.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          per_language: int = PER_LANGUAGE, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """language -> dictionary content, from the whole texts of a bounded sample of the rows with a label and a text."""
    counts = written(word_counts(labelled, lang_col, id_col, text_col, per_language), "language-words")
    texts = counts.where("word = ''").select("lang", F.col("n").alias("texts"))
    words = counts.where("word <> ''").join(F.broadcast(texts), "lang").withColumn(
        "f", F.col("n") / (F.col("texts") + SMOOTHING))
    own = words.withColumn("top", F.max("f").over(Window.partitionBy("word"))).where(2 * F.col("f") >= F.col("top"))
    # the commonest words that fit
    length = F.sum(F.octet_length("word") + 1).over(Window.partitionBy("lang").orderBy(F.desc("n"), F.desc("word")))
    found: dict[str, list[tuple[int, str]]] = {r["lang"]: [] for r in texts.collect()}
    size = min(size, ALL_DICTIONARY_BYTES // max(1, len(found)))
    kept = own.withColumn("bytes", length).where(F.col("bytes") <= size)
    for r in kept.select("lang", "n", "word").toLocalIterator():
        found[r["lang"]].append((r["n"], r["word"]))
    return {lang: _content(found[lang]) for lang in sorted(found)}


def dictionaries(texts: dict[str, list[str]], size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """``train`` for a few normalised texts at hand."""
    counts = {lang: Counter(w for t in own for w in set(t.split())) for lang, own in texts.items()}
    share = {lang: {w: n / (len(texts[lang]) + SMOOTHING) for w, n in words.items()} for lang, words in counts.items()}
    top: dict[str, float] = {}
    for words in share.values():
        for w, f in words.items():
            top[w] = max(top.get(w, 0.0), f)
    content = {}
    for lang in sorted(counts):
        kept, length = [], 0
        for n, w in sorted(((n, w) for w, n in counts[lang].items() if 2 * share[lang][w] >= top[w]), reverse=True):
            length += len(w.encode()) + 1
            if length > size:
                break
            kept.append((n, w))
        content[lang] = _content(kept)
    return content


def _content(words: list[tuple[int, str]]) -> bytes:
    """The counted words, commonest last."""
    return "".join(f"{w} " for _, w in sorted(words)).encode()


class Compressors:
    def __init__(self, contents: dict[str, bytes]):
        self.languages = sorted(contents)
        self.own = [self._compressor(contents[lang], LEVEL) for lang in self.languages]
        self.bare = self._compressor(b"", LEVEL)
        self.allowances = self._allowances(contents)

    @staticmethod
    def _compressor(content: bytes, level: int) -> zstandard.ZstdCompressor:
        kind = {"level": level, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        if not content:
            return zstandard.ZstdCompressor(**kind)
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=words, **kind)

    def _allowances(self, contents: dict[str, bytes]) -> list[float]:
        """Per language, the share that its dictionary saves on the commonest words of the others."""
        samples = {lang: contents[lang][-FOREIGN_CHARS:].decode(errors="ignore") for lang in self.languages}
        out = []
        for i, lang in enumerate(self.languages):
            own = bare = 0
            for other, sample in samples.items():
                if other != lang and sample:
                    sizes, without = self.sizes(sample, [i])
                    own += sizes[0]
                    bare += without
            out.append(max(0.0, 1.0 - own / bare) if bare else 0.0)
        return out

    def sizes(self, text: str, which: list[int] | None = None) -> tuple[list[int], int]:
        """Total compressed bytes of all blocks of a normalised text: per language, and without a dictionary."""
        blocks = [text[i:i + BLOCK_CHARS].encode() for i in range(0, len(text), BLOCK_CHARS)]
        chosen = self.own if which is None else [self.own[i] for i in which]
        return [sum(len(c.compress(b)) for b in blocks) for c in chosen], sum(len(self.bare.compress(b)) for b in blocks)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(best language, score 0..1, margin to the runner-up as a share of the best size)."""
        plain = normalise(text)
        if not plain or not self.languages:
            return UND, 0.0, 0.0
        raw, bare = self.sizes(plain)
        sizes = [s + a * bare for s, a in zip(raw, self.allowances)]
        if min(sizes) >= bare:          # nothing is saved but by chance
            sizes = raw
        best = min(range(len(sizes)), key=sizes.__getitem__)
        score = 1.0 / sum(2.0 ** min(0.0, -8.0 * (s - sizes[best]) / SCORE_BITS) for s in sizes)
        others = [s for i, s in enumerate(sizes) if i != best]
        margin = (min(others) - sizes[best]) / sizes[best] if others else 1.0
        return self.languages[best], score, margin


def identify(docs: DataFrame, contents: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
             min_margin: float = MIN_MARGIN) -> DataFrame:
    """(doc_id, lang_best, lang, score, margin): ``lang`` is null where the margin is too narrow."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(contents)
    dtype = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Compressors(sent.value)
        for batch in batches:
            got = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[0] if g[2] >= min_margin or g[0] == UND else None for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64())],
                ["doc_id", "lang_best", "lang", "score", "margin"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dtype}, lang_best string, lang string, score double, margin double")
