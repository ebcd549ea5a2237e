"""Personal data: fixed patterns, and terms that give the protected entities away.

Base spans are emails, ip addresses, card and phone numbers.  Every distinct
value is a protected entity e.  The corpus says how much a term t (a word of at
least two characters outside the base spans) reveals of it.  All counts are of
distinct texts, so copies count once, and of whole texts:

    PMI(t, e) = log2( P(e | t) * N / n(e) ),   IC(e) = log2(N / n(e)),
    P(e | t) = ( n(t, e) + SMOOTHING * n(e) / N ) / ( n(t) + SMOOTHING )

where n(t, e) counts the texts that hold both, n(e) and n(t) those that hold
one, and N all.  disclosure = PMI / IC comes close to 1 for a term that occurs
nowhere but beside e; the smoothing, as of texts with t that hold e as often as
any, keeps a few sightings from proving too much.  No entity or term is left
out.  A term at or over ``GENERALISE`` is replaced by a placeholder in every
document that holds e and t, one at or over ``REMOVE`` is deleted.

Jobs: (1) digests of the texts, to find those with copies; (2) a map over each
distinct text that writes the entities and, apart from them, the terms of those
with base spans, and the counts of all terms, combined within the task; (3) the
number of a term's texts, set against the most that could reach the threshold
beside any of a text's entities, leaves the terms that may tell
something, and only these meet the entities; sums by (entity, term) give the
scores; all joins are by shuffle, and nothing but counts of rows passes the
driver; (4) a map over all texts with each one's disclosing terms joined by its
digest (broadcast while they are counted to be few, else shuffled).

Defined results: a null or empty text has no spans; repeated rows count once
and are judged alike; an empty table gives none; other columns are not read
(``sanitise`` passes them through, whatever their names).  Texts are told apart by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cascata.llm.common import as_row, prepare, written

GENERALISE = 0.8
REMOVE = 0.95
# Texts with a term that hold the entity as often as any, added to those seen.
SMOOTHING = 2.0
# Terms of texts, about 40 bytes each, and digests of texts with copies up to which they are broadcast.
BROADCAST_ROWS = 1_000_000
# Distinct terms counted, and rows held, at a time within a task.
COUNT_BUFFER = 500_000
ROW_BUFFER = 50_000

KINDS = ("email", "ip", "card", "phone", "term")
# The base patterns.  Possessive runs and the look-behind only spare retries that cannot match.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W_]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards (scanning from every start would be quadratic in long words)."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            last = match.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base spans by start, then kind; code points, end exclusive."""
    if not text:
        return []
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def entity(kind: int, value: str) -> int:
    """64-bit id of a protected value: case and separators don't matter."""
    plain = value.lower() if kind < 2 else re.sub(r"[^0-9]", "", value)
    return xxhash.xxh3_64_intdigest(f"{kind}:{plain}") - (1 << 63)


def _outside(words: list[tuple[int, int, str]], spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """The words that overlap no span; both lists are by start."""
    out, i, reach = [], 0, 0
    for a, b, w in words:
        while i < len(spans) and spans[i][0] < b:
            reach = max(reach, spans[i][2])
            i += 1
        if a >= reach:
            out.append((a, b, w))
    return out


def _words(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m.group().lower()) for m in _WORD.finditer(text)]


def spans_of(text: str | None, terms: dict[str, float]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, all spans): the base spans and, for disclosing terms, their occurrences outside them."""
    base = base_spans(text)
    if not base or not terms:
        return base, base
    extra = [(a, 4, b) for a, b, w in _outside(_words(text), base) if w in terms]
    return base, sorted(base + extra)


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def cleaned(text: str, spans: list[tuple[int, int, int]], terms: dict[str, float], remove: float = REMOVE) -> str:
    """The text with base spans as [EMAIL] etc. (overlapping ones as the first's kind), terms as [TERM] or deleted."""
    out, at, i = [], 0, 0
    while i < len(spans):
        a, kind, b = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < b:
            b = max(b, spans[i][2])
            i += 1
        gone = kind == 4 and terms.get(text[a:b].lower(), 0.0) >= remove
        out += [text[at:a], "" if gone else f"[{KINDS[kind].upper()}]"]
        at = b
    return "".join(out) + text[at:]


def _digests(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.lit("b"), text).alias("b")]


def distinct_texts(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, int]:
    """((a, b, text) of each distinct text that is not null, by its digest a, b; how many)."""
    rows = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    rows = rows.select(*_digests(F.col("text")), "text")
    classes = written(rows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("m")), "text-digests")
    copied = classes.where("m > 1").select("a", "b")
    side = F.broadcast(copied) if copied.count() <= BROADCAST_ROWS else copied
    # only texts with copies are shuffled
    once = rows.join(side, ["a", "b"], "left_semi").groupBy("a", "b").agg(F.first("text").alias("text"))
    return rows.join(side, ["a", "b"], "left_anti").unionAll(once), classes.count()


def holdings(texts: DataFrame) -> DataFrame:
    """Of distinct texts: (a, b, entity) and (a, b, term) of all that hold an entity, each in rows of its own; and
    (term, n), the texts with a term, in parts to be summed, without a and b."""
    prepare(texts.sparkSession)
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
    names = ["a", "b", "entity", "term", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def made(columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        def counted() -> pa.RecordBatch:
            none = [None] * len(seen)
            return made((none, none, none, list(seen), list(seen.values())))

        for batch in batches:
            for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text"))):
                spans = base_spans(text)
                if spans:
                    terms = {w for _, _, w in _outside(_words(text), spans) if len(w) > 1}
                    held = [(e, None) for e in {entity(k, text[x:y]) for x, k, y in spans}] + [(None, t) for t in terms]
                    for i in range(0, len(held), ROW_BUFFER):
                        part = held[i:i + ROW_BUFFER]
                        m = len(part)
                        yield made(([a] * m, [b] * m, [h[0] for h in part], [h[1] for h in part], [None] * m))
                else:
                    terms = {w.lower() for w in set(_WORD.findall(text)) if len(w.lower()) > 1}
                seen.update(terms)
            if len(seen) > COUNT_BUFFER:
                yield counted()
                seen = Counter()
        yield counted()

    return texts.select("a", "b", "text").mapInArrow(run, "a long, b long, entity long, term string, n long")


def most_texts(n_e: Column, n: Column, threshold: float) -> Column:
    """In how many texts a term may be at most if it is to reach the threshold: all of the entity's texts hold it then."""
    share = n_e / n
    least = F.pow(share, F.lit(1.0 - threshold))
    return F.coalesce(F.try_divide(n_e + SMOOTHING * share, least) - SMOOTHING, F.lit(float("inf"))) * 1.000001


def candidates(held: DataFrame, n_texts: int, threshold: float = GENERALISE) -> DataFrame:
    """(a, b, entity, n_e, term, n_t): the entities of each text with those of its terms that are in few enough texts.

    Entities and terms of a text meet only then: common terms never do.
    """
    n = F.lit(float(n_texts))
    entities = held.where("entity is not null").select("a", "b", "entity")
    of_entity = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")).withColumn(
        "most", most_texts(F.col("n_e"), n, threshold))
    entities = entities.join(of_entity, "entity")
    of_term = held.where("a is null").groupBy("term").agg(F.sum("n").alias("n_t"))
    of_text = entities.groupBy("a", "b").agg(F.max("most").alias("text_most"))
    rare = (held.where("a is not null and term is not null").select("a", "b", "term").join(of_term, "term")
            .join(of_text, ["a", "b"]).where("n_t <= text_most").drop("text_most"))
    return rare.join(entities, ["a", "b"]).where("n_t <= most").drop("most")


def scores(pairs: DataFrame, n_texts: int, threshold: float = GENERALISE) -> DataFrame:
    """(entity, term, support, disclosure) of the terms over the threshold; ``pairs`` are the ``candidates``."""
    n = F.lit(float(n_texts))
    rows = pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("support"), F.first("n_e").alias("n_e"),
                                               F.first("n_t").alias("n_t"))
    p = (F.col("support") + SMOOTHING * F.col("n_e") / n) / (F.col("n_t") + SMOOTHING)
    ic = F.log2(n / F.col("n_e"))
    rows = rows.withColumn("disclosure", F.when(ic > 0, F.log2(p * n / F.col("n_e")) / ic).otherwise(0.0))
    return rows.where(F.col("disclosure") >= threshold).select("entity", "term", "support", "disclosure")


def _with_terms(docs: DataFrame, text_col: str) -> DataFrame:
    """(row, text, terms): each row of ``docs`` as one struct, its text, and its disclosing terms of the entities it
    holds, with their disclosure."""
    texts, n_texts = distinct_texts(docs, text_col)
    held = written(holdings(texts), "holdings")
    pairs = written(candidates(held, n_texts), "disclosure-pairs")
    telling = scores(pairs, n_texts).select("entity", "term", "disclosure")
    per_text = written(pairs.select("a", "b", "entity", "term").join(telling, ["entity", "term"])
                       .groupBy("a", "b", "term").agg(F.max("disclosure").alias("d")), "disclosing-terms")
    few = per_text.count() <= BROADCAST_ROWS
    per_text = per_text.groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("term", "d"))).alias("terms"))
    rows = docs.select(as_row(docs), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("row", "text", *_digests(F.col("text")))
    return rows.join(F.broadcast(per_text) if few else per_text, ["a", "b"], "left").select("row", "text", "terms")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term) of every whole text."""
    prepare(docs.sparkSession)
    dtype = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for text, terms in zip(batch.column("text").to_pylist(), batch.column("terms").to_pylist()):
                b, e = spans_of(text, {t["term"]: t["d"] for t in terms or ()})
                base.append(b)
                every.append(e)
            counts = [pa.array([sum(s[1] == k for s in x) for x in every], pa.int64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts[:4],
                 pa.array([hashlib.sha256(render(b).encode()).hexdigest() for b in base], pa.string()),
                 pa.array([render(e) for e in every], pa.string()), counts[4]],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term"])

    return _with_terms(rows, "text").select("row.doc_id", "text", "terms").mapInArrow(
        run, f"doc_id {dtype}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
             "n_term long")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its texts cleaned; same columns, null texts stay null."""
    prepare(docs.sparkSession)
    with_terms = _with_terms(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for text, terms in zip(batch.column("text").to_pylist(), batch.column("terms").to_pylist()):
                known = {t["term"]: t["d"] for t in terms or ()}
                _, spans = spans_of(text, known)
                new.append(cleaned(text, spans, known) if spans else text)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.string())], ["row", "text"])

    clean = with_terms.mapInArrow(run, with_terms.select("row", "text").schema)
    return clean.select(*[(F.col("text") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
