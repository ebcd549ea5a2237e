"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton enumerates every vocabulary match that ends at a
position (one-character pieces, which match nearly everywhere, are looked up in
a table of characters instead); dynamic programming over positions carries the best score so far and
the number of pieces on that path.  Ties are the unigram tokenizer's: starts
are visited in ascending order and a path is replaced only by a strictly
better one, so among equal scores the longest last piece stays.  A character
that no one-character piece covers may stand alone at ``min score - 10`` and
counts one token per UTF-8 byte (byte fallback).

Segments are cut as the tokenizer cuts them: a space becomes the word-start
mark, one mark is put in front of a text that does not begin with one, and each
mark opens a segment.  Segments are scored apart, so a bounded memo of
segment -> (count, score) serves repeated words.  Rows are independent: a map,
no shuffle.

The vocabulary's pieces are read from a public model file.  Its own scores are
merge ranks; a piece of rank r (from 1) gets the score -ln(r + 1), a fixed
rule, nothing is trained.

Defined results: a null or empty text has 0 tokens and score 0; repeated rows
give repeated rows; an empty table none; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascata.llm.chunk_memo import TwoGenerations
from cascata.llm.common import prepare

MARK = "▁"
UNK_PENALTY = 10.0
MEMO_CHARS = 64
MEMO_SEGMENTS = 800_000


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) in id order: id 0 unknown, 256 byte pieces, then the model's ordinary pieces by rank."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    worst = -math.log(len(pieces) + 1)
    head = [("<unk>", worst)] + [(f"<0x{b:02X}>", worst) for b in range(256)]
    return head + [(p, -math.log(r + 1)) for r, p in enumerate(pieces, 1)]


class UnigramCounter:
    def __init__(self, entries: list[tuple[str, float]], limit: int = MEMO_SEGMENTS):
        self.automaton = ahocorasick.Automaton()
        self.singles: dict[str, float] = {}
        for i, (piece, score) in enumerate(entries):
            if len(piece) == 1:
                self.singles[piece] = score
            else:
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.chars = np.array(sorted(map(ord, self.singles)), np.uint32)
        self.char_scores = np.array([self.singles[chr(c)] for c in self.chars.tolist()])
        self.lengths = np.array([len(p) for p, _ in entries])
        self.scores = np.array([s for _, s in entries])
        self.entries = [(len(p), s) for p, s in entries]
        self.unknown = min(s for _, s in entries) - UNK_PENALTY
        self.gap = next(c for c in map(chr, range(0xE000, 0xF8FF)) if all(c not in p for p, _ in entries))
        self.memo = TwoGenerations(limit)

    def segment(self, seg: str) -> tuple[int, float]:
        """Best path's token count and score of one segment, position by position."""
        n = len(seg)
        best = [-math.inf] * (n + 1)
        count = [0] * (n + 1)
        best[0] = 0.0
        matches = self.automaton.iter(seg)
        match = next(matches, None)
        for end in range(1, n + 1):
            top, pieces, single = -math.inf, 0, False
            here = []
            while match is not None and match[0] == end - 1:
                here.append(self.entries[match[1]])
                match = next(matches, None)
            if seg[end - 1] in self.singles:
                here.append((1, self.singles[seg[end - 1]]))
            here.sort(reverse=True)                       # longest first: ascending starts
            for length, score in here:
                single = single or length == 1
                s = best[end - length] + score
                if s > top:
                    top, pieces = s, count[end - length] + 1
            if not single:
                s = best[end - 1] + self.unknown
                if s > top:
                    top, pieces = s, count[end - 1] + len(seg[end - 1].encode())
            best[end], count[end] = top, pieces
        return count[n], best[n]

    def segments(self, segs: list[str]) -> list[tuple[int, float]]:
        """``segment`` for many short segments: one automaton pass, the same program over all of them at once."""
        if not segs:
            return []
        sizes = np.array([len(s) for s in segs])
        text = self.gap.join(segs)
        offsets = np.cumsum(sizes + 1) - sizes - 1        # a gap, in no vocabulary entry, keeps matches apart
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        ends, lengths, scores = found[:, 0], self.lengths[found[:, 1]], self.scores[found[:, 1]]
        at_char = np.repeat(np.arange(len(segs), dtype=np.int32), sizes + 1)     # a gap counts to the segment before it
        seg = at_char[ends]
        local = ends - offsets[seg] + 1
        n, width = len(segs), int(sizes.max()) + 1
        best = np.full((width, n), -np.inf)
        count = np.zeros((width, n), np.int64)
        best[0] = 0.0
        code = local * (int(lengths.max(initial=0)) + 1) - lengths
        if code.max(initial=0) < 1 << 16:
            code = code.astype(np.uint16)                 # sorted in one pass per byte
        order = np.argsort(code, kind="stable")           # by end, longest first: ascending starts
        local, lengths, seg, scores = local[order], lengths[order], seg[order], scores[order]
        code = code[order].astype(np.int64)
        cuts = np.flatnonzero(np.diff(code, prepend=-1, append=-1))
        at = 0
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        # a character's own piece is its shortest match; without one it stands alone, a token per byte
        known = np.isin(points, self.chars)
        alone_score = np.full(len(points), self.unknown)
        alone_score[known] = self.char_scores[np.searchsorted(self.chars, points[known])]
        alone_count = np.where(known, 1, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))
        for end in range(1, width):
            while at < len(cuts) - 1 and local[cuts[at]] == end:
                a, b = cuts[at], cuts[at + 1]
                at += 1
                which, start = seg[a:b], end - int(lengths[a])
                s = best[start, which] + scores[a:b]
                won = s > best[end, which]
                which = which[won]
                best[end, which] = s[won]
                count[end, which] = count[start, which] + 1
            alone = np.flatnonzero(sizes >= end)
            char = offsets[alone] + end - 1
            s = best[end - 1, alone] + alone_score[char]
            won = s > best[end, alone]
            alone, char = alone[won], char[won]
            best[end, alone] = s[won]
            count[end, alone] = count[end - 1, alone] + alone_count[char]
        every = np.arange(n)
        return list(zip(count[sizes, every].tolist(), best[sizes, every].tolist()))

    def texts(self, texts: list[str | None]) -> list[tuple[int, float, int]]:
        """(tokens, best score, segments) of whole texts."""
        cut = []
        for t in texts:
            parts = t.replace(MARK, " ").split(" ") if t else []
            cut.append(parts[1:] if parts and not parts[0] else parts)
        memo = self.memo
        memo.settle()
        need = memo.recall(set().union(*cut).difference(memo))
        short = [w for w in need if len(w) < MEMO_CHARS and self.gap not in w]
        memo.update(zip(short, self.segments([MARK + w for w in short])))
        long = [w for w in need if len(w) >= MEMO_CHARS or self.gap in w]
        memo.update((w, self.segment(MARK + w)) for w in long)
        out = []
        for parts in cut:
            counts, scores = zip(*map(memo.__getitem__, parts)) if parts else ((), ())
            out.append((sum(counts), math.fsum(scores), len(parts)))
        for w in long:
            del memo[w]
        return out


@lru_cache(maxsize=2)
def counter(path: str) -> UnigramCounter:
    """One counter per Python worker and model file."""
    return UnigramCounter(vocabulary(path))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, score, n_segments) of every whole text."""
    prepare(docs.sparkSession)
    dtype = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uni = counter(path)
        for batch in batches:
            got = uni.texts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([g[0] for g in got], pa.int64()),
                 pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.int64())],
                ["doc_id", "n_tokens", "score", "n_segments"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dtype}, n_tokens long, score double, n_segments long")
