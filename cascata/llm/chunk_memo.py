"""Encoding texts cut by cut, remembering the cuts.

Both byte-level tokenizers here split a text by the same public pattern
before they merge bytes.  No match of that pattern runs over

* a space that follows a non-space character,
* the step from a letter or digit to one of ``. , ! ? ; :`` or a line break,
* the step from a line break after a non-space character to another one,

so a text may be cut there and the cuts' ids concatenated: the result is that
of the whole text.  Cuts repeat, so a bounded memo of cut -> ids does most of
the work.  A batch's texts are cut and their cuts numbered in whole columns, so
Python and the memo see each different cut of a batch once, what the memo lacks
is encoded once, and the ids are gathered by the cuts' numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

# Longer cuts are encoded but not remembered.
MEMO_CHARS = 64
MEMO_WORDS = 400_000

# By code point of the basic plane: letters and digits, and what is no white space (as Python's str has them); the last
# stands for all beyond, where no white space is and letters are not told apart.
_BEYOND = 0xFFFF
_CHARS = [chr(c) for c in range(1 << 16)]
_ALNUM = np.array([c.isalnum() for c in _CHARS])
_SOLID = np.array([not c.isspace() for c in _CHARS])
del _CHARS
# By byte: a space, a line break, one of the other signs that a cut may come before.
_KIND = np.zeros(256, np.uint8)
_KIND[list(b".,!?;:")] = 1
_KIND[list(b"\n")] = 2
_KIND[list(b" ")] = 3


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the UTF-8 characters that start at ``at``."""
    lead = data[at].astype(np.int32)
    after = [data[np.minimum(at + i, len(data) - 1)].astype(np.int32) & 0x3F for i in (1, 2)]
    return np.select([lead < 0x80, lead < 0xE0, lead < 0xF0],
                     [lead, (lead & 0x1F) << 6 | after[0], (lead & 0xF) << 12 | after[0] << 6 | after[1]], _BEYOND)


def _before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the characters before ``at`` start."""
    at = at - 1
    for _ in range(3):
        at = np.where((data[at] & 0xC0 == 0x80) & (at > 0), at - 1, at)
    return at


def cut_places(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ascending places in the UTF-8 ``data`` at which texts (that begin and end at ``bounds``) begin, end or are cut."""
    marked = np.flatnonzero(_KIND[data])
    marked = marked[marked > 0]
    kind, before = _KIND[data[marked]], data[marked - 1]
    solid, alnum = _SOLID[before], _ALNUM[before]
    wide = np.flatnonzero(before >= 0x80)
    points = _code_points(data, _before(data, marked[wide]))
    solid[wide], alnum[wide] = _SOLID[points], _ALNUM[points]
    after = marked[(kind == 2) & solid] + 1
    after = after[after < len(data)]
    after = after[_SOLID[_code_points(data, after)]]
    cuts = np.zeros(len(data) + 1, bool)
    # a space after white space, or a sign after what is no letter, is no cut
    cuts[marked[np.where(kind == 3, solid, alnum)]] = cuts[after] = cuts[bounds] = True
    return np.flatnonzero(cuts)


class TwoGenerations(dict):
    """A dict of at most ``limit`` entries: when half are new, the older half goes, except what was asked for again."""

    def __init__(self, limit: int):
        super().__init__()
        self.half = max(1, limit // 2)
        self.old: dict = {}

    def recall(self, keys: Iterable) -> list:
        """The keys that neither generation has; those of the older move to the newer."""
        keys, old = set(keys), self.old
        if not old:
            return list(keys)
        again = {k: old[k] for k in keys if k in old}
        self.update(again)
        return list(keys.difference(again))

    def settle(self) -> None:
        if len(self) > self.half:
            self.old = dict(self)
            self.clear()


class ChunkMemo:
    """``encode_many`` maps strings to bytes; ``texts`` gives each whole text's bytes by way of its cuts."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], limit: int = MEMO_WORDS):
        self.encode_many = encode_many
        self.known = TwoGenerations(limit)

    def texts(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        column = column.cast(pa.large_string()).fill_null("")
        _, bounds, data = column.buffers()
        bounds = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else [0]
        if bounds[0] == bounds[-1]:
            return [b""] * len(column)
        data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        places = cut_places(data, bounds)
        cuts = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
        numbered = cuts.dictionary_encode()
        values = pa.array(self._values(numbered.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        _, ends, raw = values.take(numbered.indices).buffers()
        ends = np.frombuffer(ends, np.int64)[np.searchsorted(places, bounds)].tolist()
        raw = memoryview(raw or b"")
        return [raw[a:b].tobytes() for a, b in zip(ends, ends[1:])]

    def _values(self, cuts: list[str]) -> list[bytes]:
        """Each cut's bytes; those of short cuts are remembered."""
        known = self.known
        known.settle()
        out = list(map(known.get, cuts))
        new = known.recall([c for c, x in zip(cuts, out) if x is None])
        known.update(zip(new, self.encode_many(new)))
        out = [known[c] if x is None else x for c, x in zip(cuts, out)]
        for c in new:
            if len(c) > MEMO_CHARS:
                del known[c]
        return out
