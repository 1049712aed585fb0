"""Words, shingles and their hashes of many texts at once, as numpy arrays.

Texts are read as UTF-8 bytes with A-Z lowered. A word is a maximal run of word bytes;
bytes of characters beyond ASCII always belong to one class, so byte runs and character
runs are the same. A word's hash joins the values of two polynomials in its bytes modulo
the prime 2**31 - 1, at two points: no pattern of bytes makes them alike by itself, as
repeated patterns do modulo a power of two.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
CHUNK_BYTES = 1_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_U64 = np.uint64
_PRIME = (1 << 31) - 1
_POINTS = (1_583_458_089, 784_588_716)
_powers: list[np.ndarray] = []


def byte_class(is_word) -> np.ndarray:
    """A table of the bytes *is_word* holds for; A-Z never occur in lowered text."""
    return np.array([bool(is_word(b)) for b in range(256)])


#: Words between ASCII white space.
SPACED = byte_class(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
#: Words of letters and digits; anything beyond ASCII belongs to a word.
ALNUM = byte_class(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of *x* reaches every bit of the result."""
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(29))) * _U64(0xA5CB9243F26AB1C3)
    return x ^ (x >> _U64(32))


def _power_tables(n: int) -> list[np.ndarray]:
    """The powers of both points below the *n*-th, kept for the next call if they are few."""
    if _powers and len(_powers[0]) >= n:
        return _powers
    tables = []
    for point in _POINTS:
        table, step = np.ones(1, dtype=_U64), point
        while len(table) < max(n, 1 << 10):
            table = np.concatenate([table, table * _U64(step) % _U64(_PRIME)])
            step = step * step % _PRIME
        tables.append(table)
    if len(tables[0]) <= 1 << 20:
        _powers[:] = tables
    return tables


class Words:
    """The words of a few texts: text ``i`` has the words ``first[i]:first[i + 1]``."""

    def __init__(self, texts: Sequence[str | None], table: np.ndarray, lower: bool = True):
        parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.raw = b" ".join(parts)
        if lower:
            self.raw = self.raw.translate(_LOWER)
        buffer = np.frombuffer(self.raw, dtype=np.uint8)
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        #: Where each text begins in ``raw``; one byte lies between texts.
        self.begins = np.concatenate(([0], np.cumsum(lengths + 1)))
        #: Which bytes belong to words.
        self.inside = table[buffer]
        edges = np.diff(np.concatenate(([0], self.inside.astype(np.int8), [0])))
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)
        self.first = np.searchsorted(self.starts, self.begins)
        self.buffer = buffer

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash for each word."""
        if not len(self.starts):
            return np.zeros(0, dtype=_U64)
        lengths = self.ends - self.starts
        begins = np.concatenate(([0], np.cumsum(lengths)))
        place = np.arange(begins[-1]) - np.repeat(begins[:-1], lengths)
        data = self.buffer[self.inside].astype(_U64) + _U64(1)
        values = []
        for power in _power_tables(int(lengths.max())):
            terms = data * power[place]  # below 2**39: words up to 2**24 bytes can't overflow
            if lengths.max() > 1 << 24:
                terms %= _U64(_PRIME)
            values.append(np.add.reduceat(terms, begins[:-1]) % _U64(_PRIME))
        return mix((values[0] << _U64(31)) | values[1])

    def slices(self, before: np.ndarray | None = None) -> pa.Array:
        """The words as bytes; where *before* is set, with the byte before the word."""
        longer = np.zeros(len(self.starts), dtype=bool) if before is None else before
        taken = self.inside.copy()
        taken[self.starts[longer] - 1] = True
        ends = np.concatenate(([0], np.cumsum(self.ends - self.starts + longer)))
        data = np.ascontiguousarray(self.buffer[taken])
        buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
        return pa.Array.from_buffers(pa.large_binary(), len(self.starts), buffers)

    def shingles(self, size: int, whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of *size* words, and where each text's begin.

        A text with fewer words has none, or with *whole_if_short* its whole sequence as one.
        """
        words, counts = self.hashes(), self.counts()
        n = np.maximum(counts - size + 1, 0)
        if whole_if_short:
            n = np.where((n == 0) & (counts > 0), 1, n)
        begins = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(self.first[:-1] - begins[:-1], n) + np.arange(begins[-1])
        last = np.repeat(self.first[1:], n)
        total = np.zeros(len(at), dtype=_U64)
        for k in range(size):
            more = at + k < last
            word = words[np.minimum(at + k, len(words) - 1)] if len(words) else words
            total = np.where(more, mix(total + word) * _U64(BASE), total)
        return mix(total), begins


def portions(texts: Sequence[str | None], limit: int = CHUNK_BYTES) -> Iterator[slice]:
    """Runs of texts of about *limit* characters; a longer text is alone in its run."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text is not None else 0
        if i > start and size + n > limit:
            yield slice(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield slice(start, len(texts))


def sets_of(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each text in ascending order, and where each text's begin."""
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(begins)))
