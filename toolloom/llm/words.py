"""Words, word hashes and shingles of whole Arrow text columns at once, with numpy.

A word is a run of bytes other than space and \\x09-\\x0D; A-Z count as a-z. Hashes have 64 bits, depend on the
bytes only, and are the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit of its input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))[_LOWER]
_RAW = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_PLACE = mix(np.arange(1001, 1001 + 64, dtype=np.uint64)) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for n places at least."""
    if len(_powers.get("base", ())) < n:
        for name, factor in (("base", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
            line = np.full(n, factor, np.uint64)
            line[0] = 1
            _powers[name] = np.multiply.accumulate(line)
    return _powers["base"], _powers["inverse"]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (one more entry than texts); null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut so that each part has about limit bytes of text, or one text."""
    for batch in batches:
        lengths = np.diff(text_bytes(batch.column(text))[1])
        part = np.cumsum(lengths) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of the bytes of each span, upper and lower case apart; spans may overlap."""
    if not len(start):
        return np.zeros(0, np.uint64)
    power, inverse = _power(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_RAW[data] * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """start, end (bytes), doc (index of the text) and hash of each word of some texts; first: each text's first word."""

    def __init__(self, texts: pa.Array):
        self.data, self.offsets = data, offsets = text_bytes(texts)
        n = len(data)
        space = _SPACE[data]
        begins = np.zeros(n + 1, bool)
        begins[offsets] = True
        before = np.ones(n, bool)
        before[1:] = space[:-1]
        self.start = np.flatnonzero(~space & (before | begins[:-1]))
        after = np.ones(n, bool)
        after[:-1] = space[1:]
        self.end = np.flatnonzero(~space & (after | begins[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.count)), self.count)
        self.hash = self._hashes(space)

    def _hashes(self, space: np.ndarray) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, np.uint64)
        power, inverse = _power(len(self.data))
        terms = _BYTE[self.data]
        terms *= power[: len(terms)]
        terms[space] = 0
        sums = np.add.reduceat(terms, self.start) * inverse[self.start]
        return mix(sums + (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every run of size words inside a text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        total = np.zeros(len(at), np.uint64)
        for k in range(size):
            total += self.hash[at + k] * _PLACE[k]
        return at, mix(total)

    def shingle_sets(self, size: int = SHINGLE) -> list[np.ndarray]:
        """Each text's distinct shingles, sorted; a shorter text has its whole word sequence as one, an empty text none."""
        at, hashes = self.runs(size)
        bounds = np.searchsorted(at, self.first)
        sets = []
        for i, n in enumerate(self.count):
            if n >= size:
                x = np.sort(hashes[bounds[i] : bounds[i + 1]])
                sets.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
            elif n:
                words = self.hash[self.first[i] : self.first[i + 1]]
                sets.append(mix((words * _PLACE[size : size + n]).sum(keepdims=True) + np.uint64(n)))
            else:
                sets.append(np.zeros(0, np.uint64))
        return sets
