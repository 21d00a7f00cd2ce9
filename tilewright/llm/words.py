"""Words of many texts at once as numpy arrays, and small integers packed into bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

# White space is 0x20 and 0x09 to 0x0D, nothing else.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15 | 5, 0xD1342543DE82EF95
_SLICE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that equal inputs, and only they, stay equal."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below 2**bits."""
    def table(b: int) -> np.ndarray:
        out = np.full(1 << bits, b, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return table(base), table(pow(base, -1, 1 << 64))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, max(16, int(n).bit_length()))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the n + 1 bounds of its texts; a null text is empty."""
    column = column.fill_null("").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    if not len(bounds):
        bounds = np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ``data[start:end]``, by prefix sums of a polynomial over the bytes.

    Spans come in order and do not overlap.
    """
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):  # slices, so that the tables stay small
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _SLICE)))
        a, b = starts[at], ends[stop - 1]
        up, down = powers(_BYTE_BASE, int(b - a) + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=sums[1:])
        s, e = starts[at:stop] - a, ends[at:stop] - a
        out[at:stop] = (sums[e] - sums[s]) * down[s]
        at = stop
    return mix(out)


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of many texts.

    Word i is ``data[starts[i]:ends[i]]`` and belongs to text ``doc[i]``; text d has the words
    ``first[d]:first[d + 1]``.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.bounds = buffers(column)
        if lower:
            self.data = _LOWER[self.data]
        black = ~_SPACE[self.data]
        cuts = self.bounds[:-1][np.diff(self.bounds) > 0]
        begins = black.copy()
        begins[1:] &= ~black[:-1]
        begins[cuts] = black[cuts]
        finishes = black.copy()
        finishes[:-1] &= ~black[1:]
        lasts = self.bounds[1:][np.diff(self.bounds) > 0] - 1
        finishes[lasts] = black[lasts]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.starts, self.bounds)
        self.doc = np.repeat(np.arange(len(column)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return span_hashes(self.data, self.starts, self.ends)

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each position on, and whether they lie within one text."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        up, down = powers(_WORD_BASE, len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * down[:n]), self.doc[:n] == self.doc[k - 1 :]


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned values as bytes of seven bits, low ones first, and the length of each."""
    values = np.asarray(values).astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    limit = 7
    while limit < 64 and (larger := values >= np.uint64(1) << np.uint64(limit)).any():
        sizes += larger
        limit += 7
    places = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        here = slice(None) if k == 0 else np.flatnonzero(sizes > k)
        low = (values[here] >> np.uint64(7 * k)).astype(np.uint8) & np.uint8(127)
        out[places[here] + k] = low | ((sizes[here] > k + 1).astype(np.uint8) << np.uint8(7))
    return out, sizes


def unpack(data: bytes | np.ndarray) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8) if not isinstance(data, np.ndarray) else data
    if not len(raw):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate(([0], ends[:-1] + 1))
    sizes = ends - starts + 1
    out = (raw[starts] & np.uint8(127)).astype(np.uint64)
    for k in range(1, int(sizes.max())):
        here = np.flatnonzero(sizes > k)
        out[here] |= (raw[starts[here] + k] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
    return out


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned values by their differences."""
    if not len(values):
        return b""
    values = values.astype(np.uint64)
    return pack(np.concatenate((values[:1], np.diff(values))))[0].tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


_SPACES = re.compile(rb"[\x20\x09-\x0D]")


def word_lists(raw: bytes, size: int = _SLICE) -> Iterator[list[bytes]]:
    """The words of one text in lists of about ``size`` bytes, so that a long text needs no more at once."""
    at = 0
    while at < len(raw):
        cut = _SPACES.search(raw, at + size)
        end = cut.start() if cut else len(raw)
        yield raw[at:end].split()
        at = end
