"""Words of many texts at once, on the UTF-8 bytes of an Arrow column.

Every function works on a slice of rows of bounded size (``slices``), so a task never holds the
arrays of more than half a megabyte of text, or of one text if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(holds) -> np.ndarray:
    """A table of 256 flags: the bytes for which ``holds`` is true."""
    return np.array([bool(holds(b)) for b in range(256)])


#: Bytes of words of letters and digits, after lower-casing; every byte of a non-ASCII character belongs to a word.
ALNUM = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: Bytes of words between white space.
SOLID = byte_class(lambda b: b != 32 and not 9 <= b <= 13)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of ``batch`` with the bytes of ``column`` and the n + 1 offsets of its rows; a null text counts as empty."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield batch.slice(at, to - at), data[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to


def find(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the number of words before each row (n + 1 values)."""
    member = inside[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = member[:-1], member[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(member & ~before), np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2^64."""
    global _powers
    if len(_powers[0]) < n:
        out = []
        for factor in (_MULTIPLIER, _INVERSE):
            p = np.full(max(n, SLICE_BYTES + 64), factor, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers = tuple(out)
    return _powers


class Hasher:
    """64-bit hashes of any byte ranges of one array, by differences of one running sum."""

    def __init__(self, values: np.ndarray):
        up, self._down = _power(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self._sums[1:])

    @classmethod
    def of_bytes(cls, data: np.ndarray) -> Hasher:
        return cls(_BYTE_VALUES[data])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))


def single_spaced(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one space after each, and their start and end bytes there."""
    lengths = ends - starts
    to = np.cumsum(lengths + 1)
    new_starts = to - lengths - 1
    out = np.full(int(to[-1]) if len(to) else 0, 32, np.uint8)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(new_starts, lengths) + within] = data[np.repeat(starts, lengths) + within]
    return out.tobytes(), new_starts, new_starts + lengths
