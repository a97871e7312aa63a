"""Words of whole texts as numpy arrays, taken from the bytes of Arrow string columns.

A word is a run of anything but the six white-space signs 0x20 and 0x09-0x0D.  In UTF-8 these
are single bytes that occur in no other character, so words are found byte by byte.  Texts are
handled in slices of about ``SLICE`` bytes; a longer text is a slice of its own, so memory
follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finalising mix of the public splitmix64 generator."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as long as asked for."""

    def __init__(self, base: np.uint64):
        self.base = int(base)
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up, self.down


POWERS = Powers(BASE)


def spans_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """A 64-bit hash of each ``values[start:end]``, equal for equal content."""
    up, down = powers.upto(len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


@dataclass
class Slice:
    """Rows ``first`` to ``first + n_rows`` of a batch: bytes, and where each row lies in them."""

    first: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # n_rows + 1

    @property
    def n_rows(self) -> int:
        return len(self.offsets) - 1

    def raw(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


@dataclass
class Words:
    start: np.ndarray  # byte positions in the slice
    end: np.ndarray
    bounds: np.ndarray  # n_rows + 1: the words of row r are bounds[r]:bounds[r + 1]

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def slices(texts: pa.Array, size: int = SLICE) -> Iterator[Slice]:
    """A string column cut into slices of whole rows and about ``size`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    if not n:
        return
    _, places, body = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        own = offsets[first:last + 1]
        yield Slice(first, data[own[0]:own[-1]], own - own[0])
        first = last


def words(part: Slice, separator: np.ndarray = SPACE) -> Words:
    data, offsets = part.data, part.offsets
    if not len(data):
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, np.zeros(len(offsets), np.int64))
    gap = separator[data]
    before, after = np.empty_like(gap), np.empty_like(gap)
    before[0], before[1:] = True, gap[:-1]
    after[-1], after[:-1] = True, gap[1:]
    filled = offsets[:-1] < offsets[1:]
    before[offsets[:-1][filled]] = True
    after[offsets[1:][filled] - 1] = True
    start = np.flatnonzero(~gap & before)
    end = np.flatnonzero(~gap & after) + 1
    return Words(start, end, np.searchsorted(start, offsets))


def word_hashes(part: Slice, found: Words, powers: Powers = POWERS) -> np.ndarray:
    return spans_hash(part.data.astype(np.uint64) + np.uint64(1), found.start, found.end, powers)


def windows(bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``width`` items that lie within one row, and their rows."""
    n = np.maximum(np.diff(bounds) - width + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    return np.arange(len(row)) - first[row] + bounds[:-1][row], row


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    raw = data.tobytes()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(start, end, strict=True)]
