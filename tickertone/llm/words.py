"""Words and their hashes for whole Arrow columns of text, without a Python object per word.

A word is a maximal run of characters other than ASCII white space (space and U+0009 to
U+000D). Its hash is a 64-bit polynomial of its bytes, mixed; equal words have equal hashes
everywhere, and two different ones share a hash with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19  # texts are worked on about this much at a time
CHUNK_ROWS = 4096
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEPS = tuple(np.uint64(x) for x in (
    0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
))
_powers: dict[str, np.ndarray] = {}


@dataclass
class Texts:
    """Some consecutive rows of a text column: their bytes, and where each text starts."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    valid: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def texts(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column in pieces of about ``size`` bytes and CHUNK_ROWS rows at most, whole texts
    each; a null text is empty."""
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return
    valid = np.asarray(column.is_valid())
    held = column.buffers()
    offsets = np.frombuffer(held[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(held[2], dtype=np.uint8) if held[2] else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, first + CHUNK_ROWS, max(first + 1, last))
        at = offsets[first:last + 1]
        yield Texts(first, data[at[0]:at[-1]], at - at[0], valid[first:last])
        first = last


def _power(name: str, base: int, n: int) -> np.ndarray:
    table = _powers.get(name)
    if table is None or len(table) < n:
        table = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        _powers[name] = table
    return table[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered(data: np.ndarray) -> np.ndarray:
    """A to Z in lower case, everything else as it is."""
    return _LOWER[data]


def split_words(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text the index of its first word."""
    data, at = part.data, part.offsets
    if len(data) == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(at), dtype=np.int64)
    inside = ~_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    inner = at[1:-1]
    edges = inner[(inner > 0) & (inner < len(data))]  # words end where texts do
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span [start, end) of ``values``: bytes, or hashes of words."""
    n = len(values) + 1
    sums = np.zeros(n, dtype=np.uint64)
    weights = _power("up", _BASE, n)[:-1]
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * weights, out=sums[1:])
    shift = _power("down", pow(_BASE, -1, 1 << 64), n)
    return mixed((sums[ends] - sums[starts]) * shift[starts])


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` consecutive values."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        total = total * _STEPS[0] + hashes[i:i + count] * _STEPS[1 + i % 3]
    return mixed(total)


def counts_between(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """How many of ``flags`` hold between each two neighbouring ``edges``."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[edges])


def characters(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a character."""
    return (data & 0xC0) != 0x80


def spaces(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its values and the length of each list."""
    edges = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=edges[1:])
    return pa.ListArray.from_arrays(pa.array(edges), pa.array(values).cast(kind))
