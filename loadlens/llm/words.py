"""Words of many texts at once, as numpy arrays over the bytes of an Arrow column.

Words are runs of bytes other than 0x20 and 0x09-0x0D. UTF-8 continuation bytes are never among those,
so splitting bytes splits code points correctly. A word stands for its 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are looked at together; a longer text is a block of its own.
BLOCK_BYTES = 1 << 21
NO_SPACE = np.ones(256, bool)
NO_SPACE[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


class Powers:
    """_BASE^i and its inverse for i up to n, kept for the next call; travels to workers empty."""

    def __init__(self):
        self.both = ()

    def __reduce__(self):
        return Powers, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.both or len(self.both[0]) <= n:
            size = max(n + 1, BLOCK_BYTES + 1)
            both = []
            for base in (_BASE, _INVERSE):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                both.append(np.cumprod(p, dtype=np.uint64))
            self.both = tuple(both)
        return self.both


powers = Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number spread over all bits (one to one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Block:
    """Consecutive texts of a column: rows [first, first + n), their bytes, where each text begins and ends."""

    first: int
    n: int
    data: np.ndarray
    at: np.ndarray


@dataclass
class Words:
    """start, end: byte ranges; doc: number of the text in the block; key: hash; docs: first word of each text."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    key: np.ndarray
    docs: np.ndarray


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column in blocks of at most `most` bytes or one text; null is empty."""
    if not len(texts):
        return
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, side="right")) - 1)
        yield Block(i, j - i, data[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


def range_keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def words_in(block: Block, data: np.ndarray) -> Words:
    """The words of a block; data: its bytes, lower-cased or not."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = NO_SPACE[data]
    cut = np.zeros(len(data) + 1, bool)  # a text begins here
    cut[block.at] = True
    begins = inside[1:] & (~inside[:-1] | cut)
    ends = inside[:-1] & (~inside[1:] | cut)
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    doc = np.searchsorted(block.at, start, side="right") - 1
    docs = np.searchsorted(start, block.at)
    return Words(start, end, doc, range_keys(data, start, end), docs)
