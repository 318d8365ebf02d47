"""Hashes of words and word runs of many texts at once, as numpy arrays.

Used inside tasks on slabs of bounded size.  A word is hashed from its bytes; a run's
hash is joined from those of shorter runs, in a number of steps that grows with the
logarithm of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that are hashed at once; a longer text is a slab of its own.
SLAB_BYTES = 500_000


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two neighbouring runs from theirs."""
    return mix(mix(a, 1) ^ b, 2)


class Words:
    """The words of a slab of texts: ``counts`` by text, byte ``starts`` and ``ends``, ``hashes``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        n = len(data)
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        word = ~space
        begins = word.copy()
        begins[1:] &= space[:-1] | edge[1:n]
        ends = word.copy()
        ends[:-1] &= space[1:] | edge[1:n]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.firsts = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.firsts)
        # Only A-Z of the bytes change.
        self._bytes = data.tobytes().lower() if lower else data.tobytes()
        self._by_seed: dict[int, np.ndarray] = {}
        self.hashes = self.hashed(0)

    def hashed(self, seed: int) -> np.ndarray:
        """A hash of each word's bytes; those of different seeds say nothing about each other."""
        if seed not in self._by_seed:
            text, n = self._bytes, len(self.starts)
            each = (xxhash.xxh3_64_intdigest(text[a:b], seed) for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True))
            self._by_seed[seed] = np.fromiter(each, np.uint64, n)
        return self._by_seed[seed]

    def runs(self, k: int, seed: int = 0) -> np.ndarray:
        """The hash of the k words from each word on; only those within one text mean anything.

        Runs of 1, 2, 4, ... words are joined from two halves each, and those that add
        up to k from left to right.  Fewer than k words in the slab: none.
        """
        part, size = self.hashed(seed), 1
        n, done, out = len(part), 0, None
        if n < k:
            return np.zeros(0, np.uint64)
        while True:
            if k & size:
                out = part if out is None else join(out[: n - done - size + 1], part[done:])
                done += size
            if done == k:
                return out
            part = join(part[:-size], part[size:])
            size *= 2

    def whole(self, text: int) -> np.uint64:
        """The hash of all the words of one text."""
        own = self.hashes[self.firsts[text] : self.firsts[text + 1]]
        found = np.array([len(own)], np.uint64)
        for i in range(len(own)):
            found = join(found, own[i : i + 1])
        return found[0]


def slabs(texts: pa.StringArray, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """Cut a column into slabs: first row, row after the last, and the words.

    A null is an empty text.
    """
    large = texts.cast(pa.large_string()).fill_null("")
    if len(large) == 0:
        return
    _, where, body = large.buffers()
    offsets = np.frombuffer(where, np.int64)[large.offset : large.offset + len(large) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(large):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + SLAB_BYTES, "right")) - 1)
        last = min(last, len(large))
        cut = offsets[first : last + 1]
        yield first, last, Words(data[cut[0] : cut[-1]], cut - cut[0], lower)
        first = last
