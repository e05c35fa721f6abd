"""Words, their fingerprints and word shingles, as arrays over a batch of texts.

A word is a maximal run of bytes other than space and \\x09-\\x0D, which is what
``bytes.split`` returns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Odd multiplier of the rolling fingerprints and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class Fingerprints(dict):
    """Word -> 64-bit fingerprint; forgets all words when it has grown to ``limit``."""

    def __init__(self, seed: int = 0, limit: int = 800_000):
        super().__init__()
        self.seed, self.limit = seed, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def split(text: str | None, lower: bool = False) -> list[bytes]:
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of all runs of ``width`` consecutive words; empty if there are fewer words."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total *= np.uint64(BASE)
        total += h[k : k + n]
    return mix(total)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i below n."""
    up, down = np.full(n, BASE, np.uint64), np.full(n, BASE_INVERSE, np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def window_prints(h: np.ndarray, width: int) -> np.ndarray:
    """As ``shingles``, in time that doesn't depend on the width."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = powers(len(h))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * up, dtype=np.uint64)])
    return mix((total[width:] - total[:n]) * down[:n])


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each holds about ``most`` bytes of the column, or one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
