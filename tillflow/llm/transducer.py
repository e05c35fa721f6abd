"""A table-driven transducer over UTF-8 bytes, and the hash table that its word spans go into.

The machine has two states, between words and in a word, and its state after a
byte depends on that byte's class alone.  So a table of (class before, class)
pairs gives every byte's outputs, a whole block of bytes at a time: whether a
word starts or ends here, and whether the byte is a code point, a capital, a
symbol.  Documents follow each other with a blank in between, which puts the
machine back between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

BLANK, PLAIN, CAPITAL, SYMBOL, LEAD, CONTINUATION = range(6)
STARTS, ENDS, POINT, IS_CAPITAL, IS_SYMBOL = (1 << i for i in range(5))
SYMBOLS = b"#$%&*|"
#: Bytes that go through the tables at once.
BLOCK = 1 << 20
#: Words up to so many bytes are compared eight bytes at a time; longer ones one by one.
SHORT = 32


def class_table() -> np.ndarray:
    """The class of every byte."""
    found = np.full(256, PLAIN, np.uint8)
    found[[0x20, *range(0x09, 0x0E)]] = BLANK
    found[ord("A") : ord("Z") + 1] = CAPITAL
    found[list(SYMBOLS)] = SYMBOL
    found[0x80:0xC0] = CONTINUATION
    found[0xC0:] = LEAD
    return found


def output_table() -> np.ndarray:
    """The outputs of a byte, by 8 * class of the byte before + class."""
    found = np.zeros(64, np.uint8)
    for before in range(6):
        for now in range(6):
            out = 0 if now == CONTINUATION else POINT
            out |= STARTS if before == BLANK and now != BLANK else 0
            out |= ENDS if before != BLANK and now == BLANK else 0
            out |= IS_CAPITAL if now == CAPITAL else IS_SYMBOL if now == SYMBOL else 0
            found[8 * before + now] = out
    return found


CLASS, OUTPUT = class_table(), output_table()


@dataclass
class Counts:
    """Per document: words, distinct words, capitals, code points, symbols."""

    words: np.ndarray
    distinct: np.ndarray
    capitals: np.ndarray
    points: np.ndarray
    symbols: np.ndarray


def outputs(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, outputs) block by block; the state goes on from block to block."""
    before = BLANK
    for at in range(0, len(data), BLOCK):
        now = CLASS[data[at : at + BLOCK]]
        pairs = now.copy()
        pairs[0] += 8 * before
        pairs[1:] += now[:-1] << 3
        before = int(now[-1])
        yield at, OUTPUT[pairs]


def counted(texts: list[bytes]) -> Counts:
    """One pass over the texts, and their distinct words."""
    n = len(texts)
    lengths = np.fromiter(map(len, texts), np.int64, n) + 1
    ends_of = np.cumsum(lengths)
    # eight more blanks, so that eight bytes can be read at every word
    buffer = b" ".join([*texts, b" " * 8])
    data = np.frombuffer(buffer, np.uint8)
    sums = {k: np.zeros(n + 1, np.int64) for k in (POINT, IS_CAPITAL, IS_SYMBOL)}
    starts, stops = [], []
    for at, out in outputs(data):
        # documents that this block touches; the blanks at the end are one more
        first, last = np.searchsorted(ends_of, [at, at + len(out) - 1], side="right")
        cuts = np.maximum(np.concatenate([[0], ends_of[first:last]]) - at, 0)
        cuts[0] = 0
        for k, total in sums.items():
            total[first : last + 1] += np.add.reduceat((out & k) != 0, cuts, dtype=np.int64)
        starts.append(np.flatnonzero(out & STARTS) + at)
        stops.append(np.flatnonzero(out & ENDS) + at)
    start, stop = np.concatenate(starts), np.concatenate(stops)
    owner = np.searchsorted(ends_of, start, side="right")
    return Counts(
        np.bincount(owner, minlength=n)[:n], distinct_spans(buffer, start, stop, owner, n),
        sums[IS_CAPITAL][:n], sums[POINT][:n] - 1, sums[IS_SYMBOL][:n],
    )


def distinct_spans(buffer: bytes, start: np.ndarray, stop: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per owner how many different byte strings its spans hold."""
    long = stop - start > SHORT
    found = np.zeros(n, np.int64)
    seen = {(o, buffer[a:b]) for o, a, b in zip(owner[long].tolist(), start[long].tolist(), stop[long].tolist(), strict=True)}
    np.add.at(found, np.array([o for o, _ in seen], np.int64), 1)

    start, size, owner = start[~long], (stop - start)[~long], owner[~long]
    if len(start):
        found += inserted(span_values(buffer, start, size), size, owner, n)
    return found


def span_values(buffer: bytes, start: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """The spans' bytes, eight to a number, zeros after their end."""
    eights = np.ndarray((len(buffer) - 7,), "<u8", buffer, 0, (1,))
    values = []
    for k in range(0, int(size.max()), 8):
        left = np.clip(size - k, 0, 8)
        mask = np.where(left == 8, ~np.uint64(0), (np.uint64(1) << (8 * (left % 8)).astype(np.uint64)) - np.uint64(1))
        values.append(eights[np.minimum(start + k, len(eights) - 1)] & mask)
    return values


def inserted(values: list[np.ndarray], size: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Puts all spans into one open hash table; per owner how many found no equal one there.

    A slot's span is compared in owner, length and bytes, so equal hashes say nothing by themselves.
    """
    keys = [owner.astype(np.uint64) << np.uint64(32) | size.astype(np.uint64), *values]
    code = np.zeros(len(owner), np.uint64)
    for part in keys:
        code = (code ^ part) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    bits = max(4, (2 * len(owner)).bit_length())
    mask = (1 << bits) - 1
    slot = (code >> np.uint64(64 - bits)).astype(np.int64)
    table = np.full(1 << bits, -1, np.int64)
    found = np.zeros(n, np.int64)
    rest = np.arange(len(owner))
    while len(rest):
        at = slot[rest]
        free = table[at] < 0
        table[at[free]] = rest[free]
        held = table[at]
        same = np.ones(len(rest), bool)
        for part in keys:
            same &= part[held] == part[rest]
        found += np.bincount(owner[rest[held == rest]], minlength=n)
        rest = rest[~same]
        slot[rest] = (slot[rest] + 1) & mask
    return found
