"""Recompression: names for runs and pairs of words that equal substrings share.

Names are fingerprints of what they stand for, so every task gives equal runs
and pairs equal names without exchanging a table.  Round 0 names runs of one
word.  Each later round deals the names into left and right ones by a bit of
the name, and replaces a left name and the right name after it by the name of
the pair.  What a text holds inside, away from its ends, is named alike
wherever it stands: a symbol depends only on the words of its context, which
grows by at most one neighbour a round and is tracked exactly.

The anchor of a window is the first symbol of the highest round whose context
lies in the window, together with the ``SAID`` words that its context starts
with (or the window's last ones): a symbol that stayed short says little alone.
It is a function of the window's words, so equal windows have equal anchors,
and a window whose anchor occurs in no other document is repeated nowhere.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import marks
from .repeats import without_repeats as without_repeats_by
from .words import BASE, mix, shingles

ROUNDS = 12
SAID = 16
#: Claims that one group brings together, about.
GROUP_CLAIMS = 100_000


class Parse:
    """The symbols of one round: names, and the words [left, right) that each depends on."""

    def __init__(self, names: np.ndarray, left: np.ndarray, right: np.ndarray, fixed: np.ndarray):
        self.names, self.left, self.right, self.fixed = names, left, right, fixed

    def named_runs(self) -> Parse:
        """Round 0.  Whether a word stands alone is seen from its neighbours, so they join every context."""
        n = len(self.names)
        first = np.ones(n, bool)
        first[1:] = (self.names[1:] != self.names[:-1]) | self.fixed[1:] | self.fixed[:-1]
        start = np.flatnonzero(first)
        length = np.diff(start, append=n)
        names = np.where(length > 1, mix(self.names[start] + np.uint64(BASE) * length.astype(np.uint64)), self.names[start])
        left, right = self.left[np.maximum(start - 1, 0)], self.right[np.minimum(start + length, n - 1)]
        fixed = self.fixed[start]
        return Parse(names, np.where(fixed, self.left[start], left), np.where(fixed, self.right[start], right), fixed)

    def named_pairs(self, number: int) -> Parse:
        """One later round.  A symbol that stays alone has seen the neighbour that it could have joined."""
        n = len(self.names)
        is_left = (mix(self.names + np.uint64(number)) & np.uint64(1)).astype(bool)
        joins = np.zeros(n, bool)  # with the next symbol
        joins[:-1] = is_left[:-1] & ~is_left[1:] & ~self.fixed[:-1] & ~self.fixed[1:]
        joined = np.zeros(n, bool)  # with the one before
        joined[1:] = joins[:-1]
        keep = np.flatnonzero(~joined)
        pair, names = joins[keep], self.names[keep]
        after, before = np.minimum(keep + 1, n - 1), np.maximum(keep - 1, 0)
        alone = ~pair & ~self.fixed[keep]
        out = np.where(pair, mix(names * np.uint64(BASE) ^ self.names[after]), names)
        left = np.where(alone & ~is_left[keep], self.left[before], self.left[keep])
        right = np.where(pair | (alone & is_left[keep]), self.right[after], self.right[keep])
        return Parse(out, left, right, self.fixed[keep])


def anchors(h: np.ndarray, ends: np.ndarray, width: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``width`` words within documents, and the names of their anchors.

    ``h`` holds the words' fingerprints of several documents, ``ends`` the end
    of each document in it.
    """
    # A separator before and after every document: a symbol that no window holds and that never joins.
    n, docs = len(h), len(ends)
    sizes = np.diff(ends, prepend=0)
    shift = np.repeat(np.arange(1, docs + 1), sizes)
    place = np.arange(n) + shift
    names, fixed = np.zeros(n + docs + 1, np.uint64), np.ones(n + docs + 1, bool)
    names[place], fixed[place] = mix(h), False
    at = np.arange(n + docs + 1)
    parse = Parse(names, at, at + 1, fixed)
    parses = [parse, parse := parse.named_runs()]
    for number in range(1, rounds):
        parses.append(parse := parse.named_pairs(number))

    whole = np.repeat(ends, sizes) - np.arange(n) >= width
    starts = np.flatnonzero(whole)
    wanted, found, found_at = place[starts], np.zeros(len(starts), np.uint64), starts.copy()
    open_ = np.arange(len(starts))
    for parse in reversed(parses):
        own = ~parse.fixed
        names, left, right = parse.names[own], parse.left[own], parse.right[own]
        if not len(names) or not len(open_):
            continue
        before = np.cumsum(np.bincount(left, minlength=n + docs + 2))
        first = before[wanted[open_] - 1]
        first_in = np.minimum(first, len(names) - 1)
        fits = (first < len(names)) & (right[first_in] <= wanted[open_] + width)
        found[open_[fits]] = names[first_in[fits]]
        found_at[open_[fits]] += left[first_in[fits]] - wanted[open_[fits]]
        open_ = open_[~fits]
    said = min(SAID, width)
    words = shingles(h, said)
    if len(starts):
        found = mix(found ^ words[np.minimum(found_at, starts + width - said)])
    return starts, found


def settle(claims: DataFrame) -> DataFrame:
    """Claims whose anchors have equal names meet in one group of names; their windows verify the repeat."""
    spark = claims.sparkSession
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-claims.count() // GROUP_CLAIMS))

    def verify(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([marks(table.to_pylist())])

    dealt = claims.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(groups)))
    return dealt.groupBy("part").applyInArrow(verify, "id bigint, tag bigint, data binary")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 50, with_text: bool = False) -> DataFrame:
    """Removes the words of passages of ``width`` words that a document with a smaller key holds as well.

    The rows returned, nulls, empty texts and repeated rows: as in ``repeats.without_repeats``.
    """
    return without_repeats_by(docs, anchors, settle, key, text, width, with_text)
