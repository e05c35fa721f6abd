"""Sparse suffix arrays: repeats from the neighbours of a few selected suffixes.

Of every ``width`` consecutive words the minimiser, the run of ``ORDER`` words
with the smallest fingerprint, selects the suffix that starts there; equal
windows select the same suffix of theirs.  About one suffix in
(width - ORDER + 2) / 2 is retained, and of these only such whose first
``ORDER`` words another document has too.  A retained suffix carries its words,
up to ``width`` from its start, and up to width - ORDER words to its left: what
the windows that selected it span.

The suffixes are sorted by their words, over all tasks by ranges of the first
``ORDER``, and every suffix gets the length of the common prefix with its
neighbour before it (LCP).  A window that starts l words left of its suffix is
also in another document if that one's suffix shares width - l words, which is
a stretch of neighbours whose LCP is no less, and the match extends l words to
the left.  So each stretch is split by its left words, and all but the smallest
document of a part hold a repeat.

Words stand for themselves by ``BYTES`` bytes of their fingerprints; a window is
taken for another only if all of its words are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .repeats import mark_batch
from .repeats import without_repeats as without_repeats_by
from .words import mix, shingles

#: Words that a minimiser spans, and bytes that a word has in a suffix.
ORDER, BYTES = 16, 5
#: Suffixes that a task compares at once; a run of neighbours that share ORDER words is never cut.
COMPARED = 5_000


def leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of its least, the first one of equals."""
    n = len(values) - width + 1
    at, span = np.arange(len(values)), 1
    while 2 * span <= width:
        a, b = at[:-span], at[span:]
        at = np.where(values[b] < values[a], b, a)
        span *= 2
    a, b = at[:n], at[width - span : width - span + n]
    return np.where(values[b] < values[a], b, a)


def anchors(h: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of ``width`` words within documents, and the first words' fingerprint of their suffixes."""
    return suffixes(h, ends, width)[:2]


def suffixes(h: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``anchors``, and where the windows' suffixes start."""
    starts = np.flatnonzero(np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(h)) >= width)
    if not len(starts):
        return starts, np.empty(0, np.uint64), starts
    order = min(ORDER, width)
    values = shingles(h, order)
    places = leftmost_least(values, width - order + 1)[starts]
    return starts, values[places], places


def pack(h: np.ndarray, width: int, start: int, windows: int) -> bytes:
    """The first ``BYTES`` bytes of the fingerprint of every word that some consecutive windows span."""
    return h[start : start + windows + width - 1].astype(">u8").view(np.uint8).reshape(-1, 8)[:, :BYTES].tobytes()


def unpack(data: list[bytes]) -> np.ndarray:
    """The words of all suffixes, one after the other, as numbers."""
    flat = np.frombuffer(b"".join(data), np.uint8).reshape(-1, BYTES)
    words = np.zeros((len(flat), 8), np.uint8)
    words[:, 8 - BYTES :] = flat
    return words.view(">u8").ravel().astype(np.uint64)


def common_prefixes(right: np.ndarray) -> np.ndarray:
    """LCP: how many leading words each suffix shares with the one before it; 0 for the first."""
    lcp = np.zeros(len(right), np.int64)
    if len(right) > 1:
        differ = right[1:] != right[:-1]
        lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), right.shape[1])
    return lcp


def compared(suffixes_: list[dict], width: int) -> pa.RecordBatch:
    """Marks of sorted suffixes (id, tag, place: start of the first window, at: words before the suffix, data)."""
    sizes = np.array([len(s["data"]) // BYTES for s in suffixes_], np.int64)
    if not len(sizes):
        return mark_batch(*[np.empty(0, np.int64)] * 3)
    words = unpack([s["data"] for s in suffixes_])
    ids, tags, places, at = (np.array([s[c] for s in suffixes_], np.int64) for c in ("id", "tag", "place", "at"))
    begin = np.cumsum(sizes) - sizes + at
    # words that a suffix doesn't have differ from all others
    own = (np.arange(len(sizes), dtype=np.uint64) + np.uint64(1) << np.uint64(8 * BYTES))[:, None]

    def around(offsets: np.ndarray, there: np.ndarray) -> np.ndarray:
        return np.where(there, words[np.clip(begin[:, None] + offsets, 0, len(words) - 1)], own)

    ahead, back = np.arange(width), np.arange(1, width - min(ORDER, width) + 1)
    right = around(ahead, ahead < (sizes - at)[:, None])
    left = around(-back, back <= at[:, None])
    lcp = common_prefixes(right)
    # the words to the left, read outwards, as a fingerprint for each number of them
    extended = np.zeros((len(sizes), len(back) + 1), np.uint64)
    for k in range(len(back)):
        extended[:, k + 1] = mix(extended[:, k] ^ left[:, k])
    found = []
    for l in range(len(back) + 1):
        stretch = np.cumsum(lcp < width - l)
        has = np.flatnonzero((at >= l) & (sizes - at >= width - l))
        # stretches of one suffix repeat nothing
        has = has[np.bincount(stretch[has], minlength=len(sizes) + 1)[stretch[has]] > 1]
        if not len(has):
            continue
        order = np.lexsort((ids[has], extended[has, l], stretch[has]))
        has = has[order]
        new = np.ones(len(has), bool)
        new[1:] = (stretch[has[1:]] != stretch[has[:-1]]) | (extended[has[1:], l] != extended[has[:-1], l])
        least = ids[has][new][np.cumsum(new) - 1]
        repeats = has[ids[has] > least]
        found.append((ids[repeats], tags[repeats], places[repeats] + at[repeats] - l))
    return mark_batch(*(np.concatenate(x) for x in zip(*found, strict=True))) if found else mark_batch(*[np.empty(0, np.int64)] * 3)


def settle(claims: DataFrame, width: int) -> DataFrame:
    """Sorts the retained suffixes and compares neighbours."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[dict] = []  # the neighbours that share their first words, last
        held: list[dict] = []  # runs of two suffixes or more, to be compared
        for batch in batches:
            for suffix in batch.to_pylist():
                if run and run[-1]["head"] != suffix["head"]:
                    held += run if len(run) > 1 else []
                    run = []
                    if len(held) >= COMPARED:
                        yield compared(held, width)
                        held = []
                run.append(suffix)
        yield compared(held + (run if len(run) > 1 else []), width)

    tasks = int(claims.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(tasks, -(-claims.count() // (4 * COMPARED)))
    first = F.col("at") * BYTES + 1
    dealt = claims.drop("name").withColumn("head", F.substring("data", first, F.lit(min(ORDER, width) * BYTES))).repartitionByRange(parts, "head")
    dealt = dealt.sortWithinPartitions("head", F.substring("data", first, F.lit(width * BYTES)), "id", "tag", "place")
    return dealt.mapInArrow(compare, "id bigint, tag bigint, data binary")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 50, with_text: bool = False) -> DataFrame:
    """Removes the words of passages of ``width`` words that a document with a smaller key holds as well.

    The rows returned, nulls, empty texts and repeated rows: as in ``repeats.without_repeats``.
    """
    return without_repeats_by(docs, suffixes, lambda claims: settle(claims, width), key, text, width, with_text, pack)
