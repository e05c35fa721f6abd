"""Benchmark decontamination by containment search with size-partitioned MinHash sketches.

The short benchmark items are the queries, the documents the long domain.  For
an item of n distinct shingles and containment t, a document that holds at
least ceil(t n) of them misses at most n - ceil(t n).  So of any
n - ceil(t n) + 1 shingles of the item the document holds one.  The item's
sketch is that many of its smallest hashes under one random order: a bottom-k
MinHash sketch whose k follows from the item's size, so that no leak can slip
through however long the document is (a document's own MinHash, which long
texts dilute, is never used).

Items are partitioned by size, a power of two of shingles each.  A document
probes the sketches of a partition only if it has enough shingles to contain
the partition's smallest item.  Candidates are verified on the spot: the
shingles themselves, as words, are looked up in the document.

Items go to the tasks in blocks of bounded size; every block passes over all
documents, which are not shuffled.  The driver holds one block at a time: with
several, what each has found is written before the next is made.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .memory import lean
from .scratch import stored
from .words import Fingerprints, shingles, slices, split

#: Code points of benchmark text in a block: what the driver holds at once and a task gets.
BLOCK_CHARS = 4_000_000
#: Words that a task remembers the fingerprints of.
WORDS = 100_000


def needed(n: int, percent: int) -> int:
    """The fewest shingles of n that make up ``percent`` of them."""
    return -(-n * percent // 100)


class Sketches:
    """The items of a block: sketches by shingle width and size partition, and the shingles to verify with."""

    def __init__(self, items: list[tuple[object, str]], width: int, percent: int):
        self.percent = percent
        self.items: list[tuple[object, int, set[bytes]]] = []
        prints = Fingerprints()
        parts: dict[tuple[int, int], list[tuple[np.ndarray, int]]] = defaultdict(list)
        for key, text in items:
            words = split(text, lower=True)
            if not words:
                continue
            w = min(width, len(words))
            own = {b" ".join(words[i : i + w]) for i in range(len(words) - w + 1)}
            hashes = np.unique(shingles(prints.of(words), w))
            sketch = hashes[: len(own) - needed(len(own), percent) + 1]
            parts[w, len(own).bit_length()].append((sketch, len(self.items)))
            self.items.append((key, w, own))
        #: width -> partitions of (fewest shingles a document needs, sorted sketch values, their items)
        self.parts: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = defaultdict(list)
        for (w, _), found in sorted(parts.items()):
            values = np.concatenate([s for s, _ in found])
            owners = np.concatenate([np.full(len(s), i) for s, i in found])
            order = np.argsort(values, kind="stable")
            least = min(needed(len(self.items[i][2]), percent) for _, i in found)
            self.parts[w].append((least, values[order], owners[order]))

    def candidates(self, h: np.ndarray) -> set[int]:
        """Items with a sketch value among the shingles of a document."""
        found: set[int] = set()
        for w, parts in self.parts.items():
            if len(h) < w:
                continue
            values = shingles(h, w)
            for least, sketch, owners in parts:
                if len(values) < least:
                    continue
                hits = values[self.seen[w][(values & self.mask).astype(np.int64)]]
                if len(hits):
                    low, high = np.searchsorted(sketch, hits, "left"), np.searchsorted(sketch, hits, "right")
                    found.update(int(o) for a, b in zip(low, high, strict=True) if b > a for o in owners[a:b])
        return found

    def index(self) -> Sketches:
        """Adds, per width, which low bits any sketch value has; made in the task, as it is larger than the sketches."""
        total = sum(len(v) for parts in self.parts.values() for _, v, _ in parts)
        size = 1 << max(16, min(24, (total * 32).bit_length()))
        self.mask = np.uint64(size - 1)
        self.seen = {}
        for w, parts in self.parts.items():
            self.seen[w] = np.zeros(size, bool)
            for _, values, _ in parts:
                self.seen[w][(values & self.mask).astype(np.int64)] = True
        return self

    def leaks(self, words: list[bytes], h: np.ndarray) -> list[tuple[object, int, int]]:
        """(item, shingles it shares, shingles it has) of the items that the document contains."""
        out, of_width = [], {}
        for i in sorted(self.candidates(h)):
            key, w, own = self.items[i]
            if w not in of_width:
                of_width[w] = {b" ".join(words[k : k + w]) for k in range(len(words) - w + 1)}
            shared = len(own & of_width[w])
            if shared >= needed(len(own), self.percent):
                out.append((key, shared, len(own)))
        return out


def block_count(items: DataFrame, text: str, block_chars: int) -> int:
    size = items.where(F.trim(text) != "").agg(F.sum(F.char_length(text))).first()[0] or 0
    return max(1, -(-size // block_chars))


def blocks(items: DataFrame, key: str, text: str, n: int) -> Iterator[list[tuple[object, str]]]:
    """The items in n blocks, one after the other; an item longer than a block is one alone."""
    items = items.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.trim("text") != "")
    for i in range(n):
        block: list[Row] = (items.where(F.pmod(F.xxhash64("key", "text"), F.lit(n)) == i) if n > 1 else items).collect()
        if block:
            yield [(r["key"], r["text"]) for r in block]


def found_by(rows: DataFrame, sketches: Sketches, schema: str, item_kind: str) -> DataFrame:
    """(key, item, n_shared, n_item) of rows (key, text) and the items of one block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, prints = sketches.index(), Fingerprints(limit=WORDS)
        for batch in slices(batches, "text"):
            at: list[int] = []
            hits: list[tuple[object, int, int]] = []
            for i, t in enumerate(batch.column("text").to_pylist()):
                words = split(t, lower=True)
                for leak in index.leaks(words, prints.of(words)):
                    at.append(i)
                    hits.append(leak)
            keys = batch.column("key").take(pa.array(at, pa.int64()))
            items, shared, n = zip(*hits, strict=True) if hits else ((), (), ())
            kinds = pa.int64() if item_kind == "bigint" else None
            yield pa.RecordBatch.from_arrays([keys, pa.array(items, kinds or pa.string()), pa.array(shared, pa.int64()), pa.array(n, pa.int64())], ["key", "item", "n_shared", "n_item"])

    return rows.mapInArrow(lean(task), schema)


def without(docs: DataFrame, sketches: Sketches, text: str) -> DataFrame:
    """The rows of ``docs`` that contain no item of one block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, prints = sketches.index(), Fingerprints(limit=WORDS)
        for batch in slices(batches, text):
            words = [split(t, lower=True) for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array([not index.leaks(w, prints.of(w)) for w in words], pa.bool_()))

    return docs.mapInArrow(lean(task), docs.schema)


def contained(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    percent: int = 80, width: int = 5, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Pairs (key, item_key, n_shared, n_item): documents that hold ``percent`` of an item's distinct shingles.

    Words are runs of bytes other than space and \\x09-\\x0D with A-Z in lower
    case; shingles are ``width`` words.  An item of fewer words is one shingle
    of all of them; an item without words matches nothing, and neither does a
    document without.  Null texts count as empty.  Repeated rows of documents
    or items give repeated pairs.  Other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind, item_kind = rows.schema["key"].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"key {kind}, item {item_kind}, n_shared bigint, n_item bigint"
    found: list[DataFrame] = []
    n = block_count(items, item_text, block_chars)
    for block in blocks(items, item_key, item_text, n):
        one = found_by(rows, Sketches(block, width, percent), schema, item_kind)
        found.append(stored(one, "leaks") if n > 1 else one)
    empty = docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionAll, found, empty).withColumnsRenamed({"key": key, "item": item_key})


def without_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    percent: int = 80, width: int = 5, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item by the rule of ``contained``.

    Each row is judged by its own text alone, so nulls and repeats in other
    columns don't matter.  With one block nothing is shuffled; with several the
    texts found are named by their digests, and rows of these names go.
    """
    n = block_count(items, item_text, block_chars)
    if n == 1:
        for block in blocks(items, item_key, item_text, n):
            return without(docs, Sketches(block, width, percent), text)
        return docs
    name = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    pairs = contained(docs.select(name.alias("__name"), text), items, "__name", text, item_key, item_text, percent, width, block_chars)
    return docs.withColumn("__name", name).join(pairs.select("__name").distinct(), "__name", "left_anti").select(docs.columns)
