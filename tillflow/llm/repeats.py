"""Words of documents that repeat a passage of a document with a smaller id.

What the two methods (recompression and sparse suffix arrays) share.  A method
names every window of ``width`` words by an anchor that depends on the window's
words alone.

1. Every document's distinct anchors are counted by document.  Anchors of one
   document only are done with.
2. Documents get the list of their shared anchors; those without are done with,
   and but for a few that a filter takes for others their texts are not shuffled.
3. The windows at shared anchors are fingerprinted (96 bits, two functions).
   Within a task a window that a smaller document of the task also has is
   marked at once, so that a passage which a third of all documents hold
   leaves a task as one claim.  The others travel as runs of windows that
   share an anchor.
4. The method brings equal anchors together and marks every window that a
   smaller document holds.
5. Marked windows meet their documents, and covered words are removed.

Rows are known by id and a fingerprint of the text, so that rows which share an
id don't share their marks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import lean
from .scratch import free, remove, stored
from .words import Fingerprints, slices, split, window_prints

#: Claims that a task holds before it sends them.
HELD = 1_000_000
#: Words of documents that are parsed at once.
AT_ONCE = 100_000
#: Bits of a filter: for each row that it holds, about, and in all, at most.
ROW_BITS, FILTER_BITS = 16, 1 << 27
DONE, OPEN, CLAIM, MARK, ALIAS = range(5)
NULL_ID = (1 << 63) - 1
#: (fingerprints of words, ends of documents, width) -> starts of windows, their anchors' names and, for some methods, places
Anchors = Callable[[np.ndarray, np.ndarray, int], tuple[np.ndarray, ...]]
#: (the words' fingerprints of a document, width, start of the first window of a run, windows) -> the words that a claim carries
Pack = Callable[[np.ndarray, int, int, int], bytes]


def groups(rows: Iterator[tuple], sizes: Callable[[tuple], int], most: int) -> Iterator[list[tuple]]:
    """Cuts rows into lists of about ``most`` in total."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += sizes(row)
        if total >= most:
            yield held
            held, total = [], 0
    if held:
        yield held


def hashed(batches: Iterator[pa.RecordBatch], prints: Fingerprints, least: int, asked: str | None = None) -> Iterator[list[tuple]]:
    """Lists of (row of the batch as a dict without text, words, fingerprints).

    Fingerprints are made for documents with ``least`` words or more, where the column ``asked`` holds anything.
    """
    for batch in slices(batches, "text"):
        others = batch.drop_columns(["text"]).to_pylist()
        words = (split(t) for t in batch.column("text").to_pylist())
        rows = ((o, w, prints.of(w) if len(w) >= least and (asked is None or o[asked]) else None) for o, w in zip(others, words, strict=True))
        yield from groups(rows, lambda r: len(r[1]), AT_ONCE)


def joined_hashes(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([h for *_, h in rows]), np.cumsum([len(h) for *_, h in rows])


def likely(rows: DataFrame, wanted: DataFrame, *names: str) -> DataFrame:
    """Rows with a column ``likely``: true for all whose names are among those wanted, and for few others.

    A filter of ``FILTER_BITS`` bits at most goes to all tasks; when it is too
    small for what is wanted, more rows are likely.
    """
    bits = min(FILTER_BITS, max(1 << 15, 1 << (ROW_BITS * wanted.count()).bit_length()))
    at = F.pmod(F.xxhash64(*names), F.lit(bits)) + 1
    bucket, bit = F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit")
    maps = wanted.select(bucket, bit).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
    byte = F.conv(F.hex(F.substring("map", F.shiftright("bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(F.getbit(byte, F.col("bit").bitwiseAND(7).cast("int")) == 1, F.lit(False))
    asked = rows.select("*", bucket, bit).join(F.broadcast(maps), "bucket", "left")
    return asked.select(*rows.columns, found.alias("likely"))


def anchor_table(docs: DataFrame, anchors: Anchors, width: int) -> DataFrame:
    """Distinct (name, id, tag) of the windows of each document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints()
        for rows in hashed(batches, prints, width):
            rows = [r for r in rows if r[2] is not None]
            if not rows:
                continue
            h, ends = joined_hashes(rows)
            starts, names, *_ = anchors(h, ends, width)
            doc = np.searchsorted(ends, starts, side="right")
            order = np.lexsort((names, doc))
            doc, names = doc[order], names[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (names[1:] != names[:-1])
            ids, tags = (np.array([o[c] for o, *_ in rows], np.int64) for c in ("id", "tag"))
            yield pa.RecordBatch.from_arrays([pa.array(names[new].view(np.int64)), pa.array(ids[doc[new]]), pa.array(tags[doc[new]])], ["name", "id", "tag"])

    return docs.mapInArrow(lean(task), "name bigint, id bigint, tag bigint")


class Claims:
    """Windows of a task: marks those that a smaller document of the task has, and sends the others as runs.

    Of equal windows of a document only the first is sent; the others are known
    as its aliases, so that a word repeated a million times is one window.  A
    run's windows follow each other and share their anchor, its place included.
    It carries its windows' fingerprints, or what ``pack`` makes of the
    document's words.
    """

    def __init__(self, width: int, pack: Pack | None = None) -> None:
        self.width, self.pack = width, pack
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.docs: list[np.ndarray] = []
        self.size = 0

    def add(self, row: dict, h: np.ndarray, starts: np.ndarray, names: np.ndarray, places: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        n = len(starts)
        doc = np.full(n, len(self.docs), np.int32)
        self.parts.append((one, two, np.full(n, row["id"]), np.full(n, row["tag"]), names, starts.astype(np.int32), places.astype(np.int32), doc))
        self.docs.append(h if self.pack else h[:0])
        self.size += n

    def rows(self) -> Iterator[dict]:
        if not self.size:
            return
        one, two, ids, tags, names, starts, places, doc = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        docs = self.docs
        self.parts, self.docs, self.size = [], [], 0
        repeated = marked(one, two, ids)
        for i, j in bounds(ids[repeated], tags[repeated]):
            at = np.flatnonzero(repeated)[i:j]
            yield {"kind": MARK, "id": ids[at[0]], "tag": tags[at[0]], "data": starts[at].tobytes()}
        left = np.flatnonzero(~repeated)
        order = left[np.lexsort((starts[left], two[left], one[left], tags[left], ids[left]))]
        first = np.ones(len(order), bool)
        if len(order):
            first[1:] = (np.diff(ids[order]) != 0) | (np.diff(tags[order]) != 0) | (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
            stands = order[first][np.cumsum(first) - 1]
            again, same = order[~first], stands[~first]
            for i, j in bounds(ids[again], tags[again]):
                pairs = np.column_stack([starts[again[i:j]], starts[same[i:j]]]).astype(np.int32)
                yield {"kind": ALIAS, "id": ids[again[i]], "tag": tags[again[i]], "data": pairs.tobytes()}
        left = np.sort(order[first])
        one, two, ids, tags, names, starts, places, doc = (x[left] for x in (one, two, ids, tags, names, starts, places, doc))
        for i, j in bounds(ids, tags, doc, names, places, starts - np.arange(len(starts))):
            start = int(starts[i])
            data = self.pack(docs[doc[i]], self.width, start, j - i) if self.pack else one[i:j].tobytes() + two[i:j].tobytes()
            yield {"kind": CLAIM, "id": ids[i], "tag": tags[i], "name": int(names[i].view(np.int64)), "place": start, "at": int(places[i]) - start, "data": data}


def bounds(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of equal values in all columns."""
    n = len(columns[0])
    if not n:
        return
    new = np.zeros(n, bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    edges = np.flatnonzero(new).tolist()
    yield from zip([0, *edges], [*edges, n], strict=True)


def marked(one: np.ndarray, two: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which windows a smaller id also has."""
    order = np.lexsort((ids, two, one))
    a, b, i = one[order], two[order], ids[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    least = i[new][np.cumsum(new) - 1]
    out = np.empty(len(a), bool)
    out[order] = i > least
    return out


def unpacked(claims: list[dict]) -> tuple[np.ndarray, ...]:
    """Both fingerprints, id, tag and start of every window of some claims."""
    sizes = [len(c["data"]) // 12 for c in claims]
    one = np.concatenate([np.frombuffer(c["data"], np.uint64, n) for c, n in zip(claims, sizes, strict=True)])
    two = np.concatenate([np.frombuffer(c["data"], np.uint32, n, 8 * n) for c, n in zip(claims, sizes, strict=True)])
    ids, tags = (np.repeat(np.array([c[k] for c in claims], np.int64), sizes) for k in ("id", "tag"))
    starts = np.concatenate([np.arange(c["place"], c["place"] + n, dtype=np.int32) for c, n in zip(claims, sizes, strict=True)])
    return one, two, ids, tags, starts


def marks(claims: list[dict]) -> pa.RecordBatch:
    """id, tag and the starts of the windows among the claims that a smaller id also claims."""
    names = ["id", "tag", "data"]
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    if not claims:
        return pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names)
    one, two, ids, tags, starts = unpacked(claims)
    at = np.flatnonzero(marked(one, two, ids))
    return mark_batch(ids[at], tags[at], starts[at])


def mark_batch(ids: np.ndarray, tags: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """One row per document: id, tag and the starts of its windows that are marked."""
    order = np.lexsort((starts, tags, ids))
    ids, tags, starts = ids[order], tags[order], starts[order].astype(np.int32)
    found = [(int(ids[i]), int(tags[i]), starts[i:j].tobytes()) for i, j in bounds(ids, tags)]
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))], ["id", "tag", "data"])


SCHEMA = "kind int, id bigint, tag bigint, name bigint, place int, data binary, n_words bigint, sha string, none boolean, at int"


def as_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"kind": pa.int32(), "id": pa.int64(), "tag": pa.int64(), "name": pa.int64(), "place": pa.int32(), "data": pa.binary(), "n_words": pa.int64(), "sha": pa.string(), "none": pa.bool_(), "at": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in kinds.items()], list(kinds))


def claim_table(docs: DataFrame, anchors: Anchors, width: int, with_text: bool, pack: Pack | None) -> DataFrame:
    """Of documents (id, tag, text, names): those without shared anchors as done, the others with their claims and marks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, claims = Fingerprints(), Claims(width, pack)
        seconds = Fingerprints(seed=1)
        for rows in hashed(batches, prints, width, "names"):
            out, open_ = [], []
            for row, words, h in rows:
                data = b" ".join(words)
                base = {"id": row["id"], "tag": row["tag"], "n_words": len(words), "sha": hashlib.sha256(data).hexdigest(), "none": row["none"]}
                if row["names"]:
                    open_.append((row, words, h))
                    out.append(base | {"kind": OPEN, "data": data})
                else:
                    out.append(base | {"kind": DONE, "data": data if with_text else None})
            if open_:
                h, ends = joined_hashes(open_)
                starts, names, *rest = anchors(h, ends, width)
                doc = np.searchsorted(ends, starts, side="right")
                places = rest[0] - (ends - [len(o) for *_, o in open_])[doc] if rest else np.zeros(len(starts), np.int64)
                at = np.searchsorted(doc, np.arange(len(open_) + 1))
                for k, (row, words, own) in enumerate(open_):
                    mine = slice(at[k], at[k + 1])
                    wanted = np.flatnonzero(np.isin(names[mine], np.array(row["names"], np.int64).view(np.uint64)))
                    one, two = window_prints(own, width)[wanted], window_prints(seconds.of(words), width)[wanted]
                    claims.add(row, own, wanted, names[mine][wanted], places[mine][wanted], one, two.astype(np.uint32))
                if claims.size >= HELD:
                    out += claims.rows()
            yield as_batch(out)
        yield as_batch(list(claims.rows()))

    return docs.mapInArrow(lean(task), SCHEMA)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n words a window at one of the starts covers."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def removed(open_: DataFrame, width: int, with_text: bool) -> DataFrame:
    """Of documents (id, n_words, sha, data, found, aliases): id, n_words, spans of removed words, digest and text of the others."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            spans, shas, texts = [], [], []
            for row in batch.select(["data", "found", "aliases", "sha"]).to_pylist():
                if not row["found"]:
                    spans.append([])
                    shas.append(row["sha"])
                    texts.append(row["data"].decode() if with_text else None)
                    continue
                words = row["data"].split()
                starts = np.frombuffer(b"".join(row["found"]), np.int32)
                if row["aliases"]:
                    pairs = np.frombuffer(b"".join(row["aliases"]), np.int32).reshape(-1, 2)
                    starts = np.concatenate([starts, pairs[np.isin(pairs[:, 1], starts), 0]])
                out = covered(np.unique(starts), width, len(words))
                kept = b" ".join([w for w, gone in zip(words, out.tolist(), strict=True) if not gone])
                edges = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]]))).reshape(-1, 2)
                spans.append([{"start": int(a), "end": int(b)} for a, b in edges])
                shas.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept.decode() if with_text else None)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("none"), batch.column("n_words"), pa.array(spans, kind), pa.array(shas, pa.string()), pa.array(texts, pa.string())],
                ["id", "none", "n_words", "spans", "kept_sha256", "kept"],
            )

    return open_.mapInArrow(task, "id bigint, none boolean, n_words bigint, spans array<struct<start:int,end:int>>, kept_sha256 string, kept string")


def without_repeats(
    docs: DataFrame, anchors: Anchors, settle: Callable[[DataFrame], DataFrame], key: str = "doc_id", text: str = "text", width: int = 50, with_text: bool = False,
    pack: Pack | None = None,
) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, spans (of word places, end exclusive), kept_sha256, kept (null unless asked for).

    ``settle`` gets claims (id, tag, name, place, at, data) and returns marks
    (id, tag, data).  Words are runs of bytes other than space and \\x09-\\x0D; kept
    words are joined by one space.  Null and empty texts have no words.  The key
    is a whole number; rows with equal keys are no smaller than each other, and
    a null key counts as the largest there is, 2 ** 63 - 1, and as equal to it.
    Other columns are not read.
    """
    rows = docs.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(NULL_ID)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(key).isNull().alias("none")
    ).select("id", F.xxhash64("text").alias("tag"), "text", "none")
    names = stored(anchor_table(rows.drop("none"), anchors, width), "anchors")
    shared = stored(names.groupBy("name").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("name"), "shared")
    some = likely(names, shared, "name").where("likely").drop("likely")
    wanted = stored(some.join(shared, "name").groupBy("id", "tag").agg(F.collect_list("name").alias("names")), "wanted")
    free(names)
    free(shared)
    rows = likely(rows, wanted, "id", "tag")
    moved = rows.where("likely").join(wanted.hint("shuffle_hash"), ["id", "tag"], "left")
    others = rows.where("NOT likely").withColumn("names", F.lit(None).cast("array<bigint>"))
    claims = stored(claim_table(moved.unionByName(others).drop("likely"), anchors, width, with_text, pack), "claims", by="kind")
    free(wanted)

    found = stored(settle(claims.where(F.col("kind") == CLAIM).select("id", "tag", "name", "place", "at", "data")), "marks")
    remove(claims.sparkSession, f"{claims._scratch}/kind={CLAIM}")
    found = found.unionByName(claims.where(F.col("kind") == MARK).select("id", "tag", "data"))
    aliases = claims.where(F.col("kind") == ALIAS).select("id", "tag", F.lit(None).cast("binary").alias("data"), F.col("data").alias("alias"))
    found = found.withColumn("alias", F.lit(None).cast("binary")).unionByName(aliases)
    found = found.groupBy("id", "tag").agg(F.collect_list("data").alias("found"), F.collect_list("alias").alias("aliases"))
    open_ = claims.where(F.col("kind") == OPEN).select("id", "none", "tag", "n_words", "sha", "data").join(found, ["id", "tag"], "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    done = claims.where(F.col("kind") == DONE).select("id", "none", "n_words", none.alias("spans"), F.col("sha").alias("kept_sha256"), F.decode("data", "utf-8").alias("kept"))
    every = removed(open_, width, with_text).unionByName(done)
    gone = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return every.select(F.when(~F.col("none"), F.col("id")).alias(key), "n_words", gone.alias("n_removed"), "spans", "kept_sha256", "kept")
