"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Every chunk of rows has one fingerprint per distinct text and sends each
   owner of a fingerprint range the sorted fingerprints of that range, as
   Golomb-Rice codes of their differences.
2. The owners find the fingerprints that several chunks sent and answer each
   chunk with one bit per fingerprint.
3. Rows whose bit is set, or whose text repeats within the chunk, are suspects.
   Only their texts are shuffled, grouped by the bytes themselves.

A chunk sends a fingerprint once, however many copies it holds, and the byte
comparison is an aggregate with a partial step in each task, so a text that a
third of all rows share is one row per task.  Chunks and owners are bounded in
rows (``CHUNK_ROWS``, ``OWNER_ROWS``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .memory import lean
from .scratch import stored
from .words import slices

CHUNK_ROWS = 1_000_000
OWNER_ROWS = 4_000_000
BLANKS = " \t\n\x0b\x0c\r"


def golomb(values: np.ndarray, span: int) -> tuple[bytes, int]:
    """Sorted distinct values below ``span`` as unary quotients, then remainders; and the remainders' bits."""
    n = len(values)
    if not n:
        return b"", 0
    width = max(0, (span // n).bit_length() - 1)
    steps = np.diff(values, prepend=np.uint64(0))
    ends = np.cumsum((steps >> np.uint64(width)).astype(np.int64) + 1)
    unary = np.zeros(int(ends[-1]), np.uint8)
    unary[ends - 1] = 1
    rest = (steps[:, None] >> np.arange(width, dtype=np.uint64)[None, :]) & np.uint64(1)
    return np.packbits(np.concatenate([unary, rest.astype(np.uint8).ravel()])).tobytes(), width


def ungolomb(code: bytes, n: int, width: int) -> np.ndarray:
    """The values that ``golomb`` coded."""
    if not n:
        return np.empty(0, np.uint64)
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    ends = np.flatnonzero(bits)[:n]
    start = int(ends[-1]) + 1
    rest = bits[start : start + n * width].reshape(n, width).astype(np.uint64)
    steps = (np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)) << np.uint64(width)
    steps += (rest << np.arange(width, dtype=np.uint64)[None, :]).sum(axis=1, dtype=np.uint64)
    return np.cumsum(steps, dtype=np.uint64)


def tag_of(text: str | Column) -> Column:
    """Tells a document's texts apart where several rows have its key; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def digests(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per row: key, tag (names the text as it is), part, n_chars (its code points), sha256 and fingerprint of it without white space."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tag", tag_of("text"))
    kind = rows.schema["key"].dataType.simpleString()
    blanks = BLANKS.encode()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            bare = [t.encode().translate(None, blanks) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("tag"),
                    pa.array([part] * len(texts), pa.int32()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in bare], pa.string()),
                    pa.array(np.array([xxhash.xxh3_64_intdigest(b) for b in bare], np.uint64).view(np.int64)),
                ],
                ["key", "tag", "part", "n_chars", "sha", "print"],
            )

    return rows.mapInArrow(lean(task), f"key {kind}, tag bigint, part int, n_chars bigint, sha string, print bigint")


def suspects(rows: DataFrame, chunks: int, owners: int) -> DataFrame:
    """The distinct prints of ``rows`` (part, print) that more than one row has."""
    rows = rows.select((F.col("part") % chunks).alias("chunk"), "print")
    span = -(-(1 << 64) // owners)

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        prints, counts = np.unique(pdf["print"].to_numpy().view(np.uint64), return_counts=True)
        bounds = np.searchsorted(prints, np.array([i * span for i in range(1, owners)], np.uint64))
        out = []
        for owner, (part, count) in enumerate(zip(np.split(prints, bounds), np.split(counts, bounds), strict=True)):
            if len(part):
                code, width = golomb(part - np.uint64(owner * span), span)
                out.append((owner, int(pdf["chunk"].iloc[0]), len(part), width, code, np.packbits(count > 1).tobytes()))
        return pd.DataFrame(out, columns=["owner", "chunk", "n", "width", "code", "twice"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [ungolomb(c, n, w) for c, n, w in zip(pdf["code"], pdf["n"], pdf["width"], strict=True)]
        prints, counts = np.unique(np.concatenate(parts), return_counts=True)
        shared = prints[counts > 1]
        pdf["shared"] = [np.packbits(np.isin(p, shared)).tobytes() for p in parts]
        return pdf

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in pdf.itertuples():
            bits = np.frombuffer(row.shared, np.uint8) | np.frombuffer(row.twice, np.uint8)
            prints = ungolomb(row.code, row.n, row.width) + np.uint64(row.owner * span)
            out.append(prints[np.unpackbits(bits)[: row.n] == 1])
        return pd.DataFrame({"print": np.concatenate(out).view(np.int64)})

    codes = rows.groupBy("chunk").applyInPandas(send, "owner int, chunk int, n int, width int, code binary, twice binary")
    shared = codes.groupBy("owner").applyInPandas(answer, "owner int, chunk int, n int, width int, code binary, twice binary, shared binary")
    bits = shared.groupBy("chunk").applyInPandas(read, "print bigint")
    return bits


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256, text_print.

    Texts are equal when they are identical without ``[\\x20\\x09-\\x0D]``; null
    counts as empty, and empty texts equal each other.  Of equal texts the row
    with the most code points stays, then the smallest key (a null key last),
    then, among rows of one key, the smallest fingerprint of the text as it is
    (``text_print``).  Rows that repeat key and text count in group_size and
    carry the same verdict: to keep one of them, take distinct (key,
    text_print).  Other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = stored(digests(docs, key, text), "digests")
    total, parts = rows.agg(F.count("*"), F.countDistinct("part")).first()
    if not total:
        return rows.select(F.col("key").alias(key), F.col("key").alias("keep_id"), F.col("n_chars").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"), F.col("tag").alias("text_print"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(min(parts, width), -(-total // CHUNK_ROWS))
    owners = max(min(width, -(-total // 10_000)), -(-total // OWNER_ROWS))
    shared = suspects(rows, chunks, owners).distinct().withColumn("suspect", F.lit(True))
    rows = stored(rows.join(shared, "print", "left").withColumn("suspect", F.col("suspect").isNotNull()), "suspects")

    ids = rows.where("suspect").select(F.col("key").alias("id")).distinct()
    texts = (
        docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .join(ids.hint("shuffle_hash"), F.col("key").eqNullSafe(F.col("id")), "left_semi")
        .select("key", tag_of("text").alias("tag"), F.char_length("text").cast("long").alias("n_chars"), F.translate("text", BLANKS, "").alias("bare"))
    )
    # the smallest comes first: most code points, then keys in order with null last, then fingerprints
    place = F.struct((-F.col("n_chars")).alias("fewer"), F.col("key").isNull().alias("none"), "key", "tag")
    classes = (
        texts.groupBy("bare").agg(F.min(place).alias("first"), F.count("*").alias("group_size"))
        .select(F.sha2("bare", 256).alias("sha"), F.col("first.key").alias("keep_id"), F.col("first.tag").alias("keep_tag"), "group_size")
    )
    found = rows.where("suspect").join(stored(classes, "classes"), "sha")
    alone = rows.where(~F.col("suspect")).withColumns({"keep_id": F.col("key"), "keep_tag": F.col("tag"), "group_size": F.lit(1).cast("long")})
    columns: list[Column] = [
        F.col("key").alias(key), F.col("keep_id"), F.col("group_size"),
        (F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("tag") == F.col("keep_tag"))).alias("kept"), F.col("sha").alias("text_sha256"), F.col("tag").alias("text_print"),
    ]
    return found.select(*columns).unionByName(alone.select(*columns))
