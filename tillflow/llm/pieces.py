"""SentencePiece encoding and decoding with a table of distinct marked words.

The model turns every space into a marker and puts one marker before the text.
Where no piece has a marker after another character, no piece spans the place
between a character and the next marker.  The text then falls into marked
words, each of them markers and what follows up to the next marker, that are
segmented apart from each other.  In the table a marked word stands without its
first marker, which the model puts back.  Every task keeps a table of the distinct
marked words of its rows, segments each of them once, and joins the ids back to
the documents by the words' positions.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .memory import lean
from .words import slices

MARK = "▁"
MARKED = re.compile(f"{MARK}+[^{MARK}]*")


def model_bytes(path: str) -> bytes:
    """The model file; it is small (about half a megabyte) and goes to the tasks with the function."""
    with open(path, "rb") as file:
        return file.read()


def separable(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether marked words are segmented apart: spaces are kept, one marker leads, no piece crosses into a marker."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    if any(MARK in piece.lstrip(MARK) for piece in pieces):
        return False
    return all(model.normalize(x) == MARK + x.replace(" ", MARK) for x in ("a", "  a  b ", " \t\n ", "½ Ａ", "é"))


class WordTable:
    """Marked word -> its ids, as 32-bit integers in bytes, and its decoded text; starts anew at ``limit`` words."""

    def __init__(self, model: sentencepiece.SentencePieceProcessor, limit: int = 200_000):
        self.model, self.limit, self.apart = model, limit, separable(model)
        # A last marker with nothing after it can't be encoded alone: the empty text has no marker.
        self.bare = model.encode("a ")[len(model.encode("a")) :]
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.apart:
            return [text]
        if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [w[1:].replace(MARK, " ") for w in MARKED.findall(MARK + text.replace(" ", MARK))]

    def add(self, words: set[str]) -> None:
        if len(self.ids) + len(words) > self.limit:
            self.ids.clear()
            self.texts.clear()
        new = list(words - self.ids.keys())
        ids = [i if w else self.bare for w, i in zip(new, self.model.encode(new, num_threads=1), strict=True)]
        self.ids.update(zip(new, (array("i", i).tobytes() for i in ids), strict=True))
        self.texts.update(zip(new, self.model.decode(ids, num_threads=1), strict=True))

    def look_up(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids and decoded texts; every marked word but the first decodes without the space of its first marker."""
        words = [self.words(text) for text in texts]
        self.add(set().union(*words))
        return [b"".join(map(self.ids.__getitem__, row)) for row in words], [" ".join(map(self.texts.__getitem__, row)) for row in words]


def encode(docs: DataFrame, model: bytes, key: str = "doc_id", text: str | Column = "text") -> DataFrame:
    """One row per row of ``docs``: key, ids (array of int) and decoded (string), without begin or end ids.

    Null and empty texts have no ids and decode to the empty text.  Rows with
    equal keys stay apart; other columns are not read.  No row is moved: each
    task needs one batch of texts and its table of words.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(sentencepiece.SentencePieceProcessor(model_proto=model))
        for batch in slices(batches, "text"):
            ids, decoded = table.look_up(batch.column("text").to_pylist())
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32) // 4
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), lists, pa.array(decoded, pa.string())], ["key", "ids", "decoded"])

    return rows.mapInArrow(lean(task), f"key {kind}, ids array<int>, decoded string").withColumnRenamed("key", key)


def decode(rows: DataFrame, model: bytes, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and text, by the library's decode; null ids give the empty text."""
    rows = rows.select(F.col(key).alias("key"), F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            texts = processor.decode(batch.column("ids").to_pylist(), num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    return rows.mapInArrow(lean(task), f"key {kind}, text string").withColumnRenamed("key", key)
