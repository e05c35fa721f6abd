"""How filters interact: what each removes at every place of every order.

1. One pass of the byte transducer tells for each text which filters fail that
   need the text alone, and names the text by its SHA-256.
2. The filter on identical texts: of the rows with one digest, all but those
   with the smallest doc_id fail.  The smallest is an aggregate with a partial
   step, and rows meet it by digest *and* doc_id, so a text that a third of all
   rows share is no hot key.
3. Rows are counted by part, set of failing filters, and labels.  Whatever an
   order does depends on these counts alone: a filter at a place removes the
   rows that fail it and none of the filters before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations, permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .transducer import counted
from .words import slices

FILTERS = "ABCDE"
SHORT, FEW_DISTINCT, CAPITALS, SYMBOLS, COPY = (1 << i for i in range(5))
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per row of ``docs``: key, part, fails (bits of the filters that need the text alone), sha (32 bytes).

    Null texts are empty, a null part is the empty string. Other columns are not read.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            c = counted(texts)
            fails = (
                SHORT * (c.words < LEAST_WORDS) + FEW_DISTINCT * (100 * c.distinct < DISTINCT_PERCENT * c.words)
                + CAPITALS * (100 * c.capitals > CAPITAL_PERCENT * c.points) + SYMBOLS * (c.symbols > 0)
            )
            shas = [hashlib.sha256(t).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("part"), pa.array(fails, pa.int32()), pa.array(shas, pa.binary())], ["key", "part", "fails", "sha"])

    return rows.mapInArrow(task, "key bigint, part string, fails int, sha binary")


def cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """Counts of rows: part, mask (bits of all filters that fail), n, good (of them labelled quality 1), toxic (toxic 1).

    A row is a copy if a row with a smaller key has an identical text; a null
    key is larger than any other, and rows that share key and text are no
    copies of each other.  A key with several labels has every mark that any of
    them gives it; a null key has none.
    """
    rows = failures(docs, key, text, part).groupBy("key", "part", "fails", "sha").agg(F.count("*").alias("n"))
    rows = stored(rows, "failures")
    # a null key only stands where no other key has the text: min skips nulls
    firsts = rows.groupBy(F.col("sha").alias("first_sha")).agg(F.min("key").alias("first_key")).withColumn("first", F.lit(True))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("key")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    same = F.col("key").eqNullSafe(F.col("first_key")) & (F.col("sha") == F.col("first_sha"))
    found = rows.join(firsts, same, "left").select("key", "part", "n", (F.col("fails") + F.when(F.col("first"), 0).otherwise(COPY)).alias("mask"))
    found = found.join(marks, "key", "left")
    n = F.col("n")
    return found.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic")
    )


def places() -> Column:
    """All (bit, before, steps): a filter, the set of filters before it, and the orders and steps where that is so."""
    found = []
    bits = {f: 1 << i for i, f in enumerate(FILTERS)}
    for f in FILTERS:
        others = FILTERS.replace(f, "")
        for size in range(len(FILTERS)):
            for before in combinations(others, size):
                after = [o for o in others if o not in before]
                orders = ["".join((*b, f, *a)) for b in permutations(before) for a in permutations(after)]
                found.append(F.struct(
                    F.lit(bits[f]).alias("bit"), F.lit(sum(bits[b] for b in before)).alias("before"),
                    F.lit(size + 1).alias("step"), F.array(*map(F.lit, orders)).alias("orders"),
                ))
    return F.array(*found)


def audit(counts: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``counts`` is what ``cells`` returns.  Every part has a row for each of the
    5 steps of the 120 orders, zeros included; an empty table has no parts.
    """
    mask, bit, before, n = F.col("mask"), F.col("bit"), F.col("before"), F.col("n")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
    total = lambda condition, of=n: F.sum(F.when(condition, of).otherwise(0)).cast("long")
    # in 120 / |mask| of all orders the filter comes before all others that the row fails
    share = F.lit(factorial(len(FILTERS))) / F.greatest(F.bit_count("mask"), F.lit(1))
    sums = counts.select("*", F.inline(places())).groupBy("part", "bit", "before", "step", "orders").agg(
        total(~gone & ~fails).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(mask == bit).alias("unique_fails"), total(fails & ~gone, F.col("good")).alias("good_lost"), total(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
        F.sum(F.when(fails, n * share.cast("long")).otherwise(0)).cast("long").alias("shapley"),
    )
    measures = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sums.select("part", F.explode("orders").alias("filter_order"), "step", *measures)
