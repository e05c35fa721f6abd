"""Toxicity by non-negative learning from positive and unlabelled texts.

Only toxic labels are believed.  Texts without one, and those labelled
otherwise, are unlabelled: a mixture with the class prior's share of toxic ones.
The risk of a classifier g on the whole mixture is then

    prior * R+(toxic)  +  max(0, R-(unlabelled) - prior * R-(toxic))

with R+ and R- the mean losses of texts as toxic and as not toxic.  Without the
maximum a flexible classifier drives the second part below zero by learning the
toxic examples by heart; with it, a batch in which it is below zero moves the
classifier by the first part alone (Kiryo et al. 2017).

1. Of the distinct texts that may be learnt from, at most POSITIVES toxic and
   UNLABELLED others are taken, those with the smallest fingerprints.  The
   prior is the share of toxic ones among all distinct labelled texts.
2. Features are hashed character runs inside words, their edges included; the
   FEATURES that tell the two samples apart best are counted in one aggregate.
3. MODELS linear classifiers, each from a share of the texts and in a task of
   its own, are trained in numpy.  On the texts that a classifier has not seen
   its offset is moved to where the same risk, of errors now, is least.  The
   classifiers' mean margin scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .words import slices

#: Distinct texts to learn from, at most.
POSITIVES, UNLABELLED = 4_000, 12_000
#: Lengths of character runs, buckets that they are hashed into, and buckets that become features.
RUNS, BUCKETS, FEATURES = (3, 4, 5, 6), 1 << 19, 1_024
#: Toxic texts that must have a feature.
LEAST = 3
#: Classifiers, and the share of the texts that each learns from.
MODELS, SHARE = 3, 0.6
EPOCHS, BATCH, RATE, SPARSITY = 60, 1_024, 0.05, 2e-4
#: Characters that are looked at in one go.
AT_ONCE = 1 << 20

LETTERS = np.zeros(128, np.uint32)
LETTERS[97:123] = np.arange(97, 123)


def characters(text: str) -> np.ndarray:
    """Code points in lower case; runs of anything in ASCII but letters are one 0, as are both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < 128, LETTERS[np.minimum(points, 127)], points)
    points = np.concatenate([np.zeros(1, np.uint32), points, np.zeros(1, np.uint32)])
    return points[np.append(True, (points[1:] != 0) | (points[:-1] != 0))]


def buckets(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of all runs of characters inside words, a word's edges being characters; repeated as they come."""
    whole = characters(text or "")
    for at in range(0, len(whole), AT_ONCE):
        points = whole[at : at + AT_ONCE + max(RUNS) - 1]
        inside = points != 0
        code = points[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + points[1:]
        good = np.ones(len(code), bool)
        for n in range(3, max(RUNS) + 1):
            size = len(points) - n + 1
            if size <= 0:
                break
            code = code[:size] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :]
            good = good[:size] & inside[n - 2 : n - 2 + size]
            if n in RUNS:
                spread = code[good] ^ (code[good] >> np.uint64(31))
                yield ((spread * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def present(text: str | None, numbers: np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` features a text has; ``numbers`` gives a bucket's feature, or ``count`` for none."""
    found = np.zeros(count + 1, bool)
    for part in buckets(text):
        found[numbers[part]] = True
    return found[:count]


def trained(features: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 0, epochs: int = EPOCHS) -> np.ndarray:
    """Weights and offset of a linear classifier with the least non-negative risk.

    ``features`` is a 0/1 matrix; a row may be positive, unlabelled or both.
    Adam steps, a weight's absolute value costing SPARSITY.
    """
    rng = np.random.default_rng(seed)
    ones, others = np.flatnonzero(positive), np.flatnonzero(unlabelled)
    x = features.astype(np.float32)
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    mean, square, step = np.zeros_like(w), np.zeros_like(w), 0
    rounds = max(1, -(-len(others) // BATCH))
    each = min(len(ones), max(BATCH // 4, -(-len(ones) // rounds)))

    def margins(rows: np.ndarray) -> np.ndarray:
        return x[rows] @ w[:-1].astype(np.float32) + w[-1]

    def gradient(rows: np.ndarray, slopes: np.ndarray) -> np.ndarray:
        return np.append(x[rows].T @ slopes.astype(np.float32), slopes.sum()) / len(rows)

    def sigmoid(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for epoch in range(epochs):
        order = rng.permutation(others)
        for i in range(rounds):
            u, p = order[i * BATCH : (i + 1) * BATCH], rng.choice(ones, each, replace=False)
            zu, zp = margins(u), margins(p)
            total = prior * gradient(p, sigmoid(zp) - 1)
            if np.logaddexp(0, zu).mean() >= prior * np.logaddexp(0, zp).mean():
                total += gradient(u, sigmoid(zu)) - prior * gradient(p, sigmoid(zp))
            total[:-1] += SPARSITY * np.sign(w[:-1])
            step += 1
            mean, square = 0.9 * mean + 0.1 * total, 0.999 * square + 0.001 * total**2
            rate = RATE * (1 - 0.9 * epoch / epochs)
            w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w


def cut(toxic: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The margin from which on to call texts toxic: in the middle of those where the risk of errors is as good as least."""
    toxic, unlabelled = np.sort(toxic), np.sort(unlabelled)
    beyond = max(toxic[-1], unlabelled[-1]) + 1  # calls none
    tried = np.unique(np.append(np.quantile(toxic, np.linspace(0, 1, 201)), beyond))
    missed = np.searchsorted(toxic, tried) / len(toxic)
    called = 1 - np.searchsorted(unlabelled, tried) / len(unlabelled)
    risk = prior * missed + np.maximum(0, called - prior * (1 - missed))
    return float(np.median(tried[risk <= risk.min() + prior * 0.01]))


@dataclass
class Model:
    """Feature numbers of buckets, and the mean classifier; there is none without LEAST confirmed examples that share a run."""

    numbers: np.ndarray | None
    weights: np.ndarray | None
    prior: float


def held_out(key: Column) -> Column:
    """Whether nothing may be learnt from a row: crc32 of its key as text, modulo 5, is 0; a null key counts as empty."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sampled(docs: DataFrame, labels: DataFrame, key: str, text: str) -> tuple[DataFrame, float]:
    """(text, print, positive, unlabelled) of the distinct texts to learn from, and the prior."""
    open_ = docs.where(~held_out(F.col(key))).select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("print"), F.col(text).alias("text")).where(F.length("text") > 0)
    marks = labels.select(F.col("doc_id").cast("long").alias("key"), F.col("toxic").alias("mark")).where(F.col("mark").isNotNull() & F.col("key").isNotNull())
    marks = marks.groupBy("key").agg((F.max("mark") == 1).alias("mark"))
    # narrow rows only: a text is its fingerprint until it is chosen
    prints = open_.groupBy("key", "print").agg(F.lit(True).alias("x")).select("key", "print")
    known = prints.join(marks, "key", "left").groupBy("print").agg(F.max("mark").alias("mark"))
    known = stored(known, "prints")
    n, toxic = known.agg(F.count("mark"), F.count_if("mark")).first()
    prior = min(max((toxic or 0) / max(n or 0, 1), 1e-3), 0.5)
    order = F.xxhash64("print", F.lit(11))
    some = known.where("mark").orderBy(order, "print").limit(POSITIVES).select("print", F.lit(True).alias("positive"))
    others = known.orderBy(F.xxhash64("print", F.lit(12)), "print").limit(UNLABELLED).select("print", F.lit(False).alias("positive"))
    chosen = some.unionByName(others).groupBy("print").agg(F.max("positive").alias("positive"), F.min("positive").alias("all_positive"))
    chosen = stored(chosen.select("print", "positive", (~F.col("all_positive")).alias("unlabelled")), "chosen")  # POSITIVES + UNLABELLED rows at most
    # equal fingerprints stand for one text; min makes it the same one whatever the order
    texts = open_.select("print", "text").join(F.broadcast(chosen), "print").groupBy("print", "positive", "unlabelled").agg(F.min("text").alias("text"))
    return stored(texts, "texts"), prior


def chosen_buckets(texts: DataFrame) -> np.ndarray:
    """The buckets that are most more frequent in toxic texts than in the others, by the z score of their shares."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches, "text"):
            for t, p, u in zip(*(batch.column(c).to_pylist() for c in ("text", "positive", "unlabelled")), strict=True):
                own = np.zeros(BUCKETS, bool)
                for part in buckets(t):
                    own[part] = True
                at = np.flatnonzero(own)
                sums[0, at] += p
                sums[1, at] += u
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], ["bucket", "p", "u"])

    totals = texts.agg(F.count_if("positive").alias("p"), F.count_if("unlabelled").alias("u")).first()
    mean = (F.col("p") + F.col("u") + 1) / (totals["p"] + totals["u"] + 2)
    score = (F.col("p") / totals["p"] - F.col("u") / totals["u"]) / F.sqrt(mean * (1 - mean))
    counts = texts.select("text", "positive", "unlabelled").mapInArrow(task, "bucket bigint, p bigint, u bigint")
    counts = counts.groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where(F.col("p") >= LEAST)
    return np.array(sorted(r["bucket"] for r in counts.orderBy(score.desc(), "bucket").limit(FEATURES).select("bucket").collect()), np.int64)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", models: int = MODELS) -> Model:
    """Learns from the rows that are not held out; labels other than toxic = 1 are used for the prior only.

    A key with several labels is toxic if any of them says so; rows without key
    have no label.  Null and empty texts are not learnt from; a text that many
    rows share counts once.  The result doesn't depend on the rows' order.
    """
    texts, prior = sampled(docs, labels, key, text)
    if texts.where("positive").isEmpty():
        return Model(None, None, prior)
    at = chosen_buckets(texts)
    if not len(at):
        return Model(None, None, prior)
    numbers = np.full(BUCKETS, len(at), np.uint16)
    numbers[at] = np.arange(len(at))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [np.packbits(present(t, numbers, len(at))).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("print", "positive", "unlabelled")), pa.array(found, pa.binary())], ["print", "positive", "unlabelled", "bits"])

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("print")
        seed = int(pdf["model"].iloc[0])
        rng = np.random.default_rng(seed)
        positive, unlabelled = pdf["positive"].to_numpy(bool), pdf["unlabelled"].to_numpy(bool)
        x = np.unpackbits(np.frombuffer(b"".join(pdf["bits"]), np.uint8).reshape(len(pdf), -1), axis=1)[:, : len(at)]
        own = rng.random(len(pdf)) < SHARE
        if not all((side & kind).any() for side in (own, ~own) for kind in (positive, unlabelled)):
            own = np.ones(len(pdf), bool)  # too few to leave any out
        unseen = ~own if not own.all() else own
        w = trained(x[own], positive[own], unlabelled[own], prior, seed)
        margins = x @ w[:-1] + w[-1]
        w[-1] -= cut(margins[unseen & positive], margins[unseen & unlabelled], prior)
        return pd.DataFrame({"model": [seed], "w": [w.tolist()]})

    rows = stored(texts.select("print", "positive", "unlabelled", "text").mapInArrow(bits, "print bigint, positive boolean, unlabelled boolean, bits binary"), "features")
    rows = rows.withColumn("model", F.explode(F.array(*map(F.lit, range(models)))))
    found = rows.groupBy("model").applyInPandas(train, "model int, w array<double>").orderBy("model").collect()
    return Model(numbers, np.mean([r["w"] for r in found], axis=0), prior)


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Null texts count as empty and score as a text without any feature.  Without
    a model all scores are 0.  Rows that repeat are scored
    alike; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            if model.weights is None:
                scores = np.zeros(batch.num_rows)
            else:
                count = len(model.weights) - 1
                margins = [model.weights[:-1][present(t, model.numbers, count)].sum() for t in batch.column("text").to_pylist()]
                scores = 1 / (1 + np.exp(-np.clip(np.array(margins) + model.weights[-1], -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(scores, pa.float64())], ["key", "score"])

    found = rows.mapInArrow(task, f"key {kind}, score double")
    return found.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
