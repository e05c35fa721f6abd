"""Language identification by Bayesian fusion of evidence.

log P(language | everything) is the sum of

* the text's likelihood under byte-trigram counts of each language, weakened
  because trigrams of one text depend on each other (``STRENGTH``);
* the likelihood of the declared language, from how often each declaration
  comes with each language over all rows;
* the prior of the host, smoothed towards that of its address suffix, which is
  smoothed towards that of all rows.

Trigram counts come from a bounded sample of each label's distinct texts
(``FIT_ROWS``); every label of any row is a language.  A declaration must not be
the label that the model was fitted on, or it would be its own evidence.  All
other counts are grouped aggregates over every row, in which a host that holds
a third of them is one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .memory import lean
from .scratch import stored
from .words import slices

#: Distinct texts of each label that trigram counts are taken from, about.
FIT_ROWS = 5_000
#: More labels than this are an error: they don't name languages, and each costs 65,536 numbers in every task.
MOST_LABELS = 500
#: The evidence of a text is that of this many independent trigrams at most.
STRENGTH = 150.0
#: Rows of the parent that count with a host or suffix, and rows that each declaration is seen with beforehand.
HOST_WEIGHT, SUFFIX_WEIGHT, DECLARED_WEIGHT = 20.0, 100.0, 1.0
BUCKETS = 1 << 16

#: Letters in lower case and bytes of other scripts stay, all else separates words.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass
class Model:
    """Languages, and per trigram bucket and language the log of its probability."""

    languages: list[str]
    logs: np.ndarray


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of words, each with a space before and after."""
    words = (text or "").lower().encode().translate(LETTERS).split()
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    if not words or len(b) < 3:
        return np.empty(0, np.int64)
    return ((((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def sampled(rows: DataFrame, shares: dict[str, float]) -> DataFrame:
    """(text, label) of the given share of each label's distinct texts, each text once per label."""
    label_share = F.create_map(*[F.lit(v) for item in shares.items() for v in item])[F.col("label")]
    rows = rows.withColumn("print", F.xxhash64("text")).where(F.pmod("print", F.lit(1_000_000_000)) < label_share * 1_000_000_000)

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Leaves one copy per task, so that a text in a third of all rows is no hot key."""
        seen: set[tuple[str, int]] = set()
        for batch in batches:
            new = []
            for i, name in enumerate(zip(batch.column("label").to_pylist(), batch.column("print").to_pylist(), strict=True)):
                if name not in seen:
                    seen.add(name)
                    new.append(i)
            yield batch.take(pa.array(new, pa.int64()))

    return rows.mapInArrow(lean(once), rows.schema).dropDuplicates(["label", "print"]).select("text", "label")


def fit(labelled: DataFrame, text: str = "text", label: str = "lang", fit_rows: int = FIT_ROWS) -> Model:
    """Trigram counts by label from about ``fit_rows`` distinct texts of each; the driver gets 65,536 sums per language."""
    rows = labelled.select(F.col(text).alias("text"), F.col(label).alias("label")).where(F.col("text").isNotNull() & F.col("label").isNotNull())
    counts = rows.groupBy("label").agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("text")).alias("texts"))
    shares = {r["label"]: min(1.0, fit_rows / max(r["texts"], 1)) for r in counts.limit(MOST_LABELS + 1).collect()}
    if len(shares) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels in {label}")
    if not shares:
        return Model([], np.empty((BUCKETS, 0), np.float32))
    rows = sampled(rows, shares)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            for t, name in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                if name not in sums:
                    sums[name] = np.zeros(BUCKETS, np.int64)
                sums[name] += np.bincount(trigrams(t), minlength=BUCKETS)
        for name, values in sums.items():
            at = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(values[at])], ["label", "bucket", "n"])

    found = rows.mapInArrow(lean(task), "label string, bucket bigint, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(shares)
    sums = np.full((BUCKETS, len(languages)), 0.5)
    for i, name in enumerate(languages):
        own = found[found["label"] == name]
        sums[own["bucket"].to_numpy(), i] += own["n"].to_numpy()
    return Model(languages, np.log(sums / sums.sum(axis=0)).astype(np.float32))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """Adds n_trigrams and evidence (array of double, the largest 0) to rows and drops their text."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("text").schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.zeros((batch.num_rows, len(model.languages)))
            lengths = np.zeros(batch.num_rows, np.int64)
            for i, t in enumerate(batch.column("text").to_pylist()):
                at = trigrams(t)
                lengths[i] = n = len(at)
                if n:
                    found[i] = model.logs[at].sum(axis=0, dtype=np.float64) / (n + STRENGTH) * STRENGTH
            if found.size:
                found -= found.max(axis=1, keepdims=True)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(model.languages)
            evidence = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))
            kept = [batch.column(n) for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(lengths), evidence], [*(n for n in batch.schema.names if n != "text"), "n_trigrams", "evidence"])

    return rows.mapInArrow(lean(task), f"{schema}, n_trigrams bigint, evidence array<double>")


def smoothed(counts: list[Column], parent: list[Column], weight: float) -> list[Column]:
    """Shares of counts with ``weight`` rows of the parent's shares added."""
    total = sum(counts[1:], counts[0])
    return [(c + weight * p) / (total + weight) for c, p in zip(counts, parent, strict=True)]


def identify(
    rows: DataFrame, model: Model, key: str, text: str | Column, declared: Column | None = None, host: Column | None = None,
    suffix: Column | None = None, least: float = 0.5,
) -> DataFrame:
    """One row per row: key, language, probability, accepted, n_trigrams.

    ``accepted`` is false for texts without letters, and where no language
    reaches ``least``.  Null and empty texts are not accepted; a null
    declaration, host or suffix is a value like any other.  Without any known
    language the language is null and nothing is accepted.  Ties go to the
    language first in order.  Other columns are not read.
    """
    none = F.lit(None).cast("string")
    parts = rows.select(
        F.col(key).alias("key"), (F.col(text) if isinstance(text, str) else text).alias("text"),
        *[F.coalesce(none if c is None else c, F.lit("")).alias(n) for n, c in (("declared", declared), ("host", host), ("suffix", suffix))],
    )
    base = stored(scored(parts, model), "evidence")
    names = model.languages
    if not names:
        return base.select(F.col("key").alias(key), none.alias("language"), F.lit(0.0).alias("probability"), F.lit(False).alias("accepted"), "n_trigrams")

    shares = [F.exp(F.get("evidence", F.lit(i))) for i in range(len(names))]
    likely = base.where("n_trigrams > 0").select(
        "declared", "host", "suffix", *[(s / sum(shares[1:], shares[0])).alias(f"s{i}") for i, s in enumerate(shares)]
    )
    sums = [F.sum(f"s{i}").alias(f"s{i}") for i in range(len(names))]
    counts = stored(likely.groupBy("declared", "host", "suffix").agg(*sums), "counts")
    own = [F.col(f"s{i}") for i in range(len(names))]

    everything = [float(v or 0) for v in counts.agg(*sums).first()]
    overall = [F.lit((v + 1) / (sum(everything) + len(names))) for v in everything]
    suffixes = counts.groupBy("suffix").agg(*sums)
    suffixes = suffixes.select("suffix", *[c.alias(f"p{i}") for i, c in enumerate(smoothed(own, overall, SUFFIX_WEIGHT))])
    hosts = counts.groupBy("host", "suffix").agg(*sums).join(suffixes, "suffix")
    parents = [F.col(f"p{i}") for i in range(len(names))]
    hosts = stored(hosts.select("host", "suffix", *[F.log(c).alias(f"h{i}") for i, c in enumerate(smoothed(own, parents, HOST_WEIGHT))]), "hosts")
    declarations = counts.groupBy("declared").agg(*sums)
    values = declarations.count()
    declarations = stored(
        declarations.select("declared", *[F.log((c + DECLARED_WEIGHT) / (v + DECLARED_WEIGHT * max(values, 1))).alias(f"d{i}") for i, (c, v) in enumerate(zip(own, everything, strict=True))]),
        "declarations",
    )

    joined = base.join(hosts, ["host", "suffix"], "left").join(declarations, "declared", "left")
    logs = [
        F.get("evidence", F.lit(i)) + F.coalesce(f"h{i}", F.log(overall[i])) + F.coalesce(f"d{i}", F.lit(0.0)) for i in range(len(names))
    ]
    # a - max before exp, so that nothing overflows
    posterior = F.array(*logs)
    joined = joined.select("key", "n_trigrams", posterior.alias("logs")).withColumn("top", F.array_max("logs"))
    total = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    best = F.get(F.array(*map(F.lit, names)), F.array_position("logs", F.col("top")).cast("int") - 1)
    probability = 1 / total
    return joined.select(
        F.col("key").alias(key), best.alias("language"), probability.alias("probability"),
        ((F.col("n_trigrams") > 0) & (probability >= least)).alias("accepted"), "n_trigrams",
    )


def markup_language(html: Column) -> Column:
    """The primary subtag that the html element declares; null if none."""
    found = F.lower(F.regexp_extract(html, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z]+)""", 1))
    return F.when(found != "", found)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def suffix_of(url: Column) -> Column:
    """The last label of the host's name."""
    return F.substring_index(host_of(url), ".", -1)


def visible_text(html: Column) -> Column:
    """Markup, scripts and styles taken out; enough for trigrams."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"(?s)<[^>]*>|&[#A-Za-z0-9]+;", " ")
