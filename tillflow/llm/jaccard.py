"""Jaccard join of word-shingle sets with count vectors in R-trees.

Equal sets are one class, named by a fingerprint of the set; all else works on
classes.

1. Shingles are hashed into groups; the counts per group are the class's point.
   The overlap of two sets is at most the sum over the groups of the smaller
   count, and a box of points bounds it by its largest counts.
2. Sets with similarity t share one of their first n - ceil(t n) + 1 shingles
   in any order of all shingles.  The order is by fingerprint, with the
   shingles that very many documents hold last.  Classes that share such a
   shingle form a block.  A tree over all points would have to be searched
   beyond any bound, as few of its boxes exclude anything in so many
   dimensions; in a block it has little to search.
3. In every block an R-tree finds which members may be similar to which.  Only
   what hangs together is sent on, one row per member and not one per pair:
   any two that may be similar are in one cluster.
4. The members of a cluster meet with their shingle sets, once each, and exact
   overlaps link them.  Again only what hangs together is sent on.

In 3 and 4 a member that already hangs together with the largest component of
its group asks for nothing: of two members in different components at least
one has asked.  So a group of thousands of near copies costs a few searches.
Groups beyond a size are cut into slices (``together``).

Blocks are found by an exchange in which a task sends one class for each
shingle, however many of its classes hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .memory import give_back, lean
from .repeats import bounds, groups
from .scratch import free, stored
from .words import BASE, Fingerprints, mix, shingles, slices, split

GROUPS = 128
#: Sets of more shingles than four a group have twice as many groups, and so on.
DENSE = 4
#: Stands for any count from this on.
MANY = 255
#: Shingles that a task holds before it sends what it has found.
HELD = 400_000
#: Words that a task remembers the fingerprints of.
WORDS = 100_000
#: A shingle is common from so many documents on, and there are at most so many common ones (8 bytes each in every task).
COMMON_FROM, MOST_COMMON = 32, 4_000_000
#: Times that a task must see a shingle to report it as possibly common.
SEEN = 4
#: Shingles that one group of the exchange brings together, about.
GROUP_SHINGLES = 1_000_000
#: Members of a slice of a block, and of all slices that a task gets, about.
TREE_MEMBERS, PART_MEMBERS = 2048, 20_000
#: The same for clusters, in shingles.
SLICE_SHINGLES, PART_SHINGLES = 400_000, 500_000
#: Bits of the filter that tells which texts are parsed again.
FILTER_BITS = 1 << 26
LEAF = 16
ROW, COUNT = 0, 1
POINT, MEMBER, ASK = 0, 1, 2


def needed(n: int, percent: int) -> int:
    """The least overlap with any partner of a set of n."""
    return -(-percent * n // 100)


def shingle_set(words: list[bytes], prints: Fingerprints, width: int) -> np.ndarray:
    """Sorted distinct shingles; the whole sequence if there are fewer words, nothing if there are none."""
    h = prints.of(words)
    return np.unique(shingles(h, min(width, len(h)))) if len(h) else np.empty(0, np.uint64)


def class_of(own: np.ndarray) -> int:
    """A set's fingerprint: the sum of its mixed members, signed."""
    total = np.sum(mix(own ^ np.uint64(BASE)), dtype=np.uint64) + np.uint64(len(own))
    return int(total.view(np.int64))


def sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[dict, np.ndarray]]:
    """Every row, without its text, and its shingle set."""
    prints = Fingerprints(limit=WORDS)
    for batch in slices(batches, "text"):
        others = batch.drop_columns(["text"]).to_pylist()
        for row, text in zip(others, batch.column("text").to_pylist(), strict=True):
            yield row, shingle_set(split(text, lower=True), prints, width)


def profile(docs: DataFrame, width: int) -> DataFrame:
    """A row per document (kind ROW: id, tag, class, n) and counts of shingles that a task saw often (kind COUNT: class, n)."""

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        names, kinds = ["kind", "id", "tag", "class", "n"], [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for part in groups(sets(batches, width), lambda r: len(r[1]) + 1, HELD):
            rows, new = [], []
            for row, own in part:
                name = class_of(own)
                rows.append((ROW, row["id"], row["tag"], name, len(own)))
                if name not in known:
                    known.add(name)
                    new.append(own)
            found, times = np.unique(np.concatenate(new), return_counts=True) if new else (np.empty(0, np.uint64),) * 2
            often = times >= SEEN
            rows += [(COUNT, None, None, t, n) for t, n in zip(found[often].view(np.int64).tolist(), times[often].tolist(), strict=True)]
            yield batch(rows)

    return docs.mapInArrow(lean(task), "kind int, id bigint, tag bigint, class bigint, n bigint")


def first_shingles(own: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    """The shingles of a set that any partner shares one of."""
    n = len(own) - needed(len(own), percent) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
        rare = own[common[at] != own]
        own = np.concatenate([rare, own[common[at] == own]]) if len(rare) < n else rare
    return own[:n]


def block_table(docs: DataFrame, width: int, percent: int, common: np.ndarray, parts: int) -> DataFrame:
    """Points of classes, members of blocks found within a task, and per task one class of each shingle, by part."""
    kinds = {"kind": pa.int32(), "class": pa.int64(), "n": pa.int64(), "counts": pa.binary(), "shingle": pa.int64(), "part": pa.int32(), "data": pa.binary()}

    def batch(**columns: list) -> pa.RecordBatch:
        size = len(columns["kind"])
        return pa.RecordBatch.from_arrays([pa.array(columns.get(n, [None] * size), k) for n, k in kinds.items()], list(kinds))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for part in groups(sets(batches, width), lambda r: len(r[1]) + 1, HELD):
            names, points, firsts = [], [], []
            for _, own in part:
                name = class_of(own)
                if not len(own) or name in known:
                    continue
                known.add(name)
                names.append(name)
                points.append((len(own), np.minimum(group_counts(own), MANY).astype(np.uint8).tobytes()))
                firsts.append(first_shingles(own, common, percent))
            if not names:
                continue
            yield batch(**{"kind": [POINT] * len(names), "class": names, "n": [n for n, _ in points], "counts": [c for _, c in points]})
            tokens, owners = np.concatenate(firsts), np.repeat(np.array(names, np.int64), [len(f) for f in firsts])
            order = np.lexsort((owners, tokens))
            tokens, owners = tokens[order], owners[order]
            first = np.ones(len(tokens), bool)
            first[1:] = tokens[1:] != tokens[:-1]
            alone = first & np.append(first[1:], True)
            shared = ~alone
            yield batch(**{"kind": [MEMBER] * int(shared.sum()), "class": owners[shared], "shingle": tokens[shared].view(np.int64)})
            tokens, owners = tokens[first], owners[first]  # in order, so by part
            edges = np.searchsorted(tokens, np.array([(i << 64) // parts for i in range(1, parts)], np.uint64))
            packed = [(i, t.tobytes() + o.tobytes()) for i, (t, o) in enumerate(zip(np.split(tokens, edges), np.split(owners, edges), strict=True)) if len(t)]
            yield batch(kind=[ASK] * len(packed), part=[i for i, _ in packed], data=[d for _, d in packed])

    return docs.mapInArrow(lean(task), "kind int, class bigint, n bigint, counts binary, shingle bigint, part int, data binary")


def met(table: pa.Table) -> pa.Table:
    """Members (shingle, class) of the shingles that several tasks have sent."""
    data = [d for d in table.column("data").to_pylist()]
    tokens = np.concatenate([np.frombuffer(d, np.uint64, len(d) // 16) for d in data])
    owners = np.concatenate([np.frombuffer(d, np.int64, len(d) // 16, len(d) // 2) for d in data])
    order = np.argsort(tokens)
    tokens, owners = tokens[order], owners[order]
    same = np.zeros(len(tokens) + 1, bool)
    same[1:-1] = tokens[1:] == tokens[:-1]
    shared = same[1:] | same[:-1]
    return pa.table({"shingle": tokens[shared].view(np.int64), "class": owners[shared]})


def group_counts(own: np.ndarray) -> np.ndarray:
    """Shingles per group; groups are ranges of fingerprints, so half as many are sums of neighbours."""
    size = GROUPS
    while size * DENSE < len(own):
        size *= 2
    return np.bincount((own >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64), minlength=size)


def fine(data: bytes) -> np.ndarray:
    """Counts of a point; one that was cut is as large as can be."""
    counts = np.frombuffer(data, np.uint8).astype(np.int64)
    return np.where(counts == MANY, 1 << 40, counts) if (counts == MANY).any() else counts


def folded(counts: np.ndarray, size: int) -> np.ndarray:
    return counts.reshape(size, -1).sum(axis=1) if len(counts) > size else counts


def overlap_bound(one: np.ndarray, two: np.ndarray) -> int:
    """The most that two sets can share, by the groups that the smaller number of them has."""
    size = min(len(one), len(two))
    return int(np.minimum(folded(one, size), folded(two, size)).sum())


def enough(n: np.ndarray, m: np.ndarray, overlap: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of n and m that share so many are similar: overlap / union >= percent / 100."""
    return (100 + percent) * overlap >= percent * (n + m)


class Tree:
    """R-tree over points (size, counts), packed by size, then by the counts' groups in turn."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order = np.arange(len(points))
        self.sort(0, len(points), 0)
        starts = np.arange(0, len(points), LEAF)
        boxes = points[self.order]
        #: levels from the leaves up: the largest coordinates and the smallest size of every LEAF nodes below
        self.levels = [(np.maximum.reduceat(boxes, starts), np.minimum.reduceat(boxes[:, 0], starts))]
        while len(self.levels[-1][0]) > LEAF:
            high, low = self.levels[-1]
            starts = np.arange(0, len(high), LEAF)
            self.levels.append((np.maximum.reduceat(high, starts), np.minimum.reduceat(low, starts)))

    def sort(self, start: int, stop: int, axis: int) -> None:
        """Sort-tile: cuts a range into runs along an axis, and each run along the next."""
        part = self.order[start:stop]
        self.order[start:stop] = part[np.argsort(self.points[part, axis], kind="stable")]
        step = max(LEAF, -(-(stop - start) // 4) // LEAF * LEAF)
        if stop - start > LEAF and axis + 1 < self.points.shape[1]:
            for at in range(start, stop, step):
                self.sort(at, min(at + step, stop), axis + 1)

    def search(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Points whose sizes and summed smaller counts allow similarity with the query."""
        nodes = np.arange(len(self.levels[-1][0]))
        for high, low in reversed(self.levels):
            nodes = nodes[nodes < len(high)]
            box, least = high[nodes], low[nodes]
            shared = np.minimum(box[:, 1:], query[1:]).sum(axis=1)
            fits = enough(query[0], least, shared, percent) & (100 * box[:, 0] >= percent * query[0]) & (100 * query[0] >= percent * least)
            nodes = (nodes[fits][:, None] * LEAF + np.arange(LEAF)).ravel()
        found = self.order[nodes[nodes < len(self.order)]]
        box = self.points[found]
        shared = np.minimum(box[:, 1:], query[1:]).sum(axis=1)
        fits = enough(query[0], box[:, 0], shared, percent) & (100 * box[:, 0] >= percent * query[0]) & (100 * query[0] >= percent * box[:, 0])
        return found[fits]


def distinct_blocks(members: DataFrame) -> DataFrame:
    """Members (shingle, class) of one of all blocks that have the same members."""
    name = F.xxhash64("class"), F.xxhash64("class", F.lit(1))
    blocks = members.groupBy("shingle").agg(F.bit_xor(name[0]).alias("one"), F.bit_xor(name[1]).alias("two"), F.count("*").alias("n"))
    kept = blocks.groupBy("one", "two", "n").agg(F.min("shingle").alias("shingle")).select("shingle")
    return members.join(kept, "shingle")


Links = Callable[[int], np.ndarray]


def hanging(labels: np.ndarray, asks: np.ndarray, links: Links) -> np.ndarray:
    """Labels after the members that ``links`` gives for an asking member have got one label with it.

    Members whose label is the main one at the time need not ask: whoever could
    be linked with them does.  The main label is that of the members which
    never ask, who all share one, or where all ask the most frequent.
    """
    labels, waiting = labels.copy(), asks.copy()
    silent = np.flatnonzero(~asks)
    while True:
        main = labels[silent[0]] if len(silent) else np.bincount(labels).argmax()
        rest = np.flatnonzero(waiting & (labels != main))
        if not len(rest):
            return labels
        waiting[rest[0]] = False
        met = np.unique(labels[np.append(links(rest[0]), rest[0])])
        if len(met) > 1:
            labels[np.isin(labels, met)] = met[0]


def linked_points(pdf: pd.DataFrame, percent: int) -> Links:
    """Who may be similar to a member, by a tree of the members' points; small slices need none."""
    counts = [fine(c) for c in pdf["counts"]]
    spots = np.column_stack([pdf["n"].to_numpy(np.int64), np.array([folded(c, GROUPS) for c in counts])])
    tree = Tree(spots) if len(spots) > 4 * LEAF else None

    def links(k: int) -> np.ndarray:
        query = spots[k]
        if tree:
            hits = tree.search(query, percent)
        else:
            shared = np.minimum(spots[:, 1:], query[1:]).sum(axis=1)
            hits = np.flatnonzero(enough(query[0], spots[:, 0], shared, percent))
        if len(counts[k]) > GROUPS:
            closer = np.array([overlap_bound(counts[k], counts[h]) for h in hits.tolist()], np.int64)
            hits = hits[enough(query[0], spots[hits, 0], closer, percent)]
        return hits

    return links


def linked_sets(pdf: pd.DataFrame, percent: int) -> Links:
    """Who is similar to a member, by exact overlaps: the lists of members by shingle are counted."""
    sets_ = [np.frombuffer(o, np.uint64) for o in pdf["own"]]
    sizes = np.array([len(o) for o in sets_], np.int64)
    tokens, place = np.unique(np.concatenate(sets_), return_inverse=True)
    owners = np.repeat(np.arange(len(sets_)), sizes)[np.argsort(place, kind="stable")]
    starts = np.searchsorted(np.sort(place), np.arange(len(tokens) + 1))
    own = np.split(place, np.cumsum(sizes)[:-1])

    def links(k: int) -> np.ndarray:
        lengths = starts[own[k] + 1] - starts[own[k]]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(starts[own[k]], lengths)
        shared = np.bincount(owners[at], minlength=len(sizes))
        return np.flatnonzero(enough(sizes[k], sizes, shared, percent))

    return links


def together(members: DataFrame, payload: DataFrame, link: Callable[[pd.DataFrame, int], Links], percent: int, slice_weight: int, part_weight: int) -> DataFrame:
    """(node, root) of all classes that hang together by links within groups.

    ``members`` has (group, class, weight), ``payload`` what ``link`` needs of a
    class.  Groups beyond ``slice_weight`` are cut into slices, in every group
    otherwise, and links are looked for within slices first.  Then the members
    of such groups that are not in their group's largest component ask in all
    of its slices.
    """
    spark = members.sparkSession
    columns = [c for c in payload.columns if c != "class"]
    sizes = stored(members.groupBy("group").agg(F.sum("weight").alias("weight"), F.count("*").alias("members")).where("members > 1"), "groups")
    total, largest = sizes.agg(F.sum("weight"), F.max("weight")).first()
    if not total:
        return spark.createDataFrame([], "node bigint, root bigint")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_weight))
    cut = sizes.select("group", F.ceil(F.col("weight") / slice_weight).alias("slices"))
    of = F.pmod(F.xxhash64("class", "group"), F.col("slices"))

    def search(rows: DataFrame) -> DataFrame:
        """Star edges (a, b) of what hangs together in every slice of rows (group, slice, class, root, asks, ...)."""

        def task(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["group", "slice", "class"], ignore_index=True)
            roots, asks, found = pdf["root"].to_numpy(), pdf["asks"].to_numpy(bool), [np.empty((0, 2), np.int64)]
            for i, j in bounds(pdf["group"].to_numpy(), pdf["slice"].to_numpy()):
                if j - i < 2:
                    continue
                names, labels = np.unique(roots[i:j], return_inverse=True)
                after = hanging(labels, asks[i:j], link(pdf.iloc[i:j], percent))
                pairs = np.unique(np.column_stack([names[after], names[labels]]), axis=0)
                found.append(pairs[pairs[:, 0] != pairs[:, 1]])
            out = np.concatenate(found)
            give_back()
            return pd.DataFrame({"a": out[:, 0], "b": out[:, 1]})

        part = F.pmod(F.xxhash64("group", "slice"), F.lit(parts))
        rows = rows.join(payload, "class").select("group", "slice", "class", "root", "asks", *columns).withColumn("part", part)
        return rows.groupBy("part").applyInPandas(task, "a bigint, b bigint")

    first = members.join(cut, "group").select("group", of.alias("slice"), "class", F.col("class").alias("root"), F.lit(True).alias("asks"))
    found = components(search(first))
    if largest <= slice_weight:
        return found

    rooted = members.join(cut.where("slices > 1"), "group").join(found, members["class"] == found["node"], "left")
    rooted = rooted.select("group", "class", "slices", F.coalesce("root", "class").alias("root"))
    mains = rooted.groupBy("group", "root").agg(F.count("*").alias("n")).groupBy("group")
    mains = mains.agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1")
    open_ = stored(rooted.join(mains.select("group", "main"), "group"), "open")
    own = open_.select("group", of.alias("slice"), "class", "root", (F.col("root") != F.col("main")).alias("asks"))
    elsewhere = open_.where("root <> main").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1))).where(F.col("slice") != of)
    both = own.unionByName(elsewhere.select("group", "slice", "class", "root", F.lit(True).alias("asks")))
    return components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(search(both)))


def asked_bits(wanted: DataFrame, *names: str) -> np.ndarray:
    """A filter of FILTER_BITS bits that holds the wanted rows' names; the driver gets these bits and no more."""
    at = F.pmod(F.xxhash64(*names), F.lit(FILTER_BITS)) + 1
    bits = wanted.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
    found = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, data in bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit")).collect():
        found[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(data, np.uint8)[: len(found)]
    return found


def sets_of(rows: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """(class, own): the shingle sets of the classes in ``reps`` (class, id, tag), each from one of its rows.

    A filter leaves hardly any other texts to be shuffled, and of rows that
    repeat id and text one in a task.  They are always shuffled, few or many:
    else filter and sets would run in one stage, and each task would need two
    Python workers, which stay.
    """
    wanted = asked_bits(reps, "id", "tag")

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int | None, int]] = set()
        for batch in batches:
            at = batch.column("at").to_numpy()
            hit = (wanted[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            names = zip(batch.column("id").to_pylist(), batch.column("tag").to_pylist(), strict=True)
            if len(seen) > WORDS:
                seen.clear()
            new = [bool(h) and n not in seen and not seen.add(n) for h, n in zip(hit.tolist(), names, strict=True)]
            yield batch.drop_columns(["at"]).filter(pa.array(new, pa.bool_()))

    def own_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in groups(sets(batches, width), lambda r: len(r[1]) + 1, HELD):
            yield pa.RecordBatch.from_arrays([pa.array([r["class"] for r, _ in part], pa.int64()), pa.array([o.tobytes() for _, o in part], pa.binary())], ["class", "own"])

    some = rows.select("id", "tag", "text", F.pmod(F.xxhash64("id", "tag"), F.lit(FILTER_BITS)).alias("at")).mapInArrow(lean(likely), "id bigint, tag bigint, text string")
    reps = reps.select("class", F.col("id").alias("rep_id"), F.col("tag").alias("rep_tag"))
    chosen = some.join(reps.hint("merge"), F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("tag") == F.col("rep_tag")))
    return chosen.select("class", "text").mapInArrow(lean(own_sets), "class bigint, own binary").dropDuplicates(["class"])


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, width: int = 5) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, stays.

    Words are runs of bytes other than space and \\x09-\\x0D with A-Z in lower
    case; a document's set is its distinct ``width``-word shingles, or its whole
    sequence if it has fewer words.  Documents link when overlap / union is
    ``percent`` or more; component_id is the smallest key that links reach.
    Null and empty texts have no shingles and link with nothing.  Of every
    component the row with the smallest key, then text fingerprint, stays; rows
    that repeat both do as one.  A null key is larger than any other.  Other
    columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select("id", F.xxhash64("text").alias("tag"), "text")
    known = stored(profile(rows, width), "profile", by="kind")
    light = known.where(F.col("kind") == ROW).select("id", "tag", "class", "n")
    total = light.agg(F.sum("n")).first()[0] or 0
    least = max(COMMON_FROM, total // MOST_COMMON)
    common = known.where(F.col("kind") == COUNT).groupBy("class").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    common = np.sort(common.select("class").toArrow().column("class").to_numpy().astype(np.int64).view(np.uint64))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (5 * GROUP_SHINGLES)))
    blocks = stored(block_table(rows, width, percent, common, parts), "blocks", by="kind")

    points = stored(blocks.where(F.col("kind") == POINT).select("class", "n", "counts").dropDuplicates(["class"]), "points")
    asked = blocks.where(F.col("kind") == ASK).select("part", "data").groupBy("part").applyInArrow(met, "shingle bigint, class bigint")
    members = stored(blocks.where(F.col("kind") == MEMBER).select("shingle", "class").unionByName(asked).distinct(), "members")
    free(blocks)
    few = stored(distinct_blocks(members).select(F.col("shingle").alias("group"), "class", F.lit(1).alias("weight")), "distinct_blocks")
    free(members)

    # What may be similar hangs together in clusters, and within these what is.
    clusters = stored(together(few, points, linked_points, percent, TREE_MEMBERS, PART_MEMBERS), "clusters")
    free(few)
    roots = clusters.select(F.col("root").alias("class")).distinct().select("class", F.col("class").alias("group"))
    in_clusters = clusters.select(F.col("node").alias("class"), F.col("root").alias("group")).unionByName(roots)
    in_clusters = stored(in_clusters.join(points.select("class", F.col("n").alias("weight")), "class").select("group", "class", "weight"), "in_clusters")
    reps = light.join(in_clusters.select("class"), "class", "left_semi").groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tag")).alias("rep"))
    held = stored(sets_of(rows, stored(reps.select("class", "rep.id", "rep.tag"), "reps"), width), "sets")
    roots = stored(together(in_clusters, held, linked_sets, percent, SLICE_SHINGLES, PART_SHINGLES), "roots")
    free(held)

    # A component's number is its smallest key, over all rows of all its classes.
    named = light.groupBy("class").agg(F.min("id").alias("least")).join(roots, F.col("class") == F.col("node"), "left")
    named = named.select("class", "least", F.coalesce("root", "class").alias("root"))
    whole = named.groupBy("root").agg(F.min("least").alias("component"))
    named = stored(named.join(whole, "root").select("class", "component", F.col("root").alias("name")), "components")
    some = light.where("n > 0").join(named, "class").select("id", "tag", "n", "component", "name")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "tag")
    first = some.groupBy(F.col("name").alias("of")).agg(F.min(place).alias("first"))
    judged = some.join(first, F.col("name") == F.col("of")).withColumn("stays", F.col("first") == place).drop("of", "first", "name")
    bare = light.where("n = 0").select("id", "tag", "n", F.col("id").alias("component"), F.lit(True).alias("stays"))
    return judged.select("id", "tag", "n", "component", "stays").unionByName(bare).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "stays", F.col("tag").alias("text_print"),
    )
