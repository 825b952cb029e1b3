"""Near-duplicate documents by Order MinHash.

A sketch takes the LENGTH occurrence-labelled word shingles with the smallest hashes under
one hash function and keeps them in the order of the text, so it answers to edits and to
reordering alike (Marcais et al., 2019).  Sketches are strung into trees; at the chosen
depths of a tree, documents with the same sketches meet in a bucket, and each is paired
with the bucket's leader.  A banded alignment of the shingles verifies every pair.  A second
round looks for links between documents not yet joined: within small buckets pair by pair,
elsewhere with the shortest documents of each size class as leaders.  A last one decides all
pairs of different components in the larger buckets, dealt out block against block; lengths
and histograms of labels rule most of them out before the alignment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, mix64, ship, stored
from .components import components
from .word_hash import Rolling, hashed, words_of

SHINGLE = 5
SIMILARITY = 0.8
TREES = 16
DEPTHS = (2, 3)  # sketches that must agree in a bucket
LENGTH = 2  # shingles in a sketch
PAIRED = 24  # documents of a bucket that are compared pair by pair in a join
BLOCK = 1024  # documents of a larger bucket compared at once; it is dealt out block against block
BLOCK_LABELS = 4_000_000  # shingles in a block at most, so that blocks of long texts hold fewer documents
BROADCAST_IDS = 1_000_000  # ids sent to every task at most; beyond that the join shuffles

_U = np.uint64
_SKETCHES = TREES * max(DEPTHS)
_FLIP = mix64(np.arange(1, _SKETCHES + 1, dtype=_U))
_TIMES = mix64(np.arange(1001, 1001 + _SKETCHES, dtype=_U)) | _U(1)
_WIDE = 1 << 18  # cells of a sketch matrix held at once


def shingles(text: str | None) -> np.ndarray:
    """A label for each shingle of the lower-cased words in order: its hash and how often it came before.

    A text under SHINGLE words is one shingle; one without words has none.
    """
    words = words_of(text.lower() if text else text)
    if not words:
        return np.zeros(0, _U)
    grams = mix64(Rolling(hashed(words)).windows(min(SHINGLE, len(words))) + _U(min(SHINGLE, len(words))))
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    nth = np.arange(len(grams)) - np.repeat(first, np.diff(np.append(first, len(grams))))
    out = np.empty_like(grams)
    out[order] = mix64(ranked + nth.astype(_U) * _U(0x9E3779B97F4A7C15))
    return out


def sketches(labels: np.ndarray) -> np.ndarray:
    """_SKETCHES values: for each hash function the LENGTH smallest labels, hashed in text order."""
    n = len(labels)
    take = min(LENGTH, n)
    rows = max(1, _WIDE // n)
    out = []
    for at in range(0, _SKETCHES, rows):
        values = (labels[None, :] ^ _FLIP[at : at + rows, None]) * _TIMES[at : at + rows, None]
        places = []
        for _ in range(take):
            least = values.argmin(axis=1)
            places.append(least)
            values[np.arange(len(values)), least] = _U(0xFFFFFFFFFFFFFFFF)
        ordered = np.sort(np.stack(places, axis=1), axis=1)
        value = np.zeros(len(values), _U)
        for k in range(take):
            value = mix64(value * _U(3) + labels[ordered[:, k]])
        out.append(value)
    return np.concatenate(out)


def bucket_keys(sketch: np.ndarray) -> np.ndarray:
    """One key for each tree and depth."""
    trees = sketch.reshape(TREES, -1)
    keys, value = [], np.arange(TREES, dtype=_U) * _U(0xD6E8FEB86659FD93)
    for depth in range(1, trees.shape[1] + 1):
        value = mix64(value * _U(3) + trees[:, depth - 1])
        if depth in DEPTHS:
            keys.append(value)
    return np.concatenate(keys)


def alignment(x: np.ndarray, y: np.ndarray) -> float:
    """Shingles aligned in order over all shingles of both, by sparse dynamic programming in a band.

    Labels are unique within a text, so matches are points and the best alignment is the
    longest chain rising in both.  A chain that reaches SIMILARITY leaves so few shingles
    unmatched that no matched pair lies further from the diagonal than the band.
    """
    total = len(x) + len(y)
    band = int(total * (1 - 2 * SIMILARITY / (1 + SIMILARITY))) + 1
    order = np.argsort(y, kind="stable")
    at = np.minimum(np.searchsorted(y, x, sorter=order), len(y) - 1)
    there = order[at]
    mine = np.flatnonzero(y[there] == x)
    theirs = there[mine]
    theirs = theirs[np.abs(theirs - mine) <= band]
    if len(theirs) * (1 + SIMILARITY) < SIMILARITY * total:
        return len(theirs) / (total - len(theirs)) if len(theirs) else 0.0  # an upper bound, already too low
    chain = len(theirs) if (np.diff(theirs) > 0).all() else _longest_rise(theirs.tolist())
    return chain / (total - chain)


def _longest_rise(places: list[int]) -> int:
    from bisect import bisect_left

    ends: list[int] = []
    for p in places:
        k = bisect_left(ends, p)
        if k == len(ends):
            ends.append(p)
        else:
            ends[k] = p
    return len(ends)


def _signatures(docs: DataFrame) -> DataFrame:
    """_id, a, b (128-bit hash of the shingles), n (their number), keys (of the buckets)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist()):
                labels = shingles(text)
                if len(labels):
                    ends = np.array([0]), np.array([len(labels)])
                    a = Rolling(labels).spans(*ends)[0]
                    b = mix64(Rolling(mix64(labels ^ _U(0x5851F42D4C957F2D))).spans(*ends))[0]
                    rows.append((i, a, b, len(labels), bucket_keys(sketches(labels))))
            if rows:
                ids, a, b, n, keys = zip(*rows)
                flat = pa.array(np.concatenate(keys).view(np.int64))
                width = len(keys[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(np.array(a, _U).view(np.int64)), pa.array(np.array(b, _U).view(np.int64)), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(range(0, len(flat) + 1, width), pa.int32()), flat)],
                    ["_id", "a", "b", "n", "keys"])

    return docs.mapInArrow(of, "_id long, a long, b long, n long, keys array<long>")


def _labels(docs: DataFrame) -> DataFrame:
    """_id, labels: the shingle labels of each document as bytes."""

    @F.pandas_udf("binary")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([shingles(t).tobytes() for t in texts])

    return docs.select("_id", of("_text").alias("labels"))


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """x, y of the pairs whose alignment reaches SIMILARITY; of rows that share an id, one that does is enough."""
    ids = stored(pairs.select(F.explode(F.array("x", "y")).alias("_id")).distinct(), "candidate-ids")
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    labels = stored(_labels(docs.join(few, "_id", "left_semi")), "labels")
    discard(ids)

    @F.pandas_udf("double")
    def aligned(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([alignment(np.frombuffer(x, _U), np.frombuffer(y, _U)) for x, y in zip(xs, ys)], dtype="float64")

    pairs = F.broadcast(pairs) if pairs.count() <= BROADCAST_IDS else pairs
    of_y = labels.select(F.col("_id").alias("y"), F.col("labels").alias("ly"))
    both = labels.select(F.col("_id").alias("x"), F.col("labels").alias("lx")).join(pairs, "x").join(of_y, "y")
    links = stored(both.withColumn("s", aligned("lx", "ly")).where(F.col("s") >= SIMILARITY).select("x", "y"), "links")
    discard(labels)
    return links


def _by_size(placed: DataFrame) -> DataFrame:
    """Each row with the shortest document of its bucket in its own size class and the classes that can still reach it.

    Texts around one shared passage are most like the shortest of them.
    """
    size = F.floor(F.log2(F.col("n").cast("double")) * 6).cast("int")  # a step is a factor of 1.12
    shortest = placed.groupBy("key", size.alias("size")).agg(F.min(F.struct("n", "_id", "component")).alias("l"))
    shortest = stored(shortest.select("key", "size", F.col("l._id").alias("leader"), F.col("l.component").alias("other"), F.col("l.n").alias("m")), "shortest")
    return placed.withColumn("size", F.explode(F.array(size - 2, size - 1, size))).join(shortest, ["key", "size"])


def _by_pair(placed: DataFrame) -> DataFrame:
    """Every pair of a bucket of no more than PAIRED documents; larger ones are left to leaders and to deeper buckets."""
    rows = placed.where(F.col("c") <= PAIRED)
    other = rows.select("key", F.col("_id").alias("leader"), F.col("component").alias("other"), F.col("n").alias("m"))
    return rows.join(other, "key").where("_id > leader")


def linked(labels: list[np.ndarray], component: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Places of pairs, one of ``left`` and one of ``right``, that join all components which some such pair joins.

    Every pair of different components is decided: by length, by the histograms of its labels, whose
    distance is at most the number of labels not shared, or else by alignment.
    """
    n = np.array([len(x) for x in labels])
    order = np.argsort(n, kind="stable")
    root, out = component.copy(), []
    bins = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(int))  # as many as labels, or more
    for width in np.unique(bins[order]):
        reach = order[(n[order] * 2 > width if width > 64 else n[order] > 0) & (SIMILARITY * n[order] <= width)]
        table = np.stack([np.minimum(np.bincount((labels[i] & _U(width - 1)).astype(np.int64), minlength=width), 255) for i in reach]).astype(np.uint8)
        for at in np.flatnonzero(bins[reach] == width):
            i = reach[at]
            last = np.searchsorted(n[reach], n[i] / SIMILARITY + 1e-6, side="right")
            ahead = np.arange(at + 1, last)
            j = reach[ahead]
            ahead = ahead[(root[j] != root[i]) & (left[i] & right[j] | right[i] & left[j])]
            for k in range(0, len(ahead), max(1, _WIDE // width)):
                part = ahead[k : k + max(1, _WIDE // width)]
                apart = (np.maximum(table[part], table[at]) - np.minimum(table[part], table[at])).sum(axis=1, dtype=np.int64)
                total = n[i] + n[reach[part]]
                for j in reach[part[(total - apart) / 2 * (1 + SIMILARITY) >= SIMILARITY * total - 1e-6]]:
                    if root[i] != root[j] and alignment(labels[i], labels[j]) >= SIMILARITY:
                        root[root == root[j]] = root[i]
                        out.append((int(i), int(j)))
    return out


def _by_block(placed: DataFrame, docs: DataFrame) -> DataFrame:
    """x, y of links between components in buckets above PAIRED: all their pairs, block against block.

    A task holds at most about 2 BLOCK documents and 2 BLOCK_LABELS shingles, but for single longer texts.

    Members of a bucket's largest component are compared with the other members only.
    """
    placed = placed.where(F.col("c") > PAIRED)
    parts = placed.groupBy("key", "component").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    crowds = parts.groupBy("key").agg(F.sum("c").alias("c"), F.max(F.struct("c", "component")).alias("most"), F.max("n").alias("n"))
    crowds = crowds.where(F.col("most.c") < F.col("c"))
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_LABELS) / F.col("n"))))
    blocks = lambda c: F.ceil(c / block).cast("int")
    crowds = crowds.select("key", F.col("most.component").alias("most"), blocks(F.col("most.c")).alias("m"), blocks(F.col("c") - F.col("most.c")).alias("o"))
    rows = placed.select("key", "_id", "component").join(stored(crowds, "crowd-keys"), "key").withColumn("main", F.col("component") == F.col("most"))
    rows = rows.withColumn("at", F.pmod(F.xxhash64("_id"), F.when(F.col("main"), F.col("m")).otherwise(F.col("o"))).cast("int"))
    # Blocks of the others are 0 .. o - 1, those of the largest component follow.
    rows = rows.withColumn("at", F.when(F.col("main"), F.col("at") + F.col("o")).otherwise(F.col("at")))
    last = F.col("o") + F.when(F.col("main"), 0).otherwise(F.col("m")) - 1
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), last)))
    rows = rows.select("key", F.least("at", "with").alias("p"), F.greatest("at", "with").alias("q"), "at", "_id", "component")
    rows = stored(rows, "crowds")
    ids = stored(rows.select("_id").distinct(), "crowd-ids")
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    labels = stored(_labels(docs.join(few, "_id", "left_semi")), "crowd-labels")
    discard(ids)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        at, p, q = pdf["at"].to_numpy(), pdf["p"].iloc[0], pdf["q"].iloc[0]
        found = linked([np.frombuffer(x, _U) for x in pdf["labels"]], pdf["component"].to_numpy(), at == p, at == q)
        ids = pdf["_id"].to_numpy()
        return pd.DataFrame([(ids[i], ids[j]) for i, j in found], columns=["x", "y"], dtype="int64")

    links = stored(rows.join(labels, "_id").groupBy("key", "p", "q").applyInPandas(compare, "x long, y long").distinct(), "links")
    discard(rows, labels)
    return links


def _joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` after further links: only components that got one are searched anew."""
    of = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
    bridges = links.join(of("x"), "x", "left").join(of("y"), "y", "left")
    bridges = bridges.select(F.coalesce("cx", "x").alias("a"), F.coalesce("cy", "y").alias("b"))
    moved = stored(components(bridges), "moved")
    old = groups.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    old = old.select("node", F.coalesce("to", "component").alias("component"))
    return old.unionByName(moved.join(groups, "node", "left_anti"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, copy_of (smallest id with the same shingles), group_id, kept (id = group_id).

    Two documents link if their five-word shingles align at a similarity of 0.8 or more;
    group_id is the smallest id reachable by links.  A text without words (or null) and a
    row with a null id link with nothing and are kept.  Rows that share an id are one
    document.  Identical shingle sequences are settled first, so copies, however many,
    enter the search as one.  Ids are integers; further columns are not read.
    """
    ship(docs.sparkSession)
    keyed = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    signed = stored(_signatures(keyed.where("_id IS NOT NULL")), "signatures")
    # Grouped tables are stored before they are joined, so that the rows of a hot key can be split over tasks.
    classes = signed.groupBy("a", "b").agg(F.min("_id").alias("copy_of"), F.min_by("keys", "_id").alias("keys"), F.first("n").alias("n"))
    rows = classes.select(F.col("copy_of").alias("_id"), "n", F.posexplode("keys").alias("place", "key"))
    rows = rows.withColumn("least", F.col("place") < TREES).drop("place")
    met = rows.groupBy("key").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"), F.count("*").alias("c")).where("lo < hi")
    rows = stored(rows.join(stored(met.select("key", "lo", "c"), "met"), "key"), "buckets")
    copies = stored(signed.groupBy("a", "b").agg(F.min("_id").alias("copy_of")), "copies")
    sizes = rows.select(F.col("_id").alias("y"), F.col("n").alias("m")).distinct()
    alike = F.least("n", "m") >= SIMILARITY * F.greatest("n", "m")
    pairs = rows.where("_id <> lo").select(F.col("_id").alias("x"), "n", F.col("lo").alias("y")).distinct()
    pairs = stored(pairs.join(sizes, "y").where(alike).select("x", "y"), "pairs")
    groups = stored(components(_verified(pairs, keyed), "x", "y"), "groups")
    tested = pairs

    def placed_rows() -> DataFrame:
        return rows.join(groups.withColumnRenamed("node", "_id"), "_id", "left").withColumn("component", F.coalesce("component", "_id"))

    placed = placed_rows()
    wanted = "_id", "component", "n", "leader", "other", "m"
    apart = _by_size(placed).select(*wanted).unionByName(_by_pair(placed).select(*wanted))
    pairs = apart.where(alike & (F.col("component") != F.col("other"))).select(F.greatest("_id", "leader").alias("x"), F.least("_id", "leader").alias("y")).distinct()
    pairs = stored(pairs.join(tested, ["x", "y"], "left_anti"), "pairs")
    discard(tested)
    if not pairs.isEmpty():
        groups = stored(_joined(groups, _verified(pairs, keyed)), "groups")
    # Buckets of the least depth hold those of the others.
    crowded = _by_block(placed_rows().where("least"), keyed)
    if not crowded.isEmpty():
        groups = stored(_joined(groups, crowded), "groups")
    discard(pairs, rows)
    placed = signed.select("_id", "a", "b").join(copies, ["a", "b"])
    placed = placed.groupBy("_id").agg(F.min("copy_of").alias("copy_of"))
    placed = placed.join(groups.withColumnRenamed("node", "copy_of"), "copy_of", "left")
    out = docs.select(F.col(id_col), F.col(id_col).cast("long").alias("_id")).join(placed, "_id", "left")
    group = F.coalesce("component", "copy_of", "_id")
    return out.select(
        F.col(id_col), F.coalesce("copy_of", "_id").alias("copy_of"), group.alias("group_id"),
        F.coalesce(F.col("_id") == group, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the document of the smallest id of each group alone; all columns stay."""
    gone = near_duplicates(docs, id_col, text_col).where(~F.col("kept")).select(id_col).distinct()
    gone = stored(gone, "near-duplicates")
    few = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.join(few, id_col, "left_anti")
