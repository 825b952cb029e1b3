"""The trie of conversation prefixes by preorder intervals.

A node is a distinct sequence of first turns.  Nodes are told apart by running sums of
hashes that are keyed by position, ranked lexicographically by the branches on their path, and a
subtree is the interval from a node's rank to its end.  What a subtree holds is then a
difference of two prefix sums.  No step walks the trie level by level, and no conversation
or group of equal conversations has to fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import running_sums
from .common import discard, ship, stored, words_col

LANES = 4  # sums of 32-bit hashes that name a prefix, 128 bits together
PIECE = 1024  # ids joined into one text before the texts of a node meet


def ordered_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """_c, _at (from 0), _a, _b (two hashes of role and text), _words, one row per turn in the order of ``turn``, null first.

    A null role or text is empty.  Turns of one number go by their hashes, so by content;
    equal ones count each.  Turns of a null conversation belong to none and are left out.  Texts go no
    further than this.
    """
    said = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("_c"), F.col(turn).alias("_turn"), F.xxhash64(F.lit(1), *said).alias("_a"), F.xxhash64(F.lit(2), *said).alias("_b"),
        F.size(words_col(said[1])).cast("long").alias("_words"), F.monotonically_increasing_id().alias("_row"), F.lit(1).alias("_1"))
    rows = stored(rows, "turns")
    placed = running_sums(rows, ["_c"], [F.col("_turn").asc_nulls_first(), F.col("_a"), F.col("_b"), F.col("_row")], {"_at": "_1"})
    return placed.select("_c", "_at", "_a", "_b", "_words")


def rebuilt(turns: DataFrame, group: int = 20, folds: int = 4) -> DataFrame:
    """The rows of ``ordered_turns`` with the first h turns of every conversation c taken from conversation c - c % group.

    h is the crc32 of c in decimal, modulo ``folds``; an absent conversation gives nothing,
    a shorter one all it has.  A conversation may be left without turns: each has a row with
    _at null in the result, so that it still counts.  A remainder has the sign of c.
    """
    rows = stored(turns, "ordered-turns")
    sizes = rows.groupBy("_c").agg(F.count("*").alias("_n"))
    h = (F.crc32(F.col("_c").cast("string").cast("binary")) % folds).alias("_h")
    named = sizes.select("_c", h, (F.col("_c") - F.col("_c") % group).alias("_base"))
    taken = sizes.select(F.col("_c").alias("_base"), F.least("_n", F.lit(folds - 1)).alias("_has"))
    named = named.join(taken, "_base", "left").withColumn("_taken", F.least("_h", F.coalesce("_has", F.lit(0))))
    named = stored(named.select("_c", "_base", "_h", "_taken"), "conversations")
    own = rows.join(named.select("_c", "_h", "_taken"), "_c").where("_at >= _h").withColumn("_at", F.col("_taken") + F.col("_at") - F.col("_h"))
    lent = rows.where((F.col("_at") < folds - 1) & (F.col("_c") % group == 0)).withColumnRenamed("_c", "_base")
    lent = lent.join(named, "_base").where("_at < _h")
    keep = ["_c", "_at", "_a", "_b", "_words"]
    none = named.select("_c", *[F.lit(None).cast("long").alias(c) for c in ("_at", "_a", "_b")], F.lit(0).cast("long").alias("_words"))
    return own.select(keep).unionByName(lent.select(keep)).unionByName(none)


def _named(lanes: list[Column]) -> Column:
    """A prefix's name: two hashes of its sums."""
    return F.struct(F.xxhash64(F.lit(1), *lanes).alias("p"), F.xxhash64(F.lit(2), *lanes).alias("q"))


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted ids of sorted nodes, joined into texts of up to PIECE ids."""
    held: list[int] = []
    node = None
    for pdf in batches:
        out = []
        for *key, c in pdf[["conv_id", "depth", "_c"]].itertuples(index=False):
            if held and (key != node or len(held) == PIECE):
                out.append((*node, held[0], ",".join(map(str, held))))
                held = []
            node = key
            held.append(c)
        yield pd.DataFrame(out, columns=["conv_id", "depth", "_first", "_ids"])
    if held:
        yield pd.DataFrame([(*node, held[0], ",".join(map(str, held)))], columns=["conv_id", "depth", "_first", "_ids"])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The SHA-256 of the texts of each node, in order; a text is let go once it is read."""
    node, sha = None, None
    for pdf in batches:
        out = []
        for *key, ids in pdf[["conv_id", "depth", "_ids"]].itertuples(index=False):
            if key != node:
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield pd.DataFrame(out, columns=["conv_id", "depth", "ends_sha256"])
    if node:
        yield pd.DataFrame([(*node, sha.hexdigest())], columns=["conv_id", "depth", "ends_sha256"])


def prefix_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie over rows of _c, _at, _a, _b, _words, as ``ordered_turns`` and ``rebuilt`` give them.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs (members), n_children,
    n_leaves (nodes without a child in the subtree), saved_tokens (over the subtree,
    (n_convs - 1) * words of the last turn), ends_sha256 (SHA-256 of the ids of the members that end
    here, ascending, joined by commas; of nothing for none).  (conv_id, depth) names a node.

    Members that share no turn meet in the root, which is absent only if the table is empty.
    Equal conversations are members of the same nodes.
    """
    ship(turns.sparkSession)
    rows = turns.select(
        "_c", F.coalesce(F.col("_at") + 1, F.lit(0)).alias("depth"), F.when(F.col("_at").isNull(), F.lit(0)).otherwise(F.col("_words")).alias("_words"),
        *[F.when(F.col("_at").isNotNull(), F.xxhash64(F.lit(n), "_a", "_b", "_at")).alias(f"_h{n}") for n in range(LANES // 2)])
    roots = rows.select("_c").distinct().select("_c", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("_words"), *[F.lit(None).cast("long").alias(f"_h{n}") for n in range(LANES // 2)])
    rows = rows.where("depth > 0").unionByName(roots)
    low = F.lit(0xFFFFFFFF)
    lanes = [x for n in range(LANES // 2) for x in (F.col(f"_h{n}").bitwiseAND(low), F.shiftrightunsigned(f"_h{n}", 32))]
    rows = stored(rows.select("_c", "depth", "_words", *[F.coalesce(x, F.lit(0).cast("long")).alias(f"_l{i}") for i, x in enumerate(lanes)], F.lit(1).alias("_1")), "prefix-turns")
    summed = running_sums(rows, ["_c"], [F.col("depth")], {f"_s{i}": f"_l{i}" for i in range(LANES)} | {"_before": "_1"})
    here = [F.col(f"_s{i}") + F.col(f"_l{i}") for i in range(LANES)]
    rows = stored(summed.select("_c", "depth", "_words", (F.col("_before_all") == F.col("depth") + 1).alias("_ends"), _named(here).alias("_node")), "prefixes")
    nodes = stored(rows.groupBy("_node").agg(F.min("_c").alias("conv_id"), F.count("*").alias("n_convs")), "prefix-nodes")

    # Each conversation's way down: the nodes it passes.  Nodes with the same members lie on one edge, which
    # their smallest member and their number name; a path is the list of its edges.
    ways = stored(rows.join(nodes, "_node").drop("_node"), "prefix-ways")
    discard(nodes)
    edge = F.struct((-F.col("n_convs")).alias("less"), F.col("conv_id").alias("rep"))
    # Edges of which the conversation is no representative but that lie above one of which it is.
    own = F.col("_c") == F.col("conv_id")
    passed = ways.groupBy("_c").agg(F.array_sort(F.collect_set(edge)).alias("_edges"), F.max(F.when(own, F.col("n_convs"))).alias("_own")).where("_own IS NOT NULL")
    reps = ways.where(own).drop("_c")
    above = ways.select("_c", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id")).withColumnRenamed("_c", "conv_id")
    reps = reps.join(above, ["conv_id", "depth"], "left")
    reps = reps.join(passed.withColumnRenamed("_c", "conv_id"), "conv_id")
    path = F.transform(F.filter("_edges", lambda e: -e["less"] >= F.col("n_convs")), lambda e: F.struct(e["rep"].alias("rep"), e["less"].alias("less")))
    reps = stored(reps.select("conv_id", "depth", "parent_conv_id", "n_convs", ((F.col("n_convs") - 1) * F.col("_words")).alias("_saved"), path.alias("_path")), "prefix-reps")
    children = reps.where("parent_conv_id IS NOT NULL").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    reps = reps.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    reps = stored(reps.withColumns({"_leaf": (F.col("n_children") == 0).cast("long"), "_1": F.lit(1)}), "prefix-children")

    # Ranks by path and depth are a preorder; the last rank below an edge closes its nodes' subtrees.
    ranked = stored(running_sums(reps, [], [F.col("_path"), F.col("depth")], {"_rank": "_1", "_leaves": "_leaf", "_tokens": "_saved"}), "prefix-ranks")
    discard(reps)
    last = F.max(F.struct("_rank", (F.col("_leaves") + F.col("_leaf")).alias("leaves"), (F.col("_tokens") + F.col("_saved")).alias("tokens"))).alias("_last")
    lasts = ranked.groupBy("conv_id", "n_convs").agg(last, F.first("_path").alias("_path"))
    ends = lasts.select("_last", F.explode("_path").alias("_e")).groupBy(F.col("_e.rep").alias("conv_id"), (-F.col("_e.less")).alias("n_convs")).agg(F.max("_last").alias("_end"))
    found = ranked.join(stored(ends, "prefix-ends"), ["conv_id", "n_convs"]).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("_end.leaves") - F.col("_leaves")).alias("n_leaves"), (F.col("_end.tokens") - F.col("_tokens")).alias("saved_tokens"))

    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    closing = ways.where("_ends").select("conv_id", "depth", "_c").repartitionByRange(parts, "conv_id", "depth", "_c").sortWithinPartitions("conv_id", "depth", "_c")
    pieces = stored(closing.mapInPandas(_pieces, "conv_id long, depth long, _first long, _ids string"), "prefix-pieces")
    digests = pieces.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "_first").mapInPandas(_digests, "conv_id long, depth long, ends_sha256 string")
    return found.join(digests, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
