"""Near-duplicate embeddings by randomised-rotation binary codes.

A vector is rotated at random and kept as its signs, with the inner product of vector and
signs as correction factor; dividing by it makes the product of a code with another vector
an unbiased estimate of their cosine, with a known error (Gao and Long, 2024).  Codes,
factors and the rotated vectors in a byte a component are computed once and stored; they
alone travel to where blocks of vectors meet, where the estimate and its confidence bound decide which
pairs need exact recomputation.  Whole vectors are fetched only for those pairs.

Vectors of a large label gather around pivots.  Blocks of two pivots meet unless the
triangle inequality of angles rules out that any pair reaches the threshold, so no pair is left to chance.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, ship, stored
from .components import components

COSINE = 0.93
BLOCK = 2048  # vectors that meet as many others in one task, by expectation
PIVOTS = 512  # of a label at most, by expectation; one for each BLOCK of its vectors before that
CHUNK = 16_384  # vectors that look for their pivot in one task
DEVIATIONS = 5.0  # of an estimate's error, before a pair is ruled out without exact recomputation
SLACK = 1e-5  # for the rounding of estimates

_rotations: dict[tuple[int, int], np.ndarray] = {}


def rotation(dim: int, turn: int) -> np.ndarray:
    """The ``turn``-th random rotation of ``dim`` dimensions, the same in every task."""
    if (dim, turn) not in _rotations:
        q, r = np.linalg.qr(np.random.default_rng([dim, turn]).standard_normal((dim, dim)))
        _rotations[dim, turn] = q * np.sign(np.diag(r))
    return _rotations[dim, turn]


def unpacked(pdf: pd.DataFrame) -> np.ndarray:
    """The byte vectors, at length 1."""
    x = np.frombuffer(b"".join(pdf["small"]), np.int8).reshape(len(pdf), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


def may_meet(between: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether vectors around two pivots can be as near as COSINE.

    ``between`` holds the angles of the pivots, ``low`` and ``high`` the bounds of the angles of each
    pivot's vectors to it.  The angle of two vectors is at least any of the three differences.
    """
    widest = math.acos(COSINE) + 1e-6
    least = np.maximum(between - high[:, None] - high[None, :], np.maximum(low[:, None] - between - high[None, :], low[None, :] - between - high[:, None]))
    return least <= widest


def units(vectors) -> np.ndarray:
    x = np.stack(vectors).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def encoded(unit: np.ndarray) -> tuple[np.ndarray, ...]:
    """(code bits, factor, bytes, scale, residual): the rotated vectors as signs with their correction, and in a byte a component with its error."""
    turned = unit @ rotation(unit.shape[1], 0)
    factor = np.abs(turned).sum(axis=1) / math.sqrt(unit.shape[1])  # vector times its code
    scale = np.abs(turned).max(axis=1) / 127
    small = np.round(turned / scale[:, None])
    residual = np.linalg.norm(turned - small * scale[:, None], axis=1)
    return np.packbits(turned >= 0, axis=1), factor, small.astype(np.int8), scale, residual


def survivors(code, factor, small, scale, residual) -> np.ndarray:
    """Whether the cosine of each (coded, byte vector) pair may reach COSINE: its estimate and the bound of its error."""
    dim = small.shape[1]
    signs = np.unpackbits(code, axis=1)[:, :dim].astype(np.float32) * 2 - 1
    estimate = (signs @ small.astype(np.float32).T) * scale.astype(np.float32) / (math.sqrt(dim) * factor).astype(np.float32)[:, None]
    error = DEVIATIONS * np.sqrt(np.maximum(0.0, 1 - factor**2) / max(1, dim - 1)) / factor
    return estimate >= COSINE - SLACK - error[:, None] - residual / factor[:, None]


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place reachable from each place."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            return label


def _meetings(codes: DataFrame) -> tuple[DataFrame, list[str], DataFrame]:
    """(rows of ``codes`` for each pair of blocks they take part in, the columns that name a pair, a stored table to let go later).

    A block is a pivot's share of a label's vectors, or a part of it by hash.  A label of
    one block has no pivots.  Pairs of pivots are decided on the at most PIVOTS pivots of a label.
    """
    group = ["_label", "dim"]
    draw = F.pmod(F.xxhash64("rep", "_a"), F.lit(1 << 30))
    sizes = codes.groupBy(*group).agg(F.count("*").alias("n"))
    sizes = sizes.withColumns({"_k": F.least(F.ceil(F.col("n") / BLOCK), F.lit(PIVOTS)), "_chunks": F.ceil(F.col("n") / CHUNK).cast("int")})
    sizes = stored(sizes, "vector-sizes")
    all_rows = codes.join(sizes, group)
    large = all_rows.where("_k > 1")
    pivots = stored(large.where(draw < F.col("_k") / F.col("n") * (1 << 30)).select(*group, "rep", "_a", "small", "_chunks"), "vector-pivots")
    kinds = {f.name: f.dataType.simpleString() for f in codes.schema}

    def settle(rows: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        x, out = unpacked(rows), rows[["_label", "dim", "rep", "_a"]]
        if around.empty:
            return out.assign(home=0, low=0.0, high=math.pi)
        found = angles(x, unpacked(around.sort_values(["rep", "_a"])))
        home = found.argmin(axis=1)
        angle, off = found[np.arange(len(x)), home], np.arcsin(np.minimum(rows["residual"].to_numpy(), 1.0)) + 1e-6  # of the byte vector from the vector
        return out.assign(home=home, low=angle - off, high=angle + off)

    chunked = large.select(*group, "rep", "_a", "small", "residual", F.pmod(F.xxhash64("_a", "rep"), F.col("_chunks")).cast("int").alias("_chunk"))
    sent = pivots.select(*group, "rep", "_a", "small", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)).alias("_chunk"))
    keys = [*group, "_chunk"]
    settled = chunked.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(settle, f"_label {kinds['_label']}, dim int, rep long, _a long, home int, low double, high double")
    alone = all_rows.where("_k = 1").select(*group, "rep", "_a", F.lit(0).alias("home"), F.lit(0.0).alias("low"), F.lit(math.pi).alias("high"))
    homes = stored(settled.unionByName(alone), "vector-homes")
    shares = homes.groupBy(*group, "home").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), F.min("low").alias("low"), F.max("high").alias("high"))

    def decide(shares: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        shares, around = shares.sort_values("home", ignore_index=True), around.sort_values(["rep", "_a"], ignore_index=True)
        near = np.ones((len(shares), len(shares)), bool)
        if len(around):
            centre = unpacked(around)[shares["home"].to_numpy()]
            near = may_meet(angles(centre, centre), shares["low"].to_numpy(), shares["high"].to_numpy())
        p, q = np.nonzero(near | np.eye(len(shares), dtype=bool))
        own = shares.iloc[p].reset_index(drop=True)
        return own[["_label", "dim", "home", "parts"]].assign(other=shares["home"].to_numpy()[q], others=shares["parts"].to_numpy()[q])

    meets = shares.groupBy(*group).cogroup(pivots.groupBy(*group)).applyInPandas(decide, f"_label {kinds['_label']}, dim int, home int, parts int, other int, others int")
    meets = stored(meets.where("parts IS NOT NULL"), "vector-meetings")
    met = codes.join(homes.drop("low", "high"), [*group, "rep", "_a"]).join(meets, [*group, "home"])
    block = lambda home, part: F.col(home).cast("long") * (1 << 32) + part
    met = met.withColumn("at", block("home", F.pmod(F.xxhash64("_a"), F.col("parts"))))
    met = met.withColumn("with", F.explode(F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda part: block("other", part))))
    met = met.withColumns({"p": F.least("at", "with"), "q": F.greatest("at", "with")}).drop("home", "parts", "other", "others", "with")
    return met, [*group, "p", "q"], homes


def embedding_links(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: id, n_links, component_id (smallest id reachable by links), kept (id = component_id).

    Vectors link if their labels are equal and not null, their dimensions agree and their cosine, in double
    precision, is at least 0.93.  Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null id, link with nothing and are kept.
    Every pair of vectors of a label is compared by its codes, or ruled out by the angles to pivots,
    however large the label is.  Equal vectors of a label are compared as one and counted in full; repeated rows count
    once.  Ids are integers; further columns are not read.
    """
    ship(vectors.sparkSession)
    kind = vectors.schema[vector_col].dataType.simpleString()
    v = F.col("_v")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("_label"),
        F.col(vector_col).cast("array<float>" if kind == "array<float>" else "array<double>").alias("_v"))
    fine = F.size(v) > 0
    fine &= F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    fine &= F.exists(v, lambda e: e != 0)
    good = rows.where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.coalesce(fine, F.lit(False)))
    # Equal vectors of a label have equal 128 bits; two hashes of different seeds stand for the vector where rows are dealt out.
    same = ["_label", "_a", "_b"]
    good = good.select("_id", "_label", F.xxhash64(F.lit(1), v).alias("_a"), F.xxhash64(F.lit(2), v).alias("_b"), "_v")
    members = stored(good.select("_id", *same).distinct(), "vector-members")
    classes = members.groupBy(*same).agg(F.min("_id").alias("rep"), F.count("*").alias("w"))
    values = good.groupBy(*same).agg(F.first("_v").alias("v"))
    classes = stored(classes.join(values, same), "vector-classes")
    @F.pandas_udf("dim int, code binary, factor double, small binary, scale double, residual double")
    def coded(vs: pd.Series) -> pd.DataFrame:
        out: list = [None] * len(vs)
        for dim, at in vs.groupby(vs.map(len)).groups.items():
            code, factor, small, scale, residual = encoded(units(vs[at]))
            for n, i in enumerate(at):
                out[i] = (dim, code[n].tobytes(), factor[n], small[n].tobytes(), scale[n], residual[n])
        return pd.DataFrame(out, columns=["dim", "code", "factor", "small", "scale", "residual"])

    codes = stored(classes.select("_label", "rep", "_a", coded("v").alias("c")).select("_label", "rep", "_a", "c.*"), "vector-codes")
    met, pair, homes = _meetings(codes)

    def estimate(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rep", "_a"], ignore_index=True)
        p, q = (int(pdf[c].iloc[0]) for c in ("p", "q"))
        at = pdf["at"].to_numpy()
        left, right = np.flatnonzero(at == p), np.flatnonzero(at == q)
        code, small = (np.frombuffer(b"".join(pdf[c]), t).reshape(len(pdf), -1) for c, t in (("code", np.uint8), ("small", np.int8)))
        factor, scale, residual = (pdf[c].to_numpy() for c in ("factor", "scale", "residual"))
        i, j = np.nonzero(survivors(code[left], factor[left], small[right], scale[right], residual[right]))
        i, j = left[i], right[j]
        good = i < j if p == q else np.ones(len(i), bool)
        i, j = i[good], j[good]
        active = np.unique(np.concatenate([i, j]))
        i, j = np.searchsorted(active, i), np.searchsorted(active, j).astype(np.uint16)
        order = np.argsort(i, kind="stable")
        mates = np.split(j[order], np.searchsorted(i[order], np.arange(1, len(active)))) if len(active) else []
        out = pd.DataFrame({"rep": pdf["rep"].to_numpy()[active], "_a": pdf["_a"].to_numpy()[active], "mates": pd.Series([m.tobytes() for m in mates], dtype="object")})
        return out.assign(**{c: pdf[c].iloc[0] for c in pair})

    types = {f.name: f.dataType.simpleString() for f in met.schema}
    found = met.groupBy(*pair).applyInPandas(estimate, ", ".join(["rep long", "_a long", "mates binary", *(f"`{c}` {types[c]}" for c in pair)]))
    found = stored(found, "vector-survivors")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rep", "_a"], ignore_index=True)
        unit, mates = units(pdf["v"]), [np.frombuffer(m, np.uint16) for m in pdf["mates"]]
        i, j = np.repeat(np.arange(len(pdf)), [len(m) for m in mates]), np.concatenate(mates).astype(np.int64)
        near = np.concatenate([np.einsum("ij,ij->i", unit[i[k : k + 65536]], unit[j[k : k + 65536]]) >= COSINE for k in range(0, len(i), 65536)] or [np.zeros(0, bool)])
        i, j = i[near], j[near]
        w = pdf["w"].to_numpy()
        links = np.zeros(len(pdf), np.int64)
        np.add.at(links, i, w[j])
        np.add.at(links, j, w[i])
        ids = pdf["rep"].to_numpy()
        return pd.DataFrame({"rep": ids, "links": links, "to": ids[_forest(len(ids), i, j)]})[links > 0]

    exact = found.join(classes.select("_label", "rep", "_a", "w", "v"), ["_label", "rep", "_a"])
    compared = stored(exact.groupBy(*pair).applyInPandas(compare, "rep long, links long, to long"), "vector-links")
    discard(codes, found, homes)
    groups = components(compared.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    counts = compared.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = classes.join(counts, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    classes = stored(classes.drop("v"), "vector-results")
    members = members.join(classes, same)
    members = members.groupBy("_id").agg(
        F.sum(F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"),
        F.min(F.coalesce("component", "rep")).alias("component_id"))
    out = vectors.select(F.col(id_col), F.col(id_col).cast("long").alias("_id")).join(members, "_id", "left")
    component = F.coalesce("component_id", "_id")
    return out.select(
        F.col(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))
