"""Gradient boosting on binned columns, for many training sets at once."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encode import Encoder, Job
from .linear import sigmoid

# The public defaults of histogram boosting.
BINS, LEAVES, LEAST_HESSIAN = 255, 31, 1e-3
STOPPING_ROWS, HELD_OUT, PATIENCE, STOPPING_TOL = 10_000, 0.1, 10, 1e-7

TASK_ROWS = 200_000  # training rows up to which a task fits a model alone
CHUNK = 16_384  # rows that a tree is asked for at once
JOINT = 1 << 14  # cells that columns are counted in at once
TABLE_SPLITS = 8  # of a tree whose values are looked up by the sides taken
TIE = 1e-10  # gains closer than this, relative to the sums they are made of, are equal: sums in another order differ by less


def landing(feature: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(nodes that split, node come to for each pattern of the sides taken at them: bit k is set where the k-th goes left) of a tree; None above 8 splits."""
    nodes = np.flatnonzero(feature >= 0)
    if len(nodes) > TABLE_SPLITS:
        return None
    place, at = {int(n): k for k, n in enumerate(nodes)}, np.zeros(1 << len(nodes), int)
    sides = np.arange(len(at))
    for n in nodes:  # a node's children have higher numbers
        goes = sides >> place[int(n)] & 1 == 1
        at = np.where(at == n, np.where(goes, left[n], right[n]), at)
    return nodes, at


@dataclass
class Trees:
    """Each row of the arrays is a tree, its nodes numbered from the root, 0; leaves have feature -1."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @cached_property
    def tables(self) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """(nodes that split, value for each pattern of the sides taken at them: bit k is set where the k-th goes left) of each tree; None above 8 splits."""
        found = [landing(*tree) for tree in zip(self.feature, self.left, self.right)]
        return [x and (x[0], self.value[t, x[1]]) for t, x in enumerate(found)]

    def given(self, x: np.ndarray, t: int) -> np.ndarray:
        """The value tree ``t`` gives each row; fast if the columns of ``x`` are contiguous."""
        if table := self.tables[t]:
            nodes, values = table
            code = np.zeros(len(x), np.uint8)
            for k, n in enumerate(nodes):
                code |= (x[:, self.feature[t, n]] <= self.threshold[t, n]).view(np.uint8) << k
            return values[code]
        out, at = np.zeros(len(x)), [(0, np.arange(len(x)))]
        while at:
            n, rows = at.pop()
            if self.feature[t, n] < 0:
                out[rows] = self.value[t, n]
            else:
                goes = x[rows, self.feature[t, n]] <= self.threshold[t, n]
                at += [(self.left[t, n], rows[goes]), (self.right[t, n], rows[~goes])]
        return out

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """trees x rows: the value each of the trees gives each row."""
        return np.stack([self.given(x, t) for t in range(len(self.feature))]) if len(self.feature) else np.zeros((0, len(x)))

    def raw(self, x: np.ndarray) -> np.ndarray:
        x, out = np.asfortranarray(x), np.full(len(x), self.base)
        for i in range(0, len(x), CHUNK):
            for t in range(len(self.feature)):
                out[i : i + CHUNK] += self.given(x[i : i + CHUNK], t)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))

    def using(self, columns: Sequence[int]) -> np.ndarray:
        """The numbers of the trees that split on one of the columns."""
        return np.flatnonzero(np.isin(self.feature, list(columns)).any(axis=1))

    def uses(self, columns: Sequence[int]) -> bool:
        return len(self.using(columns)) > 0

    def anew(self, new: np.ndarray, columns: Sequence[int], leaves: np.ndarray) -> np.ndarray:
        """The raw score of rows after a change of some columns, to the last bit; ``leaves`` are theirs before, and only trees that split on the columns are asked."""
        only, out = set(self.using(columns)), np.full(len(new), self.base)
        for t in range(len(self.feature)):
            out += self.given(new, t) if t in only else leaves[t]
        return out

    def change(self, x: np.ndarray, new: np.ndarray, columns: Sequence[int]) -> np.ndarray:
        """By how much the raw score of rows changes when some columns do."""
        return self.anew(new, columns, self.leaves(x)) - self.raw(x)


def thresholds(x: np.ndarray) -> np.ndarray:
    """Cuts between the distinct values, or between 255 quantiles if there are more."""
    distinct = np.unique(x)
    if len(distinct) <= BINS:
        return (distinct[:-1] + distinct[1:]) / 2
    return np.unique(np.percentile(x, np.linspace(0, 100, BINS + 1)[1:-1], method="midpoint"))


class Splits:
    """Where the sums of a node lie in its matrix: all its rows, the bins of columns, then the set rows of columns of two bins."""

    def __init__(self, wide: Sequence[int], two: Sequence[int]):
        self.cells = len(wide) * (BINS + 1)
        self.feature = np.append(np.repeat(np.array(wide, int), BINS + 1), np.array(two, int))
        self.last = np.append(np.tile(np.arange(BINS + 1), len(wide)), np.zeros(len(two), int))

    def best_split(self, sums: np.ndarray, l2: float, least_rows: int) -> tuple[float, int, int, np.ndarray]:
        """(gain, feature, last bin of the left side, its totals); the first of equals, gain 0 for none."""
        whole = sums[:, :1]
        wide = sums[:, 1 : 1 + self.cells].reshape(3, -1, BINS + 1).cumsum(axis=2).reshape(3, -1)
        left = np.concatenate([wide, whole - sums[:, 1 + self.cells :]], axis=1)
        right = whole - left
        fine = (left[2] >= least_rows) & (right[2] >= least_rows) & (left[1] >= LEAST_HESSIAN) & (right[1] >= LEAST_HESSIAN)
        all_ = whole[0] ** 2 / (whole[1] + l2 + 1e-15)
        gain = left[0] ** 2 / (left[1] + l2 + 1e-15) + right[0] ** 2 / (right[1] + l2 + 1e-15) - all_
        gain = np.where(fine, gain, 0.0)
        best = gain.max(initial=0.0)
        if best <= 0:
            return 0.0, -1, -1, np.zeros(3)
        equal = np.flatnonzero((gain > 0) & (gain >= best - TIE * (best + float(all_[0]))))
        at = equal[np.lexsort((self.last[equal], self.feature[equal]))[0]]
        return float(gain[at]), int(self.feature[at]), int(self.last[at]), left[:, at].copy()


class Bins(Splits):
    """Columns of codes made ready, once for all trees, for sums of gradients, Hessians and rows by feature and bin.

    Columns that are equal to an earlier one, or of one bin, are left out, as the first of equals is split.
    Columns of two bins, as indicators and levels are, share a count with others that are never set with them.
    """

    def __init__(self, codes: np.ndarray):
        self.codes, first = np.asfortranarray(codes), {}
        for f in range(codes.shape[1]):
            if self.codes[:, f].any():
                first.setdefault(self.codes[:, f].tobytes(), f)
        top = codes.max(axis=0, initial=0).astype(int)
        wide, two = ([f for f in first.values() if (top[f] > 1) == many] for many in (True, False))
        super().__init__(wide, two)
        # (codes, number of codes, first code that counts, places of the sums)
        columns = [(self.codes[:, f], int(top[f]) + 1, 0, 1 + i * (BINS + 1) + np.arange(top[f] + 1)) for i, f in enumerate(wide)]
        set_ = self.codes[:, two].astype(np.float32)
        meet = set_.T @ set_ > 0
        bundles: list[list[int]] = []
        for i in range(len(two)):
            free = next((b for b in bundles if not meet[i, b].any()), None)
            bundles.append([i]) if free is None else free.append(i)
        for b in bundles:
            columns.append((set_[:, b] @ np.arange(1, len(b) + 1), len(b) + 1, 1, 1 + self.cells + np.array(b)))
        # Columns are counted jointly, as many as give ``JOINT`` cells; each one's sums are the margins.
        groups: list[list] = []
        for c in sorted(columns, key=lambda c: -c[1]):
            free = next((g for g in groups if c[1] * math.prod(x[1] for x in g) <= JOINT), None)
            groups.append([c]) if free is None else free.append(c)
        self.joint = []
        for g in groups:
            sizes = [x[1] for x in g]
            self.joint.append((np.ravel_multi_index([x[0].astype(np.intp) for x in g], sizes), sizes, [x[2:] for x in g]))

    def of(self, g: np.ndarray, h: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The sums of a node's rows, or of all."""
        g, h = (g, h) if rows is None else (g[rows], h[rows])
        out = np.zeros((3, 1 + len(self.feature)))
        out[:, 0] = g.sum(), h.sum(), len(g)
        for column, sizes, places in self.joint:
            at = column if rows is None else column[rows]
            for k, w in enumerate((g, h, None)):
                found = np.bincount(at, w, math.prod(sizes)).reshape(sizes)
                for axis, (first, to) in enumerate(places):
                    out[k, to] = found.sum(axis=tuple(i for i in range(len(sizes)) if i != axis))[first:]
        return out


def grow(bins: Bins, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, rate: float, depth: int | None, least_rows: int, l2: float):
    """(tree as columns feature, threshold, left, right, value; rows of its leaves): the best leaf is split first."""
    tree, members, waiting = [], {}, []

    def add(rows: np.ndarray, sums: np.ndarray, level: int) -> int:
        n = len(tree)
        tree.append([-1, 0.0, -1, -1, -rate * sums[0, 0] / (sums[1, 0] + l2 + 1e-15)])
        members[n] = rows
        gain, feature, last, _ = bins.best_split(sums, l2, least_rows) if may_split(rows, level) else (0.0, -1, -1, None)
        if gain > 0:
            heapq.heappush(waiting, (-gain, n, feature, last, level, sums))
        return n

    def may_split(rows: np.ndarray, level: int) -> bool:
        return (depth is None or level < depth) and len(rows) >= 2 * least_rows

    add(np.arange(len(g)), bins.of(g, h), 0)
    leaves = 1
    while waiting and leaves < LEAVES:
        _, n, feature, last, level, sums = heapq.heappop(waiting)
        rows = members.pop(n)
        goes = bins.codes[rows, feature] <= last
        sides = rows[goes], rows[~goes]
        small = int(len(sides[1]) < len(sides[0]))  # the other side is what remains
        if any(may_split(side, level + 1) for side in sides):
            part = bins.of(g, h, sides[small])
        else:  # leaves need their totals only
            part = np.zeros_like(sums)
            part[:, 0] = g[sides[small]].sum(), h[sides[small]].sum(), len(sides[small])
        both = (part, sums - part) if small == 0 else (sums - part, part)
        tree[n][:2] = feature, float(cuts[feature][last])
        tree[n][2], tree[n][3] = (add(side, x, level + 1) for side, x in zip(sides, both))
        leaves += 1
    return tree, members


def boost(columns: Iterable[np.ndarray], y: np.ndarray, w: np.ndarray, rate: float, rounds: int, depth: int | None, least_rows: int, l2: float, seed: int, held: np.ndarray | None = None) -> Trees:
    """Trees for 0/1 labels and weights, classes balanced; logistic loss.

    Above 10,000 rows a tenth of each class is held out, and boosting ends when its loss
    has not improved for 10 rounds.  The order of the rows matters for that draw only; ``held`` gives the rows instead.
    """
    y, w = y.astype(float), w.astype(float)
    ones = y.sum()
    w = w * np.where(y == 1, len(y) / (2 * max(ones, 1)), len(y) / (2 * max(len(y) - ones, 1)))
    out = np.zeros(len(y), bool) if held is None else held
    if held is None and len(y) > STOPPING_ROWS:
        for label in (0.0, 1.0):
            at = np.random.default_rng([seed, int(label)]).permutation(np.flatnonzero(y == label))
            out[at[: round(HELD_OUT * len(at))]] = True
    cuts, found = [], []
    for x in columns:  # one at a time: codes take an eighth of the room
        cuts.append(thresholds(x[~out]))
        found.append(np.searchsorted(cuts[-1], x).astype(np.uint8))
    codes = np.stack(found, axis=1) if found else np.zeros((len(y), 0), np.uint8)
    del found
    codes_held, y_held, w_held = codes[out], y[out], w[out]
    codes, y, w = codes[~out], y[~out], w[~out]
    mean = np.clip((w * y).sum() / max(w.sum(), 1e-300), 1e-15, 1 - 1e-15)
    base = float(np.log(mean / (1 - mean)))
    raw, raw_held = np.full(len(y), base), np.full(len(y_held), base)
    bins = Bins(codes)
    loss = lambda: float((w_held * (np.logaddexp(0, raw_held) - y_held * raw_held)).sum() / w_held.sum())
    losses, trees = [loss()] if out.any() else [], []
    for _ in range(rounds):
        p = sigmoid(raw)
        tree, members = grow(bins, cuts, w * (p - y), w * p * (1 - p), rate, depth, least_rows, l2)
        trees.append(tree)
        for n, rows in members.items():
            raw[rows] += tree[n][4]
        if losses:
            raw_held += _binned(tree, codes_held, cuts)
            losses.append(loss())
            if len(losses) > PATIENCE and min(losses[-PATIENCE:]) >= losses[-PATIENCE - 1] - STOPPING_TOL:
                break
    size = max((len(t) for t in trees), default=1)
    packed = np.zeros((5, len(trees), size))
    packed[0] = -1
    for i, tree in enumerate(trees):
        packed[:, i, : len(tree)] = np.array(tree).T
    return Trees(base, packed[0].astype(int), packed[1], packed[2].astype(int), packed[3].astype(int), packed[4])


def _binned(tree: list, codes: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The values a tree gives rows of bins."""
    out, at = np.zeros(len(codes)), [(0, np.arange(len(codes)))]
    while at:
        n, rows = at.pop()
        feature, cut, left, right, value = tree[n]
        if feature < 0:
            out[rows] = value
        else:
            goes = codes[rows, feature] <= np.searchsorted(cuts[feature], cut)
            at += [(left, rows[goes]), (right, rows[~goes])]
    return out


def by_job(rows: DataFrame, jobs: int) -> DataFrame:
    """``rows`` in a partition for each job; hashes of a few numbers would meet."""
    return rows.repartitionById(jobs, F.col("job"))


def fit_trees(rows: DataFrame, encoders: Sequence[Encoder], jobs: Sequence[Job], vocabulary, rate: float, rounds: int, depth: int | None, least_rows: int, l2: float, seed: int) -> list[Trees]:
    """Boosted trees of every job, each on all of its training rows.

    Up to 200,000 of them meet in one task, no two jobs in the same, and jobs are fitted side by side.  Beyond that no
    task holds them: rows stay in blocks, and all jobs share the passes over these.
    """
    if max((e.rows for e in encoders), default=0) > TASK_ROWS:
        from .boosting_passes import fit_in_passes

        return fit_in_passes(rows, encoders, jobs, vocabulary, rate, rounds, depth, least_rows, l2, seed)
    table = F.array(*[F.struct(F.lit(j).alias("job"), F.lit(r).alias("r"), F.lit(k).alias("k")) for j, (r, k) in enumerate(jobs)])
    mine = F.filter(table, lambda x: F.element_at("_folds", x["r"] + 1) != x["k"])
    dealt = rows.select("_r", "_num", "_cat", "_y", "_w", F.explode(F.transform(mine, lambda x: x["job"])).alias("job"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_r", ignore_index=True)
        encoder = encoders[int(pdf["job"].iloc[0])]
        num, cat = (np.stack(pdf[c].to_numpy()).reshape(len(pdf), -1) for c in ("_num", "_cat"))
        found = boost(encoder.each(num, cat, vocabulary), pdf["_y"].to_numpy(), pdf["_w"].to_numpy(), rate, rounds, depth, least_rows, l2, seed)
        packed = np.stack([found.feature, found.threshold, found.left, found.right, found.value])
        return pd.DataFrame({"job": pdf["job"].iloc[:1], "base": [found.base], "trees": [packed.shape[1]], "packed": [packed.tobytes()]})

    got = {}
    for row in by_job(dealt, len(jobs)).groupBy("job").applyInPandas(fit, "job int, base double, trees int, packed binary").collect():
        f, t, left, right, v = np.frombuffer(row.packed).reshape(5, row.trees, -1)
        got[row.job] = Trees(row.base, f.astype(int), t, left.astype(int), right.astype(int), v)
    none = Trees(0.0, *[np.zeros((0, 1), kind) for kind in (int, float, int, int, float)])
    return [got.get(j, none) for j in range(len(jobs))]
