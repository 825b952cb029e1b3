"""Gradient boosting of training sets of any size: passes over blocks of binned rows, which the trees of all jobs share."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import running_sums
from ..sources.shared import discard, stored
from .boosting import BINS, HELD_OUT, PATIENCE, STOPPING_ROWS, STOPPING_TOL, LEAVES, Splits, Trees, landing
from .encode import Encoder, Job, arrays
from .linear import sigmoid

BLOCK_ROWS = 131_072  # of a block at most
SHARED = 1 << 13  # cells that columns of a block are counted in at once
ROUNDS_KEPT = 8  # trees of a job that a pass adds to the scores of its block before these are written anew


def greatest_within(cut: np.ndarray, mean: float, scale: float) -> np.ndarray:
    """The greatest numbers that are at most ``cut`` once they are standardised, by halving the range of doubles."""
    flip = lambda i: np.where(i < 0, np.iinfo(np.int64).min - i, i)  # noqa: E731  doubles in their order, as integers, and back
    low, high = (np.full(len(cut), flip(np.array([x]).view(np.int64))[0]) for x in (-np.finfo(float).max, np.finfo(float).max))
    with np.errstate(over="ignore"):
        for _ in range(64):
            middle = (low >> 1) + (high >> 1) + (low & high & 1)
            within = (flip(middle).view(np.float64) - mean) / scale <= cut
            low, high = np.where(within, middle, low), np.where(within, high, middle)
    return flip(low).view(np.float64)


def marked(rows: DataFrame, encoders: Sequence[Encoder], jobs: Sequence[Job], seed: int) -> DataFrame:
    """``rows`` with _kept and _held, for each job whether its trees are grown on the row, or judged by it.

    A job of more than 10,000 rows holds a tenth of them out, by a hash of the row's number; no other row of a job is left out.
    """
    mine = [F.col("_folds")[r] != k for r, k in jobs]
    out = F.pmod(F.xxhash64(F.lit(seed), "_r"), F.lit(round(1 / HELD_OUT))) == 0
    held = [m & out & F.lit(e.rows > STOPPING_ROWS) for m, e in zip(mine, encoders)]
    return rows.withColumns({"_held": F.array(*held), "_kept": F.array(*[m & ~h for m, h in zip(mine, held)])})


def job_cuts(rows: DataFrame, encoders: Sequence[Encoder]) -> dict[tuple[int, int], np.ndarray]:
    """(job, number of a numeric column) -> ``thresholds`` of its standardised values over all rows that the job keeps.

    Equal values are counted first; only the order statistics that cuts lie between meet in a task, at most some
    hundreds for each job.
    """
    jobs, columns = range(len(encoders)), encoders[0].numeric
    tall = rows.select("_kept", F.posexplode("_num").alias("feature", "value"))
    counts = stored(tall.groupBy("feature", "value").agg(*[F.count(F.when(F.col("_kept")[j], 1)).alias(f"c{j}") for j in jobs]), "counts")
    filled = []  # a missing value counts as the job's median
    for row in counts.where("value IS NULL").collect():
        filled += [(row.feature, float(e.stats[columns[row.feature]][0]), *[row[f"c{j}"] if i == j else 0 for i in jobs]) for j, e in enumerate(encoders)]
    every = counts.where("value IS NOT NULL").unionByName(rows.sparkSession.createDataFrame(filled, counts.schema))
    every = every.groupBy("feature", "value").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in jobs])
    every = every.withColumns({f"one{j}": (F.col(f"c{j}") > 0).cast("long") for j in jobs})
    placed = running_sums(every, ["feature"], [F.col("value")], {f"lo{j}": f"c{j}" for j in jobs} | {f"d{j}": f"one{j}" for j in jobs})
    needed = F.lit(False)
    for j in jobs:
        step = BINS / F.greatest(F.col(f"lo{j}_all") - 1, F.lit(1))
        first = F.greatest(F.lit(1), F.ceil((F.col(f"lo{j}") - 1) * step - 1e-6))
        last = F.least(F.lit(BINS - 1), F.floor((F.col(f"lo{j}") + F.col(f"c{j}")) * step + 1e-6))
        needed = needed | ((F.col(f"c{j}") > 0) & ((F.col(f"d{j}_all") <= BINS) | (first <= last)))
    shares = np.linspace(0, 100, BINS + 1)[1:-1] / 100

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, out = pdf.sort_values("value", ignore_index=True), []
        feature = int(pdf["feature"].iloc[0])
        for j, e in enumerate(encoders):
            mine = pdf[pdf[f"c{j}"] > 0]
            _, _, mean, scale = e.stats[columns[feature]]
            x = (mine["value"].to_numpy() - mean) / scale
            if not len(mine):
                cuts = np.zeros(0)
            elif mine[f"d{j}_all"].iloc[0] <= BINS:
                x = np.unique(x)
                cuts = (x[:-1] + x[1:]) / 2
            else:
                place = (mine[f"lo{j}_all"].iloc[0] - 1) * shares
                a, b = (x[np.searchsorted(mine[f"lo{j}"].to_numpy(), at(place), side="right") - 1] for at in (np.floor, np.ceil))
                cuts = np.unique(b - (b - a) * 0.5)
            out.append((feature, j, cuts.tobytes()))
        return pd.DataFrame(out, columns=["feature", "job", "cuts"])

    found = placed.where(needed).groupBy("feature").applyInPandas(cut, "feature int, job int, cuts binary").collect()
    discard(counts)
    return {(row.job, row.feature): np.frombuffer(row.cuts) for row in found}


class Codes:
    """Numbers for the values of the source columns, fine enough for every job's cuts; the last number of a numeric column is for missing.

    Source columns are coded jointly, some at a time; ``groups`` has (columns, their numbers of codes) of each joint code.
    """

    def __init__(self, encoders: Sequence[Encoder], vocabulary: dict[str, dict[str, int]], cuts: dict[tuple[int, int], np.ndarray]):
        self.numeric, self.categorical = encoders[0].numeric, encoders[0].categorical
        self.tops, self.grids = {}, []
        for i, c in enumerate(self.numeric):
            for j, e in enumerate(encoders):
                self.tops[j, i] = greatest_within(cuts.get((j, i), np.zeros(0)), *e.stats[c][2:])
            self.grids.append(np.unique(np.concatenate([self.tops[j, i] for j in range(len(encoders))])))
        self.sizes = [len(g) + 2 for g in self.grids] + [len(vocabulary[c]) + 1 for c in self.categorical]
        self.first = np.cumsum([0, *self.sizes])  # cell of each column's first code, where all are laid side by side
        groups: list[list[int]] = []
        for s in sorted(range(len(self.sizes)), key=lambda s: -self.sizes[s]):
            free = next((g for g in groups if self.sizes[s] * math.prod(self.sizes[x] for x in g) <= SHARED), None)
            groups.append([s]) if free is None else free.append(s)
        self.groups = [(g, [self.sizes[s] for s in g]) for g in groups]
        self.kind = np.min_scalar_type(max((math.prod(sizes) for _, sizes in self.groups), default=1) - 1)
        # (joint code, column's code for each joint code) of a column
        self.member = {s: (i, np.unravel_index(np.arange(math.prod(sizes)), sizes)[k]) for i, (g, sizes) in enumerate(self.groups) for k, s in enumerate(g)}

    def joint(self, num: np.ndarray, cat: np.ndarray) -> np.ndarray:
        """groups x rows: the joint codes."""
        found = [np.where(np.isnan(x := num[:, i]), len(grid) + 1, np.searchsorted(grid, x)) for i, grid in enumerate(self.grids)]
        found += [cat[:, i] + 1 for i in range(len(self.categorical))]
        out = np.zeros((len(self.groups), len(num)), self.kind)
        for i, (g, sizes) in enumerate(self.groups):
            out[i] = np.ravel_multi_index([found[s].astype(np.intp) for s in g], sizes)
        return out

    def sums(self, joint: list[np.ndarray]) -> np.ndarray:
        """sums x cells: the sums by columns' codes of those by joint codes (each sums x joint codes)."""
        out = np.zeros((len(joint[0]) if joint else 0, self.first[-1]))
        for found, (g, sizes) in zip(joint, self.groups):
            found = found.reshape(-1, *sizes)
            for k, s in enumerate(g):
                out[:, self.first[s] : self.first[s + 1]] = found.sum(axis=tuple(1 + i for i in range(len(sizes)) if i != k))
        return out


class JobColumns(Splits):
    """The encoded columns of a job as functions of the shared codes.

    Sums of a node travel without the bins that no value falls into; ``place`` puts them where ``best_split`` looks for them.
    """

    def __init__(self, job: int, encoder: Encoder, vocabulary: dict[str, dict[str, int]], codes: Codes, cuts: dict[tuple[int, int], np.ndarray]):
        self.source, self.bin, self.cuts = [], [], []  # of each encoded column: source column, bin of each of its codes, cuts
        sources, targets, place, wide, two = [], [], [np.zeros(1, int)], [], []
        parts = list(encoder.parts())
        for _, c, kind, detail in parts:
            numeric = kind in ("value", "missing")
            s = codes.numeric.index(c) if numeric else len(codes.numeric) + codes.categorical.index(c)
            code = np.arange(codes.sizes[s])
            if kind == "value":
                own, grid = cuts.get((job, s), np.zeros(0)), codes.grids[s]
                at = np.searchsorted(np.searchsorted(grid, codes.tops[job, s]), code)
                at[-1] = np.searchsorted(own, (detail[0] - detail[2]) / detail[3])
            elif kind == "missing":
                at, own = code == code[-1], np.array([((0 - detail[0]) / detail[1] + (1 - detail[0]) / detail[1]) / 2])
            else:
                known = [vocabulary[c][v] + 1 for v in ([detail] if kind == "level" else detail)]
                at, own = np.isin(code, known) == (kind == "level"), np.array([0.5])
            self.source.append(s)
            self.bin.append(np.asarray(at).astype(np.uint8))
            self.cuts.append(own)
        wide = [f for f, (_, _, kind, _) in enumerate(parts) if kind == "value"]
        two = [f for f, (_, _, kind, _) in enumerate(parts) if kind != "value"]
        super().__init__(wide, two)
        n = 1
        for i, f in enumerate(wide):
            sources.append(codes.first[self.source[f]] + np.arange(len(self.bin[f])))
            targets.append(n + self.bin[f].astype(int))
            place.append(1 + i * (BINS + 1) + np.arange(len(self.cuts[f]) + 1))
            n += len(self.cuts[f]) + 1
        for i, f in enumerate(two):
            set_ = np.flatnonzero(self.bin[f])
            sources.append(codes.first[self.source[f]] + set_)
            targets.append(np.full(len(set_), n))
            place.append(np.array([1 + self.cells + i]))
            n += 1
        self.sources, self.targets, self.place = (np.concatenate([np.zeros(0, int), *x]) for x in (sources, targets, place))

    def of(self, cells: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """The sums of a node, as they travel, from those by the columns' codes."""
        out = np.zeros((len(whole), len(self.place)))
        for i, x in enumerate(cells):
            out[i] = np.bincount(self.targets, x[self.sources], len(self.place))
        out[:, 0] = whole
        return out

    def full(self, sums: np.ndarray) -> np.ndarray:
        out = np.zeros((3, 1 + len(self.feature)))
        out[:, self.place] = sums
        return out


@dataclass
class Block:
    """Rows of all jobs: joint codes (groups x rows), labels, weights, and for each job (jobs x rows) which it keeps and holds out, and their raw scores."""

    joint: np.ndarray
    y: np.ndarray
    w: np.ndarray
    kept: np.ndarray
    held: np.ndarray
    raw: np.ndarray


@dataclass
class Shared:
    """What all passes need to know of the jobs."""

    codes: Codes
    columns: list[JobColumns]
    factors: np.ndarray  # jobs x classes: weight of each class

    def goes(self, block: Block, job: int, feature: int, last: int) -> np.ndarray:
        """Which rows lie left of a cut."""
        own = self.columns[job]
        group, code = self.codes.member[own.source[feature]]
        return (own.bin[feature] <= last)[code][block.joint[group]]

    def nodes(self, block: Block, job: int, tree: np.ndarray) -> np.ndarray:
        """The node of a tree (nodes x feature, last bin, left, right, value), finished or not, that each row comes to."""
        feature, last, left, right = tree[:, :4].astype(int).T
        if reached := landing(feature, left, right):
            split, to = reached
            code = np.zeros(len(block.y), np.uint8)
            for k, n in enumerate(split):
                code |= self.goes(block, job, feature[n], last[n]).view(np.uint8) << k
            return to[code]
        at = np.zeros(len(block.y), int)
        for n in np.flatnonzero(feature >= 0):
            at = np.where(at == n, np.where(self.goes(block, job, feature[n], last[n]), left[n], right[n]), at)
        return at

    def gradients(self, block: Block, job: int, raw: np.ndarray, judge: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """(gradient, Hessian of each row, with ``judge`` the loss and weight of the rows held out, if there are any)."""
        w, loss = block.w * self.factors[job][block.y], None
        if judge and len(out := np.flatnonzero(block.held[job])):
            loss = np.array([(w[out] * (np.logaddexp(0, raw[out]) - block.y[out] * raw[out])).sum(), w[out].sum()])
        p = sigmoid(raw)
        return w * (p - block.y), w * p * (1 - p), loss

    def raw(self, block: Block, job: int, trees: Sequence[np.ndarray]) -> np.ndarray:
        """Scores after more trees."""
        out = block.raw[job].copy()
        for tree in trees:
            out += tree[self.nodes(block, job, tree), 4]
        return out


def make_blocks(rows: DataFrame, codes: Codes, jobs: int, base: np.ndarray, total: int):
    """The rows as an RDD of blocks, one in a task; tasks are a multiple of the cores there are."""
    cores = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    tasks = cores * max(1, -(-total // (cores * BLOCK_ROWS)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            num, cat, y, w, kept, held = arrays(batch, "_num", "_cat", "_y", "_w", "_kept", "_held")
            shape = (len(y), -1)
            found.append((codes.joint(num.reshape(shape) if num.size else num, cat), y.astype(np.uint8), w.astype(float), kept.reshape(shape).T.astype(bool), held.reshape(shape).T.astype(bool)))
        if found:
            whole = [np.concatenate(x, axis=-1) for x in zip(*found)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in whole], ["joint", "y", "w", "kept", "held"])

    def unpack(row) -> Block:
        y = np.frombuffer(row.y, np.uint8)
        wide = lambda x, kind: np.frombuffer(x, kind).reshape(-1, len(y))
        return Block(wide(row.joint, codes.kind), y, np.frombuffer(row.w), wide(row.kept, bool), wide(row.held, bool), np.repeat(base[:, None], len(y), axis=1))

    dealt = rows.select("_num", "_cat", "_y", "_w", "_kept", "_held", "_r").repartitionById(tasks, F.pmod("_r", F.lit(tasks)).cast("int"))
    packed = dealt.mapInArrow(pack, "joint binary, y binary, w binary, kept binary, held binary")
    return packed.rdd.map(unpack)


def fit_in_passes(rows: DataFrame, encoders: Sequence[Encoder], jobs: Sequence[Job], vocabulary, rate: float, rounds: int, depth: int | None, least_rows: int, l2: float, seed: int) -> list[Trees]:
    """The trees of ``boosting.boost`` for every job, on all of its rows, wherever these lie.

    A row is coded once for all jobs.  A pass over the blocks gives, for each job, the sums of gradients, Hessians and rows by column and bin of
    the nodes that are next; the driver picks the splits.  Only the smaller child of a split is counted, and the leaves' totals
    follow from the sums of the node above: a tree of depth 3 takes three passes.  A pass returns some
    (encoded columns x bins) numbers a node, whatever the rows.
    """
    spark = rows.sparkSession
    rows = marked(rows, encoders, jobs, seed)
    per_job = []
    for j, (r, k) in enumerate(jobs):
        for y in (0, 1):
            per_job += [F.count(F.when((F.col("_folds")[r] != k) & (F.col("_y") == y), 1)), F.sum(F.when(F.col("_kept")[j] & (F.col("_y") == y), F.col("_w")))]
    total, *found = rows.agg(F.count("*"), *per_job).first()
    found = np.array([x or 0 for x in found], float).reshape(len(jobs), 2, 2)
    n, weight = found[:, :, 0], found[:, :, 1]
    factors = n.sum(axis=1, keepdims=True) / (2 * np.maximum(n, 1))
    weight = weight * factors
    mean = np.clip(weight[:, 1] / np.maximum(weight.sum(axis=1), 1e-300), 1e-15, 1 - 1e-15)
    base = np.log(mean / (1 - mean))

    cuts = job_cuts(rows, encoders) if encoders[0].numeric else {}
    codes = Codes(encoders, vocabulary, cuts)
    columns = [JobColumns(j, e, vocabulary, codes, cuts) for j, e in enumerate(encoders)]
    shared = spark.sparkContext.broadcast(Shared(codes, columns, factors))
    blocks = make_blocks(rows, codes, len(jobs), base, total).persist(StorageLevel.MEMORY_AND_DISK)

    def add_up(of, nodes: int) -> dict[tuple[int, int], np.ndarray]:
        return dict(blocks.flatMap(of).reduceByKey(np.add, max(1, nodes // 4)).collect())

    def roots(wanted: dict[int, list[np.ndarray]], rows_too: bool) -> dict[tuple[int, int], np.ndarray]:
        """Sums of all rows kept, by (job, 0), and, by (job, -1), the loss and the weight of those held out; ``wanted`` has each job's trees since the scores of the blocks.

        Rows are the same in every round: they are counted with ``rows_too`` only.
        """
        def of(block: Block) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
            s, found = shared.value, {}
            for j, trees in wanted.items():
                raw = s.raw(block, j, trees)
                g, h, loss = s.gradients(block, j, raw, True)
                if loss is not None:
                    yield (j, -1), loss
                found[j] = [g * block.kept[j], h * block.kept[j], *([block.kept[j].astype(float)] if rows_too else [])]
            joint: dict[int, list[np.ndarray]] = {j: [] for j in wanted}
            for code, (_, sizes) in zip(block.joint, s.codes.groups):
                here, cells = code.astype(np.intp), math.prod(sizes)
                for j, weights in found.items():
                    joint[j].append(np.stack([np.bincount(here, x, cells) for x in weights]))
            for j, weights in found.items():
                yield (j, 0), s.columns[j].of(s.codes.sums(joint[j]), np.array([x.sum() for x in weights]))

        return add_up(of, len(wanted))

    def count(wanted: dict[int, tuple[list[np.ndarray], np.ndarray, list[int]]]) -> dict[tuple[int, int], np.ndarray]:
        """Sums of the nodes wanted, by (job, node); ``wanted`` also has the tree that is growing and its nodes to count, for each job."""
        def of(block: Block) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
            s = shared.value
            for j, (trees, tree, nodes) in wanted.items():
                at = s.nodes(block, j, tree)
                g, h, _ = s.gradients(block, j, s.raw(block, j, trees), False)
                for node in nodes:
                    mine = np.flatnonzero(block.kept[j] & (at == node))
                    own, joint = (g[mine], h[mine]), []
                    for code, (_, sizes) in zip(block.joint, s.codes.groups):
                        here, cells = code[mine].astype(np.intp), math.prod(sizes)
                        joint.append(np.stack([np.bincount(here, own[0], cells), np.bincount(here, own[1], cells), np.bincount(here, minlength=cells)]))
                    yield (j, node), s.columns[j].of(s.codes.sums(joint), np.array([own[0].sum(), own[1].sum(), len(mine)]))

        return add_up(of, sum(len(nodes) for _, _, nodes in wanted.values()))

    done: list[list[np.ndarray]] = [[] for _ in jobs]
    losses: list[list[float]] = [[] for _ in jobs]
    open_, written = list(range(len(jobs))), 0
    old = None
    for turn in range(rounds):
        found = roots({j: done[j][written:] for j in open_}, turn == 0)
        if old is not None:  # the new scores are there
            old.unpersist()
            old = None
        for j in list(open_):
            if (j, -1) in found:
                loss, held = found[j, -1]
                losses[j].append(float(loss / held))
                if len(losses[j]) > PATIENCE and min(losses[j][-PATIENCE:]) >= losses[j][-PATIENCE - 1] - STOPPING_TOL:
                    open_.remove(j)
        if turn == 0:
            kept = {j: found[j, 0][2] for j in open_}
        growing = {j: Growing(columns[j], columns[j].full(np.vstack([found[j, 0][:2], kept[j]])), rate, depth, least_rows, l2) for j in open_}
        while wanted := {j: (done[j][written:], t.table(), nodes) for j, t in growing.items() if (nodes := t.split())}:
            for (j, node), sums in count(wanted).items():
                growing[j].counted(node, columns[j].full(sums))
        for j, t in growing.items():
            done[j].append(t.table())
        if not open_:
            break
        if turn + 1 - written == ROUNDS_KEPT and turn + 1 < rounds:
            new = spark.sparkContext.broadcast({j: done[j][written:] for j in open_})
            old, blocks = blocks, blocks.map(_scorer(shared, new)).persist(StorageLevel.MEMORY_AND_DISK)
            written = turn + 1
    for x in (old, blocks):
        if x is not None:
            x.unpersist()
    return [_trees(float(base[j]), done[j], columns[j].cuts) if n[j].sum() else Trees(0.0, *[np.zeros((0, 1), t) for t in (int, float, int, int, float)]) for j in range(len(jobs))]


def _scorer(shared, new):
    """Gives a block the scores after the trees of the broadcast ``new``."""
    def after(block: Block) -> Block:
        raw = block.raw.copy()
        for j, trees in new.value.items():
            raw[j] = shared.value.raw(block, j, trees)
        return Block(block.joint, block.y, block.w, block.kept, block.held, raw)

    return after


class Growing:
    """A tree that grows by the sums of its nodes."""

    def __init__(self, columns: JobColumns, sums: np.ndarray, rate: float, depth: int | None, least_rows: int, l2: float):
        self.columns, self.rate, self.depth, self.least_rows, self.l2 = columns, rate, depth, least_rows, l2
        self.tree: list[list[float]] = []
        self.waiting: list[tuple] = []  # (-gain, node, feature, last bin, totals of the left side, level, sums) of leaves that can be split
        self.due: dict[int, tuple] = {}  # node to count -> (its sibling, sums of both together, level)
        self._counted(self._leaf(sums[:, 0]), sums, 0)

    def table(self) -> np.ndarray:
        return np.array(self.tree)

    def _leaf(self, whole: np.ndarray) -> int:
        self.tree.append([-1, -1, -1, -1, -self.rate * whole[0] / (whole[1] + self.l2 + 1e-15)])
        return len(self.tree) - 1

    def _may_split(self, rows: float, level: int) -> bool:
        return (self.depth is None or level < self.depth) and rows >= 2 * self.least_rows

    def _counted(self, node: int, sums: np.ndarray, level: int) -> None:
        if self._may_split(sums[2, 0], level):
            gain, feature, last, left = self.columns.best_split(sums, self.l2, self.least_rows)
            if gain > 0:
                self.waiting.append((-gain, node, feature, last, left, level, sums))

    def counted(self, node: int, sums: np.ndarray) -> None:
        other, both, level = self.due.pop(node)
        self._counted(node, sums, level)
        self._counted(other, both - sums, level)

    def split(self) -> list[int]:
        """Splits leaves, the best first, and returns the nodes to count before more can be: all that can be split where the bound of leaves can't be met, else one."""
        while self.waiting and not self.due:
            leaves = sum(n[0] < 0 for n in self.tree)
            if leaves >= LEAVES:
                break
            self.waiting.sort(key=lambda x: x[:2])
            far = leaves - len(self.waiting) + sum(LEAVES if self.depth is None else 2 ** min(self.depth - x[5], 31) for x in self.waiting)
            several = len(self.waiting) if far <= LEAVES else 1
            chosen, self.waiting = self.waiting[:several], self.waiting[several:]
            for _, n, feature, last, left, level, sums in chosen:
                sides = left, sums[:, 0] - left
                nodes = [self._leaf(x) for x in sides]
                self.tree[n][:4] = feature, last, *nodes
                if any(self._may_split(x[2], level + 1) for x in sides):
                    small = int(sides[1][2] < sides[0][2])
                    self.due[nodes[small]] = nodes[1 - small], sums, level + 1
        return list(self.due)


def _trees(base: float, tables: list[np.ndarray], cuts: list[np.ndarray]) -> Trees:
    packed = np.zeros((5, len(tables), max((len(t) for t in tables), default=1)))
    packed[0] = -1
    for i, table in enumerate(tables):
        packed[:, i, : len(table)] = table.T
        for n in np.flatnonzero(table[:, 0] >= 0):
            packed[1, i, n] = cuts[int(table[n, 0])][int(table[n, 1])]
        packed[1, i, : len(table)][table[:, 0] < 0] = 0.0
    return Trees(base, packed[0].astype(int), packed[1], packed[2].astype(int), packed[3].astype(int), packed[4])
