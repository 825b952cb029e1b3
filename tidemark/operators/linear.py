"""Elastic-net logistic regression of many training sets at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .encode import Basis, Encoder, Job, arrays, pieces

PASS_ROWS = 2_048  # encoded at once
TASKS_A_SUM = 64  # whose sums one task adds up before the rest meet


@dataclass
class Linear:
    coefficients: np.ndarray
    intercept: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.coefficients + self.intercept

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))

    def uses(self, columns: Sequence[int]) -> bool:
        return bool(self.coefficients[list(columns)].any())

    def leaves(self, x: np.ndarray) -> None:
        """Nothing that ``anew`` could reuse."""

    def anew(self, new: np.ndarray, columns: Sequence[int], leaves: None) -> np.ndarray:
        """The raw score of rows after a change of some columns."""
        return self.raw(new)

    def change(self, x: np.ndarray, new: np.ndarray, columns: Sequence[int]) -> np.ndarray:
        """By how much the raw score of rows changes when some columns do."""
        at = list(columns)
        return (new[:, at] - x[:, at]) @ self.coefficients[at]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def pass_sums(rows: DataFrame, encoders: Sequence[Encoder], jobs: Sequence[Job], vocabulary, factors, at: np.ndarray) -> np.ndarray:
    """[loss, gradient, Hessian] of each job's training rows at its row of ``at`` (intercept first), in one pass over ``rows``.

    A row is encoded once, in a basis that every job's columns are linear in, and the sums over the basis give each job's.
    A task adds up its rows for every job, some at a time; the sums of tasks meet in two steps.  A sum has
    (columns of the basis + 1) ** 2 numbers, whatever the rows.
    """
    basis = Basis(encoders, vocabulary)
    maps = [basis.of(e) for e in encoders]
    width, weights = basis.width, np.stack([m @ b[: m.shape[1]] for m, b in zip(maps, at)], axis=1)
    by_label = np.array(factors)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(jobs), 1 + width + width * width))
        for batch in pieces(batches, PASS_ROWS):
            num, cat, folds, y, w = arrays(batch, "_num", "_cat", "_folds", "_y", "_w")
            z = basis.matrix(num, cat)
            eta = z @ weights
            p, t = sigmoid(eta), y[:, None]
            mine = np.stack([folds[:, repeat] != fold for repeat, fold in jobs], axis=1)
            each = np.where(mine, w[:, None] * by_label[:, (y == 1).astype(int)].T, 0.0)
            total[:, 0] += (each * (np.logaddexp(0, eta) - t * eta)).sum(axis=0)
            total[:, 1 : 1 + width] += (z.T @ (each * (p - t))).T
            for j, root in enumerate(np.sqrt(each * p * (1 - p)).T):
                part = z * root[:, None]
                total[j, 1 + width :] += (part.T @ part).ravel()
        task = TaskContext.get().partitionId()
        columns = [range(len(jobs)), [task // TASKS_A_SUM] * len(jobs), [task] * len(jobs)]
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in columns], pa.array([t.tobytes() for t in total], pa.binary())], ["job", "bucket", "task", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("task")
        total = np.zeros(1 + width + width * width)
        for part in pdf["sums"]:
            total += np.frombuffer(part)
        return pdf.iloc[:1].assign(sums=total.tobytes())

    found = rows.select("_num", "_cat", "_folds", "_y", "_w").mapInArrow(sums, "job int, bucket int, task int, sums binary")
    found = found.groupBy("job", "bucket").applyInPandas(add, found.schema).groupBy("job").applyInPandas(add, found.schema)
    n = at.shape[1]
    out = np.zeros((len(jobs), 1 + n + n * n))
    for row in found.collect():
        total, own = np.frombuffer(row.sums), maps[row.job]
        k = own.shape[1]
        out[row.job, 0] = total[0]
        out[row.job, 1 : 1 + k] = own.T @ total[1 : 1 + width]
        out[row.job, 1 + n :].reshape(n, n)[:k, :k] = own.T @ total[1 + width :].reshape(width, width) @ own
    return out


def penalised(g: np.ndarray, b: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """How far each coordinate is from stationary: 0 where the subgradient of loss and penalty holds 0."""
    smooth = g + l2 * b
    return np.where(b != 0, np.abs(smooth + l1 * np.sign(b)), np.maximum(0.0, np.abs(smooth) - l1))


def quadratic_minimum(q: np.ndarray, h: np.ndarray, l1: np.ndarray, x: np.ndarray, steps: int = 5000) -> np.ndarray:
    """The minimum of x h x / 2 + q x + l1 |x| from a start, by its signs.

    The free coordinates are solved for with their signs held.  On the way there, those
    that pass zero may stop at it, wherever the value is least.  Once the free ones are
    stationary, the coordinate furthest from being so is let in.
    """
    x, goal = x.copy(), 1e-10 * (1 + np.abs(q).max())
    h = h + np.eye(len(q)) * (1e-12 * max(1e-300, h.diagonal().max()))
    for _ in range(steps):
        grad, sign = h @ x + q, np.sign(x)
        free = (x != 0) | (l1 == 0)
        off = np.where(free, np.abs(grad + l1 * sign), np.maximum(np.abs(grad) - l1, 0.0))
        if off.max() <= goal:
            break
        if off[free].max(initial=0.0) <= goal:
            j = int(off.argmax())
            free[j], sign[j] = True, -np.sign(grad[j])
        at = np.flatnonzero(free)
        move = -x
        move[at] += np.linalg.solve(h[np.ix_(at, at)], -(q + l1 * sign)[at])
        cross = np.flatnonzero((x * (x + move) < 0) & (l1 > 0))
        times = np.append(-x[cross] / move[cross], 1.0)
        path = x + times[:, None] * move
        path[np.arange(len(cross)), cross] = 0.0
        value = times**2 * (move @ h @ move) / 2 + times * (move @ grad) + np.abs(path) @ l1
        new = path[value.argmin()]
        if np.array_equal(new, x):
            break
        x = new
    return x


def newton_step(g: np.ndarray, h: np.ndarray, b: np.ndarray, l1: np.ndarray, l2: np.ndarray) -> np.ndarray:
    """The minimum of each job's quadratic model plus penalty."""
    return np.stack([quadratic_minimum(gj - hj @ bj, hj + np.diag(l2), l1, bj) for gj, hj, bj in zip(g, h, b)])


def fit_linear(rows: DataFrame, encoders: Sequence[Encoder], jobs: Sequence[Job], vocabulary, factors, c: float, l1_ratio: float, tol: float, passes: int) -> list[Linear]:
    """The minimum of c * weighted loss + (1 - l1_ratio) / 2 * |b|^2 + l1_ratio * |b| of every job; the intercept is not penalised.

    Proximal Newton: one pass over ``rows`` gives loss, gradient and Hessian of all jobs, the
    driver solves the small quadratic problems, and a step that does not lower the objective is halved.  A job is done
    when no coordinate is further than ``tol`` times the larger penalty from stationary;
    a handful of passes is enough, and no more than ``passes`` are made.
    """
    sizes = [len(e.names()) for e in encoders]
    width = 1 + max(sizes, default=0)
    l1, l2 = np.full(width, l1_ratio), np.full(width, 1 - l1_ratio)
    l1[0] = l2[0] = 0.0
    penalty = lambda b: (l1 * np.abs(b)).sum(axis=1) + (l2 * b * b).sum(axis=1) / 2
    best, goal = np.zeros((len(jobs), width)), None
    value = np.full(len(jobs), np.inf)
    g, h = np.zeros_like(best), np.zeros((len(jobs), width, width))
    trial = best.copy()
    for _ in range(passes):
        found = pass_sums(rows, encoders, jobs, vocabulary, factors, trial) * c
        now = found[:, 0] + penalty(trial)
        better = now <= value
        best[better], value[better] = trial[better], now[better]
        g[better], h[better] = found[better, 1 : 1 + width], found[better, 1 + width :].reshape(-1, width, width)
        if goal is None:
            goal = np.maximum(tol * max(l1_ratio, 1 - l1_ratio), 1e-10 * np.abs(g).max(axis=1))
        open_ = penalised(g, best, l1, l2).max(axis=1) > goal
        if not open_.any():
            break
        step = best.copy()
        step[open_] = newton_step(g[open_], h[open_], best[open_], l1, l2)
        trial = np.where((open_ & ~better)[:, None], (best + trial) / 2, step)
        stuck = np.abs(trial - best).max(axis=1) <= 1e-12 * (1 + np.abs(best).max(axis=1))
        if (stuck | ~open_).all():
            break
    return [Linear(b[1 : 1 + n].copy(), float(b[0])) for b, n in zip(best, sizes)]
