"""From interval hazards to customer scores, and measures of their ranking and calibration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.exprs import quantiles, running_sums
from ..sources.shared import stored

STEP = np.dtype([("score", "<f8"), ("n", "<u2"), ("p", "<u2")])  # a score of a batch, its rows and events
STEPS = "repeat int, range int, n long, p long, steps binary"


def survival_scores(predictions: DataFrame, id_col: str, label: str, bins: int) -> DataFrame:
    """repeat, id, score = 1 - prod(1 - hazard) over the intervals of the horizon, actual.

    Without an event inside the horizon, customers not seen to its end are left out.
    """
    inside = predictions.where(F.col("interval").cast("int") <= bins)
    out = inside.groupBy("repeat", id_col).agg(
        (1 - F.product(1 - F.col("score"))).alias("score"), F.max(F.col(label).cast("int")).alias("actual"),
        F.max(F.col("interval").cast("int")).alias("_seen"))
    return out.where((F.col("actual") == 1) | (F.col("_seen") >= bins)).drop("_seen")


def lift_name(fraction: float) -> str:
    return f"lift_top_{int(fraction * 100)}%"


def ranking_metrics(scores: DataFrame, id_col: str, lift_at: Sequence[float]) -> DataFrame:
    """A row for each repeat with an event: n_customers, n_events, prevalence, pr_auc, roc_auc, brier and the lifts.

    Ties are exact: equal scores form one step of both curves.  Lift takes the first
    max(1, round(n * fraction)) by score, ties by id.  Running sums go over ranges
    of score and id, so a repeat of any size is ranked without meeting in one task, even if all scores tie.
    """
    a = F.col("actual").cast("long")
    steps = scores.groupBy("repeat", "score").agg(F.sum(a).alias("p"), F.count("*").alias("k"), F.sum(F.pow(F.col("score") - a, F.lit(2.0))).alias("b"))
    steps = running_sums(steps, ["repeat"], [F.col("score").desc()], {"tp": "p", "seen": "k"})
    tp, seen = F.col("tp") + F.col("p"), F.col("seen") + F.col("k")
    positives, n = F.col("tp_all"), F.col("seen_all")
    out = steps.where(positives > 0).groupBy("repeat").agg(
        F.first(n).alias("n_customers"), F.first(positives).alias("n_events"), F.first(positives / n).alias("prevalence"),
        F.sum(F.col("p") * tp / seen / positives).alias("pr_auc"),
        F.when(F.first(n) > F.first(positives), F.sum((F.col("k") - F.col("p")) * (tp - F.col("p") / 2)) / F.first(positives) / F.first(n - positives)).alias("roc_auc"),
        (F.sum("b") / F.first(n)).alias("brier"))
    if lift_at:
        ranked = running_sums(scores.withColumn("_1", F.lit(1)), ["repeat"], [F.col("score").desc(), F.col(id_col)], {"at": "_1"})
        top = lambda f: F.greatest(F.lit(1), F.bround(F.col("at_all") * F.lit(f)).cast("long"))
        hit = lambda f: F.avg(F.when(F.col("at") < top(f), a))
        lifts = ranked.groupBy("repeat").agg(*[(hit(f) / F.avg(a)).alias(lift_name(f)) for f in dict.fromkeys(lift_at)])
        out = out.join(lifts, "repeat")
    return out


def packed_steps(repeat: int, score: np.ndarray, actual: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
    """Rows of ``STEPS``: the scores of a batch of less than 2**16 rows, the highest first, in a row for each range between ``bounds``, which rise."""
    order = np.argsort(-score)
    score, actual = score[order], actual[order]
    first = np.flatnonzero(np.append(True, score[1:] != score[:-1])[: len(score)])
    steps = np.zeros(len(first), STEP)
    if len(first):
        steps["score"], steps["n"], steps["p"] = score[first], np.diff(np.append(first, len(score))), np.add.reduceat(actual.astype(int), first)
    ranges = len(bounds) - np.searchsorted(bounds, steps["score"], side="right")
    ends = np.searchsorted(ranges, np.arange(len(bounds) + 2))
    for r in np.flatnonzero(np.diff(ends)):
        part = steps[ends[r] : ends[r + 1]]
        yield repeat, int(r), int(part["n"].sum()), int(part["p"].sum()), part.tobytes()


def packed_precision(packed: DataFrame) -> dict[int, float]:
    """The pr_auc of ``ranking_metrics`` of each repeat with an event, from scores in rows of ``STEPS``.

    Scores travel packed and meet by repeat and range, so a task holds one range of one
    repeat; the totals of the ranges above it come from the counts of the rows alone.
    """
    packed = stored(packed, "steps")
    totals = packed.groupBy("repeat", "range").agg(F.sum("n").alias("_n"), F.sum("p").alias("_p"))
    within = W.partitionBy("repeat")
    before = within.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        "repeat", "range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("seen"), F.coalesce(F.sum("_p").over(before), F.lit(0)).alias("tp"),
        F.sum("_p").over(within).alias("positives"))

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        steps = np.concatenate([np.frombuffer(x, STEP) for x in pdf["steps"]])
        steps = steps[np.argsort(-steps["score"])]
        last = np.flatnonzero(np.append(steps["score"][1:] != steps["score"][:-1], True))
        seen, tp = (np.cumsum(steps[c], dtype=np.int64)[last] for c in ("n", "p"))
        p = np.diff(tp, prepend=0)
        area = (p * ((tp + pdf["tp"].iloc[0]) / (seen + pdf["seen"].iloc[0]))).sum() / pdf["positives"].iloc[0]
        return pd.DataFrame({"repeat": pdf["repeat"].iloc[:1], "area": [float(area)]})

    rows = packed.select("repeat", "range", "steps").join(F.broadcast(totals.where("positives > 0")), ["repeat", "range"])
    found = rows.groupBy("repeat", "range").applyInPandas(part, "repeat int, area double").groupBy("repeat").agg(F.sum("area").alias("area")).collect()
    return {r.repeat: r.area for r in found}


def summary(by_repeat: DataFrame) -> DataFrame:
    """metric, mean, std (of a sample), min, max over the repeats."""
    names = [c for c in by_repeat.columns if c != "repeat"]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("value")) for c in names])
    rows = by_repeat.select(F.explode(pairs).alias("m")).groupBy(F.col("m.metric").alias("metric"))
    v = F.col("m.value")
    return rows.agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))


def calibration(scores: DataFrame, bins: int) -> DataFrame:
    """bin, n, mean_predicted, observed_rate over quantile bins of all scores; empty if all scores are equal.

    The bins + 1 edges come to the driver.
    """
    found = quantiles(scores, [], "score", [k / bins for k in range(bins + 1)]).first()
    edges = sorted(set(found.edges)) if found else []
    array = F.array(*[F.lit(float(e)) for e in edges]) if len(edges) > 1 else F.array().cast("array<double>")
    place: Column = F.greatest(F.size(F.filter(array, lambda e: e < F.col("score"))) - 1, F.lit(0))
    rows = scores.where(F.lit(len(edges) > 1)).groupBy(place.alias("bin"))
    return rows.agg(F.count("*").alias("n"), F.avg("score").alias("mean_predicted"), F.avg("actual").alias("observed_rate"))


def coefficient_stability(coefs: DataFrame) -> DataFrame:
    """feature, mean_coef, std_coef (of the population), sign_consistency, nonzero_rate over rows of (repeat, fold, feature, coef).

    The dominant sign is the more frequent one, + on a tie; a zero is not consistent.
    """
    mean = coefs.groupBy("feature").agg(F.avg("coef").alias("mean_coef"), F.sum(F.signum("coef")).alias("_signs"))
    sign = F.when(F.col("_signs") >= 0, 1.0).otherwise(-1.0)
    rows = coefs.join(mean, "feature").groupBy("feature")
    return rows.agg(
        F.first("mean_coef").alias("mean_coef"), F.stddev_pop("coef").alias("std_coef"),
        F.avg((F.signum("coef") == sign).cast("double")).alias("sign_consistency"),
        F.avg((F.col("coef") != 0).cast("double")).alias("nonzero_rate"))
