"""Scoring: kept grids and fitted models applied to histories without outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Prep
from ..operators.features import build_features
from ..operators.percentiles import apply_percentiles
from ..sources.raw import split_outcomes
from .modelling import Fold, scored


def scoring_features(raw: DataFrame, grid: DataFrame, cfg: Prep) -> DataFrame:
    """A feature row for each customer without an outcome, as of the last acquisition, ranked by a kept grid."""
    acquired, outcomes = split_outcomes(raw, cfg)
    c = cfg.columns
    converted = outcomes.where(F.col(c.date).isNotNull()).select(F.col(c.id).alias("customer")).distinct()
    last = acquired.where(F.col(c.id).isNotNull()).groupBy(F.col(c.id).alias("customer")).agg(F.max(c.date).alias("anchor_date"), F.count("*").alias("n"))
    last = last.where((F.col("n") >= cfg.min_acquisitions) & F.col("anchor_date").isNotNull()).join(converted, "customer", "left_anti")
    return build_features(apply_percentiles(acquired, grid, cfg), last, cfg)


def score(features: DataFrame, folds: list[Fold], id_col: str = "customer", bins: int | None = None) -> DataFrame:
    """id, score: the mean over the folds' models; with ``bins``, 1 - prod(1 - hazard) over intervals 1..bins first."""
    rows = features if bins is None else features.withColumn("interval", F.explode(F.sequence(F.lit(1), F.lit(bins))).cast("string"))
    keys = [id_col] if bins is None else [id_col, "interval"]
    every = scored(rows, folds, keys).withColumnRenamed("model", "_f")
    if bins is not None:
        every = every.groupBy(id_col, "_f").agg((1 - F.product(1 - F.col("score"))).alias("score"))
    return every.groupBy(id_col).agg(F.avg("score").alias("score"))
