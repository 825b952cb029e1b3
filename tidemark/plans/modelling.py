"""Cross-validated models on the datasets: out-of-fold scores, measures, calibration, feature reports.

All folds of all repeats share their passes: one coded table holds the rows with their
fold in every repeat, and encoders, models and scores of all folds come from it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..config import Model, load_yaml, model_config
from ..operators import metrics
from ..operators.boosting import Trees, fit_trees
from ..operators.encode import Encoder, Job, arrays, coded, column_roles, fold_encoders, pieces, vocabulary_of
from ..operators.linear import Linear, fit_linear, sigmoid
from ..operators.sampling import downsample_negatives, group_folds
from ..sources.raw import read_model_input, require
from ..sources.shared import ship, stored


SHARD_ROWS = 20_000  # among which values are dealt anew
ASKED_ROWS = 8_192  # scored at once for all columns
RANGE_ROWS = 250_000  # scores of a repeat that are ranked in one task


@dataclass
class Fold:
    """A fitted model and its encoder; ``repeat`` and ``fold`` name the rows it has not seen, fold -1 none."""

    repeat: int
    fold: int
    encoder: Encoder
    model: Linear | Trees

    @property
    def names(self) -> list[str]:
        return self.encoder.names()


def load(df: DataFrame, cfg: Model) -> DataFrame:
    """Labelled rows with roles checked, the label as int and forced categories as text."""
    require(df, [cfg.id, cfg.group, cfg.label, cfg.weight], "model input")
    df = df.where(F.col(cfg.label).isNotNull()).withColumn(cfg.label, F.col(cfg.label).cast("int"))
    return df.withColumns({c: F.col(c).cast("string") for c in cfg.force_categorical if c in df.columns})


def fit_jobs(df: DataFrame, numeric: list[str], categorical: list[str], cfg: Model, jobs: Sequence[Job], splits: int) -> tuple[DataFrame, list[Fold]]:
    """(coded rows, a fitted model for each job) of rows with _folds and _sample_weight, in passes that all jobs share."""
    encoders = fold_encoders(df, numeric, categorical, cfg.min_category_frequency, jobs, splits, cfg.add_missing_indicators)
    vocabulary = vocabulary_of(encoders)
    weight = F.col("_sample_weight") * (F.coalesce(F.col(cfg.weight).cast("double"), F.lit(0.0)) if cfg.weight else F.lit(1.0))
    rows = coded(df, numeric, categorical, vocabulary).select(
        *_carried(df, cfg), "_folds", "_num", "_cat", F.col(cfg.label).cast("int").alias("_y"), weight.alias("_w"), F.monotonically_increasing_id().alias("_r"))
    rows = stored(rows, "coded")
    if cfg.type == "gbm":
        models: Sequence[Linear | Trees] = fit_trees(
            _asked_for(rows, encoders, cfg), encoders, jobs, vocabulary, cfg.gbm_learning_rate, cfg.gbm_max_iter, cfg.gbm_max_depth, cfg.gbm_min_samples_leaf,
            cfg.gbm_l2_regularization, cfg.random_state)
    else:
        models = fit_linear(rows, encoders, jobs, vocabulary, class_factors(rows, jobs), cfg.c_grid[-1], cfg.l1_ratio, cfg.tol, cfg.max_iter)
    return rows, [Fold(r, k, e, m) for (r, k), e, m in zip(jobs, encoders, models)]


def _asked_for(rows: DataFrame, encoders: Sequence[Encoder], cfg: Model) -> DataFrame:
    """All rows, unless a configuration names a number of them to fit trees on; then a draw by hash of so many of a fold, by expectation."""
    most = max((e.rows for e in encoders), default=0)
    if cfg.gbm_fit_rows is None or most <= cfg.gbm_fit_rows:
        return rows
    share = int(cfg.gbm_fit_rows / most * (1 << 30))
    return rows.where(F.pmod(F.xxhash64(F.lit(cfg.random_state), "_r"), F.lit(1 << 30)) < share)


def class_factors(rows: DataFrame, jobs: Sequence[Job]) -> list[tuple[float, float]]:
    """(weight of the negatives, of the positives) of each job that balances its classes: rows / (2 * rows of the class)."""
    counts = [F.count(F.when((F.col("_folds")[r] != k) & (F.col("_y") == y), 1)) for r, k in jobs for y in (0, 1)]
    found = list(rows.agg(*counts).first())
    return [((n0 + n1) / (2 * max(n0, 1)), (n0 + n1) / (2 * max(n1, 1))) for n0, n1 in zip(found[::2], found[1::2])]


def fit(df: DataFrame, numeric: list[str], categorical: list[str], cfg: Model) -> Fold:
    """One model on all rows of ``df``, which has _sample_weight."""
    ship(df.sparkSession)
    return fit_jobs(df.withColumn("_folds", F.array(F.lit(0))), numeric, categorical, cfg, [(0, -1)], 1)[1][0]


def _carried(df: DataFrame, cfg: Model) -> list[str]:
    return list(dict.fromkeys([cfg.id, cfg.group, cfg.label, *([cfg.weight] if cfg.weight else []), *(["interval"] if "interval" in df.columns else [])]))


def scores_of(rows: DataFrame, folds: Sequence[Fold], keep: Sequence[str], unseen: bool) -> DataFrame:
    """repeat, model, ``keep``, score: a row of coded ``rows`` for each fold, or with ``unseen`` for those that have not been fitted on it."""
    vocabulary = vocabulary_of([f.encoder for f in folds])
    named = T.StructType([T.StructField("repeat", T.IntegerType()), T.StructField("model", T.IntegerType()), *rows.select(*keep).schema, T.StructField("score", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            num, cat = arrays(batch, "_num", "_cat")
            mine = arrays(batch, "_folds")[0] if unseen else None
            for i, f in enumerate(folds):
                at = np.flatnonzero(mine[:, f.repeat] == f.fold) if unseen else np.arange(len(num))
                found = f.model.predict(f.encoder.matrix(num[at], cat[at], vocabulary))
                own = batch.select(list(keep)).take(pa.array(at))
                whole = [pa.array(np.full(len(at), n, np.int32)) for n in (f.repeat, i)]
                yield pa.RecordBatch.from_arrays([*whole, *own.columns, pa.array(found, pa.float64())], named.names)

    return rows.select(*keep, "_num", "_cat", *(["_folds"] if unseen else [])).mapInArrow(score, named)


def scored(df: DataFrame, folds: Sequence[Fold], keep: Sequence[str]) -> DataFrame:
    """repeat, model, ``keep``, score of raw rows for every fold."""
    ship(df.sparkSession)
    encoder = folds[0].encoder
    rows = coded(df, encoder.numeric, encoder.categorical, vocabulary_of([f.encoder for f in folds]))
    return scores_of(rows, folds, keep, False)


def with_folds(df: DataFrame, cfg: Model, repeats: Sequence[int]) -> DataFrame:
    """``df`` with _folds, the fold of the row's group in each of ``repeats``, null for others; rows without a group go."""
    groups = None
    for r in repeats:
        one = group_folds(df, cfg.group, cfg.label, cfg.n_splits, cfg.random_state + r).select(F.col(cfg.group).alias("_g"), F.col("fold").alias(f"_f{r}"))
        groups = one if groups is None else groups.join(one, "_g")
    groups = groups.select("_g", F.array(*[F.col(f"_f{r}") if r in repeats else F.lit(None).cast("int") for r in range(max(repeats) + 1)]).alias("_folds"))
    return df.join(groups, F.col(cfg.group) == F.col("_g")).drop("_g")


def cross_validate(df: DataFrame, cfg: Model, last_only: bool = False) -> tuple[DataFrame, list[Fold]]:
    """(out-of-fold predictions of every repeat, fitted folds).  ``last_only`` fits the last fold of the last repeat alone."""
    ship(df.sparkSession)
    reserved = {cfg.id, cfg.group, cfg.label, cfg.weight, "_sample_weight", *cfg.drop}
    numeric, categorical, _ = column_roles(df, reserved, cfg.force_categorical)
    jobs = [(r, k) for r in range(cfg.n_repeats) for k in range(cfg.n_splits)][-1 if last_only else 0 :]
    rows = stored(with_folds(df, cfg, sorted({r for r, _ in jobs})), "folds")
    rows, folds = fit_jobs(rows, numeric, categorical, cfg, jobs, cfg.n_splits)
    return scores_of(rows, folds, _carried(df, cfg), True).drop("model"), folds


def customer_scores(predictions: DataFrame, cfg: Model) -> DataFrame:
    if cfg.design == "flat":
        return predictions.select("repeat", cfg.id, "score", F.col(cfg.label).alias("actual"))
    return metrics.survival_scores(predictions, cfg.id, cfg.label, cfg.horizon_bins)


def coefficients(spark: SparkSession, folds: list[Fold]) -> DataFrame:
    """repeat, fold, feature, coef by name: folds may have learned different levels."""
    rows = [(f.repeat, f.fold, n, float(c)) for f in folds for n, c in zip(f.names, f.model.coefficients)]
    return spark.createDataFrame(rows, "repeat int, fold int, feature string, coef double")


def shuffled(df: DataFrame, columns: list[str], seed: int) -> DataFrame:
    """``df`` with _other, a struct of ``columns`` from another row: row places and value places, both by hash, are joined within shards.

    ``df`` has _r, a number for each row, and is stored.
    """
    shards = max(1, -(-df.count() // SHARD_ROWS))
    keyed = df.withColumn("_s", F.pmod(F.xxhash64("_r", F.lit(seed)), F.lit(shards)))
    by = lambda salt: W.partitionBy("_s").orderBy(F.xxhash64("_r", F.lit(salt)), "_r")
    values = keyed.select("_s", F.struct(*columns).alias("_other"), F.row_number().over(by(seed + 1)).alias("_n"))
    return keyed.withColumn("_n", F.row_number().over(by(seed + 2))).join(values, ["_s", "_n"]).drop("_s", "_n")


def permutation_importance(df: DataFrame, fold: Fold, cfg: Model, features: list[str] | None = None) -> DataFrame:
    """feature, mean_importance, std_importance: the loss of average precision when a column is dealt anew, on all rows.

    A repeat deals one order for all columns.  Every (repeat, column) is a group of one pass; its
    scores leave a task packed by ranges, not row by row, and all measures come from one aggregation.  A row is scored once; for a column dealt
    anew, only the trees that split on it, or its coefficients, are asked again, and a
    column that the model doesn't use makes no rows: its loss is 0.
    """
    ship(df.sparkSession)
    encoder, model, spark = fold.encoder, fold.model, df.sparkSession
    names, sources = features or [*encoder.numeric, *encoder.categorical], [c for _, c, *_ in encoder.parts()]
    places = {c: [i for i, x in enumerate(sources) if x == c] for c in names}
    used = [c for c in names if model.uses(places[c])]
    vocabulary = vocabulary_of([encoder])
    rows = coded(df, encoder.numeric, encoder.categorical, vocabulary)
    rows = stored(rows.select(F.col(cfg.label).cast("int").alias("actual"), "_num", "_cat", F.monotonically_increasing_id().alias("_r")), "importance")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ASKED_ROWS):
            num, cat, other, others, turn, actual = arrays(batch, "_num", "_cat", "_num2", "_cat2", "_turn", "actual")
            x = np.asfortranarray(encoder.matrix(num, cat, vocabulary))
            leaves, new, steps = model.leaves(x), x.copy(order="F"), []
            turns = [(int(t), np.flatnonzero(turn == t)) for t in np.unique(turn)]
            for i, c in enumerate(used):
                new[:, places[c]] = encoder.matrix(other, others, vocabulary, c)
                score = sigmoid(model.anew(new, places[c], leaves))
                new[:, places[c]] = x[:, places[c]]
                for t, at in turns:
                    steps += metrics.packed_steps(t * len(used) + i, score[at], actual[at], bounds)
            yield _step_batch(steps)

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ASKED_ROWS):
            num, cat, actual = arrays(batch, "_num", "_cat", "actual")
            yield _step_batch(list(metrics.packed_steps(-1, model.predict(encoder.matrix(num, cat, vocabulary)), actual, bounds)))

    def only_score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, ASKED_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(model.predict(encoder.matrix(*arrays(batch, "_num", "_cat"), vocabulary)), pa.float64())], ["score"])

    # Any bounds give the same result; those of the plain scores make ranges of like sizes.
    ranges = -(-rows.count() // RANGE_ROWS)
    bounds = np.zeros(0)
    if ranges > 1:
        bounds = np.unique(rows.select("_num", "_cat").mapInArrow(only_score, "score double").approxQuantile("score", [k / ranges for k in range(1, ranges)], 0.1 / ranges))
    every = rows.select("_num", "_cat", "actual").mapInArrow(plain, metrics.STEPS)
    if used:
        parts = [shuffled(rows, ["_num", "_cat"], cfg.random_state + 10 * r).withColumn("_turn", F.lit(r)) for r in range(cfg.permutation_repeats)]
        dealt = reduce(DataFrame.unionByName, parts).select("actual", "_num", "_cat", F.col("_other._num").alias("_num2"), F.col("_other._cat").alias("_cat2"), "_turn")
        every = every.unionByName(dealt.mapInArrow(ask, metrics.STEPS))
    found = metrics.packed_precision(every)
    out = []
    for name in names:
        at = used.index(name) if name in used else None
        lost = [0.0 if at is None else found.get(-1, 0.0) - found.get(r * len(used) + at, 0.0) for r in range(cfg.permutation_repeats)]
        mean = sum(lost) / len(lost)
        out.append((name, mean, (sum((x - mean) ** 2 for x in lost) / len(lost)) ** 0.5))
    return spark.createDataFrame(out, "feature string, mean_importance double, std_importance double").orderBy(F.desc("mean_importance"), "feature")


def _step_batch(steps: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    columns = list(zip(*steps)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["repeat", "range", "n", "p", "steps"])


def sampled(df: DataFrame, cfg: Model) -> DataFrame:
    """The modelling rows of a dataset."""
    return stored(downsample_negatives(load(df, cfg), cfg.group, cfg.label, cfg.negative_customer_fraction, cfg.random_state), "modelling")


def importance(df: DataFrame, cfg: Model) -> DataFrame:
    """The features part of ``report`` for boosted trees: every feature of the last fold, which alone is fitted for it."""
    cfg = cfg.checked()
    rows = sampled(df, cfg)
    return permutation_importance(rows, cross_validate(rows, cfg, last_only=True)[1][-1], cfg)


def out_of_fold(df: DataFrame, cfg: Model) -> tuple[DataFrame, DataFrame, list[Fold]]:
    """(scores of the customers in every repeat, the sampled modelling rows, fitted folds) of a dataset."""
    cfg = cfg.checked()
    rows = sampled(df, cfg)
    predictions, folds = cross_validate(rows, cfg)
    return stored(customer_scores(predictions, cfg), "scores"), rows, folds


def report(df: DataFrame, cfg: Model) -> dict[str, DataFrame]:
    """metrics, metrics_by_repeat, calibration, predictions, features of a dataset."""
    scores, rows, folds = out_of_fold(df, cfg)
    by_repeat = metrics.ranking_metrics(scores, cfg.id, cfg.lift_at)
    if cfg.type == "logistic":
        features = metrics.coefficient_stability(coefficients(df.sparkSession, folds)).orderBy(F.desc(F.abs("mean_coef")), "feature")
    else:
        features = permutation_importance(rows, folds[-1], cfg)
    return {
        "metrics": metrics.summary(by_repeat), "metrics_by_repeat": by_repeat, "calibration": metrics.calibration(scores, cfg.calibration_bins),
        "predictions": scores, "features": features}


def run(spark: SparkSession, config_path: str, form: str = "parquet") -> dict[str, dict]:
    """The run of a configuration file: reads a dataset, writes the five reports; returns the size of the input and the mean measures."""
    cfg = model_config(load_yaml(config_path))
    df = read_model_input(spark, cfg.input_path)
    require(df, [cfg.id, cfg.group, cfg.label, cfg.weight], "model input")
    counts = df.agg(F.count(cfg.label).alias("rows"), F.countDistinct(cfg.group).alias("customers"), F.sum(F.col(cfg.label).cast("int")).alias("events"))
    numeric, categorical, _ = column_roles(load(df, cfg), {cfg.id, cfg.group, cfg.label, cfg.weight, *cfg.drop}, cfg.force_categorical)
    sizes = {"input": {"design": cfg.design} | counts.first().asDict() | {"numeric": len(numeric), "categorical": len(categorical)}}
    for name, out in report(df, cfg).items():
        out.write.mode("overwrite").option("header", True).format(form).save(f"{cfg.output_dir}/{name}")
        if name == "metrics":
            sizes[name] = {r.metric: r["mean"] for r in out.collect()}
    return sizes
