"""Imputation, scaling and one-hot encoding, fitted on training rows only."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import quantiles, running_sums
from ..sources.shared import stored

MISSING, INFREQUENT = "MISSING", "__infrequent__"


def column_roles(df: DataFrame, reserved, force_categorical=()) -> tuple[list[str], list[str], list[str]]:
    """(numeric, categorical, skipped) columns by type: numbers and booleans, text, everything else; forced ones are categorical."""
    numeric, categorical, skipped = [], [], []
    for f in df.schema:
        if f.name in force_categorical:
            categorical.append(f.name)
        elif f.name in reserved:
            continue
        elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            numeric.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        else:
            skipped.append(f.name)
    return numeric, categorical, skipped


def _tall(df: DataFrame, numeric: list[str]) -> DataFrame:
    """feature, value: one row for each numeric cell."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in numeric])
    return df.select(F.explode(cells).alias("x")).select("x.*")


def imputation_scaling(df: DataFrame, numeric: list[str]) -> DataFrame:
    """feature, median, n_missing, mean, scale of the imputed values (population deviation; 1 where it is 0).

    Medians are exact: the mean of the two middle order statistics.
    """
    tall = _tall(df, numeric)
    middle = quantiles(tall, ["feature"], "value", [0.5]).select("feature", F.col("edges")[0].alias("median"))
    moments = tall.groupBy("feature").agg(
        F.count("*").alias("n"), F.count("value").alias("k"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("s"),
        F.coalesce(F.avg("value"), F.lit(0.0)).alias("m"), F.coalesce(F.var_pop("value"), F.lit(0.0)).alias("v"))
    rows = moments.join(middle, "feature", "left")
    fill = F.coalesce("median", F.lit(0.0))  # a column without any value is imputed as 0
    n, k, lost = F.col("n"), F.col("k"), F.col("n") - F.col("k")
    mean = (F.col("s") + lost * fill) / n
    variance = (k * (F.col("v") + F.pow(F.col("m") - mean, F.lit(2.0))) + lost * F.pow(fill - mean, F.lit(2.0))) / n
    deviation = F.sqrt(variance)
    return rows.select("feature", fill.alias("median"), lost.alias("n_missing"), mean.alias("mean"), F.when(deviation > 0, deviation).otherwise(1.0).alias("scale"))


def category_levels(df: DataFrame, categorical: list[str], least: float) -> DataFrame:
    """feature, level, n, frequent: the levels of each categorical column; those under ``least`` of the rows are pooled."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("level")) for c in categorical])
    rows = df.select(F.explode(cells).alias("x")).groupBy("x.feature", "x.level").agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("_total"))
    return rows.join(F.broadcast(total)).select("feature", "level", "n", (F.col("n") >= F.lit(least) * F.col("_total")).alias("frequent"))


def indicator_scaling(share: float) -> tuple[float, float]:
    """(mean, scale) of a missing-value indicator: of a 0/1 column with that share of ones, 1 where it is constant."""
    return share, (share * (1 - share)) ** 0.5 or 1.0


@dataclass
class Encoder:
    """Fitted encodings, as column expressions and over arrays; their number follows the columns and frequent levels.

    Numeric columns are imputed by the median and standardised, then come standardised
    indicators of the values that were missing, then a column for each frequent level and one for
    the pooled ones.  A numeric column without any training value gives its indicator only.
    An unknown level counts as pooled if there was such a level, else as none.
    """

    numeric: list[str]
    categorical: list[str]
    stats: dict[str, tuple[float, int, float, float]] = field(default_factory=dict)  # median, missing, mean, scale
    levels: dict[str, tuple[list[str], bool]] = field(default_factory=dict)
    indicators: bool = True
    rows: int = 0  # fitted on

    @classmethod
    def fit(cls, df: DataFrame, numeric: list[str], categorical: list[str], least: float, indicators: bool = True) -> Encoder:
        """Fitted on all rows of ``df``."""
        return fold_encoders(df.withColumn("_folds", F.array(F.lit(0))), numeric, categorical, least, [(0, -1)], 1, indicators)[0]

    def parts(self) -> Iterator[tuple[str, str, str, object]]:
        """(name, source column, kind, detail) of the encoded columns in order."""
        for c in self.numeric:
            if self.stats[c][1] < self.rows:
                yield c, c, "value", self.stats[c]
        for c in self.numeric if self.indicators else []:
            if missing := self.stats[c][1]:
                yield f"missing_{c}", c, "missing", indicator_scaling(missing / self.rows)
        for c in self.categorical:
            levels, rare = self.levels[c]
            for level in levels:
                yield f"{c}={level}", c, "level", level
            if rare:
                yield f"{c}={INFREQUENT}", c, "pooled", levels

    def names(self) -> list[str]:
        return [name for name, *_ in self.parts()]

    def columns(self) -> dict[str, Column]:
        """Name -> encoded column."""
        out: dict[str, Column] = {}
        for name, c, kind, detail in self.parts():
            if kind == "value":
                median, _, mean, scale = detail
                out[name] = (F.coalesce(number(c), F.lit(median)) - mean) / scale
            elif kind == "missing":
                out[name] = (number(c).isNull().cast("double") - detail[0]) / detail[1]
            elif kind == "level":
                out[name] = (level_of(c) == detail).cast("double")
            else:
                out[name] = (~level_of(c).isin(detail) if detail else F.lit(True)).cast("double")
        return out

    def each(self, num: np.ndarray, cat: np.ndarray, vocabulary: dict[str, dict[str, int]], source: str | None = None) -> Iterator[np.ndarray]:
        """The encoded columns of rows as ``coded`` gives them, one at a time; with ``source``, those of that column."""
        for _, c, kind, detail in self.parts():
            if source not in (None, c):
                continue
            if kind in ("value", "missing"):
                x = num[:, self.numeric.index(c)]
                empty = np.isnan(x)
                yield (np.where(empty, detail[0], x) - detail[2]) / detail[3] if kind == "value" else (empty - detail[0]) / detail[1]
            else:
                x, known = cat[:, self.categorical.index(c)], vocabulary[c]
                yield (x == known[detail]).astype(float) if kind == "level" else (~np.isin(x, [known[v] for v in detail])).astype(float)

    def matrix(self, num: np.ndarray, cat: np.ndarray, vocabulary: dict[str, dict[str, int]], source: str | None = None) -> np.ndarray:
        found = list(self.each(num, cat, vocabulary, source))
        return np.column_stack(found) if found else np.zeros((len(num), 0))

    def transform(self, df: DataFrame, vector: str = "_features") -> DataFrame:
        """``df`` with an array of the encoded columns."""
        return df.withColumn(vector, F.array(*self.columns().values()).cast("array<double>"))


def number(c: str) -> Column:
    """A numeric column as a double, NaN as null."""
    value = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(value), value)


def level_of(c: str) -> Column:
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING))


def vocabulary_of(encoders: Sequence[Encoder]) -> dict[str, dict[str, int]]:
    """For each categorical column, numbers of the levels that some encoder knows."""
    names = encoders[0].categorical if encoders else []
    return {c: {v: i for i, v in enumerate(sorted({v for e in encoders for v in e.levels[c][0]}))} for c in names}


def coded(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], vocabulary: dict[str, dict[str, int]]) -> DataFrame:
    """``df`` with _num (the numeric columns, null if missing) and _cat (the number of the level, -1 for one that no encoder knows).

    It serves all encoders at once: each one's matrix follows from the two arrays within a task.
    """
    def at(c: str) -> Column:
        known = vocabulary[c]
        table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv]) if known else F.create_map().cast("map<string,int>")
        return F.coalesce(F.element_at(table, level_of(c)), F.lit(-1))

    num = F.array(*map(number, numeric)).cast("array<double>")
    return df.withColumns({"_num": num, "_cat": F.array(*map(at, categorical)).cast("array<int>")})


class Basis:
    """Columns that the encoded columns of all ``encoders`` are linear in, so that one matrix of a row serves them all.

    A constant, each numeric column (standardised as the first encoder with a value has it, 0 if missing), whether it
    is missing, and one for each level that some encoder knows.
    """

    def __init__(self, encoders: Sequence[Encoder], vocabulary: dict[str, dict[str, int]]):
        first = encoders[0]
        self.numeric, self.categorical, self.vocabulary = first.numeric, first.categorical, vocabulary
        with_value = lambda c: next((e.stats[c] for e in encoders if e.stats[c][1] < e.rows), (0.0, 0, 0.0, 1.0))
        self.scales = {c: with_value(c)[2:] for c in self.numeric}
        self.places, n = {}, 1
        for c in self.numeric:
            self.places[c] = n
            n += 2
        for c in self.categorical:
            self.places[c] = n
            n += len(vocabulary[c])
        self.width = n

    def matrix(self, num: np.ndarray, cat: np.ndarray) -> np.ndarray:
        out = np.zeros((len(num), self.width))
        out[:, 0] = 1.0
        for i, c in enumerate(self.numeric):
            empty, at = np.isnan(num[:, i]), self.places[c]
            mean, scale = self.scales[c]
            out[:, at] = np.where(empty, 0.0, (num[:, i] - mean) / scale)
            out[:, at + 1] = empty
        for i, c in enumerate(self.categorical):
            rows = np.flatnonzero(cat[:, i] >= 0)
            out[rows, self.places[c] + cat[rows, i]] = 1.0
        return out

    def of(self, encoder: Encoder) -> np.ndarray:
        """basis x (1 + encoded columns): the constant, then each of the encoder's columns, from the basis."""
        parts = list(encoder.parts())
        out = np.zeros((self.width, 1 + len(parts)))
        out[0, 0] = 1.0
        for j, (_, c, kind, detail) in enumerate(parts, 1):
            at = self.places[c]
            if kind == "value":
                median, _, mean, scale = detail
                m, s = self.scales[c]
                out[[0, at, at + 1], j] = (m - mean) / scale, s / scale, (median - m) / scale
            elif kind == "missing":
                out[[0, at + 1], j] = -detail[0] / detail[1], 1 / detail[1]
            elif kind == "level":
                out[at + self.vocabulary[c][detail], j] = 1.0
            else:
                out[0, j] = 1.0
                out[[at + self.vocabulary[c][v] for v in detail], j] = -1.0
        return out


def arrays(batch: pa.RecordBatch | pa.Table, *names: str) -> list[np.ndarray]:
    """Columns of equally long lists as matrices, others as vectors; null numbers are NaN."""
    out = []
    for name in names:
        column = batch.column(batch.schema.get_field_index(name))
        if pa.types.is_list(column.type):
            out.append(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1 if len(column) and len(column.flatten()) else 0))
        else:
            out.append(column.to_numpy(zero_copy_only=False))
    return out


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows`` at most, so that the matrices of one are small whatever comes."""
    for batch in batches:
        for i in range(0, len(batch), rows):
            yield batch.slice(i, rows)


Job = tuple[int, int]  # (repeat, fold): the model of the rows whose _folds[repeat] is another


def fold_encoders(df: DataFrame, numeric: list[str], categorical: list[str], least: float, jobs: Sequence[Job], splits: int, indicators: bool = True) -> list[Encoder]:
    """The encoders of all ``jobs``, fitted in passes that they share.

    ``df`` has _folds, the fold of the row in every repeat.  Counts, moments and running
    counts are kept for each (repeat, fold); what a job trains on is the sum over the other folds, so rows
    are neither repeated for the jobs nor read again for them.  Medians are exact.
    """
    lanes = [(r, k) for r in sorted({r for r, _ in jobs}) for k in range(splits)]
    used = {job: [i for i, (r, k) in enumerate(lanes) if r == job[0] and k != job[1]] for job in jobs}
    hit = [F.col("_folds")[r] == k for r, k in lanes]
    totals = df.agg(*[F.count(F.when(h, 1)) for h in hit]).first()
    out = [Encoder(numeric, categorical, indicators=indicators, rows=sum(totals[i] for i in used[job])) for job in jobs]
    if numeric:
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), number(c).alias("value")) for c in numeric])
        tall = df.select("_folds", F.explode(cells).alias("x")).select("_folds", "x.*").where("value IS NOT NULL")
        moments = tall.groupBy("feature").agg(*[
            f(F.when(h, F.col("value"))).alias(f"{n}{i}") for i, h in enumerate(hit) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))])
        moments = {row.feature: row for row in moments.collect()}
        counts = tall.groupBy("feature", "value").agg(*[F.count(F.when(h, 1)).alias(f"_c{i}") for i, h in enumerate(hit)])
        placed = running_sums(counts, ["feature"], [F.col("value")], {f"_lo{i}": f"_c{i}" for i in range(len(lanes))})
        of = lambda job, stem, tail="": sum((F.col(f"{stem}{i}{tail}") for i in used[job]), F.lit(0))
        middle = []
        for j, job in enumerate(jobs):
            lo, n = of(job, "_lo"), of(job, "_lo", "_all")
            for name, place in ((f"a{j}", F.floor((n - 1) / 2)), (f"b{j}", F.floor(n / 2))):
                middle.append(F.max(F.when((place >= lo) & (place < lo + of(job, "_c")), F.col("value"))).alias(name))
        medians = {row.feature: row for row in placed.groupBy("feature").agg(*middle).collect()}
        for j, job in enumerate(jobs):
            for c in numeric:
                m, found = moments.get(c), medians.get(c)
                parts = [(m[f"n{i}"], m[f"m{i}"], m[f"v{i}"]) for i in used[job] if m[f"n{i}"]] if m else []
                low, high = (found[f"a{j}"], found[f"b{j}"]) if found else (None, None)
                out[j].stats[c] = imputed_moments(out[j].rows, parts, 0.0 if low is None else high - (high - low) * 0.5)
    if categorical:
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), level_of(c).alias("level")) for c in categorical])
        levels = df.select("_folds", F.explode(cells).alias("x")).groupBy("x.feature", "x.level")
        levels = levels.agg(*[F.count(F.when(h, 1)).alias(f"_c{i}") for i, h in enumerate(hit)])
        n = [sum((F.col(f"_c{i}") for i in used[job]), F.lit(0)) for job in jobs]
        often = [n[j] >= F.lit(least) * out[j].rows for j in range(len(jobs))]
        levels = stored(levels.select("feature", "level", *[(o & (x > 0)).alias(f"often{j}") for j, (o, x) in enumerate(zip(often, n))], *[(~o & (x > 0)).alias(f"rare{j}") for j, (o, x) in enumerate(zip(often, n))]), "levels")
        # At most 1 / least levels of a column are frequent in a job, so what comes to the driver is bounded.
        frequent = levels.where(" OR ".join(f"often{j}" for j in range(len(jobs)))).collect()
        rare = {row.feature: row for row in levels.groupBy("feature").agg(*[F.max(f"rare{j}").alias(f"rare{j}") for j in range(len(jobs))]).collect()}
        for j in range(len(jobs)):
            out[j].levels = {c: (sorted(r.level for r in frequent if r.feature == c and r[f"often{j}"]), bool(c in rare and rare[c][f"rare{j}"])) for c in categorical}
    return out


def imputed_moments(rows: int, parts: Sequence[tuple[int, float, float]], median: float) -> tuple[float, int, float, float]:
    """(median, missing, mean, scale) from the (count, mean, population variance) of parts; missing values count as the median."""
    parts = [*parts, (rows - sum(n for n, _, _ in parts), median, 0.0)]
    mean = sum(n * m for n, m, _ in parts) / max(1, rows)
    variance = sum(n * (v + (m - mean) ** 2) for n, m, v in parts) / max(1, rows)
    return median, parts[-1][0], mean, variance**0.5 or 1.0
