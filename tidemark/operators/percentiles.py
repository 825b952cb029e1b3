"""Percentile grids: fitted once, kept, and applied with fallback levels."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Prep
from ..functions.exprs import left_rank, quantiles_of_counts, value_counts

CELL = ["column", "level", "keys"]
COUNTS = "column string, level int, keys array<string>, value double, n long"
GRID = "column string, level int, keys array<string>, n long, edges array<double>"


def _keys(cfg: Prep, level) -> list:
    """The grouping values as text; a null stays null and matches null."""
    named = [F.year(cfg.columns.date) if k == "year" else F.col(k) for k in level]
    return [k.cast("string").alias(f"_g{i}") for i, k in enumerate(named)]


def count_values(acquisitions: DataFrame, cfg: Prep, where=None) -> DataFrame:
    """column, level, keys, value, n: how often each value occurs in every cell of every level.

    Counts of several extracts add up, so grids follow from them without the rows.
    ``where`` can hold them to training rows.
    """
    spark = acquisitions.sparkSession
    grouped = [(name, level, keys) for name, spec in cfg.numerics.items() for level, keys in enumerate(spec.percentile_group or ())]
    if not cfg.percentiles or not grouped:
        return spark.createDataFrame([], COUNTS)
    rows = acquisitions if where is None else acquisitions.where(where)
    # One pass for all columns and levels; values are counted on the map side, so the copies never travel.
    cells = F.array(*[
        F.struct(F.lit(name).alias("column"), F.lit(level).alias("level"), F.array(*_keys(cfg, keys)).alias("keys"), F.col(name).alias("value"))
        for name, level, keys in grouped])
    tall = rows.select(F.explode(cells).alias("x")).select("x.*")
    return value_counts(tall, CELL, "value").withColumnsRenamed({"_v": "value", "_c": "n"})


def merged_counts(*counts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, counts).groupBy(*CELL, "value").agg(F.sum("n").alias("n"))


def grids_of(counts: DataFrame) -> DataFrame:
    """column, level, keys, n, edges[101] of counted values."""
    renamed = counts.withColumnsRenamed({"value": "_v", "n": "_c"})
    return quantiles_of_counts(renamed, CELL, [k / 100 for k in range(101)]).select(*CELL, "n", "edges")


def fit_percentiles(acquisitions: DataFrame, cfg: Prep, where=None) -> DataFrame:
    """column, level, keys, n, edges[101] for every cell of every level; ``where`` can hold the fit to training rows."""
    return grids_of(count_values(acquisitions, cfg, where))


def fingerprint(cfg: Prep) -> str:
    """The settings that decide what a grid means, as text: cells, families and the least size of a cell."""
    levels = {name: [list(level) for level in spec.percentile_group] for name, spec in cfg.numerics.items() if cfg.percentiles and spec.percentile_group}
    return json.dumps({"levels": levels, "families": cfg.families, "default_family": cfg.default_family, "min_cell_size": cfg.min_cell_size}, sort_keys=True)


def apply_percentiles(acquisitions: DataFrame, grid: DataFrame, cfg: Prep, levels: bool = False) -> DataFrame:
    """``<column>_pct`` 0..100 from the first level whose cell held min_cell_size rows at fit time; null without one.

    ``levels`` adds ``<column>_level``, the level used.  The grid is a lookup by equal
    keys; Spark broadcasts it while it is small and shuffles by the keys beyond that.
    """
    out = acquisitions
    if not cfg.percentiles:
        return out
    for name, spec in cfg.numerics.items():
        if not spec.percentile_group:
            continue
        found = []
        for level, keys in enumerate(spec.percentile_group):
            cells = grid.where((F.col("column") == name) & (F.col("level") == level) & (F.col("n") >= cfg.min_cell_size))
            cells = cells.select(*[F.col("keys")[i].alias(f"_k{i}") for i in range(len(keys))], F.col("edges").alias(f"_e{level}"))
            match = [_keys(cfg, keys)[i].eqNullSafe(F.col(f"_k{i}")) for i in range(len(keys))]
            out = out.join(cells, match, "left").drop(*[f"_k{i}" for i in range(len(keys))])
            found.append(f"_e{level}")
        rank = left_rank(F.coalesce(*found), F.col(name))
        out = out.withColumn(f"{name}_pct", rank.cast("double"))
        if levels:
            used = F.coalesce(*[F.when(F.col(e).isNotNull(), F.lit(i)) for i, e in enumerate(found)])
            out = out.withColumn(f"{name}_level", F.when(F.col(name).isNotNull(), used))
        out = out.drop(*found)
    return out
