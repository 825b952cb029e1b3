"""Features from the rows that are visible at the anchor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import LOGGED, Prep
from ..functions.exprs import months, safe_log1p
from ..sources.raw import FAMILY, ROW


def reduced(how: str, value: Column) -> Column:
    """A named aggregate of the non-null values; null when there are none, but for count_nonnull.

    Skewness, excess kurtosis and the standard error are those of a sample: null below 3, 4
    and 2 values, the first two 0 if all are equal.  ``any`` and ``all`` look for values other than 0 and give 0
    or 1.  ``first`` and ``last`` go by the order of the history, from rows numbered by ``visible``.
    """
    n = F.count(value).cast("double")
    if how in ("skew", "kurt", "kurtosis"):
        same = F.var_pop(value) == 0
        if how == "skew":
            return F.when(n >= 3, F.when(same, 0.0).otherwise(F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2)))
        return F.when(n >= 4, F.when(same, 0.0).otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6)))
    if how == "sem":
        return F.stddev_samp(value) / F.sqrt(n)
    if how in ("count", "nunique"):
        return F.when(n > 0, n if how == "count" else F.count_distinct(value))
    if how in ("any", "all"):
        return (F.max if how == "any" else F.min)((value != 0).cast("double"))
    if how in ("first", "last"):
        return (F.max_by if how == "first" else F.min_by)(value, F.when(value.isNotNull(), F.col("_n")))
    return {
        "sum": F.sum, "max": F.max, "mean": F.avg, "min": F.min, "median": F.median,
        "std": F.stddev_samp, "var": F.var_samp, "prod": F.product, "product": F.product,
        "count_nonnull": F.count,
    }[how](value)


def visible(acquisitions: DataFrame, kept: DataFrame, cfg: Prep) -> DataFrame:
    """Each kept customer's acquisitions up to the anchor, numbered from the most recent (_n = 1) on.

    Ties of date go by the tiebreak and then by the order of the input, last first.
    """
    c = cfg.columns
    rows = acquisitions.withColumnRenamed(c.id, "customer").join(kept.select("customer", "anchor_date"), "customer")
    rows = rows.where(F.col(c.date) <= F.col("anchor_date"))
    order = [F.col(c.date).desc_nulls_first(), *([F.col(c.tiebreak).desc_nulls_first()] if c.tiebreak else []), F.col(ROW).desc()]
    return rows.withColumn("_n", F.row_number().over(W.partitionBy("customer").orderBy(*order)))


def history_aggregates(cfg: Prep) -> list[Column]:
    date = cfg.columns.date
    out = [F.count("*").alias("agg_n_acquisitions")]
    if cfg.emit_tenure:
        out.append(months(F.min(date), F.first("anchor_date")).alias("agg_tenure_months"))
    if cfg.count_by_family:
        out += [F.count(F.when(F.col(FAMILY) == f, 1)).alias(f"agg_n_{f}") for f in cfg.family_list]
    for name, spec in cfg.numerics.items():
        for how in spec.aggregations:
            value = reduced(how, F.col(name))
            out.append(value.alias(f"agg_{name}_{how}"))
            if spec.log1p and how in LOGGED:
                out.append(safe_log1p(value).alias(f"agg_{name}_{how}_log1p"))
        if cfg.numerics_by_family:
            for f in cfg.family_list:
                out += [reduced(how, F.when(F.col(FAMILY) == f, F.col(name))).alias(f"agg_{name}_{f}_{how}") for how in spec.aggregations]
    return out


def positions(cfg: Prep) -> list[Column]:
    """The carried columns at each of the last ``window`` rows, and whether there is such a row."""
    at = lambda p, x: F.max(F.when(F.col("_n") == p, F.col(x)))
    out = [F.least(F.count("*"), F.lit(cfg.window)).cast("int").alias("n_acquisitions_in_window")]
    for p in range(1, cfg.window + 1):
        out += [at(p, x).alias(f"pos{p}_{x}") for x in cfg.carry]
        out += [(at(p, f"{x}_pct") if cfg.percentiles else F.lit(None).cast("double")).alias(f"pos{p}_{x}_pct") for x in cfg.carry_percentiles]
        out.append((F.count("*") >= p).cast("int").alias(f"pos{p}_present"))
    return out


def with_gaps(df: DataFrame, cfg: Prep) -> DataFrame:
    """gap_i_j between neighbouring positions, and their mean, least, trend (newest less oldest) and count of zeros."""
    if cfg.emit_gaps:
        gaps = {f"gap_{p}_{p + 1}": months(f"_d{p + 1}", f"_d{p}") for p in range(1, cfg.window)}
        df = df.withColumns(gaps) if gaps else df
        seen = F.filter(F.array(*gaps), lambda g: g.isNotNull()) if gaps else F.array().cast("array<int>")
        df = df.withColumn("_gaps", seen)
        n = F.size("_gaps")
        total = F.aggregate("_gaps", F.lit(0), lambda a, g: a + g)
        df = df.withColumns({
            "gap_mean": F.when(n > 0, total / n), "gap_min": F.array_min("_gaps").cast("double"),
            "gap_trend": F.when(n > 1, (F.element_at("_gaps", 1) - F.element_at("_gaps", -1)).cast("double")),
            "bundle_count": F.size(F.filter("_gaps", lambda g: g == 0)),
        })
    return df.drop("_gaps", *[f"_d{p}" for p in range(1, cfg.window + 1)])


def build_features(acquisitions: DataFrame, kept: DataFrame, cfg: Prep) -> DataFrame:
    """One wide row per kept customer; the join, the numbering and the aggregate share one partitioning by customer."""
    dates = [F.max(F.when(F.col("_n") == p, F.col(cfg.columns.date))).alias(f"_d{p}") for p in range(1, cfg.window + 1)]
    out = visible(acquisitions, kept, cfg).groupBy("customer").agg(*history_aggregates(cfg), *positions(cfg), *dates)
    return with_gaps(out, cfg)
