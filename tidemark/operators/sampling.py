"""Sampling and folds by customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import draw, running_sums
from ..sources.shared import stored


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def downsample_negatives(df: DataFrame, group: str, label: str, fraction: float, seed: int) -> DataFrame:
    """Every customer who converted, and a share of the others, whole; _sample_weight makes up for those left out.

    The draw is a hash of the id, so it is the same on every run and every executor.
    """
    if fraction <= 0:
        raise ValueError("the fraction of negative customers is above 0")
    if fraction >= 1:
        return df.withColumn("_sample_weight", F.lit(1.0))
    ever = df.groupBy(F.col(group).alias("_g")).agg(F.coalesce(F.max(F.col(label).cast("int")), F.lit(0)).alias("_ever"))
    ever = ever.where((F.col("_ever") == 1) | (draw("_g", seed, _kind(df, group)) < F.lit(fraction * 4294967296)))
    weight = F.when(F.col("_ever") == 1, 1.0).otherwise(1.0 / fraction)
    return df.join(ever, F.col(group) == F.col("_g")).withColumn("_sample_weight", weight).drop("_g", "_ever")


def balanced(classes: list[tuple[int, int, int]], splits: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(rows, events) -> (customers each fold gets, folds of those left over), for (rows, events, customers).

    Customers of equal rows and events are dealt out evenly.  Those left over, the largest
    first, go one by one where the fold's rows without and with an event, each against
    its total, make the least sum of squares; then where the fewest rows are.
    """
    plain, events = (max(1, sum(x * n for x, n in pairs)) for pairs in ([(r - e, n) for r, e, n in classes], [(e, n) for _, e, n in classes]))
    loads, out = [(0, 0)] * splits, {}
    for rows, hits, customers in sorted(classes, reverse=True):
        extra = []
        for _ in range(customers % splits):
            k = min(range(splits), key=lambda i: (loads[i][0] * (rows - hits) * events**2 + loads[i][1] * hits * plain**2, sum(loads[i]), i))
            loads[k] = loads[k][0] + rows - hits, loads[k][1] + hits
            extra.append(k)
        out[rows, hits] = customers // splits, extra
    return out


def group_folds(df: DataFrame, group: str, label: str, splits: int, seed: int) -> DataFrame:
    """group, has_event, fold: customers dealt out so that folds hold like numbers of rows and of events.

    Folds are disjoint by customer and repeat for a seed.  Customers of the same number of
    rows and events go in turn, in the order of a hash; the turn is a running count over ranges, so no
    class of them meets in a task.  ``balanced`` deals out what is left of each class; the
    driver sees one row for each class.
    """
    event = F.coalesce(F.col(label).cast("int"), F.lit(0))
    customers = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.max(event).alias("has_event"), F.count("*").alias("_rows"), F.sum((event > 0).cast("long")).alias("_events"))
    customers = stored(customers.withColumn("_d", draw(group, seed, _kind(df, group))).withColumn("_1", F.lit(1)), "customers")
    classes = customers.groupBy("_rows", "_events").count().collect()
    shares = [(r, e, each, extra) for (r, e), (each, extra) in balanced([tuple(c) for c in classes], splits).items()]
    shares = df.sparkSession.createDataFrame(shares, "_r long, _e long, _each long, _extra array<int>")
    dealt = running_sums(customers, ["_rows", "_events"], [F.col("_d"), F.col(group)], {"_n": "_1"})
    dealt = dealt.join(shares, (F.col("_rows") == F.col("_r")) & (F.col("_events") == F.col("_e")))
    left = F.col("_n") - F.col("_each") * splits
    fold = F.when(left < 0, F.col("_n") % splits).otherwise(F.try_element_at("_extra", (left + 1).cast("int")))
    return dealt.select(group, "has_event", fold.cast("int").alias("fold"))
