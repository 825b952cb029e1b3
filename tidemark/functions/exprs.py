"""Column expressions and the running sums that quantiles, ranks and curves are built from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.shared import stored


def months(start, end) -> Column:
    """Calendar months from start to end: the day is ignored and the sign kept."""
    start, end = (F.col(x) if isinstance(x, str) else x for x in (start, end))
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def plus_months(date: Column, n: int) -> Column:
    """The date n months on, clamped to the month's end, with its time of day."""
    return date + F.make_ym_interval(F.lit(0), F.lit(n))


def safe_log1p(value: Column) -> Column:
    return F.when(value >= 0, F.log1p(value))


def left_rank(edges: Column, value: Column) -> Column:
    """How many edges lie below the value, 100 at most."""
    return F.when(value.isNotNull() & edges.isNotNull(), F.least(F.lit(100), F.size(F.filter(edges, lambda e: e < value))))


def lerp(a: Column, b: Column, t: Column) -> Column:
    """Between a and b, as numerical libraries round it: from the nearer end."""
    return F.when(t >= 0.5, b - (b - a) * (1 - t)).otherwise(a + (b - a) * t)


def running_sums(df: DataFrame, cell: Sequence[str], order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """``df`` with, for each name -> column of ``sums``, the sum over the rows before it in its cell, and ``<name>_all`` over the whole cell.

    Rows are dealt out by ranges of the cell and ``order``, whose bounds Spark draws from the
    data; the totals of the ranges are summed up, then only rows of one range meet in a
    task.  A cell may hold any number of rows, however close their values, as long as
    ``order`` tells them apart.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(parts, *[F.col(c) for c in cell], *order).withColumn("_part", F.spark_partition_id())
    df = stored(ranges, "ranges")  # later steps must see the same ranges
    keys = [*cell, "_part"]
    totals = df.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    within = W.partitionBy(*cell) if cell else W.partitionBy(F.lit(1))
    before = within.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(within).alias(f"{n}_all") for n in sums])
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = df.join(totals, match).drop(*[f"_k_{k}" for k in keys])
    local = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return joined.withColumns({n: F.col(f"_b_{n}") + F.coalesce(F.sum(c).over(local), F.lit(0)) for n, c in sums.items()}).drop("_part", *[f"_b_{n}" for n in sums])


def quantiles(df: DataFrame, cell: Sequence[str], value: str, fractions: Sequence[float]) -> DataFrame:
    """cell columns, n, edges: the exact quantiles of the non-null values of each cell, linearly interpolated.

    Equal values are counted first.  The order statistics that a value stands for follow
    from its place among the running counts by arithmetic, so all but the few values that
    some fraction needs are gone before anything is gathered.  ``fractions`` rise from 0 to 1
    in equal steps, or are few.
    """
    return quantiles_of_counts(value_counts(df, cell, value), cell, fractions)


def value_counts(df: DataFrame, cell: Sequence[str], value: str) -> DataFrame:
    """cell columns, _v, _c: how often each non-null value occurs in each cell."""
    return df.where(F.col(value).isNotNull()).groupBy(*cell, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c"))


def quantiles_of_counts(counts: DataFrame, cell: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    """``quantiles`` of values that ``value_counts`` has counted."""
    placed = running_sums(counts, cell, [F.col("_v")], {"_lo": "_c"})
    top, last = F.col("_lo_all") - 1, len(fractions) - 1
    even = last > 0 and all(abs(f - i / last) < 1e-12 for i, f in enumerate(fractions))
    if even:  # which fractions may fall on the value or just below it
        step = last / F.greatest(top, F.lit(1))
        least = F.greatest(F.lit(0), F.ceil((F.col("_lo") - 1) * step - 1e-6)).cast("int")
        most = F.least(F.lit(last), F.ceil((F.col("_lo") + F.col("_c")) * step + 1e-6) - 1).cast("int")
        most = F.when(top == 0, F.lit(last)).otherwise(most)
    else:
        least, most = F.lit(0), F.lit(last)
    rows = placed.withColumns({"_i": least, "_j": most}).where("_i <= _j")
    rows = rows.select(*cell, "_v", "_lo", "_c", F.col("_lo_all").alias("n"), F.explode(F.sequence("_i", "_j")).alias("i"))
    place = (F.col("n") - 1) * F.element_at(F.array(*[F.lit(float(f)) for f in fractions]), F.col("i") + 1)
    inside = lambda p: (p >= F.col("_lo")) & (p < F.col("_lo") + F.col("_c"))
    rows = rows.withColumn("p", place).withColumn("q", F.floor("p"))
    rows = rows.groupBy(*cell, "n", "i").agg(
        F.first(F.col("p") - F.col("q")).alias("t"), F.max(F.when(inside(F.col("q")), F.col("_v"))).alias("a"),
        F.max(F.when(inside(F.least(F.col("q") + 1, F.col("n") - 1)), F.col("_v"))).alias("b"))
    rows = rows.withColumn("edge", lerp(F.col("a"), F.col("b"), F.col("t")))
    edges = F.transform(F.array_sort(F.collect_list(F.struct("i", "edge"))), lambda x: x["edge"])
    return rows.groupBy(*cell).agg(F.first("n").cast("long").alias("n"), edges.alias("edges"))


WORD = 1 << 32
MIXES = (16, 73244475), (16, 73244475)  # a shift and a factor below 2**31 each, so that nothing overflows


def draw(key: str, seed: int, kind: str) -> Column:
    """A number in 0 .. 2**32-1 for an id: shifts and multiplications for integers of any size, xxhash64 for others."""
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(WORD))
    x = F.col(key).cast("long")
    x = F.pmod(x.bitwiseXOR(F.shiftright(x, 32)).bitwiseXOR(F.lit(seed)), F.lit(WORD))
    for shift, factor in MIXES:
        x = x.bitwiseXOR(F.shiftright(x, shift)) * F.lit(factor) % F.lit(WORD)
    return x.bitwiseXOR(F.shiftright(x, 16))


def draw_sql(key: str, seed: int) -> str:
    """``draw`` of a non-negative integer column in SQL."""
    x = f"(xor(xor({key}, {key} >> 32), {seed}) % {WORD})"
    for shift, factor in MIXES:
        x = f"(xor({x}, {x} >> {shift}) * {factor} % {WORD})"
    return f"xor({x}, {x} >> 16)"
