"""Synthetic acquisition histories, drawn by hashing ids, so that they parallelise and repeat for a seed."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Product, kind of its balance, scale of its amount, weight of its amount in the score, weight of drawing it.
PRODUCTS = (
    ("checking_basic", "deposit", 200.0, 0.6, 0.20),
    ("checking_premium", "deposit", 2000.0, 0.8, 0.06),
    ("savings_standard", "deposit", 8000.0, 1.4, 0.18),
    ("cd_standard", "deposit", 30000.0, 1.6, 0.08),
    ("money_market", "deposit", 90000.0, 1.8, 0.05),
    ("jumbo_cd", "deposit", 600000.0, 2.0, 0.01),
    ("credit_card_rewards", "card", 12000.0, 0.7, 0.11),
    ("credit_card_secured", "card", 4000.0, 0.4, 0.03),
    ("auto_loan", "loan", 25000.0, 0.8, 0.12),
    ("mortgage_fixed", "loan", 280000.0, 1.1, 0.11),
    ("heloc", "loan", 70000.0, 1.3, 0.05),
)
START, END = "2012-01-01", "2026-06-30"
MOST = 12  # acquisitions of a customer
WAIT_SHAPE, WAIT_SCALE = 2.2, 9.0  # of the gamma distribution of months until the outcome


def _uniform(seed: int | Column, *keys: Column) -> Column:
    return (F.pmod(F.xxhash64(*keys, seed if isinstance(seed, Column) else F.lit(seed)), F.lit(1 << 40)) + 0.5) / float(1 << 40)


def _normal(seed: int | Column, *keys: Column) -> Column:
    """Standard normal by the Box-Muller transform."""
    return F.sqrt(-2 * F.ln(_uniform(seed, *keys))) * F.cos(2 * math.pi * _uniform(seed + 1, *keys))


def _poisson(u: Column, mean: float, most: int) -> Column:
    """Inverse distribution function, up to ``most``."""
    out, term, below = F.lit(0), math.exp(-mean), 0.0
    for k in range(most):
        below += term
        out = out + (u > below).cast("int")
        term *= mean / (k + 1)
    return out


def _gamma(seed: int, shape: float, scale: float, *keys: Column) -> Column:
    """Gamma for a shape above 1 by Marsaglia and Tsang: the first of eight tries that is accepted (one is with over 95 %)."""
    d = shape - 1 / 3
    c = 1 / math.sqrt(9 * d)

    def attempt(i: Column) -> Column:
        x = _normal(seed + 3 * i, *keys)
        v = F.pow(1 + c * x, F.lit(3.0))
        good = (v > 0) & (F.ln(_uniform(seed + 3 * i + 2, *keys)) < 0.5 * x * x + d - d * v + d * F.ln(F.greatest(v, F.lit(1e-300))))
        return F.when(good, d * v * scale)

    tries = F.transform(F.sequence(F.lit(0), F.lit(7)), attempt)
    return F.coalesce(F.get(F.filter(tries, lambda x: x.isNotNull()), F.lit(0)), F.lit(d * scale))


def acquisitions(spark: SparkSession, customers: int, seed: int = 7, base_rate: float = 0.02) -> DataFrame:
    """Acquisition and outcome rows.  Richer histories convert more often; one non-converter in a
    hundred gets an outcome before the first acquisition, to exercise eligibility.

    A customer's acquisitions end with the first that lies beyond the last day, as do their
    share of the score.  Draws are hashes of the customer and the step.
    """
    c = spark.range(customers).withColumn("customer_id", F.format_string("C%06d", "id"))
    c = c.withColumn("n", F.least(F.lit(MOST), _poisson(_uniform(seed, F.col("id")), 3.5, MOST) + 1))
    days = F.datediff(F.lit(END).cast("date"), F.lit(START).cast("date"))
    c = c.withColumn("first_day", F.floor(_uniform(seed + 2, F.col("id")) * 0.7 * days).cast("int"))
    steps = c.select("*", F.explode(F.sequence(F.lit(1), "n")).alias("step"))
    key = F.col("id"), F.col("step")
    gap = F.when(F.col("step") > 1, F.floor(60 + _uniform(seed + 3, *key) * 840)).otherwise(0).cast("int")
    steps = steps.withColumn("gap", gap)
    steps = steps.withColumn("day", F.col("first_day") + F.sum("gap").over(W.partitionBy("id").orderBy("step"))).where(F.col("day") <= days)
    u = _uniform(seed + 4, *key)
    total, below, product = sum(p[4] for p in PRODUCTS), 0.0, None
    for name, balance, scale, worth, weight in PRODUCTS:
        below += weight / total
        row = F.struct(F.lit(name).alias("type"), F.lit(balance).alias("kind"), F.lit(scale).alias("scale"), F.lit(worth).alias("worth"))
        product = F.when(u <= below, row) if product is None else product.when(u <= below, row)
    steps = steps.withColumn("p", F.coalesce(product, row))
    steps = steps.withColumn("amount", F.round(F.col("p.scale") * F.exp(0.7 * _normal(seed + 5, *key)), 2))
    date = F.date_add(F.lit(START).cast("date"), F.col("day").cast("int")).cast("timestamp_ntz")
    money = lambda k, x: F.when(F.col("p.kind") == k, x)
    rows = steps.select(
        "customer_id", date.alias("origination_date"), F.col("p.type").alias("product_type"),
        money("deposit", F.col("amount")).alias("deposit_balance"),
        F.coalesce(money("loan", F.col("amount")), money("card", F.lit(0.0))).alias("loan_balance"),
        money("card", F.col("amount")).alias("credit_exposure"),
        F.round(0.0001 + 0.2199 * _uniform(seed + 7, *key), 4).alias("rate"),
        F.when(_uniform(seed + 8, *key) > 0.15, "OPEN").otherwise("CLOSED").alias("account_status"),
        F.lit(None).cast("boolean").alias("target"))
    score = F.sum(F.col("p.worth") * F.log1p("amount") / 12)
    ends = steps.groupBy("id", "customer_id").agg(F.min(date).alias("first"), F.max(date).alias("last"), score.alias("score"))
    logit = math.log(base_rate / (1 - base_rate)) + 1.6 * (F.col("score") - 2.2)
    converts = _uniform(seed + 9, F.col("id")) < 1 / (1 + F.exp(-logit))
    wait = F.floor(_gamma(seed + 20, WAIT_SHAPE, WAIT_SCALE, F.col("id"))).cast("int") + 1
    at = F.col("last") + F.make_ym_interval(F.lit(0), wait)
    early = F.col("first") - F.make_dt_interval(F.lit(200))
    outcome = F.when(converts, F.when(at <= F.lit(END).cast("timestamp_ntz"), at)).when(_uniform(seed + 14, F.col("id")) < 0.01, early)
    outcomes = ends.select("customer_id", outcome.alias("origination_date"), F.lit(True).alias("target")).where("origination_date IS NOT NULL")
    return rows.unionByName(outcomes, allowMissingColumns=True)


def ordered(rows: DataFrame) -> DataFrame:
    """By customer and date, as the files are written."""
    return rows.orderBy("customer_id", "origination_date", F.col("target").asc_nulls_first(), "product_type")
