"""Anchor dates, eligibility and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import Prep
from ..functions.exprs import months, plus_months

DESIGNS = ("fixed", "hazard")


def anchor_facts(raw: DataFrame, cfg: Prep) -> DataFrame:
    """One row per customer with an acquisition: what the rules look at, from one shuffle by customer.

    The last acquisition before the outcome and the last one up to the cutoff are
    conditional maxima; no as-of join is needed.  Null ids are left out.
    """
    c = cfg.columns
    rows = raw.where(F.col(c.id).isNotNull()).select(F.col(c.id).alias("customer"), F.col(c.date).alias("date"), F.col(c.target).isNull().alias("acquired"))
    outcome = F.min(F.when(~F.col("acquired"), F.col("date"))).over(W.partitionBy("customer"))
    rows = rows.withColumn("outcome", outcome).where("acquired")
    cutoff = plus_months(F.lit(cfg.extract_date).cast("timestamp_ntz"), -cfg.horizon_months)
    return rows.groupBy("customer").agg(
        F.count("*").alias("n"), F.first("outcome").alias("outcome"), F.min("date").alias("first"), F.max("date").alias("last"),
        F.max(F.when(F.col("date") < F.col("outcome"), F.col("date"))).alias("before"),
        F.max(F.when(F.col("date") <= cutoff, F.col("date"))).alias("by_cutoff"))


def anchors(facts: DataFrame, cfg: Prep, design: str) -> DataFrame:
    """customer, anchor_date, keep, reason, event, event_month; the first rule that holds decides.

    A customer kept would need an anchor: one whose acquisitions have no date is excluded.
    """
    if design not in DESIGNS:
        raise ValueError(f"design {design!r} is none of {DESIGNS}")
    fixed = F.lit(design == "fixed")
    outcome, none = F.col("outcome").isNotNull(), F.lit(None).cast("timestamp_ntz")
    gap = months("before", "outcome")
    extract = F.lit(cfg.extract_date).cast("timestamp_ntz")
    rules = [  # condition, keep, anchor, reason, event
        (F.col("n") < cfg.min_acquisitions, False, none, F.lit("too few acquisitions"), None),
        (F.col("outcome") < F.col("first"), False, none, F.lit("outcome precedes first acquisition"), None),
        (outcome & F.col("before").isNull(), False, none, F.lit("no acquisition before outcome"), None),
        (outcome & fixed & (gap > cfg.horizon_months), False, F.col("before"), F.format_string("outcome %dm beyond horizon", gap), None),
        (outcome, True, F.col("before"), F.lit("event"), 1),
        (fixed & F.col("by_cutoff").isNull(), False, none, F.lit("censored: no acquisition before cutoff"), None),
        (F.col("last").isNull(), False, none, F.lit("no dated acquisition"), None),
        (F.lit(True), True, F.when(fixed, F.col("by_cutoff")).otherwise(F.col("last")), F.lit("censored"), 0),
    ]

    def decided(at: int):
        out = None
        for rule in rules:
            value = F.lit(rule[at]) if at in (1, 4) else rule[at]
            out = F.when(rule[0], value) if out is None else out.when(rule[0], value)
        return out

    out = facts.select(
        "customer", decided(2).alias("anchor_date"), decided(1).alias("keep"), decided(3).alias("reason"),
        decided(4).cast("int").alias("event"), "outcome")
    month = F.when(F.col("event") == 1, months("anchor_date", "outcome")).when(F.col("event") == 0, months(F.col("anchor_date"), extract))
    return out.withColumn("event_month", month).drop("outcome")


def exclusions(facts: DataFrame, cfg: Prep) -> DataFrame:
    """design, customer, reason of everyone a design leaves out."""
    parts = [anchors(facts, cfg, d).where("NOT keep").select(F.lit(d).alias("design"), "customer", "reason") for d in DESIGNS]
    return parts[0].unionByName(parts[1])
