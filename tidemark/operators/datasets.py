"""The flat and the hazard dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Prep


def flat_dataset(features: DataFrame, anchors: DataFrame) -> DataFrame:
    """One row per kept customer: customer, anchor_date, label, features."""
    kept = anchors.where("keep").select("customer", "anchor_date", F.col("event").alias("label"))
    return kept.join(features, "customer")


def hazard_skeleton(anchors: DataFrame, cfg: Prep) -> DataFrame:
    """One row per kept customer and interval (low, high] at risk: interval, months_low, months_high, exposure_frac, event.

    Follow-up ends at the cap, where an event counts as none.  A last interval without
    event and with less than min_exposure_frac of exposure is left out.
    """
    w, cap = cfg.bin_months, cfg.max_followup_months
    rows = anchors.where("keep AND anchor_date IS NOT NULL").select(
        "customer", F.greatest(F.lit(0), F.least("event_month", F.lit(cap))).alias("m"), "event")
    happened = (F.col("event") == 1) & (F.col("m") < cap)
    rows = rows.select("customer", "m", happened.alias("ev"), F.greatest(F.lit(1), F.ceil(F.col("m") / w)).cast("int").alias("n"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), "n")).alias("interval"))
    low, last = (F.col("interval") - 1) * w, F.col("interval") == F.col("n")
    exposure = F.when(last, F.greatest(F.least(F.col("m") - low, F.lit(w)) / w, F.lit(1.0) / w)).otherwise(1.0)
    rows = rows.withColumn("e", exposure).where(~(last & ~F.col("ev") & (F.col("e") < cfg.min_exposure_frac)))
    return rows.select(
        "customer", "interval", low.alias("months_low"), (F.col("interval") * w).alias("months_high"),
        F.bround("e", 3).alias("exposure_frac"), (last & F.col("ev")).cast("int").alias("event"))


def hazard_dataset(features: DataFrame, anchors: DataFrame, cfg: Prep) -> DataFrame:
    return hazard_skeleton(anchors, cfg).join(features, "customer")
