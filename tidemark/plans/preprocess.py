"""From raw acquisition rows to the two datasets, the exclusions and the percentile grids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import Prep, load_yaml, prep_config
from ..operators.anchors import anchor_facts, anchors, exclusions
from ..operators.datasets import flat_dataset, hazard_dataset
from ..operators.features import build_features
from ..operators.percentiles import CELL, COUNTS, GRID, apply_percentiles, count_values, fingerprint, grids_of, merged_counts
from ..sources.raw import in_order, ingest, read_csv, split_outcomes
from ..sources.shared import remove, stored


@dataclass
class Prepared:
    flat: DataFrame
    hazard: DataFrame
    exclusions: DataFrame
    grid: DataFrame
    counts: DataFrame | None = None  # what a new grid was fitted on


def prepare(raw: DataFrame, cfg: Prep, grid: DataFrame | None = None, fit_where=None) -> Prepared:
    """Both datasets of ingested rows.  ``grid`` is a kept artifact for scoring; otherwise it is fitted here, on all
    acquisitions or those where ``fit_where`` holds, and written once."""
    cfg = cfg.checked()
    acquired, _ = split_outcomes(raw, cfg)
    counts = stored(count_values(acquired, cfg, fit_where), "values") if grid is None else None
    grid = stored(grids_of(counts), "grid") if grid is None else grid
    ranked = apply_percentiles(acquired, grid, cfg)
    facts = anchor_facts(raw, cfg)
    by_design = {d: anchors(facts, cfg, d) for d in ("fixed", "hazard")}
    features = {d: build_features(ranked, a.where("keep AND anchor_date IS NOT NULL"), cfg) for d, a in by_design.items()}
    return Prepared(
        flat_dataset(features["fixed"], by_design["fixed"]),
        hazard_dataset(features["hazard"], by_design["hazard"], cfg),
        exclusions(facts, cfg), grid, counts)


def save_grid(counts: DataFrame, cfg: Prep, path: str, grid: DataFrame | None = None) -> None:
    """The artifact in a new folder: counted values, the grid that follows from them, and the settings that decide what they mean."""
    counts.orderBy(*CELL, "value").write.parquet(f"{path}/values")
    (grids_of(counts) if grid is None else grid).write.parquet(f"{path}/grid")
    counts.sparkSession.createDataFrame([(fingerprint(cfg),)], "settings string").coalesce(1).write.parquet(f"{path}/settings")


def load_grid(spark: SparkSession, path: str, cfg: Prep | None = None) -> DataFrame:
    """The grid of an artifact; an error if it was fitted with other settings than ``cfg``."""
    _same_settings(spark, path, cfg)
    return spark.read.schema(GRID).parquet(f"{path}/grid")


def extend_grid(path: str, acquisitions: DataFrame, cfg: Prep, out: str) -> None:
    """A new artifact in ``out``: that of ``path`` with further acquisitions counted in.

    The grid equals one fitted on all rows, old and new, and the old rows are not read.
    """
    spark = acquisitions.sparkSession
    _same_settings(spark, path, cfg)
    old = spark.read.schema(COUNTS).parquet(f"{path}/values")
    save_grid(stored(merged_counts(old, count_values(acquisitions, cfg)), "values"), cfg, out)


def _same_settings(spark: SparkSession, path: str, cfg: Prep | None) -> None:
    kept = spark.read.schema("settings string").parquet(f"{path}/settings").first()[0]
    if cfg is not None and kept != fingerprint(cfg):
        raise ValueError(f"the grids in {path} were fitted with other settings: {kept}")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows with their order: a Parquet table or CSV files."""
    return in_order(spark.read.parquet(path)) if path.rstrip("/").endswith(".parquet") else read_csv(spark, path)


#: The order of rows in the files; a sort by ranges of these columns comes before each write.
ORDER = {"flat_dataset": ["customer"], "hazard_dataset": ["customer", "interval"], "exclusions": ["design", "customer"]}


def run(spark: SparkSession, config_path: str, form: str = "parquet") -> dict[str, dict]:
    """The run of a configuration file: reads the raw table, writes ordered datasets, exclusions and grids; returns their sizes.

    ``loaded`` counts rows, acquisitions, outcomes and customers of the input; a dataset its
    rows, customers, events, summed exposure (hazard) and columns, observed while it is
    written, so nothing is read again.
    """
    cfg = prep_config(load_yaml(config_path))
    c, raw = cfg.columns, ingest(read_raw(spark, cfg.input_path), cfg)
    outcome = F.count(c.target)
    sizes = {"loaded": raw.agg(F.count("*").alias("rows"), (F.count("*") - outcome).alias("acquisitions"), outcome.alias("outcomes"), F.countDistinct(c.id).alias("customers")).first().asDict()}
    done = prepare(raw, cfg)
    save_grid(done.counts, cfg, _fresh(spark, f"{cfg.artifact_dir}/percentile_grids"), done.grid)
    for name, df in (("flat_dataset", done.flat), ("hazard_dataset", done.hazard), ("exclusions", done.exclusions)):
        counts = {"rows": F.count(F.lit(1))}
        if "interval" in df.columns:  # whoever has rows has a first interval
            counts["customers"] = F.count(F.when(F.col("interval") == 1, 1))
        elif name == "flat_dataset":
            counts["customers"] = F.count("customer")
        if label := next((x for x in ("label", "event") if x in df.columns), None):
            counts["events"] = F.sum(F.col(label).cast("long"))
        if "exposure_frac" in df.columns:
            counts["exposure"] = F.sum("exposure_frac")
        seen = Observation()  # filled by the write itself
        out = df.orderBy(*ORDER[name]).observe(seen, *[v.alias(k) for k, v in counts.items()])
        out.write.mode("overwrite").option("header", True).format(form).save(f"{cfg.output_dir}/{name}")
        sizes[name] = seen.get | {"columns": len(df.columns)}
    return sizes


def run_extension(spark: SparkSession, config_path: str, artifact: str, out: str) -> None:
    """The rows of a configuration file's input counted into the grids of ``artifact``; the result goes to ``out``."""
    cfg = prep_config(load_yaml(config_path))
    acquired, _ = split_outcomes(ingest(read_raw(spark, cfg.input_path), cfg), cfg)
    extend_grid(artifact, acquired, cfg, out)


def _fresh(spark: SparkSession, path: str) -> str:
    """``path``, without what an earlier run has left there."""
    remove(spark, path)
    return path
