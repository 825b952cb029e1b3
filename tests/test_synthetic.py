"""The synthetic source against a plain version of the same distributions, and the command line from end to end."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import __main__ as cli
from tidemark.sources.synthetic import END, PRODUCTS, START, acquisitions, ordered

CUSTOMERS = 300_000


def plain(n, seed, base_rate):
    """(steps, converted, early, waits, shares of products, logs of amounts over their scale) in NumPy."""
    rng = np.random.default_rng(seed)
    days = int((np.datetime64(END) - np.datetime64(START)).astype(int))
    weights, scales, worth = (np.array([p[i] for p in PRODUCTS]) for i in (4, 2, 3))
    wanted = np.clip(rng.poisson(3.5, n) + 1, 1, 12)
    day = rng.uniform(0, days * 0.7, n).astype(int)
    steps, score, last, products, logs = np.zeros(n, int), np.zeros(n), np.zeros(n, int), np.zeros(len(PRODUCTS)), []
    going = np.ones(n, bool)
    for step in range(12):
        going &= (step < wanted) & (day <= days)
        k, noise = rng.choice(len(PRODUCTS), n, p=weights / weights.sum()), rng.normal(0, 0.7, n)
        products += np.bincount(k[going], minlength=len(PRODUCTS))
        logs.append(noise[going])
        score[going] += (worth[k] * np.log1p(scales[k] * np.exp(noise)) / 12)[going]
        last[going] = day[going]
        steps += going
        day = day + rng.uniform(60, 900, n).astype(int)
    converts = rng.random(n) < 1 / (1 + np.exp(-(math.log(base_rate / (1 - base_rate)) + 1.6 * (score - 2.2))))
    wait = rng.gamma(2.2, 9.0, n).astype(int) + 1
    seen = converts & (last + wait * 30.44 <= days)
    early = ~converts & (rng.random(n) < 0.01)
    return steps, seen.mean(), early.mean(), wait[seen], products / products.sum(), np.concatenate(logs)


def test_distributions_equal_a_plain_version(spark):
    steps, converted, early, waits, products, logs = plain(CUSTOMERS, 3, 0.02)
    rows = acquisitions(spark, CUSTOMERS).cache()
    own = rows.where("target IS NULL")
    assert abs(own.count() / CUSTOMERS - steps.mean()) < 0.03
    histogram = {r[0]: r[1] / CUSTOMERS for r in own.groupBy("customer_id").count().groupBy("count").count().collect()}
    assert all(abs(histogram.get(k, 0) - (steps == k).mean()) < 0.012 for k in range(1, 13))
    shares = {r[0]: r[1] / own.count() for r in own.groupBy("product_type").count().collect()}
    assert all(abs(shares[p[0]] - x) < 0.006 for p, x in zip(PRODUCTS, products))
    amount = F.coalesce("deposit_balance", "credit_exposure", "loan_balance")
    for name, _, scale, *_ in PRODUCTS:
        one = own.where(F.col("product_type") == name).agg(F.avg(F.log(amount)), F.stddev(F.log(amount))).first()
        assert abs(one[0] - math.log(scale)) < 0.06 and abs(one[1] - logs.std()) < 0.05, name
    loan = own.where("product_type like 'credit_card%'").agg(F.max("loan_balance"), F.min("loan_balance")).first()
    assert tuple(loan) == (0.0, 0.0)
    rate = own.agg(F.avg("rate"), F.min("rate"), F.max("rate"), F.avg((F.col("account_status") == "OPEN").cast("int"))).first()
    assert abs(rate[0] - 0.11005) < 0.002 and rate[1] >= 0.0001 and rate[2] <= 0.22 and abs(rate[3] - 0.85) < 0.01
    assert own.where(F.round("rate", 4) != F.col("rate")).count() == 0
    span = own.groupBy("customer_id").agg(F.min("origination_date").alias("first"), F.max("origination_date").alias("last"))
    outcomes = rows.where("target").join(span, "customer_id").cache()
    assert outcomes.select("customer_id").distinct().count() == outcomes.count()
    later = outcomes.where("origination_date > last")
    assert abs(later.count() / CUSTOMERS - converted) < 0.003
    before = outcomes.where(F.datediff("first", "origination_date") == 200).count()
    assert before + later.count() == outcomes.count() and abs(before / CUSTOMERS - early) < 0.003
    months = (F.year("origination_date") - F.year("last")) * 12 + F.month("origination_date") - F.month("last")
    got = later.agg(F.avg(months), F.stddev(months), F.min(months)).first()
    assert abs(got[0] - waits.mean()) < 1.2 and abs(got[1] - waits.std()) < 1.2 and got[2] >= 1
    gaps = own.join(span, "customer_id").where("origination_date > first").count()
    assert gaps == own.count() - CUSTOMERS
    rows.unpersist()
    outcomes.unpersist()


def test_written_rows_are_ordered_and_repeat(spark):
    rows = [tuple(r) for r in ordered(acquisitions(spark, 300)).select("customer_id", "origination_date").collect()]
    assert rows == sorted(rows)
    one, two = (sorted(map(str, acquisitions(spark, 50, seed=s).collect())) for s in (5, 5))
    assert one == two


PREP = """
io: {{input_path: {0}/raw, output_dir: {0}/data, artifact_dir: {0}/artifacts}}
columns: {{id: customer_id, date: origination_date, target: target, product_type: product_type, tiebreak: null}}
labeling: {{extract_date: "2026-06-30", horizon_months: 36, min_acquisitions: 1}}
"""
MODEL = """
io: {{input_path: {0}/data/{1}_dataset, output_dir: {0}/{1}}}
design: {2}
columns: {{id: customer, group: customer, label: {3}, weight: {4}, drop: [anchor_date, months_low, months_high], force_categorical: [interval]}}
model: {{type: logistic, logistic: {{l1_ratio: 0.1, c_grid: [0.1], max_iter: 15, tol: 0.001}}}}
sampling: {{negative_customer_fraction: 0.5}}
cv: {{n_splits: 2, n_repeats: 1, random_state: 42}}
"""


def test_command_line_from_end_to_end(spark, tmp_path, capsys):
    cli.main(["synthesize", "--customers", "1500", "--out", f"{tmp_path}/raw.parquet", "--base-rate", "0.2"])
    raw = spark.read.parquet(f"{tmp_path}/raw.parquet")
    (tmp_path / "prep.yaml").write_text(PREP.format(tmp_path).replace("/raw,", "/raw.parquet,"))
    cli.main(["preprocess", "--config", f"{tmp_path}/prep.yaml"])
    said = capsys.readouterr().out
    assert f"'rows': {raw.count()}" in said and "'exposure'" in said
    flat, hazard, gone = (spark.read.parquet(f"{tmp_path}/data/{n}") for n in ("flat_dataset", "hazard_dataset", "exclusions"))
    assert (len(flat.columns), len(hazard.columns), gone.columns) == (57, 60, ["design", "customer", "reason"])
    customers = [r[0] for r in flat.select("customer").collect()]
    assert customers == sorted(customers) and len(set(customers)) == len(customers)
    keys = [tuple(r) for r in hazard.select("customer", "interval").collect()]
    assert keys == sorted(keys)
    from tidemark.plans.preprocess import load_grid

    grid = load_grid(spark, f"{tmp_path}/artifacts/percentile_grids")
    assert grid.count() > 20 and {len(r.edges) for r in grid.collect()} == {101}
    for design, name, label, weight in (("hazard", "hazard", "event", "exposure_frac"), ("flat", "flat", "label", "null")):
        (tmp_path / f"{name}.yaml").write_text(MODEL.format(tmp_path, name, design, label, weight))
        cli.main(["model", "--config", f"{tmp_path}/{name}.yaml"])
        assert f"'design': '{design}'" in capsys.readouterr().out
        measures = {r.metric: r["mean"] for r in spark.read.parquet(f"{tmp_path}/{name}/metrics").collect()}
        assert {"n_customers", "n_events", "prevalence", "pr_auc", "roc_auc", "brier", "lift_top_1%"} <= set(measures) and 0.4 < measures["roc_auc"] <= 1
        for part in ("metrics_by_repeat", "calibration", "predictions", "features"):
            assert spark.read.parquet(f"{tmp_path}/{name}/{part}").count() > 0


def test_unknown_settings_are_errors():
    from tidemark.config import model_config, prep_config

    for bad in ({"labelling": {}}, {"labeling": {"horizon": 3}}, {"sequence": {"windows": 3}}, {"columns": {"ident": "x"}}, {"percentiles": {"on": True}}):
        with pytest.raises(ValueError, match="unknown"):
            prep_config(bad)
    for bad in ({"modle": {}}, {"cv": {"splits": 3}}, {"model": {"gbm": {"depth": 3}}}, {"sampling": {"fraction": 0.5}}):
        with pytest.raises(ValueError, match="unknown"):
            model_config(bad)
    assert model_config({"model": {"type": "gbm", "gbm": {"max_depth": 4, "l2_regularization": 1.0}}}).gbm_max_depth == 4
