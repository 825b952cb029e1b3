"""Features of the customers each micro-batch touches, against those of the whole history."""

from dataclasses import replace

from tidemark.config import Prep
from tidemark.operators.percentiles import GRID, fit_percentiles
from tidemark.plans.scoring import scoring_features
from tidemark.sources.raw import ingest, split_outcomes
from tidemark.sources.synthetic import acquisitions
from tidemark.streaming.histories import refresh_features


def test_micro_batches_refresh_the_customers_in_them(spark, tmp_path):
    cfg = replace(Prep(), min_cell_size=5)
    raw = acquisitions(spark, 120)
    raw.write.parquet(f"{tmp_path}/all")
    raw = spark.read.parquet(f"{tmp_path}/all")
    grid = fit_percentiles(split_outcomes(ingest(raw, cfg), cfg)[0], cfg).cache()
    early, late = raw.where("origination_date < '2020-01-01'"), raw.where("origination_date >= '2020-01-01'")
    for part in (early, late):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/in")
        refresh_features(stream, f"{tmp_path}/history", grid, cfg, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/history").count() == raw.count()
    touched = {r[0] for r in late.select("customer_id").distinct().collect()}
    want = {r.customer: r for r in scoring_features(ingest(raw, cfg), grid, cfg).collect() if r.customer in touched}
    got = {r.customer: r for r in spark.read.parquet(f"{tmp_path}/out/batch=1").collect()}
    assert got == want and len(want) > 20


def test_finished_batches_are_merged(spark, tmp_path, monkeypatch):
    from tidemark.streaming import histories

    monkeypatch.setattr(histories, "FAN", 2)
    monkeypatch.setattr(histories, "SHARDS", 2)
    assert list(histories.covering(7)) == [(2, 0), (1, 4), (0, 6)] and list(histories.covering(0)) == []
    assert list(histories.merges(4)) == [(1, 2), (2, 0)] and list(histories.merges(5)) == list(histories.merges(0)) == []
    rows = acquisitions(spark, 30).drop("_row_idx")
    rows.repartition(7).write.parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    cfg = Prep(percentiles=False)
    query = histories.refresh_features(arriving, f"{tmp_path}/history", spark.createDataFrame([], GRID), cfg, f"{tmp_path}/out", f"{tmp_path}/ckpt")
    query.awaitTermination(240)
    held = [f"{tmp_path}/history/level={level}/from={start}" for level, start in histories.covering(7)]
    assert spark.read.option("basePath", f"{tmp_path}/history").parquet(*held).count() == rows.count()
    assert not (tmp_path / "history/level=0/from=0").exists() and (tmp_path / "history/level=0/from=6").exists()
    last = spark.read.parquet(f"{tmp_path}/out/batch=6")
    whole = scoring_features(ingest(rows, cfg), spark.createDataFrame([], GRID), cfg)
    key = lambda r: (r.customer, r.agg_n_acquisitions, r.agg_tenure_months)
    assert {key(r) for r in last.collect()} <= {key(r) for r in whole.collect()} and last.count() > 0
