"""Quantiles, metrics, folds, encoding and the logistic fit, against plain versions."""

from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import Model, model_config
from tidemark.functions.exprs import quantiles
from tidemark.operators import metrics
from tidemark.operators.encode import Encoder, coded, fold_encoders, imputation_scaling, vocabulary_of
from tidemark.operators.sampling import downsample_negatives, group_folds
from tidemark.sources.synthetic import acquisitions


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(1)
    cells = {str(n): np.round(rng.lognormal(5, 2, n) * rng.choice([-1, 1], n), 2) for n in (1, 2, 5, 30, 101, 500)}
    cells["same"], cells["zero"] = np.full(40, 3.0), np.concatenate([np.zeros(50), rng.normal(size=20)])
    rows = [(k, float(v)) for k, vs in cells.items() for v in vs] + [("none", None)]
    got = {r.c: r for r in quantiles(spark.createDataFrame(rows, "c string, v double"), ["c"], "v", [k / 100 for k in range(101)]).collect()}
    assert set(got) == set(cells)
    for k, vs in cells.items():
        assert got[k].n == len(vs) and np.array_equal(got[k].edges, np.percentile(vs, np.arange(101)))


def scores(spark, rng, n=400, repeats=2):
    rows = [(r, i, float(np.round(rng.random(), 2)), int(rng.random() < 0.2)) for r in range(repeats) for i in range(n)]
    return rows, spark.createDataFrame(rows, "repeat int, customer long, score double, actual int")


def test_metrics_equal_brute_force(spark):
    rows, df = scores(spark, np.random.default_rng(2))
    got = {r.repeat: r for r in metrics.ranking_metrics(df, "customer", (0.01, 0.1)).collect()}
    for repeat in (0, 1):
        s = np.array([x[2] for x in rows if x[0] == repeat])
        a = np.array([x[3] for x in rows if x[0] == repeat])
        pos, neg = s[a == 1], s[a == 0]
        auc = np.mean((pos[:, None] > neg).astype(float) + 0.5 * (pos[:, None] == neg))
        ap, last = 0.0, 0.0
        for t in sorted(set(s), reverse=True):
            recall = a[s >= t].sum() / a.sum()
            ap += (recall - last) * a[s >= t].mean()
            last = recall
        order = sorted(range(len(s)), key=lambda i: (-s[i], i))
        lift = a[order[: max(1, round(len(s) * 0.1))]].mean() / a.mean()
        r = got[repeat]
        assert r.roc_auc == pytest.approx(auc, abs=1e-12) and r.pr_auc == pytest.approx(ap, abs=1e-12)
        assert r.brier == pytest.approx(np.mean((s - a) ** 2)) and r["lift_top_10%"] == pytest.approx(lift)


def test_degenerate_scores(spark):
    schema = "repeat int, customer long, score double, actual int"
    none = spark.createDataFrame([(0, 1, 0.5, 0), (0, 2, 0.1, 0)], schema)
    assert metrics.ranking_metrics(none, "customer", (0.1,)).count() == 0
    ones = spark.createDataFrame([(0, 1, 0.5, 1), (0, 2, 0.1, 1)], schema)
    assert metrics.ranking_metrics(ones, "customer", ()).first().roc_auc is None
    tied = spark.createDataFrame([(0, i, 0.5, i % 2) for i in range(10)], schema)
    assert metrics.calibration(tied, 5).count() == 0
    assert metrics.summary(metrics.ranking_metrics(tied, "customer", ())).where("metric = 'brier'").first()["std"] is None
    assert metrics.lift_name(0.29) == "lift_top_28%"


def test_survival(spark):
    rows = [(0, "a", 1, 0.1, 0), (0, "a", 2, 1.0, 0), (0, "b", 1, 0.2, 1), (0, "c", 1, 0.2, 0), (0, "d", 1, 0.1, 0), (0, "d", 2, 0.1, 0), (0, "d", 3, 0.9, 1)]
    df = spark.createDataFrame(rows, "repeat int, customer string, interval int, score double, event int")
    got = {r.customer: (round(r.score, 6), r.actual) for r in metrics.survival_scores(df, "customer", "event", 2).collect()}
    assert got == {"a": (1.0, 0), "b": (0.2, 1), "d": (0.19, 0)}


def test_folds_and_sampling(spark):
    df = spark.range(3000).select(F.col("id").alias("customer"), (F.col("id") % 7 == 0).cast("int").alias("event")).withColumn("i", F.explode(F.array(F.lit(1), F.lit(2))))
    folds = group_folds(df, "customer", "event", 5, 42)
    counts = {(r.has_event, r.fold): r["count"] for r in folds.groupBy("has_event", "fold").count().collect()}
    assert folds.count() == 3000 and len(counts) == 10
    for e in (0, 1):
        sizes = [counts[e, k] for k in range(5)]
        assert max(sizes) - min(sizes) <= 1
    kept = downsample_negatives(df, "customer", "event", 0.25, 42)
    rows = kept.groupBy("customer").agg(F.count("*").alias("n"), F.max("event").alias("e"), F.max("_sample_weight").alias("w")).collect()
    assert all(r.n == 2 and r.w == (1.0 if r.e else 4.0) for r in rows)
    assert sum(r.e for r in rows) == 429 and abs(sum(not r.e for r in rows) / 2571 - 0.25) < 0.04
    with pytest.raises(ValueError):
        downsample_negatives(df, "customer", "event", 0, 42)


def plain_encoding(train, rows, numeric, categorical, least):
    """The encoded rows by name: medians, standardised values and indicators, frequent and pooled levels of ``train``."""
    out = {}
    for c in numeric:
        x = np.array([np.nan if r[c] is None else float(r[c]) for r in train])
        if not np.isnan(x).all():
            middle = np.nanmedian(x)
            filled = np.where(np.isnan(x), middle, x)
            out[c] = [((middle if r[c] is None or r[c] != r[c] else float(r[c])) - filled.mean()) / (filled.std() or 1.0) for r in rows]
    for c in numeric:
        lost = np.array([r[c] is None or r[c] != r[c] for r in train])
        if lost.any():
            out[f"missing_{c}"] = [((r[c] is None or r[c] != r[c]) - lost.mean()) / (lost.std() or 1.0) for r in rows]
    for c in categorical:
        level = lambda r: "MISSING" if r[c] is None else r[c]  # noqa: E731, B023
        counts = Counter(level(r) for r in train)
        often = sorted(v for v, n in counts.items() if n >= least * len(train))
        out |= {f"{c}={v}": [float(level(r) == v) for r in rows] for v in often}
        if len(often) < len(counts):
            out[f"{c}=__infrequent__"] = [float(level(r) not in often) for r in rows]
    return out


def encoder_rows(n=300):
    rng = np.random.default_rng(9)
    out = []
    for i in range(n):
        out.append({"customer": i // 2, "event": int(rng.random() < 0.25), "x": None if rng.random() < 0.2 else float(rng.normal()), "k": 5.0, "none": None,
                    "z": float("nan") if i % 9 == 0 else float(rng.integers(0, 5)), "c": None if i % 11 == 0 else str(rng.choice(["a", "b", "c"])) if i % 40 else f"rare{i}", "flag": bool(i % 3)})
    return out


ENCODED = "customer long, event int, x double, k double, none double, z double, c string, flag boolean"


def test_encoders_of_folds_equal_a_plain_encoding(spark):
    rows = encoder_rows()
    folds = [[i // 2 % 3, i // 2 * 7 % 5 % 3] for i in range(len(rows))]
    df = spark.createDataFrame([(*r.values(), f) for r, f in zip(rows, folds)], ENCODED + ", _folds array<int>")
    numeric, categorical, least = ["x", "k", "none", "z", "flag"], ["c"], 0.02
    jobs = [(r, k) for r in range(2) for k in range(3)]
    found = fold_encoders(df, numeric, categorical, least, jobs, 3)
    vocabulary = vocabulary_of(found)
    table = coded(df, numeric, categorical, vocabulary).orderBy("customer", "x").select("_num", "_cat").toPandas()
    order = [r for r in df.orderBy("customer", "x").collect()]
    num, cat = np.array(list(table["_num"]), float), np.stack(table["_cat"])
    for job, encoder in zip(jobs, found):
        train = [r for r, f in zip(rows, folds) if f[job[0]] != job[1]]
        want = plain_encoding(train, order, numeric, categorical, least)
        assert encoder.names() == list(want) and encoder.rows == len(train)
        assert "missing_none" in want and "none" not in want
        np.testing.assert_allclose(encoder.matrix(num, cat, vocabulary), np.array(list(want.values())).T, atol=1e-12)
    encoder = found[0]
    unknown = spark.createDataFrame([(0, 0, None, 5.0, 1.0, 2.0, "new", True)], ENCODED)
    want = plain_encoding([r for r, f in zip(rows, folds) if f[0] != 0], unknown.collect(), numeric, categorical, least)
    np.testing.assert_allclose(encoder.transform(unknown).first()["_features"], [v[0] for v in want.values()], atol=1e-12)


def test_encoder(spark):
    rows = [(float(i) if i % 4 else None, "common" if i % 50 else f"rare{i}", 5.0) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, c string, k double")
    stats = {r.feature: r for r in imputation_scaling(df, ["x", "k"]).collect()}
    xs = np.array([r[0] for r in rows if r[0] is not None])
    filled = np.array([np.median(xs) if r[0] is None else r[0] for r in rows])
    assert stats["x"].median == np.median(xs) and stats["x"].scale == pytest.approx(filled.std()) and stats["x"]["mean"] == pytest.approx(filled.mean())
    assert stats["k"].scale == 1.0
    encoder = Encoder.fit(df, ["x", "k"], ["c"], 0.01)
    assert list(encoder.columns()) == ["x", "k", "missing_x", "c=common", "c=__infrequent__"]
    unknown = spark.createDataFrame([(None, "new", 5.0)], df.schema)
    assert encoder.transform(unknown).first()["_features"][2:] == pytest.approx([0.75 / (0.25 * 0.75) ** 0.5, 0.0, 1.0])


def model_rows(spark, n=600, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-(x @ [1.0, -0.5, 0.0])))).astype(int)
    kind = rng.choice(["p", "q", "r"], n)
    rows = [(i // 2, *[None if rng.random() < 0.1 else float(v) for v in r], str(k), int(t), float(rng.integers(1, 4))) for i, (r, k, t) in enumerate(zip(x, kind, y))]
    return spark.createDataFrame(rows, "customer long, a double, b double, c double, kind string, event int, w double").withColumn("_sample_weight", F.lit(1.0))


def distance_from_stationary(x, y, w, beta, intercept, c, l1):
    w = w * np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    off = w * (1 / (1 + np.exp(-(x @ beta + intercept))) - y)
    gradient = c * off @ x + (1 - l1) * beta
    return max(abs(c * off.sum()), max(abs(g + l1 * np.sign(b)) if b else max(0.0, abs(g) - l1) for g, b in zip(gradient, beta)))


@pytest.mark.parametrize("c, l1", [(0.05, 0.1), (1.0, 0.1), (0.01, 0.9)])
def test_every_fold_of_the_logistic_model_is_optimal(spark, c, l1):
    from tidemark.plans import modelling

    df, cfg = model_rows(spark), Model(weight="w", c_grid=(c,), l1_ratio=l1, n_splits=3, n_repeats=2)
    predictions, folds = modelling.cross_validate(df, cfg)
    rows = modelling.with_folds(df, cfg, [0, 1]).toPandas()
    num = rows[["a", "b", "c"]].to_numpy(float)
    vocabulary = vocabulary_of([f.encoder for f in folds])
    cat = np.array([[vocabulary["kind"][k]] for k in rows["kind"]])
    assert [(f.repeat, f.fold) for f in folds] == [(r, k) for r in range(2) for k in range(3)]
    scores = {(r.repeat, r.customer, r.score) for r in predictions.collect()}
    assert predictions.count() == 2 * len(rows) and len({f.model.intercept for f in folds}) == 6
    for f in folds:
        mine = np.array([x[f.repeat] != f.fold for x in rows["_folds"]])
        x = f.encoder.matrix(num, cat, vocabulary)
        assert distance_from_stationary(x[mine], rows["event"].to_numpy()[mine], rows["w"].to_numpy()[mine], f.model.coefficients, f.model.intercept, c, l1) < 1e-3
        want = 1 / (1 + np.exp(-(x[~mine] @ f.model.coefficients + f.model.intercept)))
        got = {(r, i): [] for r, i, _ in scores}
        for r, i, s in scores:
            got[r, i].append(s)
        assert all(min(abs(np.array(got[f.repeat, i]) - p)) < 1e-9 for i, p in zip(rows["customer"].to_numpy()[~mine], want))


def test_minimum_by_signs_equals_slow_descent():
    from tidemark.operators.linear import quadratic_minimum

    rng = np.random.default_rng(5)
    for _ in range(20):
        a = rng.normal(size=(12, 9))
        h, q, l1 = a.T @ a + 0.1 * np.eye(9), rng.normal(size=9) * 4, np.where(np.arange(9) == 0, 0.0, 1.0)
        x = np.zeros(9)
        for _ in range(5000):
            for j in range(9):
                r = q[j] + h[j] @ x - h[j, j] * x[j]
                x[j] = -np.sign(r) * max(abs(r) - l1[j], 0) / h[j, j]
        np.testing.assert_allclose(quadratic_minimum(q, h, l1, rng.normal(size=9)), x, atol=1e-7)


def plain_boost(x, y, w, rate, rounds, depth, least, l2):
    """Raw scores of the training rows after each round, by trying every cut of every column."""
    w = w * np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    cuts = [np.unique((np.unique(c)[:-1] + np.unique(c)[1:]) / 2) if len(np.unique(c)) <= 255 else np.unique(np.percentile(c, np.linspace(0, 100, 256)[1:-1], method="midpoint")) for c in x.T]
    p = (w * y).sum() / w.sum()
    raw, out = np.full(len(y), np.log(p / (1 - p))), []

    def split(rows, level, g, h):
        best = (0.0, None, None)
        score = lambda r: g[r].sum() ** 2 / (h[r].sum() + l2)
        if level < depth:
            for f, cs in enumerate(cuts):
                for cut in cs:
                    side = x[rows, f] <= cut
                    a, b = rows[side], rows[~side]
                    if min(len(a), len(b)) >= least and (gain := score(a) + score(b) - score(rows)) > best[0] + 1e-9:
                        best = (gain, a, b)
        if best[1] is None:
            raw[rows] -= rate * g[rows].sum() / (h[rows].sum() + l2)
        else:
            split(best[1], level + 1, g, h)
            split(best[2], level + 1, g, h)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        split(np.arange(len(y)), 0, w * (p - y), w * p * (1 - p))
        out.append(raw.copy())
    return out


def test_boosting_equals_a_plain_search():
    from tidemark.operators.boosting import boost

    rng = np.random.default_rng(6)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 4, 400), rng.random(400) < 0.3, np.full(400, 2.0)]).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * x[:, 0] * x[:, 2] - x[:, 1] + 2))).astype(float)
    w = rng.uniform(0.5, 2, 400)
    for l2 in (0.0, 5.0):
        want = plain_boost(x, y, w, 0.1, 8, 3, 20, l2)
        for rounds in (1, 8):
            found = boost(list(x.T), y, w, 0.1, rounds, 3, 20, l2, 42)
            np.testing.assert_allclose(found.raw(x), want[rounds - 1], atol=1e-9)
    assert not np.allclose(want[-1], plain_boost(x, y, w, 0.1, 8, 3, 20, 0.0)[-1], atol=1e-3)
    assert found.uses([0]) and not found.uses([3])
    new = x.copy()
    new[:, 0] = new[::-1, 0]
    np.testing.assert_allclose(found.raw(x) + found.change(x, new, [0]), found.raw(new), atol=1e-12)
    assert boost([], y, w, 0.1, 3, 3, 20, 1.0, 42).raw(np.zeros((2, 0))) == pytest.approx([0.0, 0.0], abs=0.3)


def test_boosting_stops_early_only_on_large_data():
    from tidemark.operators.boosting import boost

    rng = np.random.default_rng(7)
    for n, stops in ((10_000, False), (10_001, True)):
        x, y = rng.normal(size=(n, 2)), (rng.random(n) < 0.5).astype(float)
        found = boost(list(x.T), y, np.ones(n), 0.3, 40, 3, 20, 0.0, 1)
        assert (len(found.feature) < 40) == stops and len(found.feature) >= 10


def test_boosted_trees_fit_a_bounded_sample(spark):
    from tidemark.plans import modelling

    df, cfg = model_rows(spark), Model(type="gbm", weight="w", gbm_max_iter=4, gbm_min_samples_leaf=10, n_splits=3, n_repeats=1)
    whole = modelling.cross_validate(df, cfg)[1]
    part = modelling.cross_validate(df, replace(cfg, gbm_fit_rows=150))[1]
    again = modelling.cross_validate(df, replace(cfg, gbm_fit_rows=150))[1]
    same = lambda a, b: all(np.array_equal(p.model.value, q.model.value) for p, q in zip(a, b))
    assert len(whole) == len(part) == 3 and same(part, again) and not same(whole, part)


def test_stability_and_config(spark):
    rows = [(0, k, "f", c) for k, c in enumerate([1.0, -1.0, 0.0, 2.0])]
    got = metrics.coefficient_stability(spark.createDataFrame(rows, "repeat int, fold int, feature string, coef double")).first()
    assert (got.mean_coef, got.sign_consistency, got.nonzero_rate) == (0.5, 0.5, 0.75)
    with pytest.raises(ValueError):
        model_config({"design": "hazard", "evaluation": {"hazard_horizon_months": 20, "hazard_bin_months": 6}})


def test_synthetic_histories(spark):
    rows = acquisitions(spark, 1500).cache()
    per = rows.where("target IS NULL").groupBy("customer_id").count().agg(F.avg("count"), F.max("count")).first()
    assert 2.5 < per[0] < 4.6 and per[1] <= 12
    assert 0 < rows.where("target").count() < 400
    assert rows.where("origination_date > timestamp_ntz'2026-06-30'").count() == 0


def test_streamed_histories(spark, tmp_path):
    from tidemark.config import Prep
    from tidemark.operators.percentiles import GRID
    from tidemark.streaming.histories import refresh_features

    source = tmp_path / "in"
    acquisitions(spark, 40).write.parquet(str(source))
    arriving = spark.readStream.schema(spark.read.parquet(str(source)).schema).parquet(str(source))
    cfg = Prep()
    query = refresh_features(arriving, str(tmp_path / "history"), spark.createDataFrame([], GRID), cfg, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_model_queries_run_the_reference_configuration(monkeypatch):
    from tidemark import queries
    from tidemark.plans import modelling

    runs = []
    monkeypatch.setattr(queries, "_model_input", lambda spark, d: "rows")
    monkeypatch.setattr(modelling, "cross_validate", lambda rows, cfg, *a: runs.append(cfg) or ("predictions", []))
    monkeypatch.setattr(modelling, "load", lambda df, cfg: df)
    for module in (modelling, queries):
        monkeypatch.setattr(module, "downsample_negatives", lambda rows, *a: rows)
    monkeypatch.setattr("tidemark.operators.sampling.downsample_negatives", lambda rows, *a: rows)
    monkeypatch.setattr(modelling, "stored", lambda df, label: df)
    monkeypatch.setattr(modelling, "customer_scores", lambda predictions, cfg: predictions)
    assert queries.cv_logistic_oof(None, "") == queries.cv_gbt_oof(None, "") == "predictions"
    assert runs == [Model(), Model(type="gbm")]
    assert (Model().n_splits, Model().n_repeats, Model().max_iter, Model().gbm_max_iter, Model().gbm_max_depth) == (5, 2, 400, 300, 3)


def test_permutation_importance_reports_the_boosted_trees(monkeypatch):
    from tidemark import queries
    from tidemark.plans import modelling

    runs = []
    monkeypatch.setattr(queries, "_model_input", lambda spark, d: "rows")
    monkeypatch.setattr(modelling, "importance", lambda df, cfg: runs.append((df, cfg)) or "every feature")
    assert queries.permutation_importance(None, "") == "every feature"
    assert runs == [("rows", Model(type="gbm"))] and runs[0][1].permutation_repeats == 5


def test_importance_equals_the_features_of_the_report(spark):
    from tidemark.plans import modelling

    rng = np.random.default_rng(4)
    rows = [(i // 2, str(i % 2 + 1), float(rng.normal()), 1.0, int(rng.random() < 0.3)) for i in range(400)]
    df = spark.createDataFrame(rows, "customer long, interval string, x double, exposure_frac double, event int")
    cfg = Model(type="gbm", gbm_max_iter=2, gbm_min_samples_leaf=5, n_splits=2, n_repeats=2, permutation_repeats=2, negative_customer_fraction=1.0)
    one, two = (sorted(map(tuple, x.collect())) for x in (modelling.importance(df, cfg), modelling.report(df, cfg)["features"]))
    assert one == two and {r[0] for r in one} == {"x", "interval"}


def test_draws_hold_for_ids_of_any_size(spark):
    from tidemark.functions.exprs import draw, draw_sql

    ids = [0, 1, 2, 5_000_000_000, 2**62, 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "i long")
    got = [r[0] for r in df.select(draw("i", 42, "bigint")).collect()]
    assert len(set(got)) == len(ids) and all(0 <= x < 2**32 for x in got)
    assert spark.createDataFrame([(-1,), (-(2**63),)], "i long").select(draw("i", 42, "bigint").alias("d")).where("d BETWEEN 0 AND 4294967295").count() == 2
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest($1::BIGINT[]) AS i", [ids])
    assert got == [r[0] for r in con.execute(f"SELECT {draw_sql('i', 42)} FROM t").fetchall()]
    share = spark.range(100_000).select(draw("id", 7, "bigint").alias("d")).agg(F.avg((F.col("d") < 2**30).cast("int")), F.avg((F.col("d") % 2).cast("double"))).first()
    assert abs(share[0] - 0.25) < 0.01 and abs(share[1] - 0.5) < 0.01
    big = spark.createDataFrame([(10**18 + i, i % 10 == 0) for i in range(500)], "customer long, event boolean")
    assert downsample_negatives(big, "customer", "event", 0.5, 1).count() > 200 and group_folds(big, "customer", "event", 5, 1).count() == 500


def test_running_sums_spread_narrow_bands_and_ties(spark):
    """100,000 values in one narrow band and one tied score: no task holds more than a few of the ranges' rows."""
    from tidemark.functions.exprs import running_sums

    rng = np.random.default_rng(2)
    values = rng.uniform(0.50, 0.51, 100_000)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id long, v double").withColumn("one", F.lit(1))
    spread = df.repartitionByRange(4, F.lit(0), "v").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert spread < 40_000
    got = {r.id: (r.n, r.n_all) for r in running_sums(df, [], [F.col("v"), F.col("id")], {"n": "one"}).collect()}
    order = np.lexsort((np.arange(len(values)), values))
    assert all(got[int(i)] == (n, 100_000) for n, i in enumerate(order))
    tied = df.withColumn("v", F.lit(0.0))
    got = {r.id: r.n for r in running_sums(tied, [], [F.col("v").desc(), F.col("id")], {"n": "one"}).collect()}
    assert got == {i: i for i in range(100_000)}
    edges = quantiles(df, [], "v", [k / 100 for k in range(101)]).first().edges
    assert np.array_equal(edges, np.percentile(values, np.arange(101)))


def test_equal_or_null_tiebreaks_keep_the_order_of_the_input(spark, tmp_path):
    from tidemark.config import Columns, Prep
    from tidemark.operators.features import visible
    from tidemark.sources.raw import ingest, split_outcomes

    cfg = Prep(columns=Columns(tiebreak="tie"), percentiles=False)
    rows = [("a", "2015-01-01", None, "p", 1.0 * i, None, None, tie) for i, tie in enumerate([None, 3, 3, None, 1])]
    schema = "customer_id string, origination_date string, target boolean, product_type string, deposit_balance double, loan_balance double, credit_exposure double, tie int"
    acquired, _ = split_outcomes(ingest(spark.createDataFrame(rows, schema).coalesce(1), cfg), cfg)
    kept = spark.sql("SELECT 'a' AS customer, timestamp_ntz'2016-01-01' AS anchor_date")
    order = [r.deposit_balance for r in visible(acquired, kept, cfg).orderBy("_n").collect()]
    assert order == [3.0, 0.0, 2.0, 1.0, 4.0]


def test_permutation_importance_finds_the_column_that_matters(spark):
    from tidemark.plans import modelling

    rng = np.random.default_rng(3)
    x, noise = rng.normal(size=(2, 600))
    label = (x + rng.normal(size=600) * 0.3 > 0).astype(int)
    kind = np.where(rng.random(600) < 0.5, "u", "v")
    df = spark.createDataFrame([(i, float(a), float(b), k, int(y)) for i, (a, b, k, y) in enumerate(zip(x, noise, kind, label))], "customer long, x double, noise double, kind string, event int")
    df = df.withColumn("_sample_weight", F.lit(1.0))
    cfg = Model(weight=None, type="gbm", gbm_max_iter=5, permutation_repeats=3)
    fold = modelling.fit(df, ["x", "noise"], ["kind"], cfg)
    got = {r.feature: r for r in modelling.permutation_importance(df, fold, cfg).collect()}
    assert set(got) == {"x", "noise", "kind"} and got["x"].mean_importance > 0.3 and got["x"].std_importance > 0
    assert abs(got["noise"].mean_importance) < 0.05 and abs(got["kind"].mean_importance) < 0.05
    # the same as scoring every row anew with the column of the row dealt to it
    rows = coded(df, ["x", "noise"], ["kind"], vocabulary_of([fold.encoder])).withColumn("_r", F.monotonically_increasing_id())
    lost, vocabulary = [], vocabulary_of([fold.encoder])
    for turn in range(3):
        dealt = modelling.shuffled(rows, ["_num", "_cat"], cfg.random_state + 10 * turn).toPandas()
        num, cat, other = np.stack(dealt["_num"]), np.stack(dealt["_cat"]), np.stack([o["_num"] for o in dealt["_other"]])
        new = num.copy()
        new[:, 0] = other[:, 0]
        ap = lambda s, y: (lambda o: (np.cumsum(y[o]) / np.arange(1, len(y) + 1))[y[o] == 1].mean())(np.argsort(-s, kind="stable"))
        y = dealt["event"].to_numpy()
        jitter = np.arange(len(y)) * 0.0
        lost.append(ap(fold.model.predict(fold.encoder.matrix(num, cat, vocabulary)) + jitter, y) - ap(fold.model.predict(fold.encoder.matrix(new, cat, vocabulary)) + jitter, y))
    assert got["x"].mean_importance == pytest.approx(np.mean(lost), abs=0.05)
    dealt = modelling.shuffled(df.withColumn("_r", F.monotonically_increasing_id()), ["x"], 1).collect()
    assert sorted(r._other.x for r in dealt) == sorted(x) and sum(r._other.x == r.x for r in dealt) < 20

def test_packed_scores_rank_like_single_ones(spark):
    rng = np.random.default_rng(8)
    rows, df = scores(spark, rng, n=3000)
    packed = []
    for repeat in (0, 1):
        mine = [x for x in rows if x[0] == repeat]
        for i in range(0, 3000, 500):
            part = mine[i : i + 500]
            packed += metrics.packed_steps(repeat, np.array([x[2] for x in part]), np.array([x[3] for x in part]), np.array([0.1, 0.3, 0.31, 0.8]))
    packed += metrics.packed_steps(2, np.array([0.2, 0.4]), np.array([0, 0]), np.zeros(0))  # no event, so no measure
    table = spark.createDataFrame(packed, metrics.STEPS)
    assert table.count() <= 2 * 6 * 5 + 1 and list(metrics.packed_steps(0, np.zeros(0), np.zeros(0), np.zeros(0))) == []
    want = {r.repeat: r.pr_auc for r in metrics.ranking_metrics(df, "customer", []).collect()}
    got = metrics.packed_precision(table)
    assert set(got) == {0, 1} and all(got[r] == pytest.approx(want[r], abs=1e-12) for r in want)


def test_columns_dealt_anew_are_scored_to_the_last_bit():
    from tidemark.operators.boosting import boost

    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=3000) > 0).astype(float)
    for depth, least in ((3, 20), (None, 5)):  # values by a table, and by a walk for trees of many splits
        found = boost(list(x.T), y, np.ones(3000), 0.1, 20, depth, least, 1.0, 42)
        assert any(t is None for t in found.tables) == (depth is None)
        new = np.asfortranarray(x.copy())
        new[:, 1] = new[::-1, 1]
        assert np.array_equal(found.anew(new, [1], found.leaves(x)), found.raw(new))
        one = [found.base + sum(walk(found, t, row) for t in range(len(found.feature))) for row in new[:50]]
        np.testing.assert_allclose(found.raw(new)[:50], one, atol=1e-12)


def walk(trees, t, row):
    n = 0
    while trees.feature[t, n] >= 0:
        n = (trees.left if row[trees.feature[t, n]] <= trees.threshold[t, n] else trees.right)[t, n]
    return trees.value[t, n]


def test_bins_are_counted_jointly():
    from tidemark.operators.boosting import BINS, Bins

    rng = np.random.default_rng(10)
    kind = rng.integers(0, 4, 900)
    codes = np.column_stack([rng.integers(0, 256, 900), *[kind == k for k in range(4)], rng.random(900) < 0.5, rng.integers(0, 9, 900), kind == 2, np.zeros(900)]).astype(np.uint8)
    codes = np.column_stack([codes, codes[:, 0]])
    bins, g, h = Bins(codes), rng.normal(size=900), rng.random(900)
    assert len(bins.joint) == 2 and set(bins.feature) == {0, 1, 2, 3, 4, 5, 6}  # equal and constant columns are left out
    for rows in (None, np.flatnonzero(rng.random(900) < 0.4)):
        at = np.arange(900) if rows is None else rows
        sums = bins.of(g, h, rows)
        for i, (f, last) in enumerate(zip(bins.feature, bins.last)):
            mine = at[codes[at, f] == (last if f in (0, 6) else 1)]
            np.testing.assert_allclose(sums[:, 1 + i], [g[mine].sum(), h[mine].sum(), len(mine)], atol=1e-9)
    assert bins.cells == 2 * (BINS + 1)

def test_one_basis_serves_the_encoders_of_all_folds(spark):
    from tidemark.operators.encode import Basis, arrays, pieces
    from tidemark.operators.linear import PASS_ROWS, pass_sums, sigmoid
    from tidemark.plans import modelling

    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(range(5000))], ["x"])
    assert [len(b) for b in pieces(iter([batch]), 2048)] == [2048, 2048, 904] and PASS_ROWS <= 2048
    cfg = Model(weight="w", n_splits=3, n_repeats=2, min_category_frequency=0.3)
    jobs = [(r, k) for r in range(2) for k in range(3)]
    df = modelling.with_folds(model_rows(spark), cfg, [0, 1])
    encoders = fold_encoders(df, ["a", "b", "c"], ["kind"], 0.3, jobs, 3)
    assert any(rare for e in encoders for _, rare in e.levels.values()) and any("missing_" in n for e in encoders for n in e.names())
    vocabulary = vocabulary_of(encoders)
    rows = coded(df, ["a", "b", "c"], ["kind"], vocabulary).selectExpr("_folds", "_num", "_cat", "event AS _y", "w AS _w").localCheckpoint()
    num, cat, folds, y, w = arrays(rows.toArrow().combine_chunks().to_batches()[0], "_num", "_cat", "_folds", "_y", "_w")
    basis = Basis(encoders, vocabulary)
    width = 1 + max(len(e.names()) for e in encoders)
    at, factors = np.random.default_rng(11).normal(size=(6, width)), [(0.7, 1.9)] * 6
    found = pass_sums(rows, encoders, jobs, vocabulary, factors, at)
    for j, (e, (r, k)) in enumerate(zip(encoders, jobs)):
        x = np.column_stack([np.ones(len(num)), e.matrix(num, cat, vocabulary)])
        np.testing.assert_allclose(basis.matrix(num, cat) @ basis.of(e), x, atol=1e-9)
        mine, n = folds[:, r] != k, x.shape[1]
        z, t, eta = x[mine], y[mine], x[mine] @ at[j, :n]
        each, p = w[mine] * np.where(t == 1, 1.9, 0.7), sigmoid(eta)
        np.testing.assert_allclose(found[j, 0], (each * (np.logaddexp(0, eta) - t * eta)).sum(), rtol=1e-10)
        np.testing.assert_allclose(found[j, 1 : 1 + n], z.T @ (each * (p - t)), rtol=1e-9, atol=1e-8)
        np.testing.assert_allclose(found[j, 1 + width :].reshape(width, width)[:n, :n], (z * (each * p * (1 - p))[:, None]).T @ z, rtol=1e-9, atol=1e-8)


def test_no_two_jobs_meet_in_a_task(spark):
    from tidemark.operators.boosting import by_job

    rows = by_job(spark.range(1000).selectExpr("cast(id % 10 AS int) AS job"), 10)
    places = rows.groupBy("job").applyInPandas(lambda pdf: pdf.iloc[:1], "job int").select("job", F.spark_partition_id().alias("at")).collect()
    assert len(places) == 10 and len({r["at"] for r in places}) == 10


def test_trees_are_fitted_on_all_rows_whether_a_task_holds_them_or_not(spark, monkeypatch):
    from tidemark.operators import boosting
    from tidemark.plans import modelling

    df, cfg = model_rows(spark), Model(type="gbm", weight="w", gbm_max_iter=9, gbm_min_samples_leaf=10, n_splits=3, n_repeats=1)
    assert cfg.gbm_fit_rows is None
    scores = lambda: modelling.cross_validate(df, cfg)[0].select("repeat", "customer", "event", "score").toPandas().sort_values(["repeat", "customer", "score"]).to_numpy(float)
    within = scores()
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    np.testing.assert_allclose(scores(), within, rtol=0, atol=1e-9)


@pytest.mark.parametrize("depth", [3, None])
def test_passes_over_blocks_give_the_trees_of_one_task(spark, depth):
    from tidemark.operators.boosting import boost
    from tidemark.operators.boosting_passes import fit_in_passes, marked
    from tidemark.operators.encode import arrays
    from tidemark.sources.shared import ship, stored

    ship(spark)
    rng, n = np.random.default_rng(12), 24_000 if depth else 1500
    a, b, kind = rng.normal(size=n), rng.integers(0, 6, n), rng.choice(["u", "v", "w"], n)
    y = (rng.random(n) < 1 / (1 + np.exp(2 - a - 0.5 * b * (kind == "u")))).astype(int)
    rows = [(i, None if i % 7 == 0 else float(a[i]), float(b[i]), float(2 * b[i]), None if i % 3 else 4.0, f"r{i}" if i % 60 == 0 else str(kind[i]), int(y[i]), 0.5 + i % 3, [i // 5 % 2]) for i in range(n)]
    df = spark.createDataFrame(rows, "_r long, a double, b double, twice double, c double, kind string, _y int, _w double, _folds array<int>")
    jobs, numeric, rounds = [(0, 0), (0, 1)], ["a", "b", "twice", "c"], 40 if depth else 2
    encoders = fold_encoders(df, numeric, ["kind"], 0.02, jobs, 2)
    vocabulary = vocabulary_of(encoders)
    table = stored(coded(df, numeric, ["kind"], vocabulary).select("_r", "_num", "_cat", "_y", "_w", "_folds"), "test")
    found = fit_in_passes(table, encoders, jobs, vocabulary, 0.5, rounds, depth, 20, 1.0, 42)
    num, cat, t, w, kept, held = arrays(marked(table, encoders, jobs, 42).toArrow().combine_chunks().to_batches()[0], "_num", "_cat", "_y", "_w", "_kept", "_held")
    kept, held = kept.astype(bool), held.astype(bool)
    for j, e in enumerate(encoders):
        x, mine = e.matrix(num, cat, vocabulary), kept[:, j] | held[:, j]
        assert mine.sum() == e.rows and (0.09 < held[:, j].sum() / e.rows < 0.11 if depth else not held.any())
        want = boost(list(x[mine].T), t[mine], w[mine], 0.5, rounds, depth, 20, 1.0, 42, held=held[mine, j] if depth else None)
        assert len(found[j].feature) == len(want.feature) and (not depth or len(want.feature) < rounds)  # stopped early
        np.testing.assert_allclose(found[j].raw(x), want.raw(x), atol=1e-9)
        assert not found[j].uses([2])  # of equal columns the first is split


def test_the_fold_that_importance_looks_at_is_fitted_on_all_rows(spark, monkeypatch):
    from tidemark.operators import boosting
    from tidemark.plans import modelling

    df, cfg = model_rows(spark), Model(type="gbm", weight="w", gbm_max_iter=4, gbm_min_samples_leaf=10, n_splits=3, n_repeats=1)
    assert cfg.gbm_fit_rows is None
    scores = lambda: np.sort([r.score for r in modelling.cross_validate(df, cfg, last_only=True)[0].collect()])
    within = scores()
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    found = scores()
    assert 150 < len(found) < 250
    np.testing.assert_allclose(found, within, rtol=0, atol=1e-9)
