"""Anchors, features and datasets on small hand-written histories."""

from dataclasses import replace
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import REDUCERS, Columns, Numeric, Prep, prep_config
from tidemark.operators.anchors import anchor_facts, anchors, exclusions
from tidemark.operators.datasets import hazard_skeleton
from tidemark.operators.encode import column_roles
from tidemark.operators.features import build_features
from tidemark.operators.percentiles import apply_percentiles, count_values, fit_percentiles
from tidemark.operators.sampling import balanced, group_folds
from tidemark.plans.preprocess import extend_grid, load_grid, save_grid
from tidemark.sources.raw import in_order, ingest, read_csv, read_model_input, require, split_outcomes, strict_dates, typed

CFG = Prep(columns=Columns(tiebreak="tie"), extract_date="2020-01-01", horizon_months=12, min_acquisitions=1)
SCHEMA = "customer_id string, origination_date timestamp_ntz, tie int, product_type string, deposit_balance double, loan_balance double, credit_exposure double, target boolean"


def day(text):
    return datetime.fromisoformat(text) if text else None


def raw(spark, rows):
    """rows: (customer, date, target, tie, product, deposit)"""
    full = [(c, day(d), tie, product, deposit, None, None, target) for c, d, target, tie, product, deposit in rows]
    return ingest(spark.createDataFrame(full, SCHEMA), CFG)


def acq(c, d, tie=0, product="checking_basic", deposit=1.0):
    return (c, d, None, tie, product, deposit)


def out(c, d, target=True):
    return (c, d, target, None, None, None)


@pytest.fixture(scope="module")
def decided(spark):
    rows = [
        acq("same", "2015-01-01"), out("same", "2015-01-01"),
        acq("early", "2015-01-01"), out("early", "2014-01-01"),
        out("only", "2015-01-01"),
        acq("limit", "2015-01-31"), out("limit", "2016-01-01"),
        acq("past", "2015-01-31"), out("past", "2016-02-01"),
        acq("month", "2015-01-05"), out("month", "2015-01-20", False),
        acq("late", "2019-06-01"),
        acq("quiet", "2012-03-01"), acq("quiet", "2019-11-01"),
        acq("blind", None), acq(None, "2015-01-01"),
        acq("dateless", "2015-01-01"), out("dateless", None),
    ]
    facts = anchor_facts(raw(spark, rows), CFG).cache()
    return {d: {r.customer: r for r in anchors(facts, CFG, d).collect()} for d in ("fixed", "hazard")}, facts


def test_rules_of_the_fixed_design(decided):
    fixed = decided[0]["fixed"]
    assert set(fixed) == {"same", "early", "limit", "past", "month", "late", "quiet", "blind", "dateless"}
    reasons = {k: r.reason for k, r in fixed.items()}
    assert reasons["same"] == "no acquisition before outcome"
    assert reasons["early"] == "outcome precedes first acquisition"
    assert reasons["past"] == "outcome 13m beyond horizon" and not fixed["past"].keep and fixed["past"].anchor_date
    assert (fixed["limit"].keep, fixed["limit"].event, fixed["limit"].event_month) == (True, 1, 12)
    assert (fixed["month"].event, fixed["month"].event_month) == (1, 0)
    assert reasons["late"] == "censored: no acquisition before cutoff"
    assert fixed["quiet"].anchor_date == day("2012-03-01") and fixed["quiet"].event == 0
    assert not fixed["blind"].keep
    assert fixed["dateless"].event == 0


def test_rules_of_the_hazard_design(decided):
    hazard = decided[0]["hazard"]
    assert hazard["past"].keep and hazard["past"].event_month == 13
    assert hazard["late"].anchor_date == day("2019-06-01") and hazard["late"].event_month == 7
    assert not hazard["blind"].keep and hazard["blind"].reason == "no dated acquisition"


def test_exclusions_cover_both_designs(decided, spark):
    rows = exclusions(decided[1], CFG).groupBy("design").count().collect()
    assert {r.design: r["count"] for r in rows} == {"fixed": 5, "hazard": 3}


@pytest.mark.parametrize(("month", "event", "want"), [
    (0, 1, [(1, 0, 6, 0.167, 1)]), (2, 0, []), (3, 0, [(1, 0, 6, 0.5, 0)]), (13, 1, [(1, 0, 6, 1.0, 0), (2, 6, 12, 1.0, 0), (3, 12, 18, 0.167, 1)]),
    (-4, 0, []), (12, 0, [(1, 0, 6, 1.0, 0), (2, 6, 12, 1.0, 0)]),
])
def test_hazard_intervals(spark, month, event, want):
    one = spark.createDataFrame([("a", day("2015-01-01"), True, "x", event, month)], "customer string, anchor_date timestamp_ntz, keep boolean, reason string, event int, event_month int")
    got = [tuple(r)[1:] for r in hazard_skeleton(one, CFG).orderBy("interval").collect()]
    assert got == want


def test_event_at_the_cap_is_censored(spark):
    schema = "customer string, anchor_date timestamp_ntz, keep boolean, reason string, event int, event_month int"
    two = spark.createDataFrame([("at", day("2010-01-01"), True, "", 1, 60), ("under", day("2010-01-01"), True, "", 1, 59)], schema)
    events = {r.customer: r.e for r in hazard_skeleton(two, CFG).groupBy("customer").agg(F.sum("event").alias("e")).collect()}
    assert events == {"at": 0, "under": 1}


def test_features_see_nothing_after_the_anchor(spark):
    rows = raw(spark, [acq("a", "2015-01-10", 1, "jumbo_cd", 5.0), acq("a", "2015-03-01", 1, "auto_loan", -9.0), acq("a", "2015-03-01", 2, None, None), acq("a", "2016-01-01", 9, "heloc", 100.0)])
    kept = spark.createDataFrame([("a", day("2015-03-01"))], "customer string, anchor_date timestamp_ntz")
    cfg = replace(CFG, percentiles=False)
    f = build_features(split_outcomes(rows, cfg)[0], kept, cfg).first()
    assert f.agg_n_acquisitions == 3 and f.agg_tenure_months == 2
    assert f.pos1_product_type is None and f.pos1_product_family == "OTHER" and f.pos2_product_type == "auto_loan"
    assert f.agg_deposit_balance_sum == -4.0 and f.agg_deposit_balance_sum_log1p is None
    assert f.agg_loan_balance_sum is None
    assert (f.gap_1_2, f.gap_2_3, f.gap_3_4, f.bundle_count, f.gap_trend, f.gap_min) == (0, 2, None, 1, -2.0, 0.0)
    assert (f.pos3_present, f.pos4_present) == (1, 0)


def test_grid_matches_numpy_and_falls_back(spark):
    rng = np.random.default_rng(5)
    values = {"checking_basic": np.round(rng.lognormal(8, 1, 37), 2), "jumbo_cd": np.round(rng.lognormal(9, 1, 29), 2)}
    values["money_market"] = np.full(30, 7.0)
    rows = raw(spark, [acq("c", "2015-01-01", i, p, float(v)) for p, vs in values.items() for i, v in enumerate(vs)])
    acquired = split_outcomes(rows, CFG)[0]
    grid = fit_percentiles(acquired, CFG).cache()
    cells = {(r.level, tuple(r["keys"])): r for r in grid.where("column = 'deposit_balance'").collect()}
    for p, vs in values.items():
        assert cells[1, (p,)].n == len(vs)
        assert np.array_equal(cells[1, (p,)].edges, np.percentile(vs, np.arange(101)))
    ranked = apply_percentiles(acquired, grid, CFG, levels=True)
    used = {r.product_type: (r.lo, r.hi) for r in ranked.groupBy("product_type").agg(F.min("deposit_balance_level").alias("lo"), F.max("deposit_balance_level").alias("hi")).collect()}
    assert used["checking_basic"] == (0, 0) and used["jumbo_cd"] == (2, 2)  # 29 rows are too few; the family has 59
    assert {r[0] for r in ranked.where("product_type = 'money_market'").select("deposit_balance_pct").collect()} == {0.0}
    above = raw(spark, [acq("c", "2015-06-01", 0, "checking_basic", 1e9)])
    assert apply_percentiles(split_outcomes(above, CFG)[0], grid, CFG).first().deposit_balance_pct == 100.0


def test_empty_history(spark):
    rows = raw(spark, [])
    facts = anchor_facts(rows, CFG)
    assert anchors(facts, CFG, "fixed").count() == 0 and hazard_skeleton(anchors(facts, CFG, "hazard"), CFG).count() == 0


def test_csv_missing_values_and_checks(spark, tmp_path):
    (tmp_path / "in.csv").write_text("customer_id,origination_date,target,product_type,deposit_balance,loan_balance,credit_exposure\na,2015-01-01,,NA,12,x,NaN\n")
    cfg = Prep()
    row = ingest(read_csv(spark, str(tmp_path / "in.csv")), cfg).first()
    assert (row.product_type, row.product_family, row.deposit_balance, row.loan_balance, row.credit_exposure, row.target) == (None, "OTHER", 12.0, None, None, None)
    with pytest.raises(ValueError, match="nope"):
        require(spark.range(1), ["id", "nope", None], "x")
    with pytest.raises(ValueError, match="unknown aggregations"):
        prep_config({"numeric_columns": {"x": {"aggregations": ["mode"]}}})


def test_rows_of_several_files_keep_the_order_of_the_files(spark, tmp_path):
    header = "customer_id,origination_date,target,product_type,deposit_balance,loan_balance,credit_exposure\n"
    line = lambda n: f"c,2015-01-01,,checking_basic,{n},,\n"
    sizes = {"a": 3, "b": 3000, "c": 2}  # Spark reads the largest first
    n = 0
    for name, size in sizes.items():
        (tmp_path / f"{name}.csv").write_text(header + "".join(line(n + i) for i in range(size)))
        n += size
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = read_csv(spark, str(tmp_path)).orderBy("_row_idx").collect()
        assert [int(r.deposit_balance) for r in rows] == list(range(n))
        # the last rows of the input are the most recent ones of a day
        acquired, _ = split_outcomes(ingest(read_csv(spark, str(tmp_path)), Prep(percentiles=False)), Prep(percentiles=False))
        kept = spark.createDataFrame([("c", day("2016-01-01"))], "customer string, anchor_date timestamp_ntz")
        f = build_features(acquired, kept, Prep(percentiles=False)).first()
        assert [f[f"pos{p}_deposit_balance"] for p in (1, 2, 3, 4)] == [n - 1.0, n - 2.0, n - 3.0, n - 4.0]
        acquired.write.parquet(f"{tmp_path}/p.parquet")
        table = in_order(spark.read.parquet(f"{tmp_path}/p.parquet").drop("_row_idx"))
        assert table.select("_row_idx").distinct().count() == n
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_dates_are_of_one_form(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        def parsed(*texts):
            rows = strict_dates(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string"), "d").orderBy("i").collect()
            return [r.d for r in rows]

        assert parsed("2020-01-05", None, "2020-02-29") == [day("2020-01-05"), None, day("2020-02-29")]
        assert parsed("01/05/2020", "12/1/2020") == [day("2020-01-05"), day("2020-12-01")]
        assert parsed("01/05/2020", "13/05/2020") == [day("2020-05-01"), day("2020-05-13")]
        assert parsed("20200105") == [day("2020-01-05")] and parsed("2020-01-05T10:00:00.5") == [datetime(2020, 1, 5, 10, 0, 0, 500000)]
        assert parsed(None, None) == [None, None] and parsed() == []
        for bad in (["2020-01-05", "2020"], ["2020-01-05", "2020-1-5"], ["2020-01-05", "05/01/2020"], ["2020-02-30"], ["2020-01-05", "2020-01-05 10:00:00"], ["soon"]):
            with pytest.raises(ValueError, match="no form of dates"):
                parsed(*bad)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_types_of_a_model_input(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "whole,gaps,number,mixed,flag,flaggaps,day,none,exp,neg,text\n"
        "1,1,1.5,1,True,True,2020-01-01,NA,1e5,-3,a\n"
        "2,NA,NA,x,false,,2020-01-02,nan,.5,+4,NA\n"
        "3,3,nan,2,TRUE,False,,,inf,0,5x\n")  # fmt: skip
    df = read_model_input(spark, str(tmp_path / "in.csv"))
    assert dict(df.dtypes) == {
        "whole": "bigint", "gaps": "double", "number": "double", "mixed": "string", "flag": "boolean", "flaggaps": "string",
        "day": "string", "none": "double", "exp": "double", "neg": "bigint", "text": "string"}
    assert [tuple(r) for r in df.orderBy("whole").select("gaps", "number", "flag", "exp", "neg", "none").collect()] == [
        (1.0, 1.5, True, 1e5, -3, None), (None, None, False, 0.5, 4, None), (3.0, None, True, float("inf"), 0, None)]
    numeric, categorical, skipped = column_roles(df, {"whole"})
    assert numeric == ["gaps", "number", "flag", "none", "exp", "neg"] and categorical == ["mixed", "flaggaps", "day", "text"] and skipped == []
    assert typed(spark.range(2)).dtypes == [("id", "bigint")]


def test_grids_grow_by_new_extracts(spark, tmp_path):
    rng = np.random.default_rng(12)
    rows = [acq(f"c{i}", f"{2014 + i % 3}-0{1 + i % 9}-01", i, rng.choice(["checking_basic", "jumbo_cd", "unheard_of"]).item(), float(np.round(rng.lognormal(6, 2), 1)) if i % 8 else None) for i in range(600)]
    old, new, every = (split_outcomes(raw(spark, part), CFG)[0] for part in (rows[:400], rows[400:], rows))
    save_grid(count_values(old, CFG), CFG, f"{tmp_path}/one")
    extend_grid(f"{tmp_path}/one", new, CFG, f"{tmp_path}/two")
    key = lambda r: (r.column, r.level, tuple(r["keys"]))
    got, want = ({key(r): (r.n, r.edges) for r in g.collect()} for g in (load_grid(spark, f"{tmp_path}/two", CFG), fit_percentiles(every, CFG)))
    assert got == want and len(got) > 10
    kept = spark.read.parquet(f"{tmp_path}/two/values")
    assert kept.groupBy("column", "level", "keys", "value").count().where("count > 1").count() == 0
    for other in (replace(CFG, min_cell_size=31), replace(CFG, families={"jumbo_cd": "CARD"}), replace(CFG, default_family="REST")):
        with pytest.raises(ValueError, match="other settings"):
            load_grid(spark, f"{tmp_path}/one", other)
        with pytest.raises(ValueError, match="other settings"):
            extend_grid(f"{tmp_path}/one", new, other, f"{tmp_path}/three")


def test_reducers_equal_pandas(spark):
    import pandas as pd

    rng = np.random.default_rng(3)
    histories = {"none": [None, None], "one": [2.0], "two": [1.0, 4.0], "three": [1.0, None, 5.0, 6.5], "same": [3.0] * 5, "zeros": [0.0, 0.0, None]}
    histories |= {f"r{n}": [None if rng.random() < 0.2 else float(np.round(rng.lognormal(3, 1), 2)) for _ in range(n)] for n in (4, 9, 60)}
    hows = [h for h in REDUCERS if h not in ("count_nonnull",)]
    cfg = replace(CFG, percentiles=False, numerics={"deposit_balance": Numeric(aggregations=tuple(REDUCERS), log1p=False), "loan_balance": Numeric(), "credit_exposure": Numeric()})
    rows = [acq(c, f"2015-01-{1 + i // 3:02d}", i % 3, deposit=v) for c, vs in histories.items() for i, v in enumerate(vs)]
    kept = spark.createDataFrame([(c, day("2016-01-01")) for c in histories], "customer string, anchor_date timestamp_ntz")
    got = {r.customer: r for r in build_features(split_outcomes(raw(spark, rows), cfg)[0], kept, cfg).collect()}
    for c, vs in histories.items():
        clean = pd.Series(vs, dtype=float).dropna()
        assert got[c]["agg_deposit_balance_count_nonnull"] == len(clean)
        for how in hows:
            want = None if clean.empty else clean.iloc[{"first": 0, "last": -1}[how]] if how in ("first", "last") else float(getattr(clean, how)())
            value = got[c][f"agg_deposit_balance_{how}"]
            assert (value is None) if want is None or np.isnan(want) else value == pytest.approx(want, rel=1e-9, abs=1e-9), (c, how)


def test_folds_balance_rows_and_events_of_large_customers(spark):
    rng = np.random.default_rng(4)
    rows = [(c, int(rng.random() < 0.3)) for c in range(6) for _ in range(int(rng.integers(2000, 4000)))]
    rows += [(100 + i // 3, int(i % 30 == 0)) for i in range(3000)] + [(None, 1)] * 5
    got = group_folds(spark.createDataFrame(rows, "customer long, event int"), "customer", "event", 5, 42).collect()
    fold = {r.customer: r.fold for r in got}
    assert set(fold) == {c for c, _ in rows if c is not None} and len(got) == len(fold)
    sizes, events = np.zeros(5), np.zeros(5)
    for c, e in rows:
        if c is not None:
            sizes[fold[c]] += 1
            events[fold[c]] += e
    large = [sum(c == k for c, _ in rows) for k in range(6)]
    assert len({fold[c] for c in range(6)}) == 5 and sizes.max() - sizes.min() <= min(large) + max(large) - min(large) + 10
    small = group_folds(spark.createDataFrame(rows[-3005:], "customer long, event int"), "customer", "event", 5, 42).groupBy("fold").agg(F.count("*"), F.sum("has_event")).collect()
    assert {r[1] for r in small} == {200} and {r[2] for r in small} == {20}
    assert balanced([(9, 0, 1), (8, 0, 1), (7, 0, 1), (1, 0, 12)], 3) == {(9, 0): (0, [0]), (8, 0): (0, [1]), (7, 0): (0, [2]), (1, 0): (4, [])}
    assert balanced([], 5) == {}
