"""The engine's operators as queries over the driver's tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Model
from .functions.exprs import draw_sql, months
from .operators import metrics as M
from .operators.anchors import DESIGNS, anchor_facts, anchors
from .operators.anchors import exclusions as exclusion_report
from .operators.datasets import flat_dataset, hazard_dataset, hazard_skeleton
from .operators.encode import category_levels, column_roles
from .operators.encode import imputation_scaling as imputation_and_scaling
from .operators.features import build_features, visible
from .operators.percentiles import apply_percentiles, fit_percentiles
from .operators.sampling import downsample_negatives, group_folds
from .sources.raw import FAMILY, ORDERS, ingest, orders_as_raw, split_outcomes, strict_dates, typed
from .sources.shared import stored

CFG = ORDERS
SEED, FRACTION, SPLITS, BINS, LIFTS, CAL_BINS = 42, 0.25, 5, 4, (0.01, 0.05, 0.10), 5
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return ingest(orders_as_raw(spark, d), CFG)


def _acquired(spark: SparkSession, d: str) -> DataFrame:
    return split_outcomes(_raw(spark, d), CFG)[0]


def _anchors(spark: SparkSession, d: str, design: str) -> DataFrame:
    return anchors(anchor_facts(_raw(spark, d), CFG), CFG, design)


def _ranked(spark: SparkSession, d: str, levels: bool = False) -> DataFrame:
    acquired = _acquired(spark, d)
    return apply_percentiles(acquired, stored(fit_percentiles(acquired, CFG), "grid"), CFG, levels)


def _features(spark: SparkSession, d: str, design: str, cfg=CFG, ranked: bool = True) -> DataFrame:
    acquired = _ranked(spark, d) if ranked else _acquired(spark, d)
    return build_features(acquired, _anchors(spark, d, design).where("keep"), cfg)


def _predictions(spark: SparkSession, d: str) -> DataFrame:
    """Hazard rows of two repeats with a score that is a formula of customer, interval and repeat.

    A fixture: measures, calibration and lift of such scores, with all their ties, can be had
    from SQL as well; ``cv_metrics`` has the measures of a fitted model.
    """
    rows = hazard_skeleton(_anchors(spark, d, "hazard"), CFG).withColumn("repeat", F.explode(F.array(F.lit(0), F.lit(1))))
    score = F.pmod(F.col("customer") * 31 + F.col("interval") * 17 + F.col("repeat") * 7, F.lit(97)) / 1000 + 0.01
    return rows.select("repeat", "customer", "interval", score.alias("score"), "event")


def _scores(spark: SparkSession, d: str) -> DataFrame:
    out = M.survival_scores(_predictions(spark, d), "customer", "event", BINS)
    return out.withColumn("score", F.round("score", 6))


# ---- the same in SQL ---------------------------------------------------------------------

_DATE = f"TIMESTAMP '{CFG.extract_date}'"


def _month(a: str, b: str) -> str:
    return f"CAST((year({b}) - year({a})) * 12 + month({b}) - month({a}) AS INTEGER)"


_FAMILY_CASE = "CASE " + " ".join(f"WHEN product_type = '{k}' THEN '{v}'" for k, v in CFG.families.items()) + f" ELSE '{CFG.default_family}' END"

_RAW_SQL = f"""WITH kinds AS (
  SELECT o_custkey AS customer_id, o_orderdate AS origination_date, o_orderkey AS tie, o_totalprice AS price,
    CASE WHEN o_orderkey % 29 = 0 THEN true END AS target,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 997 < 4 THEN 'jumbo_cd' WHEN o_orderkey % 89 = 7 THEN 'exotic_note'
      WHEN o_orderstatus = 'F' AND o_orderpriority < '3' THEN 'savings_standard' WHEN o_orderstatus = 'F' THEN 'checking_basic'
      WHEN o_orderstatus = 'O' AND o_orderpriority < '3' THEN 'mortgage_fixed' WHEN o_orderstatus = 'O' THEN 'auto_loan'
      ELSE 'credit_card_rewards' END AS product_type FROM orders),
raw AS (SELECT customer_id, origination_date, tie, target, product_type,
    CASE WHEN product_type IN ('jumbo_cd', 'exotic_note', 'savings_standard', 'checking_basic') THEN price END AS deposit_balance,
    CASE WHEN product_type IN ('mortgage_fixed', 'auto_loan') THEN price WHEN product_type = 'credit_card_rewards' THEN 0.0 END AS loan_balance,
    CASE WHEN product_type = 'credit_card_rewards' THEN price END AS credit_exposure,
    CASE WHEN target IS NULL THEN {_FAMILY_CASE} END AS product_family FROM kinds),
acq AS (SELECT * FROM raw WHERE target IS NULL),
outcomes AS (SELECT customer_id, min(origination_date) AS outcome FROM raw WHERE target IS NOT NULL GROUP BY 1),
facts AS (SELECT a.customer_id AS customer, count(*) AS n, any_value(o.outcome) AS outcome, min(origination_date) AS first, max(origination_date) AS last,
    max(origination_date) FILTER (origination_date < o.outcome) AS before,
    max(origination_date) FILTER (origination_date <= {_DATE} - INTERVAL {CFG.horizon_months} MONTH) AS by_cutoff
  FROM acq a LEFT JOIN outcomes o USING (customer_id) GROUP BY 1),
"""


def _anchor_sql(design: str) -> str:
    fixed = design == "fixed"
    gap = _month("before", "outcome")
    cases = [
        (f"n < {CFG.min_acquisitions}", "false", "NULL", "'too few acquisitions'", "NULL"),
        ("outcome < first", "false", "NULL", "'outcome precedes first acquisition'", "NULL"),
        ("outcome IS NOT NULL AND before IS NULL", "false", "NULL", "'no acquisition before outcome'", "NULL"),
        *([(f"outcome IS NOT NULL AND {gap} > {CFG.horizon_months}", "false", "before", f"'outcome ' || {gap} || 'm beyond horizon'", "NULL")] if fixed else []),
        ("outcome IS NOT NULL", "true", "before", "'event'", "1"),
        *([("by_cutoff IS NULL", "false", "NULL", "'censored: no acquisition before cutoff'", "NULL")] if fixed else []),
        ("true", "true", "by_cutoff" if fixed else "last", "'censored'", "0"),
    ]
    pick = lambda i: "CASE " + " ".join(f"WHEN {c[0]} THEN {c[i]}" for c in cases) + " END"
    return f"""{design}_a AS (SELECT customer, outcome, CAST({pick(2)} AS TIMESTAMP) AS anchor_date, {pick(1)} AS keep, {pick(3)} AS reason,
  CAST({pick(4)} AS INTEGER) AS event FROM facts),
{design} AS (SELECT customer, anchor_date, keep, reason, event,
  CASE WHEN event = 1 THEN {_month('anchor_date', 'outcome')} WHEN event = 0 THEN {_month('anchor_date', _DATE)} END AS event_month FROM {design}_a),
"""


_BOTH_SQL = _RAW_SQL + _anchor_sql("fixed") + _anchor_sql("hazard")


def _hist_sql(design: str, source: str = "acq") -> str:
    return f"""hist AS (SELECT a.*, f.customer, f.anchor_date, row_number() OVER (PARTITION BY f.customer ORDER BY origination_date DESC, tie DESC) AS rn
  FROM {source} a JOIN {design} f ON a.customer_id = f.customer AND f.keep WHERE a.origination_date <= f.anchor_date),
"""


def _log(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN round(ln(1 + {x}), 6) END"


def _history_sql(by_family: bool = False) -> list[str]:
    out = ["count(*) AS agg_n_acquisitions", f"{_month('min(origination_date)', 'any_value(anchor_date)')} AS agg_tenure_months"]
    out += [f"count(*) FILTER (product_family = '{f}') AS \"agg_n_{f}\"" for f in CFG.family_list]
    for name, spec in CFG.numerics.items():
        for how in spec.aggregations:
            out.append(f"round({how}({name}), 6) AS agg_{name}_{how}")
            if spec.log1p:
                out.append(f"{_log(f'{how}({name})')} AS agg_{name}_{how}_log1p")
            if by_family:
                out += [f"round({how}({name}) FILTER (product_family = '{f}'), 6) AS \"agg_{name}_{f}_{how}\"" for f in CFG.family_list]
    return out


def _position_sql(percentiles: bool = True) -> list[str]:
    at = lambda p, x: f"max({x}) FILTER (rn = {p})"
    out = [f"CAST(least(count(*), {CFG.window}) AS INTEGER) AS n_acquisitions_in_window"]
    for p in range(1, CFG.window + 1):
        out += [f"{at(p, x)} AS pos{p}_{x}" for x in CFG.carry]
        out += [f"{at(p, f'{x}_pct')} AS pos{p}_{x}_pct" for x in CFG.carry_percentiles] if percentiles else []
        out.append(f"CAST(count(*) >= {p} AS INTEGER) AS pos{p}_present")
    return out


_GAPS = [f"gap_{p}_{p + 1}" for p in range(1, CFG.window)]


def _gap_sql() -> list[str]:
    at = lambda p: f"max(origination_date) FILTER (rn = {p})"
    return [f"{_month(at(p + 1), at(p))} AS gap_{p}_{p + 1}" for p in range(1, CFG.window)]


_GAP_LIST = f"list_filter([{', '.join(_GAPS)}], lambda g: g IS NOT NULL)"
_GAP_SUMMARY = f"""round(list_avg({_GAP_LIST}), 6) AS gap_mean, CAST(list_min({_GAP_LIST}) AS DOUBLE) AS gap_min,
  CASE WHEN len({_GAP_LIST}) > 1 THEN CAST({_GAP_LIST}[1] - {_GAP_LIST}[-1] AS DOUBLE) END AS gap_trend,
  CAST(len(list_filter([{', '.join(_GAPS)}], lambda g: g = 0)) AS INTEGER) AS bundle_count"""


def _edges_sql(values: str, parts: str) -> str:
    p, s = f"((len({values}) - 1) * {parts})", values
    a, b, t = f"{s}[CAST(floor({p}) AS BIGINT) + 1]", f"{s}[least(CAST(floor({p}) AS BIGINT) + 1, len({s}) - 1) + 1]", f"({p} - floor({p}))"
    return f"CASE WHEN {t} >= 0.5 THEN {b} - ({b} - {a}) * (1 - {t}) ELSE {a} + ({b} - {a}) * {t} END"


_GRID_PARTS = []
for _name, _spec in CFG.numerics.items():
    for _i, _level in enumerate(_spec.percentile_group or ()):
        _ks = ["CAST(year(origination_date) AS VARCHAR)" if k == "year" else k for k in _level]
        _GRID_PARTS.append(f"SELECT '{_name}' AS \"column\", {_i} AS level, [{', '.join(_ks)}] AS keys, list({_name} ORDER BY {_name}) AS v FROM acq WHERE {_name} IS NOT NULL GROUP BY 3")
_GRID_SQL = f"""cells AS ({' UNION ALL '.join(_GRID_PARTS)}),
grid AS (SELECT "column", CAST(level AS INTEGER) AS level, keys, CAST(len(v) AS BIGINT) AS n,
  list_transform(range(0, 101), lambda k: {_edges_sql('v', "(k / CAST(100 AS DOUBLE))")}) AS edges FROM cells),
"""


def _ranked_sql() -> str:
    joins, columns = [], []
    for name, spec in CFG.numerics.items():
        if not spec.percentile_group:
            continue
        edges, levels = [], []
        for i, level in enumerate(spec.percentile_group):
            ks = ["CAST(year(origination_date) AS VARCHAR)" if k == "year" else k for k in level]
            g = f"g_{name}_{i}"
            joins.append(f"LEFT JOIN grid {g} ON {g}.\"column\" = '{name}' AND {g}.level = {i} AND {g}.n >= {CFG.min_cell_size} AND {g}.keys = [{', '.join(ks)}]")
            edges.append(f"{g}.edges")
            levels.append(f"WHEN {g}.edges IS NOT NULL THEN {i}")
        columns.append(f"CASE WHEN {name} IS NOT NULL THEN CAST(least(100, len(list_filter(coalesce({', '.join(edges)}), lambda e: e < {name}))) AS DOUBLE) END AS {name}_pct")
        columns.append(f"CAST(CASE WHEN {name} IS NULL THEN NULL {' '.join(levels)} END AS INTEGER) AS {name}_level")
    return f"ranked AS (SELECT acq.*, {', '.join(columns)} FROM acq {' '.join(joins)}),\n"


def _feature_sql(design: str) -> str:
    return _hist_sql(design, "ranked") + f"""wide AS (SELECT customer, {', '.join([*_history_sql(), *_position_sql(), *_gap_sql()])} FROM hist GROUP BY 1),
features AS (SELECT *, {_GAP_SUMMARY} FROM wide),
"""


_w, _cap = CFG.bin_months, CFG.max_followup_months
_SKELETON_SQL = f"""spans AS (SELECT customer, greatest(0, least(event_month, {_cap})) AS m, event FROM hazard WHERE keep),
counted AS (SELECT customer, m, event = 1 AND m < {_cap} AS ev, greatest(1, CAST(ceil(m / {_w}.0) AS INTEGER)) AS n FROM spans),
opened AS (SELECT *, CAST(unnest(range(1, n + 1)) AS INTEGER) AS "interval" FROM counted),
exposed AS (SELECT *, "interval" = n AS is_last, CASE WHEN "interval" = n THEN greatest(least(m - ("interval" - 1) * {_w}, {_w}) / CAST({_w} AS DOUBLE), 1.0 / {_w}) ELSE 1.0 END AS e FROM opened),
skeleton AS (SELECT customer, "interval", CAST(("interval" - 1) * {_w} AS INTEGER) AS months_low, CAST("interval" * {_w} AS INTEGER) AS months_high,
  CAST(round_even(e, 3) AS DOUBLE) AS exposure_frac, CAST(is_last AND ev AS INTEGER) AS event FROM exposed WHERE NOT (is_last AND NOT ev AND e < {CFG.min_exposure_frac})),
"""
_PRED_SQL = _BOTH_SQL + _SKELETON_SQL + """preds AS (SELECT r AS repeat, customer, "interval",
  CAST((customer * 31 + "interval" * 17 + r * 7) % 97 AS DOUBLE) / 1000 + 0.01 AS score, event FROM skeleton, (SELECT unnest([0, 1]) AS r)),
"""
_SCORE_SQL = _PRED_SQL + f"""scores AS (SELECT CAST(repeat AS INTEGER) AS repeat, customer, round(1 - product(1 - score), 6) AS score, max(event) AS actual FROM preds
  WHERE "interval" <= {BINS} GROUP BY 1, 2 HAVING max(event) = 1 OR max("interval") >= {BINS}),
"""
_lifts = ", ".join(
    f"(avg(actual) FILTER (rn <= greatest(1, CAST(round_even(n * {f}, 0) AS BIGINT)))) / avg(actual) AS \"{M.lift_name(f)}\"" for f in LIFTS)
_METRIC_SQL = _SCORE_SQL + f"""steps AS (SELECT repeat, score, CAST(sum(actual) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS k, sum(pow(score - actual, 2)) AS b FROM scores GROUP BY 1, 2),
curve AS (SELECT *, sum(p) OVER w AS tp, sum(k) OVER w AS seen, sum(p) OVER (PARTITION BY repeat) AS pos, sum(k) OVER (PARTITION BY repeat) AS n FROM steps
  WINDOW w AS (PARTITION BY repeat ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
curves AS (SELECT repeat, CAST(any_value(n) AS BIGINT) AS n_customers, CAST(any_value(pos) AS BIGINT) AS n_events, any_value(pos / n) AS prevalence,
  sum(p * tp / seen) / any_value(pos) AS pr_auc, sum((k - p) * (tp - p / 2)) / any_value(pos * (n - pos)) AS roc_auc, sum(b) / any_value(n) AS brier FROM curve WHERE pos > 0 GROUP BY 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY repeat ORDER BY score DESC, customer) AS rn, count(*) OVER (PARTITION BY repeat) AS n FROM scores),
lifts AS (SELECT repeat, {_lifts} FROM placed GROUP BY 1),
metrics AS (SELECT * FROM curves JOIN lifts USING (repeat)),
"""
_METRICS = ["n_customers", "n_events", "prevalence", "pr_auc", "roc_auc", "brier", *[M.lift_name(f) for f in LIFTS]]


def _select(prefix: str, body: str) -> str:
    return prefix.rstrip().rstrip(",") + "\n" + body


# ---- the queries ---------------------------------------------------------------------------


@query(_select(_RAW_SQL, "SELECT customer_id, origination_date, tie, product_type, product_family, deposit_balance, loan_balance, credit_exposure FROM acq"))
def raw_acquisitions(spark: SparkSession, d: str) -> DataFrame:
    return _acquired(spark, d).select("customer_id", "origination_date", "tie", "product_type", FAMILY, "deposit_balance", "loan_balance", "credit_exposure")


@query(_select(_RAW_SQL, "SELECT product_family, target IS NOT NULL AS is_outcome, count(*) AS n, count(DISTINCT customer_id) AS customers FROM raw GROUP BY 1, 2"))
def family_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = _raw(spark, d).groupBy(FAMILY, F.col("target").isNotNull().alias("is_outcome"))
    return rows.agg(F.count("*").alias("n"), F.countDistinct("customer_id").alias("customers"))


@query(_select(_BOTH_SQL, "SELECT * FROM fixed"))
def anchors_fixed(spark: SparkSession, d: str) -> DataFrame:
    return _anchors(spark, d, "fixed")


@query(_select(_BOTH_SQL, "SELECT * FROM hazard"))
def anchors_hazard(spark: SparkSession, d: str) -> DataFrame:
    return _anchors(spark, d, "hazard")


@query(_select(_BOTH_SQL, """SELECT d AS design, reason, keep, count(*) AS customers, CAST(sum(event) AS BIGINT) AS events FROM
  (SELECT 'fixed' AS d, * FROM fixed UNION ALL SELECT 'hazard' AS d, * FROM hazard) GROUP BY 1, 2, 3"""))  # fmt: skip
def eligibility_summary(spark: SparkSession, d: str) -> DataFrame:
    facts = anchor_facts(_raw(spark, d), CFG)
    both = [anchors(facts, CFG, x).select(F.lit(x).alias("design"), "reason", "keep", "event") for x in DESIGNS]
    rows = both[0].unionByName(both[1]).groupBy("design", "reason", "keep")
    return rows.agg(F.count("*").alias("customers"), F.sum("event").alias("events"))


@query(_select(_BOTH_SQL, "SELECT 'fixed' AS design, customer, reason FROM fixed WHERE NOT keep UNION ALL SELECT 'hazard', customer, reason FROM hazard WHERE NOT keep"))
def exclusions(spark: SparkSession, d: str) -> DataFrame:
    return exclusion_report(anchor_facts(_raw(spark, d), CFG), CFG)


@query(_select(_BOTH_SQL + _hist_sql("fixed"), f"SELECT customer, {', '.join(_history_sql())} FROM hist GROUP BY 1"))
def agg_history(spark: SparkSession, d: str) -> DataFrame:
    f = _features(spark, d, "fixed", ranked=False, cfg=_plain())
    return rounded(f.select("customer", *[c for c in f.columns if c.startswith("agg_")]))


def _plain(**more):
    from dataclasses import replace

    return replace(CFG, percentiles=False, **more)


@query(_select(_BOTH_SQL + _hist_sql("hazard"), "SELECT customer, product_family, count(*) AS n, round(sum(deposit_balance), 6) AS deposit, round(max(loan_balance), 6) AS loan FROM hist GROUP BY 1, 2"))
def agg_by_family(spark: SparkSession, d: str) -> DataFrame:
    rows = visible(_acquired(spark, d), _anchors(spark, d, "hazard").where("keep"), CFG).groupBy("customer", FAMILY)
    return rounded(rows.agg(F.count("*").alias("n"), F.sum("deposit_balance").alias("deposit"), F.max("loan_balance").alias("loan")))


@query(_select(_BOTH_SQL + _hist_sql("fixed"), f"SELECT customer, {', '.join(_history_sql(by_family=True))} FROM hist GROUP BY 1"))
def agg_numerics_by_family(spark: SparkSession, d: str) -> DataFrame:
    f = _features(spark, d, "fixed", ranked=False, cfg=_plain(numerics_by_family=True))
    return rounded(f.select("customer", *[c for c in f.columns if c.startswith("agg_")]))


_REDUCED = ("mean", "count_nonnull", "min", "median", "std", "var", "nunique", "prod")
_REDUCED_SQL = {"mean": "avg", "count_nonnull": "count", "std": "stddev_samp", "var": "var_samp", "nunique": "count(DISTINCT ", "prod": "product"}


def _reduced_sql(column: str) -> list[str]:
    out = []
    for how in _REDUCED:
        fn = _REDUCED_SQL.get(how, how)
        value = f"{fn}{column})" if fn.endswith(" ") else f"{fn}({column})"
        value = f"nullif({value}, 0)" if how == "nunique" else value
        value = f"CASE WHEN {value} > 0 THEN round(log10({value}), 4) END" if how == "prod" else f"round({value}, {0 if how == 'var' else 6})"
        out.append(f"{value} AS agg_{column}_{how}")
    return [*out, f"CASE WHEN avg({column}) >= 0 THEN round(ln(1 + avg({column})), 6) END AS agg_{column}_mean_log1p"]


@query(_select(_BOTH_SQL + _hist_sql("fixed"), f"SELECT customer, {', '.join([*_reduced_sql('deposit_balance'), *_reduced_sql('loan_balance')])} FROM hist GROUP BY 1"))
def agg_reducers(spark: SparkSession, d: str) -> DataFrame:
    """Every other reducer that may be named; products are shown by their logarithm and variances without places."""
    from .config import Numeric

    both = ("deposit_balance", "loan_balance")
    f = _features(spark, d, "fixed", ranked=False, cfg=_plain(numerics={c: Numeric(aggregations=_REDUCED) for c in both}))
    f = f.withColumns({f"agg_{c}_prod": F.round(F.log10(f"agg_{c}_prod"), 4) for c in both} | {f"agg_{c}_var": F.round(f"agg_{c}_var", 0) for c in both})
    return rounded(f.select("customer", *[c for c in f.columns if c.startswith("agg_deposit") or c.startswith("agg_loan")]))


_MOMENTS = ("skew", "kurt", "sem", "any", "all", "first", "last", "count")


def _moment_sql(c: str) -> list[str]:
    """Central moments of the centred column c_<c>, whose count is n_<c>."""
    n, m = f"CAST(count({c}) AS DOUBLE)", [f"sum(pow(c_{c}, {k}))" for k in (2, 3, 4)]
    skew = f"CASE WHEN {n} >= 3 THEN CASE WHEN min({c}) = max({c}) THEN 0 ELSE {n} * sqrt({n} - 1) / ({n} - 2) * {m[1]} / pow({m[0]}, 1.5) END END"
    kurt = f"CASE WHEN {n} >= 4 THEN CASE WHEN min({c}) = max({c}) THEN 0 ELSE {n} * ({n} + 1) * ({n} - 1) * {m[2]} / (({n} - 2) * ({n} - 3) * {m[0]} * {m[0]}) - 3 * pow({n} - 1, 2) / (({n} - 2) * ({n} - 3)) END END"
    sql = {
        "skew": f"round({skew}, 4)", "kurt": f"round({kurt}, 4)", "sem": f"round(stddev_samp({c}) / sqrt({n}), 4)",
        "any": f"CAST(max(CAST({c} <> 0 AS INTEGER)) AS DOUBLE)", "all": f"CAST(min(CAST({c} <> 0 AS INTEGER)) AS DOUBLE)",
        "first": f"arg_max({c}, rn) FILTER ({c} IS NOT NULL)", "last": f"arg_min({c}, rn) FILTER ({c} IS NOT NULL)", "count": f"CASE WHEN {n} > 0 THEN {n} END",
    }
    return [f"{sql[how]} AS agg_{c}_{how}" for how in _MOMENTS]


_CENTRED = "centred AS (SELECT *, " + ", ".join(f"{c} - avg({c}) OVER (PARTITION BY customer) AS c_{c}" for c in ("deposit_balance", "loan_balance")) + " FROM hist),"


@query(_select(_BOTH_SQL + _hist_sql("hazard") + _CENTRED, f"SELECT customer, {', '.join([*_moment_sql('deposit_balance'), *_moment_sql('loan_balance')])} FROM centred GROUP BY 1"))
def agg_moments(spark: SparkSession, d: str) -> DataFrame:
    """Reducers of higher moments and of order."""
    from .config import Numeric

    both = ("deposit_balance", "loan_balance")
    f = _features(spark, d, "hazard", ranked=False, cfg=_plain(numerics={c: Numeric(aggregations=_MOMENTS, log1p=False) for c in both}))
    return rounded(f.select("customer", *[c for c in f.columns if c.startswith("agg_deposit") or c.startswith("agg_loan")]), 4)


@query(_select(_BOTH_SQL + _hist_sql("hazard"), f"SELECT customer, {', '.join(_position_sql(percentiles=False))} FROM hist GROUP BY 1"))
def sequence_positions(spark: SparkSession, d: str) -> DataFrame:
    f = _features(spark, d, "hazard", ranked=False, cfg=_plain())
    return f.select("customer", "n_acquisitions_in_window", *[c for c in f.columns if c.startswith("pos") and not c.endswith("_pct")])


@query(_select(_BOTH_SQL + _hist_sql("hazard") + f"wide AS (SELECT customer, {', '.join(_gap_sql())} FROM hist GROUP BY 1),", f"SELECT *, {_GAP_SUMMARY} FROM wide"))
def sequence_gaps(spark: SparkSession, d: str) -> DataFrame:
    f = _features(spark, d, "hazard", ranked=False, cfg=_plain())
    return rounded(f.select("customer", *_GAPS, "gap_mean", "gap_min", "gap_trend", "bundle_count"))


@query(_select(_RAW_SQL + _GRID_SQL, """SELECT "column", level, array_to_string(keys, '|') AS label, n, CAST(k AS INTEGER) AS k, edges[k + 1] AS edge FROM grid, (SELECT unnest(range(0, 101)) AS k)"""))
def percentile_grid(spark: SparkSession, d: str) -> DataFrame:
    grid = fit_percentiles(_acquired(spark, d), CFG)
    return grid.select("column", "level", F.concat_ws("|", "keys").alias("label"), "n", F.posexplode("edges").alias("k", "edge"))


@query(_select(_RAW_SQL + _GRID_SQL + _ranked_sql(), "SELECT tie, customer_id, deposit_balance_pct, loan_balance_pct FROM ranked"))
def percentile_apply(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d).select("tie", "customer_id", "deposit_balance_pct", "loan_balance_pct")


@query(_select(_RAW_SQL + _GRID_SQL + _ranked_sql(), "SELECT product_type, deposit_balance_level, loan_balance_level, count(*) AS n FROM ranked GROUP BY 1, 2, 3"))
def percentile_fallback_level(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d, levels=True).groupBy("product_type", "deposit_balance_level", "loan_balance_level").agg(F.count("*").alias("n"))


@query(_select(_BOTH_SQL + _GRID_SQL + _ranked_sql() + _feature_sql("fixed"), "SELECT f.customer, a.anchor_date, a.event AS label, f.* EXCLUDE (customer) FROM features f JOIN fixed a ON f.customer = a.customer AND a.keep"))
def flat(spark: SparkSession, d: str) -> DataFrame:
    return rounded(flat_dataset(_features(spark, d, "fixed"), _anchors(spark, d, "fixed")))


@query(_select(_BOTH_SQL + _SKELETON_SQL, "SELECT * FROM skeleton"))
def hazard_intervals(spark: SparkSession, d: str) -> DataFrame:
    return hazard_skeleton(_anchors(spark, d, "hazard"), CFG)


@query(_select(_BOTH_SQL + _GRID_SQL + _ranked_sql() + _feature_sql("hazard") + _SKELETON_SQL, "SELECT s.*, f.* EXCLUDE (customer) FROM skeleton s JOIN features f USING (customer)"))
def hazard(spark: SparkSession, d: str) -> DataFrame:
    return rounded(hazard_dataset(_features(spark, d, "hazard"), _anchors(spark, d, "hazard"), CFG))


_DRAW = draw_sql("customer", SEED)


@query(_select(_BOTH_SQL + _SKELETON_SQL + f"ever AS (SELECT customer, max(event) AS ever FROM skeleton GROUP BY 1),",
    f"SELECT customer, \"interval\", CAST(CASE WHEN ever = 1 THEN 1.0 ELSE {1 / FRACTION} END AS DOUBLE) AS weight FROM skeleton JOIN ever USING (customer) WHERE ever = 1 OR {_DRAW} < {FRACTION * 4294967296}"))
def downsample_weights(spark: SparkSession, d: str) -> DataFrame:
    rows = downsample_negatives(hazard_intervals(spark, d), "customer", "event", FRACTION, SEED)
    return rows.select("customer", "interval", F.col("_sample_weight").alias("weight"))


_FOLDS_SQL = _BOTH_SQL.replace("WITH kinds", "WITH RECURSIVE kinds") + _SKELETON_SQL + f"""people AS (SELECT customer, max(event) AS has_event, count(*) AS r, sum(event) AS e FROM skeleton GROUP BY 1),
turns AS (SELECT *, row_number() OVER (PARTITION BY r, e ORDER BY {_DRAW}, customer) - 1 AS t, count(*) OVER (PARTITION BY r, e) // {SPLITS} * {SPLITS} AS even FROM people),
totals AS (SELECT greatest(1, CAST(sum(r - e) AS HUGEINT)) AS n, greatest(1, CAST(sum(e) AS HUGEINT)) AS p FROM people),
items AS (SELECT row_number() OVER (ORDER BY r DESC, e DESC, t) AS i, customer, CAST(r - e AS HUGEINT) AS a, CAST(e AS HUGEINT) AS b FROM turns WHERE t >= even),
walk AS (SELECT CAST(0 AS BIGINT) AS i, CAST([{', '.join('0' * SPLITS)}] AS HUGEINT[]) AS x, CAST([{', '.join('0' * SPLITS)}] AS HUGEINT[]) AS y, CAST(-1 AS BIGINT) AS customer, CAST(-1 AS BIGINT) AS fold
  UNION ALL SELECT i, list_transform(x, lambda v, k: v + CASE WHEN k = f + 1 THEN a ELSE 0 END), list_transform(y, lambda v, k: v + CASE WHEN k = f + 1 THEN b ELSE 0 END), customer, f FROM (
    SELECT items.i, x, y, items.a, items.b, items.customer, list_sort(list_transform(range(0, {SPLITS}), lambda k: [x[k + 1] * a * p * p + y[k + 1] * b * n * n, x[k + 1] + y[k + 1], k]))[1][3] AS f
    FROM walk JOIN items ON items.i = walk.i + 1, totals)),
"""


@query(_select(_FOLDS_SQL, f"SELECT customer, has_event, CAST(CASE WHEN t < even THEN t % {SPLITS} ELSE w.fold END AS INTEGER) AS fold FROM turns LEFT JOIN walk w USING (customer)"))
def stratified_group_folds(spark: SparkSession, d: str) -> DataFrame:
    return group_folds(hazard_intervals(spark, d), "customer", "event", SPLITS, SEED)


@query(_select(_SCORE_SQL, "SELECT * FROM scores"))
def survival_score(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d)


def _metric(name: str) -> str:
    return _select(_METRIC_SQL, f'SELECT repeat, round("{name}", 6) AS "{name}" FROM metrics')


@query(_metric("pr_auc"))
def pr_auc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.ranking_metrics(_scores(spark, d), "customer", []).select("repeat", "pr_auc"))


@query(_metric("roc_auc"))
def roc_auc(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.ranking_metrics(_scores(spark, d), "customer", []).select("repeat", "roc_auc"))


@query(_metric("brier"))
def brier(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.ranking_metrics(_scores(spark, d), "customer", []).select("repeat", "brier"))


@query(_select(_METRIC_SQL, "SELECT repeat, " + ", ".join(f'round("{M.lift_name(f)}", 6) AS "{M.lift_name(f)}"' for f in LIFTS) + " FROM metrics"))
def lift_at(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.ranking_metrics(_scores(spark, d), "customer", LIFTS).select("repeat", *[f"`{M.lift_name(f)}`" for f in LIFTS]))


@query(_select(_METRIC_SQL, " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(avg(\"{m}\"), 6) AS mean, round(stddev_samp(\"{m}\"), 6) AS std, round(CAST(min(\"{m}\") AS DOUBLE), 6) AS min, round(CAST(max(\"{m}\") AS DOUBLE), 6) AS max FROM metrics" for m in _METRICS)))
def metrics_summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.summary(M.ranking_metrics(_scores(spark, d), "customer", LIFTS)))


@query(_select(_SCORE_SQL + f"""s AS (SELECT list(score ORDER BY score) AS v FROM scores),
edges AS (SELECT list_sort(list_distinct(list_transform(range(0, {CAL_BINS + 1}), lambda k: {_edges_sql('v', f"(k / CAST({CAL_BINS} AS DOUBLE))")}))) AS e FROM s),""",
    "SELECT CAST(greatest(len(list_filter(e, lambda x: x < score)) - 1, 0) AS INTEGER) AS bin, count(*) AS n, round(avg(score), 6) AS mean_predicted, round(avg(actual), 6) AS observed_rate FROM scores, edges WHERE len(e) > 1 GROUP BY 1"))
def calibration(spark: SparkSession, d: str) -> DataFrame:
    return rounded(M.calibration(_scores(spark, d), CAL_BINS))


_NUMERIC = ["agg_n_acquisitions", "agg_tenure_months", "agg_deposit_balance_sum", "agg_credit_exposure_sum", "pos2_loan_balance", "gap_mean"]
_CATEGORIC = ["pos1_product_type", "pos2_product_family"]
_WIDE_SQL = _BOTH_SQL + _hist_sql("hazard") + f"wide0 AS (SELECT customer, {', '.join([*_history_sql(), *_position_sql(percentiles=False), *_gap_sql()])} FROM hist GROUP BY 1), wide AS (SELECT *, {_GAP_SUMMARY} FROM wide0),"


def _wide(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_features(spark, d, "hazard", ranked=False, cfg=_plain()))


@query(_select(_WIDE_SQL + "tall AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM wide" for c in _NUMERIC) + """),
mid AS (SELECT feature, coalesce(median(value), 0) AS median, count(*) - count(value) AS n_missing FROM tall GROUP BY 1),
filled AS (SELECT feature, median, n_missing, coalesce(value, median) AS v FROM tall JOIN mid USING (feature)),""",
    "SELECT feature, round(any_value(median), 4) AS median, any_value(n_missing) AS n_missing, round(avg(v), 4) AS mean, round(CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1 END, 4) AS scale FROM filled GROUP BY 1"))
def imputation_scaling(spark: SparkSession, d: str) -> DataFrame:
    return rounded(imputation_and_scaling(_wide(spark, d), _NUMERIC), 4)


@query(_select(_WIDE_SQL + "tall AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce({c}, 'MISSING') AS level FROM wide" for c in _CATEGORIC) + "),",
    "SELECT feature, level, count(*) AS n, count(*) >= 0.01 * (SELECT count(*) FROM wide) AS frequent FROM tall GROUP BY 1, 2"))
def onehot_infrequent(spark: SparkSession, d: str) -> DataFrame:
    return category_levels(_wide(spark, d), _CATEGORIC, 0.01)


_TYPES_SQL = f"""SELECT CASE WHEN column_name = 'interval' OR column_type = 'VARCHAR' THEN 'categorical'
  WHEN column_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT', 'HUGEINT', 'FLOAT', 'DOUBLE', 'BOOLEAN') THEN 'numeric' ELSE 'skipped' END AS role, column_name AS feature
FROM (DESCRIBE {ORACLE_SQL["hazard"]}) WHERE column_name NOT IN ('customer', 'event', 'exposure_frac', 'anchor_date', 'months_low', 'months_high')"""


@query(_TYPES_SQL)
def column_types(spark: SparkSession, d: str) -> DataFrame:
    found = column_roles(hazard(spark, d), {"customer", "event", "exposure_frac", "anchor_date", "months_low", "months_high"}, ("interval",))
    rows = [(role, name) for role, names in zip(("numeric", "categorical", "skipped"), found) for name in names]
    return spark.createDataFrame(rows, "role string, feature string")


@query(_TYPES_SQL)
def inferred_types(spark: SparkSession, d: str) -> DataFrame:
    """Roles of the columns of the hazard dataset as a CSV would hold it, every value a text: types are found from all rows."""
    rows = hazard(spark, d)
    rows = typed(rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns]))
    found = column_roles(rows, {"customer", "event", "exposure_frac", "anchor_date", "months_low", "months_high"}, ("interval",))
    return spark.createDataFrame([(role, name) for role, names in zip(("numeric", "categorical", "skipped"), found) for name in names], "role string, feature string")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS day_first, CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS compact FROM orders")
def date_forms(spark: SparkSession, d: str) -> DataFrame:
    """Order dates written in two forms, some missing, and read back by the one form that fits all."""
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.date_format("o_orderdate", "dd/MM/yyyy")).alias("day_first"),
        F.when(F.col("o_orderkey") % 5 > 0, F.date_format("o_orderdate", "yyyyMMdd")).alias("compact"))
    return strict_dates(strict_dates(o, "day_first"), "compact")


_COEF = "WITH f AS (SELECT unnest(range(0, 10)) AS i), c AS (SELECT i, k, CASE WHEN (i * 7 + k * 3) % 5 = 0 THEN 0.0 ELSE ((i * 13 + k * 11) % 17 - 6) / CAST(10 AS DOUBLE) END AS coef FROM f, (SELECT unnest(range(0, 40)) AS k)), m AS (SELECT k, avg(coef) AS mc, CASE WHEN sum(sign(coef)) >= 0 THEN 1 ELSE -1 END AS dom FROM c GROUP BY 1)"


@query(_COEF + " SELECT 'f' || k AS feature, round(any_value(mc), 6) AS mean_coef, round(stddev_pop(coef), 6) AS std_coef, round(avg(CAST(sign(coef) = dom AS INTEGER)), 6) AS sign_consistency, round(avg(CAST(coef <> 0 AS INTEGER)), 6) AS nonzero_rate FROM c JOIN m USING (k) GROUP BY k")
def coef_stability(spark: SparkSession, d: str) -> DataFrame:
    i, k = F.col("i"), F.col("k")
    rows = spark.range(10).select(F.col("id").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(39))).alias("k"))
    coef = F.when((i * 7 + k * 3) % 5 == 0, 0.0).otherwise(((i * 13 + k * 11) % 17 - 6) / 10)
    return rounded(M.coefficient_stability(rows.select(F.concat(F.lit("f"), k.cast("string")).alias("feature"), coef.alias("coef"))))


def _model_input(spark: SparkSession, d: str) -> DataFrame:
    return stored(hazard_dataset(_features(spark, d, "hazard"), _anchors(spark, d, "hazard"), CFG), "hazard")


@query(None)
def cv_logistic_oof(spark: SparkSession, d: str) -> DataFrame:
    from .plans.modelling import out_of_fold

    return out_of_fold(_model_input(spark, d), Model())[0]


@query(None)
def cv_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Measures over the repeats of the cross-validated logistic model."""
    from .plans.modelling import out_of_fold

    return M.summary(M.ranking_metrics(out_of_fold(_model_input(spark, d), Model())[0], "customer", LIFTS))


@query(None)
def cv_calibration(spark: SparkSession, d: str) -> DataFrame:
    """Predicted and observed rates by bins of the out-of-fold scores of the logistic model."""
    from .plans.modelling import out_of_fold

    return M.calibration(out_of_fold(_model_input(spark, d), Model())[0], CAL_BINS)


@query(None)
def cv_coefficients(spark: SparkSession, d: str) -> DataFrame:
    """How steady the coefficients of the logistic model are over its folds."""
    from .plans.modelling import coefficients, out_of_fold

    return M.coefficient_stability(coefficients(spark, out_of_fold(_model_input(spark, d), Model())[2]))


@query(None)
def cv_gbt_oof(spark: SparkSession, d: str) -> DataFrame:
    from .plans.modelling import out_of_fold

    return out_of_fold(_model_input(spark, d), Model(type="gbm"))[0]


@query(None)
def permutation_importance(spark: SparkSession, d: str) -> DataFrame:
    from .plans.modelling import importance

    return importance(_model_input(spark, d), Model(type="gbm"))


@query(None)
def synthetic_acquisitions(spark: SparkSession, d: str) -> DataFrame:
    from .sources.synthetic import acquisitions

    return acquisitions(spark, 25_000)


@query(_select(_BOTH_SQL + _hist_sql("fixed"), f"SELECT customer, tie, {_month('origination_date', 'anchor_date')} AS months_before, rn AS place FROM hist"))
def visible_history(spark: SparkSession, d: str) -> DataFrame:
    rows = visible(_acquired(spark, d), _anchors(spark, d, "fixed").where("keep"), CFG)
    return rows.select("customer", "tie", months("origination_date", "anchor_date").alias("months_before"), F.col("_n").cast("long").alias("place"))
