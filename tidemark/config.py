"""Typed configuration, read from YAML mappings and checked before anything runs."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from datetime import datetime

#: Aggregates that may be named for a numeric column.
REDUCERS = (
    "sum", "max", "mean", "count_nonnull", "min", "median", "std", "var", "nunique", "prod", "product",
    "count", "skew", "kurt", "kurtosis", "sem", "any", "all", "first", "last",
)
LOGGED = ("sum", "max", "mean")  # of which log1p is given too

# Product types and their families.
FAMILIES = {
    "checking_basic": "TXN_DEPOSIT",
    "checking_premium": "TXN_DEPOSIT",
    "savings_standard": "SAV_TIME",
    "cd_standard": "SAV_TIME",
    "jumbo_cd": "SAV_TIME",
    "money_market": "SAV_TIME",
    "credit_card_rewards": "CARD",
    "credit_card_cashback": "CARD",
    "credit_card_secured": "CARD",
    "auto_loan": "SEC_INSTALL",
    "mortgage_fixed": "MORTGAGE",
    "heloc": "MORTGAGE",
}


@dataclass(frozen=True)
class Columns:
    id: str = "customer_id"
    date: str = "origination_date"
    target: str = "target"
    product_type: str = "product_type"
    tiebreak: str | None = None


@dataclass(frozen=True)
class Numeric:
    aggregations: tuple[str, ...] = ("sum", "max")
    log1p: bool = True
    percentile_group: tuple[tuple[str, ...], ...] | None = None


_LEVELS = (("product_type", "year"), ("product_type",), ("product_family",))


@dataclass(frozen=True)
class Prep:
    """Everything that shapes the two datasets."""

    columns: Columns = Columns()
    default_family: str = "OTHER"
    families: dict[str, str] = field(default_factory=lambda: dict(FAMILIES))
    numerics: dict[str, Numeric] = field(default_factory=lambda: {
        "deposit_balance": Numeric(percentile_group=_LEVELS),
        "loan_balance": Numeric(percentile_group=_LEVELS),
        "credit_exposure": Numeric(aggregations=("sum",)),
    })
    percentiles: bool = True
    min_cell_size: int = 30
    window: int = 4
    carry: tuple[str, ...] = ("product_type", "product_family", "deposit_balance", "loan_balance")
    carry_percentiles: tuple[str, ...] = ("deposit_balance", "loan_balance")
    emit_gaps: bool = True
    count_by_family: bool = True
    numerics_by_family: bool = False
    emit_tenure: bool = True
    extract_date: str = "2026-06-30"
    horizon_months: int = 36
    min_acquisitions: int = 1
    bin_months: int = 6
    max_followup_months: int = 60
    min_exposure_frac: float = 0.5
    input_path: str | None = None
    output_dir: str | None = None
    artifact_dir: str | None = None

    @property
    def family_list(self) -> list[str]:
        """The distinct families in order, the default last."""
        return [*sorted(set(self.families.values()) - {self.default_family}), self.default_family]

    def checked(self) -> Prep:
        datetime.fromisoformat(self.extract_date)
        for name, spec in self.numerics.items():
            if odd := set(spec.aggregations) - set(REDUCERS):
                raise ValueError(f"numeric column {name}: unknown aggregations {sorted(odd)}; known are {', '.join(REDUCERS)}")
        for name in self.carry_percentiles:
            if name not in self.numerics or not self.numerics[name].percentile_group:
                raise ValueError(f"carried percentile {name} has no percentile_group")
        if self.window < 1 or self.bin_months < 1 or self.max_followup_months < 1:
            raise ValueError("window, bin_months and max_followup_months are at least 1")
        return self


@dataclass(frozen=True)
class Model:
    """Everything that shapes training and evaluation."""

    design: str = "hazard"
    id: str = "customer"
    group: str = "customer"
    label: str = "event"
    weight: str | None = "exposure_frac"
    drop: tuple[str, ...] = ("anchor_date", "months_low", "months_high")
    force_categorical: tuple[str, ...] = ("interval",)
    min_category_frequency: float = 0.01
    add_missing_indicators: bool = True
    type: str = "logistic"
    l1_ratio: float = 0.1
    c_grid: tuple[float, ...] = (0.001, 0.01, 0.1, 1.0)
    max_iter: int = 400
    tol: float = 1e-3
    gbm_max_depth: int = 3
    gbm_learning_rate: float = 0.05
    gbm_max_iter: int = 300
    gbm_min_samples_leaf: int = 200
    gbm_l2_regularization: float = 1.0
    gbm_fit_rows: int | None = None  # trees are fitted on all training rows; a number asks for a draw of so many of a fold instead
    permutation_repeats: int = 5
    negative_customer_fraction: float = 0.25
    n_splits: int = 5
    n_repeats: int = 2
    random_state: int = 42
    lift_at: tuple[float, ...] = (0.01, 0.05, 0.10)
    calibration_bins: int = 5
    hazard_horizon_months: int = 24
    hazard_bin_months: int = 6
    input_path: str | None = None
    output_dir: str | None = None

    def checked(self) -> Model:
        if self.design not in ("flat", "hazard"):
            raise ValueError(f"design {self.design!r} is neither flat nor hazard")
        if self.type not in ("logistic", "gbm"):
            raise ValueError(f"model type {self.type!r} is neither logistic nor gbm")
        if self.design == "hazard" and self.hazard_horizon_months % self.hazard_bin_months:
            raise ValueError("hazard_horizon_months is a multiple of hazard_bin_months")
        if not 0 < self.negative_customer_fraction:
            raise ValueError("negative_customer_fraction is above 0")
        return self

    @property
    def horizon_bins(self) -> int:
        return self.hazard_horizon_months // self.hazard_bin_months


def _tuples(value):
    return tuple(map(_tuples, value)) if isinstance(value, list) else value


def _known(kind, values: dict):
    names = {f.name for f in fields(kind)}
    if odd := sorted(set(values) - names):
        raise ValueError(f"unknown settings: {', '.join(odd)}")
    return kind(**{k: _tuples(v) for k, v in values.items()})


def _sections(raw: dict, *known: str) -> None:
    if odd := sorted(set(raw) - set(known)):
        raise ValueError(f"unknown sections: {', '.join(odd)}")


def _renamed(section: dict, where: str, **names: str) -> dict:
    """The settings of a section under the names of the dataclass; others are errors."""
    if odd := sorted(set(section) - set(names)):
        raise ValueError(f"{where}: unknown settings: {', '.join(odd)}")
    return {names[k]: v for k, v in section.items()}


def prep_config(raw: dict) -> Prep:
    """A preprocessing configuration from the nested mapping of a YAML file."""
    _sections(raw, "io", "columns", "product_families", "numeric_columns", "percentiles", "sequence", "aggregates", "labeling", "hazard")
    flat = {**raw.get("io", {}), **raw.get("labeling", {}), **raw.get("hazard", {}), **raw.get("aggregates", {})}
    sequence = dict(window="window", carry_columns="carry", carry_percentiles="carry_percentiles", emit_gaps="emit_gaps")
    flat |= _renamed(raw.get("sequence", {}), "sequence", **sequence)
    flat |= _renamed(raw.get("product_families", {}), "product_families", map="families", default_family="default_family")
    flat |= _renamed(raw.get("percentiles", {}), "percentiles", enable="percentiles", min_cell_size="min_cell_size")
    if "columns" in raw:
        flat["columns"] = _known(Columns, raw["columns"])
    if "numeric_columns" in raw:
        flat["numerics"] = {k: _known(Numeric, {"log1p": False, **v}) for k, v in raw["numeric_columns"].items()}
    return _known(Prep, flat).checked()


def model_config(raw: dict) -> Model:
    """A modelling configuration from the nested mapping of a YAML file."""
    _sections(raw, "io", "design", "columns", "encoding", "model", "sampling", "cv", "evaluation")
    model, gbm = raw.get("model", {}), dict(raw.get("model", {}).get("gbm", {}))
    _sections(model, "type", "logistic", "gbm")
    flat = {**raw.get("io", {}), **raw.get("columns", {}), **raw.get("encoding", {}), **raw.get("cv", {}), **raw.get("evaluation", {})}
    flat |= {"type": model.get("type", "logistic"), **model.get("logistic", {})}
    flat |= {"permutation_repeats": gbm.pop("permutation_repeats", 5), "design": raw.get("design", "hazard")}
    flat |= {f"gbm_{k}": v for k, v in gbm.items()}
    flat |= _renamed({"negative_customer_fraction": 1.0} | raw.get("sampling", {}), "sampling", negative_customer_fraction="negative_customer_fraction")
    return _known(Model, flat).checked()


def load_yaml(path: str) -> dict:
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)
