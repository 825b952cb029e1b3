"""Reading acquisition histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Columns, Prep

# Texts that stand for a missing value in CSV files.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

FAMILY = "product_family"
ROW = "_row_idx"


def require(df: DataFrame, names, where: str) -> None:
    """ValueError that lists the names ``df`` lacks; empty names are passed over."""
    lacking = [n for n in names if n and n not in df.columns]
    if lacking:
        raise ValueError(f"{where}: missing columns {', '.join(lacking)}")


def in_order(df: DataFrame) -> DataFrame:
    """A frame read from files, with the place of each row in _row_idx: by path, then by place in the file.

    Spark reads the larger of several files first and cuts them where it likes; the path
    and the offset of the block put that right, and within a block rows are numbered as they are read.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return df.select("*", place.alias(ROW))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column as text."""
    return spark.read.option("header", True).csv(path)


def without_missing(df: DataFrame) -> DataFrame:
    """Texts that stand for a missing value become null."""
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")) for c, t in df.dtypes if t == "string"})


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column as text, missing-value texts as null, and the order of the rows in _row_idx."""
    return without_missing(in_order(read_text(spark, path)))


#: What a text can be read as; a later kind takes in the earlier ones, but a truth value is no number.
KINDS = ("truth", "whole", "number", "text")
_WHOLE, _NUMBER = r"^\s*[+-]?\d{1,18}\s*$", r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def typed(df: DataFrame) -> DataFrame:
    """``df`` with text columns given the type that all their values agree on, found in one pass.

    Whole numbers are long, or double if some are missing, as are other numbers and
    columns without any value.  True and False are boolean if no value is missing.  Everything else stays
    text: dates, mixtures, and truth values with gaps.
    """
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return df

    def kind(c: str):
        x = F.col(f"`{c}`")
        return F.when(x.isNull(), None).when(F.lower(x).isin("true", "false"), 0).when(x.rlike(_WHOLE), 1).when(x.rlike(_NUMBER), 2).otherwise(3)

    found = df.agg(F.count("*"), *[f(kind(c)) for c in texts for f in (F.count, F.min, F.max)]).first()
    out = {}
    for i, c in enumerate(texts):
        count, low, high = found[1 + 3 * i : 4 + 3 * i]
        x, gaps = F.trim(f"`{c}`"), count < found[0]
        if low == high == 0 and not gaps:
            out[c] = F.lower(x) == "true"
        elif low != 0 and high in (None, 1, 2):
            number = F.when(F.lower(x).rlike("inf"), F.when(x.startswith("-"), float("-inf")).otherwise(float("inf"))).otherwise(x.try_cast("double"))
            out[c] = x.cast("long") if high == 1 and not gaps else number
    return df.withColumns(out)


def read_model_input(spark: SparkSession, path: str) -> DataFrame:
    """A dataset: Parquet with its types, or a CSV with missing-value texts as null and its columns ``typed``."""
    return typed(without_missing(read_text(spark, path))) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)


# Shapes of dates and how their parts make an ISO date; a column has one of them throughout.  Of two that
# fit, as with 01/02/2020 alone, the earlier counts: the month comes before the day.
_D2, _D4, _N = r"(\d{2})", r"(\d{4})", r"(\d{1,2})"
_ISO, _CLOCK = rf"{_D4}-{_D2}-{_D2}", rf"{_D2}:{_D2}:{_D2}"
DATE_FORMS = {
    "2020-01-31": (rf"^{_ISO}$", "$1-$2-$3"),
    "2020-01-31 12:30:00": (rf"^{_ISO} {_CLOCK}$", "$1-$2-$3 $4:$5:$6"),
    "2020-01-31T12:30:00": (rf"^{_ISO}T{_CLOCK}$", "$1-$2-$3 $4:$5:$6"),
    "2020-01-31 12:30:00.5": (rf"^{_ISO} {_CLOCK}(\.\d{{1,6}})$", "$1-$2-$3 $4:$5:$6$7"),
    "2020-01-31T12:30:00.5": (rf"^{_ISO}T{_CLOCK}(\.\d{{1,6}})$", "$1-$2-$3 $4:$5:$6$7"),
    "2020-01-31 12:30": (rf"^{_ISO} {_D2}:{_D2}$", "$1-$2-$3 $4:$5:00"),
    "2020/01/31": (rf"^{_D4}/{_N}/{_N}$", "$1-$2-$3"),
    "01/31/2020": (rf"^{_N}/{_N}/{_D4}$", "$3-$1-$2"),
    "31/01/2020": (rf"^{_N}/{_N}/{_D4}$", "$3-$2-$1"),
    "01-31-2020": (rf"^{_N}-{_N}-{_D4}$", "$3-$1-$2"),
    "31-01-2020": (rf"^{_N}-{_N}-{_D4}$", "$3-$2-$1"),
    "31.01.2020": (rf"^{_N}\.{_N}\.{_D4}$", "$3-$2-$1"),
    "20200131": (rf"^{_D4}{_D2}{_D2}$", "$1-$2-$3"),
}


def date_of(text: Column, form: str) -> Column:
    """A text of one of DATE_FORMS as a timestamp without time zone; null if it isn't one or there is no such day."""
    shape, iso = DATE_FORMS[form]
    return F.when(text.rlike(shape), F.regexp_replace(text, shape, iso).try_cast("timestamp_ntz"))


def strict_dates(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a text column read as dates, all of one form.

    One pass counts the values that each form fits.  If none fits all, a ValueError names two that
    differ; null stays null.  The outcome doesn't depend on spark.sql.ansi.enabled.
    """
    text = F.trim(f"`{name}`")
    counts = df.agg(F.count(text), *[F.count(date_of(text, form)) for form in DATE_FORMS]).first()
    fits = [form for form, n in zip(DATE_FORMS, counts[1:]) if n == counts[0]]
    if not fits:
        best = max(zip(counts[1:], DATE_FORMS), key=lambda x: x[0])[1]
        odd = df.where(text.isNotNull() & date_of(text, best).isNull()).select(text).first()[0]
        raise ValueError(f"column {name}: no form of dates fits all values; {odd!r} is no date like {best}")
    return df.withColumn(name, date_of(text, fits[0]))


def with_family(df: DataFrame, cfg: Prep) -> DataFrame:
    """product_family from the configured map, the default for others and for null; null on outcome rows."""
    table = F.create_map(*[F.lit(x) for kv in cfg.families.items() for x in kv]) if cfg.families else F.create_map().cast("map<string,string>")
    family = F.coalesce(F.element_at(table, F.col(cfg.columns.product_type)), F.lit(cfg.default_family))
    return df.withColumn(FAMILY, F.when(F.col(cfg.columns.target).isNull(), family))


def ingest(df: DataFrame, cfg: Prep) -> DataFrame:
    """Checked and typed raw rows: strict dates, lenient numbers (bad and NaN become null), family, row order.

    Dates that are text are looked at in one pass first, so that all are of one form.
    """
    col = cfg.columns
    require(df, [col.id, col.date, col.target, col.product_type, col.tiebreak, *cfg.numerics], "input")
    require(df, [c for c in cfg.carry if c != FAMILY], "carried columns")
    levels = {k for s in cfg.numerics.values() for level in s.percentile_group or () for k in level}
    require(df, sorted(levels - {"year", FAMILY}), "percentile groups")
    if dict(df.dtypes)[col.date] == "string":
        df = strict_dates(df, col.date)
    numbers = {c: F.expr(f"try_cast(`{c}` AS DOUBLE)") for c in cfg.numerics}
    numbers = {c: F.when(~F.isnan(x), x) for c, x in numbers.items()}
    df = df.withColumns(numbers | {col.date: F.col(col.date).cast("timestamp_ntz")})
    if ROW not in df.columns:
        df = df.withColumn(ROW, F.monotonically_increasing_id())  # also beside a tiebreak, which may tie or be null
    return with_family(df, cfg)


def split_outcomes(raw: DataFrame, cfg: Prep) -> tuple[DataFrame, DataFrame]:
    """(acquisitions, outcomes): outcome rows are those with any target at all."""
    target = F.col(cfg.columns.target)
    return raw.where(target.isNull()), raw.where(target.isNotNull())


#: Settings for histories taken from the orders table.
ORDERS = Prep(columns=Columns(tiebreak="tie"), extract_date="2001-08-01", horizon_months=24, min_acquisitions=2)


def orders_as_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table seen as acquisitions, one in 29 an outcome."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    outcome = F.col("o_orderkey") % 29 == 0
    urgent = F.col("o_orderpriority") < "3"
    kind = (
        F.when(outcome, F.lit(None))
        .when(F.col("o_orderkey") % 997 < 4, "jumbo_cd")
        .when(F.col("o_orderkey") % 89 == 7, "exotic_note")
        .when((F.col("o_orderstatus") == "F") & urgent, "savings_standard")
        .when(F.col("o_orderstatus") == "F", "checking_basic")
        .when((F.col("o_orderstatus") == "O") & urgent, "mortgage_fixed")
        .when(F.col("o_orderstatus") == "O", "auto_loan")
        .otherwise("credit_card_rewards")
    )
    raw = o.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("origination_date"), F.col("o_orderkey").alias("tie"),
        F.when(outcome, True).alias("target"), kind.alias("product_type"), F.col("o_totalprice").alias("_price"))
    deposit = F.col("product_type").isin("jumbo_cd", "exotic_note", "savings_standard", "checking_basic")
    loan = F.col("product_type").isin("mortgage_fixed", "auto_loan")
    card = F.col("product_type") == "credit_card_rewards"
    return raw.select(
        "customer_id", "origination_date", "tie", "target", "product_type",
        F.when(deposit, F.col("_price")).alias("deposit_balance"),
        F.when(loan, F.col("_price")).when(card, 0.0).alias("loan_balance"),
        F.when(card, F.col("_price")).alias("credit_exposure"))
