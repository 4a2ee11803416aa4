"""Cleaning: dedupe, impute, correct types and ages, drop outliers and bad rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.functions import text
from pricegrid.functions.predicates import any_of, known, outside
from pricegrid.operators.duplicates import NARROW, drop_copies
from pricegrid.operators.features import category_rows, numeric_columns, string_columns
from pricegrid.operators.order import quantile_values
from pricegrid.operators.rules import Rule
from pricegrid.operators.validation import in_list, number
from pricegrid.schema import CANONICAL, TableConfig
from pricegrid.session import stage

METHODS = ("iqr", "zscore", "domain", "combined")


def dedupe(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; of wide rows, only those that may have a copy are shuffled."""
    return drop_copies(df)


def fit_statistics(df: DataFrame, columns, method="combined") -> dict:
    """mean, sample deviation and quartiles per column, as far as the method uses them."""
    columns = [c for c in columns if c in df.columns]
    if not columns or method == "domain":
        return {}
    row = {f"{p}_{c}": None for c in columns for p in ("mean", "std")}
    if method in ("zscore", "combined"):
        row = df.agg(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_samp(c).alias(f"std_{c}") for c in columns],
        ).first()
    quartiles = {c: [None, None] for c in columns}
    if method in ("iqr", "combined"):
        quartiles = quantile_values(df, columns, [0.25, 0.75])
    return {
        c: {
            "mean": row[f"mean_{c}"],
            "std": row[f"std_{c}"],
            "q25": quartiles[c][0],
            "q75": quartiles[c][1],
            "iqr": None if quartiles[c][0] is None else quartiles[c][1] - quartiles[c][0],
        }
        for c in columns
    }


def fix_missing_age(df: DataFrame) -> DataFrame:
    """Recompute a missing or negative age from the two years."""
    if not {"age_years", "year", "year_of_reference"} <= set(df.columns):
        return df
    bad = F.col("age_years").isNull() | (F.col("age_years") < 0)
    redone = (F.col("year_of_reference") - F.col("year")).cast(df.schema["age_years"].dataType)
    return df.withColumn("age_years", F.when(bad, redone).otherwise(F.col("age_years")))


def modes(df: DataFrame, columns) -> dict:
    """Most frequent value per column, the smallest one of ties."""
    counted = category_rows(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("feature").agg(F.min(F.struct(-F.col("n"), F.col("value"))).alias("m"))
    return {r.feature: r.value for r in best.select("feature", "m.value").collect()}


def fit_imputation(df: DataFrame) -> dict:
    """Fill values for the columns that have missing values.

    Numbers take the median (rounded down in integer columns), text the mode,
    or Unknown when there is none. age_years is never imputed.
    """
    numbers = [c for c in numeric_columns(df) if c != "age_years"]
    texts = string_columns(df)
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in (*numbers, *texts)]).first()
    numbers = [c for c in numbers if gaps[c]]
    texts = [c for c in texts if gaps[c]]
    fills: dict = {}
    if numbers:
        whole = {f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)}
        for c, (median,) in quantile_values(df, numbers, [0.5]).items():
            if median is not None:
                fills[c] = int(median // 1) if c in whole else median
    if texts:
        found = modes(df, texts)
        fills.update({c: found.get(c, "Unknown") for c in texts})
    return fills


def impute(df: DataFrame, fills: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()}) if fills else df


def correct_types(df: DataFrame, config: TableConfig = CANONICAL) -> DataFrame:
    """Integers as long (unreadable becomes 0), floats as double (unreadable null)."""
    new = {}
    for c in config.integer_columns:
        if c in df.columns:
            whole = isinstance(df.schema[c].dataType, T.IntegralType)
            if whole:
                value = F.col(c).cast("long")
            else:
                # Whole numbers are read as such, as a double holds only 53 bits of them.
                value = F.coalesce(F.col(c).try_cast("long"), F.floor(F.col(c).try_cast("double")).cast("long"))
            new[c] = F.coalesce(value, F.lit(0).cast("long"))
    for c in config.float_columns:
        if c in df.columns:
            new[c] = F.col(c).try_cast("double")
    return df.withColumns(new) if new else df


def fix_age(df: DataFrame) -> DataFrame:
    """Set every age that differs from the two years, or is negative, to their difference.

    Whatever the old age was, the result is the difference, so nothing else is
    computed; a missing year gives a missing age.
    """
    if not {"age_years", "year", "year_of_reference"} <= set(df.columns):
        return df
    return df.withColumn("age_years", F.col("year_of_reference") - F.col("year"))


def outlier_mask(column, method, statistics, config, iqr_factor=1.5, z_limit=3.0):
    """Rows whose value is an outlier by the method; missing values never are."""
    col, stat, tests = F.col(column), statistics.get(column), []
    if method in ("iqr", "combined") and stat and stat["iqr"] is not None:
        reach = iqr_factor * stat["iqr"]
        tests.append(outside(col, F.lit(stat["q25"] - reach), F.lit(stat["q75"] + reach)))
    if method in ("zscore", "combined") and stat and (stat["std"] or 0) > 0:
        score = F.abs((col - F.lit(stat["mean"])) / F.lit(stat["std"]))
        tests.append(known(score > z_limit))
    if method in ("domain", "combined") and column in config.ranges:
        low, high = config.ranges[column]
        tests.append(outside(col, F.lit(float(low)), F.lit(float(high))))
    return any_of(tests)


def standardize_text(df: DataFrame, config: TableConfig = CANONICAL) -> DataFrame:
    """Names in title case with single blanks, codes in upper case; null stays null."""
    new = {c: text.clean_name(F.col(c)) for c in config.title_collapse_columns if c in df.columns}
    new |= {c: text.clean_code(F.col(c)) for c in config.upper_columns if c in df.columns}
    new |= {c: text.clean_title(F.col(c)) for c in config.title_columns if c in df.columns}
    return df.withColumns(new) if new else df


def validity_rules(config: TableConfig = CANONICAL):
    """Rules a row must meet to be kept; a missing value breaks its rule."""
    low, high = config.year_limits
    engine = number(config.ranges["engine_size"][1])
    met = [
        ("price", "price > 0", ("price",)),
        ("km", "km >= 0", ("km",)),
        ("year", f"year >= {low} and year <= {high}", ("year",)),
        ("age_years", "age_years >= 0", ("age_years",)),
        ("year_of_reference", "year <= year_of_reference", ("year", "year_of_reference")),
        ("engine_size", f"engine_size > 0 and engine_size <= {engine}", ("engine_size",)),
        ("doors", f"doors in ({in_list(config.allowed['doors'])})", ("doors",)),
    ]
    return [Rule(name, f"not coalesce({kept}, false)", columns) for name, kept, columns in met]


def drop_invalid(df: DataFrame, config: TableConfig = CANONICAL) -> DataFrame:
    rules = [r for r in validity_rules(config) if set(r.columns) <= set(df.columns)]
    return df.where(~any_of(r.mask() for r in rules))


@dataclass
class Cleaner:
    """Cleaning options. fit() learns outlier statistics from the raw rows."""

    config: TableConfig = field(default_factory=TableConfig)
    method: str = "iqr"
    iqr_factor: float = 1.5
    z_limit: float = 3.0
    duplicates: bool = True
    missing: bool = True
    outliers: bool = True
    texts: bool = True

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"unknown outlier method: {self.method}")

    def fit(self, df: DataFrame) -> CleaningModel:
        statistics = fit_statistics(df, self.config.outlier_columns, self.method) if self.outliers else {}
        return CleaningModel(self, statistics)

    def clean(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


@dataclass
class CleaningModel:
    options: Cleaner
    statistics: dict

    def masks(self, df):
        o = self.options
        return {
            c: outlier_mask(c, o.method, self.statistics, o.config, o.iqr_factor, o.z_limit)
            for c in o.config.outlier_columns
            if c in df.columns
        }

    def prepare(self, df: DataFrame) -> DataFrame:
        """Everything up to the corrected ages: no row is judged yet.

        Imputing reads the distinct rows twice, so they are written once to the
        shared folder instead of being deduplicated again. The table is one that
        fitting has read twice already, so copies are found by digest and only
        rows that may have one are shuffled.
        """
        o = self.options
        df = drop_copies(df, NARROW) if o.duplicates else df
        if o.missing:
            df = stage(df, "distinct") if o.duplicates else df
            df = fix_missing_age(df)
            df = impute(df, fit_imputation(df))
        return fix_age(correct_types(df, o.config))

    def transform(self, df: DataFrame) -> DataFrame:
        o = self.options
        df = self.prepare(df)
        df = df.where(~any_of(self.masks(df).values())) if o.outliers else df
        df = standardize_text(df, o.config) if o.texts else df
        return drop_invalid(df, o.config)

    def quarantine(self, df: DataFrame) -> DataFrame:
        """All prepared rows with the reasons to drop them (empty = kept)."""
        o = self.options
        df = self.prepare(df)
        named = []
        if o.outliers:
            named += [F.when(m, F.lit(f"outlier {c}")) for c, m in self.masks(df).items()]
        rules = [r for r in validity_rules(o.config) if set(r.columns) <= set(df.columns)]
        named += [F.when(r.mask(), F.lit(f"invalid {r.name}")) for r in rules]
        df = standardize_text(df, o.config) if o.texts else df
        return df.withColumn("reasons", F.filter(F.array(*named), lambda x: x.isNotNull()))

    def report(self, df: DataFrame) -> DataFrame:
        """Rows in, duplicates, rows dropped by reason kind, rows kept."""
        judged = self.quarantine(df)
        dropped = F.size("reasons") > 0
        counts = judged.agg(
            F.count(F.lit(1)).alias("rows_distinct"),
            F.count_if(F.exists("reasons", lambda x: x.startswith("outlier"))).alias("rows_outlier"),
            F.count_if(F.exists("reasons", lambda x: x.startswith("invalid"))).alias("rows_invalid"),
            F.count_if(~dropped).alias("rows_kept"),
        )
        total = df.agg(F.count(F.lit(1)).alias("rows_in"))
        removed = (F.col("rows_in") - F.col("rows_kept")) / F.col("rows_in") * 100
        return total.crossJoin(F.broadcast(counts)).withColumn("removed_pct", F.round(removed, 4))


def statistics_table(spark, statistics: dict) -> DataFrame:
    """Fitted statistics as rows."""
    rows = [(c, s["mean"], s["std"], s["q25"], s["q75"], s["iqr"]) for c, s in statistics.items()]
    schema = "column string, mean double, std double, q25 double, q75 double, iqr double"
    return spark.createDataFrame(rows, schema)
