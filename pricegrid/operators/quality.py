"""Data-quality assessment: types, gaps, rules, outliers, categories, score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.functions.predicates import known, outside
from pricegrid.functions.text import strip
from pricegrid.operators.features import numeric_columns, quoted, string_columns
from pricegrid.operators.order import quantile_values
from pricegrid.operators.rules import Rule, issues
from pricegrid.operators.validation import business_rules, number

NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def type_report(df: DataFrame, schema) -> DataFrame:
    """Expected and actual type per expected column: OK, MISMATCH or MISSING."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = []
    for f in schema:
        expected, actual = f.dataType.simpleString(), have.get(f.name)
        status = "MISSING" if actual is None else "OK" if actual == expected else "MISMATCH"
        rows.append((f.name, expected, actual or "MISSING", status))
    return df.sparkSession.createDataFrame(
        rows, "column string, expected string, actual string, status string"
    )


def per_column(df, columns, measures):
    """One row per column from one aggregate; measures: {name: f(column) -> aggregate}."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{m}{i}") for i, c in enumerate(columns) for m, f in measures.items()],
    )
    cells = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{m}{i}").alias(m) for m in measures])
        for i, c in enumerate(columns)
    ]
    return row.select("rows", F.explode(F.array(*cells)).alias("c")).select("rows", "c.*")


def mixed_types(df: DataFrame) -> DataFrame:
    """Text columns in which some but not all values read as numbers."""
    columns = string_columns(df)
    found = per_column(
        df, columns, {"numeric_values": lambda c: F.count_if(known(quoted(c).rlike(NUMBER_TEXT)))}
    )
    return found.where((F.col("numeric_values") > 0) & (F.col("numeric_values") < F.col("rows"))).select(
        "column", "numeric_values", F.round(F.col("numeric_values") / F.col("rows") * 100, 6).alias("percentage")
    )


# Numbers that stand for "missing", by column.
SENTINEL_COLUMNS = ("km", "price", "engine_size")
SENTINELS = (-1, -999)


def missing_check(df: DataFrame, sentinel_columns=SENTINEL_COLUMNS, age_columns=("age_years",)):
    """Per column: nulls, empty text, blank text, sentinel numbers and their total."""
    texts = set(string_columns(df))

    def sentinel(c):
        if c in sentinel_columns:
            return F.count_if(known(F.col(c).isin([float(x) for x in SENTINELS])))
        return F.count_if(known(F.col(c) < 0)) if c in age_columns else F.sum(F.lit(0))

    def of_text(condition):
        return lambda c: F.count_if(known(condition(quoted(c)))) if c in texts else F.sum(F.lit(0))

    found = per_column(
        df,
        df.columns,
        {
            "null_count": lambda c: F.count_if(quoted(c).isNull()),
            "empty_strings": of_text(lambda x: x == ""),
            "whitespace_only": of_text(lambda x: (x != "") & x.rlike(r"^\s*$")),
            "special_numeric": sentinel,
        },
    )
    parts = ["null_count", "empty_strings", "whitespace_only", "special_numeric"]
    total = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts[1:]), F.col(parts[0]))
    return found.select(
        "column",
        *[F.coalesce(F.col(p), F.lit(0)).cast("long").alias(p) for p in parts],
        F.round(F.col("null_count") / F.col("rows") * 100, 6).alias("null_pct"),
        total.cast("long").alias("total_issues"),
        F.round(total / F.col("rows") * 100, 6).alias("total_pct"),
    )


# Names and limits of the assessment rules.
def assessment_rules(config, reference_years=(2021, 2023), max_rate=50000):
    low, high = config.year_limits
    first, last = reference_years
    engine = number(config.ranges["engine_size"][1])
    shared = {r.name: r for r in business_rules(config)}
    keep = [
        "Price > 0", "KM >= 0", "Doors (2, 3, 4, or 5)", "Age >= 0", "Year <= year_of_reference",
        "Age calculation consistency", "KM per year (< 50,000 km/year)",
    ]
    return [
        Rule(f"Year range ({low}-{high})", f"year < {low} or year > {high}", ("year",),
             description="year beyond the limits"),
        *[shared[name] for name in keep],
        Rule("Engine size (0.7-7.0L)", f"engine_size <= 0 or engine_size > {engine}", ("engine_size",),
             description="engine size beyond the limits"),
        Rule(f"Year of reference ({first}-{last})",
             f"year_of_reference < {first} or year_of_reference > {last}", ("year_of_reference",),
             description="reference year beyond the limits"),
    ]


# Names and limits of the inconsistency rules.
def inconsistency_rules(last_year=2023):
    return [
        Rule("Zero mileage (km = 0)", "km = 0", ("km",)),
        Rule("Very low price (< R$ 1,000)", "price < 1000", ("price",), value="price"),
        Rule("Very high price (> R$ 1,000,000)", "price > 1000000", ("price",), value="price"),
        Rule("Aged vehicle with zero km", "age_years > 0 and km = 0", ("age_years", "km")),
        Rule("Very old vehicle with very low km", "age_years > 20 and km < 10000", ("age_years", "km")),
        Rule("Future vehicle year", f"year > {last_year}", ("year",)),
    ]


def assessment_issues(df, config, **options):
    return issues(df, assessment_rules(config, **options))


def inconsistent_values(df, last_year=2023):
    return issues(df, inconsistency_rules(last_year))


def outlier_summary(df: DataFrame, columns=None, exclude=("year_of_reference",)) -> DataFrame:
    """Mean, deviation, extremes and IQR / z-score outlier counts per numeric column.

    Two passes: statistics for all columns, then counts against those numbers.
    """
    columns = columns or [c for c in numeric_columns(df) if c not in exclude]
    row = df.agg(
        *[f(c).alias(f"{p}{i}") for i, c in enumerate(columns) for p, f in (("m", F.avg), ("s", F.stddev_pop))]
    ).first()
    quartiles = quantile_values(df, columns, [0.25, 0.75])
    bounds = {}
    for c in columns:
        q1, q3 = quartiles[c]
        bounds[c] = (None, None) if q1 is None else (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    position = {c: i for i, c in enumerate(columns)}

    def iqr_count(c):
        low, high = bounds[c]
        return F.count_if(outside(F.col(c), F.lit(low).cast("double"), F.lit(high).cast("double")))

    def z_count(c):
        mean, std = row[f"m{position[c]}"], row[f"s{position[c]}"]
        if not std:
            return F.count_if(F.lit(False))
        return F.count_if(known(F.abs((F.col(c) - F.lit(mean)) / F.lit(std)) > 3.0))

    found = per_column(
        df,
        columns,
        {
            "mean": lambda c: F.avg(c),
            "std": lambda c: F.stddev_samp(c),
            "min": lambda c: F.min(c).cast("double"),
            "max": lambda c: F.max(c).cast("double"),
            "iqr_outliers": iqr_count,
            "zscore_outliers": z_count,
            "iqr_lower": lambda c: F.max(F.lit(bounds[c][0]).cast("double")),
            "iqr_upper": lambda c: F.max(F.lit(bounds[c][1]).cast("double")),
        },
    )
    share = F.col("iqr_outliers") / F.col("rows") * 100
    return found.select(
        F.col("column").alias("feature"),
        F.round("mean", 4).alias("mean"),
        F.round("std", 4).alias("std"),
        "min",
        "max",
        "iqr_outliers",
        F.round(share, 6).alias("iqr_pct"),
        "zscore_outliers",
        F.round(F.col("zscore_outliers") / F.col("rows") * 100, 6).alias("zscore_pct"),
        F.round("iqr_lower", 4).alias("iqr_lower"),
        F.round("iqr_upper", 4).alias("iqr_upper"),
        (share > 5).alias("significant"),
    )


def _value_rows(df, columns):
    """(column, value, n) of every text column, missing values included."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), quoted(c).alias("value")) for c in columns]
    )
    rows = df.select(F.explode(cells).alias("x")).select("x.*")
    return rows.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _with_rare_limit(counts):
    """Add the count below which a value is rare: 5, or 0.01 % of the rows.

    The rows per column are summed from the grouped counts, without another
    pass over the table.
    """
    limits = counts.groupBy("column").agg(
        F.greatest(F.lit(5.0), F.sum("n") * F.lit(0.0001)).alias("limit")
    )
    return counts.join(F.broadcast(limits), "column")


def category_consistency(df: DataFrame, columns=None) -> DataFrame:
    """Per text column: distinct values, stray blanks, case collisions, rare values, top."""
    columns = columns or string_columns(df)
    text = F.coalesce("value", F.lit("nan"))
    present = F.col("value").isNotNull()
    top = F.min(F.when(present, F.struct((-F.col("n")).alias("n"), F.col("value"))))
    found = _with_rare_limit(_value_rows(df, columns)).groupBy("column").agg(
        F.count(F.lit(1)).alias("unique_values"),
        F.bool_or(strip(text) != text).alias("has_whitespace"),
        F.count_distinct(F.lower(text)).alias("lowers"),
        F.count_distinct(F.upper(text)).alias("uppers"),
        F.count_if(present & (F.col("n") < F.col("limit"))).alias("rare_values_count"),
        top.alias("top"),
    )
    collides = (F.col("lowers") != F.col("unique_values")) | (F.col("uppers") != F.col("unique_values"))
    return found.select(
        "column",
        "unique_values",
        "has_whitespace",
        collides.alias("has_case_inconsistency"),
        "rare_values_count",
        F.coalesce("top.value", F.lit("N/A")).alias("most_common"),
        F.coalesce(-F.col("top.n"), F.lit(0)).alias("most_common_count"),
    )


def problem_columns(consistency: DataFrame) -> DataFrame:
    return consistency.where(
        F.col("has_whitespace") | F.col("has_case_inconsistency") | (F.col("rare_values_count") > 0)
    )


def rare_values(df: DataFrame, columns=None) -> DataFrame:
    """Every rare value of every text column with its count."""
    columns = columns or string_columns(df)
    counted = _with_rare_limit(_value_rows(df, columns))
    return counted.where(F.col("value").isNotNull() & (F.col("n") < F.col("limit"))).select(
        "column", "value", "n"
    )


def quality_report(df: DataFrame, config, columns=None, **options) -> DataFrame:
    """Issue categories per area, as rows (area, categories)."""
    parts = {
        "data types": type_report(df, config.schema).where("status <> 'OK'"),
        "missing values": missing_check(df).where("total_issues > 0"),
        "business rules": assessment_issues(df, config, **options),
        "outliers": outlier_summary(df).where("significant"),
        "categories": problem_columns(category_consistency(df, columns)),
        "inconsistent values": inconsistent_values(df),
    }
    frames = [
        part.agg(F.count(F.lit(1)).alias("categories")).select(F.lit(area).alias("area"), "categories")
        for area, part in parts.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def quality_score(report: DataFrame) -> DataFrame:
    """Total issue categories and the score word."""
    total = F.sum("categories")
    chain = None
    for limit, word in C.QUALITY_SCORES[:-1]:
        hit = F.col("total_categories") <= limit
        chain = F.when(hit, word) if chain is None else chain.when(hit, word)
    return report.agg(total.alias("total_categories")).withColumn(
        "quality_score", chain.otherwise(C.QUALITY_SCORES[-1][1])
    )


