"""Validation against a table configuration; the result is an issue table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.predicates import known
from pricegrid.operators.rules import Rule, applicable, count_rules, issues

ISSUE_COLUMNS = "check string, rule string, severity string, detail string"


def literal(value):
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def number(value):
    """A double literal, so both sides of a comparison have the same type."""
    return f"{float(value)!r}e0" if "e" not in repr(float(value)) else repr(float(value))


def in_list(values):
    return ", ".join(literal(v) for v in values)


def range_rules(ranges):
    """Values outside [low, high]; missing values pass."""
    return [
        Rule(
            name=c,
            condition=f"{c} < {number(low)} or {c} > {number(high)}",
            columns=(c,),
            severity=None,
            description=f"expected range {low} to {high}",
            check="range",
            value=c,
        )
        for c, (low, high) in ranges.items()
    ]


def categorical_rules(config, normalize=False):
    """Values not in the accepted list; missing values pass.

    State codes are compared in upper case. With normalize=True words are
    compared without regard to case as well.
    """
    rules = []
    for c, words in config.allowed.items():
        text = normalize and isinstance(words[0], str)
        accepted = [w.lower() for w in words] if text else list(words)
        left = f"lower({c})" if text else c
        rules.append(
            Rule(c, f"{left} not in ({in_list(accepted)})", (c,), None, "value not accepted", "categorical")
        )
    if config.states:
        rules.append(
            Rule(
                "state",
                f"upper(state) not in ({in_list(config.states)})",
                ("state",),
                None,
                "unknown state code",
                "categorical",
            )
        )
    return rules


# Names and severities of the business rules.
def business_rules(config):
    doors = in_list(config.allowed["doors"])
    return [
        Rule("Price > 0", "price <= 0", ("price",), "error", "price is zero or below"),
        Rule("KM >= 0", "km < 0", ("km",), "error", "mileage is below zero"),
        Rule(
            "Year <= year_of_reference", "year > year_of_reference", ("year", "year_of_reference"),
            "error", "built after the year it is listed for",
        ),
        Rule("Age >= 0", "age_years < 0", ("age_years",), "error", "age is below zero"),
        Rule(
            "Age calculation consistency",
            "coalesce(age_years <> year_of_reference - year, true)",
            ("age_years", "year_of_reference", "year"),
            "warning",
            "age is not the difference of the two years",
        ),
        Rule(
            # A divisor of zero (age -1) is an infinite rate when km is above zero.
            "KM per year (< 50,000 km/year)",
            "case when age_years + 1 = 0 then km > 0 else km / (age_years + 1) > 50000 end",
            ("km", "age_years"),
            "warning",
            "more than 50 000 km a year",
        ),
        Rule(
            "Engine size > 0", "engine_size <= 0", ("engine_size",), "error",
            "engine size is zero or below",
        ),
        Rule(
            "Doors (2, 3, 4, or 5)", f"not coalesce(doors in ({doors}), false)", ("doors",), "error",
            "number of doors not accepted",
        ),
    ]


def schema_issues(df: DataFrame, schema) -> DataFrame:
    """Missing columns, unexpected columns and type mismatches, at most one row each."""
    spark, have = df.sparkSession, {f.name: f.dataType.simpleString() for f in df.schema}
    expected = {f.name: f.dataType.simpleString() for f in schema}
    missing = sorted(set(expected) - set(have))
    unexpected = sorted(set(have) - set(expected))
    wrong = [f"{c}: {have[c]} instead of {t}" for c, t in expected.items() if have.get(c, t) != t]
    rows = [
        ("schema", name, severity, "; ".join(items))
        for name, severity, items in (
            ("missing_columns", "error", missing),
            ("unexpected_columns", "warning", unexpected),
            ("type_mismatch", "error", wrong),
        )
        if items
    ]
    return spark.createDataFrame(rows, ISSUE_COLUMNS)


def range_issues(df: DataFrame, config) -> DataFrame:
    return issues(df, range_rules(config.ranges))


def categorical_issues(df: DataFrame, config, normalize=False) -> DataFrame:
    return issues(df, categorical_rules(config, normalize))


def business_issues(df: DataFrame, config) -> DataFrame:
    return issues(df, business_rules(config))


def invalid_values(df: DataFrame, config, normalize=False) -> DataFrame:
    """Each invalid word with its column and number of rows, one job for all columns."""
    rules = applicable(df, categorical_rules(config, normalize))
    cells = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("column"),
                (F.upper(r.name) if r.name == "state" else F.col(r.name).cast("string")).alias("value"),
                r.mask().alias("bad"),
            )
            for r in rules
        ]
    )
    rows = df.select(F.explode(cells).alias("x")).select("x.*").where("bad")
    return rows.groupBy("column", "value").agg(F.count(F.lit(1)).alias("violations"))


def invalid_states(df: DataFrame, states: DataFrame, column="state", key="state") -> DataFrame:
    """State codes that a state table does not list, with their rows."""
    codes = df.where(F.col(column).isNotNull()).groupBy(F.upper(column).alias("value")).agg(
        F.count(F.lit(1)).alias("violations")
    )
    return codes.join(states.select(F.upper(key).alias("value")), "value", "left_anti")


def value_rules(config, normalize=False):
    return [*range_rules(config.ranges), *categorical_rules(config, normalize), *business_rules(config)]


def validate(df: DataFrame, config, normalize=False) -> DataFrame:
    """All issues: schema, ranges, categories and business rules (one data pass)."""
    structure = schema_issues(df, config.schema).select(
        "check", "rule", F.lit(None).cast("long").alias("violations"),
        F.lit(None).cast("double").alias("percentage"), F.lit(None).cast("double").alias("min_found"),
        F.lit(None).cast("double").alias("max_found"), "severity", F.col("detail").alias("description"),
    )
    return structure.unionByName(issues(df, value_rules(config, normalize)))


def summary(df: DataFrame, config, normalize=False) -> DataFrame:
    """total_rows, total_issues, validation_passed and has_errors from one pass.

    Any issue fails the validation, whatever its severity; has_errors looks at
    severities.
    """
    structure = schema_issues(df, config.schema).collect()
    share = F.col("violations") / F.col("rows")
    severity = F.coalesce("fixed_severity", F.when(share < 0.05, "warning").otherwise("error"))
    hit = F.col("violations") > 0
    total = (F.count_if(hit) + F.lit(len(structure))).cast("long")
    bad = F.lit(any(r.severity == "error" for r in structure))
    return (
        count_rules(df, value_rules(config, normalize))
        .agg(
            F.max("rows").alias("total_rows"),
            total.alias("total_issues"),
            F.coalesce(F.bool_or(known(hit & (severity == "error"))), F.lit(False)).alias("_errors"),
        )
        .select(
            "total_rows",
            "total_issues",
            (F.col("total_issues") == 0).alias("validation_passed"),
            (F.col("_errors") | bad).alias("has_errors"),
        )
    )


def validate_stages(frames: dict, config, normalize=False) -> DataFrame:
    """Issues of several stages of one table, e.g. before and after cleaning."""
    named = [
        validate(df, config, normalize).withColumn("stage", F.lit(name)) for name, df in frames.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), named)
