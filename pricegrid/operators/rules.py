"""Rule tables: any number of row conditions counted in one pass.

A rule is a SQL condition that is true for a violating row. All rules of a
table become conditional counts of a single aggregate, so checking forty rules
reads the data once and shuffles one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.predicates import known

WARNING_SHARE = 0.05


@dataclass(frozen=True)
class Rule:
    """severity None means: warning below 5 % of the rows, else error."""

    name: str
    condition: str
    columns: tuple = ()
    severity: str | None = "error"
    description: str = ""
    check: str = "rule"
    value: str | None = None

    def mask(self):
        return known(F.expr(self.condition))


def applicable(df: DataFrame, rules):
    """Rules whose columns the frame has."""
    have = set(df.columns)
    return [r for r in rules if set(r.columns) <= have]


def count_rules(df: DataFrame, rules, by=()) -> DataFrame:
    """One row per rule (and group): violations, rows and value extremes."""
    rules = applicable(df, rules)
    masked = df.select(
        *by,
        *[r.mask().alias(f"m{i}") for i, r in enumerate(rules)],
        *[
            F.when(r.mask(), F.col(r.value)).cast("double").alias(f"x{i}")
            for i, r in enumerate(rules)
            if r.value
        ],
    )
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, r in enumerate(rules):
        aggregates.append(F.count_if(f"m{i}").alias(f"v{i}"))
        if r.value:
            aggregates += [F.min(f"x{i}").alias(f"lo{i}"), F.max(f"x{i}").alias(f"hi{i}")]
    none = F.lit(None).cast("double")
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(r.check).alias("check"),
            F.lit(r.name).alias("rule"),
            F.col(f"v{i}").alias("violations"),
            (F.col(f"lo{i}") if r.value else none).alias("min_found"),
            (F.col(f"hi{i}") if r.value else none).alias("max_found"),
            F.lit(r.severity).cast("string").alias("fixed_severity"),
            F.lit(r.description).alias("description"),
        )
        for i, r in enumerate(rules)
    ]
    counted = masked.groupBy(*by).agg(*aggregates)
    return counted.select(*by, "rows", F.explode(F.array(*cells)).alias("r")).select(*by, "rows", "r.*")


def issues(df: DataFrame, rules, by=()) -> DataFrame:
    """Rules with at least one violation, their share and severity."""
    share = F.col("violations") / F.col("rows")
    by_share = F.when(share < WARNING_SHARE, "warning").otherwise("error")
    return (
        count_rules(df, rules, by)
        .where(F.col("violations") > 0)
        .select(
            *by,
            "check",
            "rule",
            "violations",
            F.round(share * 100, 6).alias("percentage"),
            "min_found",
            "max_found",
            F.coalesce("fixed_severity", by_share).alias("severity"),
            "description",
        )
    )


def reasons(rules):
    """Array of the names of the rules a row violates."""
    named = F.array(*[F.when(r.mask(), F.lit(r.name)) for r in rules])
    return F.filter(named, lambda x: x.isNotNull())
