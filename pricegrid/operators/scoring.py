"""Scoring of request records: defaults, validation, prediction, stamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.operators.rules import Rule, reasons
from pricegrid.operators.validation import in_list, number
from pricegrid.schema import CANONICAL, TableConfig

OPTIONAL = tuple(C.REQUEST_DEFAULTS)
REQUIRED = (
    "brand", "model", "year", "km", "state", "city", "fuel_type", "transmission", "engine_size",
    "color", "doors", "condition", "age_years",
)


def request_rules(config: TableConfig = CANONICAL, ranges=None):
    """Rules of a request: required fields, ranges, accepted words and states."""
    rules = [Rule(f"{c} missing", f"{c} is null", (c,)) for c in REQUIRED]
    for c, (low, high) in (ranges or C.REQUEST_RANGES).items():
        rules.append(Rule(f"{c} out of range", f"{c} < {number(low)} or {c} > {number(high)}", (c,)))
    for c, words in config.allowed.items():
        rules.append(Rule(f"{c} not accepted", f"{c} not in ({in_list(words)})", (c,)))
    if config.states:
        rules.append(Rule("state not accepted", f"upper(state) not in ({in_list(config.states)})", ("state",)))
    return rules


def checked_requests(df: DataFrame, config: TableConfig = CANONICAL, ranges=None) -> DataFrame:
    """Requests with an array of the rules they break (empty = valid)."""
    return df.withColumn("reasons", reasons(request_rules(config, ranges)))


def with_defaults(df: DataFrame, defaults=None, upper_state=True) -> DataFrame:
    """Fill the optional fields and upper-case the state."""
    defaults = defaults or C.REQUEST_DEFAULTS
    new = {
        c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()
    }
    if upper_state:
        new["state"] = F.upper("state")
    return df.withColumns(new)


def valid_and_rejected(df: DataFrame, config=CANONICAL, ranges=None):
    """Valid requests ready to score, and rejected ones with their reasons."""
    checked = checked_requests(df, config, ranges)
    bad = F.size("reasons") > 0
    return with_defaults(checked.where(~bad).drop("reasons")), checked.where(bad)


def score(df: DataFrame, model, name, version, prediction="prediction") -> DataFrame:
    """Predictions of any number of rows, stamped with model, version and time."""
    return model.transform(df).withColumns(
        {
            "prediction": F.col(prediction),
            "model_name": F.lit(name),
            "model_version": F.lit(version),
            "scored_at": F.current_timestamp(),
        }
    )
