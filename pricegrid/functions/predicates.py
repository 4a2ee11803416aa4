"""Row conditions whose result is never null."""

from functools import reduce

from pyspark.sql import functions as F


def known(condition):
    """A condition on missing values counts as not met."""
    return F.coalesce(condition, F.lit(False))


def differs(a, b):
    """True when the values differ or either is missing."""
    return F.coalesce(a != b, F.lit(True))


def not_in(col, values):
    """True when the value is missing or not in the list."""
    return ~known(col.isin(list(values)))


def outside(col, low, high):
    return known((col < low) | (col > high))


def any_of(conditions):
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def nan_to_null(df):
    """Replace NaN by null in every floating column of a freshly read table."""
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df
