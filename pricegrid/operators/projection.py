"""Schema-driven projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.functions.bins import below_labels
from pricegrid.operators.features import aligned, numeric_columns, quoted, string_columns


def rename_existing(df: DataFrame, mapping=None) -> DataFrame:
    """Rename the columns that exist."""
    return df.withColumnsRenamed(dict(mapping or C.RAW_RENAMES))


def reorder(df: DataFrame, order) -> DataFrame:
    """The listed columns that exist, in that order."""
    return df.select(*[quoted(c) for c in order if c in df.columns])


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c) for c in numeric_columns(df)])


def select_text(df: DataFrame) -> DataFrame:
    return df.select(*[quoted(c) for c in string_columns(df)])


def align(df: DataFrame, features, keep=()) -> DataFrame:
    """Exactly the expected feature columns: absent ones are 0, others dropped."""
    return df.select(*[quoted(c) for c in keep], *aligned(df, features))


def price_category(col="price"):
    """Price word by left-closed limits."""
    return below_labels(F.col(col), C.PRICE_CATEGORIES)
