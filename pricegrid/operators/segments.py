"""Segment metrics and error analysis of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.functions.bins import right_closed
from pricegrid.operators.evaluation import metrics
from pricegrid.operators.features import region_of
from pricegrid.operators.profiling import most_frequent


def price_segment(col="price", include_lowest=False):
    return right_closed(F.col(col), C.PRICE_SEGMENT_EDGES, C.PRICE_SEGMENT_LABELS, include_lowest)


def age_segment(df: DataFrame, include_lowest=False):
    """Age segment; without an age it is counted from the year. Age 0 has none by default."""
    if "age_years" in df.columns:
        age = F.col("age_years")
    else:
        age = F.lit(C.SEGMENT_FALLBACK_YEAR) - F.col("year")
    return right_closed(age, C.AGE_SEGMENT_EDGES, C.AGE_SEGMENT_LABELS, include_lowest)


def with_brand_segment(df: DataFrame, n=10, column="brand") -> DataFrame:
    """brand_segment: one of the n most frequent brands (ties by name), else Other."""
    names = most_frequent(df, column, n).select(F.col(column).alias("_brand"))
    joined = df.join(F.broadcast(names), F.col(column) == F.col("_brand"), "left")
    return joined.withColumn("brand_segment", F.coalesce("_brand", F.lit("Other"))).drop("_brand")


def with_segments(df: DataFrame, mapping=None, include_lowest=False) -> DataFrame:
    """All four segment columns. A mapping None with a region column keeps that column."""
    new = {"price_segment": price_segment("price", include_lowest)}
    if "age_years" in df.columns or "year" in df.columns:
        new["age_segment"] = age_segment(df, include_lowest)
    if "state" in df.columns and (mapping is not None or "region" not in df.columns):
        new["region"] = region_of(F.col("state"), mapping)
    df = df.withColumns(new)
    return with_brand_segment(df) if "brand" in df.columns else df


# Segment type -> segment column.
SEGMENTS = {
    "price": "price_segment",
    "age": "age_segment",
    "brand": "brand_segment",
    "region": "region",
}


def segment_metrics(df: DataFrame, segments=None, y="y", yhat="yhat") -> DataFrame:
    """Metrics per (segment_type, segment_value), all types in one pass."""
    segments = {t: c for t, c in (segments or SEGMENTS).items() if c in df.columns}
    cells = F.array(
        *[
            F.struct(F.lit(t).alias("segment_type"), F.col(c).cast("string").alias("segment_value"))
            for t, c in segments.items()
        ]
    )
    rows = (
        df.select(F.explode(cells).alias("s"), F.col(y).alias("y"), F.col(yhat).alias("yhat"))
        .select("s.*", "y", "yhat")
        .where(F.col("segment_value").isNotNull())
    )
    return metrics(rows, by=["segment_type", "segment_value"])


def error_columns(df: DataFrame, y="y", yhat="yhat") -> DataFrame:
    """error, absolute_error and percentage_error (of the actual value) per row."""
    error = F.col(y) - F.col(yhat)
    return df.withColumns(
        {
            "error": error,
            "absolute_error": F.abs(error),
            "percentage_error": F.try_divide(F.abs(error), F.col(y)) * 100,
        }
    )


def worst_predictions(df: DataFrame, n=50, key="listing_id") -> DataFrame:
    """The n rows with the largest absolute error, ties by key."""
    return df.orderBy(F.desc("absolute_error"), key).limit(n)
