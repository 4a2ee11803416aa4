"""Regression metrics, residual statistics, model and split comparison."""

from __future__ import annotations

from functools import reduce
from statistics import NormalDist

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.metrics import METRICS, metric_columns
from pricegrid.operators.order import quantile_values, quantiles


def metrics(df: DataFrame, y="y", yhat="yhat", by=()) -> DataFrame:
    """n_samples, rmse, mae, mape and r2, overall or per group, in one pass."""
    return df.groupBy(*by).agg(*metric_columns(y, yhat))


def long_predictions(df: DataFrame, models: dict, y="y", keep=()) -> DataFrame:
    """One row per model and record from a frame with a prediction column per model.

    models: {model name: prediction column}.
    """
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("yhat"))
            for name, c in models.items()
        ]
    )
    return df.select(*keep, F.col(y).alias("y"), F.explode(cells).alias("p")).select(*keep, "y", "p.*")


def compare_models(df: DataFrame, models: dict, y="y", by=()) -> DataFrame:
    """One row of metrics per model (and group), all from one pass."""
    return metrics(long_predictions(df, models, y, by), by=("model", *by))


def metric_drift(compared: DataFrame, split_col="split", base="val", other="test", which=METRICS):
    """Difference and percent change of each metric from one split to another."""
    wide = compared.groupBy("model").agg(
        *[
            F.first(F.when(F.col(split_col) == name, F.col(m)), True).alias(f"{m}_{side}")
            for m in which
            for side, name in (("base", base), ("other", other))
        ]
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(m.upper()).alias("metric"),
                    F.col(f"{m}_base").alias("validation"),
                    F.col(f"{m}_other").alias("test"),
                )
                for m in which
            ]
        )
    )
    change = F.col("test") - F.col("validation")
    return (
        wide.select("model", rows.alias("r"))
        .select("model", "r.*")
        .withColumn("difference", F.round(change, 4))
        .withColumn("pct_change", F.round(F.try_divide(change, F.col("validation")) * 100, 4))
    )


def pick_model(available, wanted):
    """The wanted model, or the first one when it was not trained."""
    return wanted if wanted in available else next(iter(available))


RESIDUAL_STATS = ["mean", "std", "min", "max", "median", "skewness", "kurtosis"]


def residual_stats(df: DataFrame, y="y", yhat="yhat", by=()) -> DataFrame:
    """Moments and extremes of y - yhat; the median is exact at any size."""
    by = list(by)
    rows = df.select(*by, (F.col(y) - F.col(yhat)).alias("e"))
    moments = rows.groupBy(*by).agg(
        F.avg("e").alias("mean"),
        F.stddev_pop("e").alias("std"),
        F.min("e").alias("min"),
        F.max("e").alias("max"),
        F.skewness("e").alias("skewness"),
        F.kurtosis("e").alias("kurtosis"),
    )
    middle = quantiles(rows, ["e"], [0.5], by).select(*by, F.col("e")[0].alias("median"))
    joined = moments.join(middle, by) if by else moments.crossJoin(F.broadcast(middle))
    return joined.select(*by, *[F.round(c, 4).alias(c) for c in RESIDUAL_STATS])


def summary_report(df: DataFrame, y="y", yhat="yhat", by=()) -> DataFrame:
    """Metric and residual statistics as (metric, value) rows."""
    by = list(by)
    scores, residuals = metrics(df, y, yhat, by), residual_stats(df, y, yhat, by)
    one = scores.join(residuals, by) if by else scores.crossJoin(F.broadcast(residuals))
    names = {m: m.upper() for m in METRICS} | {s: f"Residual {s.capitalize()}" for s in RESIDUAL_STATS}
    cells = F.array(
        *[
            F.struct(F.lit(label).alias("metric"), F.col(c).cast("double").alias("value"))
            for c, label in names.items()
        ]
    )
    return one.select(*by, F.explode(cells).alias("m")).select(*by, "m.*")


def residual_sample(df: DataFrame, n: int, key="listing_id", seed=42) -> DataFrame:
    """Seeded sample of (actual, predicted, residual) for scatter charts."""
    from pricegrid.sources.tables import sample_rows

    residual = (F.col("y") - F.col("yhat")).alias("residual")
    return sample_rows(df, n, key, seed).select(key, "y", "yhat", residual)


def qq_points(df: DataFrame, points=99, y="y", yhat="yhat") -> DataFrame:
    """Residual quantiles against normal quantiles at evenly spaced positions."""
    probs = [(i + 0.5) / points for i in range(points)]
    rows = df.select((F.col(y) - F.col(yhat)).alias("e"))
    values = quantile_values(rows, ["e"], probs)["e"]
    normal = NormalDist()
    points_ = [(p, normal.inv_cdf(p), v) for p, v in zip(probs, values)]
    return df.sparkSession.createDataFrame(
        points_, "position double, theoretical double, observed double"
    )


def stack_frames(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


