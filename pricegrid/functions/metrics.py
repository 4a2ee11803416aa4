"""Regression metrics as aggregate expressions, and their rounding."""

from pyspark.sql import functions as F


def rmse(y, yhat):
    return F.sqrt(F.avg((y - yhat) * (y - yhat)))


def mae(y, yhat):
    return F.avg(F.abs(y - yhat))


def mape(y, yhat):
    """Mean absolute relative error over rows with y != 0; infinite without any."""
    mean = F.avg(F.when(y != 0, F.abs((y - yhat) / y)))
    return F.when(F.count(y) > 0, F.coalesce(mean, F.lit(float("inf"))))


def r2(y, yhat):
    """One minus residual over total variance; constant targets score 1 or 0."""
    sse = F.sum((y - yhat) * (y - yhat))
    sst = F.count(y) * F.var_pop(y)
    return (
        F.when(F.count(y) < 2, F.lit(None).cast("double"))
        .when(sst > 0, 1 - sse / sst)
        .when(sse == 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )


def metric_columns(y="y", yhat="yhat"):
    """n_samples, rmse, mae, mape and r2 as one list of aggregates."""
    y, yhat = F.col(y), F.col(yhat)
    return [
        F.count(F.lit(1)).alias("n_samples"),
        F.round(rmse(y, yhat), 4).alias("rmse"),
        F.round(mae(y, yhat), 4).alias("mae"),
        F.round(mape(y, yhat), 6).alias("mape"),
        F.round(r2(y, yhat), 6).alias("r2"),
    ]


METRICS = ["rmse", "mae", "mape", "r2"]
