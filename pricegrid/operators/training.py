"""Regression models on Spark ML: baselines, linear models, trees and search."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import Lock

import numpy as np
from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml import Model, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.operators.features import _Fitted, _Fitter, _Settings
from pricegrid.operators.order import quantile_values
from pricegrid.session import lineage_dir, shared_dir, stage

FEATURES, LABEL, PREDICTION = "features", "label", "prediction"


class ConstantRegressor(_Fitter):
    """Predicts the mean or the median of the training target."""

    def __init__(self, statistic="mean", label=LABEL, prediction=PREDICTION):
        super().__init__()
        if statistic not in ("mean", "median"):
            raise ValueError(f"unknown statistic: {statistic}")
        self._put(statistic=statistic, label=label, prediction=prediction)

    def _fit(self, df):
        label = self.opt("label")
        if self.opt("statistic") == "mean":
            value = df.agg(F.avg(label)).first()[0]
        else:
            value = quantile_values(df, [label], [0.5])[label][0]
        return ConstantModel()._put(value=value, prediction=self.opt("prediction"))


class ConstantModel(_Fitted):
    @property
    def value(self):
        return self.opt("value")

    def _transform(self, df):
        return df.withColumn(self.opt("prediction"), F.lit(self.value).cast("double"))


def linear(label=LABEL, features=FEATURES):
    """Ordinary least squares by the normal equations."""
    return LinearRegression(
        labelCol=label, featuresCol=features, regParam=0.0, solver="normal", standardization=False
    )


def ridge(df: DataFrame, alpha=1.0, label=LABEL, features=FEATURES):
    """Least squares plus alpha * |w|^2.

    Spark penalizes the mean squared error of a target scaled by its deviation,
    so the equal penalty is alpha * stddev(y) / n.
    """
    deviation, n = df.agg(F.stddev_pop(label), F.count(label)).first()
    return LinearRegression(
        labelCol=label,
        featuresCol=features,
        regParam=alpha * (deviation or 0.0) / max(n, 1),
        elasticNetParam=0.0,
        standardization=False,
        solver="normal",
    )


def lasso(alpha=1.0, label=LABEL, features=FEATURES, max_iter=500):
    """Half the mean squared error plus alpha * |w|."""
    return LinearRegression(
        labelCol=label,
        featuresCol=features,
        regParam=alpha,
        elasticNetParam=1.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-10,
    )


def decision_tree(depth=10, leaf=10, seed=42, label=LABEL, features=FEATURES):
    return DecisionTreeRegressor(
        labelCol=label, featuresCol=features, maxDepth=depth, minInstancesPerNode=leaf, seed=seed
    )


@dataclass
class TrainingResult:
    """Fitted models by name with parameters, seconds and validation RMSE.

    `judged` holds all candidates of a search: (parameters, RMSE) in drawn order.
    """

    models: dict = field(default_factory=dict)
    params: dict = field(default_factory=dict)
    seconds: dict = field(default_factory=dict)
    rmse: dict = field(default_factory=dict)
    judged: dict = field(default_factory=dict)

    def add(self, name, model, seconds, params=None, rmse=None, judged=()):
        self.models[name] = model
        self.seconds[name] = seconds
        self.params[name] = params or {}
        self.rmse[name] = None if rmse is None else float(rmse)
        self.judged[name] = [(p, float(score)) for p, score in judged]

    def merge(self, other):
        for part in ("models", "params", "seconds", "rmse", "judged"):
            getattr(self, part).update(getattr(other, part))
        return self

    def predict(self, df: DataFrame, prediction=PREDICTION) -> DataFrame:
        """One frame with a column yhat_{model} per model (a chain of narrow steps)."""
        if not self.models:
            raise ValueError("no models were trained")
        for name, model in self.models.items():
            df = model.transform(df).withColumnRenamed(prediction, f"yhat_{name}")
        return df

    @property
    def prediction_columns(self):
        return {name: f"yhat_{name}" for name in self.models}

    def candidates(self, spark) -> DataFrame:
        """One row per candidate of every search: model, number, parameters, RMSE, chosen."""
        rows = [
            (name, k, {p: str(v) for p, v in params.items()}, score, params == self.params[name])
            for name, judged in self.judged.items()
            for k, (params, score) in enumerate(judged)
        ]
        return spark.createDataFrame(
            rows, "model string, candidate int, params map<string,string>, rmse double, chosen boolean"
        )

    def facts(self, df: DataFrame, grids: dict) -> DataFrame:
        """What holds of searches whatever the data, per model and split.

        Rows, candidates judged, whether the chosen values lie in the grid and
        have the lowest error of all candidates, and on train whether the model
        errs no more than the train mean would.
        """
        errors = [
            F.struct(
                F.lit(name).alias("model"),
                F.lit(len(self.judged[name])).cast("long").alias("candidates"),
                F.lit(all(self.params[name][p] in values for p, values in grids[name].items())).alias("in_grid"),
                F.lit(self.rmse[name] == min(score for _, score in self.judged[name])).alias("lowest"),
                F.sqrt(F.avg(F.pow(F.col(LABEL) - F.col(column), 2))).alias("rmse"),
            )
            for name, column in self.prediction_columns.items()
        ]
        found = self.predict(df).groupBy("split").agg(
            F.count(F.lit(1)).alias("n_samples"), F.stddev_pop(LABEL).alias("deviation"), F.array(*errors).alias("m")
        )
        found = found.select("split", "n_samples", "deviation", F.explode("m").alias("m"))
        fits = F.when(F.col("split") == "train", F.col("m.rmse") <= F.col("deviation") * (1 + 1e-9))
        return found.select(
            "m.model", "split", "n_samples", "m.candidates", "m.in_grid", "m.lowest", fits.alias("fits_train")
        )

    def table(self, spark) -> DataFrame:
        """One row per model: type, parameters, seconds, validation RMSE."""
        rows = [
            (n, type(m).__name__, str(self.params[n]), float(self.seconds[n]), self.rmse[n])
            for n, m in self.models.items()
        ]
        return spark.createDataFrame(
            rows, "model string, model_type string, params string, seconds double, rmse double"
        )


def train_baselines(train: DataFrame, alpha=1.0, seed=42, which=None) -> TrainingResult:
    """Mean, median, linear, ridge, lasso and tree on a frame with features and label.

    The frame is read many times, so keep it in a stage table or persist it.
    """
    makers = {
        "mean_baseline": lambda: ConstantRegressor("mean"),
        "median_baseline": lambda: ConstantRegressor("median"),
        "linear_regression": linear,
        "ridge_regression": lambda: ridge(train, alpha),
        "lasso_regression": lambda: lasso(alpha),
        "decision_tree": lambda: decision_tree(seed=seed),
    }
    result = TrainingResult()
    for name, make in makers.items():
        if which is None or name in which:
            start = time.time()
            result.add(name, make().fit(train), time.time() - start)
    return result


def sample_grid(grid: dict, n, seed=42):
    """n different parameter sets of a grid, drawn with a seed."""
    combos = [dict(zip(grid, values)) for values in product(*grid.values())]
    order = np.random.default_rng(seed).permutation(len(combos))
    return [combos[i] for i in order[: min(n, len(combos))]]


# Parameter grids of the searches, under Spark's parameter names.
FOREST_GRID = {
    "numTrees": [50, 100, 150],
    "maxDepth": [10, 20],
    "minInstancesPerNode": [2, 4],
}
BOOST_GRID = {
    "maxIter": [300, 500],
    "stepSize": [0.05, 0.1],
    "maxDepth": [4, 6],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "all"],
    "minInstancesPerNode": [1, 5],
}
DEEP_BOOST_GRID = {
    "maxIter": [300, 500],
    "stepSize": [0.05, 0.1],
    "maxDepth": [8, 12],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["0.8", "all"],
    "minInstancesPerNode": [10, 20],
}


def rmse_evaluator():
    return RegressionEvaluator(labelCol=LABEL, predictionCol=PREDICTION, metricName="rmse")


# Nodes of one part of a forest, some 300 bytes each on the driver while
# they grow, parts that grow side by side or are applied in one pass, and the step
# between the seeds of parts.
PART_NODES, PARTS_BESIDE, SEED_STEP = 125_000, 4, 1_000_003


def part_sizes(trees, depth, rows, leaf, part_nodes=PART_NODES):
    """Numbers of trees of the parts: at most `part_nodes` nodes a part, one tree at least.

    A tree has at most 2^depth leaves, and no more than its rows give leaves of `leaf` rows.
    """
    nodes = 2 * max(1, min(2**depth, rows // leaf))
    parts = math.ceil(trees / max(1, part_nodes // nodes))
    return [trees // parts + (k < trees % parts) for k in range(parts)]


class PartedForest(_Fitter):
    """Random forest grown and written in parts of whole trees.

    Spark gathers all trees of a fit on the driver. Trees are drawn independently, so
    parts with seeds of their own are the same forest; the driver holds `beside` parts at
    a time. A forest of one part is Spark's own model. What a part holds still grows with
    the rows where a single tree passes `part_nodes`, up to 2^depth leaves.
    """

    def __init__(self, part_nodes=PART_NODES, beside=1, **options):
        super().__init__()
        self._put(part_nodes=part_nodes, beside=beside, **options)

    def _fit(self, df):
        options = dict(self.getOrDefault(self.settings))
        part_nodes, beside, trees, seed = (options.pop(k) for k in ("part_nodes", "beside", "numTrees", "seed"))
        rows = int(df.count() * options["subsamplingRate"])
        sizes = part_sizes(trees, options["maxDepth"], rows, options["minInstancesPerNode"], part_nodes)

        def grow(k):
            return RandomForestRegressor(numTrees=sizes[k], seed=seed + k * SEED_STEP, **options).fit(df)

        if len(sizes) == 1:
            return grow(0)
        path = shared_dir(df.sparkSession, "forest")

        def write(k):
            grow(k).write().save(f"{path}/part_{k}")

        with ThreadPool(min(beside, len(sizes))) as pool:
            pool.map(inheritable_thread_target(df.sparkSession)(write), range(len(sizes)), chunksize=1)
        return PartedForestModel()._put(path=path, sizes=sizes, prediction=PREDICTION)


class _PartsWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for k in range(len(self.instance.opt("sizes"))):
            self.instance.part(k).write().save(f"{path}/part_{k}")


class _PartsReader(MLReader):
    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = PartedForestModel()
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance._put(path=path)


class PartedForestModel(Model, _Settings, MLReadable, MLWritable):
    """A forest in parts below a shared folder; PARTS_BESIDE of them are applied in one pass.

    Between two passes the rows are written with their sum so far, so the driver holds
    the parts of one pass. A stream is not written: there all parts are held.
    """

    def part(self, k):
        return RandomForestRegressionModel.load(f"{self.opt('path')}/part_{k}")

    @property
    def getNumTrees(self):
        return sum(self.opt("sizes"))

    def _transform(self, df):
        total, one = "__forest_sum", "__forest_part"
        rows = df.withColumn(total, F.lit(0.0))
        for k, trees in enumerate(self.opt("sizes")):
            if k and k % PARTS_BESIDE == 0 and not df.isStreaming:
                rows = stage(rows, "forest-sums")
            found = self.part(k).setPredictionCol(one).transform(rows)
            rows = found.withColumn(total, F.col(total) + F.col(one) * trees).drop(one)
        return rows.withColumn(self.opt("prediction"), F.col(total) / self.getNumTrees).drop(total)

    def write(self):
        return _PartsWriter(self)

    @classmethod
    def read(cls):
        return _PartsReader()


def search_forest(
    train, grid=None, n=3, folds=2, seed=42, parallelism=1, sample=0.2, beside=PARTS_BESIDE, rows_per_task=50_000
):
    """Random forest by seeded search with cross-validation on RMSE.

    Each of the `parallelism` fits holds `beside` parts of its forest on the driver. Spark
    keeps the node that each row has come to in each tree; without that every row walks down
    all trees again at every level, and every task is sent all trees. As in boosting, parts
    side by side take fewer, larger tasks, as each task sends the counts of all nodes.
    """
    lineage_dir(train.sparkSession)
    options = dict(
        labelCol=LABEL, featuresCol=FEATURES, seed=seed, subsamplingRate=sample, featureSubsetStrategy="sqrt",
        numTrees=20, maxDepth=5, minInstancesPerNode=1, cacheNodeIds=True, part_nodes=PART_NODES, beside=beside,
    )
    train = train.coalesce(max(1, math.ceil(train.count() / (rows_per_task * beside * parallelism))))
    forest = PartedForest(**options)
    candidates = sample_grid(grid or FOREST_GRID, n, seed)
    maps = [{forest.settings: {**options, **c}} for c in candidates]
    start = time.time()
    found = CrossValidator(
        estimator=forest, estimatorParamMaps=maps, evaluator=rmse_evaluator(), numFolds=folds,
        seed=seed, parallelism=parallelism,
    ).fit(train)
    best = int(np.argmin(found.avgMetrics))
    result = TrainingResult()
    result.add(
        "random_forest", found.bestModel, time.time() - start, candidates[best], found.avgMetrics[best],
        zip(candidates, found.avgMetrics),
    )
    return result


def first_rounds(model: GBTRegressionModel, rounds) -> GBTRegressionModel:
    """The boosted model as it was after so many rounds."""
    if rounds >= model.getNumTrees:
        return model
    java, context = model._java_obj, SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(jvm.double, rounds)
    for k, (tree, weight) in enumerate(zip(java.trees()[:rounds], list(java.treeWeights())[:rounds])):
        trees[k], weights[k] = tree, float(weight)
    cut = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, weights))
    return cut.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def shared_fits(candidates):
    """Candidates grouped by all parameters but the rounds: {fit: [candidate number]}."""
    groups = {}
    for k, params in enumerate(candidates):
        rest = tuple(sorted((p, v) for p, v in params.items() if p != "maxIter"))
        groups.setdefault(rest, []).append(k)
    return groups


# Bytes that a boosted fit keeps of a row (the row in bins of four bytes a
# feature, three generations of predictions, residuals) and the most rows of a task.
FIT_ROW_BYTES, TASK_ROWS = 300, 2_000_000


def fits_in_memory(spark, rows, n_features) -> int:
    """Fits over so many rows whose kept rows fit side by side, one at least.

    Half of the executors' memory for storage counts; tasks may claim the other half.
    """
    found, total = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator(), 0
    while found.hasNext():
        total += found.next()._1()
    return max(1, total // 2 // max(1, rows * (FIT_ROW_BYTES + 4 * n_features)))


def fit_tasks(rows, rows_per_task, beside, cores) -> int:
    """Tasks of a fit: `rows_per_task` rows times the fits side by side for each, no more
    than two for each of its cores, as every task sends the counts of all nodes of a level,
    but of TASK_ROWS rows at most."""
    most = max(2 * math.ceil(cores / beside), math.ceil(rows / TASK_ROWS))
    return max(1, min(math.ceil(rows / (rows_per_task * beside)), most))


def search_boosting(
    train, validation=None, grid=None, n=10, seed=42, name="gradient_boosting",
    early_stopping=False, features=FEATURES, parallelism=8, rows_per_task=50_000,
):
    """Gradient-boosted trees, the candidate with the lowest validation RMSE.

    Without validation rows the training rows judge. With early_stopping the
    validation rows also end the boosting of each candidate.

    Rounds are only ever added, so candidates that differ in their number alone are
    one fit, judged after every round by one pass over the rows that judge. Fits are
    independent: `parallelism` of them run side by side and share the cores, fewer where the
    rows that each keeps in memory for all its rounds would push out those of the others.
    Each takes tasks of at least `rows_per_task` rows times the fits side by side: a round's
    time on few rows is the start of its tasks, and every task sends the counts of all nodes
    of a level. Only the best model so far is kept. Spark cuts the lineage of the rounds by
    checkpoints.
    """
    start, judge, spark = time.time(), train if validation is None else validation, train.sparkSession
    lineage_dir(spark)
    candidates = sample_grid(grid or BOOST_GRID, n, seed)
    stops = early_stopping and validation is not None
    rows = train
    if stops:
        rows = train.withColumn("is_validation", F.lit(False)).unionByName(
            validation.withColumn("is_validation", F.lit(True))
        )
    groups = shared_fits(candidates)
    n_rows, row = rows.count(), rows.select(features).first()
    beside = max(1, min(parallelism, len(groups), fits_in_memory(spark, n_rows, len(row[0]) if row else 0)))
    rows = rows.coalesce(fit_tasks(n_rows, rows_per_task, beside, spark.sparkContext.defaultParallelism))
    scores, kept, lock = [None] * len(candidates), [], Lock()

    def fit(group):
        rest, members = group
        rounds = max(candidates[k].get("maxIter", 20) for k in members)
        model = GBTRegressor(labelCol=LABEL, featuresCol=features, seed=seed, maxIter=rounds, **dict(rest))
        fitted = (model.setValidationIndicatorCol("is_validation") if stops else model).fit(rows)
        errors = fitted.evaluateEachIteration(judge, "squared")
        for k in members:
            scores[k] = math.sqrt(errors[min(candidates[k].get("maxIter", 20), len(errors)) - 1])
        # An unknown error (no rows that judge) comes first, as in argmin.
        found = min((-math.inf if math.isnan(scores[k]) else scores[k], k) for k in members)
        with lock:
            if not kept or found < kept[0]:
                kept[:] = [found, fitted]

    def levels(group):
        return max(candidates[k].get("maxIter", 20) * candidates[k].get("maxDepth", 5) for k in group[1])

    with ThreadPool(beside) as pool:
        # The longest fits start first.
        ordered = sorted(groups.items(), key=levels, reverse=True)
        pool.map(inheritable_thread_target(spark)(fit), ordered, chunksize=1)
    (_, best), model = kept
    model = first_rounds(model, candidates[best].get("maxIter", 20))
    result = TrainingResult()
    result.add(name, model, time.time() - start, candidates[best], scores[best], zip(candidates, scores))
    return result


def train_advanced(train, validation=None, grids=None, counts=(3, 10, 10), seed=42, deep=True):
    """Forest and both boosting searches; grids may replace the default ones."""
    grids = grids or {}
    result = search_forest(train, grids.get("forest"), counts[0], seed=seed)
    result.merge(
        search_boosting(train, validation, grids.get("boosting"), counts[1], seed, "gradient_boosting")
    )
    if deep:
        grid = grids.get("deep_boosting") or DEEP_BOOST_GRID
        result.merge(search_boosting(train, validation, grid, counts[2], seed, "deep_boosting"))
    return result


def fit_on(stages, estimator, train) -> Model:
    """Feature stages and an estimator as one saved-and-loaded-as-one model."""
    return Pipeline(stages=[*stages, estimator]).fit(train)
