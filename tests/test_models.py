import gc
import inspect
import random
import threading
import weakref
from multiprocessing.pool import ThreadPool
from unittest.mock import MagicMock

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from pricegrid.operators import evaluation, scoring, segments, training
from pricegrid.operators import features as fe
from pricegrid.operators.registry import Registry, latest_versions, next_versions
from pricegrid.plans import model_queries
from pricegrid.session import shared_dir
from pricegrid.streaming import quality as stream_quality
from pricegrid.streaming import scoring as stream_scoring
from tests.conftest import FORD, HONDA, SF, TOYOTA, frame


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 3)) * [1, 5, 0.3]
    y = x @ [4.0, -2.0, 0.0] + 30 + rng.normal(size=500)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, label double")
    return x, y, fe.FeatureVector(["a", "b", "c"]).transform(df).cache()


def closed_form(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - x.mean(0) @ w


def test_linear_and_ridge_equal_the_closed_form(numbers):
    x, y, df = numbers
    for estimator, alpha in ((training.linear(), 0.0), (training.ridge(df, 100.0), 100.0)):
        model = estimator.fit(df)
        w, b = closed_form(x, y, alpha)
        assert model.coefficients.toArray() == pytest.approx(w, abs=1e-6)
        assert model.intercept == pytest.approx(b, abs=1e-6)


def test_lasso_equals_coordinate_descent(numbers):
    x, y, df = numbers
    xc, yc, w = x - x.mean(0), y - y.mean(), np.zeros(3)
    for _ in range(500):
        for j in range(3):
            rho = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - 0.5, 0) / (xc[:, j] @ xc[:, j] / len(y))
    assert training.lasso(0.5).fit(df).coefficients.toArray() == pytest.approx(w, abs=1e-4)


def test_search_beats_the_mean_and_is_repeatable(numbers):
    _, _, df = numbers
    train, val = df.randomSplit([0.7, 0.3], 1)
    grid = {"maxIter": [5, 10], "stepSize": [0.3], "maxDepth": [3]}
    found = training.search_boosting(train, val, grid, n=2)
    baseline = training.train_baselines(train, which=["mean_baseline", "median_baseline", "decision_tree"])
    merged = baseline.merge(found)
    scores = {r.model: r.rmse for r in evaluation.compare_models(merged.predict(val), merged.prediction_columns, "label").collect()}
    assert scores["gradient_boosting"] < scores["mean_baseline"]
    assert scores["decision_tree"] < scores["mean_baseline"]
    assert training.sample_grid(training.BOOST_GRID, 10) == training.sample_grid(training.BOOST_GRID, 10)
    assert len({str(p) for p in training.sample_grid(training.FOREST_GRID, 99)}) == 12


def test_metrics_special_cases(spark):
    df = spark.createDataFrame([("z", 0.0, 1.0), ("z", 0.0, 2.0), ("c", 5.0, 5.0), ("c", 5.0, 5.0), ("one", 3.0, 1.0)],
                               "g string, y double, yhat double")
    found = {r.g: r for r in evaluation.metrics(df, by=["g"]).collect()}
    assert found["z"].mape == float("inf") and found["z"].r2 == 0.0
    assert found["c"].r2 == 1.0 and found["c"].rmse == 0.0
    assert found["one"].r2 is None and found["one"].mae == 2.0
    stats = evaluation.residual_stats(df).first()
    assert stats["median"] == 0.0 and stats["max"] == 2.0


def test_segments(spark):
    rows = [dict(TOYOTA, age_years=0), dict(HONDA, price=30000.0), dict(FORD, price=250000.0)]
    df = segments.with_segments(frame(spark, rows))
    got = {r.brand: (r.price_segment, r.age_segment, r.region) for r in df.collect()}
    assert got == {"Toyota": ("30-50k", None, "Sudeste"), "Honda": ("<30k", "3-5", "Sudeste"),
                   "Ford": (">200k", "3-5", "Sudeste")}
    # Without ages they are counted to the fallback year 2024: 9, 6 and 4 years.
    plain = df.drop("age_years")
    found = plain.select("brand", segments.age_segment(plain).alias("s")).collect()
    assert {r.brand: r.s for r in found} == {"Toyota": "6-10", "Honda": "6-10", "Ford": "3-5"}


def car_model(spark):
    train = frame(spark, [TOYOTA, HONDA, FORD]).select("brand", "price")
    stages = [fe.TargetMeanEncoder(["brand"], drop=False), fe.ColumnContract(keep=["brand", "price"]),
              fe.FeatureVector(["brand_encoded"]), training.linear("price")]
    return Pipeline(stages=stages).fit(train)


def test_registry_round_trip(spark):
    store = Registry(spark, shared_dir(spark, "registry"))
    assert store.next_version("m") == "v1.0.0"
    model = car_model(spark)
    for version in (None, "v1.0.9", "v1.0.10", None):
        store.save(model, "m", "linear", {"rmse": 1.5}, version=version, hyperparameters={"alpha": 1})
    assert store.versions("m") == ["v1.0.0", "v1.0.9", "v1.0.10", "v1.0.11"]
    loaded, entry = store.load("m")
    assert entry.version == "v1.0.11" and entry.feature_list == ["brand_encoded"]
    assert loaded.transform(frame(spark, [HONDA]).select("brand")).first().prediction == pytest.approx(70000.0)
    store.set_production("m", "v1.0.9")
    store.set_production("m", "v1.0.10")
    assert store.production("m") == "v1.0.10" and store.production("other") is None
    assert latest_versions(store.entries()).first().latest_version == "v1.0.11"
    assert next_versions(store.entries()).first().next_version == "v1.0.12"
    with pytest.raises(ValueError):
        store.load("absent")
    with pytest.raises(ValueError):
        store.set_production("m", "v9.9.9")


def test_registry_gives_concurrent_writers_different_versions(spark):
    path, model = shared_dir(spark, "registry-race"), car_model(spark)
    with ThreadPool(5) as pool:
        versions = pool.map(lambda k: Registry(spark, path).save(model, "m", "linear", {"rmse": float(k)}), range(5))
    store = Registry(spark, path)
    assert sorted(versions) == store.versions("m") == [f"v1.0.{k}" for k in range(5)]
    assert store.entries().select("path").distinct().count() == 5
    # A writer that has read an older state loses its number and decides again.
    late, last = Registry(spark, path), store.log.last()
    seen = iter([last - 1, last - 1])
    late.log.last = lambda: next(seen, None) or store.log.last()
    assert late.save(model, "m", "linear", {}) == "v1.0.5"
    with pytest.raises(ValueError):
        late.save(model, "m", "linear", {}, version="v1.0.3")
    assert store.log.commit(last, {"action": "choose"}) is False
    assert len(store.versions("m", upto=last)) == 5 and len(store.versions("m")) == 6


def test_registry_bulk_commits(spark):
    store = Registry(spark, shared_dir(spark, "registry-bulk"))
    rows = spark.createDataFrame([("a", "v1.0.2"), ("a", "v1.0.10"), ("b", "v2.0.0")], "model_name string, version string")
    store.save_all(rows)
    assert store.next_version("a") == "v1.0.11" and store.log.last() == 0
    for bad in (rows, rows.limit(1).unionByName(rows.limit(1)).withColumn("version", F.lit("v9.0.0"))):
        with pytest.raises(ValueError):
            store.save_all(bad)
    store.choose_all(rows.where("version <> 'v1.0.10'"))
    store.choose_all(rows.where("version = 'v1.0.10'"))
    assert (store.production("a"), store.production("b")) == ("v1.0.10", "v2.0.0")
    with pytest.raises(ValueError):
        store.choose_all(rows.withColumn("version", F.lit("v0.0.0")))


def test_rounds_are_prefixes_and_shared(spark):
    rng = random.Random(4)
    data = [(Vectors.dense([rng.random() for _ in range(3)]),) for _ in range(300)]
    df = spark.createDataFrame(data, ["features"])
    at = vector_to_array("features")
    df = df.withColumn("label", 5 * at[0] + F.sin(9 * at[1]) + at[2]).repartition(2).cache()
    options = dict(labelCol="label", featuresCol="features", seed=7, subsamplingRate=0.8, maxDepth=3)
    long, short = (GBTRegressor(maxIter=n, **options).fit(df) for n in (9, 4))
    cut = training.first_rounds(long, 4)
    assert cut.getNumTrees == 4 and cut.treeWeights == short.treeWeights
    both = [[r.prediction for r in m.transform(df).collect()] for m in (cut, short)]
    assert both[0] == pytest.approx(both[1])
    grid = {"maxIter": [4, 9], "maxDepth": [2, 3], "subsamplingRate": [0.8]}
    assert sorted(map(len, training.shared_fits(training.sample_grid(grid, 4)).values())) == [2, 2]
    found = training.search_boosting(df, None, grid, 4, seed=7, parallelism=2)
    judged = found.judged["gradient_boosting"]
    for params, score in judged:
        alone = GBTRegressor(labelCol="label", featuresCol="features", seed=7, **params).fit(df.coalesce(1))
        assert score == pytest.approx(training.rmse_evaluator().evaluate(alone.transform(df)))
    chosen = found.params["gradient_boosting"]
    assert found.models["gradient_boosting"].getNumTrees == chosen["maxIter"]
    assert found.rmse["gradient_boosting"] == min(score for _, score in judged)
    rows = found.candidates(spark).collect()
    assert len(rows) == 4 and [r.chosen for r in rows].count(True) == 1
    fact = found.facts(df.withColumn("split", F.lit("train")), {"gradient_boosting": grid}).first()
    assert (fact.n_samples, fact.candidates, fact.in_grid, fact.lowest, fact.fits_train) == (300, 4, True, True, True)


REQUEST = {k: v for k, v in TOYOTA.items() if k != "price"} | dict(
    brand="Fiat", model="Uno", year=2020, engine_size=1.0, age_years=4, year_of_reference=2024, month_of_reference="2024-01")
BAD = [dict(REQUEST, year=1980), dict(REQUEST, km=-1.0), dict(REQUEST, doors=6), dict(REQUEST, fuel_type="Steam"),
       dict(REQUEST, state="XX"), dict(REQUEST, city=None), dict(REQUEST, year_of_reference=2019)]


def requests(spark):
    good = [REQUEST, dict(REQUEST, state="sp", year_of_reference=None, month_of_reference=None)]
    return frame(spark, good + BAD).drop("price")


def test_request_rules(spark):
    valid, rejected = scoring.valid_and_rejected(requests(spark))
    assert valid.count() == 2 and rejected.count() == len(BAD)
    row = valid.orderBy(F.desc("year_of_reference")).collect()[0]
    assert (row.state, row.year_of_reference, row.month_of_reference) == ("SP", 2024, "2024-01")
    assert valid.where("state = 'SP' and year_of_reference = 2024").count() == 2
    assert {r.reasons[0] for r in rejected.collect()} == {
        "year out of range", "km out of range", "doors out of range", "fuel_type not accepted",
        "state not accepted", "city missing", "year_of_reference out of range"}


def test_stream_scores_equal_batch_scores(spark):
    base, df = shared_dir(spark, "stream"), requests(spark)
    df.repartition(3).write.json(f"{base}/in")
    model = car_model(spark)
    stream = stream_scoring.request_stream(spark, f"{base}/in", df.schema, files_per_batch=1)
    stream_scoring.score_stream(stream, model, "m", "v1.0.0", f"{base}/out", f"{base}/cp").awaitTermination()
    scored = spark.read.parquet(f"{base}/out/scored")
    batch = scoring.score(scoring.valid_and_rejected(df)[0], model, "m", "v1.0.0")
    assert sorted(r.prediction for r in scored.collect()) == sorted(r.prediction for r in batch.collect())
    assert spark.read.parquet(f"{base}/out/rejected").count() == len(BAD)


def test_late_events_are_dropped(spark):
    base = shared_dir(spark, "late")
    schema = "ts timestamp, event_type string, value double, props string"

    def batch(n, rows):
        frame_ = spark.createDataFrame(rows, "t string, event_type string, value double, props string")
        frame_.select(F.to_timestamp("t").alias("ts"), "event_type", "value", "props").coalesce(1).write.mode(
            "append").parquet(f"{base}/in/batch={n}")
        stream = spark.readStream.schema(schema).parquet(f"{base}/in/batch=*")
        counters = stream_quality.quality_counters(stream, stream_quality.event_rules(), "1 hour", "10 minutes")
        stream_quality.write_counters(counters, f"{base}/out", f"{base}/cp").awaitTermination()

    batch(1, [("2024-01-01 10:05:00", "view", 1.0, '{"k": 1}'), ("2024-01-01 10:20:00", "odd", 300.0, "x")])
    batch(2, [("2024-01-01 13:00:00", "view", -1.0, '{"k": 2}')])
    batch(3, [("2024-01-01 10:30:00", "view", 1.0, '{"k": 1}'), ("2024-01-01 16:00:00", "view", 1.0, '{"k": 1}')])
    batch(4, [("2024-01-01 19:00:00", "view", 1.0, '{"k": 1}')])
    fields = spark.read.parquet(f"{base}/out").drop("batch").schema
    counted = stream_quality.read_counters(spark, f"{base}/out", fields, "10 minutes")
    rows = {str(r.window_start)[11:16]: r for r in counted.collect()}
    first = rows["10:00"]
    assert (first.rows, first.unknown_type, first.high_value, first.bad_props) == (2, 1, 1, 1)
    assert rows["13:00"].negative_value == 1
    # The window still open at the end is there as well, and marked.
    assert {k: r.closed for k, r in rows.items()} == {"10:00": True, "13:00": True, "16:00": True, "19:00": False}


FOREST, BOOST, DEEP = (training.FOREST_GRID, 3), (training.BOOST_GRID, 10), (training.DEEP_BOOST_GRID, 10)


@pytest.mark.parametrize("name, wanted", [
    ("ml8_forest_search", [FOREST]), ("ml9_boosting_search", [BOOST]), ("ml10_deep_boosting_search", [DEEP]),
    ("ml11_train_all", [FOREST, BOOST, DEEP]),
])
def test_search_queries_take_the_whole_grids(monkeypatch, name, wanted):
    searched = []
    for search, default in (("search_forest", training.FOREST_GRID), ("search_boosting", training.BOOST_GRID)):
        known = inspect.signature(getattr(training, search))

        def record(*args, known=known, default=default, **options):
            given = known.bind(*args, **options)
            given.apply_defaults()
            searched.append((given.arguments["grid"] or default, given.arguments["n"]))
            return MagicMock()

        monkeypatch.setattr(training, search, record)
    monkeypatch.setattr(model_queries, "model_frame", MagicMock())
    monkeypatch.setattr(model_queries, "_split", MagicMock())
    monkeypatch.setattr(model_queries, "ev", MagicMock())
    getattr(model_queries, name)(None, SF)
    assert searched == wanted


def test_forests_are_grown_written_and_applied_in_parts(spark, numbers, monkeypatch):
    _, _, df = numbers
    assert training.part_sizes(100, 20, 12_490, 2, 250_000) == [20] * 5
    assert training.part_sizes(7, 3, 500, 2, 48) == [3, 2, 2]
    assert training.part_sizes(5, 20, 10**9, 1, 1000) == [1] * 5
    options = dict(labelCol="label", featuresCol="features", seed=3, numTrees=7, maxDepth=3, minInstancesPerNode=2,
                   subsamplingRate=0.5, featureSubsetStrategy="sqrt")
    whole = training.PartedForest(**options).fit(df)
    plain = RandomForestRegressor(**options).fit(df)
    predicted = [[r.prediction for r in m.transform(df).orderBy("a").collect()] for m in (whole, plain)]
    assert predicted[0] == predicted[1]
    # Seven trees of at most 16 nodes, 48 nodes a part: never more than three trees in one fit.
    fitted, known = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, rows: fitted.append(self.getNumTrees()) or known(self, rows))
    parted = training.PartedForest(part_nodes=48, **options).fit(df)
    assert fitted == [3, 2, 2] and parted.getNumTrees == 7
    trees = [t for k in range(3) for t in parted.part(k).trees]
    by_tree = np.mean([[t.predict(r.features) for r in df.orderBy("a").collect()] for t in trees], axis=0)
    path = shared_dir(spark, "saved-forest")
    PipelineModel([parted]).write().overwrite().save(path)
    for model in (parted, PipelineModel.load(path)):
        got = model.transform(df).orderBy("a")
        assert got.columns == [*df.columns, "prediction"]
        assert [r.prediction for r in got.collect()] == pytest.approx(list(by_tree))
    # The search grows its forests this way.
    monkeypatch.setattr(training, "PART_NODES", 48)
    found = training.search_forest(df, {"numTrees": [4, 6], "maxDepth": [3], "minInstancesPerNode": [2]}, 2)
    assert max(fitted[3:]) <= 3 and found.models["random_forest"].getNumTrees in (4, 6)
    assert found.rmse["random_forest"] == min(score for _, score in found.judged["random_forest"])


def test_fits_side_by_side_share_tasks_and_losers_are_dropped(numbers, monkeypatch):
    _, _, df = numbers
    rows, tasks, alive, made, known = df.repartition(8), [], [], [], GBTRegressor.fit

    def fit(self, given):
        gc.collect()
        alive.append(sum(ref() is not None for ref in made))
        tasks.append(given.rdd.getNumPartitions())
        model = known(self, given)
        made.append(weakref.ref(model))
        return model

    monkeypatch.setattr(GBTRegressor, "fit", fit)
    grid = {"maxIter": [2], "maxDepth": [1, 2, 3, 4]}
    found = training.search_boosting(rows, None, grid, 4, parallelism=1, rows_per_task=100)
    # One fit at a time takes tasks of 100 rows; only the best model so far is held.
    assert tasks == [5] * 4 and max(alive) <= 1
    judged = found.judged["gradient_boosting"]
    assert (found.params["gradient_boosting"], found.rmse["gradient_boosting"]) == min(judged, key=lambda j: j[1])
    evaluated = training.rmse_evaluator().evaluate(found.models["gradient_boosting"].transform(rows))
    assert evaluated == pytest.approx(found.rmse["gradient_boosting"])
    tasks.clear()
    training.search_boosting(rows, None, grid, 4, parallelism=2, rows_per_task=100)
    assert tasks == [3] * 4


def test_forest_search_keeps_node_ids_and_grows_parts_side_by_side(numbers, monkeypatch):
    _, _, df = numbers
    options = dict(labelCol="label", featuresCol="features", seed=3, numTrees=3, maxDepth=6, subsamplingRate=0.5,
                   featureSubsetStrategy="sqrt")
    kept, walked = (RandomForestRegressor(cacheNodeIds=on, **options).fit(df) for on in (True, False))
    assert kept.toDebugString.splitlines()[1:] == walked.toDebugString.splitlines()[1:]
    given, staged, known, stage = [], [], RandomForestRegressor.fit, training.stage

    def fit(self, rows):
        given.append((self.getNumTrees(), self.getCacheNodeIds(), rows.rdd.getNumPartitions()))
        return known(self, rows)

    monkeypatch.setattr(RandomForestRegressor, "fit", fit)
    monkeypatch.setattr(training, "stage", lambda rows, name: staged.append(name) or stage(rows, name))
    # Six trees of at most 16 nodes, one tree a part, two parts side by side and in one pass.
    monkeypatch.setattr(training, "PART_NODES", 16)
    monkeypatch.setattr(training, "PARTS_BESIDE", 2)
    grid = {"numTrees": [6], "maxDepth": [3], "minInstancesPerNode": [2]}
    found = training.search_forest(df.repartition(8), grid, 1, sample=0.5, beside=2, rows_per_task=125)
    # Two folds and the final fit, each of six parts, in tasks of 250 rows.
    assert given == [(1, True, 2)] * 18
    model = found.models["random_forest"]
    assert model.opt("sizes") == [1] * 6
    staged.clear()
    rows = model.transform(df).orderBy("a").collect()
    assert staged == ["forest-sums"] * 2
    trees = [model.part(k).trees[0] for k in range(6)]
    by_tree = np.mean([[t.predict(r.features) for r in rows] for t in trees], axis=0)
    assert [r.prediction for r in rows] == pytest.approx(list(by_tree))


def test_fits_side_by_side_are_bounded_by_memory(spark, numbers, monkeypatch):
    _, _, df = numbers
    held = training.fits_in_memory(spark, 1_000_000, 25)
    assert held >= 1 and training.fits_in_memory(spark, 2_000_000, 25) in (max(1, held // 2), max(1, (held - 1) // 2))
    assert training.fits_in_memory(spark, 10**12, 25) == 1 and training.fits_in_memory(spark, 0, 0) > 10**6
    # Two tasks a core of a fit at most, but never more than TASK_ROWS rows a task.
    assert training.fit_tasks(45_000_000, 50_000, 1, 12) == 24
    assert training.fit_tasks(45_000_000, 50_000, 8, 12) == 23
    assert training.fit_tasks(124_900, 50_000, 8, 12) == 1
    assert training.fit_tasks(10**9, 50_000, 1, 12) == 500
    tasks, running, most, known, lock = [], [], [], GBTRegressor.fit, threading.Lock()

    def fit(self, given):
        with lock:
            running.append(self)
            most.append(len(running))
        tasks.append(given.rdd.getNumPartitions())
        try:
            return known(self, given)
        finally:
            with lock:
                running.remove(self)

    monkeypatch.setattr(GBTRegressor, "fit", fit)
    # Rows that fill the memory alone are fitted one after the other, each by all cores.
    monkeypatch.setattr(training, "FIT_ROW_BYTES", 10**12)
    grid = {"maxIter": [2], "maxDepth": [1, 2, 3, 4]}
    training.search_boosting(df.repartition(16), None, grid, 4, parallelism=4, rows_per_task=10)
    assert max(most) == 1 and tasks == [8] * 4
