from functools import partial

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pricegrid.functions import bins
from pricegrid.operators import features as fe
from pricegrid.operators.feature_selection import FeatureSelector, redundant
from pricegrid.operators.splitting import Splitter
from pricegrid.schema import CANONICAL
from pricegrid.session import shared_dir
from tests.conftest import FORD, HONDA, TOYOTA, frame


@pytest.fixture(scope="module")
def cars(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        base = (TOYOTA, HONDA, FORD)[int(rng.integers(3))]
        year = int(rng.integers(2010, 2023))
        rows.append(dict(base, year=year, age_years=2023 - year, km=float(rng.integers(1000, 90000)),
                         price=float(rng.integers(20000, 90000))))
    df = frame(spark, rows).withColumn("listing_id", F.md5(F.concat_ws("|", "year", "km", "price")))
    return Splitter().fit(df).transform(df).cache()


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(float(x),) for x in (-1, 0, 2, 3, 99)] + [(None,)], "x double")
    label = bins.right_closed(F.col("x"), [0, 2, 5, None], ["a", "b", "c"])
    assert [r[0] for r in df.select(label).collect()] == [None, None, "a", "b", "c", None]
    low = bins.right_closed(F.col("x"), [0, 2, 5, None], ["a", "b", "c"], include_lowest=True)
    assert [r[0] for r in df.select(low).collect()][1] == "a"
    assert bins.equal_width_edges(0, 10, 5) == pytest.approx([-0.01, 2, 4, 6, 8, 10])


def test_target_means_and_unseen_categories(spark):
    train = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("b", 45.0), (None, 7.0)], "brand string, price double")
    model = fe.TargetMeanEncoder(["brand"]).fit(train)
    test = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "brand string")
    assert [r[0] for r in model.transform(test).collect()] == [15.0, 45.0, 30.0, 30.0]
    with pytest.raises(ValueError):
        fe.TargetMeanEncoder(["brand"]).fit(test)


def test_indicators_ignore_unseen_values(spark):
    model = fe.IndicatorEncoder(["c"]).fit(spark.createDataFrame([("x-1",), ("y",)], "c string"))
    out = model.transform(spark.createDataFrame([("x-1",), ("new",), (None,)], "c string"))
    assert out.columns == ["c_x-1", "c_y"]
    assert [tuple(r) for r in out.collect()] == [(1, 0), (0, 0), (0, 0)]


def test_sparse_indicators_of_many_values(spark, monkeypatch):
    n = 30_000
    monkeypatch.setattr(fe, "lookup", partial(fe.lookup, broadcast_rows=100))  # joins by shuffle
    df = spark.range(n).select(
        "id", F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("wide"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).alias("few"), (F.col("id") % 7).alias("indicators_n"),
    )
    model = fe.SparseIndicatorEncoder(["wide", "few", "absent"]).fit(df)
    path = shared_dir(spark, "sparse")
    model.write().overwrite().save(path)
    model = fe.SparseIndicatorModel.load(path)
    rows = model.transform(df).orderBy("id").collect()
    assert len(rows) == n and rows[0].asDict().keys() == {"id", "indicators_n", "indicators"}
    for r in rows[:50] + rows[-50:]:
        assert r.indicators.size == n + 1
        assert list(r.indicators.indices) == ([r.id, n] if r.id % 3 else [r.id])
        assert set(r.indicators.values) == {1.0}
    unseen = spark.createDataFrame([("new", None), (None, "hot")], "wide string, few string")
    assert [list(r.indicators.indices) for r in model.transform(unseen).collect()] in ([[], [n]], [[n], []])
    names = {r.position: (r.feature, r.value) for r in model.names().collect()}
    assert len(names) == n + 1 and names[n] == ("few", "hot") and names[5] == ("wide", "k000005")


def test_sparse_indicators_equal_the_dense_ones(spark, cars):
    columns = ["fuel_type", "transmission", "condition"]
    dense = fe.IndicatorEncoder(columns).fit(cars)
    values = dense.opt("categories")
    wanted = [F.col(f"`{c}_{v}`").cast("double") for c in columns for v in values[c]]
    one = dense.transform(cars).select("listing_id", F.array(*wanted).alias("d"))
    two = fe.SparseIndicatorEncoder(columns).fit(cars).transform(cars)
    two = two.select("listing_id", vector_to_array("indicators").alias("s"))
    assert one.join(two, "listing_id").where("d != s").count() == 0


def test_sparse_indicators_of_an_empty_table(spark):
    df = spark.createDataFrame([], "brand string, x int")
    out = fe.SparseIndicatorEncoder(["brand"]).fit(df).transform(df)
    assert out.columns == ["x", "indicators"] and out.count() == 0
    row = spark.createDataFrame([("a", 1)], "brand string, x int")
    assert fe.SparseIndicatorEncoder(["brand"]).fit(df).transform(row).first().indicators.size == 0


def test_scalers_handle_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    standard = fe.Scaler(["x", "k"]).fit(df).transform(df).collect()
    assert [tuple(r) for r in standard] == [(-1.0, 0.0), (1.0, 0.0)]
    ranged = fe.Scaler(["x", "k"], "minmax").fit(df).transform(df).collect()
    assert [tuple(r) for r in ranged] == [(0.0, 0.0), (1.0, 0.0)]


def test_frequencies_and_city_sizes(spark):
    train = spark.createDataFrame([("a",)] * 150 + [("b",)] * 50, "city string")
    new = spark.createDataFrame([("a",), ("b",), ("c",)], "city string")
    freq = fe.FrequencyEncoder(["city"]).fit(train).transform(new)
    assert [r.city_frequency for r in freq.collect()] == [0.75, 0.25, 0.0]
    size = fe.SizeLabeler().fit(train).transform(new)
    assert [r.city_size for r in size.collect()] == ["Medium", "Small", "Small"]


def test_quantile_bins_drop_equal_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 1, 1, 1, 1, 1, 2, 3, 4, 5]], "km double")
    model = fe.QuantileBinner({"km": "km_bin"}).fit(df)
    assert len(model.opt("edges")["km"]) < 6
    new = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (9.0,)], "km double")
    got = [r.km_bin for r in model.transform(new).collect()]
    assert got[0] is None and got[1] == 0 and got[3] is None and got[2] is not None


def test_full_features_fit_on_train_only(cars):
    model, out = fe.transform_split(cars, CANONICAL, advanced=True)
    names = fe.feature_names(model)
    assert {"brand_encoded", "km_log", "age_squared", "brand_frequency", "km_per_year"} <= set(names)
    assert "price" not in names and "region" not in names
    train = cars.where("split = 'train'")
    alone = fe.fit_features(train, CANONICAL, keep=("split",), advanced=True).transform(train)
    cols = ["listing_id", "brand_encoded", "year", "km_log", "brand_frequency"]
    whole = {tuple(r) for r in out.where("split = 'train'").select(*cols).collect()}
    assert whole == {tuple(r) for r in alone.select(*cols).collect()}
    std = out.where("split = 'train'").agg(F.stddev_pop("year")).first()[0]
    assert std == pytest.approx(1.0)


def test_saved_feature_model_gives_the_same_frame(spark, cars):
    model = fe.fit_features(cars.where("split = 'train'"), CANONICAL, keep=("split",), advanced=True)
    path = shared_dir(spark, "test-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert fe.feature_names(loaded) == fe.feature_names(model)
    assert set(map(tuple, loaded.transform(cars).collect())) == set(map(tuple, model.transform(cars).collect()))


def test_missing_feature_columns_become_zero(cars):
    model = fe.fit_features(cars.where("split = 'train'"), CANONICAL)
    out = model.transform(cars.drop("fuel_type"))
    assert out.agg(F.sum("fuel_type_Flex")).first()[0] == 0
    assert [c for c in out.columns if c not in ("listing_id", "price")] == fe.feature_names(model)


def test_selection(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=400)
    rows = [(float(a), float(a * 2 + 1e-6 * n), float(n), float(3 * a + 0.1 * n)) for a, n in zip(x, rng.normal(size=400))]
    df = spark.createDataFrame(rows, "x double, copy double, noise double, y double")
    chosen = FeatureSelector("correlation", threshold=0.5).fit(df, "y")
    assert len(chosen.selected) == 1 and chosen.selected[0] in ("x", "copy")
    info = FeatureSelector("mutual_info", k=2, prune=False).fit(df, "y")
    assert set(info.selected) == {"x", "copy"}
    assert redundant({("a", "b"): 0.99, ("b", "c"): 0.99}, {"a": 0.3, "b": 0.2, "c": 0.1}) == {"b", "c"}
    with pytest.raises(ValueError):
        FeatureSelector().transform(df)
