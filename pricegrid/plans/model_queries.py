"""Training, evaluation, segments, registry and scoring."""

from __future__ import annotations

from dataclasses import replace
from statistics import NormalDist

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from pricegrid.operators import evaluation as ev
from pricegrid.operators import features as fe
from pricegrid.operators import registry as rg
from pricegrid.operators import scoring, training
from pricegrid.operators import segments as sg
from pricegrid.operators.order import quantile_values
from pricegrid.plans import sql
from pricegrid.plans.catalog import Catalog
from pricegrid.plans.feature_queries import full_features, split_listings, train_rows
from pricegrid.plans.table_queries import SPLIT_SQL, range_sql_case
from pricegrid.schema import LISTINGS
from pricegrid.session import shared_dir, stage
from pricegrid.sources.listings import dirty_listings, listings, table

catalog = Catalog()
query = catalog.add
L, D = sql.WITH_L, sql.WITH_D

# -- training -----------------------------------------------------------------------


def numeric_frame(df, columns):
    """features vector and label of a frame."""
    vector = fe.FeatureVector(list(columns)).transform(df)
    return vector.select(*df.columns, "features", F.col("price").alias("label"))


for _word, _sql in (("mean", "avg(price)"), ("median", "quantile_cont(price,0.5)")):

    @query(
        f"ml{1 if _word == 'mean' else 2}_{_word}_baseline",
        f"""{SPLIT_SQL}, m as (select {_sql} as yhat from sp where split='train')
select split, round(max(yhat),4) as prediction, {sql.metrics_sql('price', 'yhat')} from sp cross join m group by split""",
    )
    def _baseline(spark, sf_dir, statistic=_word):
        df = split_listings(spark, sf_dir, "listing_id", "price").withColumn("label", F.col("price"))
        model = training.ConstantRegressor(statistic).fit(train_rows(df))
        scored = model.transform(df)
        value = scored.groupBy("split").agg(F.round(F.max("prediction"), 4).alias("prediction"))
        return ev.metrics(scored, "price", "prediction", ["split"]).join(value, "split")


MOMENTS = f"""{SPLIT_SQL}, t as (select cast(engine_size as double) as x, price as y from sp where split='train'),
 m as (select count(*) as n, avg(x) as mx, avg(y) as my, var_pop(x) as vx, covar_pop(x,y) as cxy from t)"""


def _coefficients(spark, name, model):
    """Slope and intercept of a fitted one-feature model."""
    row = (name, round(float(model.coefficients[0]), 3), round(float(model.intercept), 2))
    return spark.createDataFrame([row], "model string, slope double, intercept double")


def _one_feature(spark, sf_dir):
    df = train_rows(split_listings(spark, sf_dir, "listing_id", "engine_size", "price"))
    return numeric_frame(df, ["engine_size"]).select("features", "label")


def _slope_sql(name, slope):
    return f"""{MOMENTS}, w as (select *, {slope} as s from m)
select '{name}' as model, round(s,3) as slope, round(my-s*mx,2) as intercept from w"""


@query("ml3_linear_one_feature", _slope_sql("linear", "cxy/vx"))
def ml3_linear_one_feature(spark, sf_dir):
    return _coefficients(spark, "linear", training.linear().fit(_one_feature(spark, sf_dir)))


@query("ml4_ridge_one_feature", _slope_sql("ridge", "n*cxy/(n*vx+5000.0e0)"))
def ml4_ridge_one_feature(spark, sf_dir):
    rows = _one_feature(spark, sf_dir)
    return _coefficients(spark, "ridge", training.ridge(rows, 5000.0).fit(rows))


@query(
    "ml5_lasso_one_feature",
    _slope_sql("lasso", "sign(cxy)*greatest(abs(cxy)-100.0e0,0)/vx"),
)
def ml5_lasso_one_feature(spark, sf_dir):
    return _coefficients(spark, "lasso", training.lasso(100.0).fit(_one_feature(spark, sf_dir)))


def model_frame(spark, sf_dir):
    """Feature frame with vector and label, written once: training reads it many times."""
    model, out = full_features(spark, sf_dir)
    names = fe.feature_names(model)
    slim = fe.FeatureVector(names).transform(out).select(
        "listing_id", "split", F.col("price").alias("label"), "features"
    )
    return stage(slim, "model-frame")


def _split(df, name):
    return df.where(F.col("split") == name)


@query("ml6_decision_tree")
def ml6_decision_tree(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    model = training.decision_tree().fit(_split(df, "train"))
    return ev.metrics(model.transform(df), "label", "prediction", ["split"])


@query("ml7_all_baselines")
def ml7_all_baselines(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    result = training.train_baselines(_split(df, "train"))
    return ev.compare_models(result.predict(df), result.prediction_columns, "label", ["split"])


def _against_mean(df, predictions):
    """Per model and split: rows, and on train whether the error is no worse than the train mean's.

    Least squares, its penalised forms and a tree guarantee that on train, whatever the data.
    The listings' prices carry no signal, so nothing is claimed for the other splits.
    """
    mean = training.ConstantRegressor("mean").fit(_split(df, "train"))
    with_mean = mean.transform(df).withColumnRenamed("prediction", "__mean")
    found = ev.compare_models(with_mean, {**predictions, "__mean": "__mean"}, "label", ["split"])
    base = found.where("model = '__mean'").select("split", F.col("rmse").alias("base"))
    fits = F.when(F.col("split") == "train", F.col("rmse") <= F.col("base") * (1 + 1e-9))
    return found.where("model <> '__mean'").join(base, "split").select("model", "split", "n_samples", fits.alias("fits_train"))


def _against_mean_sql(models):
    return f"{SPLIT_SQL} select m.model, split, count(*) as n_samples, case when split='train' then m.fits end as fits_train from sp cross join (values " + ", ".join(
        f"('{name}', {str(good).lower()})" for name, good in models.items()
    ) + ") m(model, fits) group by m.model, split, m.fits"


@query("ml6_tree_on_train", _against_mean_sql({"decision_tree": True}))
def ml6_tree_on_train(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    scored = training.decision_tree().fit(_split(df, "train")).transform(df)
    return _against_mean(scored.withColumnRenamed("prediction", "yhat"), {"decision_tree": "yhat"})


@query(
    "ml7_baselines_on_train",
    _against_mean_sql({
        "mean_baseline": True, "median_baseline": False, "linear_regression": True, "ridge_regression": True,
        "lasso_regression": True, "decision_tree": True,
    }),
)
def ml7_baselines_on_train(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    result = training.train_baselines(_split(df, "train"))
    return _against_mean(result.predict(df), result.prediction_columns)


SEARCHED = {
    "random_forest": training.FOREST_GRID, "gradient_boosting": training.BOOST_GRID, "deep_boosting": training.DEEP_BOOST_GRID,
}


def _facts_sql(counts):
    """Searches judge all their candidates and choose the best of the grid, whatever the data."""
    return f"{SPLIT_SQL} select m.model, split, count(*) as n_samples, m.candidates, true as in_grid, true as lowest," + (
        " case when split='train' then true end as fits_train from sp cross join (values "
    ) + ", ".join(f"('{name}', {n}::bigint)" for name, n in counts.items()) + ") m(model, candidates) group by m.model, split, m.candidates"


@query("ml8_forest_search", _facts_sql({"random_forest": 3}))
def ml8_forest_search(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    return training.search_forest(_split(df, "train")).facts(df, SEARCHED)


@query("ml9_boosting_search", _facts_sql({"gradient_boosting": 10}))
def ml9_boosting_search(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    return training.search_boosting(_split(df, "train"), _split(df, "val")).facts(df, SEARCHED)


@query("ml10_deep_boosting_search", _facts_sql({"deep_boosting": 10}))
def ml10_deep_boosting_search(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    found = training.search_boosting(
        _split(df, "train"), _split(df, "val"), training.DEEP_BOOST_GRID, name="deep_boosting", early_stopping=True
    )
    return found.facts(df, SEARCHED)


@query("ml11_train_all", _facts_sql({"random_forest": 3, "gradient_boosting": 10, "deep_boosting": 10}))
def ml11_train_all(spark, sf_dir):
    df = model_frame(spark, sf_dir)
    return training.train_advanced(_split(df, "train"), _split(df, "val")).facts(df, SEARCHED)


# -- evaluation -----------------------------------------------------------------------

MODELS = {"mean": "yhat_mean", "median": "yhat_median", "brand": "yhat_brand"}


def predictions(spark, sf_dir):
    """Valid listings with their split and three predictions fitted on train."""
    df = split_listings(spark, sf_dir)
    train = train_rows(df)
    mean = train.agg(F.avg("price")).first()[0]
    median = quantile_values(train, ["price"], [0.5])["price"][0]
    out = fe.TargetMeanEncoder(["brand"], drop=False).fit(train).transform(df)
    return out.withColumnRenamed("brand_encoded", "yhat_brand").withColumns(
        {"y": F.col("price"), "yhat_mean": F.lit(mean), "yhat_median": F.lit(median)}
    )


PREDICT = f"""{SPLIT_SQL}, tr as (select * from sp where split='train'),
 bm as (select brand, avg(price) as e from tr group by 1),
 pr as (select sp.*, price as y, coalesce(e,(select avg(e) from bm)) as yhat_brand,
  (select avg(price) from tr) as yhat_mean, (select quantile_cont(price,0.5) from tr) as yhat_median
  from sp left join bm using (brand)),
 te as (select *, yhat_brand as yhat from pr where split='test')"""


def test_rows(spark, sf_dir):
    df = predictions(spark, sf_dir).where(F.col("split") == "test")
    return df.withColumn("yhat", F.col("yhat_brand"))


METRIC_SQL = {
    "rmse": "round(sqrt(avg((y-yhat)*(y-yhat))),4)",
    "mae": "round(avg(abs(y-yhat)),4)",
    "mape": "round(avg(case when y<>0 then abs((y-yhat)/y) end),6)",
    "r2": "round(1-sum((y-yhat)*(y-yhat))/(count(*)*var_pop(y)),6)+0e0",
}

for _i, (_metric, _text) in enumerate(METRIC_SQL.items(), start=1):

    @query(
        f"ev{_i}_{_metric}",
        f"""{PREDICT}, z as (select region, case when doors=2 then 0 else y end as y, yhat from te)
select region, {_text} as {_metric} from z group by region""",
    )
    def _metric_by_region(spark, sf_dir, metric=_metric):
        """Some actual values are zero: the relative error leaves them out."""
        df = test_rows(spark, sf_dir).withColumn("y", F.when(F.col("doors") == 2, 0.0).otherwise(F.col("y")))
        return ev.metrics(df, by=["region"]).select("region", metric)


E = "(y-yhat)"
RESIDUAL_SQL = """round(avg(e),4) as mean, round(stddev_pop(e),4) as std, round(min(e),4) as min, round(max(e),4) as max,
 round(quantile_cont(e,0.5),4) as median, round(avg(pow(e-mu,3))/pow(var_pop(e),1.5),4) as skewness,
 round(avg(pow(e-mu,4))/pow(var_pop(e),2)-3,4) as kurtosis"""


@query(
    "ev5_residual_stats",
    f"""{PREDICT}, z as (select region, {E} as e from te), m as (select region, avg(e) as mu from z group by 1)
select region, {RESIDUAL_SQL} from z join m using (region) group by region""",
)
def ev5_residual_stats(spark, sf_dir):
    return ev.residual_stats(test_rows(spark, sf_dir), by=["region"])


@query(
    "ev6_summary_report",
    f"""{PREDICT}, z as (select y, yhat, {E} as e, avg({E}) over () as mu from te),
 s as (select {', '.join(f'{t} as {m}' for m, t in METRIC_SQL.items())}, {RESIDUAL_SQL} from z) """
    + sql.union(
        [f"select '{m.upper()}' as metric, {m} as value from s" for m in METRIC_SQL]
        + [f"select 'Residual {s.capitalize()}', {s} from s" for s in ev.RESIDUAL_STATS]
    ),
)
def ev6_summary_report(spark, sf_dir):
    return ev.summary_report(test_rows(spark, sf_dir))


LONG = f"{PREDICT}, lo as (" + sql.union(
    f"select split, y, '{name}' as model, {column} as yh from pr" for name, column in MODELS.items()
) + ")"


@query(
    "ev7_compare_models",
    f"{LONG} select model, {sql.metrics_sql('y', 'yh')} from lo where split='val' group by model",
)
def ev7_compare_models(spark, sf_dir):
    return ev.compare_models(predictions(spark, sf_dir).where("split = 'val'"), MODELS)


@query(
    "ev8_residual_sample",
    f"""{PREDICT} select listing_id, y, round(yhat+1e-8,6) as yhat, round(y-yhat+1e-8,6) as residual from te
 order by md5(listing_id||'|42') limit 500""",
)
def ev8_residual_sample(spark, sf_dir):
    out = ev.residual_sample(test_rows(spark, sf_dir), 500)
    return out.select(
        "listing_id", "y", *[F.round(F.col(c) + F.lit(1e-8), 6).alias(c) for c in ("yhat", "residual")]
    )


QQ = [(i + 0.5) / 99 for i in range(99)]


@query(
    "ev9_qq_points",
    f"{PREDICT}, z as (select {E} as e from te) " + sql.union(
        f"""select {round(p, 8)}e0 as position, {round(NormalDist().inv_cdf(p), 6)}e0 as theoretical,
 round(quantile_cont(e,{p!r}),3) as observed from z""" for p in QQ
    ),
)
def ev9_qq_points(spark, sf_dir):
    out = ev.qq_points(test_rows(spark, sf_dir), 99)
    return out.select(
        F.round("position", 8).alias("position"), F.round("theoretical", 6).alias("theoretical"), F.round("observed", 3).alias("observed")
    )


@query(
    "ev10_test_set",
    f"""{PREDICT}, z as (select y, yhat_mean as yhat from pr where split='test')
select 'mean' as model, {sql.metrics_sql()} from z""",
)
def ev10_test_set(spark, sf_dir):
    """The wanted model was not trained, so the first one is evaluated."""
    df = predictions(spark, sf_dir).where("split = 'test'")
    name = ev.pick_model(MODELS, "forest")
    return ev.compare_models(df, {name: MODELS[name]})


SPLIT_METRICS = f"{LONG}, cm as (select model, split, {sql.metrics_sql('y', 'yh')} from lo group by model, split)"


@query(
    "ev11_metric_drift",
    f"{SPLIT_METRICS}, w as (" + sql.union(
        f"""select v.model, '{m.upper()}' as metric, v.{m} as validation, t.{m} as test from cm v join cm t
 on v.model=t.model and v.split='val' and t.split='test'""" for m in METRIC_SQL
    ) + """) select model, metric, validation, test, round(test-validation,4) as difference,
 round(case when validation<>0 then (test-validation)/validation*100 end,4) as pct_change from w""",
)
def ev11_metric_drift(spark, sf_dir):
    return ev.metric_drift(ev12_split_metrics(spark, sf_dir))


@query("ev12_split_metrics", f"{SPLIT_METRICS} select * from cm")
def ev12_split_metrics(spark, sf_dir):
    return ev.compare_models(predictions(spark, sf_dir), MODELS, by=["split"])


# -- segments ---------------------------------------------------------------------------

PRICE_SEG = range_sql_case("price", sg.C.PRICE_SEGMENT_EDGES, sg.C.PRICE_SEGMENT_LABELS)
AGE_SEG = range_sql_case("age_years", sg.C.AGE_SEGMENT_EDGES, sg.C.AGE_SEGMENT_LABELS)
BRAND_SEG = "case when brand in (select brand from tb) then brand else 'Other' end"


def _top_brands(source):
    return f"tb as (select brand from {source} group by 1 order by count(*) desc, brand limit 10)"


@query("sg1_price_segment", f"{L} select listing_id, {PRICE_SEG} as price_segment from l")
def sg1_price_segment(spark, sf_dir):
    return listings(spark, sf_dir).select("listing_id", sg.price_segment().alias("price_segment"))


@query("sg2_age_segment", f"{L} select listing_id, {AGE_SEG} as age_segment from l")
def sg2_age_segment(spark, sf_dir):
    df = listings(spark, sf_dir)
    return df.select("listing_id", sg.age_segment(df).alias("age_segment"))


@query("sg3_brand_segment", f"{L}, {_top_brands('l')} select listing_id, {BRAND_SEG} as brand_segment from l")
def sg3_brand_segment(spark, sf_dir):
    df = listings(spark, sf_dir).select("listing_id", "brand")
    return sg.with_brand_segment(df).select("listing_id", "brand_segment")


@query(
    "sg4_region_segment",
    f"""{PREDICT} select region, {sql.metrics_sql()} from te group by region""",
)
def sg4_region_segment(spark, sf_dir):
    """Region of each state by the fixed map of the data, then metrics per region."""
    from pricegrid.plans.feature_queries import nation_regions

    df = test_rows(spark, sf_dir).drop("region")
    mapped = df.withColumn("region", fe.region_of(F.col("state"), nation_regions(spark, sf_dir)))
    return ev.metrics(mapped, by=["region"])


@query(
    "sg5_segment_metrics",
    f"""{PREDICT}, {_top_brands('te')}, x as ("""
    + sql.union(
        f"select '{kind}' as segment_type, {text} as segment_value, y, yhat from te"
        for kind, text in (("price", PRICE_SEG), ("age", AGE_SEG), ("brand", BRAND_SEG), ("region", "region"))
    )
    + f""") select segment_type, segment_value, {sql.metrics_sql()} from x where segment_value is not null group by 1,2""",
)
def sg5_segment_metrics(spark, sf_dir):
    return sg.segment_metrics(sg.with_segments(test_rows(spark, sf_dir)))


ERRORS = """listing_id, y, round(y-yhat+1e-8,6) as error, round(abs(y-yhat)+1e-8,6) as absolute_error,
 round(abs(y-yhat)/y*100+1e-8,6) as percentage_error"""


def _error_frame(df):
    columns = ("error", "absolute_error", "percentage_error")
    return df.select("listing_id", "y", *[F.round(F.col(c) + F.lit(1e-8), 6).alias(c) for c in columns])


@query("sg6_error_columns", f"{PREDICT} select {ERRORS} from te")
def sg6_error_columns(spark, sf_dir):
    return _error_frame(sg.error_columns(test_rows(spark, sf_dir)))


@query(
    "sg7_worst_predictions",
    f"{PREDICT}, w as (select * from te order by abs(y-yhat) desc, listing_id limit 50) select {ERRORS} from w",
)
def sg7_worst_predictions(spark, sf_dir):
    return _error_frame(sg.worst_predictions(sg.error_columns(test_rows(spark, sf_dir))))


# -- registry ---------------------------------------------------------------------------


def version_entries(spark, sf_dir):
    """A registry of mean models: one version per state, reference year and doors."""
    minor = (F.col("year_of_reference") - 1992).cast("string")
    version = F.concat(F.lit("v1."), minor, F.lit("."), F.col("doors").cast("string"))
    return (
        listings(spark, sf_dir)
        .groupBy(F.col("state").alias("model_name"), version.alias("version"))
        .agg(F.round(F.stddev_pop("price"), 4).alias("rmse"), F.count(F.lit(1)).alias("train_size"))
    )


def registered(spark, sf_dir):
    """These versions in a registry."""
    store = rg.Registry(spark, shared_dir(spark, "registry"))
    store.save_all(version_entries(spark, sf_dir).select(
        "model_name", "version", F.lit("mean").alias("model_type"), F.create_map(F.lit("rmse"), "rmse").alias("performance_metrics"),
        F.create_map(F.lit("train_size"), F.col("train_size").cast("string")).alias("training_info"),
    ))
    return store


ENTRIES = f"""{L}, en as (select state as model_name, 'v1.'||(year_of_reference-1992)||'.'||doors as version,
 round(stddev_pop(price),4) as rmse, count(*) as train_size from l group by 1,2),
 ve as (select *, cast(split_part(version,'.',2) as int)*1000+cast(split_part(version,'.',3) as int) as k from en)"""


def brand_model(train):
    """Brand means and a line through them, as one saved model."""
    stages = [
        fe.TargetMeanEncoder(["brand"], drop=False),
        fe.ColumnContract(keep=[c for c in train.columns if c != "brand_encoded"]),
        fe.FeatureVector(["brand_encoded"]),
        training.linear(label="price"),
    ]
    return Pipeline(stages=stages).fit(train)


SLIM = ["listing_id", "brand", "region", "price"]


def saved_brand_model(spark, sf_dir):
    df = split_listings(spark, sf_dir, *SLIM)
    store = rg.Registry(spark, shared_dir(spark, "registry"))
    model = brand_model(train_rows(df).select("listing_id", "brand", "price"))
    scored = ev.metrics(model.transform(_split(df, "test")), "price", "prediction").first()
    numbers = {m: scored[m] for m in ("rmse", "mae", "mape", "r2")}
    info = {r.split: r["count"] for r in df.groupBy("split").count().collect()}
    for _ in range(2):
        store.save(model, "brand_line", "linear", numbers, hyperparameters={"alpha": 0.0}, training_info=info)
    return store, df


@query(
    "rg1_save_model",
    f"""{PREDICT}, m as (select {sql.metrics_sql()} from te)
select 'brand_line' as model_name, 'linear' as model_type, version, 'brand_encoded' as features, rmse, mae, mape, r2,
 cast((select count(*) from tr) as varchar) as train_size from m cross join (values ('v1.0.0'),('v1.0.1')) v(version)""",
)
def rg1_save_model(spark, sf_dir):
    store, _ = saved_brand_model(spark, sf_dir)
    metric = [F.col("performance_metrics")[m].alias(m) for m in ("rmse", "mae", "mape", "r2")]
    return store.entries().select(
        "model_name", "model_type", "version", F.array_join("feature_list", ",").alias("features"), *metric,
        F.col("training_info")["train"].alias("train_size"),
    )


@query(
    "rg2_next_version",
    f"""{ENTRIES} select model_name, 'v1.'||(max(k)//1000)||'.'||(max(k)%1000+1) as next_version from ve group by 1""",
)
def rg2_next_version(spark, sf_dir):
    return rg.next_versions(registered(spark, sf_dir).entries())


@query(
    "rg3_load_model",
    f"{PREDICT} select listing_id, price, round(yhat,2) as prediction from te",
)
def rg3_load_model(spark, sf_dir):
    store, df = saved_brand_model(spark, sf_dir)
    model, _ = store.load("brand_line")
    return model.transform(_split(df, "test")).select(
        "listing_id", "price", F.round("prediction", 2).alias("prediction")
    )


@query(
    "rg4_list_versions",
    f"{ENTRIES} select model_name, arg_max(version,k) as latest_version, count(*) as versions from ve group by 1",
)
def rg4_list_versions(spark, sf_dir):
    entries = registered(spark, sf_dir).entries()
    count = entries.groupBy("model_name").agg(F.count(F.lit(1)).alias("versions"))
    return rg.latest_versions(entries).join(count, "model_name")


@query(
    "rg5_production",
    f"""{ENTRIES}, b as (select model_name, arg_min(version, rmse*1e6+k/1e6) as version from ve where train_size>1 group by 1)
select ve.model_name, ve.version, rmse, b.version is not null as is_production from ve
 left join b on ve.model_name=b.model_name and ve.version=b.version""",
)
def rg5_production(spark, sf_dir):
    """First the newest version is in production, then the one with the lowest error."""
    store = registered(spark, sf_dir)
    entries = store.entries()
    store.choose_all(rg.latest_versions(entries).withColumnRenamed("latest_version", "version"))
    rmse = F.col("performance_metrics")["rmse"]
    best = entries.where(F.col("training_info")["train_size"].cast("long") > 1).groupBy("model_name")
    store.choose_all(best.agg(F.min_by("version", F.struct(rmse, rg.version_key())).alias("version")))
    return store.entries().select("model_name", "version", rmse.alias("rmse"), "is_production")


@query(
    "rg6_check_model",
    f"""{PREDICT} select 'brand_line' as model_name, 'v1.0.1' as version, 1 as feature_count, true as validation_passed,
 '' as errors, {sql.metrics_sql()} from te""",
)
def rg6_check_model(spark, sf_dir):
    store, df = saved_brand_model(spark, sf_dir)
    model, entry = store.load("brand_line")
    return rg.check_model(model, entry, _split(df, "test"))


# -- scoring ----------------------------------------------------------------------------

REQUEST_RANGES = {
    "year": (1995, 2001), "km": (0, 200000), "engine_size": (0.7, 7.0), "doors": (2, 5),
    "age_years": (0, 40), "year_of_reference": (1996, 2000),
}


def requests(spark, sf_dir):
    """Damaged listings as requests; some leave out the optional fields."""
    df = dirty_listings(spark, sf_dir)
    open_ = F.col("doors") == 3
    return df.select(
        "listing_id",
        *scoring.REQUIRED,
        F.when(~open_, F.col("year_of_reference")).alias("year_of_reference"),
        F.when(~open_, F.col("month_of_reference")).alias("month_of_reference"),
    )


def request_config(spark, sf_dir):
    """Listing configuration whose states are the nations of all regions but the first."""
    names = [r.n_name for r in table(spark, sf_dir, "nation").where("n_regionkey <> 0").collect()]
    return replace(LISTINGS, states=tuple(sorted(names)))


REQUESTS = f"""{D}, rq as (select *, case when doors<>3 then year_of_reference end as yr,
 case when doors<>3 then month_of_reference end as mo from d)"""
NATIONS = "(select n_name from nation where n_regionkey<>0)"
REQUEST_TESTS = (
    [(f"{c} missing", f"{c} is null") for c in scoring.REQUIRED]
    + [
        (f"{c} out of range", f"{'yr' if c == 'year_of_reference' else c}<{low} or {'yr' if c == 'year_of_reference' else c}>{high}")
        for c, (low, high) in REQUEST_RANGES.items()
    ]
    + [
        ("fuel_type not accepted", "fuel_type not in ('A','N')"),
        ("transmission not accepted", "transmission not in ('F','O')"),
        ("condition not accepted", "condition not in ('1-URGENT','2-HIGH','3-MEDIUM')"),
        ("doors not accepted", "doors not in (2,3,4,5)"),
        ("state not accepted", f"upper(state) not in {NATIONS}"),
    ]
)
REASONS = "concat_ws(';', " + ", ".join(f"case when {t} then '{n}' end" for n, t in REQUEST_TESTS) + ")"


@query("sc1_request_reasons", f"{REQUESTS} select listing_id, {REASONS} as reasons from rq")
def sc1_request_reasons(spark, sf_dir):
    checked = scoring.checked_requests(requests(spark, sf_dir), request_config(spark, sf_dir), REQUEST_RANGES)
    return checked.select("listing_id", F.array_join("reasons", ";").alias("reasons"))


VALID_REQUESTS = f"""{REQUESTS}, va as (select listing_id, brand, upper(state) as state, coalesce(yr,2024) as year_of_reference,
 coalesce(mo,'2024-01') as month_of_reference from rq where {REASONS}='')"""


@query("sc2_request_defaults", f"{VALID_REQUESTS} select * exclude (brand) from va")
def sc2_request_defaults(spark, sf_dir):
    valid, _ = scoring.valid_and_rejected(requests(spark, sf_dir), request_config(spark, sf_dir), REQUEST_RANGES)
    return valid.select(
        "listing_id", "state", F.col("year_of_reference").cast("long").alias("year_of_reference"), "month_of_reference"
    )


# Requests keep their damaged brands; those unknown in training get the mean of means.
SCORED = VALID_REQUESTS + ", " + f"""c as (select * from l where {sql.CLEAN_FILTER}),
 {sql.split_ctes('c', "md5(listing_id||'|42')")},
 bm as (select brand, avg(price) as e from sp where split='train' group by 1)
select listing_id, round(coalesce(e,(select avg(e) from bm)),2) as prediction, 'brand_line' as model_name,
 'v1.0.0' as model_version from va left join bm using (brand)"""


@query("sc3_batch_scores", SCORED)
def sc3_batch_scores(spark, sf_dir):
    model = request_model(split_listings(spark, sf_dir, "listing_id", "brand", "price"))
    valid, _ = scoring.valid_and_rejected(requests(spark, sf_dir), request_config(spark, sf_dir), REQUEST_RANGES)
    return _scores(scoring.score(valid, model, "brand_line", "v1.0.0"))


def request_model(df):
    """Brand line without a target column in its input."""
    stages = [fe.TargetMeanEncoder(["brand"], drop=False), fe.FeatureVector(["brand_encoded"]), training.linear("price")]
    return Pipeline(stages=stages).fit(train_rows(df).select("brand", "price"))


def _scores(scored):
    return scored.select(
        "listing_id", F.round("prediction", 2).alias("prediction"), "model_name", "model_version"
    )
