"""Feature stages and feature selection on the valid listings."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from pricegrid.operators import feature_selection as selection
from pricegrid.operators import features as fe
from pricegrid.operators.splitting import Splitter
from pricegrid.plans import sql
from pricegrid.plans.catalog import Catalog
from pricegrid.plans.flagship import valid_listings
from pricegrid.plans.table_queries import SPLIT_SQL
from pricegrid.schema import LISTINGS
from pricegrid.session import once
from pricegrid.sources.listings import listings, table

catalog = Catalog()
query = catalog.add
L = sql.WITH_L


def split_listings(spark, sf_dir, *columns):
    """Valid listings (the given columns) with the seeded split label."""
    rows = once(valid_listings(spark, sf_dir), *columns)
    return Splitter().fit(rows).transform(rows)


def train_rows(df):
    return df.where(F.col("split") == "train")


def nation_regions(spark, sf_dir):
    """State -> region map from the nation table (25 rows in any scale)."""
    rows = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_name", "r_name")
        .collect()
    )
    return {r.n_name: r.r_name for r in rows}


@query("fe1_age_squared", f"{L} select listing_id, age_years, age_years*age_years as age_squared from l")
def fe1_age_squared(spark, sf_dir):
    df = listings(spark, sf_dir).drop("age_years")
    return fe.AgeFeatures().transform(df).select("listing_id", "age_years", "age_squared")


@query(
    "fe2_region",
    f"""{L} select listing_id, state, case when n_regionkey=0 then 'Unknown' else region end as region
 from l join nation on state=n_name""",
)
def fe2_region(spark, sf_dir):
    """The states of one region are left out of the map and become Unknown."""
    mapping = {s: r for s, r in nation_regions(spark, sf_dir).items() if r != "AFRICA"}
    df = listings(spark, sf_dir).drop("region")
    return fe.RegionLookup(mapping).transform(df).select("listing_id", "state", "region")


def tidy_mean(column):
    """Round a mean of cents. Many such means end in an exact 5 at the seventh
    digit, so they are moved off the tie first: summation order must not matter."""
    return F.round(F.col(column) + F.lit(1e-8), 6)


ENCODED = ["brand", "model", "state", "city"]
ENCODE_SQL = SPLIT_SQL + ", tr as (select * from sp where split='train'), " + ", ".join(
    f"""e_{c} as (select {c}, avg(price) as e_{c} from tr group by 1),
 g_{c} as (select avg(e_{c}) as d_{c} from e_{c})"""
    for c in ENCODED
) + ", en as (select sp.*, " + ", ".join(
    f"coalesce(e_{c}.e_{c},d_{c}) as {c}_encoded" for c in ENCODED
) + " from sp " + " ".join(
    f"left join e_{c} on sp.{c}=e_{c}.{c} cross join g_{c}" for c in ENCODED
) + ")"


@query(
    "fe3_target_means",
    ENCODE_SQL + " select listing_id, split, "
    + ", ".join(f"round({c}_encoded+1e-8,6) as {c}_encoded" for c in ENCODED) + " from en",
)
def fe3_target_means(spark, sf_dir):
    df = split_listings(spark, sf_dir, "listing_id", "price", *ENCODED)
    out = fe.TargetMeanEncoder(ENCODED).fit(train_rows(df)).transform(df)
    return out.select("listing_id", "split", *[tidy_mean(f"{c}_encoded").alias(f"{c}_encoded") for c in ENCODED])


@query(
    "fe3_unseen_category",
    f"""{SPLIT_SQL}, e as (select city, avg(price) as e from sp where split='train' and doors<4 and km<40000 group by 1)
select listing_id, round(coalesce(e.e,(select avg(e) from e))+1e-8,6) as city_encoded
 from sp left join e using (city) where split='test'""",
)
def fe3_unseen_category(spark, sf_dir):
    df = split_listings(spark, sf_dir, "listing_id", "city", "price", "doors", "km")
    fitted = fe.TargetMeanEncoder(["city"]).fit(train_rows(df).where("doors < 4 and km < 40000"))
    out = fitted.transform(df.where("split = 'test'"))
    return out.select("listing_id", tidy_mean("city_encoded").alias("city_encoded"))


ONE_HOT = {
    "fuel_type": ["A", "N", "R"],
    "transmission": ["F", "O"],
    "condition": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
}
ONE_HOT_SQL = ", ".join(
    f"""cast({c}='{v}' as int) as "{c}_{v}" """ for c, values in ONE_HOT.items() for v in values
)


@query("fe4_indicators", f"{L} select listing_id, {ONE_HOT_SQL} from l")
def fe4_indicators(spark, sf_dir):
    df = once(listings(spark, sf_dir), "listing_id", *ONE_HOT)
    return fe.IndicatorEncoder(list(ONE_HOT)).fit(df).transform(df)


SPARSE = ["model", "city", "fuel_type"]
SPARSE_SQL = f"""{L}, {", ".join(
    f"v_{c} as (select {c}, row_number() over (order by {c} collate \"C\")-1 as i, count(*) over () as k"
    f" from (select distinct {c} from l where {c} is not null))" for c in SPARSE
)} select listing_id, list_sort([v_model.i, coalesce((select max(k) from v_model),0)+v_city.i,
 coalesce((select max(k) from v_model),0)+coalesce((select max(k) from v_city),0)+v_fuel_type.i]) as places
 from l {" ".join(f"join v_{c} on l.{c}=v_{c}.{c}" for c in SPARSE)}"""


@query("fe4_sparse_indicators", SPARSE_SQL)
def fe4_sparse_indicators(spark, sf_dir):
    df = once(listings(spark, sf_dir), "listing_id", *SPARSE)
    out = fe.SparseIndicatorEncoder(SPARSE).fit(df).transform(df)
    return out.select("listing_id", fe.places_of("indicators").alias("places"))


@query(
    "fe5_log_columns",
    f"{L} select listing_id, round(ln(1+price),8) as price_log, round(ln(1+km),8) as km_log from l",
)
def fe5_log_columns(spark, sf_dir):
    out = fe.LogColumns(["price", "km"]).transform(listings(spark, sf_dir))
    return out.select("listing_id", F.round("price_log", 8).alias("price_log"), F.round("km_log", 8).alias("km_log"))


SCALED = ["year", "engine_size", "doors", "age_years"]


def _scale_sql(center, spread):
    stats = ", ".join(f"{center}({c}) as a_{c}, {spread.format(c=c)} as b_{c}" for c in SCALED)
    out = ", ".join(f"round(({c}-a_{c})/case when b_{c}=0 then 1 else b_{c} end,8) as {c}" for c in SCALED)
    return f"{SPLIT_SQL}, s as (select {stats} from sp where split='train') select listing_id, {out} from sp cross join s"


def _scaled(spark, sf_dir, method):
    df = split_listings(spark, sf_dir, "listing_id", *SCALED)
    out = fe.Scaler(SCALED, method).fit(train_rows(df)).transform(df)
    return out.select("listing_id", *[F.round(c, 8).alias(c) for c in SCALED])


@query("fe6_standardize", _scale_sql("avg", "stddev_pop({c})"))
def fe6_standardize(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@query("fe7_min_max", _scale_sql("min", "max({c})-min({c})"))
def fe7_min_max(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


VALID = f"{L}, c as (select * from l where {sql.CLEAN_FILTER})"


@query("fe8_depreciation", f"{VALID} select listing_id, round(price/(age_years+1),4) as depreciation_rate from c")
def fe8_depreciation(spark, sf_dir):
    out = fe.Depreciation().transform(valid_listings(spark, sf_dir))
    return out.select("listing_id", F.round("depreciation_rate", 4).alias("depreciation_rate"))


@query(
    "fe9_frequency",
    f"""{SPLIT_SQL}, tr as (select * from sp where split='train'),
 b as (select brand, count(*)/(select count(*) from tr) as f from tr group by 1),
 m as (select model, count(*)/(select count(*) from tr) as f from tr group by 1)
select listing_id, round(coalesce(b.f,0),8) as brand_frequency, round(coalesce(m.f,0),8) as model_frequency
 from sp left join b using (brand) left join m using (model)""",
)
def fe9_frequency(spark, sf_dir):
    df = split_listings(spark, sf_dir, "listing_id", "brand", "model")
    out = fe.FrequencyEncoder(["brand", "model"]).fit(train_rows(df)).transform(df)
    return out.select(
        "listing_id", *[F.round(f"{c}_frequency", 8).alias(f"{c}_frequency") for c in ("brand", "model")]
    )


@query(
    "fe10_interactions",
    f"""{VALID} select listing_id, brand||'_'||year as brand_year_interaction,
 fuel_type||'_'||transmission as fuel_transmission_interaction from c""",
)
def fe10_interactions(spark, sf_dir):
    out = fe.Interactions().transform(valid_listings(spark, sf_dir))
    return out.select("listing_id", "brand_year_interaction", "fuel_transmission_interaction")


AGE_WORD = """case when age_years<=lo+w then 'Very_New' when age_years<=lo+2*w then 'New'
 when age_years<=lo+3*w then 'Medium' when age_years<=lo+4*w then 'Old' else 'Very_Old' end"""


@query(
    "fe11_age_condition",
    f"""{VALID}, r as (select cast(min(age_years) as double) as lo, (max(age_years)-min(age_years))/5.0e0 as w from c)
select listing_id, {AGE_WORD}||'_'||condition as age_condition_interaction from c cross join r""",
)
def fe11_age_condition(spark, sf_dir):
    df = valid_listings(spark, sf_dir)
    out = fe.AgeConditionBinner().fit(df).transform(df)
    return out.select("listing_id", "age_condition_interaction")


@query("fe12_km_per_year", f"{VALID} select listing_id, round(km/(age_years+1),4) as km_per_year from c")
def fe12_km_per_year(spark, sf_dir):
    out = fe.Interactions().transform(valid_listings(spark, sf_dir))
    return out.select("listing_id", F.round("km_per_year", 4).alias("km_per_year"))


def _edges_sql(c):
    edges = ", ".join(f"quantile_cont({c},{i / 5})" for i in range(6))
    return f"(select list_sort(list_distinct([{edges}])) from sp where split='train')"


def _bin_case(c):
    """0-based right-closed bin; the lowest edge belongs to the first bin."""
    e = f"e_{c}"
    return f"""case when {c}<{e}[1] or {c}>{e}[len({e})] then null
 else greatest(len(list_filter({e}, lambda x: x<{c}))-1,0) end"""


@query(
    "fe13_quantile_bins",
    f"""{SPLIT_SQL}, ed as (select {_edges_sql('price')} as e_price, {_edges_sql('age_years')} as e_age_years,
 {_edges_sql('km')} as e_km)
select listing_id, cast({_bin_case('price')} as int) as price_bin, cast({_bin_case('age_years')} as int) as age_bin,
 cast({_bin_case('km')} as int) as km_bin from sp cross join ed""",
)
def fe13_quantile_bins(spark, sf_dir):
    df = split_listings(spark, sf_dir, "listing_id", "price", "age_years", "km")
    out = fe.QuantileBinner().fit(train_rows(df)).transform(df)
    return out.select("listing_id", "price_bin", "age_bin", "km_bin")


@query(
    "fe14_city_size",
    f"""{SPLIT_SQL}, n as (select city, count(*) as n from sp where split='train' group by 1)
select listing_id, city, case when n>1000 then 'Large' when n>100 then 'Medium' else 'Small' end as city_size
 from sp left join n using (city)""",
)
def fe14_city_size(spark, sf_dir):
    df = split_listings(spark, sf_dir, "listing_id", "city")
    out = fe.SizeLabeler().fit(train_rows(df)).transform(df)
    return out.select("listing_id", "city", "city_size")


@query(
    "fe14_city_size_per_batch",
    f"""{VALID}, n as (select city, count(*) as n from c group by 1)
select listing_id, city, case when n>1000 then 'Large' when n>100 then 'Medium' else 'Small' end as city_size
 from c join n using (city)""",
)
def fe14_city_size_per_batch(spark, sf_dir):
    df = once(valid_listings(spark, sf_dir), "listing_id", "city")
    out = fe.SizeLabeler(per_batch=True).fit(df).transform(df)
    return out.select("listing_id", "city", "city_size")


STANDARD = ["year", "engine_size", "doors", "age_years", "year_of_reference", "age_squared"]
FULL_SQL = (
    ENCODE_SQL
    + ", z as (select *, age_years*age_years as age_squared from en), s as (select "
    + ", ".join(f"avg({c}) as a_{c}, stddev_pop({c}) as b_{c}" for c in STANDARD)
    + " from z where split='train') select listing_id, split, price, km, "
    + ", ".join(f"round(({c}-a_{c})/case when b_{c}=0 then 1 else b_{c} end,8) as {c}" for c in STANDARD)
    + ", round(ln(1+km),8) as km_log, "
    + ", ".join(f"round({c}_encoded+1e-8,6) as {c}_encoded" for c in ENCODED)
    + f", {ONE_HOT_SQL} from z cross join s"
)


def full_features(spark, sf_dir):
    """Fitted feature stages and the transformed frame, fitted on train only."""
    mapping = nation_regions(spark, sf_dir)
    return fe.transform_split(split_listings(spark, sf_dir), LISTINGS, mapping=mapping)


def _rounded(out):
    tidy = {c: F.round(c, 8) for c in (*STANDARD, "km_log")}
    tidy |= {f"{c}_encoded": tidy_mean(f"{c}_encoded") for c in ENCODED}
    return out.select(*[tidy[c].alias(c) if c in tidy else fe.quoted(c) for c in out.columns])


@query("fe15_full_features", FULL_SQL)
def fe15_full_features(spark, sf_dir):
    return _rounded(full_features(spark, sf_dir)[1])


@query("fe16_saved_features", FULL_SQL)
def fe16_saved_features(spark, sf_dir):
    """The same frame from the feature model after saving and loading it."""
    from pyspark.ml import PipelineModel

    from pricegrid.session import shared_dir

    df = split_listings(spark, sf_dir)
    train = train_rows(df)
    model = fe.fit_features(train, LISTINGS, keep=("split",), mapping=nation_regions(spark, sf_dir))
    path = shared_dir(spark, "feature-model")
    model.write().overwrite().save(path)
    return _rounded(PipelineModel.load(path).transform(df))


FEATURES = ["km", *STANDARD, "km_log", *[f"{c}_encoded" for c in ENCODED], *[f"{c}_{v}" for c, vs in ONE_HOT.items() for v in vs]]


@query(
    "fe16_saved_selection",
    f"with f as ({FULL_SQL}), tr as (select * from f where split='train'), te as (select * from f where split='test') "
    + sql.union(
        f"select '{c}' as feature, count(*) as n, round(avg(\"{c}\"),3)+0e0 as mean from te "
        f"having (select abs(corr(\"{c}\",price)) from tr) >= 0.05"
        for c in FEATURES
    ),
)
def fe16_saved_selection(spark, sf_dir):
    """Rows and mean on test of the features that a saved and loaded model selects."""
    from pyspark.ml import PipelineModel

    from pricegrid.session import shared_dir

    df = split_listings(spark, sf_dir)
    select = selection.SelectFeatures("price", ("listing_id", "split"), method="correlation", threshold=0.05, prune=False)
    model = fe.fit_features(train_rows(df), LISTINGS, [select], keep=("split",), mapping=nation_regions(spark, sf_dir))
    path = shared_dir(spark, "selected-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    names = fe.feature_names(loaded)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), fe.quoted(c).cast("double").alias("x")) for c in names]))
    rows = loaded.transform(df).where("split = 'test'").select(cells.alias("c")).select("c.*")
    return rows.groupBy("feature").agg(F.count("*").alias("n"), (F.round(F.avg("x"), 3) + 0.0).alias("mean"))


@query(
    "fe17_features_by_split",
    f"with f as ({FULL_SQL}) select split, count(*) as n, round(avg(brand_encoded),3) as brand_encoded, "
    "round(avg(year),4)+0 as year, round(stddev_pop(age_years),4) as age_years, "
    'sum("fuel_type_A") as fuel_a from f group by split',
)
def fe17_features_by_split(spark, sf_dir):
    return _rounded(full_features(spark, sf_dir)[1]).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("brand_encoded"), 3).alias("brand_encoded"),
        (F.round(F.avg("year"), 4) + 0).alias("year"),
        F.round(F.stddev_pop("age_years"), 4).alias("age_years"),
        F.sum("fuel_type_A").alias("fuel_a"),
    )


# -- selection -------------------------------------------------------------------------

CANDIDATES = ["km", "year", "engine_size", "doors", "age_years", "year_of_reference", "age_squared", "km_log"]
FRAME = f"""{SPLIT_SQL}, f as (select price, km, year, engine_size, doors, age_years, year_of_reference,
 age_years*age_years as age_squared, ln(1+km) as km_log from sp where split='train')"""


def _candidates(spark, sf_dir):
    """Train rows with the target and the features to choose from, written once: selection reads them many times."""
    df = train_rows(split_listings(spark, sf_dir, "listing_id", "price", *CANDIDATES[:-2]))
    df = fe.LogColumns(["km"]).transform(fe.AgeFeatures().transform(df))
    return once(df, "price", *CANDIDATES)


SCORES = sql.union(f"select '{c}' as feature, abs(corr({c},price)) as score from f" for c in CANDIDATES)


@query(
    "fs1_correlation",
    f"{FRAME}, s as ({SCORES}) select feature, round(score,6) as score, score>=0.01 as selected from s",
)
def fs1_correlation(spark, sf_dir):
    df = _candidates(spark, sf_dir)
    report = selection.FeatureSelector("correlation", prune=False).fit(df, "price", CANDIDATES).report(spark)
    return report.select("feature", F.round("score", 6).alias("score"), "selected")


def _binned(c):
    edges = ", ".join(f"quantile_cont({c},{i / 10})" for i in range(1, 10))
    return f"(select list_distinct([{edges}]) from f) as e_{c}"


MI_COLUMNS = ["km", "year", "engine_size", "age_years"]
MI_BINS = ", ".join(f"len(list_filter(e_{c}, lambda x: x<{c})) as b_{c}" for c in (*MI_COLUMNS, "price"))


@query(
    "fs2_mutual_information",
    f"{FRAME}, ed as (select {', '.join(_binned(c) for c in (*MI_COLUMNS, 'price'))}), "
    f"b as (select {MI_BINS} from f cross join ed), j as ("
    + sql.union(
        f"select '{c}' as feature, b_{c} as bx, b_price as by_, count(*) as n from b group by 2,3" for c in MI_COLUMNS
    )
    + """), m as (select *, sum(n) over (partition by feature, bx) as nx, sum(n) over (partition by feature, by_) as ny,
 sum(n) over (partition by feature) as nt from j)
select feature, round(sum(cast(n as double)/nt*ln(cast(n as double)*nt/(cast(nx as double)*ny))),6) as score from m group by 1""",
)
def fs2_mutual_information(spark, sf_dir):
    return selection.mutual_information(_candidates(spark, sf_dir), MI_COLUMNS, "price")


def _selection_facts(report, method):
    """What holds of scores by a seeded forest: which features, that importances are a
    share of one, and that the best of them is among the chosen."""
    return report.agg(
        F.lit(method).alias("method"), F.array_join(F.sort_array(F.collect_set("feature")), ",").alias("features"),
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("score").between(0, 1)).alias("within"),
        F.round(F.sum("score"), 6).alias("total"), F.max_by("selected", "score").alias("best_selected"),
    )


@query(
    "fs3_importance",
    f"select 'importance' as method, '{','.join(sorted(CANDIDATES))}' as features, {len(CANDIDATES)}::bigint as n, true as within, 1e0 as total, true as best_selected",
)
def fs3_importance(spark, sf_dir):
    df = _candidates(spark, sf_dir)
    report = selection.FeatureSelector("importance", prune=False).fit(df, "price", CANDIDATES).report(spark)
    return _selection_facts(report, "importance")


@query("fs4_all_methods")
def fs4_all_methods(spark, sf_dir):
    df = _candidates(spark, sf_dir)
    return selection.FeatureSelector("all").fit(df, "price", CANDIDATES).report(spark)


@query(
    "fs5_redundant_pairs",
    f"{FRAME} select * from (" + sql.union(
        f"select '{a}' as a, '{b}' as b, round(abs(corr({a},{b})),6) as r from f" for a, b in combinations(CANDIDATES, 2)
    ) + ") where r>0.9",
)
def fs5_redundant_pairs(spark, sf_dir):
    pairs = selection.feature_pairs(_candidates(spark, sf_dir), CANDIDATES)
    rows = [(a, b, round(r, 6)) for (a, b), r in pairs.items() if round(r, 6) > 0.9]
    return spark.createDataFrame(rows, "a string, b string, r double")


PAIRS = sql.union(
    f"select {i} as ia, {j} as ib, abs(corr({CANDIDATES[i]},{CANDIDATES[j]})) as r from f"
    for i, j in combinations(range(len(CANDIDATES)), 2)
)
POSITIONS = sql.union(
    f"select {i} as i, '{c}' as feature, abs(corr({c},price)) as score from f" for i, c in enumerate(CANDIDATES)
)


@query(
    "fs6_selection_report",
    f"""{FRAME}, s as ({POSITIONS}), p as ({PAIRS}),
 kept as (select * from s where score>=0.0001),
 gone as (select case when a.score>b.score then b.feature else a.feature end as feature
  from p join kept a on p.ia=a.i join kept b on p.ib=b.i where p.r>0.9)
select feature, round(score,6) as score, score>=0.0001 and feature not in (select feature from gone) as selected from s""",
)
def fs6_selection_report(spark, sf_dir):
    chosen = selection.FeatureSelector("correlation", threshold=0.0001, cutoff=0.9)
    report = chosen.fit(_candidates(spark, sf_dir), "price", CANDIDATES).report(spark)
    return report.select("feature", F.round("score", 6).alias("score"), "selected")


@query("fs7_apply_selection")
def fs7_apply_selection(spark, sf_dir):
    df = _candidates(spark, sf_dir)
    chosen = selection.FeatureSelector("correlation", k=4).fit(df, "price", CANDIDATES)
    return chosen.transform(df, keep=("price",))


@query(
    "fs7_selected_values",
    f"""{FRAME}, scored as ({SCORES}), best as (select * from scored order by score desc, feature limit 4), met as ("""
    + sql.union(f"select '{a}' as a, '{b}' as b, abs(corr({a},{b})) as r from f" for a, b in combinations(CANDIDATES, 2))
    + """), gone as (select case when x.score>y.score then met.b else met.a end as feature
 from met join best x on met.a=x.feature join best y on met.b=y.feature where r>0.95), vals as ("""
    + sql.union(f"select '{c}' as feature, count(*) as n, round(avg({c}),3)+0e0 as mean from f" for c in CANDIDATES)
    + ") select vals.* from vals join best using (feature) where feature not in (select feature from gone)",
)
def fs7_selected_values(spark, sf_dir):
    """Rows and mean of every column that the selection by correlation keeps."""
    df = once(_candidates(spark, sf_dir))
    out = selection.FeatureSelector("correlation", k=4).fit(df, "price", CANDIDATES).transform(df)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in out.columns]))
    rows = out.select(cells.alias("c")).select("c.*")
    return rows.groupBy("feature").agg(F.count("*").alias("n"), (F.round(F.avg("x"), 3) + 0.0).alias("mean"))
