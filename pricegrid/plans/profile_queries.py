"""Profiling, exploratory aggregates and correlations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.functions import bins
from pricegrid.operators import correlation, profiling, projection
from pricegrid.operators.order import quantiles
from pricegrid.operators.profile_store import ProfileStore
from pricegrid.plans import sql
from pricegrid.plans.catalog import Catalog
from pricegrid.plans.table_queries import CATEGORY_SQL, range_sql_case
from pricegrid.session import once, shared_dir
from pricegrid.sources.listings import dirty_listings, listings, table

catalog = Catalog()
query = catalog.add
L, D = sql.WITH_L, sql.WITH_D
WORDS = ["brand", "model", "state", "city", "fuel_type", "transmission", "color", "condition"]

SPARK_TYPES = {c: "double" if c in ("price", "km", "engine_size") else "bigint" for c in sql.NUMERIC}


@query(
    "ed1_shape",
    f"{L} " + sql.union(
        f"""select {i} as position, '{c}' as "column", '{SPARK_TYPES.get(c, 'string')}' as dtype,
 '{'numeric' if c in SPARK_TYPES else 'string'}' as type_class, (select count(*) from l) as n_rows"""
        for i, c in enumerate(sql.LISTING_COLUMNS)
    ),
)
def ed1_shape(spark, sf_dir):
    return profiling.shape_info(listings(spark, sf_dir))


def _describe_sql(c, source):
    quantile = ", ".join(
        f"round(quantile_cont({c},{p}),4) as {name}" for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    )
    return f"""select '{c}' as "column", count({c}) as count, round(avg({c}),4) as mean, round(stddev_samp({c}),4) as std,
 cast(round(min({c}),4) as double) as min, {quantile}, cast(round(max({c}),4) as double) as max from {source}"""


@query("ed3_describe_numeric", f"{D} {sql.union(_describe_sql(c, 'd') for c in sql.NUMERIC)}")
def ed3_describe_numeric(spark, sf_dir):
    return profiling.describe_numeric(once(dirty_listings(spark, sf_dir), *sql.NUMERIC), sql.NUMERIC)


@query(
    "ed3_describe_events",
    f"{sql.union(_describe_sql(c, 'events') for c in ('value', 'user_id'))}",
)
def ed3_describe_events(spark, sf_dir):
    return profiling.describe_numeric(table(spark, sf_dir, "events"), ["value", "user_id"])


MERGED = ["price", "km", "year", "brand", "state", "fuel_type", "condition", "model"]
FEW_VALUES = ["brand", "state", "fuel_type", "condition"]


def _merged_sql(c):
    numeric = c in sql.NUMERIC
    facts = [
        f"cast(round({f}({c}),4) as double) as {name}" if numeric else f"cast(null as double) as {name}"
        for f, name in (("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max"))
    ]
    top = f"(select count(*) from d where {c} is not null group by {c} order by 1 desc limit 1)" if c in FEW_VALUES else "cast(null as bigint)"
    return f"""select '{c}' as "column", count(*) as rows, count(*)-count({c}) as missing, {', '.join(facts)},
 {top} as top_count, true as distinct_near, {'true' if numeric else 'cast(null as boolean)'} as quartiles_near from d"""


@query("ed3_merged_profiles", f"{D} {sql.union(_merged_sql(c) for c in MERGED)}")
def ed3_merged_profiles(spark, sf_dir):
    """Profiles of two loads merged from their sketches; estimates are held against exact counts."""
    df = once(dirty_listings(spark, sf_dir), *MERGED, "year_of_reference")
    base, old = shared_dir(spark, "loads"), F.col("year_of_reference") < 1996
    store = ProfileStore(spark, shared_dir(spark, "profiles"))
    for name, part in (("historical", df.where(old)), ("recent", df.where(~old))):
        part.select(*MERGED).write.parquet(f"{base}/{name}")
        store.add(base)  # the second time only the recent files are read
    found = once(store.merged())
    near = []
    for r in found.where("q50 is not null").select("column", "q25", "q50", "q75").collect():
        x = F.col(r["column"])
        shares = [
            (F.avg((x < q).cast("int")) <= p + 0.02) & (F.avg((x <= q).cast("int")) >= p - 0.02)
            for p, q in ((0.25, r.q25), (0.5, r.q50), (0.75, r.q75))
        ]
        near.append(F.struct(F.lit(r["column"]).alias("c"), (shares[0] & shares[1] & shares[2]).alias("quartiles_near")))
    ranks = df.agg(F.array(*near).alias("x")).select(F.inline("x"))
    exact = profiling.distinct_counts(df, MERGED).select(F.col("column").alias("dc"), F.col("distinct_values").alias("d"))
    joined = found.join(F.broadcast(ranks), F.col("column") == F.col("c"), "left").join(
        F.broadcast(exact), F.col("column") == F.col("dc")
    )
    top = F.when(F.col("column").isin(FEW_VALUES), F.array_max(F.col("frequent.count")))
    return joined.select(
        "column", "rows", "missing", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "max")],
        top.alias("top_count"), (F.abs(F.col("distinct_values") - F.col("d")) <= F.col("d") * 0.05).alias("distinct_near"),
        "quartiles_near",
    )


@query(
    "ed4_describe_text",
    f"{D} " + sql.union(
        f"""select '{c}' as "column", count({c}) as count, count(distinct {c}) as "unique",
 (select {c} from d where {c} is not null group by 1 order by count(*) desc, 1 limit 1) as top,
 (select count(*) from d where {c} is not null group by {c} order by count(*) desc limit 1) as freq from d"""
        for c in WORDS
    ),
)
def ed4_describe_text(spark, sf_dir):
    return profiling.describe_text(dirty_listings(spark, sf_dir), WORDS)


@query(
    "ed5_missing_values",
    f"{D} select * from ("
    + sql.union(
        f"""select '{c}' as "column", count(*) filter (where {c} is null) as missing,
 round(count(*) filter (where {c} is null)/count(*)*100,6) as percentage from d"""
        for c in sql.LISTING_COLUMNS
    )
    + ") where missing>0",
)
def ed5_missing_values(spark, sf_dir):
    return profiling.missing_values(dirty_listings(spark, sf_dir))


@query(
    "ed6_duplicate_count",
    f"""{D}, g as (select count(*) as n from (select d as r from d) group by r)
select cast(sum(n) as bigint) as rows, cast(sum(n-1) as bigint) as duplicates,
 round(sum(n-1)/sum(n)*100,6) as percentage from g""",
)
def ed6_duplicate_count(spark, sf_dir):
    return profiling.duplicate_count(dirty_listings(spark, sf_dir))


@query(
    "ed7_duplicate_rows",
    f"{D} select * exclude (n) from (select *, count(*) over (partition by d) as n from d) where n>1",
)
def ed7_duplicate_rows(spark, sf_dir):
    return profiling.duplicate_rows(dirty_listings(spark, sf_dir))


KEY = ["brand", "model", "year", "state", "fuel_type", "transmission", "color", "condition", "age_years"]


@query(
    "ed8_duplicate_keys",
    f"""{L}, g as (select count(*) as n from l group by {', '.join(KEY)})
select cast(sum(n) as bigint) as rows, cast(sum(n-1) as bigint) as duplicates,
 round(sum(n-1)/sum(n)*100,6) as percentage from g""",
)
def ed8_duplicate_keys(spark, sf_dir):
    return profiling.duplicate_count(listings(spark, sf_dir), KEY)


def _histogram_sql(x, n):
    return f"""{L}, v as (select {x} as x from l), r as (select min(x) as lo, max(x) as hi, (max(x)-min(x))/{n} as w from v)
select cast(least(floor((x-lo)/w),{n - 1}) as bigint) as bin,
 round(max(lo)+cast(least(floor((x-lo)/w),{n - 1}) as bigint)*max(w),4) as low,
 round(max(lo)+(cast(least(floor((x-lo)/w),{n - 1}) as bigint)+1)*max(w),4) as high,
 count(*) as count from v cross join r group by 1, cast(least(floor((x-lo)/w),{n - 1}) as bigint)"""


@query("ed9_histogram", _histogram_sql("price", 100))
def ed9_histogram(spark, sf_dir):
    return profiling.histogram(once(listings(spark, sf_dir), "price"), "price", 100)


@query("ed9_histogram_log", _histogram_sql("ln(1+price)", 50))
def ed9_histogram_log(spark, sf_dir):
    return profiling.histogram(once(listings(spark, sf_dir), "price"), "price", 50, log=True)


def _box_sql(source, x, by=""):
    group = f"{by}, " if by else ""
    where = f"where {by} is not null" if by else ""
    fences = "x>=q1-1.5e0*(q3-q1) and x<=q3+1.5e0*(q3-q1)"
    join = f"join q using ({by})" if by else "cross join q"
    return f"""v as (select {group}{x} as x from {source} {where}), q as (select {group}quantile_cont(x,0.25) as q1,
 quantile_cont(x,0.5) as q2, quantile_cont(x,0.75) as q3 from v {'group by ' + by if by else ''})
select {group}count(*) as count, round(max(q1),4) as q1, round(max(q2),4) as median, round(max(q3),4) as q3,
 round(least(min(x) filter (where {fences}),max(q1)),4) as whisker_low,
 round(greatest(max(x) filter (where {fences}),max(q3)),4) as whisker_high,
 count(*) filter (where not ({fences})) as outlier_points from v {join} {'group by ' + by if by else ''}"""


@query("ed10_box_stats", f"{L}, {_box_sql('l', 'price')}")
def ed10_box_stats(spark, sf_dir):
    return profiling.box_stats(once(listings(spark, sf_dir), "price"), "price")


@query("ed10_box_stats_log", f"{L}, {_box_sql('l', 'ln(1+price)')}")
def ed10_box_stats_log(spark, sf_dir):
    return profiling.box_stats(once(listings(spark, sf_dir), "price"), "price", log=True)


@query("ed10_box_stats_by_state", f"{L}, {_box_sql('l', 'price', 'state')}")
def ed10_box_stats_by_state(spark, sf_dir):
    return profiling.box_stats(once(listings(spark, sf_dir), "price", "state"), "price", ["state"])


def _moments(c):
    skew = f"(avg(({c}-mu)*({c}-mu)*({c}-mu))/pow(avg(({c}-mu)*({c}-mu)),1.5))"
    kurt = f"(avg(({c}-mu)*({c}-mu)*({c}-mu)*({c}-mu))/pow(avg(({c}-mu)*({c}-mu)),2)-3)"
    return f"""select '{c}' as "column", round({skew},4) as skewness, round({kurt},4) as kurtosis,
 case when abs({skew})>1 then 'high' when abs({skew})>0.5 then 'moderate' else 'symmetric' end as skew_label,
 case when {kurt}>3 then 'heavy tails' when {kurt}<3 then 'light tails' else 'normal tails' end as tail_label
 from d cross join (select avg({c}) as mu from d)"""


@query("ed11_skew_kurtosis", f"{D} {sql.union(_moments(c) for c in ('price', 'km', 'engine_size', 'age_years'))}")
def ed11_skew_kurtosis(spark, sf_dir):
    return profiling.skew_kurtosis(dirty_listings(spark, sf_dir), ["price", "km", "engine_size", "age_years"])


@query(
    "ed12_iqr_outliers",
    f"""{D}, q as (select quantile_cont(price,0.25) as a, quantile_cont(price,0.75) as b from d),
 f as (select a, b, a-1.5e0*(b-a) as lo, b+1.5e0*(b-a) as hi from q)
select round(max(a),4) as q1, round(max(b),4) as q3, round(max(lo),4) as lower, round(max(hi),4) as upper,
 count(*) filter (where price<lo or price>hi) as outliers,
 round(count(*) filter (where price<lo or price>hi)/count(*)*100,6) as percentage,
 min(price) filter (where price<lo or price>hi) as min_outlier,
 max(price) filter (where price<lo or price>hi) as max_outlier from d cross join f""",
)
def ed12_iqr_outliers(spark, sf_dir):
    return profiling.iqr_outliers(once(dirty_listings(spark, sf_dir), "price"), "price")


@query(
    "ed13_z_outliers",
    f"""{D}, s as (select avg(price) as m, stddev_pop(price) as s from d)
select round(max(m),4) as mean, round(max(s),4) as std, count(*) filter (where abs((price-m)/s)>3) as outliers,
 round(count(*) filter (where abs((price-m)/s)>3)/count(*)*100,6) as percentage,
 min(price) filter (where abs((price-m)/s)>3) as min_outlier,
 max(price) filter (where abs((price-m)/s)>3) as max_outlier from d cross join s""",
)
def ed13_z_outliers(spark, sf_dir):
    return profiling.z_outliers(once(dirty_listings(spark, sf_dir), "price"), "price")


@query(
    "ed14_label_distribution",
    f"""{L} select {CATEGORY_SQL} as label, count(*) as count,
 round(count(*)/(select count(*) from l)*100,6) as percentage from l group by 1""",
)
def ed14_label_distribution(spark, sf_dir):
    return profiling.label_distribution(listings(spark, sf_dir), projection.price_category())


def _stats(value, names=("mean", "median", "std", "count")):
    texts = {
        "mean": f"round(avg({value}),4) as mean", "median": f"round(quantile_cont({value},0.5),4) as median",
        "std": f"round(stddev_samp({value}),4) as std", "min": f"min({value}) as min",
        "max": f"max({value}) as max", "count": f"count({value}) as count",
    }
    return ", ".join(texts[n] for n in names)


for _by in ("year_of_reference", "brand", "state"):

    @query(f"ed15_stats_by_{_by}", f"{D} select {_by}, {_stats('price')} from d where {_by} is not null group by 1")
    def _stats_by(spark, sf_dir, by=_by):
        return profiling.group_stats(once(dirty_listings(spark, sf_dir), by, "price"), by, "price")


for _word, _direction in (("top", "desc"), ("bottom", "asc")):

    @query(
        f"ed16_{_word}_groups",
        f"""{L}, g as (select city, {_stats('price')} from l group by 1)
select * from g order by mean {_direction}, city limit 20""",
    )
    def _ranked(spark, sf_dir, ascending=_direction == "asc"):
        stats = profiling.group_stats(once(listings(spark, sf_dir), "city", "price"), "city", "price")
        return profiling.top_groups(stats, "mean", 20, "city", ascending)


@query(
    "ed17_frequent_models",
    f"""{L}, t as (select model from l group by 1 order by count(*) desc, model limit 30)
select model, {_stats('price')} from l where model in (select model from t) group by 1""",
)
def ed17_frequent_models(spark, sf_dir):
    df = once(listings(spark, sf_dir), "model", "price")
    return profiling.group_stats(profiling.only_frequent(df, "model", 30), "model", "price")


@query(
    "ed18_first_last_change",
    f"""{L}, g as (select year_of_reference as y, avg(price) as m from l group by 1),
 e as (select min(y) as a, max(y) as b, arg_min(m,y) as ma, arg_max(m,y) as mb from g)
select a as first_period, b as last_period, round(ma,4) as first_mean, round(mb,4) as last_mean,
 round(mb-ma,4) as change, round((mb-ma)/ma*100,4) as change_pct from e""",
)
def ed18_first_last_change(spark, sf_dir):
    return profiling.first_last_change(listings(spark, sf_dir), "year_of_reference", "price")


@query(
    "ed19_value_counts",
    f"{D} " + sql.union(
        f"""select '{c}' as "column", {c} as value, count(*) as count,
 round(count(*)/(select count({c}) from d)*100,6) as percentage from d where {c} is not null group by 2"""
        for c in WORDS
    ),
)
def ed19_value_counts(spark, sf_dir):
    return profiling.value_counts(dirty_listings(spark, sf_dir), WORDS)


@query(
    "ed20_top_with_others",
    f"""{L}, t as (select brand from l group by 1 order by count(*) desc, brand limit 10)
select case when brand in (select brand from t) then brand else 'Others' end as brand, count(*) as count
from l group by 1""",
)
def ed20_top_with_others(spark, sf_dir):
    return profiling.top_with_others(listings(spark, sf_dir), "brand", 10)


@query(
    "ed21_concentration",
    f"""{L}, g as (select model, count(*) as n from l group by 1),
 r as (select *, row_number() over (order by n desc, model) as k from g)
select t.top, cast(sum(n) filter (where k<=t.top) as bigint) as rows,
 round(sum(n) filter (where k<=t.top)/sum(n)*100,6) as share_pct
from r cross join (values (5),(10),(20),(30),(100)) t(top) group by 1""",
)
def ed21_concentration(spark, sf_dir):
    return profiling.concentration(listings(spark, sf_dir), "model")


@query(
    "ed22_frequency_of_frequencies",
    f"""{L}, g as (select city, model, count(*) as frequency from l group by 1,2)
select frequency, count(*) as "values" from g group by 1""",
)
def ed22_frequency_of_frequencies(spark, sf_dir):
    pair = listings(spark, sf_dir).withColumn("pair", F.concat_ws("|", "city", "model"))
    return profiling.frequency_of_frequencies(pair, "pair")


@query(
    "ed22_singletons",
    f"""{L}, g as (select city, model, doors, count(*) as n from l group by 1,2,3)
select count(*) filter (where n=1) as singletons, count(*) as "values",
 round(count(*) filter (where n=1)/count(*)*100,6) as percentage from g""",
)
def ed22_singletons(spark, sf_dir):
    text = F.concat_ws("|", "city", "model", F.col("doors").cast("string"))
    return profiling.singletons(listings(spark, sf_dir).withColumn("pair", text), "pair")


@query(
    "ed23_distinct_counts",
    f"{D} " + sql.union(
        f"""select '{c}' as "column", count(distinct {c}) as distinct_values from d""" for c in sql.LISTING_COLUMNS
    ),
)
def ed23_distinct_counts(spark, sf_dir):
    return profiling.distinct_counts(dirty_listings(spark, sf_dir))


CONDITION_ORDER = ["3-MEDIUM", "1-URGENT", "2-HIGH", "5-LOW"]


@query(
    "ed24_ordered_counts",
    f"""{L} select cast(position as int) as position, condition, count(*) as count from l join (values """
    + ", ".join(f"({i},'{c}')" for i, c in enumerate(CONDITION_ORDER))
    + ") o(position, condition) using (condition) group by 1,2",
)
def ed24_ordered_counts(spark, sf_dir):
    return profiling.ordered_counts(listings(spark, sf_dir), "condition", CONDITION_ORDER)


@query(
    "ed25_year_by_reference",
    f"""{L} select year_of_reference, {_stats('year', ('mean', 'min', 'max'))},
 (select year from l group by 1 order by count(*) desc, 1 limit 1) as common_year,
 (select count(*) from l group by year order by 1 desc limit 1) as common_count from l group by 1""",
)
def ed25_year_by_reference(spark, sf_dir):
    df = once(listings(spark, sf_dir), "year", "year_of_reference")
    common = profiling.most_frequent(df, "year", 1).select(
        F.col("year").alias("common_year"), F.col("count").alias("common_count")
    )
    stats = profiling.group_stats(df, "year_of_reference", "year", ("mean", "min", "max"))
    return stats.crossJoin(F.broadcast(common))


def _bin_sql(column, value, width, low, high, having=""):
    start = f"floor(({column}-{low})/{width}e0)*{width}+{low}"
    return f"""{L} select cast({start} as double) as bin_start, {_stats(value)},
 cast({start} as double)+{width}/2.0e0 as bin_mid from l where {column}>={low} and {column}<{high} group by 1 {having}"""


@query("ed26_year_bins", _bin_sql("year", "price", 2, 1990, 2002))
def ed26_year_bins(spark, sf_dir):
    """Price by bins of two model years."""
    return profiling.binned_stats(once(listings(spark, sf_dir), "year", "price"), "year", "price", 2, 1990, 2002)


@query("ed26_age_bins", _bin_sql("age_years", "km", 5, 0, 40))
def ed26_age_bins(spark, sf_dir):
    return profiling.binned_stats(once(listings(spark, sf_dir), "age_years", "km"), "age_years", "km", 5, 0, 40)


@query(
    "ed27_km_per_year",
    f"{L} select round(avg(case when age_years>0 then km/(age_years+1) end),4) as km_per_year from l",
)
def ed27_km_per_year(spark, sf_dir):
    return profiling.km_per_year(listings(spark, sf_dir))


for _by, _value in (
    ("fuel_type", "engine_size"), ("transmission", "engine_size"), ("condition", "age_years"), ("fuel_type", "age_years"),
):

    @query(
        f"ed28_{_value}_by_{_by}",
        f"{L} select {_by}, {_stats(_value, ('mean', 'median', 'std'))} from l group by 1",
    )
    def _feature_stats(spark, sf_dir, by=_by, value=_value):
        return profiling.group_stats(once(listings(spark, sf_dir), by, value), by, value, ("mean", "median", "std"))


for _column, _n in (("engine_size", 10), ("doors", 100)):

    @query(
        f"ed29_top_{_column}",
        f"""{L} select {_column}, count(*) as count, round(count(*)/(select count({_column}) from l)*100,6) as percentage
 from l group by 1 order by 2 desc, 1 limit {_n}""",
    )
    def _top_numbers(spark, sf_dir, column=_column, n=_n):
        return profiling.top_numbers(listings(spark, sf_dir), column, n)


# -- correlations -----------------------------------------------------------------------

CORR = ["price", "km", "year", "engine_size", "doors", "age_years", "year_of_reference"]


@query(
    "ed30_pearson_matrix",
    f"{L} " + sql.union(
        f"select '{a}' as a, '{b}' as b, {'1e0' if a == b else f'(select round(corr({a},{b}),6) from l)'} as r"
        for a in CORR for b in CORR
    ),
)
def ed30_pearson_matrix(spark, sf_dir):
    return correlation.correlation_matrix(listings(spark, sf_dir), CORR)


@query(
    "ed30_target_correlations",
    f"{L} " + sql.union(
        f"select '{c}' as feature, round(corr({c},price),6) as r from l" for c in CORR if c != "price"
    ),
)
def ed30_target_correlations(spark, sf_dir):
    return correlation.target_correlations(listings(spark, sf_dir), "price", CORR)


RANKS = "k as (select " + ", ".join(
    f"rank() over (order by {c})+(count(*) over (partition by {c})-1)/2.0e0 as {c}" for c in CORR
) + " from l)"


@query(
    "ed31_spearman_pairs",
    f"{L}, {RANKS} " + sql.union(
        f"select '{a}' as a, '{b}' as b, round(corr({a},{b}),6) as r from k" for a, b in combinations(CORR, 2)
    ),
)
def ed31_spearman_pairs(spark, sf_dir):
    pairs = correlation.spearman_pairs(once(listings(spark, sf_dir), *CORR), CORR)
    return pairs.select("a", "b", F.round("r", 6).alias("r"))


@query(
    "ed31_target_rank_correlations",
    f"{L}, {RANKS} " + sql.union(
        f"select '{c}' as feature, round(corr({c},price),6) as r from k" for c in ("km", "year", "engine_size", "age_years")
    ),
)
def ed31_target_rank_correlations(spark, sf_dir):
    columns = ["km", "year", "engine_size", "age_years"]
    return correlation.target_rank_correlations(once(listings(spark, sf_dir), "price", *columns), "price", columns)


for _x in ("age_years", "km"):

    @query(
        f"ed32_correlation_test_{_x}",
        f"""{L}, {RANKS}, c as (select corr({_x},price) as r, count(*) as n from l)
select '{_x}' as x, 'price' as y, n, round(r,6) as pearson, round(r*sqrt((n-2)/(1-r*r)),4) as t,
 round((select corr({_x},price) from k),6) as spearman from c""",
    )
    def _corr_test(spark, sf_dir, x=_x):
        found = correlation.correlation_test(once(listings(spark, sf_dir), x, "price"), x, "price")
        return found.select("x", "y", "n", "pearson", "t", "spearman")


@query("ed33_km_bins", _bin_sql("km", "price", 50000, 0, 600000, "having count(price)>100"))
def ed33_km_bins(spark, sf_dir):
    return profiling.binned_stats(once(listings(spark, sf_dir), "km", "price"), "km", "price", 50000, 0, 600000, 100)


for _column, (_edges, _labels) in {"age_years": profiling.AGE_RANGES, "km": profiling.KM_RANGES}.items():
    _source = f"s as (select price, {range_sql_case(_column, _edges, _labels)} as range from l)"

    @query(f"ed34_{_column}_range_box", f"{L}, {_source}, {_box_sql('s', 'price', 'range')}")
    def _range_box(spark, sf_dir, column=_column, edges=_edges, labels=_labels):
        return profiling.range_box_stats(once(listings(spark, sf_dir), column, "price"), column, "price", edges, labels)


for _by, _least, _n in (("brand", 100, 20), ("model", 50, 30)):

    @query(
        f"ed35_frequent_{_by}_stats",
        f"""{L}, g as (select {_by}, {_stats('price')} from l group by 1 having count(*)>={_least})
select * from g order by mean desc, {_by} limit {_n}""",
    )
    def _having(spark, sf_dir, by=_by, least=_least, n=_n):
        stats = profiling.group_stats(once(listings(spark, sf_dir), by, "price"), by, "price")
        return profiling.top_groups(stats.where(F.col("count") >= least), "mean", n, by)


@query(
    "ed35_mean_of_means",
    f"""{L}, g as (select model, round(avg(price),4) as m from l group by 1 having count(*)>=50)
select count(*) as groups, round(avg(m),4) as mean, min(m) as min, max(m) as max from g""",
)
def ed35_mean_of_means(spark, sf_dir):
    stats = profiling.group_stats(listings(spark, sf_dir), "model", "price", ("mean", "count"))
    return stats.where(F.col("count") >= 50).agg(
        F.count(F.lit(1)).alias("groups"), F.round(F.avg("mean"), 4).alias("mean"),
        F.min("mean").alias("min"), F.max("mean").alias("max"),
    )


MEANS = "m as (select model, avg(price) as mean, count(*) as n from l where model is not null group by 1 having count(price)>=50)"


@query(
    "ed35_median_of_means",
    f"{L}, {MEANS} select round(quantile_cont(mean,0.5),4) as median_of_means from m",
)
def ed35_median_of_means(spark, sf_dir):
    means = listings(spark, sf_dir).where("model is not null").groupBy("model").agg(
        F.avg("price").alias("mean"), F.count("price").alias("n")
    ).where("n >= 50")
    return quantiles(means, ["mean"], [0.5]).select(F.round(F.col("mean")[0], 4).alias("median_of_means"))


@query(
    "ed35_means_histogram",
    f"""{L}, m as (select city, avg(price) as m from l where city is not null group by 1 having count(price)>=5),
 e as (select min(m) as lo, max(m) as hi, (max(m)-min(m))/8 as w from m),
 b as (select greatest(least(cast(ceil((m-lo)/w) as int)-1, 7), 0) as bin, lo, w from m cross join e)
select bin, round(lo+bin*w,4) as low, round(lo+(bin+1)*w,4) as high, count(*) as groups from b group by bin, lo, w""",
)
def ed35_means_histogram(spark, sf_dir):
    return profiling.means_histogram(once(listings(spark, sf_dir), "city", "price"), "city", "price", 8, 5)


for _name, _pair, _source in (
    ("fuel_by_transmission", ("fuel_type", "transmission"), "select fuel_type, transmission, price from l"),
    ("condition_by_age", ("condition", "age_range"), f"select condition, {range_sql_case('age_years', C.AGE_RANGE_EDGES, C.AGE_RANGE_LABELS)} as age_range, price from l"),
):

    @query(
        f"ed36_{_name}_stats",
        f"""{L}, s as ({_source}) select {', '.join(_pair)}, round(avg(price),4) as mean,
 round(quantile_cont(price,0.5),4) as median, count(price) as count from s
 where {' and '.join(f'{c} is not null' for c in _pair)} group by 1,2""",
    )
    def _pair_stats(spark, sf_dir, pair=_pair):
        """Mean, median and count of the price per pair of groups."""
        label = bins.right_closed(F.col("age_years"), C.AGE_RANGE_EDGES, C.AGE_RANGE_LABELS)
        df = once(listings(spark, sf_dir).withColumn("age_range", label), *pair, "price")
        return profiling.group_stats(df, list(pair), "price", ("mean", "median", "count"))


@query(
    "ed36_brand_by_year",
    f"""{L}, t as (select brand from l group by 1 order by count(*) desc, brand limit 10)
select brand, year, round(avg(price),4) as mean_price from l where brand in (select brand from t) group by 1,2""",
)
def ed36_brand_by_year(spark, sf_dir):
    top = profiling.only_frequent(once(listings(spark, sf_dir), "brand", "year", "price"), "brand", 10)
    return top.groupBy("brand", "year").agg(F.round(F.avg("price"), 4).alias("mean_price"))


FUELS, GEARS = ["A", "N", "R"], ["F", "O"]


@query(
    "ed36_fuel_by_transmission",
    f"{L} select fuel_type, " + ", ".join(
        f"round(avg(price) filter (where transmission='{g}'),4) as {g}" for g in GEARS
    ) + " from l group by 1",
)
def ed36_fuel_by_transmission(spark, sf_dir):
    return profiling.pivot_means(listings(spark, sf_dir), "fuel_type", "transmission", "price", GEARS)


YEARS = list(range(1992, 1999))


@query(
    "ed36_brand_by_year_pivot",
    f"""{L}, t as (select brand from l group by 1 order by count(*) desc, brand limit 10) select brand, """ + ", ".join(
        f'round(avg(price) filter (where year={y}),4) as "{y}"' for y in YEARS
    ) + " from l where brand in (select brand from t) group by 1",
)
def ed36_brand_by_year_pivot(spark, sf_dir):
    top = profiling.only_frequent(once(listings(spark, sf_dir), "brand", "year", "price"), "brand", 10)
    return profiling.pivot_means(top, "brand", "year", "price", YEARS)


@query(
    "ed36_fuel_by_engine_pivot",
    f"""{L}, r as (select min(engine_size) as lo, max(engine_size) as hi from l),
 s as (select fuel_type, price, case when engine_size<=lo+(hi-lo)*1/5 then 0 when engine_size<=lo+(hi-lo)*2/5 then 1
 when engine_size<=lo+(hi-lo)*3/5 then 2 when engine_size<=lo+(hi-lo)*4/5 then 3 else 4 end as b from l cross join r)
select fuel_type, """ + ", ".join(f'round(avg(price) filter (where b={k}),4) as "{k}"' for k in range(5)) + " from s group by 1",
)
def ed36_fuel_by_engine_pivot(spark, sf_dir):
    df = once(listings(spark, sf_dir), "engine_size", "fuel_type", "price")
    low, high = df.agg(F.min("engine_size"), F.max("engine_size")).first()
    label = bins.right_closed(F.col("engine_size"), bins.equal_width_edges(low, high, 5))
    df = df.withColumn("engine_bin", label.cast("string"))
    return profiling.pivot_means(df, "fuel_type", "engine_bin", "price", [str(k) for k in range(5)])


AGE_CASE = range_sql_case("age_years", C.AGE_RANGE_EDGES, C.AGE_RANGE_LABELS)


@query(
    "ed36_condition_by_age",
    f"{L}, s as (select condition, price, {AGE_CASE} as age_range from l) select condition, " + ", ".join(
        f"""case when count(price) filter (where age_range='{a}')>=50
 then round(avg(price) filter (where age_range='{a}'),4) end as "{a}" """ for a in C.AGE_RANGE_LABELS
    ) + " from s group by 1",
)
def ed36_condition_by_age(spark, sf_dir):
    label = bins.right_closed(F.col("age_years"), C.AGE_RANGE_EDGES, C.AGE_RANGE_LABELS)
    df = listings(spark, sf_dir).withColumn("age_range", label)
    return profiling.pivot_means(df, "condition", "age_range", "price", C.AGE_RANGE_LABELS, 50)


@query(
    "ed36_fuel_by_engine",
    f"""{L}, r as (select min(engine_size) as lo, max(engine_size) as hi from l),
 s as (select fuel_type, price, engine_size as e, lo, hi, (hi-lo)/5 as w from l cross join r)
select fuel_type, case when e<=lo+(hi-lo)*1/5 then 0 when e<=lo+(hi-lo)*2/5 then 1 when e<=lo+(hi-lo)*3/5 then 2
 when e<=lo+(hi-lo)*4/5 then 3 else 4 end as engine_bin, round(avg(price),4) as mean_price from s group by 1,2""",
)
def ed36_fuel_by_engine(spark, sf_dir):
    df = once(listings(spark, sf_dir), "engine_size", "fuel_type", "price")
    low, high = df.agg(F.min("engine_size"), F.max("engine_size")).first()
    label = bins.right_closed(F.col("engine_size"), bins.equal_width_edges(low, high, 5))
    return df.groupBy("fuel_type", label.alias("engine_bin")).agg(
        F.round(F.avg("price"), 4).alias("mean_price")
    )


@query(
    "ed36_year_by_transmission",
    f"{L} select year, " + ", ".join(
        f"round(avg(price) filter (where transmission='{g}'),4) as {g}" for g in GEARS
    ) + " from l group by 1",
)
def ed36_year_by_transmission(spark, sf_dir):
    return profiling.pivot_means(listings(spark, sf_dir), "year", "transmission", "price", GEARS)


@query(
    "ed37_sample_per_group",
    f"""{L} select listing_id, condition, age_years, price from l
 qualify row_number() over (partition by condition order by md5(listing_id||'|42'))<=5000""",
)
def ed37_sample_per_group(spark, sf_dir):
    df = once(listings(spark, sf_dir), "listing_id", "condition", "age_years", "price")
    return profiling.sample_per_group(df, "condition", 5000)


@query("ed38_head", f"{L} select * from l order by listing_id limit 5")
def ed38_head(spark, sf_dir):
    return listings(spark, sf_dir).orderBy("listing_id").limit(5)
