"""Cleaning operators on the damaged listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.operators import cleaning
from pricegrid.operators.cleaning import Cleaner
from pricegrid.plans import sql
from pricegrid.plans.catalog import Catalog
from pricegrid.schema import LISTINGS
from pricegrid.session import once
from pricegrid.sources.listings import dirty_listings

catalog = Catalog()
query = catalog.add
D = sql.WITH_D
OUTLIER_COLUMNS = ["price", "km", "year", "age_years", "engine_size"]
LIMITS = {
    "price": (1000, 100000), "km": (0, 200000), "year": (1995, 2001), "age_years": (0, 40),
    "engine_size": (0.7, 7.0),
}
COLUMNS = sql.LISTING_COLUMNS
KEYS = ["listing_id", "price", "km", "year", "age_years", "engine_size"]

STATS = "st as (select " + ", ".join(
    f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}, quantile_cont({c},0.25) as q1_{c}, quantile_cont({c},0.75) as q3_{c}"
    for c in OUTLIER_COLUMNS
) + " from d)"
IQR = " or ".join(
    f"coalesce({c}<q1_{c}-1.5e0*(q3_{c}-q1_{c}) or {c}>q3_{c}+1.5e0*(q3_{c}-q1_{c}),false)" for c in OUTLIER_COLUMNS
)
ZSCORE = " or ".join(f"coalesce(s_{c}>0 and abs(({c}-m_{c})/s_{c})>3,false)" for c in OUTLIER_COLUMNS)
DOMAIN = " or ".join(
    f"coalesce({c}<{low} or {c}>{high},false)" for c, (low, high) in LIMITS.items()
)
MASKS = {"iqr": IQR, "zscore": ZSCORE, "domain": DOMAIN, "combined": f"{IQR} or {ZSCORE} or {DOMAIN}"}

UNIQUE = "u as (select distinct * from d)"
# The median of price and km, and the most frequent model, of the distinct rows.
FILLS = """f as (select (select quantile_cont(price,0.5) from u) as f_price, (select quantile_cont(km,0.5) from u) as f_km,
 (select model from u where model is not null group by model order by count(*) desc, model limit 1) as f_model)"""
AGE = "case when age_years is null or age_years<0 then year_of_reference-year else age_years end"
IMPUTED = f"""i as (select u.* replace (coalesce(price,f_price) as price, coalesce(km,f_km) as km,
 coalesce(model,f_model) as model, {AGE} as age_years) from u cross join f)"""
FIXED = "x as (select * replace (year_of_reference-year as age_years) from i)"


def _tidy(name, expr):
    collapsed = rf"regexp_replace({expr},'\s+',' ','g')"
    return f"{collapsed} as {name}"


TEXT = ", ".join(
    [_tidy(c, sql.title_sql(sql.strip_sql(c))) for c in ("brand", "model", "city")]
    + [f"{sql.title_sql(sql.strip_sql(c))} as {c}" for c in ("fuel_type", "transmission", "color", "condition")]
    + [f"upper({sql.strip_sql('state')}) as state"]
)
VALID = """price>0 and km>=0 and year>=1995 and year<=2001 and age_years>=0 and year<=year_of_reference
 and engine_size>0 and engine_size<=7 and doors in (2,3,4,5)"""


def full_clean_sql(method, select="*"):
    """SQL of the whole cleaning chain."""
    return f"""{D}, {STATS}, {UNIQUE}, {FILLS}, {IMPUTED}, {FIXED},
 o as (select x.* from x cross join st where not ({MASKS[method]})),
 t as (select * replace ({TEXT}) from o)
select {select} from t where {VALID}"""


@query("cl0_clean_iqr", full_clean_sql("iqr", ", ".join(COLUMNS)))
def cl0_clean_iqr(spark, sf_dir):
    return Cleaner(LISTINGS, "iqr").clean(once(dirty_listings(spark, sf_dir))).select(*COLUMNS)


@query("cl0_clean_combined", full_clean_sql("combined", ", ".join(COLUMNS)))
def cl0_clean_combined(spark, sf_dir):
    return Cleaner(LISTINGS, "combined").clean(once(dirty_listings(spark, sf_dir))).select(*COLUMNS)


@query(
    "cl0_clean_report",
    f"""{D}, {STATS}, {UNIQUE}, {FILLS}, {IMPUTED}, {FIXED},
 j as (select x.*, ({MASKS['iqr']}) as outlier, not coalesce({VALID},false) as invalid from x cross join st)
select (select count(*) from d) as rows_in, count(*) as rows_distinct,
 count(*) filter (where outlier) as rows_outlier, count(*) filter (where invalid) as rows_invalid,
 count(*) filter (where not outlier and not invalid) as rows_kept,
 round(((select count(*) from d)-count(*) filter (where not outlier and not invalid))
   /(select count(*) from d)*100,4) as removed_pct from j""",
)
def cl0_clean_report(spark, sf_dir):
    df = once(dirty_listings(spark, sf_dir))
    return Cleaner(LISTINGS, "iqr").fit(df).report(df)


@query("cl1_dedupe", f"{D} select distinct * from d")
def cl1_dedupe(spark, sf_dir):
    return cleaning.dedupe(dirty_listings(spark, sf_dir))


@query(
    "cl2_fit_statistics",
    f"{D} " + sql.union(
        f"""select '{c}' as "column", round(avg({c}),4) as mean, round(stddev_samp({c}),4) as std,
 round(quantile_cont({c},0.25),4) as q25, round(quantile_cont({c},0.75),4) as q75,
 round(quantile_cont({c},0.75)-quantile_cont({c},0.25),4) as iqr from d"""
        for c in OUTLIER_COLUMNS
    ),
)
def cl2_fit_statistics(spark, sf_dir):
    found = cleaning.fit_statistics(once(dirty_listings(spark, sf_dir), *OUTLIER_COLUMNS), OUTLIER_COLUMNS)
    table = cleaning.statistics_table(spark, found)
    return table.select("column", *[F.round(c, 4).alias(c) for c in ("mean", "std", "q25", "q75", "iqr")])


@query("cl3_missing_age", f"{D} select listing_id, year, year_of_reference, {AGE} as age_years from d")
def cl3_missing_age(spark, sf_dir):
    df = cleaning.fix_missing_age(dirty_listings(spark, sf_dir))
    return df.select("listing_id", "year", "year_of_reference", "age_years")


NUMBER_FILLS = """select listing_id, coalesce(price,(select quantile_cont(price,0.5) from d)) as price,
 coalesce(km,(select quantile_cont(km,0.5) from d)) as km from d"""


@query("cl4_impute_numbers", f"{D} {NUMBER_FILLS}")
def cl4_impute_numbers(spark, sf_dir):
    df = once(dirty_listings(spark, sf_dir), "listing_id", "price", "km")
    return cleaning.impute(df, cleaning.fit_imputation(df))


@query(
    "cl5_impute_text",
    f"""{D} select listing_id, coalesce(model,(select model from d where model is not null group by model
 order by count(*) desc, model limit 1)) as model, color from d""",
)
def cl5_impute_text(spark, sf_dir):
    df = once(dirty_listings(spark, sf_dir), "listing_id", "model", "color")
    return cleaning.impute(df, cleaning.fit_imputation(df))


@query(
    "cl6_correct_types",
    f"""{D} select listing_id, year, cast(coalesce(case when doors<5 then doors end,0) as bigint) as doors, price,
 case when km<>-999 then km end as km from d""",
)
def cl6_correct_types(spark, sf_dir):
    """Numbers arriving as text, some unreadable: bad integers 0, bad floats null."""
    df = dirty_listings(spark, sf_dir).select(
        "listing_id",
        F.col("year").cast("string").alias("year"),
        F.when(F.col("doors") < 5, F.col("doors").cast("string")).otherwise("many").alias("doors"),
        F.col("price").cast("string").alias("price"),
        F.when(F.col("km") == -999, "unknown").otherwise(F.col("km").cast("string")).alias("km"),
    )
    return cleaning.correct_types(df, LISTINGS)


@query(
    "cl7_fix_age",
    f"""{D} select listing_id, case when age_years<>year_of_reference-year or age_years<0 then year_of_reference-year
 else age_years end as age_years from d""",
)
def cl7_fix_age(spark, sf_dir):
    return cleaning.fix_age(dirty_listings(spark, sf_dir)).select("listing_id", "age_years")


def _outlier_query(name, method):
    text = f"{D}, {STATS} select {', '.join('d.' + k for k in KEYS)} from d cross join st where not ({MASKS[method]})"

    @query(name, text)
    def run(spark, sf_dir):
        df = once(dirty_listings(spark, sf_dir), *KEYS)
        model = Cleaner(LISTINGS, method).fit(df)
        return df.where(~cleaning.any_of(model.masks(df).values()))

    return run


_outlier_query("cl8_outliers_iqr", "iqr")
_outlier_query("cl9_outliers_zscore", "zscore")
_outlier_query("cl10_outliers_domain", "domain")
_outlier_query("cl11_outliers_combined", "combined")


@query(
    "cl12_text_names",
    f"{D} select listing_id, "
    + ", ".join(_tidy(c, sql.title_sql(sql.strip_sql(c))) for c in ("brand", "model", "city"))
    + " from d",
)
def cl12_text_names(spark, sf_dir):
    df = cleaning.standardize_text(dirty_listings(spark, sf_dir), LISTINGS)
    return df.select("listing_id", "brand", "model", "city")


@query(
    "cl13_text_codes",
    f"{D} select listing_id, upper({sql.strip_sql('state')}) as state, "
    + ", ".join(
        f"{sql.title_sql(sql.strip_sql(c))} as {c}" for c in ("fuel_type", "transmission", "color", "condition")
    )
    + " from d",
)
def cl13_text_codes(spark, sf_dir):
    df = cleaning.standardize_text(dirty_listings(spark, sf_dir), LISTINGS)
    return df.select("listing_id", "state", "fuel_type", "transmission", "color", "condition")


@query("cl14_drop_invalid", f"{D} select {', '.join(KEYS)}, doors from d where {VALID}")
def cl14_drop_invalid(spark, sf_dir):
    return cleaning.drop_invalid(dirty_listings(spark, sf_dir), LISTINGS).select(*KEYS, "doors")


REASONS = [
    (f"outlier {c}", f"coalesce({c}<q1_{c}-1.5e0*(q3_{c}-q1_{c}) or {c}>q3_{c}+1.5e0*(q3_{c}-q1_{c}),false)")
    for c in OUTLIER_COLUMNS
] + [
    (f"invalid {name}", f"not coalesce({kept},false)")
    for name, kept in (
        ("price", "price>0"), ("km", "km>=0"), ("year", "year>=1995 and year<=2001"),
        ("age_years", "age_years>=0"), ("year_of_reference", "year<=year_of_reference"),
        ("engine_size", "engine_size>0 and engine_size<=7"), ("doors", "doors in (2,3,4,5)"),
    )
]


@query(
    "cl15_quarantine",
    f"{D}, {STATS}, {UNIQUE}, {FILLS}, {IMPUTED}, {FIXED} select listing_id, concat_ws(';', "
    + ", ".join(f"case when {test} then '{name}' end" for name, test in REASONS)
    + ") as reasons from x cross join st",
)
def cl15_quarantine(spark, sf_dir):
    df = once(dirty_listings(spark, sf_dir))
    judged = Cleaner(LISTINGS, "iqr").fit(df).quarantine(df)
    return judged.select("listing_id", F.array_join("reasons", ";").alias("reasons"))
