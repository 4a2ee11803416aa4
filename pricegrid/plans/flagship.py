"""Flagship: clean, split, target-encode on train, predict, metrics per region."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid.operators.evaluation import metrics
from pricegrid.operators.features import TargetMeanEncoder
from pricegrid.operators.splitting import Splitter
from pricegrid.plans import sql
from pricegrid.plans.catalog import Catalog
from pricegrid.session import once
from pricegrid.sources.listings import listings

SPLIT_COLUMNS = ["listing_id", "brand", "region", "price"]


def valid_listings(spark, sf_dir):
    """Listings that meet the hard rules."""
    return listings(spark, sf_dir).where(
        (F.col("price") > 0)
        & (F.col("km") >= 0)
        & (F.col("age_years") >= 0)
        & (F.col("year") <= F.col("year_of_reference"))
        & F.col("engine_size").between(0.7, 7.0)
        & F.col("doors").isin(2, 3, 4, 5)
    )


def flagship(spark, sf_dir):
    rows = once(valid_listings(spark, sf_dir), *SPLIT_COLUMNS)
    labelled = Splitter(seed=None).fit(rows).transform(rows)
    encoder = TargetMeanEncoder(["brand"]).fit(labelled.where(F.col("split") == "train"))
    scored = encoder.transform(labelled.where(F.col("split") == "test"))
    return metrics(
        scored.select("region", F.col("price").alias("y"), F.col("brand_encoded").alias("yhat")),
        by=["region"],
    )


catalog = Catalog()

catalog.add(
    "flagship_region_metrics",
    f"""{sql.WITH_L}, c as (select * from l where {sql.CLEAN_FILTER}),
 {sql.split_ctes('c')},
 enc as (select brand, avg(price) as e from sp where split='train' group by brand),
 g as (select avg(e) as dflt from enc),
 p as (select sp.region, sp.price as y, coalesce(enc.e,g.dflt) as yhat
       from sp left join enc on sp.brand=enc.brand cross join g where split='test')
select region, {sql.metrics_sql()} from p group by region""",
)(flagship)
