"""Sources, sinks, projections and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.operators import projection
from pricegrid.operators.features import aligned
from pricegrid.operators.splitting import Splitter, split_sizes
from pricegrid.plans import sql
from pricegrid.plans.catalog import Catalog
from pricegrid.plans.flagship import valid_listings
from pricegrid.schema import CANONICAL_SCHEMA, LISTINGS
from pricegrid.session import once, shared_dir
from pricegrid.sources import sinks
from pricegrid.sources.listings import dirty_listings, listings, raw_listings
from pricegrid.sources.tables import combine, read_all, read_listings, read_rescued, sample_rows

catalog = Catalog()
query = catalog.add
L, D = sql.WITH_L, sql.WITH_D
CANONICAL_COLUMNS = [f.name for f in CANONICAL_SCHEMA]


def _write_csv(df, purpose):
    path = shared_dir(df.sparkSession, purpose)
    df.select(*CANONICAL_COLUMNS).write.option("header", True).csv(path)
    return path


# -- sources and sinks -----------------------------------------------------------


@query(
    "io1_csv_scan",
    f"""{L} select brand, count(*) as n, round(avg(price),4) as mean_price, round(avg(km),4) as mean_km,
 min(month_of_reference) as first_month, max(year) as last_year from l group by brand""",
)
def io1_csv_scan(spark, sf_dir):
    df = read_listings(spark, _write_csv(listings(spark, sf_dir), "csv"))
    return df.groupBy("brand").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("price"), 4).alias("mean_price"),
        F.round(F.avg("km"), 4).alias("mean_km"),
        F.min("month_of_reference").alias("first_month"),
        F.max("year").alias("last_year"),
    )


DAMAGED = f"""{L}, x as (select *, cast('0x'||substr(listing_id,5,4) as int) % 40 as h from l),
 r as (select case when h in (0,1) then 'year' when h=2 then 'price' when h in (3,4) then 'fields' end as reason from x)"""


def damaged_lines(spark, sf_dir):
    """Listings as CSV files some of whose lines the schema does not fit."""
    df = listings(spark, sf_dir).select(*CANONICAL_COLUMNS, "listing_id")
    pick = F.conv(F.substring("listing_id", 5, 4), 16, 10).cast("int") % 40
    df = df.withColumn("_pick", pick)
    texts = {c: F.col(c).cast("string") for c in CANONICAL_COLUMNS}
    texts["year"] = F.when(F.col("_pick").isin(0, 1), "MMXX").otherwise(texts["year"])
    texts["price"] = F.when(F.col("_pick") == 2, F.concat(F.lit("R$ "), texts["price"])).otherwise(texts["price"])
    fields = F.to_csv(F.struct(*[t.alias(c) for c, t in texts.items()]))
    fields = F.when(F.col("_pick") == 3, F.concat(fields, F.lit(",more"))).otherwise(fields)
    fields = F.when(F.col("_pick") == 4, F.regexp_replace(fields, ",[^,]*$", "")).otherwise(fields)
    path = shared_dir(spark, "damaged")
    df.select(fields.alias("line")).write.text(path)
    return path


@query(
    "io1_rescued_records",
    f"""{DAMAGED} select coalesce(reason, 'read') as found, count(*) as lines from r group by 1""",
)
def io1_rescued_records(spark, sf_dir):
    rows, rescued = read_rescued(spark, damaged_lines(spark, sf_dir), header=False)
    reason = F.when(F.col("reasons")[0].startswith("other"), "fields").otherwise(F.substring_index(F.col("reasons")[0], ":", 1))
    return rows.agg(F.lit("read").alias("found"), F.count(F.lit(1)).alias("lines")).unionByName(
        rescued.groupBy(reason.alias("found")).agg(F.count(F.lit(1)).alias("lines"))
    )


@query(
    "cl15_rescued_values",
    f"""{DAMAGED}, v as (select x.* from x where h in (0,1,2)) select case when h=2 then 'price' else 'year' end as "column",
 case when h=2 then 'no double' else 'no bigint' end as fault, count(*) as lines,
 round(avg(case when h=2 then price end),4) as mean_price from v group by 1,2""",
)
def cl15_rescued_values(spark, sf_dir):
    """Quarantined lines by column and fault; the text tells what stood there."""
    _, rescued = read_rescued(spark, damaged_lines(spark, sf_dir), header=False)
    parts = F.split(F.col("reasons")[0], ": ", 3)
    told = rescued.where(F.col("reasons")[0].contains(": no ")).select(
        parts[0].alias("column"), parts[1].alias("fault"), F.regexp_replace(parts[2], r"^R\$ ", "").try_cast("double").alias("price")
    )
    return told.groupBy("column", "fault").agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.avg("price"), 4).alias("mean_price")
    )


@query(
    "io2_load_all",
    f"""{L} select case when year_of_reference<1998 then 'historical' else 'recent' end as dataset,
 count(*) as n, round(avg(price),4) as mean_price from l group by 1""",
)
def io2_load_all(spark, sf_dir):
    df = listings(spark, sf_dir)
    old = F.col("year_of_reference") < 1998
    paths = {
        "historical": _write_csv(df.where(old), "historical"),
        "recent": _write_csv(df.where(~old), "recent"),
    }
    frames = [d.withColumn("dataset", F.lit(name)) for name, d in read_all(spark, paths).items()]
    return combine(*frames).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 4).alias("mean_price")
    )


@query(
    "io3_union_by_name",
    f"""{L} select year_of_reference, count(*) as n, count(month_of_reference) as n_month,
 round(avg(price),4) as mean_price from (
 select year_of_reference, price, cast(null as varchar) as month_of_reference from l where year_of_reference<1998
 union all select year_of_reference, price, month_of_reference from l where year_of_reference>=1998) group by 1""",
)
def io3_union_by_name(spark, sf_dir):
    df = listings(spark, sf_dir)
    old = df.where("year_of_reference < 1998").drop("month_of_reference")
    new = df.where("year_of_reference >= 1998").select(*reversed(df.columns))
    return combine(old, new).groupBy("year_of_reference").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("month_of_reference").alias("n_month"),
        F.round(F.avg("price"), 4).alias("mean_price"),
    )


def _split_rows(spark, sf_dir):
    rows = once(valid_listings(spark, sf_dir), "listing_id", "brand", "price", "year_of_reference")
    return Splitter().fit(rows).transform(rows)


BY_HASH = "md5(listing_id||'|42')"
SPLIT_SQL = f"{L}, c as (select * from l where {sql.CLEAN_FILTER}), {sql.split_ctes('c', BY_HASH)}"


@query(
    "io4_save_splits",
    f"{SPLIT_SQL} select split, count(*) as n_rows, round(avg(price),4) as mean_price from sp group by split",
)
def io4_save_splits(spark, sf_dir):
    path = sinks.save_splits(_split_rows(spark, sf_dir), shared_dir(spark, "splits"), fmt="csv")
    back = spark.read.option("header", True).schema("listing_id string, brand string, price double, "
                                                    "year_of_reference long, split string").csv(path)
    return back.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("price"), 4).alias("mean_price")
    )


@query(
    "io5_load_splits",
    f"""{SPLIT_SQL} select brand, count(*) as n_rows, round(avg(price),4) as mean_price
 from sp where split='test' group by brand""",
)
def io5_load_splits(spark, sf_dir):
    path = sinks.save_splits(_split_rows(spark, sf_dir), shared_dir(spark, "splits"))
    test = sinks.load_splits(spark, path).where(F.col("split") == "test")
    return test.groupBy("brand").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("price"), 4).alias("mean_price")
    )


@query(
    "io6_report_table",
    f"""{L} select brand, count(*) as n, round(avg(price),4) as mean_price, max(price) as max_price
 from l group by brand""",
)
def io6_report_table(spark, sf_dir):
    report = listings(spark, sf_dir).groupBy("brand").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("price"), 4).alias("mean_price"),
        F.max("price").alias("max_price"),
    )
    path = sinks.write_report(report, shared_dir(spark, "report"))
    return spark.read.option("header", True).schema(report.schema).csv(path)


@query(
    "io7_run_manifest",
    f"""{SPLIT_SQL} select 1 as position, 'load' as stage, 'listings' as artifact, count(*) as n_rows from c
 union all select 2, 'split', split, count(*) from sp group by split""",
)
def io7_run_manifest(spark, sf_dir):
    """Write two stages and their manifest, then count rows per recorded artifact."""
    base, run = shared_dir(spark, "run"), "run-1"
    rows = valid_listings(spark, sf_dir).select("listing_id", "brand", "price")
    rows.write.parquet(f"{base}/listings")
    rows = spark.read.parquet(f"{base}/listings")
    sinks.append_manifest(spark, f"{base}/manifest", run, 1, "load", "listings", f"{base}/listings")
    sinks.save_splits(Splitter().fit(rows).transform(rows), f"{base}/splits")
    for name in sinks.SPLITS:
        path = f"{base}/splits/split={name}"
        sinks.append_manifest(spark, f"{base}/manifest", run, 2, "split", name, path)
    manifest = sinks.read_manifest(spark, f"{base}/manifest")
    # One row per stage artifact: a handful, whatever the data size.
    counts = [
        spark.read.parquet(m.path).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(m.path).alias("path"), "n_rows"
        )
        for m in manifest.collect()
    ]
    return manifest.join(combine(*counts), "path").select("position", "stage", "artifact", "n_rows")


@query(
    "io8_seeded_sample",
    f"{L} select listing_id, brand, price from l order by {BY_HASH} limit 1000",
)
def io8_seeded_sample(spark, sf_dir):
    return sample_rows(once(listings(spark, sf_dir), "listing_id", "brand", "price"), 1000)


# -- projections --------------------------------------------------------------------


@query(
    "pr1_rename",
    f"""{L} select listing_id, brand, model, year, price, fuel_type, transmission, engine_size,
 year_of_reference, month_of_reference from l""",
)
def pr1_rename(spark, sf_dir):
    return projection.rename_existing(raw_listings(spark, sf_dir))


@query(
    "pr2_reorder",
    f"""{L} select brand, model, year, price, km, state, city, fuel_type, transmission, engine_size, color,
 doors, condition, age_years, year_of_reference, month_of_reference from l""",
)
def pr2_reorder(spark, sf_dir):
    return projection.reorder(listings(spark, sf_dir), CANONICAL_COLUMNS)


@query("pr3_select_text", f"{L} select {', '.join(sql.TEXT)} from l")
def pr3_select_text(spark, sf_dir):
    return projection.select_text(listings(spark, sf_dir))


@query("pr4_numeric_only", f"{L} select {', '.join(sql.NUMERIC)} from l")
def pr4_numeric_only(spark, sf_dir):
    return projection.select_numeric(listings(spark, sf_dir))


@query(
    "pr5_align_columns",
    f"{L} select listing_id, year, km, 0 as brand_encoded, engine_size, 0 as city_size from l",
)
def pr5_align_columns(spark, sf_dir):
    """brand_encoded is absent and city is text: both become 0."""
    df = listings(spark, sf_dir).withColumnRenamed("city", "city_size")
    features = ["year", "km", "brand_encoded", "engine_size", "city_size"]
    return df.select("listing_id", *aligned(df, features))


@query(
    "pr6_predicate_masks",
    f"""{D} select count(*) filter (where price is null or not (price<20000 or price>80000)) as kept,
 count(*) filter (where price<20000 or price>80000) as dropped,
 count(*) filter (where price is null) as unknown from d""",
)
def pr6_predicate_masks(spark, sf_dir):
    """A missing price is outside no range, so its row is kept."""
    from pricegrid.functions.predicates import outside

    mask = outside(F.col("price"), 20000, 80000)
    return dirty_listings(spark, sf_dir).agg(
        F.count_if(~mask).alias("kept"),
        F.count_if(mask).alias("dropped"),
        F.count_if(F.col("price").isNull()).alias("unknown"),
    )


@query(
    "pr7_membership",
    f"""{L} select condition, count(*) as n from l where condition in ('1-URGENT','2-HIGH','3-MEDIUM')
 and doors in (2,3,4,5) group by condition""",
)
def pr7_membership(spark, sf_dir):
    accepted = LISTINGS.allowed
    df = listings(spark, sf_dir).where(
        F.col("condition").isin(accepted["condition"]) & F.col("doors").isin(accepted["doors"])
    )
    return df.groupBy("condition").agg(F.count(F.lit(1)).alias("n"))


def range_sql_case(column, edges, labels):
    """Right-closed ranges; a None edge is unbounded."""
    return "case " + " ".join(
        f"when {column}>{a}" + (f" and {column}<={b}" if b is not None else "") + f" then '{label}'"
        for a, b, label in zip(edges, edges[1:], labels)
    ) + " end"


CATEGORY_SQL = "case " + " ".join(
    f"when price<{limit} then '{label}'" for limit, label in C.PRICE_CATEGORIES[:-1]
) + f" else '{C.PRICE_CATEGORIES[-1][1]}' end"


@query("pr8_price_category", f"{L} select listing_id, price, {CATEGORY_SQL} as price_category from l")
def pr8_price_category(spark, sf_dir):
    return listings(spark, sf_dir).select(
        "listing_id", "price", projection.price_category().alias("price_category")
    )


# -- splits -------------------------------------------------------------------------


@query("sp2_random_split", f"{L}, {sql.split_ctes('l', BY_HASH)} select listing_id, split from sp")
def sp2_random_split(spark, sf_dir):
    rows = once(listings(spark, sf_dir), "listing_id")
    return Splitter().fit(rows).transform(rows)


ROW_HASH = """md5(md5('{"brand":"' || brand || '","year_of_reference":' || year_of_reference || '}') || '-' || copy || '|42')"""


@query(
    "sp2_keyless_split",
    f"""{L}, c as (select brand, year_of_reference,
  row_number() over (partition by brand, year_of_reference) - 1 as copy from l),
 h as (select *, {ROW_HASH} as k from c), {sql.split_ctes('h', 'k')}
select brand, year_of_reference, split, count(*) as n from sp group by all""",
)
def sp2_keyless_split(spark, sf_dir):
    """Few different rows without a key: copies are told apart by their number."""
    rows = once(listings(spark, sf_dir), "brand", "year_of_reference")
    return Splitter().fit(rows).transform(rows).groupBy("brand", "year_of_reference", "split").agg(F.count("*").alias("n"))


BIN_SQL = "case " + " ".join(
    f"when price{'>=' if i == 0 else '>'}{low}" + (f" and price<={high}" if high else "") + f" then {i}"
    for i, (low, high) in enumerate(zip(C.SPLIT_PRICE_EDGES, C.SPLIT_PRICE_EDGES[1:]))
) + " end"


@query(
    "sp3_stratified_split",
    f"""{L}, b as (select listing_id, price, {BIN_SQL} as bin from l),
 r as (select *, row_number() over (partition by bin order by {BY_HASH}) as rn,
       count(*) over (partition by bin) as n from b where bin is not null)
select listing_id, price, case when rn<=floor(n*0.7e0) then 'train'
 when rn<=floor(n*0.7e0)+floor(n*0.15e0) then 'val' else 'test' end as split from r""",
)
def sp3_stratified_split(spark, sf_dir):
    rows = once(listings(spark, sf_dir), "listing_id", "price")
    return Splitter(method="stratified").fit(rows).transform(rows)


TIME_ORDER = f"year_of_reference, {BY_HASH}"


@query(
    "sp5_time_split",
    f"""{L}, {sql.split_ctes('l', TIME_ORDER)}
select listing_id, year_of_reference, split from sp""",
)
def sp5_time_split(spark, sf_dir):
    rows = once(listings(spark, sf_dir), "listing_id", "year_of_reference")
    return Splitter(method="time").fit(rows).transform(rows)


@query(
    "sp5_time_split_ranges",
    f"""{L}, {sql.split_ctes('l', TIME_ORDER)} select split, count(*) as n_rows,
 min(year_of_reference) as first, max(year_of_reference) as last from sp group by split""",
)
def sp5_time_split_ranges(spark, sf_dir):
    return split_sizes(sp5_time_split(spark, sf_dir), order="year_of_reference")

