"""Streaming queries, run to the end of the given tables, and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.functions.hashing import alias_table
from pricegrid.operators import enrichment
from pricegrid.plans import model_queries as mq
from pricegrid.plans import sql
from pricegrid.plans.catalog import Catalog
from pricegrid.plans.feature_queries import split_listings
from pricegrid.session import shared_dir
from pricegrid.sources.listings import raw_listings, table
from pricegrid.streaming import ledger, quality, scoring

catalog = Catalog()
query = catalog.add
L = sql.WITH_L


def run_scoring(spark, sf_dir):
    """Requests as JSON files through the scoring stream; returns the output folder.

    JSON repeats the field names in every row, so the files are compressed. Such a file
    is read by one task, so a batch takes as many files as tasks can run.
    """
    base = shared_dir(spark, "scoring")
    rows = mq.requests(spark, sf_dir)
    rows.write.option("compression", "gzip").json(f"{base}/in")
    model = mq.request_model(split_listings(spark, sf_dir, "listing_id", "brand", "price"))
    files = max(4, spark.sparkContext.defaultParallelism)
    stream = scoring.request_stream(spark, f"{base}/in", rows.schema, files_per_batch=files)
    scoring.score_stream(
        stream, model, "brand_line", "v1.0.0", f"{base}/out", f"{base}/checkpoint",
        mq.request_config(spark, sf_dir), mq.REQUEST_RANGES,
    ).awaitTermination()
    return f"{base}/out"


@query("st1_stream_scores", mq.SCORED)
def st1_stream_scores(spark, sf_dir):
    return mq._scores(spark.read.parquet(f"{run_scoring(spark, sf_dir)}/scored"))


@query(
    "st1_stream_rejected",
    f"{mq.REQUESTS} select listing_id, {mq.REASONS} as reasons from rq where {mq.REASONS}<>''",
)
def st1_stream_rejected(spark, sf_dir):
    rejected = spark.read.parquet(f"{run_scoring(spark, sf_dir)}/rejected")
    return rejected.select("listing_id", F.array_join("reasons", ";").alias("reasons"))


@query(
    "st2_quality_windows",
    """with w as (select date_trunc('day', ts) as s, * from events)
select strftime(s, '%Y-%m-%d %H:%M:%S') as window_start, count(*) as rows,
 count(*) filter (where event_type not in ('view','click','purchase','signup')) as unknown_type,
 count(*) filter (where value<0) as negative_value, count(*) filter (where value>200) as high_value,
 count(*) filter (where json_extract(props,'$.k') is null) as bad_props,
 s + interval 1 day <= (select max(ts) from events) - interval 1 hour as closed
from w group by s""",
)
def st2_quality_windows(spark, sf_dir):
    base = shared_dir(spark, "windows")
    events = table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    counters = quality.quality_counters(stream, quality.event_rules())
    quality.write_counters(counters, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    out = quality.read_counters(spark, f"{base}/out", counters.schema).drop("window_end", "last_event")
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query(
    "st2_late_rows",
    """with e as (select *, date_trunc('day', ts) as s, ts < timestamp '2024-01-16' and event_id % 20 <> 0 as first from events),
 m as (select max(ts) - interval 1 hour as mark from e where first),
 j as (select e.*, not first and s + interval 1 day <= mark as late from e cross join m)
select strftime(s, '%Y-%m-%d %H:%M:%S') as window_start, count(*) as rows_in,
 count(*) filter (where not coalesce(late, false)) as rows_counted,
 count(*) filter (where late) as rows_late, count(*) filter (where value<0 and not coalesce(late, false)) as negative_value
from j group by s""",
)
def st2_late_rows(spark, sf_dir):
    """A twentieth of the events of the first half month arrive with the second half."""
    base = shared_dir(spark, "late")
    events = table(spark, sf_dir, "events")
    first = F.coalesce((F.col("ts") < F.lit("2024-01-16").cast("timestamp")) & (F.col("event_id") % 20 != 0), F.lit(False))
    for part in (first, ~first):
        events.where(part).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        rows = ledger.ledger_rows(stream, quality.event_rules())
        ledger.write_ledger(rows, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    out = ledger.read_ledger(spark, f"{base}/out", rows.schema)
    return out.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "rows_in", "rows_counted", "rows_late", "negative_value",
    )


# -- enrichment ---------------------------------------------------------------------------

U = {
    name: sql.uniform_sql("listing_id", name)
    for name in ("km", "price", "noise", "state", "city", "color", "doors", "condition")
}


def _weighted_sql(u, weights):
    words, cuts, others = zip(*alias_table(weights))
    place = f"({u}*{len(words)}e0)"
    cell = f"cast(floor{place} as int)"

    def look(values):
        return f"([{', '.join(values)}])[{cell}+1]"

    def texts(values):
        return [f"'{v}'" for v in values]

    low = look(f"{cut:.12f}e0" for cut in cuts)
    return f"case when {place}-{cell}<{low} then {look(texts(words))} else {look(texts(others))} end"


AGE = "(year_of_reference-year)"
BASE = "case " + " ".join(
    ("else" if limit is None else f"when {AGE}<={limit} then")
    + f" {AGE + '*' if yearly else ''}({float(low)}e0+{U['km']}*{float(high - low)}e0)"
    for limit, low, high, yearly in C.MILEAGE_BANDS
) + " end"
FACTOR = "case " + " ".join(
    f"when price>{above} then {low!r}e0+{U['price']}*{high - low!r}" for above, low, high in C.MILEAGE_PRICE_FACTORS
) + " else 1e0 end"
NOISE_LOW, NOISE_HIGH = C.MILEAGE_NOISE
KM = f"greatest(round({BASE}*({FACTOR})*({NOISE_LOW!r}e0+{U['noise']}*{NOISE_HIGH - NOISE_LOW!r}),0),0)"
STATE = _weighted_sql(U["state"], C.STATE_WEIGHTS)
CITIES = "case state " + " ".join(
    f"when '{s}' then [{', '.join(chr(39) + n + chr(39) for n in names)}]" for s, names in C.STATE_CITIES.items()
) + " end"
CONDITION = "case " + " ".join(
    ("else" if limit is None else f"when {AGE}<={limit} and km/greatest({AGE},1)<{below} then")
    + f" {_weighted_sql('u', odds)}"
    for limit, below, odds in C.CONDITION_BANDS
) + " end"
ENRICHED = f"""{L}, a as (select listing_id, brand, model, year, price, fuel_type, transmission, engine_size,
 year_of_reference, month_of_reference, {KM} as km, {STATE} as state,
 {_weighted_sql(U['color'], C.COLOR_WEIGHTS)} as color,
 cast({_weighted_sql(U['doors'], C.DOOR_WEIGHTS)} as bigint) as doors,
 {U['city']} as uc, {U['condition']} as u, {AGE} as age_years from l),
 b as (select * exclude (u), {CITIES} as names, {CONDITION} as condition from a),
 en as (select * exclude (names, uc), names[cast(floor(uc*len(names)) as int)+1] as city from b)"""


def enriched(spark, sf_dir):
    return enrichment.enrich(raw_listings(spark, sf_dir), keep_key=True)


@query("sy1_mileage", f"{ENRICHED} select listing_id, km from en")
def sy1_mileage(spark, sf_dir):
    return enriched(spark, sf_dir).select("listing_id", "km")


@query("sy2_location", f"{ENRICHED} select listing_id, state, city from en")
def sy2_location(spark, sf_dir):
    return enriched(spark, sf_dir).select("listing_id", "state", "city")


@query("sy3_condition", f"{ENRICHED} select listing_id, condition from en")
def sy3_condition(spark, sf_dir):
    return enriched(spark, sf_dir).select("listing_id", "condition")


@query("sy4_color_doors", f"{ENRICHED} select listing_id, color, doors from en")
def sy4_color_doors(spark, sf_dir):
    return enriched(spark, sf_dir).select("listing_id", "color", "doors")


@query(
    "sy5_enrich",
    f"""{ENRICHED} select listing_id, brand, model, year, price, km, state, city, fuel_type, transmission, engine_size,
 color, doors, condition, age_years, year_of_reference, month_of_reference from en""",
)
def sy5_enrich(spark, sf_dir):
    return enriched(spark, sf_dir)
