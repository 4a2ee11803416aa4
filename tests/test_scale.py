"""What moves and where: plans and staged files of steps that many queries share."""

import glob
import time
from multiprocessing.pool import ThreadPool

from pyspark.sql import functions as F

from pricegrid import session
from pricegrid.operators import duplicates
from pricegrid.operators.cleaning import Cleaner
from pricegrid.operators.keys import with_row_key
from pricegrid.plans import feature_queries, stream_queries
from pricegrid.schema import LISTINGS
from pricegrid.sources.listings import dirty_listings, listings
from tests.conftest import FORD, HONDA, SF, TOYOTA, frame


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def depth(text, word):
    """Indent of the join on a column."""
    return next(line.index("Join") for line in text.splitlines() if "Join" in line and word in line)


def test_lines_meet_orders_before_texts(spark):
    text = plan(listings(spark, SF))
    assert depth(text, "o_orderkey") > depth(text, "s_suppkey") > depth(text, "p_partkey")


def test_filter_on_damage_hashes_the_key_once(spark):
    df = dirty_listings(spark, SF)
    kept = df.where("price < 0 or km < 0 or model is null or upper(state) = 'PERU' or age_years < 0")
    assert plan(kept).count("md5(") == 1
    copies = df.groupBy("listing_id").count().where("count > 1")
    picked = F.conv(F.substring("listing_id", 1, 4), 16, 10).cast("int") % 50 == 7
    assert copies.count() > 0
    assert df.where(picked).count() == 2 * listings(spark, SF).where(picked).count()


def test_cleaner_shuffles_digests(spark, monkeypatch):
    staged = []
    write = duplicates.stage
    monkeypatch.setattr(duplicates, "stage", lambda df, name: staged.append(name) or write(df, name))
    df = frame(spark, [TOYOTA, HONDA, TOYOTA, FORD, dict(FORD, model=None), dict(FORD, model=None)])
    model = Cleaner(LISTINGS, "domain").fit(df)
    prepared = model.prepare(df)
    assert staged == ["repeated-digests"]
    assert sorted(r.brand for r in prepared.collect()) == ["Ford", "Ford", "Honda", "Toyota"]


def test_copies_of_one_row_are_written_by_many_tasks(spark):
    df = spark.range(20_000).select(F.lit("a").alias("brand"), F.lit(1999).alias("year"))
    keyed = with_row_key(df, "key").withColumn("task", F.spark_partition_id())
    found = keyed.agg(F.count_distinct("key"), F.count_distinct("task")).first()
    assert found[0] == 20_000 and found[1] > 1


def test_requests_are_compressed(spark):
    out = stream_queries.run_scoring(spark, SF)
    files = glob.glob(f"{out.rsplit('/', 1)[0]}/in/part-*")
    assert files and all(name.endswith(".json.gz") for name in files)
    parts = [spark.read.parquet(f"{out}/{kind}").count() for kind in ("scored", "rejected")]
    assert sum(parts) == dirty_listings(spark, SF).count()


def test_selection_reads_a_slim_table(spark):
    df = feature_queries._candidates(spark, SF)
    assert df.columns == ["price", *feature_queries.CANDIDATES]
    assert "md5(" not in plan(df) and "brand" not in plan(df)


def test_small_tables_of_the_listings_cost_no_shuffle(spark):
    text = listings(spark, SF)._jdf.queryExecution().executedPlan().toString()
    # Supplier, nation and region are judged one by one, not by the product of their sizes.
    assert "hashpartitioning" not in text and text.count("BroadcastHashJoin") == 5


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def test_staged_tables_leave_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(session.CLEANUP, None)
    counted = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with ThreadPool(4) as pool:
        staged = pool.map(lambda k: session.stage(counted, f"counted-{k}"), range(4))
    for _ in range(50):  # the files go after the query has ended
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert [t.count() for t in staged] == [7] * 4 and spark.conf.get(session.CLEANUP, None) == setting
    # The table that was staged can be read again, and other queries keep their files.
    assert counted.count() == 7 and shuffle_files(spark) - before
