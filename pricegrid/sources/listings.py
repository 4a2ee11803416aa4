"""Listing tables built from the order schema, clean and with known damage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listing_key():
    """Hash of the row's identity; order number and line alone are not unique."""
    parts = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in parts], cents.cast("string")))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per order line.

    The orders come first, as they never fit a broadcast in a large table: the lines
    are shuffled while they are numbers and two flags. Supplier, nation and region are
    joined one by one: Spark takes a join of tables for as large as their product, and
    shuffled all lines once more for the three as one lookup. The texts of nation, region
    and part are added behind the shuffles. No side is forced to broadcast: Spark decides
    by size, and a hot part or order key is split by the adaptive skew join.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    sold, shipped = F.year("o_orderdate"), F.year("l_shipdate")
    return lines.select(
        listing_key().alias("listing_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("model"),
        sold.cast("long").alias("year"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * 4000.0).alias("km"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
        F.col("s_name").alias("city"),
        F.col("l_returnflag").alias("fuel_type"),
        F.col("l_linestatus").alias("transmission"),
        (F.col("p_size") / 10.0).alias("engine_size"),
        F.col("p_type").alias("color"),
        F.col("l_linenumber").cast("long").alias("doors"),
        F.col("o_orderpriority").alias("condition"),
        (shipped - sold).cast("long").alias("age_years"),
        shipped.cast("long").alias("year_of_reference"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month_of_reference"),
    )


def dirty_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with damage picked by the key hash, for the quality operators.

    The pick comes out of the explode that makes the copies, so a filter on a damaged
    column stays above it and the key is hashed once a row, not once a condition.
    """
    df = listings(spark, sf_dir)
    pick = F.conv(F.substring("listing_id", 1, 4), 16, 10).cast("int") % 50
    hit = {n: F.col("_pick") == n for n in range(10)}
    own = F.col("_own")
    copies = F.explode(F.when(own == 7, F.array(own, own)).otherwise(F.array(own)))
    damaged = df.withColumn("_own", pick).withColumn("_pick", copies).withColumns(
        {
            "brand": F.when(hit[2], F.concat(F.lit("  "), F.lower("brand"), F.lit("  "))).otherwise(
                F.col("brand")
            ),
            "model": F.when(~hit[3], F.col("model")),
            "price": F.when(hit[0], None)
            .when(hit[6], F.col("price") * 100)
            .otherwise(F.col("price")),
            "km": F.when(hit[1], None).when(hit[4], F.lit(-999.0)).otherwise(F.col("km")),
            "color": F.when(hit[5], F.lit("")).otherwise(F.col("color")),
            "age_years": F.when(hit[8], F.col("age_years") + 1).otherwise(F.col("age_years")),
            "state": F.when(hit[9], F.lower("state")).otherwise(F.col("state")),
        }
    )
    return damaged.drop("_own", "_pick")


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings under the raw column names that enrichment starts from."""
    df = listings(spark, sf_dir)
    return df.select(
        "listing_id",
        "brand",
        "model",
        F.col("year").alias("year_model"),
        F.col("price").alias("avg_price_brl"),
        F.col("fuel_type").alias("fuel"),
        F.col("transmission").alias("gear"),
        "engine_size",
        "year_of_reference",
        "month_of_reference",
    )
