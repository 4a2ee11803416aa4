"""Row keys for tables that have none, and the seeded order that splits and samples use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.hashing import split_key

# Copies of one row that a task writes out; more copies are dealt out first.
COPIES = 1_024


def with_row_key(df: DataFrame, name="listing_id") -> DataFrame:
    """Add a unique text key: a digest of the whole row and the copy's number.

    Equal rows are counted (pre-aggregated per map task) and written out again
    with numbers 0, 1, ..., so the keys depend on the rows alone, not on their
    order or partitions. A row with many copies is dealt out in runs of COPIES, over
    a set number of partitions: the runs are few bytes before they are written out,
    so sized by bytes they would all meet in one task. A column of that name is
    replaced and not part of the digest.
    """
    columns = [c for c in df.columns if c != name]
    digest = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})) if columns else F.lit("")
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    counted = counted.withColumn("_digest", digest)
    dealt = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = F.explode(F.expr(f"sequence(0L, _n - 1, {COPIES}L)")).alias("_from")
    few = counted.where(F.col("_n") <= COPIES).select("*", F.lit(0).cast("long").alias("_from"))
    many = counted.where(F.col("_n") > COPIES).select("*", runs)
    many = many.repartition(dealt, "_digest", "_from")
    last = F.least(F.col("_n"), F.col("_from") + COPIES) - 1
    copies = few.unionByName(many).select(*columns, "_digest", F.explode(F.sequence("_from", last)).alias("_copy"))
    own = F.concat_ws("-", "_digest", F.col("_copy").cast("string"))
    return copies.withColumn(name, own).drop("_copy", "_digest")


def ordered(df: DataFrame, key, seed, by_row=False):
    """(frame, seeded hex key) in whose order rows are split or sampled.

    The order is the hash of the key column (missing keys first) and, among
    equal keys, the hash of the row key. by_row adds that second part, which
    costs a shuffle and is only needed where equal keys meet a cut, or where
    the table has no key column. It leaves a helper column `_row`.
    """
    first = F.coalesce(split_key(F.col(key), seed), F.lit("0" * 32)) if key in df.columns else None
    if not by_row and first is not None:
        return df, first
    second = F.md5(F.concat("_row", F.lit(f"|{seed}")))
    return with_row_key(df, "_row"), second if first is None else F.concat(first, second)
