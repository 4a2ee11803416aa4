import pytest
from pyspark.sql import functions as F

from pricegrid.functions.hashing import uniform
from pricegrid.operators.splitting import Splitter


@pytest.fixture(scope="module")
def thousand(spark):
    def pick(stream, words):
        values = F.array(*[F.lit(w) for w in words])
        return F.element_at(values, (F.floor(uniform(F.col("id"), stream) * len(words)) + 1).cast("int"))

    return spark.range(1000, numPartitions=5).select(
        F.col("id").cast("string").alias("listing_id"),
        pick("brand", ["Toyota", "Honda", "Ford"]).alias("brand"),
        (20000 + uniform(F.col("id"), "price") * 130000).alias("price"),
        pick("ref", [2021, 2022, 2023]).alias("year_of_reference"),
    )


def parts(df, **options):
    return Splitter(**options).split(df)


def keys(df):
    return {r.listing_id for r in df.select("listing_id").collect()}


@pytest.mark.parametrize("method", ["random", "time"])
def test_exact_sizes_no_overlap_no_loss(thousand, method):
    train, val, test = map(keys, parts(thousand, method=method))
    assert (len(train), len(val), len(test)) == (700, 150, 150)
    assert not train & val and not train & test and not val & test
    assert len(train | val | test) == 1000


def test_stratified_keeps_every_row_and_balances_prices(thousand):
    frames = parts(thousand, method="stratified")
    assert sum(f.count() for f in frames) == 1000
    means = [f.agg(F.avg("price")).first()[0] for f in frames]
    assert max(means) / min(means) < 1.5


def test_stratified_leaves_out_rows_without_bin(spark):
    df = spark.createDataFrame([("a", -1.0), ("b", 0.0), ("c", 5.0)], "listing_id string, price double")
    assert sum(f.count() for f in parts(df, method="stratified")) == 2


def test_time_split_is_chronological(thousand):
    train, val, test = parts(thousand, method="time")
    years = [f.agg(F.min("year_of_reference"), F.max("year_of_reference")).first() for f in (train, val, test)]
    assert years[0][1] <= years[1][0] and years[1][1] <= years[2][0]


def test_same_rows_whatever_the_partitioning(thousand):
    for method in ("random", "stratified", "time"):
        one = keys(parts(thousand.coalesce(1), method=method)[0])
        eight = keys(parts(thousand.repartition(8, "price"), method=method)[0])
        assert one == eight


def test_missing_columns_fall_back_to_the_random_split(thousand):
    random = keys(parts(thousand)[0])
    assert keys(parts(thousand.drop("price"), method="stratified")[0]) == random
    assert keys(parts(thousand.drop("year_of_reference"), method="time")[0]) == random


def test_sizes_must_sum_to_one():
    with pytest.raises(ValueError):
        Splitter(0.7, 0.2, 0.2)
    with pytest.raises(ValueError):
        Splitter(method="weekly")


def test_tiny_frames(spark):
    df = spark.createDataFrame([("a",), ("b",)], "listing_id string")
    assert [f.count() for f in parts(df)] == [1, 0, 1]
    assert [f.count() for f in parts(df.limit(0))] == [0, 0, 0]
