"""Equal rows by digest: the same rows as by whole-row grouping, in every case."""

import pytest
from pyspark.sql import functions as F

from pricegrid.operators import duplicates as D

ROWS = [
    (1, "a", None, 0.0, [1, None], (1, "x")),
    (1, "a", None, -0.0, [1, None], (1, "x")),  # zero has one value
    (1, None, "a", 0.0, [1, None], (1, "x")),  # the null is elsewhere
    (1, None, "a", 0.0, [1, None], (1, "x")),
    (1, None, "a", 0.0, [None, 1], (1, "x")),
    (None, None, None, None, None, None),
    (None, None, None, None, None, None),
    (2, "a", "b", float("nan"), [], (None, "x")),
    (2, "a", "b", float("nan"), [], (None, "x")),
    (2, "a", "b", float("nan"), None, (None, "x")),
    (3, "", "b", 1.0, [], (3, None)),
]
SCHEMA = "`a b` long, b string, c string, d double, e array<int>, f struct<x: int, y: string>"


def canonical(df):
    return sorted(repr(r).replace("-0.0", "0.0") for r in df.collect())


@pytest.mark.parametrize("narrow", [0, 10**6])
def test_equal_rows(spark, narrow):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    assert canonical(D.drop_copies(df, narrow)) == canonical(df.dropDuplicates())
    assert D.drop_copies(df, narrow).count() == 7
    copies = D.rows_with_copies(df, narrow=narrow)
    assert copies.columns == df.columns and copies.count() == 8
    assert D.group_counts(df, narrow=narrow).first() == (11, 4)
    assert D.group_counts(df, ["a b"], narrow).first() == (11, 7)
    assert D.rows_with_copies(df, ["a b", "b"], narrow).count() == 10
    empty = df.limit(0)
    assert D.group_counts(empty, narrow=narrow).first() == (None, 0)
    assert D.drop_copies(empty, narrow).count() == D.rows_with_copies(empty, narrow=narrow).count() == 0


def test_wrong_hits_and_clashes_cost_no_row(spark, monkeypatch):
    """With a digest of three values nearly all rows clash; whole rows decide."""
    monkeypatch.setattr(D, "digest", lambda df, columns: F.xxhash64(F.pmod(F.col("k"), F.lit(3))))
    df = spark.range(500).select((F.col("id") % 400).alias("k"), F.lit("x").alias("t"))
    assert D.candidates(df, narrow=0).where("_candidate").count() == 500
    assert D.drop_copies(df, 0).count() == 400
    assert D.rows_with_copies(df, narrow=0).count() == 200
    assert D.group_counts(df, narrow=0).first() == (500, 100)


def test_filter_holds_every_repeated_digest(spark):
    df = spark.range(60_000).select((F.col("id") % 50_000).alias("k"), F.lit("x").alias("t"))
    judged = D.candidates(df, narrow=0)
    hits = judged.where("_candidate")
    assert hits.where("k < 10000").count() == 20_000  # all rows with a copy
    assert hits.where("k >= 10000").count() < 50  # and hardly another
    assert D.FILTER_BYTES == 16 << 20


def test_only_digests_of_all_rows_are_shuffled(spark):
    df = spark.range(100).select(F.col("id"), *[F.lit("x" * 50).alias(f"t{k}") for k in range(20)])
    plan = D.digest_counts(df)._jdf.queryExecution().executedPlan().toString()
    shuffle = plan[plan.index("Exchange") :]
    assert "hashpartitioning(key" in shuffle and "t19" not in shuffle[: shuffle.index("partial_count")]
    once = D.candidates(df)
    assert "Exchange hashpartitioning" not in once._jdf.queryExecution().executedPlan().toString()


def test_types_without_a_hash(spark):
    df = spark.sql("select map('a', id % 2) as m from range(6)")
    assert not D.by_digest(df, ["m"], 0) and D.group_counts(df).first() == (6, 4)
