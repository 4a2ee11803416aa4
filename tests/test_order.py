import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricegrid.operators import correlation, order, profiling
from pricegrid.operators.lookup import lookup


@pytest.fixture(scope="module")
def skewed(spark):
    """Values of which a third are equal, in groups of which one holds most rows."""
    rng = np.random.default_rng(7)
    x = np.where(rng.random(4000) < 0.34, 10.0, np.round(rng.normal(20, 30, 4000), 2))
    g = np.where(rng.random(4000) < 0.7, "hot", rng.choice(["a", "b", "c"], 4000))
    y = np.round(x * 0.5 + rng.normal(0, 5, 4000), 1)
    rows = [(i, str(gi), float(xi), float(yi)) for i, (gi, xi, yi) in enumerate(zip(g, x, y))]
    return spark.createDataFrame(rows, "id long, g string, x double, y double").repartition(4).cache()


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def test_quantiles_are_exact(skewed):
    pdf = skewed.toPandas()
    whole = order.quantile_values(skewed, ["x", "y"], PROBS)
    for c in ("x", "y"):
        assert whole[c] == pytest.approx(pdf[c].quantile(PROBS).tolist())
    grouped = order.quantiles(skewed, ["x"], PROBS, ["g"]).collect()
    assert len(grouped) == 4
    for r in grouped:
        assert r.x == pytest.approx(pdf[pdf.g == r.g].x.quantile(PROBS).tolist())


def test_no_plan_merges_raw_values_in_one_task(skewed):
    for df in (order.quantiles(skewed, ["x"], PROBS), profiling.group_stats(skewed, "g", "x"), order.count_below(skewed, "x")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "percentile" not in plan and "median(" not in plan


def test_missing_values_and_empty_frames(spark):
    df = spark.createDataFrame([(None,), (1.0,), (3.0,)], "x double")
    assert order.quantile_values(df, ["x"], [0.5])["x"] == [2.0]
    assert order.quantile_values(df.limit(0), ["x"], [0.5])["x"] == [None]


def test_rows_below_each_value(skewed):
    pdf = skewed.toPandas()
    found = order.count_below(skewed, "x").collect()
    counts = pdf.x.value_counts().sort_index()
    below = counts.cumsum() - counts
    assert {r.v: (r.n, r.below) for r in found} == {v: (counts[v], below[v]) for v in counts.index}


def test_cut_keys_find_ranks_at_any_depth(spark, monkeypatch):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("k"), (F.col("id") % 3).alias("s"))
    keys = sorted(r.k for r in df.collect())
    for fetch in (20000, 3):
        monkeypatch.setattr(order, "FETCH", fetch)
        found = order.cut_keys(df, F.col("k"), lambda n: [0, 1, n // 2, n])
        assert found == {0: (5000, [None, keys[0], keys[2499], keys[-1]])}
    by = order.cut_keys(df, F.col("k"), lambda n: [n // 4], stratum=F.col("s"))
    for s, (n, (key,)) in by.items():
        own = sorted(r.k for r in df.where(F.col("s") == s).collect())
        assert (n, key) == (len(own), own[n // 4 - 1])


def test_equal_keys_at_the_cut_are_refused(spark):
    df = spark.range(100).select(F.md5(F.lit("x")).alias("k"))
    with pytest.raises(ValueError):
        order.cut_keys(df, F.col("k"), lambda n: [50])


def test_spearman_equals_pandas(skewed):
    pdf = skewed.toPandas()
    expected = pdf.x.rank().corr(pdf.y.rank())
    row = correlation.spearman_pairs(skewed, ["x", "y"]).first()
    assert row.r == pytest.approx(expected)
    test = correlation.correlation_test(skewed, "x", "y").first()
    assert test.spearman == pytest.approx(expected, abs=1e-6)
    assert test.p_value < 1e-9


def test_two_sided_p_values():
    # Values of the t distribution from printed tables.
    assert correlation.two_sided_p(2.228, 10) == pytest.approx(0.05, abs=2e-4)
    assert correlation.two_sided_p(12.706, 1) == pytest.approx(0.05, abs=2e-4)
    assert correlation.two_sided_p(1.96, 10**6) == pytest.approx(0.05, abs=2e-4)
    assert correlation.two_sided_p(0, 5) == 1.0
    # Closed forms for one and two degrees.
    assert correlation.two_sided_p(3.0, 1) == pytest.approx(1 - 2 * math.atan(3.0) / math.pi, rel=1e-12)
    assert correlation.two_sided_p(3.0, 2) == pytest.approx(1 - 3.0 / math.sqrt(11), rel=1e-12)
    # No step at any number of degrees.
    for n in (199, 200, 999, 1000):
        assert 0 < correlation.two_sided_p(3.0, n) - correlation.two_sided_p(3.0, n + 1) < 1e-5
    assert correlation.two_sided_p(3.0, 10**12) == pytest.approx(0.0026997960632601866, rel=1e-4)


def test_spearman_ranks_each_pair_on_its_complete_rows(spark):
    rows = [(1.0, 5.0, 1.0), (2.0, None, 2.0), (3.0, 2.0, 3.5), (4.0, 9.0, 3.0), (None, 1.0, 8.0), (6.0, 7.0, 9.0), (7.0, None, 7.0), (8.0, 8.0, 6.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    pdf = df.toPandas()
    found = {(r.a, r.b): r.r for r in correlation.spearman_pairs(df).collect()}
    for (a, b), r in found.items():
        both = pdf[[a, b]].dropna()
        assert r == pytest.approx(both[a].rank().corr(both[b].rank()))
    assert len(found) == 3
    ranked = {r.feature: r.r for r in correlation.target_rank_correlations(df, "a").collect()}
    assert ranked["b"] == pytest.approx(found["a", "b"], abs=1e-6)


def test_rows_without_a_key_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20000).select("id", F.when(F.col("id") % 2 == 0, F.concat(F.lit("k"), F.col("id"))).alias("k"))
        table = df.where("k is not null").select(F.col("k").alias("value"), F.col("id").alias("m"))
        out = lookup(df, table, "k", {"m": "found"}, 10000, broadcast_rows=0)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * 20000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert out.where("found is null").count() == 10000 and out.where("found = id").count() == 10000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("broadcast_rows", [0, 100])
def test_lookup_with_hot_keys(skewed, spark, broadcast_rows):
    table = spark.createDataFrame([("hot", 1.0, 2800), ("a", 2.0, 400), ("b", 3.0, 1)], "value string, m double, n long")
    out = lookup(skewed, table, "g", {"m": "found"}, 3, F.col("n") >= 400, broadcast_rows)
    assert out.columns == [*skewed.columns, "found"]
    got = {(r.g, r.found) for r in out.select("g", "found").distinct().collect()}
    assert got == {("hot", 1.0), ("a", 2.0), ("b", 3.0), ("c", None)}
    assert out.count() == 4000


def test_sample_per_group_is_the_smallest_hashes(skewed):
    out = profiling.sample_per_group(skewed.withColumn("listing_id", F.col("id").cast("string")), "g", 50)
    counts = {r.g: r["count"] for r in out.groupBy("g").count().collect()}
    assert counts == dict.fromkeys(["hot", "a", "b", "c"], 50)


def test_duplicate_rows_returns_every_copy(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y"), (3, "y"), (3, "y")], "a long, b string")
    assert profiling.duplicate_rows(df).count() == 5
    assert profiling.duplicate_count(df).first().duplicates == 3
