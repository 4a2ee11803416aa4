"""Profiles merged from sketches of files."""

import os

import pytest
from pyspark.sql import functions as F

from pricegrid.operators import profile_store, profiling
from pricegrid.operators.profile_store import ProfileStore, merge_rows, sketch_rows
from pricegrid.session import shared_dir

SCHEMA = "id long, word string, x double, flag boolean"


def day(spark, first, n=20_000):
    x = F.when(F.col("id") % 10 == 3, None).when(F.col("id") % 10 == 4, float("nan")).otherwise(F.sqrt("id") + 1e6)
    word = F.when(F.col("id") % 4 > 0, F.concat(F.lit("w"), (F.col("id") % 40).cast("string")))
    return spark.range(first, first + n).select("id", word.alias("word"), x.alias("x"), (F.col("id") % 2 == 0).alias("flag"))


def test_merged_equals_one_pass_and_exact(spark):
    base, store = shared_dir(spark, "days"), ProfileStore(spark, shared_dir(spark, "store"))
    for k in range(3):
        day(spark, 20_000 * k).repartition(2).write.parquet(f"{base}/day-{k}")
        assert store.add(base) == 2  # only the files of the new day
    assert store.add(base) == 0
    whole = spark.read.parquet(base + "/day-*")
    merged = {r["column"]: r for r in store.merged().collect()}
    once = {r["column"]: r for r in merge_rows(sketch_rows(whole, {})).collect()}
    exact = {r["column"]: r for r in profiling.describe_numeric(
        whole.select("id", F.when(~F.isnan("x"), F.col("x")).alias("x")), ["id", "x"]).collect()}
    distinct = {r["column"]: r.distinct_values for r in profiling.distinct_counts(
        whole.select("id", "word", "flag", F.when(~F.isnan("x"), F.col("x")).alias("x"))).collect()}
    assert merged.keys() == once.keys() == distinct.keys()
    for c, r in merged.items():
        assert (r.rows, r.missing, r["min"], r["max"]) == (once[c].rows, once[c].missing, once[c]["min"], once[c]["max"])
        assert r.distinct_values == pytest.approx(once[c].distinct_values, rel=0.02)
        assert r.distinct_values == pytest.approx(distinct[c], rel=0.03)
    assert merged["x"].missing == 12_000 and merged["word"].missing == 15_000
    for c in ("id", "x"):
        assert merged[c]["mean"] == pytest.approx(exact[c]["mean"]) and merged[c]["std"] == pytest.approx(exact[c]["std"], rel=1e-6)
        low, high = exact[c]["min"], exact[c]["max"]
        for q, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):  # both grow steadily with the rank
            near = whole.where((F.col(c) <= merged[c][q]) & ~F.isnan(c)).count() / (merged[c].rows - merged[c].missing)
            assert abs(near - share) < 0.02 and low <= merged[c][q] <= high
    assert merged["word"]["mean"] is None and merged["word"].q50 is None
    counts = {r.value: r["count"] for r in profiling.value_counts(whole, ["word"]).collect()}
    for item in merged["word"].frequent:
        assert counts[item["item"]] == item["count"]
    first = {r["column"]: r.rows for r in store.merged(F.col("file").contains("day-0")).collect()}
    assert set(first.values()) == {20_000}


def test_changed_files_replace_and_repeated_adds_count_once(spark):
    base, path = shared_dir(spark, "days"), shared_dir(spark, "store")
    day(spark, 0, 100).coalesce(1).write.json(base)
    store, other = ProfileStore(spark, path), ProfileStore(spark, path)
    both = store.new_files(base).collect()
    other.new_files = lambda _: spark.createDataFrame(both)  # a second writer that saw the same files as new
    assert store.add(base, "json", schema=SCHEMA) == 1 and other.add(base, "json", schema=SCHEMA) == 1
    assert {r.rows for r in store.merged().collect()} == {100}
    file = both[0].file.replace("file:", "", 1)
    file = "/" + file.lstrip("/")
    with open(file) as f:
        lines = f.readlines()
    with open(file, "w") as f:
        f.writelines(lines[:40])
    os.utime(file, (2e9, 2e9))
    crc = os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert ProfileStore(spark, path).add(base, "json", schema=SCHEMA) == 1
    assert {r.rows for r in store.merged().collect()} == {40}


def test_empty_missing_and_other_settings(spark):
    path = shared_dir(spark, "store")
    with pytest.raises(ValueError):
        ProfileStore(spark, path).merged()
    nothing = spark.createDataFrame([], SCHEMA)
    assert merge_rows(sketch_rows(nothing, {})).count() == 0
    blank = spark.createDataFrame([(None, None, None, None)] * 3, SCHEMA)
    rows = merge_rows(sketch_rows(blank, {"part": F.lit(None).cast("string")}), ["part"]).collect()
    assert len(rows) == 4
    for r in rows:
        assert (r.rows, r.missing, r["mean"], r.q50, r.distinct_values) == (3, 3, None, None, 0) and r.frequent == []
    base = shared_dir(spark, "days")
    day(spark, 0, 10).write.parquet(base)
    ProfileStore(spark, path).add(base)
    with pytest.raises(ValueError):
        ProfileStore(spark, path, kll_k=200).merged()
    assert profile_store.profiled(nothing) == ["id", "word", "x", "flag"]
