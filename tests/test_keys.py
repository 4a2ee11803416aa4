from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricegrid import CANONICAL
from pricegrid.operators import keys
from pricegrid.operators.cleaning import Cleaner
from pricegrid.operators.features import transform_split
from pricegrid.operators.splitting import Splitter
from pricegrid.schema import CANONICAL_SCHEMA
from pricegrid.sources.listings import dirty_listings
from pricegrid.sources.tables import combine, read_listings, sample_rows
from tests.conftest import SF


@pytest.fixture
def copies(spark):
    """300 rows: one row 100 times, one with nulls 50 times, the rest once."""
    rows = [("a", 1.0)] * 100 + [(None, None)] * 50 + [(f"r{i}", float(i)) for i in range(150)]
    return spark.createDataFrame(rows, "name string, price double").repartition(5)


def keyed(df):
    return sorted(tuple(map(str, r)) for r in keys.with_row_key(df, "k").collect())


def test_row_keys_are_unique_and_do_not_depend_on_partitions(copies, monkeypatch):
    one = keyed(copies)
    assert len(one) == 300 and len({r[-1] for r in one}) == 300
    assert Counter(r[:2] for r in one) == Counter(tuple(map(str, r)) for r in copies.collect())
    assert one == keyed(copies.coalesce(1)) == keyed(copies.repartition(9, "name"))
    monkeypatch.setattr(keys, "COPIES", 7)  # copies are then dealt out in runs
    assert one == keyed(copies)


def test_row_key_replaces_a_column_and_takes_empty_tables(spark, copies):
    again = keys.with_row_key(copies.withColumn("k", F.rand()), "k")
    assert sorted(tuple(map(str, r)) for r in again.select("name", "price", "k").collect()) == keyed(copies)
    assert keys.with_row_key(copies.limit(0), "k").count() == 0


@pytest.mark.parametrize("method", ["random", "stratified", "time"])
@pytest.mark.parametrize("key", ["absent", "name"])
def test_split_without_unique_key_is_exact(copies, method, key):
    df = copies.where("price is not null").withColumn("year_of_reference", F.lit(2020))
    df = df.withColumn("price", F.lit(1.0)) if method == "stratified" else df

    def parts(rows):
        frames = Splitter(method=method, key=key).split(rows)
        assert all(f.columns == rows.columns for f in frames)
        return [Counter(map(tuple, f.collect())) for f in frames]

    one = parts(df)
    assert [sum(c.values()) for c in one] == [175, 37, 38]
    assert one == parts(df.coalesce(1)) == parts(df.repartition(8, "name"))


def test_sample_without_unique_key_is_exact(copies):
    for key in ("absent", "name"):
        one = sample_rows(copies, 60, key)
        assert one.count() == 60 and one.columns == copies.columns
        assert Counter(map(tuple, one.collect())) == Counter(map(tuple, sample_rows(copies.coalesce(2), 60, key).collect()))
    assert sample_rows(copies, 0, "absent").count() == 0


def test_combined_frames_get_one_key(copies):
    both = combine(copies, copies.select("name"), key="listing_id")
    assert both.count() == both.select("listing_id").distinct().count() == 600


def test_listings_from_csv_are_keyed_cleaned_split_and_encoded(spark, tmp_path):
    path = str(tmp_path / "listings")
    rows = dirty_listings(spark, SF)
    rows.select(*[c for c in CANONICAL_SCHEMA.names if c in rows.columns]).write.option("header", True).csv(path)
    schema = [f for f in CANONICAL_SCHEMA if f.name in rows.columns]
    listings = read_listings(spark, path, schema=type(CANONICAL_SCHEMA)(schema), key="listing_id")
    clean = Cleaner(CANONICAL, method="zscore").clean(listings)
    labelled = Splitter(key="listing_id").fit(clean).transform(clean)
    assert {"listing_id", "split"} <= set(labelled.columns)
    assert labelled.count() == clean.count()
    if clean.count():
        _, features = transform_split(labelled, CANONICAL)
        assert features.count() == labelled.count()
