import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pricegrid.operators import enrichment, splitting
from pricegrid.operators.features import feature_names
from pricegrid.plans import fingerprints
from pricegrid.plans.job import STAGES, BatchJob
from pricegrid.schema import LISTINGS, RAW_SCHEMA
from pricegrid.session import shared_dir
from pricegrid.sources import sinks
from pricegrid.sources.listings import dirty_listings, raw_listings
from pricegrid.sources.tables import read_listings, sample_rows
from tests.conftest import SF

GRIDS = {
    "forest": {"numTrees": [3], "maxDepth": [3]},
    "boosting": {"maxIter": [2], "maxDepth": [2]},
    "deep_boosting": {"maxIter": [2], "maxDepth": [3]},
}


def test_batch_job_runs_and_resumes(spark):
    path = shared_dir(spark, "job")
    job = BatchJob(spark, path, LISTINGS, grids=GRIDS, counts=(1, 1, 1))
    df = dirty_listings(spark, SF)
    half = job.run(df, upto="split")
    assert set(half) == set(STAGES[:5])
    # A second run reads the finished stages and goes on with the others.
    out = BatchJob(spark, path, LISTINGS, grids=GRIDS, counts=(1, 1, 1)).run(df)
    assert set(out) == set(STAGES)
    manifest = [r.stage for r in sinks.read_manifest(spark, f"{path}/manifest").orderBy("position").collect()]
    assert manifest == list(STAGES)
    assert out["clean"].count() == out["split"].count() == out["features"].count()
    evaluated = out["evaluate"].collect()
    assert len(evaluated) == 9 * 3
    entry = out["register"].first()
    assert (entry.model_name, entry.version) == ("gradient_boosting", "v1.0.0")
    test = next(r for r in evaluated if r.model == "gradient_boosting" and r.split == "test")
    assert entry.performance_metrics["rmse"] == test.rmse
    assert {r.segment_type for r in out["segments"].collect()} == {"price", "age", "brand", "region"}
    with pytest.raises(ValueError):
        job.run(df, upto="deploy")


def test_batch_job_keeps_the_selected_features(spark):
    path = shared_dir(spark, "job-selection")
    job = BatchJob(spark, path, LISTINGS, advanced=False, selection={"method": "correlation", "k": 3, "prune": False})
    rows = job.run(dirty_listings(spark, SF), upto="features")["features"]
    assert {r.features.size for r in rows.select("features").distinct().collect()} == {3}
    names = feature_names(PipelineModel.load(f"{path}/models/features"))
    assert len(names) == 3 and "split" not in names and LISTINGS.target not in names


def stages_made(spark, path, run_id):
    rows = sinks.read_manifest(spark, f"{path}/manifest").where(F.col("run_id") == run_id)
    return [r.stage for r in rows.orderBy("position").collect()]


def test_changed_settings_redo_their_stages_only(spark):
    path = shared_dir(spark, "job-settings")

    def run(run_id, frame=None, **settings):
        job = BatchJob(spark, path, LISTINGS, advanced=False, run_id=run_id, **settings)
        job.run(dirty_listings(spark, SF) if frame is None else frame, upto="split")
        return stages_made(spark, path, run_id)

    assert run("first") == list(STAGES[:5])
    assert run("same") == []
    cleaned = spark.read.parquet(f"{path}/clean").count()
    assert run("method", method="domain") == ["clean", "validate_after", "split"]
    assert spark.read.parquet(f"{path}/clean").count() != cleaned
    assert run("seed", method="domain", seed=7) == ["split"]
    plain, mapped = (BatchJob(spark, path, LISTINGS, mapping=m)._digests([dirty_listings(spark, SF)]) for m in (None, {"FRANCE": "Europe"}))
    assert [s for s in STAGES if plain[s] != mapped[s]] == ["features", "train", "evaluate", "segments", "register"]
    # Other rows redo everything.
    rows = dirty_listings(spark, SF)
    assert run("rows", rows.where("price > 2000"), method="domain", seed=7)[0] == "load"


def test_changed_code_and_broken_tables_are_redone(spark, monkeypatch):
    path = shared_dir(spark, "job-code")
    rows = spark.createDataFrame([tuple(r) for r in dirty_listings(spark, SF).limit(300).collect()], dirty_listings(spark, SF).schema)
    run = lambda name: BatchJob(spark, path, LISTINGS, run_id=name).run(rows, upto="split")
    run("first")
    run("same")
    assert stages_made(spark, path, "same") == []
    real = fingerprints.code
    monkeypatch.setattr(fingerprints, "code", lambda *m: real(*m) + ("new" if splitting in m else ""))
    run("code")
    assert stages_made(spark, path, "code") == ["split"]
    # A table whose digest is gone was not finished.
    spark.createDataFrame([(1,)], "a int").write.mode("overwrite").parquet(f"{path}/clean")
    run("broken")
    assert stages_made(spark, path, "broken") == ["clean"]


def test_frames_are_told_by_files_or_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k long, t string")
    again = df.repartition(3).orderBy(F.desc("k"))
    assert fingerprints.frame_digest(df) == fingerprints.frame_digest(again)
    assert fingerprints.frame_digest(df) != fingerprints.frame_digest(df.distinct())
    df.write.parquet(f"{tmp_path}/t")
    read = lambda: spark.read.parquet(f"{tmp_path}/t").withColumn("x", F.transform(F.array("k"), lambda v: v + 1))
    one = fingerprints.frame_digest(read())
    assert one == fingerprints.frame_digest(read()) != fingerprints.frame_digest(read().where("k = 1"))
    df.write.mode("append").parquet(f"{tmp_path}/t")
    assert one != fingerprints.frame_digest(read())


def test_splits_must_be_complete(spark):
    path = shared_dir(spark, "splits")
    df = spark.createDataFrame([(1, "train"), (2, "val")], "id long, split string")
    with pytest.raises(FileNotFoundError):
        sinks.load_splits(spark, path)
    sinks.save_splits(df, path)
    with pytest.raises(FileNotFoundError):
        sinks.load_splits(spark, path)


def test_missing_dataset(spark):
    with pytest.raises(FileNotFoundError):
        read_listings(spark, "/nonexistent/listings.csv")


def test_enrichment_is_repeatable_and_in_range(spark):
    raw = raw_listings(spark, SF)
    assert set(RAW_SCHEMA.names) <= set(raw.columns)
    one = enrichment.enrich(raw, keep_key=True)
    two = enrichment.enrich(raw.repartition(7), keep_key=True)
    assert set(map(tuple, one.collect())) == set(map(tuple, two.collect()))
    doors = {r.doors: r["count"] / one.count() for r in one.groupBy("doors").count().collect()}
    assert doors[4] == pytest.approx(0.85, abs=0.03)
    assert one.where("km < 0").count() == 0
    assert enrichment.enrich(raw, sample=50).count() == 50
    assert sample_rows(raw, 10**6).count() == raw.count()
