"""The staged batch job: every stage ends in a table below one run folder.

A stage whose table is complete and was made by the same code from the same
inputs under the same settings is read instead of computed: its digest is kept
with the table (plans/fingerprints.py). So a run that failed continues where it
stopped, and one with another setting redoes the stages that depend on it and
all after them. Stages run in order; there is nothing to schedule.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.operators import (
    cleaning, evaluation, feature_selection, features, registry, rules, segments, splitting, training, validation,
)
from pricegrid.operators.cleaning import Cleaner
from pricegrid.operators.feature_selection import SelectFeatures
from pricegrid.operators.features import FeatureVector, feature_names, fit_features
from pricegrid.operators.registry import Registry, performance
from pricegrid.operators.splitting import Splitter
from pricegrid.plans import fingerprints
from pricegrid.schema import TableConfig
from pricegrid.sources import sinks, tables
from pricegrid.sources.tables import combine

STAGES = (
    "load", "validate_before", "clean", "validate_after", "split", "features", "train",
    "evaluate", "segments", "register",
)

# Per stage: the stages it reads, the settings it takes and the modules that compute it.
DEPENDS = {
    "load": ((), (), (tables,)),
    "validate_before": (("load",), ("config",), (validation, rules)),
    "clean": (("load",), ("config", "method"), (cleaning, rules, validation)),
    "validate_after": (("clean",), ("config",), (validation, rules)),
    "split": (("clean",), ("config", "split_method", "seed"), (splitting,)),
    "features": (("split",), ("config", "mapping", "selection"), (features, feature_selection)),
    "train": (("features",), ("grids", "counts", "advanced", "seed"), (training,)),
    "evaluate": (("features", "train"), (), (evaluation, training)),
    "segments": (("split", "features", "train"), ("config", "mapping", "main_model", "n_worst"), (segments,)),
    "register": (("evaluate", "features", "train"), ("main_model",), (registry,)),
}


@dataclass
class BatchJob:
    spark: SparkSession
    path: str
    config: TableConfig
    method: str = "iqr"
    split_method: str = "random"
    mapping: dict | None = None
    selection: dict | None = None  # options of FeatureSelector; None keeps all features
    grids: dict | None = None
    counts: tuple = (3, 10, 10)
    main_model: str = "gradient_boosting"
    advanced: bool = True
    n_worst: int = 50
    seed: int = 42
    run_id: str = "run"
    models: dict = field(default_factory=dict)

    def table(self, name) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def _done(self, name, made):
        """A written table has its _SUCCESS marker, and the digest of what made it."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        marker = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        if not marker.getFileSystem(conf).exists(marker):
            return False
        return fingerprints.read(self.spark, f"{self.path}/{name}") == made

    def _digests(self, frames):
        """The digest of every stage; a change in one changes those after it."""
        found = {}
        for stage, (inputs, settings, modules) in DEPENDS.items():
            own = [fingerprints.frame_digest(f) for f in frames] if stage == "load" else []
            own += [(name, getattr(self, name)) for name in settings]
            if stage == "load":
                own.append(self.config.key)
            found[stage] = fingerprints.digest(stage, own, fingerprints.code(*modules), [found[i] for i in inputs])
        return found

    def _stage(self, stage, make, made, partition=None) -> DataFrame:
        if not self._done(stage, made):
            writer = make().write.mode("overwrite")
            writer = writer.partitionBy(partition) if partition else writer
            writer.parquet(f"{self.path}/{stage}")
            fingerprints.write(self.spark, f"{self.path}/{stage}", made)
            sinks.append_manifest(
                self.spark, f"{self.path}/manifest", self.run_id, STAGES.index(stage), stage, "table",
                f"{self.path}/{stage}",
            )
        return self.table(stage)

    def run(self, *frames: DataFrame, upto="register") -> dict:
        """Run the stages on the union of the frames; returns the tables by stage."""
        if upto not in STAGES:
            raise ValueError(f"unknown stage: {upto}")
        last, out, key = STAGES.index(upto), {}, self.config.key
        steps = {
            "load": lambda: combine(*frames, key=None if any(key in f.columns for f in frames) else key),
            "validate_before": lambda: validation.validate(out["load"], self.config),
            "clean": lambda: Cleaner(self.config, self.method).clean(out["load"]),
            "validate_after": lambda: validation.validate(out["clean"], self.config),
            "split": lambda: self._split(out["clean"]),
            "features": lambda: self._features(out["split"]),
            "train": lambda: self._train(out["features"]),
            "evaluate": lambda: self._evaluate(out["features"]),
            "segments": lambda: self._segments(out["split"], out["features"], key),
            "register": lambda: self._register(out),
        }
        made = self._digests(frames)
        for stage in STAGES[: last + 1]:
            out[stage] = self._stage(stage, steps[stage], made[stage], "split" if stage == "split" else None)
        return out

    def _split(self, clean):
        return Splitter(method=self.split_method, key=self.config.key, seed=self.seed).fit(clean).transform(clean)

    def _features(self, labelled):
        train = labelled.where(F.col("split") == "train")
        keep = (self.config.key, self.config.target, "split")
        extra = [] if self.selection is None else [SelectFeatures(self.config.target, keep, **self.selection)]
        model = fit_features(train, self.config, extra, keep=("split",), mapping=self.mapping)
        model.write().overwrite().save(f"{self.path}/models/features")
        names = feature_names(model)
        vector = FeatureVector(names).transform(model.transform(labelled))
        return vector.select(self.config.key, "split", F.col(self.config.target).alias("label"), "features")

    def _train(self, features):
        train = features.where(F.col("split") == "train")
        found = training.train_baselines(train, seed=self.seed)
        if self.advanced:
            val = features.where(F.col("split") == "val")
            found.merge(training.train_advanced(train, val, self.grids, self.counts, self.seed))
        for name, model in found.models.items():
            PipelineModel([model]).write().overwrite().save(f"{self.path}/models/{name}")
        return found.table(self.spark)

    def _models(self):
        names = [r.model for r in self.table("train").select("model").orderBy("model").collect()]
        return {n: PipelineModel.load(f"{self.path}/models/{n}") for n in names}

    def _predicted(self, features):
        result = training.TrainingResult(models=self._models())
        return result.predict(features), result.prediction_columns

    def _evaluate(self, features):
        predicted, columns = self._predicted(features)
        return evaluation.compare_models(predicted, columns, "label", ["split"])

    def _main(self):
        names = [r.model for r in self.table("train").select("model").orderBy("model").collect()]
        return evaluation.pick_model(names, self.main_model)

    def _segments(self, labelled, features, key):
        """Segment metrics of the main model on the test rows; worst rows as a report."""
        model = PipelineModel.load(f"{self.path}/models/{self._main()}")
        test = features.where(F.col("split") == "test")
        scored = model.transform(test).select(key, F.col("label").alias("y"), F.col("prediction").alias("yhat"))
        rows = labelled.where(F.col("split") == "test").drop("split").join(scored, key)
        rows = segments.with_segments(rows, self.mapping)
        worst = segments.worst_predictions(segments.error_columns(rows), self.n_worst, key)
        sinks.write_report(worst, f"{self.path}/worst_predictions")
        return segments.segment_metrics(rows)

    def _register(self, out):
        """Save features and main model as one; test metrics come before validation."""
        name = self._main()
        rows = out["evaluate"].where(F.col("model") == name).collect()
        by_split = {r.split: {m: r[m] for m in ("rmse", "mae", "mape", "r2")} for r in rows}
        features = PipelineModel.load(f"{self.path}/models/features")
        model = PipelineModel.load(f"{self.path}/models/{name}")
        names = feature_names(features)
        whole = PipelineModel([*features.stages, FeatureVector(names), *model.stages])
        info = {f"{r.split}_size": r.n_samples for r in rows} | {"n_features": len(names)}
        store = Registry(self.spark, f"{self.path}/registry")
        store.save(
            whole, name, name, performance(by_split.get("test"), by_split.get("val")), names,
            training_info=info,
        )
        return store.entries()
