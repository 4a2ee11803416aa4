"""Versioned models in a registry table below one folder.

Each saved version has a model folder of its own and one immutable metadata row;
a production choice is a row of its own, and the latest choice per name counts.
Every change is a commit with the next free number (sources/commits.py). A writer
decides on what it has read up to some number and then tries the next one; when
another writer was faster, it reads again and decides anew, so two jobs never get
one version. A failed write leaves at most an unused model folder.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricegrid.operators.evaluation import metrics
from pricegrid.operators.features import feature_names
from pricegrid.sources.commits import CommitLog

ENTRY_SCHEMA = (
    "model_name string, model_type string, version string, path string, training_date string, "
    "performance_metrics map<string,double>, feature_list array<string>, "
    "hyperparameters map<string,string>, training_info map<string,string>"
)
CHOICE_SCHEMA = "model_name string, version string, chosen_at string"
LOG_SCHEMA = f"action string, table string, chosen_at string, {ENTRY_SCHEMA}"
FIRST_VERSION = "v1.0.0"


def version_key(version="version"):
    """Sortable (major, minor, patch) of a version text like v1.0.12."""
    parts = F.split(F.regexp_replace(version, "^v", ""), r"\.")
    return F.struct(*[parts[i].cast("int").alias(n) for i, n in enumerate(("major", "minor", "patch"))])


def latest_versions(entries: DataFrame) -> DataFrame:
    """The highest version per model name, compared as numbers."""
    return entries.groupBy("model_name").agg(F.max_by("version", version_key()).alias("latest_version"))


def next_versions(entries: DataFrame) -> DataFrame:
    """The version a further save would get: latest patch + 1."""
    top = entries.groupBy("model_name").agg(F.max(version_key()).alias("v"))
    parts = [F.lit("v"), F.col("v.major"), F.lit("."), F.col("v.minor"), F.lit("."), F.col("v.patch") + 1]
    return top.select("model_name", F.concat(*[p.cast("string") for p in parts]).alias("next_version"))


def with_production(entries: DataFrame, choices: DataFrame) -> DataFrame:
    """Add is_production from the latest choice per name: at most one version each."""
    latest = choices.groupBy(F.col("model_name").alias("_name")).agg(
        F.max_by("version", "chosen_at").alias("_version")
    )
    joined = entries.join(latest, F.col("model_name") == F.col("_name"), "left")
    flag = F.coalesce(F.col("version") == F.col("_version"), F.lit(False))
    return joined.withColumn("is_production", flag).drop("_name", "_version")


def performance(test=None, validation=None):
    """Metrics to record: test metrics where known, else validation metrics."""
    return {**(validation or {}), **(test or {})}


def now():
    return datetime.now(timezone.utc).isoformat()


class Registry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")

    def _rows(self, upto, one, many, schema):
        """Rows of one kind: those in commits, and the tables that commits name."""
        log = self.log.read(LOG_SCHEMA, upto)
        names = [c.split()[0] for c in schema.split(", ")]
        rows = log.where(F.col("action") == one).select(*names, "number")
        for commit in log.where(F.col("action") == many).select("table", "number").collect():
            table = self.spark.read.schema(schema).parquet(commit.table)
            rows = rows.unionByName(table.withColumn("number", F.lit(commit.number)))
        return rows

    def entries(self, upto=None) -> DataFrame:
        """All versions with is_production, as of a commit (the last by default)."""
        upto = self.log.last() if upto is None else upto
        choices = self._rows(upto, "choose", "choose_many", CHOICE_SCHEMA)
        choices = choices.withColumn("chosen_at", F.struct("number", "chosen_at"))
        return with_production(self._rows(upto, "save", "save_many", ENTRY_SCHEMA).drop("number"), choices)

    def versions(self, model_name, upto=None):
        rows = self.entries(upto).where(F.col("model_name") == model_name)
        return [r.version for r in rows.orderBy(version_key()).select("version").collect()]

    def next_version(self, model_name, upto=None):
        found = next_versions(self.entries(upto).where(F.col("model_name") == model_name)).first()
        return found.next_version if found else FIRST_VERSION

    def _commit(self, decide):
        """Commit the row that decide(number read) returns, again until no other writer is faster."""
        while True:
            last = self.log.last()
            row = decide(last)
            if self.log.commit(last + 1, row):
                return row

    def save(
        self, model: PipelineModel, model_name, model_type, performance_metrics, features=None,
        hyperparameters=None, training_info=None, version=None,
    ):
        """Save the model (features and estimator as one) and register it.

        An existing version is refused, and a model folder is never overwritten.
        """

        def number(last):
            if version is None:
                return self.next_version(model_name, last)
            if version in self.versions(model_name, last):
                raise ValueError(f"{model_name} {version} is already registered")
            return version

        number(self.log.last())  # refuse before the model is written
        path = f"{self.path}/models/{model_name}/{uuid.uuid4().hex}"
        model.write().save(path)
        row = {
            "action": "save", "model_name": model_name, "model_type": model_type, "path": path, "training_date": now(),
            "performance_metrics": {k: float(v) for k, v in performance_metrics.items() if v is not None},
            "feature_list": feature_names(model) if features is None else list(features),
            "hyperparameters": {k: json.dumps(v) for k, v in (hyperparameters or {}).items()},
            "training_info": {k: str(v) for k, v in (training_info or {}).items()},
        }
        return self._commit(lambda last: row | {"version": number(last)})["version"]

    def _write(self, rows, schema):
        """Rows of a bulk change as a table of the registry, nulls for absent columns."""
        fields = [c.split(" ", 1) for c in schema.split(", ")]
        table = f"{self.path}/tables/{uuid.uuid4().hex}"
        rows.select(*[
            (F.col(n) if n in rows.columns else F.lit(None)).cast(kind).alias(n) for n, kind in fields
        ]).write.parquet(table)
        return table

    def save_all(self, entries: DataFrame):
        """Register many versions in one commit; refused if one of them exists."""
        table = self._write(entries.withColumn("training_date", F.lit(now())), ENTRY_SCHEMA)
        new = self.spark.read.parquet(table).select("model_name", "version")

        def decide(last):
            known = self.entries(last).select("model_name", "version")
            twice = new.groupBy("model_name", "version").count().where("count > 1").drop("count")
            taken = new.join(known, ["model_name", "version"], "left_semi").unionByName(twice).first()
            if taken is not None:
                raise ValueError(f"{taken.model_name} {taken.version} is already registered")
            return {"action": "save_many", "table": table}

        self._commit(decide)

    def choose_all(self, choices: DataFrame):
        """Put many versions into production in one commit; unknown ones are refused."""
        table = self._write(choices.select("model_name", "version").withColumn("chosen_at", F.lit(now())), CHOICE_SCHEMA)

        def decide(last):
            known = self.entries(last).select("model_name", "version")
            absent = self.spark.read.parquet(table).join(known, ["model_name", "version"], "left_anti").first()
            if absent is not None:
                raise ValueError(f"no model {absent.model_name} {absent.version} in the registry")
            return {"action": "choose_many", "table": table}

        self._commit(decide)

    def info(self, model_name, version=None):
        """The metadata row of a version, or of the latest one."""
        rows = self.entries().where(F.col("model_name") == model_name)
        if version is not None:
            rows = rows.where(F.col("version") == version)
        found = rows.orderBy(version_key().desc()).first()
        if found is None:
            raise ValueError(f"no model {model_name} {version or ''} in the registry".rstrip())
        return found

    def load(self, model_name, version=None):
        """(model, metadata) of a version, or of the latest one."""
        entry = self.info(model_name, version)
        try:
            return PipelineModel.load(entry.path), entry
        except Exception as error:
            raise FileNotFoundError(f"no saved model at {entry.path}") from error

    def set_production(self, model_name, version):
        self.info(model_name, version)
        self._commit(lambda last: {"action": "choose", "model_name": model_name, "version": version, "chosen_at": now()})

    def production(self, model_name):
        row = self.entries().where((F.col("model_name") == model_name) & F.col("is_production")).first()
        return row.version if row else None


def check_model(model, entry, df: DataFrame, target="price", prediction="prediction") -> DataFrame:
    """Whether a loaded model predicts the rows of df, its feature count and metrics."""
    errors = []
    if not hasattr(model, "transform"):
        errors.append("the model cannot transform")
    expected, found = len(entry.feature_list), len(feature_names(model)) if not errors else 0
    if not errors and expected != found:
        errors.append(f"feature count: expected {expected}, got {found}")
    predicted = model.transform(df).select(F.col(target).alias("y"), F.col(prediction).alias("yhat"))
    scored = metrics(predicted)
    missing = predicted.agg(F.count_if(F.col("yhat").isNull()).alias("without_prediction"))
    return scored.crossJoin(missing).select(
        F.lit(entry.model_name).alias("model_name"),
        F.lit(entry.version).alias("version"),
        F.lit(expected).alias("feature_count"),
        (F.lit(not errors) & (F.col("without_prediction") == 0)).alias("validation_passed"),
        F.lit("; ".join(errors)).alias("errors"),
        "n_samples", "rmse", "mae", "mape", "r2",
    )
