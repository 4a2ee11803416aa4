"""Writing and reading split tables, reports and the run manifest."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLITS = ("train", "val", "test")

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("stage", T.StringType()),
        T.StructField("artifact", T.StringType()),
        T.StructField("path", T.StringType()),
    ]
)


def save_splits(df: DataFrame, path: str, split_col="split", fmt="parquet", mode="overwrite"):
    """One write of all splits; each split is a partition folder."""
    writer = df.write.mode(mode).partitionBy(split_col)
    writer = writer.option("header", True) if fmt == "csv" else writer
    writer.format(fmt).save(path)
    return path


def load_splits(spark: SparkSession, path: str, schema=None, fmt="parquet", split_col="split"):
    """Read the splits back; raises when one of the three is absent."""
    reader = spark.read.format(fmt)
    reader = reader.schema(schema) if schema is not None else reader
    reader = reader.option("header", True) if fmt == "csv" else reader
    try:
        df = reader.load(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no split table at {path}") from error
    wanted = df.where(F.col(split_col).isin(list(SPLITS)))
    found = {row[0] for row in wanted.select(split_col).distinct().collect()}
    missing = [name for name in SPLITS if name not in found]
    if missing:
        raise FileNotFoundError(f"splits missing at {path}: {', '.join(missing)}")
    return wanted


def write_report(df: DataFrame, path: str, fmt="csv", mode="overwrite"):
    """A report table as CSV with header, or as Parquet."""
    writer = df.write.mode(mode)
    writer = writer.option("header", True) if fmt == "csv" else writer
    writer.format(fmt).save(path)
    return path


def append_manifest(spark: SparkSession, path, run_id, position, stage, artifact, artifact_path):
    """Add one row about a finished stage."""
    row = [(run_id, position, stage, artifact, artifact_path)]
    spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)
