"""Reading listing files: declared schema, several datasets, seeded samples."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.functions.predicates import nan_to_null
from pricegrid.operators.keys import ordered, with_row_key
from pricegrid.operators.order import EqualKeys, cut_keys
from pricegrid.schema import CANONICAL_SCHEMA


def read_listings(spark: SparkSession, path, schema=CANONICAL_SCHEMA, fmt="csv", header=True, key=None):
    """Scan a file or folder with a declared schema, so no inference pass runs.

    Fields that do not parse become null. A missing path raises FileNotFoundError.
    With `key`, a column of that name tells all rows apart (see with_row_key).
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        if fmt == "csv":
            df = reader.option("header", header).option("mode", "PERMISSIVE").csv(path)
        else:
            df = reader.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such dataset: {path}") from error
        raise
    df = nan_to_null(df)
    return with_row_key(df, key) if key else df


RESCUED = "_rescued"


def read_rescued(spark: SparkSession, path, schema=CANONICAL_SCHEMA, header=True, sep=","):
    """(rows, rescued) of CSV files: every line is in exactly one of the two.

    `rescued` holds each line that the schema does not fit, with its file, the line
    as it stands and the reasons: fields that do not parse (name and text) or
    another number of fields. A quoted field may hold the separator, but not a line
    break. Both tables parse all columns of a line, whatever is selected later, so
    they agree on what is malformed. Empty lines are no lines.
    """
    names = [f.name for f in schema]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    texts = ", ".join(f"`{n}` string" for n in names)
    # One column that no separator or quote cuts is the line as it stands.
    whole = {"sep": "\u0001", "quote": "", "escape": "", "header": header, "maxCharsPerColumn": -1}
    try:
        lines = spark.read.schema("line string").options(**whole).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such dataset: {path}") from error
        raise
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED, "sep": sep}
    lines = lines.select(F.col("_metadata.file_path").alias("file"), "line").where("line is not null")
    parsed = lines.withColumn("row", F.from_csv("line", f"{ddl}, {RESCUED} string", options))
    bad = F.col(f"row.{RESCUED}").isNotNull()
    rows = nan_to_null(parsed.where(~bad).select(*[F.col("row")[n].alias(n) for n in names]))
    told = parsed.where(bad).withColumn("text", F.from_csv("line", f"{texts}, {RESCUED} string", options))
    unread = [
        F.when(
            F.col("row")[n].isNull() & (F.col("text")[n] != ""),
            F.concat(F.lit(f"{n}: no {f.dataType.simpleString()}: "), F.col("text")[n]),
        )
        for n, f in zip(names, schema)
        if not isinstance(f.dataType, T.StringType)
    ]
    count = F.when(F.col("text")[RESCUED].isNotNull(), F.lit(f"other than {len(names)} fields"))
    reasons = F.filter(F.array(count, *unread), lambda r: r.isNotNull())
    return rows, told.select("file", "line", reasons.alias("reasons"))


def read_all(spark: SparkSession, paths: dict, **options) -> dict:
    """Several datasets by name."""
    return {name: read_listings(spark, path, **options) for name, path in paths.items()}


def combine(*frames: DataFrame, key=None) -> DataFrame:
    """Union by column name; columns that a frame lacks become null.

    With `key`, rows get a new key column of that name (see with_row_key).
    """
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return with_row_key(df, key) if key else df


def sample_rows(df: DataFrame, n: int, key="listing_id", seed=42) -> DataFrame:
    """The n rows with the smallest seeded key hash: the same rows on every run.

    The n-th smallest hash is looked up first, so keeping the rows is a plain
    filter and no task has to hold the sample. Without the key column, or with
    equal keys at the cut, whole rows give the order.
    """
    for by_row in [False, True] if key in df.columns else [True]:
        rows, hashed = ordered(df, key, seed, by_row)
        try:
            found = cut_keys(rows, hashed, lambda total: [min(n, total)])
            break
        except EqualKeys:
            if by_row:
                raise
    cut = next((keys[0] for _, keys in found.values()), None)
    return df.limit(0) if cut is None else rows.where(hashed <= F.lit(cut)).select(*df.columns)
