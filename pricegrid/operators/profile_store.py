"""Profiles that grow with new files: one row of sketches per file and column.

A file is read once, when it is new or has changed; its row holds counts, mean and
spread, extremes, an HLL sketch of the distinct values, a KLL sketch of the numbers
and the frequent values. Rows of any set of files merge into the profile of that set,
so a new day costs a day. Counts, means, deviations and extremes are exact; distinct
values, quantiles and frequent values are estimates of a fixed size and error. The
exact operators of profiling.py stay the default.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid.functions.predicates import nan_to_null
from pricegrid.operators.features import quoted
from pricegrid.sources.commits import CommitLog

LOG_SCHEMA = "folder string, hll_bits int, kll_k int, items int"
QUARTILES = (0.25, 0.5, 0.75)


def profiled(df: DataFrame):
    return [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.StringType, T.BooleanType))]


def sketch_rows(df: DataFrame, by, columns=None, hll_bits=14, kll_k=400, items=1000) -> DataFrame:
    """One row per group `by` (name -> column) and profiled column.

    HLL has a relative error of 1.04 / sqrt(2^hll_bits), KLL a rank error of about
    3.3 / kll_k; a column of up to `items` distinct values has exact frequent values.
    Missing values and NaN count as rows only. A table without rows gives none.
    """
    columns = columns or profiled(df)
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}
    keys = {f"by{i}": column for i, column in enumerate(by.values())}
    df = nan_to_null(df.select(*[quoted(c).alias(c) for c in columns], *[v.alias(k) for k, v in keys.items()]))
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                quoted(c).cast("string").alias("text"),
                (quoted(c) if c in numeric else F.lit(None)).cast("double").alias("number"),
            )
            for c in columns
        ]
    )
    rows = df.select(*keys, F.explode(cells).alias("cell")).select(*keys, "cell.*")
    made = rows.groupBy(*keys, "column").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("text").alias("known"),
        F.count("number").alias("numbers"),
        F.avg("number").alias("mean"),
        (F.var_pop("number") * F.count("number")).alias("squares"),
        F.min("number").alias("low"),
        F.max("number").alias("high"),
        F.hll_sketch_agg("text", hll_bits).alias("distinct"),
        F.kll_sketch_agg_double("number", kll_k).alias("quantiles"),
        F.expr(f"approx_top_k_accumulate(text, {int(items)}) filter (where text is not null)").alias("frequent"),
    )
    return made.withColumnsRenamed(dict(zip(keys, by)))


def merge_rows(sketches: DataFrame, by=(), top=5) -> DataFrame:
    """Merge sketch rows per group `by` and column into one profile row each.

    Sketches with other settings do not merge. Deviations are summed around the
    merged mean, so they lose no digits where the mean is large.
    """
    keys = [*by, "column"]
    means = sketches.groupBy(*keys).agg(F.try_divide(F.sum(F.col("mean") * F.col("numbers")), F.sum("numbers")).alias("center"))
    means = means.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    around = F.col("squares") + F.col("numbers") * F.pow(F.col("mean") - F.col("center"), 2)
    merged = sketches.join(means, same).groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("known").alias("known"),
        F.sum("numbers").alias("numbers"),
        F.first("center").alias("mean"),
        F.sum(around).alias("squares"),
        F.min("low").alias("min"),
        F.max("high").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_values"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent), {int(top)})").alias("frequent"),
    )
    points = {
        f"q{int(q * 100)}": F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(q)))
        for q in QUARTILES
    }
    return merged.select(
        *keys, "rows", (F.col("rows") - F.col("known")).alias("missing"), "mean",
        F.when(F.col("numbers") > 1, F.sqrt(F.col("squares") / (F.col("numbers") - 1))).alias("std"),
        "min", *[v.alias(k) for k, v in points.items()], "max", "distinct_values", "frequent",
    )


class ProfileStore:
    """Sketch rows of files below one folder, added once per file.

    Every `add` writes its rows to a folder of its own and then names it in a commit
    (sources/commits.py), so a failed add leaves nothing that is read, and readers see
    whole adds. A file counts with its newest version only, and once, also where two
    writers added it. The settings of the sketches are those of the first commit.
    """

    def __init__(self, spark: SparkSession, path: str, hll_bits=14, kll_k=400, items=1000):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/log")
        self.settings = {"hll_bits": hll_bits, "kll_k": kll_k, "items": items}

    def sketches(self) -> DataFrame | None:
        """The sketch rows that count: (file, modified, column, sketches); None without any."""
        commits = self.log.read(LOG_SCHEMA).collect()  # one row an add
        for c in commits:
            found = {k: c[k] for k in self.settings}
            if found != self.settings:
                raise ValueError(f"the store keeps sketches with {found}, not {self.settings}")
        if not commits:
            return None
        rows = self.spark.read.parquet(*[f"{self.path}/{c.folder}" for c in commits])
        newest = rows.groupBy("file").agg(F.max("modified").alias("_newest")).withColumnRenamed("file", "_file")
        kept = rows.join(newest, (F.col("file") == F.col("_file")) & (F.col("modified") == F.col("_newest")))
        return kept.drop("_file", "_newest").dropDuplicates(["file", "column"])

    def new_files(self, path) -> DataFrame:
        """(file, modified) below a path that the store has not seen; no file is opened."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        files = listed.select(F.col("path").alias("file"), F.col("modificationTime").alias("modified"), "length")
        files = files.where("length > 0").drop("length")
        seen = self.sketches()
        return files if seen is None else files.join(seen.select("file", "modified"), ["file", "modified"], "left_anti")

    def add(self, path, fmt="parquet", columns=None, schema=None, **options) -> int:
        """Read the new and changed files below a path; returns how many there were."""
        files = [r.file for r in self.new_files(path).select("file").collect()]
        if not files:
            return 0
        reader = self.spark.read.format(fmt).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(files)
        by = {"file": F.col("_metadata.file_path"), "modified": F.col("_metadata.file_modification_time")}
        folder = f"sketches-{uuid.uuid4().hex}"
        sketch_rows(df, by, columns or profiled(df), **self.settings).write.parquet(f"{self.path}/{folder}")
        while not self.log.commit(self.log.last() + 1, {"folder": folder, **self.settings}):
            pass  # another writer took the number; equal files count once
        return len(files)

    def merged(self, where=None, top=5) -> DataFrame:
        """The profile of all files, or of those a condition on `file` and `modified` picks."""
        rows = self.sketches()
        if rows is None:
            raise ValueError("nothing was added yet")
        return merge_rows(rows if where is None else rows.where(where), top=top)
