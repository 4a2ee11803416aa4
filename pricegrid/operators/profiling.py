"""Profiles and exploratory aggregates, each one or two passes."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid import constants as C
from pricegrid.functions import bins
from pricegrid.functions.hashing import split_key
from pricegrid.functions.predicates import known, outside
from pricegrid.operators import duplicates
from pricegrid.operators.features import numeric_columns, quoted, string_columns
from pricegrid.operators.lookup import HOT_SHARE, lookup
from pricegrid.operators.order import quantile_values, quantiles
from pricegrid.operators.quality import per_column
from pricegrid.session import stage


# -- shape and description -----------------------------------------------------


def shape_info(df: DataFrame) -> DataFrame:
    """One row per column: position, type, type class and the number of rows."""

    def type_class(dtype):
        return "numeric" if isinstance(dtype, T.NumericType) else dtype.typeName()

    rows = [(i, f.name, f.dataType.simpleString(), type_class(f.dataType)) for i, f in enumerate(df.schema)]
    columns = df.sparkSession.createDataFrame(
        rows, "position int, column string, dtype string, type_class string"
    )
    return columns.crossJoin(F.broadcast(df.agg(F.count(F.lit(1)).alias("n_rows"))))


def describe_numeric(df: DataFrame, columns=None) -> DataFrame:
    """count, mean, std, min, quartiles and max per numeric column."""
    columns = columns or numeric_columns(df)
    middle = quantile_values(df, columns, [0.25, 0.5, 0.75])
    found = per_column(
        df,
        columns,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": lambda c: F.min(c).cast("double"),
            "max": lambda c: F.max(c).cast("double"),
        },
    )
    rows = [(c, *values) for c, values in middle.items()]
    quartiles = df.sparkSession.createDataFrame(rows, "column string, q25 double, q50 double, q75 double")
    return found.join(F.broadcast(quartiles), "column").select(
        "column", "count", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")]
    )


def value_counts(df: DataFrame, columns) -> DataFrame:
    """(column, value, count, percentage) of several columns in one job.

    The percentage is of the non-missing values of the column. Totals come from
    the same grouped counts and are joined by the few column names, so there is
    one pass over the rows and no window over all values.
    """
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), quoted(c).cast("string").alias("value")) for c in columns]
    )
    counts = (
        df.select(F.explode(cells).alias("x"))
        .select("x.*")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    totals = counts.groupBy("column").agg(F.sum("count").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "count", F.round(F.col("count") / F.col("total") * 100, 6).alias("percentage")
    )


def describe_text(df: DataFrame, columns=None) -> DataFrame:
    """count, unique, top (smallest of ties) and freq per text column."""
    counts = value_counts(df, columns or string_columns(df))
    top = F.min(F.struct((-F.col("count")).alias("n"), F.col("value")))
    return (
        counts.groupBy("column")
        .agg(F.sum("count").alias("count"), F.count(F.lit(1)).alias("unique"), top.alias("t"))
        .select("column", "count", "unique", F.col("t.value").alias("top"), (-F.col("t.n")).alias("freq"))
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values, their count and percentage."""
    found = per_column(df, df.columns, {"missing": lambda c: F.count_if(quoted(c).isNull())})
    return found.where("missing > 0").select(
        "column", "missing", F.round(F.col("missing") / F.col("rows") * 100, 6).alias("percentage")
    )


def distinct_counts(df: DataFrame, columns=None, approximate=False) -> DataFrame:
    """Distinct values per column; approximate=True keeps a sketch instead."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    found = per_column(df, columns or df.columns, {"distinct_values": lambda c: count(quoted(c))})
    return found.select("column", "distinct_values")


# -- duplicates ------------------------------------------------------------------


def duplicate_count(df: DataFrame, keys=None) -> DataFrame:
    """Rows beyond the first of their group, overall or by a key subset."""
    percentage = F.round(F.try_divide(F.col("duplicates"), F.col("rows")) * 100, 6)
    return duplicates.group_counts(df, keys).withColumn("percentage", percentage)


def duplicate_rows(df: DataFrame, keys=None) -> DataFrame:
    """All copies of rows that occur more than once."""
    return duplicates.rows_with_copies(df, keys)


# -- distribution of one column ----------------------------------------------------


def histogram(df: DataFrame, column, n_bins, log=False) -> DataFrame:
    """Equal-width bins; the last bin includes the maximum. log takes log(1 + x)."""
    value = F.log1p(column) if log else F.col(column).cast("double")
    rows = df.select(value.alias("x")).where(F.col("x").isNotNull())
    low, high = rows.agg(F.min("x"), F.max("x")).first()
    if low is None:
        return rows.sparkSession.createDataFrame([], "bin long, low double, high double, count long")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / n_bins
    index = F.least(F.floor((F.col("x") - F.lit(low)) / F.lit(width)), F.lit(n_bins - 1))
    return (
        rows.groupBy(index.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "bin",
            F.round(F.lit(low) + F.col("bin") * F.lit(width), 4).alias("low"),
            F.round(F.lit(low) + (F.col("bin") + 1) * F.lit(width), 4).alias("high"),
            "count",
        )
    )


def box_stats(df: DataFrame, column, by=(), log=False) -> DataFrame:
    """Quartiles, whiskers (furthest points within 1.5 IQR) and outlier points."""
    by = list(by)
    value = F.log1p(column) if log else F.col(column).cast("double")
    rows = df.select(*by, value.alias("x")).where(F.col("x").isNotNull())
    q = quantiles(rows, ["x"], [0.25, 0.5, 0.75], by).select(
        *by, F.col("x")[0].alias("q1"), F.col("x")[1].alias("median"), F.col("x")[2].alias("q3")
    )
    joined = rows.join(q, by) if by else rows.crossJoin(F.broadcast(q))
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (F.col("x") >= F.col("q1") - reach) & (F.col("x") <= F.col("q3") + reach)
    grouped = joined.groupBy(*by, "q1", "median", "q3").agg(
        F.count(F.lit(1)).alias("count"),
        F.min(F.when(inside, F.col("x"))).alias("low"),
        F.max(F.when(inside, F.col("x"))).alias("high"),
        F.count_if(~inside).alias("outlier_points"),
    )
    # A whisker never ends inside the box.
    return grouped.select(
        *by,
        "count",
        F.round("q1", 4).alias("q1"),
        F.round("median", 4).alias("median"),
        F.round("q3", 4).alias("q3"),
        F.round(F.least("low", "q1"), 4).alias("whisker_low"),
        F.round(F.greatest("high", "q3"), 4).alias("whisker_high"),
        "outlier_points",
    )


def skew_kurtosis(df: DataFrame, columns) -> DataFrame:
    """Population skewness and excess kurtosis with their verdicts."""
    found = per_column(df, columns, {"skewness": F.skewness, "kurtosis": F.kurtosis})
    size = F.abs("skewness")
    return found.select(
        "column",
        F.round("skewness", 4).alias("skewness"),
        F.round("kurtosis", 4).alias("kurtosis"),
        F.when(size > 1, "high").when(size > 0.5, "moderate").otherwise("symmetric").alias("skew_label"),
        F.when(F.col("kurtosis") > 3, "heavy tails")
        .when(F.col("kurtosis") < 3, "light tails")
        .otherwise("normal tails")
        .alias("tail_label"),
    )


def iqr_outliers(df: DataFrame, column, factor=1.5) -> DataFrame:
    """Bounds, number, share and extremes of values outside the IQR fences."""
    (q1, q3) = quantile_values(df, [column], [0.25, 0.75])[column]
    low, high = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
    hit = outside(F.col(column), F.lit(low), F.lit(high))
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(hit).alias("outliers"),
        F.min(F.when(hit, F.col(column))).alias("min_outlier"),
        F.max(F.when(hit, F.col(column))).alias("max_outlier"),
    )
    return found.select(
        *[F.round(F.lit(x), 4).alias(n) for n, x in (("q1", q1), ("q3", q3), ("lower", low), ("upper", high))],
        "outliers",
        F.round(F.col("outliers") / F.col("rows") * 100, 6).alias("percentage"),
        "min_outlier",
        "max_outlier",
    )


def z_outliers(df: DataFrame, column, threshold=3.0) -> DataFrame:
    """Values more than threshold population deviations from the mean."""
    mean, std = df.agg(F.avg(column), F.stddev_pop(column)).first()
    hit = known(F.abs((F.col(column) - F.lit(mean)) / F.lit(std)) > threshold) if std else F.lit(False)
    found = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(hit).alias("outliers"),
        F.min(F.when(hit, F.col(column))).alias("min_outlier"),
        F.max(F.when(hit, F.col(column))).alias("max_outlier"),
    )
    return found.select(
        F.round(F.lit(mean), 4).alias("mean"),
        F.round(F.lit(std), 4).alias("std"),
        "outliers",
        F.round(F.col("outliers") / F.col("rows") * 100, 6).alias("percentage"),
        "min_outlier",
        "max_outlier",
    )


def label_distribution(df: DataFrame, label) -> DataFrame:
    """Rows and share per label of an expression with few outcomes."""
    counts = df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(
        "label", "count", F.round(F.col("count") / F.col("total") * 100, 6).alias("percentage")
    )


# -- groups ------------------------------------------------------------------------


def group_stats(df: DataFrame, by, value, stats=("mean", "median", "std", "count")) -> DataFrame:
    """Statistics of value per group; rows with a missing group are left out."""
    by = [by] if isinstance(by, str) else list(by)
    for c in by:
        df = df.where(F.col(c).isNotNull())
    plain = {
        "mean": F.round(F.avg(value), 4),
        "std": F.round(F.stddev_samp(value), 4),
        "min": F.min(value),
        "max": F.max(value),
        "count": F.count(value),
    }
    grouped = df.groupBy(*by).agg(*[plain[s].alias(s) for s in stats if s in plain])
    if "median" in stats:
        middle = quantiles(df, [value], [0.5], by).select(
            *by, F.round(F.col(value)[0], 4).alias("median")
        )
        grouped = grouped.join(middle, by, "left")
    return grouped.select(*by, *stats)


def top_groups(stats: DataFrame, order, n, name, ascending=False) -> DataFrame:
    """The n groups with the largest (or smallest) statistic, ties by name."""
    by = F.col(order).asc() if ascending else F.col(order).desc()
    return stats.orderBy(by, F.col(name)).limit(n)


def most_frequent(df: DataFrame, column, n) -> DataFrame:
    """The n most frequent values with their counts, ties by value."""
    return _first(_counts(df, column), column, n)


def _counts(df, column):
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def _first(counts, column, n):
    return counts.orderBy(F.desc("count"), column).limit(n)


def only_frequent(df: DataFrame, column, n) -> DataFrame:
    """Rows whose value is among the n most frequent (n names are broadcast)."""
    names = most_frequent(df, column, n).select(column)
    return df.join(F.broadcast(names), column, "left_semi")


def first_last_change(df: DataFrame, by, value) -> DataFrame:
    """Mean of value in the first and the last period, and the change."""
    means = df.groupBy(by).agg(F.avg(value).alias("m"))
    ends = means.agg(
        F.min(by).alias("first_period"),
        F.max(by).alias("last_period"),
        F.min_by("m", by).alias("first_mean"),
        F.max_by("m", by).alias("last_mean"),
    )
    change = F.col("last_mean") - F.col("first_mean")
    return ends.select(
        "first_period",
        "last_period",
        F.round("first_mean", 4).alias("first_mean"),
        F.round("last_mean", 4).alias("last_mean"),
        F.round(change, 4).alias("change"),
        F.round(F.try_divide(change, F.col("first_mean")) * 100, 4).alias("change_pct"),
    )


def top_with_others(df: DataFrame, column, n, label="Others") -> DataFrame:
    """Counts of the n most frequent values and of all other values together."""
    counts = _counts(df, column)
    names = _first(counts, column, n).select(F.col(column).alias("_name"))
    joined = counts.join(F.broadcast(names), F.col(column) == F.col("_name"), "left")
    return joined.groupBy(F.coalesce("_name", F.lit(label)).alias(column)).agg(
        F.sum("count").alias("count")
    )


def concentration(df: DataFrame, column, tops=(5, 10, 20, 30, 100)) -> DataFrame:
    """Share of rows held by the most frequent values, for several list lengths."""
    counts = _counts(df, column)
    best = _first(counts, column, max(tops))
    # At most max(tops) rows reach this window.
    ranked = best.withColumn(
        "rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("count"), column))
    )
    sums = ranked.agg(
        *[F.sum(F.when(F.col("rank") <= n, F.col("count"))).alias(f"n{n}") for n in tops]
    )
    total = counts.agg(F.sum("count").alias("total"))
    rows = F.explode(
        F.array(*[F.struct(F.lit(n).alias("top"), F.col(f"n{n}").alias("rows")) for n in tops])
    )
    return sums.crossJoin(total).select("total", rows.alias("r")).select(
        "r.top", "r.rows", F.round(F.col("r.rows") / F.col("total") * 100, 6).alias("share_pct")
    )


def frequency_of_frequencies(df: DataFrame, column) -> DataFrame:
    """How many values occur once, twice, ..."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("frequency"))
    return counts.groupBy("frequency").agg(F.count(F.lit(1)).alias("values"))


def singletons(df: DataFrame, column) -> DataFrame:
    """Values that occur once, and their share of all values."""
    spread = frequency_of_frequencies(df, column)
    once = F.coalesce(F.sum(F.when(F.col("frequency") == 1, F.col("values"))), F.lit(0))
    return spread.agg(once.alias("singletons"), F.sum("values").alias("values")).withColumn(
        "percentage", F.round(F.try_divide(F.col("singletons"), F.col("values")) * 100, 6)
    )


def ordered_counts(df: DataFrame, column, order) -> DataFrame:
    """Counts in a given order of the values; values not listed are left out."""
    places = df.sparkSession.createDataFrame(list(enumerate(order)), f"position int, {column} string")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.join(F.broadcast(places), column).select("position", column, "count")


def binned_stats(df: DataFrame, column, value, width, low, high, min_count=0) -> DataFrame:
    """Statistics per left-closed bin [a, a + width) with the bin's middle."""
    start = bins.left_closed_start(F.col(column), width, low, high).cast("double")
    stats = group_stats(df.withColumn("bin_start", start), "bin_start", value)
    return stats.where(F.col("count") > min_count).withColumn("bin_mid", F.col("bin_start") + width / 2)


def means_histogram(df: DataFrame, by, value, n_bins, min_count=0) -> DataFrame:
    """How many groups have their mean in each of n equal bins between the least and
    the largest mean: bin, low, high, groups. Bins are right-closed, the first also
    holds its lower edge; an empty bin has no row."""
    means = df.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg(value).alias("m"), F.count(value).alias("n"))
    means = stage(means.where((F.col("n") >= max(min_count, 1)) & F.col("m").isNotNull()), "group-means")
    low, high = means.agg(F.min("m"), F.max("m")).first()
    if low is None:
        return means.select(F.lit(0).alias("bin"), "m", F.col("m").alias("high"), F.lit(0).alias("groups")).limit(0).withColumnRenamed("m", "low")
    edges = bins.equal_width_edges(low, high, n_bins)
    found = means.groupBy(bins.right_closed(F.col("m"), edges).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("groups"))
    width = (high - low) / n_bins
    return found.select(
        "bin", F.round(low + F.col("bin") * F.lit(width), 4).alias("low"),
        F.round(low + (F.col("bin") + 1) * F.lit(width), 4).alias("high"), "groups",
    )


def range_box_stats(df: DataFrame, column, value, edges, labels) -> DataFrame:
    """Box statistics of value per labelled right-closed range."""
    label = bins.right_closed(F.col(column), edges, labels)
    labelled = df.withColumn("range", label).where(F.col("range").isNotNull())
    return box_stats(labelled, value, ["range"])


def pivot_means(df: DataFrame, rows, columns, value, values, min_count=0) -> DataFrame:
    """Mean of value with one column per given value of the column key."""
    wide = df.groupBy(rows).pivot(columns, values)
    if not min_count:
        return wide.agg(F.round(F.avg(value), 4))
    return wide.agg(F.when(F.count(value) >= min_count, F.round(F.avg(value), 4)))


def sample_per_group(df: DataFrame, by, n, key="listing_id", seed=42) -> DataFrame:
    """At most n rows per group, those with the smallest seeded key hash.

    Only rows whose hash is below a limit can be among the n smallest, and the
    group's size tells where that limit lies. The limit is set with a margin
    and the rows below it are counted: should a group have too few, the limit
    is raised. So a hot group loses all but about n rows before any shuffle.
    """
    order = split_key(F.col(key), seed)
    group = F.col(by).cast("string")
    place = F.conv(F.substring(order, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    rows = df.where(F.col(by).isNotNull())
    sizes = stage(
        rows.groupBy(group.alias("value")).agg(F.count(F.lit(1)).alias("n")), "group-sizes"
    )
    facts = sizes.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows")).first()
    if not facts.groups:
        return rows
    hot, wanted = F.col("n") >= HOT_SHARE * facts.rows, n + 6 * math.sqrt(n) + 20
    while True:
        limits = sizes.withColumn("limit", F.lit(float(wanted)) / F.col("n"))
        near = lookup(rows, limits, group, {"limit": "_limit"}, facts.groups, hot)
        near = near.where(place <= F.col("_limit")).drop("_limit")
        found = near.groupBy(group.alias("value")).agg(F.count(F.lit(1)).alias("found"))
        short = sizes.join(found, "value", "left").where(
            F.coalesce("found", F.lit(0)) < F.least(F.col("n"), F.lit(n))
        )
        if short.isEmpty():
            break
        wanted *= 4
    ranked = F.row_number().over(Window.partitionBy(by).orderBy(order, key))
    return near.withColumn("_rank", ranked).where(F.col("_rank") <= n).drop("_rank")


def km_per_year(df: DataFrame) -> DataFrame:
    """Mean yearly mileage of listings older than a year."""
    rate = F.when(F.col("age_years") > 0, F.col("km") / (F.col("age_years") + 1))
    return df.agg(F.round(F.avg(rate), 4).alias("km_per_year"))


def top_numbers(df: DataFrame, column, n) -> DataFrame:
    """The n most common numbers with their share."""
    counts = _counts(df, column)
    total = counts.agg(F.sum("count").alias("total"))
    return _first(counts, column, n).crossJoin(F.broadcast(total)).select(
        column, "count", F.round(F.col("count") / F.col("total") * 100, 6).alias("percentage")
    )


AGE_RANGES = (C.AGE_RANGE_EDGES, C.AGE_RANGE_LABELS)
KM_RANGES = (C.KM_RANGE_EDGES, C.KM_RANGE_LABELS)
