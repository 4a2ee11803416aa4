"""Pearson and Spearman correlations, pairwise with test statistics."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.operators import gram
from pricegrid.operators.features import numeric_columns, quoted
from pricegrid.operators.lookup import HOT_SHARE, lookup
from pricegrid.operators.order import counted_values, placed
from pricegrid.session import stage


WIDE = 200  # more pairs than this are not expressions of one aggregate


def pearson_pairs(df: DataFrame, columns=None) -> DataFrame:
    """corr of every pair of columns, all in one pass."""
    columns = columns or numeric_columns(df)
    pairs = list(combinations(columns, 2))
    return _pair_rows(df, pairs, [(a, b, f"r{i}") for i, (a, b) in enumerate(pairs)])


def wide_correlations(df: DataFrame, pairs):
    """[r] of pairs of columns. Few pairs are one aggregate; many are read off the
    co-moments of their columns, whose state grows with the columns, not the pairs' expressions."""
    if len(pairs) > WIDE:
        columns = list(dict.fromkeys(c for pair in pairs for c in pair))
        found = gram.correlations(df, columns)
        return [found[a, b] if (a, b) in found else found[b, a] for a, b in pairs]
    if not pairs:
        return []
    return list(df.agg(
        *[F.corr(quoted(a).cast("double"), quoted(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    ).first())


def _pair_rows(df, pairs, shown):
    """Rows (a, b, r) of pairs; shown names the pair's place of each row, or none for 1."""
    if len(pairs) > WIDE:
        found = {f"r{i}": r for i, r in enumerate(wide_correlations(df, pairs))}
        rows = [(a, b, found[r] if r else 1.0) for a, b, r in shown]
        return df.sparkSession.createDataFrame(rows, "a string, b string, r double")
    row = df.agg(
        *[F.corr(quoted(a).cast("double"), quoted(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = [
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"), (F.col(r) if r else F.lit(1.0)).alias("r")
        )
        for a, b, r in shown
    ]
    return row.select(F.explode(F.array(*cells)).alias("p")).select("p.*")


def correlation_matrix(df: DataFrame, columns=None) -> DataFrame:
    """Full symmetric matrix as rows (a, b, r)."""
    columns = columns or numeric_columns(df)
    pairs = list(combinations(columns, 2))
    shown = [(a, b, f"r{i}") for i, (a, b) in enumerate(pairs)]
    shown += [(b, a, r) for a, b, r in shown] + [(c, c, None) for c in columns]
    return _pair_rows(df, pairs, shown).select("a", "b", F.round("r", 6).alias("r"))


def target_correlations(df: DataFrame, target, columns=None) -> DataFrame:
    """corr of each column with the target, sorted by value."""
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    if len(columns) > WIDE:
        rows = list(zip(columns, wide_correlations(df, [(c, target) for c in columns])))
        found = df.sparkSession.createDataFrame(rows, "feature string, r double")
        return found.select("feature", F.round("r", 6).alias("r")).orderBy(F.desc_nulls_last("r"), "feature")
    row = df.agg(
        *[F.corr(quoted(c).cast("double"), quoted(target).cast("double")).alias(f"r{i}") for i, c in enumerate(columns)]
    )
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("r")) for i, c in enumerate(columns)]
    found = row.select(F.explode(F.array(*cells)).alias("p")).select("p.*")
    return found.select("feature", F.round("r", 6).alias("r")).orderBy(F.desc_nulls_last("r"), "feature")


def with_ranks(df: DataFrame, columns) -> DataFrame:
    """Replace columns by their average ranks (ties share a rank).

    The values of all columns are counted in one pass over the given rows and
    their ranks joined back, so no window runs over the rows. A hot value is
    kept out of the shuffle by the lookup.
    """
    below = placed(counted_values(df, columns), ["c"])
    rank = (F.col("below") + (F.col("n") + 1) / 2).alias("rank")
    table = stage(below.select("c", F.col("v").alias("value"), "n", "total", rank), "ranks")
    sizes = {r.c: r["count"] for r in table.groupBy("c").count().collect()}
    for c in columns:
        # Adding zero turns -0.0 into 0.0, as grouping does.
        number = F.col(c).cast("double") + F.lit(0.0)
        one = table.where(F.col("c") == c)
        df = lookup(df, one, number, {"rank": "_rank"}, sizes.get(c, 0), F.col("n") >= HOT_SHARE * F.col("total"))
        df = df.withColumn(c, F.col("_rank")).drop("_rank")
    return df


def _complete_rank_pairs(df, pairs):
    """Spearman of each pair on the rows where both columns are known: (a, b, r).

    Columns without gaps are ranked once, all together; a pair with a gap is
    ranked on its own complete rows.
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    gaps = df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in columns]).first()
    full = [(a, b) for a, b in pairs if not gaps[a] and not gaps[b]]
    found = {}
    if full:
        names = list(dict.fromkeys(c for pair in full for c in pair))
        ranked = _pair_rows(with_ranks(df.select(*names), names), full, [(a, b, f"r{i}") for i, (a, b) in enumerate(full)])
        found.update({(r.a, r.b): r.r for r in ranked.collect()})
    for a, b in pairs:
        if (a, b) not in found:
            rows = df.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull())
            found[a, b] = with_ranks(rows, [a, b]).agg(F.corr(a, b)).first()[0]
    rows = [(a, b, found[a, b]) for a, b in pairs]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def spearman_pairs(df: DataFrame, columns=None) -> DataFrame:
    """Rank correlation of every pair of columns, each on its complete rows."""
    return _complete_rank_pairs(df, list(combinations(columns or numeric_columns(df), 2)))


def target_rank_correlations(df: DataFrame, target, columns=None) -> DataFrame:
    """Rank correlation of each column with the target, sorted by value."""
    columns = [c for c in (columns or numeric_columns(df)) if c != target]
    found = _complete_rank_pairs(df, [(c, target) for c in columns])
    return found.select(F.col("a").alias("feature"), F.round("r", 6).alias("r")).orderBy(F.desc_nulls_last("r"), "feature")


def correlation_test(df: DataFrame, x, y) -> DataFrame:
    """Pearson r with its t statistic and two-sided p, and Spearman rho."""
    pair = df.select(x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    r, n = pair.agg(F.corr(x, y), F.count(F.lit(1))).first()
    rho = with_ranks(pair, [x, y]).agg(F.corr(x, y)).first()[0]
    t = None if r is None or n < 3 or abs(r) >= 1 else r * math.sqrt((n - 2) / (1 - r * r))
    p = two_sided_p(t, n - 2) if t is not None else None

    def short(value, digits):
        return None if value is None else round(value, digits)

    row = (x, y, n, short(r, 6), short(t, 4), p, short(rho, 6))
    schema = "x string, y string, n long, pearson double, t double, p_value double, spearman double"
    return df.sparkSession.createDataFrame([row], schema)


def two_sided_p(t, freedom):
    """Two-sided p of a t statistic: the incomplete beta function at (freedom / 2, 1 / 2)."""
    a, b, square = freedom / 2, 0.5, t * t
    if square == 0:
        return 1.0
    x, rest = freedom / (freedom + square), square / (freedom + square)
    # log of x^a (1-x)^b / B(a, b); the gamma ratio by its series where lgamma would cancel.
    if a < 100:
        ratio = math.lgamma(a + b) - math.lgamma(a)
    else:
        ratio = 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5)
    front = ratio - math.lgamma(b) - a * math.log1p(square / freedom) + b * math.log(rest)
    if x < (a + 1) / (a + b + 2):
        return math.exp(front) * _beta_fraction(a, b, x) / a
    return 1 - math.exp(front) * _beta_fraction(b, a, rest) / b


def _beta_fraction(a, b, x):
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    value = d
    for m in range(1, 100_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / ((1 + step * d) or tiny)
            c = (1 + step / c) or tiny
            value *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return value
