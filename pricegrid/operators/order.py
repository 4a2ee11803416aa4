"""Exact order statistics that no single task has to hold.

* cut_keys      the k-th smallest hash key, found by prefix histograms
* quantiles     exact interpolated quantiles, overall or per group
* count_below   per distinct value, how many rows are smaller (for ranks)

Values are counted per distinct value first, in a shuffle by value, so a value
that holds a third of all rows costs one counter per map task. The counted
values are cut into ranges; only the totals of whole ranges are added up in one
place. The same way is taken at every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricegrid.functions.predicates import any_of
from pricegrid.session import stage

# Keys fetched at the end of a search for a cut key.
FETCH = 20_000
PREFIX_DIGITS = 3
LONGEST_KEY = 64


class EqualKeys(ValueError):
    """Rows with equal keys lie on both sides of a cut."""


def cut_keys(df: DataFrame, key, ranks_of, stratum=None) -> dict:
    """Per stratum, the keys at the 1-based ranks that ranks_of(n) asks for.

    key is uniform hex text and unique. Each pass counts rows by a longer key
    prefix inside the prefixes still open (at most 16^3 counters per open
    prefix) until the rest is short enough to fetch. Rows are read but never
    moved, so a split by these keys needs no sort of the table. Rank 0 gives
    None. Equal keys on both sides of a cut raise EqualKeys. Returns
    {stratum: (n, [key, ...])}.
    """
    stratum = F.lit(0) if stratum is None else stratum
    base = df.select(stratum.alias("s"), key.alias("k")).where(F.col("s").isNotNull())
    hist = _prefix_counts(base, PREFIX_DIGITS, None)
    sizes: dict = {}
    for (s, _), n in hist.items():
        sizes[s] = sizes.get(s, 0) + n
    goals = {s: list(ranks_of(n)) for s, n in sizes.items()}
    found = {(s, r): None for s, ranks in goals.items() for r in ranks if r <= 0}
    # (stratum, rank) -> (open prefix, rank inside the prefix, rows in the prefix)
    open_ = {(s, r): ("", r, sizes[s]) for s, ranks in goals.items() for r in ranks if r > 0}
    depth, ready = PREFIX_DIGITS, {}
    while open_:
        for goal, (prefix, rank, _) in list(open_.items()):
            narrowed = _step(hist, goal[0], prefix, rank)
            if narrowed[2] <= FETCH:
                ready[goal] = narrowed
                del open_[goal]
            else:
                open_[goal] = narrowed
        if open_:
            depth += PREFIX_DIGITS
            if depth > LONGEST_KEY + PREFIX_DIGITS:
                raise EqualKeys("the key is not unique: too many equal keys at the cut")
            hist = _prefix_counts(base, depth, {(g[0], p) for g, (p, _, _) in open_.items()})
    if ready:
        wanted = {(g[0], p) for g, (p, _, _) in ready.items()}
        keys: dict = {}
        for row in base.where(_has_prefix(wanted)).collect():
            for s, p in wanted:
                if row.s == s and row.k.startswith(p):
                    keys.setdefault((s, p), []).append(row.k)
        for (s, r), (p, rank, _) in ready.items():
            run = sorted(keys[(s, p)])
            if rank < len(run) and run[rank] == run[rank - 1]:
                raise EqualKeys("the key is not unique: equal keys at the cut")
            found[(s, r)] = run[rank - 1]
    return {s: (sizes[s], [found[(s, r)] for r in ranks]) for s, ranks in goals.items()}


def _prefix_counts(base, depth, prefixes):
    rows = base if prefixes is None else base.where(_has_prefix(prefixes))
    counted = rows.groupBy("s", F.substring("k", 1, depth).alias("p")).count()
    return {(r.s, r.p): r["count"] for r in counted.collect()}


def _has_prefix(prefixes):
    """Membership in the open prefixes, as one set lookup per prefix length."""
    by_length: dict = {}
    for s, p in prefixes:
        by_length.setdefault(len(p), []).append(f"{s}|{p}")
    return any_of(
        F.concat_ws("|", F.col("s").cast("string"), F.substring("k", 1, n)).isin(names)
        for n, names in by_length.items()
    )


def _step(hist, stratum, prefix, rank):
    """Narrow a prefix by the histogram to the longer prefix that holds the rank."""
    inside = sorted(p for s, p in hist if s == stratum and p.startswith(prefix))
    for p in inside:
        n = hist[(stratum, p)]
        if rank <= n:
            return p, rank, n
        rank -= n
    raise ValueError("rank beyond the number of rows")


def placed(counts: DataFrame, group) -> DataFrame:
    """Add below (rows with a smaller value) and total to counted values.

    counts has the group columns, v and n, one row per group and value. They
    are cut into ranges of (group, v); a running sum inside each range and one
    over the range totals (one row a range and group) give the position, so no
    task holds a group, whatever its size. The ranges are written first, as
    both sums must see the same ones.
    """
    dealt = counts.repartitionByRange(*group, "v").withColumn("part", F.spark_partition_id())
    dealt = stage(dealt, "counted")
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = dealt.groupBy(*group, "part").agg(F.sum("n").alias("rows")).select(
        *group,
        "part",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("skip"),
        F.sum("rows").over(Window.partitionBy(*group)).alias("total"),
    )
    inside = Window.partitionBy(*group, "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    running = dealt.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return running.join(heads, [*group, "part"]).select(
        *group, "v", "n", (F.col("skip") + F.col("inner")).alias("below"), "total"
    )


def counted_values(df: DataFrame, columns, by=()) -> DataFrame:
    """Rows per group, column and value (as double; missing left out): by..., c, v, n."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in columns])
    )
    rows = df.select(*by, cells.alias("cell")).select(*by, "cell.*").where(F.col("v").isNotNull())
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    return rows.groupBy(*by, "c", "v").agg(F.count(F.lit(1)).alias("n"))


def quantiles(df: DataFrame, columns, probs, by=()) -> DataFrame:
    """Exact quantiles with linear interpolation, as one array per column.

    One row per group of the by columns (rows with a missing group are left
    out), or a single row without them; a group without values has none.
    """
    columns, by, probs = list(columns), list(by), [float(p) for p in probs]
    group = [*by, "c"]
    position = [(F.col("total") - 1) * F.lit(p) for p in probs]

    def holds(place):
        return (place >= F.col("below")) & (place < F.col("below") + F.col("n"))

    ends = [(F.floor(x), F.ceil(x)) for x in position]
    hit = placed(counted_values(df, columns, by), group).where(any_of(holds(e) for pair in ends for e in pair))
    picks = []
    for i, (low, high) in enumerate(ends):
        picks.append(F.max(F.when(holds(low), F.col("v"))).alias(f"lo{i}"))
        picks.append(F.max(F.when(holds(high), F.col("v"))).alias(f"hi{i}"))
        picks.append(F.max(position[i] - low).alias(f"part{i}"))
    values = F.array(
        *[F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * F.col(f"part{i}") for i in range(len(probs))]
    )
    picked = hit.groupBy(*group).agg(*picks).select(*group, values.alias("q"))
    return picked.groupBy(*by).agg(
        *[F.first(F.when(F.col("c") == c, F.col("q")), True).alias(c) for c in columns]
    )


def quantile_values(df: DataFrame, columns, probs) -> dict:
    """Overall quantiles on the driver: {column: [value, ...]}."""
    row = quantiles(df, columns, probs).first()
    return {c: list(row[c]) if row is not None and row[c] else [None] * len(probs) for c in columns}


def count_below(df: DataFrame, column) -> DataFrame:
    """Per distinct value v: its rows n and the rows with a smaller value."""
    return placed(counted_values(df, [column]), ["c"]).select("v", "n", "below")
