"""Reproducible train / validation / test splits with exact sizes.

Fitting finds the hash keys at the split points; applying a split only compares
keys, so the table is neither sorted nor shuffled and the assignment does not
depend on partitioning, retries or row order. A table without the key column, or
with equal keys at a split point, is ordered by its whole rows (operators/keys.py),
which costs one shuffle and gives exact sizes as well.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.functions.bins import right_closed
from pricegrid.functions.predicates import any_of
from pricegrid.operators.keys import ordered
from pricegrid.operators.order import EqualKeys, count_below, cut_keys


@dataclass(frozen=True)
class SplitModel:
    """Fitted split points. cuts: {stratum: (rows, train key, validation key)}."""

    method: str
    key: str
    seed: int | None
    cuts: dict
    column: str | None = None
    edges: tuple = ()
    by_row: bool = False

    def transform(self, df: DataFrame, split_col="split") -> DataFrame:
        """Label every row train, val or test.

        The stratified split leaves out rows that fall in no bin. Hash and bin
        are columns of their own, so each is worked out once per row.
        """
        df, key = ordered(df, self.key, self.seed, self.by_row)
        new = {"_key": key}
        if self.method == "stratified":
            new["_bin"] = right_closed(F.col(self.column), list(self.edges), include_lowest=True)
        out = df.withColumns(new)
        out = out.where(F.col("_bin").isNotNull()) if self.method == "stratified" else out
        return out.withColumn(split_col, self._label()).drop(*new, "_row")

    def _label(self):
        key = F.col("_key")
        if self.method == "time":
            return self._time_label(key)
        if self.method == "random":
            _, train, val = self.cuts.get(0, (0, None, None))
            return _by_key(key, train, val)
        # A bin that the fitted rows did not have goes to test.
        chain = F.when(F.lit(False), "test")
        for stratum, (_, train, val) in sorted(self.cuts.items()):
            chain = chain.when(F.col("_bin") == stratum, _by_key(key, train, val))
        return chain.otherwise("test")

    def _time_label(self, key):
        order = F.col(self.column)
        upto = []
        for value, cut in self.cuts["points"]:
            if value is None:
                upto.append(F.lit(False))
            else:
                inside = F.lit(False) if cut is None else (order == value) & (key <= F.lit(cut))
                upto.append(F.coalesce((order < value) | inside, F.lit(False)))
        return F.when(upto[0], "train").when(upto[1], "val").otherwise("test")


def _by_key(key, train, val):
    """None as a cut means that no row falls below it."""
    in_train = F.lit(False) if train is None else key <= F.lit(train)
    in_val = F.lit(False) if val is None else key <= F.lit(val)
    return F.when(in_train, "train").when(in_val, "val").otherwise("test")


class Splitter:
    """Random, stratified (by target range) or time-ordered split.

    Sizes are fractions that sum to one. Train and validation get
    floor(n * fraction) rows, the rest is test; the stratified split does so
    per target bin. Falls back to the random split when its column is absent.
    """

    def __init__(
        self, train=0.7, val=0.15, test=0.15, method="random", key="listing_id", seed=42,
        target="price", edges=None, order="year_of_reference",
    ):
        if abs(train + val + test - 1.0) > 1e-6:
            raise ValueError(f"split sizes {train}, {val}, {test} must sum to 1")
        if method not in ("random", "stratified", "time"):
            raise ValueError(f"unknown split method: {method}")
        self.train, self.val, self.test = train, val, test
        self.method, self.key, self.seed = method, key, seed
        self.target, self.order = target, order
        self.edges = tuple(edges or C.SPLIT_PRICE_EDGES)

    def _ranks(self, n):
        first = math.floor(n * self.train)
        return [first, first + math.floor(n * self.val)]

    def fit(self, df: DataFrame) -> SplitModel:
        """Whole rows order the table only if it has no key, or equal ones at a split point."""
        if self.key in df.columns:
            try:
                return self._fit(df, False)
            except EqualKeys:
                pass
        return self._fit(df, True)

    def _fit(self, df, by_row):
        df, key = ordered(df, self.key, self.seed, by_row)
        if self.method == "stratified" and self.target in df.columns:
            return self._fit_stratified(df, key, by_row)
        if self.method == "time" and self.order in df.columns:
            return self._fit_time(df, key, by_row)
        found = cut_keys(df, key, self._ranks)
        cuts = {s: (n, *keys) for s, (n, keys) in found.items()}
        return SplitModel("random", self.key, self.seed, cuts, by_row=by_row)

    def _fit_stratified(self, df, key, by_row):
        bins = right_closed(F.col(self.target), list(self.edges), include_lowest=True)
        found = cut_keys(df, key, self._ranks, stratum=bins)
        cuts = {s: (n, *keys) for s, (n, keys) in found.items()}
        return SplitModel("stratified", self.key, self.seed, cuts, self.target, self.edges, by_row)

    def _fit_time(self, df, key, by_row):
        """Rows are ordered by time and, within the same time, by key hash."""
        rows = df.where(F.col(self.order).isNotNull())
        n = df.count()
        ranks = self._ranks(n)
        steps = count_below(rows, self.order)
        # The time value that holds a split point, and how many of its rows go below.
        hits = steps.where(
            any_of((F.col("below") < r) & (F.col("below") + F.col("n") >= r) for r in ranks)
        ).collect()
        points = []
        for rank in ranks:
            hit = next((h for h in hits if h.below < rank <= h.below + h.n), None)
            points.append((None, 0) if hit is None else (hit.v, rank - hit.below))
        inner = {}
        for value, rank in points:
            if value is not None:
                inner.setdefault(value, []).append(rank)
        found = (
            cut_keys_at(rows, F.col(self.order).cast("double"), key, inner)
            if inner
            else {}
        )
        labelled = [(v, found.get((v, r))) for v, r in points]
        return SplitModel("time", self.key, self.seed, {"points": labelled}, self.order, by_row=by_row)

    def split(self, df: DataFrame):
        """Fit and return the (train, val, test) frames."""
        labelled = self.fit(df).transform(df)
        return tuple(
            labelled.where(F.col("split") == name).drop("split") for name in ("train", "val", "test")
        )


def cut_keys_at(df, column, key, ranks_by_value):
    """Cut keys inside the rows of a few given column values."""
    result = {}
    for value, ranks in ranks_by_value.items():
        found = cut_keys(df.where(column == F.lit(value)), key, lambda _n, r=ranks: r)
        for _, keys in found.values():
            result.update({(value, r): k for r, k in zip(ranks, keys)})
    return result


def split_sizes(labelled: DataFrame, split_col="split", order=None) -> DataFrame:
    """Rows per split and, for a time split, the range of the order column."""
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    if order:
        aggregates += [F.min(order).alias("first"), F.max(order).alias("last")]
    return labelled.groupBy(split_col).agg(*aggregates)
