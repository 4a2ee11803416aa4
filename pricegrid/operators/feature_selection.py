"""Feature selection by correlation, binned mutual information and importance."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricegrid.functions.bins import edge_count
from pricegrid.operators.correlation import wide_correlations
from pricegrid.operators.features import ColumnContractModel, FeatureVector, _Fitter, numeric_columns, quoted
from pricegrid.operators.order import quantile_values
from pricegrid.session import stage


def correlation_scores(df: DataFrame, features, target) -> dict:
    """Absolute Pearson correlation with the target, all in one pass."""
    found = wide_correlations(df, [(c, target) for c in features])
    return {c: None if r is None else abs(r) for c, r in zip(features, found)}


def mutual_information(df: DataFrame, features, target, n_bins=10) -> DataFrame:
    """Mutual information of each feature with the target over quantile bins.

    Every column is cut at its exact quantiles; the joint counts of all features
    come from one grouped pass with at most features * bins^2 groups.
    """
    columns = [*features, target]
    probs = [i / n_bins for i in range(1, n_bins)]
    inner = {c: sorted(set(v)) for c, v in quantile_values(df, columns, probs).items()}
    by = edge_count(F.col(target), inner[target])
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), edge_count(quoted(c), inner[c]).alias("bx"))
            for c in features
        ]
    )
    counts = (
        df.select(by.alias("by"), F.explode(cells).alias("x"))
        .select("by", "x.*")
        .where(F.col("bx").isNotNull() & F.col("by").isNotNull())
        .groupBy("feature", "bx", "by")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # The joint table is small: its margins are grouped sums joined back.
    x = counts.groupBy("feature", "bx").agg(F.sum("n").alias("nx"))
    y = counts.groupBy("feature", "by").agg(F.sum("n").alias("ny"))
    total = counts.groupBy("feature").agg(F.sum("n").alias("nt"))
    joint = counts.join(x, ["feature", "bx"]).join(y, ["feature", "by"]).join(total, "feature")
    term = F.col("n") / F.col("nt") * F.log(F.col("n") * F.col("nt") / (F.col("nx") * F.col("ny")))
    return joint.groupBy("feature").agg(F.round(F.sum(term), 6).alias("score"))


def importance_scores(df: DataFrame, features, target, trees=100, depth=5, seed=42) -> dict:
    """Impurity importance of a random forest."""
    rows = FeatureVector(features).transform(df).select("features", F.col(target).alias("label"))
    forest = RandomForestRegressor(
        labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=1.0
    ).fit(rows)
    return dict(zip(features, forest.featureImportances.toArray().tolist()))


def feature_pairs(df: DataFrame, features) -> dict:
    """Absolute correlation of every feature pair, all in one pass."""
    pairs = list(combinations(features, 2))
    return {pair: None if r is None else abs(r) for pair, r in zip(pairs, wide_correlations(df, pairs))}


def redundant(pairs: dict, scores: dict, cutoff=0.95) -> set:
    """Of each pair correlated above the cutoff, the feature with the lower score.

    Every pair is judged, also those with a feature that is already out. On a
    tie the first feature of the pair goes.
    """
    out = set()
    for (a, b), r in pairs.items():
        if r is not None and r > cutoff:
            out.add(b if (scores.get(a) or 0) > (scores.get(b) or 0) else a)
    return out


def choose(scores: dict, k=None, threshold=None):
    """The k best features, or those that reach the threshold, best first."""
    ranked = sorted(scores, key=lambda c: (-(scores[c] or 0), c))
    if k:
        return ranked[:k]
    return [c for c in ranked if scores[c] is not None and scores[c] >= threshold]


@dataclass
class FeatureSelector:
    """Select features by correlation, mutual_info, importance or all of them."""

    method: str = "correlation"
    k: int | None = None
    threshold: float = 0.01
    prune: bool = True
    cutoff: float = 0.95
    trees: int = 100
    selected: list = field(default_factory=list)
    scores: dict = field(default_factory=dict)

    def fit(self, df: DataFrame, target, features=None):
        features = features or [c for c in numeric_columns(df) if c != target]
        if self.method not in ("correlation", "mutual_info", "importance", "all"):
            raise ValueError(f"unknown method: {self.method}")
        chosen, self.scores = [], {}
        if self.method in ("correlation", "all"):
            found = correlation_scores(df, features, target)
            self.scores.update(found)
            chosen += choose(found, self.k, self.threshold)
        if self.method in ("mutual_info", "all"):
            found = {r.feature: r.score for r in mutual_information(df, features, target).collect()}
            middle = sorted(found.values())
            half = len(middle) // 2
            median = (middle[half] + middle[~half]) / 2
            self._score(found)
            chosen += choose(found, self.k, median)
        if self.method in ("importance", "all"):
            found = importance_scores(df, features, target, self.trees)
            self._score(found)
            chosen += choose(found, self.k, sum(found.values()) / len(found))
        self.selected = list(dict.fromkeys(chosen))
        if self.prune and len(self.selected) > 1:
            # Pairs in column order, so the outcome does not depend on the ranking.
            ordered = [c for c in features if c in self.selected]
            gone = redundant(feature_pairs(df, ordered), self.scores, self.cutoff)
            self.selected = [c for c in self.selected if c not in gone]
        return self

    def _score(self, found):
        """One scale per selector: with several methods the first one's scores count."""
        self.scores = {**found, **self.scores} if self.method == "all" else dict(found)

    def transform(self, df: DataFrame, keep=()) -> DataFrame:
        if not self.selected:
            raise ValueError("fit the selector first")
        return df.select(*[quoted(c) for c in (*keep, *self.selected) if c in df.columns])

    def report(self, spark) -> DataFrame:
        """feature, score and whether it was selected, best first."""
        rows = [(c, s, c in self.selected) for c, s in self.scores.items()]
        frame = spark.createDataFrame(rows, "feature string, score double, selected boolean")
        return frame.orderBy(F.desc("score"), "feature")


class SelectFeatures(_Fitter):
    """Selection as the last stage of a feature pipeline, saved and loaded with it.

    target and keep stay in the frame and are never scored; options are those of
    FeatureSelector. The fitted stage keeps the chosen columns in frame order.
    """

    def __init__(self, target=None, keep=(), **options):
        super().__init__()
        self._put(target=target, keep=list(dict.fromkeys([*keep, *([target] if target else [])])), options=options)

    def _fit(self, df):
        keep, target = self.opt("keep"), self.opt("target")
        features = [c for c in numeric_columns(df) if c not in keep]
        # The scores read the frame several times: a slim table spares its joins.
        slim = stage(df.select(quoted(target), *[quoted(c) for c in features]), "selection-input")
        chosen = set(FeatureSelector(**self.opt("options")).fit(slim, target, features).selected)
        return ColumnContractModel()._put(keep=keep, features=[c for c in features if c in chosen])
