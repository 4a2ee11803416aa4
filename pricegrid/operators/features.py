"""Feature operators as Spark ML transformers and estimators.

Small fitted state (edges, means, categories) is kept in params. Category
tables are written to the shared folder at fit and saved as Parquet beside the
metadata, so their lineage never reaches back into the training data.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricegrid import constants as C
from pricegrid.functions import bins
from pricegrid.operators.lookup import HOT_SHARE, lookup
from pricegrid.operators.order import quantile_values
from pricegrid.session import stage


class _Settings(Params):
    """Declares JSON params by name: each stage keeps its settings in one param."""

    settings = Param(Params._dummy(), "settings", "stage settings", TypeConverters.identity)

    def opt(self, name):
        return self.getOrDefault(self.settings)[name]

    def _put(self, **values):
        current = self.getOrDefault(self.settings) if self.isSet(self.settings) else {}
        self._set(settings={**current, **values})
        return self


class _Stateless(Transformer, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    pass


class _Fitter(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    pass


class _Fitted(Model, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    pass


class _TableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls()
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        instance.table = self.sparkSession.read.parquet(f"{path}/table")
        return instance


class _TableFitted(Model, _Settings, MLReadable, MLWritable):
    """A fitted stage whose state is a table (feature, value, ...)."""

    table = None

    def write(self):
        return _TableWriter(self)

    @classmethod
    def read(cls):
        return _TableReader(cls)

    def copy(self, extra=None):
        that = super().copy(extra)
        that.table = self.table
        return that


def _present(df, columns):
    return [c for c in columns if c in df.columns]


def quoted(name):
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df):
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df):
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def category_rows(df, columns, **others):
    """One row (feature, value, others) per column and row, missing values left out."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(cells).alias("cell"), *[v.alias(k) for k, v in others.items()])
        .select("cell.*", *others)
        .where(F.col("value").isNotNull())
    )


# -- stateless ---------------------------------------------------------------


class AgeFeatures(_Stateless):
    """age_years from the two years when absent, and age_squared."""

    def __init__(self):
        super().__init__()
        self._put(age="age_years", year="year", reference="year_of_reference")

    def _transform(self, df):
        age, year, reference = self.opt("age"), self.opt("year"), self.opt("reference")
        if age not in df.columns:
            if year not in df.columns or reference not in df.columns:
                return df
            df = df.withColumn(age, F.col(reference) - F.col(year))
        return df.withColumn("age_squared", F.col(age) * F.col(age))


class RegionLookup(_Stateless):
    """region from state by a fixed table, Unknown for other states."""

    def __init__(self, mapping=None, state="state", output="region"):
        super().__init__()
        self._put(mapping=dict(mapping or C.STATE_REGION), state=state, output=output)

    def _transform(self, df):
        if self.opt("state") not in df.columns:
            return df
        return df.withColumn(self.opt("output"), region_of(F.col(self.opt("state")), self.opt("mapping")))


def region_of(state, mapping=None):
    mapping = mapping or C.STATE_REGION
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), state), F.lit("Unknown"))


class LogColumns(_Stateless):
    """log(1 + x) of the listed columns as {column}_log."""

    def __init__(self, columns=("price", "km")):
        super().__init__()
        self._put(columns=list(columns))

    def _transform(self, df):
        return df.withColumns({f"{c}_log": F.log1p(c) for c in _present(df, self.opt("columns"))})


class Depreciation(_Stateless):
    """price / (age + 1). Built from the target: never use it to predict price."""

    def _transform(self, df):
        if not {"price", "age_years"} <= set(df.columns):
            return df
        return df.withColumn("depreciation_rate", F.col("price") / (F.col("age_years") + 1))


class Interactions(_Stateless):
    """brand x year, fuel x transmission as text, and km per year."""

    def _transform(self, df):
        have, new = set(df.columns), {}
        if {"brand", "year"} <= have:
            new["brand_year_interaction"] = F.concat_ws("_", "brand", F.col("year").cast("string"))
        if {"fuel_type", "transmission"} <= have:
            new["fuel_transmission_interaction"] = F.concat_ws("_", "fuel_type", "transmission")
        if {"km", "age_years"} <= have:
            new["km_per_year"] = F.try_divide(F.col("km"), F.col("age_years") + 1)
        return df.withColumns(new) if new else df


class NumericOnly(_Stateless):
    """Drop every column that is not numeric, apart from those to keep."""

    def __init__(self, keep=()):
        super().__init__()
        self._put(keep=list(keep))

    def _transform(self, df):
        numeric, keep = set(numeric_columns(df)), self.opt("keep")
        return df.select(*[quoted(c) for c in df.columns if c in numeric or c in keep])


class FeatureVector(_Stateless):
    """Collect the numeric columns (or those listed) into one vector column."""

    def __init__(self, columns=(), output="features"):
        super().__init__()
        self._put(columns=list(columns), output=output)

    def _transform(self, df):
        values = [quoted(c).cast("double") for c in self.opt("columns")]
        return df.withColumn(self.opt("output"), array_to_vector(F.array(*values)))


# -- category tables -----------------------------------------------------------


class TargetMeanEncoder(_Fitter):
    """{c}_encoded = mean target of the category in the fitted rows.

    Unseen categories get the unweighted mean over the category means. All
    columns are fitted in one grouped pass with partial aggregation.
    """

    def __init__(self, columns=("brand", "model", "state", "city"), label="price", drop=True):
        super().__init__()
        self._put(columns=list(columns), label=label, drop=drop)

    def _fit(self, df):
        label = self.opt("label")
        if label not in df.columns:
            raise ValueError(f"target column {label} not found")
        columns = _present(df, self.opt("columns"))
        table = stage(
            category_rows(df, columns, y=F.col(label))
            .groupBy("feature", "value")
            .agg(F.avg("y").alias("mean"), F.count(F.lit(1)).alias("n")),
            "target-means",
        )
        return TargetMeanModel()._state(table, columns, self.opt("drop"))


class TargetMeanModel(_TableFitted):
    def _state(self, table, columns, drop):
        self.table = table
        facts = {
            r.feature: {"default": r.default, "categories": r.categories, "rows": r.rows}
            for r in table.groupBy("feature")
            .agg(
                F.avg("mean").alias("default"),
                F.count(F.lit(1)).alias("categories"),
                F.sum("n").alias("rows"),
            )
            .collect()
        }
        empty = {"default": 0.0, "categories": 0, "rows": 0}
        return self._put(columns=columns, drop=drop, facts={c: facts.get(c, empty) for c in columns})

    def _transform(self, df):
        for c in _present(df, self.opt("columns")):
            fact = self.opt("facts")[c]
            one = self.table.where(F.col("feature") == c)
            hot = F.col("n") >= HOT_SHARE * fact["rows"]
            df = lookup(df, one, c, {"mean": f"{c}_encoded"}, fact["categories"], hot)
            default = fact["default"] if fact["default"] is not None else 0.0
            df = df.withColumn(f"{c}_encoded", F.coalesce(f"{c}_encoded", F.lit(default)))
            df = df.drop(c) if self.opt("drop") else df
        return df


class FrequencyEncoder(_Fitter):
    """{c}_frequency = share of the fitted rows with that value; unseen 0."""

    def __init__(self, columns=("brand", "model")):
        super().__init__()
        self._put(columns=list(columns))

    def _fit(self, df):
        columns = _present(df, self.opt("columns"))
        table = stage(
            category_rows(df, columns).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")),
            "frequencies",
        )
        return FrequencyModel()._state(table, columns, df.count())


class FrequencyModel(_TableFitted):
    def _state(self, table, columns, rows):
        self.table = table
        sizes = {r.feature: r["count"] for r in table.groupBy("feature").count().collect()}
        return self._put(columns=columns, rows=rows, sizes=sizes)

    def _transform(self, df):
        rows = self.opt("rows")
        for c in _present(df, self.opt("columns")):
            one = self.table.where(F.col("feature") == c).withColumn("f", F.col("n") / F.lit(rows))
            hot = F.col("n") >= HOT_SHARE * rows
            df = lookup(df, one, c, {"f": f"{c}_frequency"}, self.opt("sizes").get(c, 0), hot)
            df = df.withColumn(f"{c}_frequency", F.coalesce(f"{c}_frequency", F.lit(0.0)))
        return df


class SizeLabeler(_Fitter):
    """city_size from the number of fitted rows per city; unseen is the last label.

    With per_batch=True the counts come from the table being transformed.
    """

    def __init__(self, column="city", output="city_size", per_batch=False):
        super().__init__()
        self._put(column=column, output=output, per_batch=per_batch)

    def _fit(self, df):
        model = SizeModel()._put(
            column=self.opt("column"), output=self.opt("output"), per_batch=self.opt("per_batch")
        )
        return model._state(df)


class SizeModel(_TableFitted):
    def _state(self, df):
        c = self.opt("column")
        if c not in df.columns:
            schema = "feature string, value string, n long"
            self.table = df.sparkSession.createDataFrame([], schema)
            return self._put(categories=0, rows=0)
        counts = category_rows(df, [c]).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        self.table = stage(counts, "sizes")
        facts = self.table.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
        return self._put(categories=facts.k, rows=facts.n or 0)

    def _transform(self, df):
        c, output = self.opt("column"), self.opt("output")
        if c not in df.columns:
            return df
        if self.opt("per_batch"):
            counts = category_rows(df, [c]).groupBy(F.col("value").alias("_v")).agg(
                F.count(F.lit(1)).alias("_n")
            )
            df = df.join(counts, F.col(c) == F.col("_v"), "left")
        else:
            hot = F.col("n") >= HOT_SHARE * self.opt("rows")
            df = lookup(df, self.table, c, {"n": "_n"}, self.opt("categories"), hot)
        label = bins.above_labels(F.col("_n"), C.CITY_SIZES)
        return df.withColumn(output, label).drop("_n", "_v")


# -- sparse indicators -----------------------------------------------------------


class SparseIndicatorEncoder(_Fitter):
    """One sparse 0/1 vector for columns of any number of values.

    Every column owns a range of the vector, in the given order, and every value a
    place in it by ascending text. The places are made in the cluster: values are
    range-partitioned, numbered inside a partition and moved by the number of values
    before it, so neither the driver nor one task holds them. Missing and unseen
    values set nothing. The vector is called `output`; with drop=True the encoded
    columns go. For columns of few values IndicatorEncoder names a column each.
    """

    def __init__(self, columns=("brand", "model", "city"), output="indicators", drop=True):
        super().__init__()
        self._put(columns=list(columns), output=output, drop=drop)

    def _fit(self, df):
        columns = _present(df, self.opt("columns"))
        model = SparseIndicatorModel()._put(output=self.opt("output"), drop=self.opt("drop"))
        return model._state(df, columns)


class SparseIndicatorModel(_TableFitted):
    def _state(self, df, columns):
        order = ["feature", "value"]
        if columns:
            cells = category_rows(df, columns)
        else:
            cells = df.sparkSession.createDataFrame([], "feature string, value string")
        counts = cells.groupBy(*order).agg(F.count(F.lit(1)).alias("n"))
        dealt = counts.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
        dealt = stage(dealt, "category-ranges")
        inside = Window.partitionBy("feature", "part").orderBy("value")
        # One row a partition and column, however many values there are.
        before = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        heads = dealt.groupBy("feature", "part").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
        heads = stage(heads.withColumn("k0", F.coalesce(F.sum("k").over(before), F.lit(0))), "category-heads")
        placed = dealt.withColumn("i", F.row_number().over(inside)).join(
            F.broadcast(heads.select("feature", "part", "k0")), ["feature", "part"]
        )
        position = (F.col("i") + F.col("k0") - 1).cast("int").alias("position")
        self.table = stage(placed.select("feature", "value", "n", position), "category-places")
        facts = {r.feature: (r.k, r.n) for r in heads.groupBy("feature").agg(F.sum("k").alias("k"), F.sum("n").alias("n")).collect()}
        ranges, start = {}, 0
        for c in columns:
            size, known = facts.get(c, (0, 0))
            ranges[c] = [start, size, known]
            start += size
        if start >= 2**31:
            raise ValueError(f"{start} values are more than a vector has places")
        return self._put(ranges=ranges, size=start)

    def names(self):
        """(position, feature, value, n): what every place of the vector stands for."""
        starts = {c: start for c, (start, _, _) in self.opt("ranges").items()}
        start = F.lit(0)
        for c, first in starts.items():
            start = F.when(F.col("feature") == c, F.lit(first)).otherwise(start)
        return self.table.select((F.col("position") + start).alias("position"), "feature", "value", "n")

    def _transform(self, df):
        columns, names = _present(df, self.opt("ranges")), []
        for i, c in enumerate(columns):
            start, size, known = self.opt("ranges")[c]
            one = self.table.where(F.col("feature") == c).select("value", "position", "n")
            text, place = F.col(c).cast("string"), f"_place{i}"
            df = lookup(df, one, text, {"position": place}, size, F.col("n") >= HOT_SHARE * known)
            df = df.withColumn(place, F.col(place) + F.lit(start))
            names.append(place)
        places = F.array(*names) if names else F.array().cast("array<int>")
        known = F.filter(places, lambda p: p.isNotNull())
        df = df.withColumn(self.opt("output"), sparse_vector(known, self.opt("size"))).drop(*names)
        return df.drop(*columns) if self.opt("drop") else df


def sparse_vector(places, size):
    """A vector of `size` with ones at the ascending places.

    A vector type is a struct of type, size, indices and values; it is filled by
    way of its JSON form, which needs no Python worker.
    """
    parts = F.struct(
        F.lit(0).alias("type"), F.lit(size).alias("size"), places.alias("indices"),
        F.transform(places, lambda _: F.lit(1.0)).alias("values"),
    )
    kind = T.StructType([T.StructField("vector", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("vector"))), kind)["vector"]


def places_of(vector):
    """The places of a sparse vector that are not zero, as an array column."""
    kind = "vector struct<indices:array<int>>"
    return F.from_json(F.to_json(F.struct(F.col(vector).alias("vector"))), kind)["vector"]["indices"]


# -- small fitted state --------------------------------------------------------


class IndicatorEncoder(_Fitter):
    """0/1 columns {c}_{value} for the sorted fitted values of each column.

    Every value becomes a column, however many there are; the values are the
    schema of the result, so they are named on the driver.
    """

    def __init__(self, columns=("fuel_type", "transmission", "condition"), drop=True):
        super().__init__()
        self._put(columns=list(columns), drop=drop)

    def _fit(self, df):
        columns = _present(df, self.opt("columns"))
        seen = category_rows(df, columns).distinct().collect()
        categories = {c: sorted(r.value for r in seen if r.feature == c) for c in columns}
        return IndicatorModel()._put(categories=categories, drop=self.opt("drop"))


class IndicatorModel(_Fitted):
    def _transform(self, df):
        for c in _present(df, self.opt("categories")):
            text = F.col(c).cast("string")
            df = df.withColumns(
                {
                    f"{c}_{v}": F.coalesce((text == v).cast("int"), F.lit(0))
                    for v in self.opt("categories")[c]
                }
            )
            df = df.drop(c) if self.opt("drop") else df
        return df


class Scaler(_Fitter):
    """Standardize (population deviation) or min-max scale columns in place.

    Without columns every numeric one is taken except those excluded and logs.
    A constant column scales by one. All columns are fitted in one aggregate.
    """

    def __init__(self, columns=(), method="standard", exclude=("price", "km")):
        super().__init__()
        self._put(columns=list(columns), method=method, exclude=list(exclude))

    def _fit(self, df):
        columns = _present(df, self.opt("columns")) or [
            c
            for c in numeric_columns(df)
            if c not in self.opt("exclude") and not c.endswith("_log")
        ]
        standard = self.opt("method") == "standard"
        center, spread = (F.avg, F.stddev_pop) if standard else (F.min, F.max)
        row = df.agg(
            *[f(c).cast("double").alias(f"{p}{i}") for i, c in enumerate(columns) for p, f in (("a", center), ("b", spread))]
        ).first()
        scales = {}
        for i, c in enumerate(columns):
            a, b = row[f"a{i}"], row[f"b{i}"]
            if a is not None:
                scales[c] = [a, (b if standard else b - a) or 1.0]
        return ScalerModel()._put(scales=scales)


class ScalerModel(_Fitted):
    def _transform(self, df):
        scales = self.opt("scales")
        return df.withColumns(
            {c: (F.col(c) - F.lit(scales[c][0])) / F.lit(scales[c][1]) for c in _present(df, scales)}
        )


class QuantileBinner(_Fitter):
    """{name}_bin = index of the right-closed quantile bin; outside the fit null."""

    def __init__(self, columns=None, n_bins=5):
        super().__init__()
        names = columns or {"price": "price_bin", "age_years": "age_bin", "km": "km_bin"}
        self._put(columns=dict(names), n_bins=n_bins)

    def _fit(self, df):
        columns = _present(df, self.opt("columns"))
        n = self.opt("n_bins")
        values = quantile_values(df, columns, [i / n for i in range(n + 1)]) if columns else {}
        edges = {c: sorted({x for x in v if x is not None}) for c, v in values.items()}
        return QuantileBinnerModel()._put(
            columns={c: self.opt("columns")[c] for c in columns}, edges=edges
        )


class QuantileBinnerModel(_Fitted):
    def _transform(self, df):
        new = {}
        for c, name in self.opt("columns").items():
            edges = self.opt("edges")[c]
            if c in df.columns and len(edges) > 1:
                new[name] = bins.right_closed(F.col(c), edges, include_lowest=True)
        return df.withColumns(new) if new else df


class AgeConditionBinner(_Fitter):
    """age_condition_interaction: one of five equal-width age words, then condition.

    The edges come from the fitted rows, or with per_batch=True from the table
    being transformed.
    """

    def __init__(self, per_batch=False):
        super().__init__()
        self._put(per_batch=per_batch)

    def _fit(self, df):
        model = AgeConditionModel()._put(per_batch=self.opt("per_batch"), edges=[])
        return model._put(edges=model.edges_of(df))


class AgeConditionModel(_Fitted):
    def edges_of(self, df):
        if not {"age_years", "condition"} <= set(df.columns):
            return []
        low, high = df.agg(F.min("age_years").cast("double"), F.max("age_years").cast("double")).first()
        return [] if low is None else bins.equal_width_edges(low, high, len(C.AGE_BIN_LABELS))

    def _transform(self, df):
        edges = self.edges_of(df) if self.opt("per_batch") else self.opt("edges")
        if not edges or not {"age_years", "condition"} <= set(df.columns):
            return df
        word = bins.right_closed(F.col("age_years"), edges, C.AGE_BIN_LABELS)
        # An age outside the fitted range has no bin and reads "nan".
        text = F.concat_ws("_", F.coalesce(word, F.lit("nan")), "condition")
        return df.withColumn("age_condition_interaction", text)


class ColumnContract(_Fitter):
    """Freeze the numeric feature columns; later frames are aligned to them."""

    def __init__(self, keep=()):
        super().__init__()
        self._put(keep=list(keep))

    def _fit(self, df):
        keep = self.opt("keep")
        features = [c for c in numeric_columns(df) if c not in keep]
        return ColumnContractModel()._put(keep=keep, features=features)


class ColumnContractModel(_Fitted):
    @property
    def feature_names(self):
        return list(self.opt("features"))

    def _transform(self, df):
        kept = [quoted(c) for c in self.opt("keep") if c in df.columns]
        return df.select(*kept, *aligned(df, self.opt("features")))


def aligned(df, features):
    """The expected feature columns in order; absent or non-numeric ones are 0."""
    numeric = set(numeric_columns(df))
    return [quoted(c) if c in numeric else F.lit(0).alias(c) for c in features]


# -- composition ---------------------------------------------------------------


def feature_stages(config, advanced=False, keep=(), mapping=None, per_batch=False):
    """All feature stages in order: age, region, advanced, numbers, categories.

    The target stays in the frame only if listed in keep. Numbers are scaled
    before categories are encoded, so encoded columns keep their own scale.
    """
    target, key = config.target, config.key
    fixed = [target, "km", *keep]
    stages = [AgeFeatures(), RegionLookup(mapping or config.state_region)]
    if advanced:
        stages += [
            FrequencyEncoder(config.frequency_encoded),
            Interactions(),
            AgeConditionBinner(per_batch),
            QuantileBinner({"age_years": "age_bin", "km": "km_bin"}),
            NumericBinsAsText(["age_bin", "km_bin"]),
            SizeLabeler(per_batch=per_batch),
        ]
    stages += [
        LogColumns(["km"]),
        Scaler(exclude=fixed),
        TargetMeanEncoder(config.target_encoded, label=target),
        IndicatorEncoder(config.one_hot),
        ColumnContract(keep=list(dict.fromkeys([key, target, *keep]))),
    ]
    return stages


class NumericBinsAsText(_Stateless):
    """Turn bin numbers into text, so that they count as categories."""

    def __init__(self, columns=()):
        super().__init__()
        self._put(columns=list(columns))

    def _transform(self, df):
        return df.withColumns({c: F.col(c).cast("string") for c in _present(df, self.opt("columns"))})


def fit_features(train, config, extra=(), **options):
    """Fit all feature stages, and extra ones after them, on the training rows."""
    return Pipeline(stages=[*feature_stages(config, **options), *extra]).fit(train)


def feature_names(model):
    """Feature columns a fitted feature model produces."""
    return next(s for s in reversed(model.stages) if isinstance(s, ColumnContractModel)).feature_names


def transform_split(df, config, split_col="split", **options):
    """Fit on the training rows only, then transform the whole frame once."""
    model = fit_features(df.where(F.col(split_col) == "train"), config, keep=(split_col,), **options)
    return model, model.transform(df)
