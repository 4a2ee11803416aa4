"""Co-moments of many columns, and lines that the schema does not fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricegrid.operators import correlation, feature_selection, gram
from pricegrid.session import shared_dir
from pricegrid.sources.tables import read_rescued


def test_wide_correlations_equal_corr(spark):
    rng = np.random.default_rng(3)
    # Means up to 10^4 deviations from zero: beyond that corr itself is off by more than 1e-9.
    x = (rng.normal(size=(700, 24)) + 10.0 ** rng.integers(0, 5, 24)) * 10.0 ** rng.integers(-3, 6, 24)
    x[:, 5] = 7.25  # constant
    x[:, 6] = 2 * x[:, 7] - 3
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    for r in rows:
        r[8] = None if r[9] is not None else float(rng.normal())  # never known together
    rows[3][10] = float("nan")
    names = [f"c {k}" for k in range(24)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)
    found = gram.correlations(df, names)
    assert len(found) == 276 > correlation.WIDE
    # Spark's corr stops at a constant column.
    pairs = [p for p in found if "c 5" not in p and p != ("c 8", "c 9")]
    row = df.agg(*[F.corr(f"`{a}`", f"`{b}`") for a, b in pairs]).first()
    for pair, r in zip(pairs, row):
        if r is None or np.isnan(r):
            assert found[pair] is None or np.isnan(found[pair]), pair
        else:
            assert found[pair] == pytest.approx(r, abs=1e-9), pair
    assert found["c 8", "c 9"] is None and found["c 0", "c 5"] is None and np.isnan(found["c 0", "c 10"])
    matrix = {(r.a, r.b): r.r for r in correlation.correlation_matrix(df, names).collect()}
    assert len(matrix) == 24 * 24 and matrix["c 1", "c 1"] == 1.0
    assert matrix["c 2", "c 1"] == matrix["c 1", "c 2"] == round(found["c 1", "c 2"], 6)
    assert feature_selection.feature_pairs(df, names)["c 1", "c 2"] == abs(found["c 1", "c 2"])


def test_five_hundred_columns_in_one_pass(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 40))
    x = base @ rng.normal(size=(40, 500)) + rng.normal(size=(300, 500))
    names = [f"f{k}" for k in range(500)]
    df = spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(40)
    df = df.select(*[F.col("v")[k].alias(n) for k, n in enumerate(names)])
    found = gram.correlations(df, names)
    expected = np.corrcoef(x.T)
    assert len(found) == 124_750
    assert max(abs(r - expected[int(a[1:]), int(b[1:])]) for (a, b), r in found.items()) < 1e-9


def test_every_line_is_read_or_rescued(spark):
    path = shared_dir(spark, "rescued")
    schema = spark.createDataFrame([], "name string, year int, price double").schema
    lines = ["a,2001,1.5", "b,MMI,2", '"c, d",2003,x', "e,2004", "f,2005,6,7", "g,,", ",,"]
    for k, part in enumerate((lines[:4], lines[4:])):
        rows = [("name,year,price",)] + [(t,) for t in part]
        spark.createDataFrame(rows, "line string").coalesce(1).write.mode("append").text(path)
    good, rescued = read_rescued(spark, path, schema)
    assert sorted(map(tuple, good.collect()), key=str) == sorted([("a", 2001, 1.5), ("g", None, None), (None, None, None)], key=str)
    found = {r.line: r.reasons for r in rescued.collect()}
    assert found == {
        "b,MMI,2": ["year: no int: MMI"], '"c, d",2003,x': ["price: no double: x"],
        "e,2004": ["other than 3 fields"], "f,2005,6,7": ["other than 3 fields"],
    }
    assert rescued.select("file").distinct().count() == 2
    assert good.select("name").count() == 3  # what is selected changes nothing
    with pytest.raises(FileNotFoundError):
        read_rescued(spark, "/nonexistent/lines.csv")
