"""Weighted draws by alias cells."""

import pytest
from pyspark.sql import functions as F

from pricegrid import constants as C
from pricegrid.functions.hashing import alias_table, uniform, weighted
from pricegrid.operators import enrichment

ODDS = [C.STATE_WEIGHTS, C.COLOR_WEIGHTS, C.DOOR_WEIGHTS, *[odds for _, _, odds in C.CONDITION_BANDS],
        {"one": 3}, {"none": 0, "all": 2}, {"a": 1, "b": 1, "c": 1}]


@pytest.mark.parametrize("weights", ODDS, ids=range(len(ODDS)))
def test_cells_hold_the_weights_exactly(weights):
    cells, total = alias_table(weights), sum(weights.values())
    share = {str(word): 0.0 for word in weights}
    for word, cut, other in cells:
        share[word] += cut / len(cells)
        share[other] += (1 - cut) / len(cells)
    assert share == pytest.approx({str(w): x / total for w, x in weights.items()}, abs=1e-11)


@pytest.mark.parametrize("weights", [{}, {"a": 0}, {"a": 1, "b": -1}])
def test_weights_without_sense_are_refused(weights):
    with pytest.raises(ValueError):
        alias_table(weights)


def test_frequencies_edges_and_nulls(spark):
    n = 200_000
    drawn = spark.range(n).select(weighted(uniform(F.col("id"), "t"), C.STATE_WEIGHTS).alias("w"))
    found = {r.w: r["count"] for r in drawn.groupBy("w").count().collect()}
    total = sum(C.STATE_WEIGHTS.values())
    for word, weight in C.STATE_WEIGHTS.items():
        p = weight / total
        assert abs(found.get(word, 0) - n * p) < 5 * (n * p * (1 - p)) ** 0.5 + 1, word
    edge = spark.createDataFrame([(0.0,), (1 - 2.0**-32,), (None,)], "u double")
    ends = [r[0] for r in edge.select(weighted(F.col("u"), C.COLOR_WEIGHTS)).collect()]
    assert set(ends[:2]) <= set(C.COLOR_WEIGHTS) and ends[2] is None


def test_no_branch_per_weight_in_the_plan(spark):
    df = spark.range(3).select(F.rand(1).alias("_u_state")).select(enrichment.state().alias("s"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("WHEN") <= 1
