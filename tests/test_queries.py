"""Registered queries against their SQL on the small tables.

TEST_ALL_QUERIES=1 runs every query; by default one per area runs.
"""

import os

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from tools.check_queries import connect, rows_of

SAMPLE = [
    "flagship_region_metrics", "io4_save_splits", "cl0_clean_combined", "va13_summary", "dq9_quality_score",
    "ed10_box_stats_by_state", "ed19_value_counts", "ed31_target_rank_correlations", "sp5_time_split",
    "fe15_full_features", "fs2_mutual_information", "ml4_ridge_one_feature", "ev6_summary_report",
    "sg5_segment_metrics", "rg2_next_version", "sc1_request_reasons", "st2_quality_windows", "sy5_enrich",
]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("TEST_ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, tables, name):
    df = entry.queries()[name](spark, SF)
    cursor = tables.execute(entry.oracle_sql()[name])
    expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert rows_of(df.columns, df.collect()) == expected


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
