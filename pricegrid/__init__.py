"""pricegrid: quality, features, models and scoring for pricing tables on Spark.

Every operator takes and returns Spark DataFrames. Column names, limits and
rules come from a TableConfig, so the same operators run on any table.
"""

from pricegrid.schema import CANONICAL, LISTINGS, TableConfig
from pricegrid.session import build_session, shared_dir

__all__ = ["CANONICAL", "LISTINGS", "TableConfig", "build_session", "shared_dir"]
