"""All registered queries and SQL texts, collected from the query modules."""

from importlib import import_module

MODULES = [
    "flagship",
    "table_queries",
    "cleaning_queries",
    "quality_queries",
    "profile_queries",
    "feature_queries",
    "model_queries",
    "stream_queries",
]


def _catalogs():
    return [import_module(f"pricegrid.plans.{name}").catalog for name in MODULES]


def _merge(parts):
    merged = {}
    for part in parts:
        repeated = set(part) & set(merged)
        if repeated:
            raise ValueError(f"registered twice: {sorted(repeated)}")
        merged.update(part)
    return merged


def queries():
    return _merge(c.queries for c in _catalogs())


def oracle_sql():
    return _merge(c.sql for c in _catalogs())
