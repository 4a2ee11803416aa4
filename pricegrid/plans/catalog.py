"""A named set of queries with their SQL equivalents."""

from __future__ import annotations


class Catalog:
    def __init__(self):
        self.queries = {}
        self.sql = {}

    def add(self, name, sql=None):
        """Decorator: register a (spark, table folder) function under a name."""

        def register(function):
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return register
