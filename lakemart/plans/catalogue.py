"""Every registered query by name."""

from __future__ import annotations

from lakemart.plans import notice_queries, retail_queries, stream_queries


def _modules():
    return (retail_queries, notice_queries, stream_queries)


def queries():
    return {name: fn for module in _modules() for name, fn in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in _modules() for name, sql in module.ORACLES.items()}
