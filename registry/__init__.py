"""Registered queries and their DuckDB oracles, one entry per operator."""

from registry import aggregates, cleaning, plans, quality, streams, tables

MODULES = (cleaning, aggregates, quality, tables, streams, plans)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
