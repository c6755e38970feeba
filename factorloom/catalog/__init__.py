"""Registered queries and the SQL each must agree with."""

from . import conform, cross, docs, evaluation, factors, jobs, keyed, rolling, storage

_MODULES = (rolling, cross, factors, evaluation, keyed, conform, docs, storage, jobs)


def queries() -> dict:
    return {name: q for m in _MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
