"""All registered queries with their SQL counterparts."""

from tidemark.registry import operators, pipelines, streams
from tidemark.registry.base import in_utc

_MODULES = (pipelines, operators, streams)


def queries():
    """Query name to callable (spark, folder) -> frame."""
    return {name: in_utc(query) for module in _MODULES for name, (query, _) in module.QUERIES.items()}


def oracle_sql():
    """Query name to SQL over the same tables."""
    return {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql}
