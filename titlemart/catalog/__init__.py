"""Named queries over the given tables, with their DuckDB counterparts."""

from titlemart.catalog import arrays, loading, marts, quality, reading, streaming, writing

MODULES = (marts, arrays, reading, loading, writing, quality, streaming)


def all_queries() -> dict:
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
