"""All queries of the core by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "c3_chunks"
Query = Callable[[SparkSession, str], DataFrame]


def _modules() -> list:
    from quirelake.plans import citations, documents, figures, planted, scalars

    return [scalars, documents, citations, figures, planted]


def queries() -> dict[str, Query]:
    """Query functions by name; a name belongs to one module only."""
    found: dict[str, Query] = {}
    for module in _modules():
        clash = found.keys() & module.QUERIES.keys()
        if clash:
            raise ValueError(f"queries defined twice: {sorted(clash)}")
        found |= module.QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    """SQL by the name of the query it restates."""
    found: dict[str, str] = {}
    for module in _modules():
        found |= module.ORACLES
    return found
