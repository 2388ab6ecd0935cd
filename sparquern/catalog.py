"""All queries of the library's own operators, and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a query under its function's name, with the DuckDB SQL for the same rows."""

    def register(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return register
