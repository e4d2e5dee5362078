"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netgroom.session import tune

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name; it runs in a tuned session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(tune(spark), sf_dir)

    _QUERIES[build.__name__] = run
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)
