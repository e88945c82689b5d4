"""Names of queries, and what runs them in Spark and in DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodeflow.session import prepare

FLAGSHIP = "j1_nearest_asof"

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that DuckDB must answer alike."""

    def put(f: Query) -> Query:
        assert name not in _queries, name
        _queries[name] = lambda spark, sf_dir: f(prepare(spark), sf_dir)
        if sql is not None:
            _sql[name] = sql
        return f

    return put


def _load() -> None:
    import lodeflow.plans.catalog  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
