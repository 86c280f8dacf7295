"""Registry of every named query / operator: Spark callables and DuckDB oracles.

``(spark, sf_dir)`` and returns a lazy DataFrame over the driver tables (or
over the star tables Spark derives from them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitchside.plans import catalog, catalog_oracle, oracle
from pitchside.plans.pipeline import star_session

SparkQuery = Callable[[SparkSession, str], DataFrame]

_SPARK: dict[str, SparkQuery] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle_sql: str | None = None):
    def deco(fn: SparkQuery) -> SparkQuery:
        _SPARK[name] = fn
        if oracle_sql is not None:
            _ORACLE[name] = oracle_sql
        return fn
    return deco


def _catalog_query(name: str) -> SparkQuery:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star_session(spark, sf_dir)
        return catalog.QueryCatalog(spark).run(name)
    run.__name__ = f"catalog_{name}"
    return run


for _name in catalog.PLANS:
    register(_name, oracle.star_query(catalog_oracle.TEXTS[_name]))(_catalog_query(_name))


def _load_operator_modules() -> None:
    # importing registers their keys
    from pitchside.plans import operator_queries, storage_queries  # noqa: F401


def spark_queries() -> dict[str, SparkQuery]:
    _load_operator_modules()
    return dict(_SPARK)


def oracle_queries() -> dict[str, str]:
    _load_operator_modules()
    return dict(_ORACLE)
