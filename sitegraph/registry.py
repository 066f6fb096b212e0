"""The library's own queries and the SQL that each must match."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import building, identity, publishing, registers, relational, resolution, web

_PLANS = (resolution, relational, identity, web, registers, building, publishing)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for m in _PLANS for k, f in m.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {k: q for m in _PLANS for k, q in m.ORACLE_SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["companies_per_state"](spark, sf_dir)
