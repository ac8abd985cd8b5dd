"""The registered queries over the given tables, and the SQL that checks each of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessela.plans import market, sales, upkeep

_PARTS = (market, sales, upkeep)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {name: sql for part in _PARTS for name, sql in part.ORACLE_SQL.items()}
