"""Registry of proof queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    query: Query
    sql: str | None


CASES: dict[str, Case] = {}


def case(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same."""

    def register(query: Query) -> Query:
        CASES[query.__name__] = Case(query, sql)
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
