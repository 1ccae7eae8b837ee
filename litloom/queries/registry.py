"""The registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, sf_dir) under its name, with the SQL that must give the same rows."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A small literal table, as DataFrame."""
    return spark.createDataFrame(rows, columns)


def values_sql(rows: list[tuple]) -> str:
    """The same as a VALUES list."""

    def one(x) -> str:
        if x is None:
            return "NULL"
        return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)

    return ", ".join("(" + ", ".join(one(x) for x in row) + ")" for row in rows)
