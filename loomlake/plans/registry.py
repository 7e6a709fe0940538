"""The registered queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with SQL of equal rows where there is some."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def t(spark: SparkSession, sf_dir: str, name: str, *columns) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return d.select(*columns) if columns else d
