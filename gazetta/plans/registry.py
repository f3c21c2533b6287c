"""Where queries and their SQL are registered."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable], Query]:
    """Registers f(t), where t(name) reads a table, under its own name."""

    def add(f: Callable) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: table(spark, sf_dir, name))

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return run

    return add


def newest(df: DataFrame, column: str) -> datetime:
    return df.agg(F.max(column)).first()[0]
