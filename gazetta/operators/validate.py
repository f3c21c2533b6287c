"""Data checks as one row each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(name: str, frame: DataFrame, *bad: Column) -> DataFrame:
    return frame.agg(F.coalesce(*bad, F.lit(0)).cast("long").alias("bad")).select(F.lit(name).alias("check_name"), "bad")


def not_null(name: str, rows: DataFrame, column: str) -> DataFrame:
    return _row(name, rows, F.sum(F.col(column).isNull().cast("int")))


def foreign_key(name: str, rows: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    lost = rows.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)).distinct(), column, "left_anti")
    return _row(name, lost, F.count(F.lit(1)))


def unique(name: str, rows: DataFrame, *keys: str) -> DataFrame:
    return _row(name, rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), F.count(F.lit(1)))


def count_of(name: str, rows: DataFrame, test: Column) -> DataFrame:
    return _row(name, rows, F.sum(F.coalesce(test, F.lit(False)).cast("int")))


def report(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def coverage(rows: DataFrame, flag: Column, *by: str) -> DataFrame:
    """total, covered and percent of the rows of each group."""
    out = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.sum(F.coalesce(flag, F.lit(False)).cast("long")).alias("covered"))
    return out.withColumn("percent", F.round(100.0 * F.col("covered") / F.col("total"), 2))


def disagreement(name: str, rows: DataFrame, parent: DataFrame, key: str, parent_key: str, columns: dict[str, str]) -> DataFrame:
    """Rows whose copies of the parent's columns (own name -> parent's name) differ from it; nulls are no difference."""
    side = parent.select(F.col(parent_key).alias("_key"), *(F.col(v).alias(f"_{k}") for k, v in columns.items()))
    differs = reduce(Column.__or__, (F.coalesce(F.col(k) != F.col(f"_{k}"), F.lit(False)) for k in columns))
    return count_of(name, rows.join(side, F.col(key) == F.col("_key")), differs)


def below(name: str, rows: DataFrame, flag: Column, percent: float) -> DataFrame:
    """1 if fewer than that percentage of the rows have the flag, as have no rows, else 0."""
    share = F.coalesce(100.0 * F.sum(F.coalesce(flag, F.lit(False)).cast("long")) / F.count(F.lit(1)), F.lit(0.0))
    return _row(name, rows, F.when(share < percent, F.lit(1)).otherwise(F.lit(0)))


def passed(checks: DataFrame) -> DataFrame:
    """One row: whether no check found anything, and how many did."""
    return checks.agg((F.coalesce(F.sum("bad"), F.lit(0)) == 0).alias("all_pass"), F.count_if(F.col("bad") > 0).alias("failed"))


def counts_by(rows: DataFrame, *by: str) -> DataFrame:
    """Rows of each level, status or run."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def schema_difference(wanted: DataFrame, live: DataFrame) -> list[str]:
    """Columns that a stored table lacks, in order."""
    return [c for c in wanted.columns if c not in live.columns]


def recent_runs(log: DataFrame, limit: int = 100) -> DataFrame:
    """The last runs with their duration in seconds; log: operation, status, started_at, completed_at and others."""
    seconds = (F.unix_micros(F.col("completed_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    return log.withColumn("duration_seconds", seconds).orderBy(F.desc("started_at"), "operation").limit(limit)


def count_difference(old: DataFrame, new: DataFrame) -> DataFrame:
    a, b = (f.agg(F.count(F.lit(1)).alias(n)).withColumn("_", F.lit(1)) for f, n in ((old, "old_n"), (new, "new_n")))
    return a.join(b, "_").drop("_").withColumn("difference", F.col("new_n") - F.col("old_n")).withColumn("percent", F.when(F.col("old_n") > 0, F.round(100.0 * F.abs(F.col("new_n") - F.col("old_n")) / F.col("old_n"), 2)))


def sample_differences(old: DataFrame, new: DataFrame, key: str, columns: list[str], one_in: int = 100) -> DataFrame:
    """Rows of a stable sample whose columns differ."""
    chosen = old.where(F.pmod(F.xxhash64(key), F.lit(one_in)) == 0).select(key, *(F.col(c).alias(f"old_{c}") for c in columns))
    both = chosen.join(new.select(key, *columns), key, "left")
    return both.where(~reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"old_{c}")) for c in columns)))
