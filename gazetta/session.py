"""The settings and the shared folder of all jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(**more: str) -> SparkSession:
    builder = SparkSession.builder.appName("gazetta")
    for k, v in {**SETTINGS, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def scratch(spark: SparkSession) -> str:
    """The shared folder: the cluster's spark.checkpoint.dir, or one of our own where that is unset and all is one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file:///tmp/checkpoints"
    return folder.rstrip("/")


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs meanwhile go as soon as it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read from there: lineage ends, and every executor can read it."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch(df.sparkSession))
    with passing(df.sparkSession):
        return df.select("*").checkpoint()  # planned anew: the files of df's own plan stay
