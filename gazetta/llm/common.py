"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.session import cut, passing, scratch

#: At most so many keys count as hot. Any other key then holds at most 1/257 of the rows.
HOT_KEYS = 256
#: Below so many rows a key is never hot.
HOT_FLOOR = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def dealt(df: DataFrame, parts: int, key: str) -> DataFrame:
    """df dealt out by key to at least `parts` partitions and cut; joins on that key then move the other side alone.

    For that it must have no fewer partitions than other exchanges. An adaptive plan does not tell the
    checkpoint how its rows are dealt, so this one exchange is planned without.
    """
    conf = df.sparkSession.conf
    parts = max(parts, int(conf.get("spark.sql.shuffle.partitions")))
    before = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return cut(df.repartition(parts, key))
    finally:
        conf.set("spark.sql.adaptive.enabled", before)


def own_folder(spark: SparkSession, kind: str) -> str:
    """A new name in the shared folder; what is there goes when the driver's Python ends, if not before."""
    folder = f"{scratch(spark)}/{kind}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, folder)
    return folder


def remove(spark: SparkSession, folder: str) -> None:
    """Removes a folder of the shared folder, as long as the session lives; shuffle files that no plan can reach go with it."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark._jvm.System.gc()


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """df as a Parquet table in the shared folder, and its folder.

    Against a checkpoint it is smaller, its columns are read one by one, and it can be removed as
    soon as all that depends on it has been cut.
    """
    folder = own_folder(df.sparkSession, "table")
    with passing(df.sparkSession):
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def hottest(df: DataFrame, *keys: str, weight: Column | None = None, floor: int = HOT_FLOOR) -> DataFrame:
    """The at most HOT_KEYS keys with most rows: small enough to broadcast at any input size."""
    counts = df.groupBy(*keys).agg((F.sum(weight) if weight is not None else F.count(F.lit(1))).alias("n_hot"))
    return counts.where(F.col("n_hot") >= floor).orderBy(F.desc("n_hot"), *keys).limit(HOT_KEYS)


#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ for text whose A-Z are not yet lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
