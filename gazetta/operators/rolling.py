"""Rolling counts over time ranges that no single hot key can slow down."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_counts(rows: DataFrame, key: str, second: str, spans: dict[str, int], bucket_s: int = 3600) -> DataFrame:
    """key, second and, for each name in spans, the number of rows with the same key in [second - span, second].

    Null is a key of its own. The same as a RANGE window over the key, but a key's rows are dealt
    out by time buckets: rows are counted by second before any shuffle, running counts are formed
    inside buckets, and the totals of whole buckets, few rows, are added up by key.
    """
    counts = rows.groupBy(F.col(key).alias("k"), F.col(second).cast("long").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    # a probe at p counts all rows up to p: at the second itself, and just before the span
    probes = F.array(F.struct(F.col("s").alias("p"), F.lit(None).cast("string").alias("span")), *(F.struct((F.col("s") - length - 1).alias("p"), F.lit(name).alias("span")) for name, length in spans.items()))
    marks = counts.select("k", "s", "n", F.explode(probes).alias("x")).select("k", "s", "x.p", "x.span", F.when(F.col("x.span").isNull(), F.col("n")).otherwise(0).alias("n"))
    marks = marks.withColumn("bucket", F.floor(F.col("p") / bucket_s))
    inside = Window.partitionBy("k", "bucket").orderBy("p").rangeBetween(Window.unboundedPreceding, 0)
    totals = counts.groupBy("k", F.floor(F.col("s") / bucket_s).alias("b")).agg(F.sum("n").alias("t"))
    # buckets in which only probes fall need the sum of all before them, too
    needed = marks.select("k", F.col("bucket").alias("b"), F.lit(0).cast("long").alias("t")).distinct().unionByName(totals).groupBy("k", "b").agg(F.sum("t").alias("t"))
    before = needed.withColumn("before", F.sum("t").over(Window.partitionBy("k").orderBy("b")) - F.col("t")).select(F.col("k").alias("k2"), "b", "before")
    same = F.col("k").eqNullSafe(F.col("k2")) & (F.col("bucket") == F.col("b"))
    up_to = marks.withColumn("inside", F.sum("n").over(inside)).join(before, same).withColumn("c", F.col("inside") + F.col("before"))
    here = F.max(F.when(F.col("span").isNull(), F.col("c")))
    return up_to.groupBy("k", "s").agg(*((here - F.max(F.when(F.col("span") == name, F.col("c")))).alias(name) for name in spans)).select(F.col("k").alias(key), F.col("s").alias(second), *spans)
