"""Where tables come from and go to: Parquet folders, JDBC, JSON, CSV and YAML masters."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazetta.functions.dates import in_days
from gazetta.session import cut


class Catalog:
    """Tables by name, from one folder or one database."""

    def __init__(self, spark: SparkSession, root: str | None = None, jdbc: dict[str, str] | None = None):
        self.spark, self.root, self.jdbc = spark, root, jdbc

    def table(self, name: str, partition: dict[str, Any] | None = None) -> DataFrame:
        """partition: partitionColumn, lowerBound, upperBound, numPartitions of a database scan."""
        if self.jdbc:
            return self.spark.read.format("jdbc").options(**self.jdbc, dbtable=name, **(partition or {})).load()
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def has(self, name: str, *columns: str) -> bool:
        try:
            return set(columns) <= set(self.table(name).columns)
        except Exception as e:  # the reader raises its own kinds for a missing path or table
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) or "doesn't exist" in str(e):
                return False
            raise

    def dataset(self, name: str) -> DataFrame | None:
        """A published dataset with the union of its files' columns; None if it is missing."""
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.root}/{name}.parquet") if self.has(name) else None


def select_rows(df: DataFrame, filters: dict[str, Any] | None = None, order_by: list | None = None, limit: int = 0, offset: int = 0) -> DataFrame:
    """Rows that equal all filters, in order; a None filter matches nothing, 0 means no limit or offset."""
    for name, value in (filters or {}).items():
        df = df.where(F.lit(False) if value is None else F.col(name) == value)
    if order_by:
        df = df.orderBy(*order_by)
    if offset:
        df = df.offset(offset)
    return df.limit(limit) if limit else df


def count_rows(df: DataFrame, filters: dict[str, Any] | None = None) -> int:
    """The number of rows that equal all filters."""
    return select_rows(df, filters).count()


def numbered(df: DataFrame, *order) -> DataFrame:
    """df with _at, each row's place (from 0) in a total order.

    Rows are numbered within sorted partitions, whose sizes are added up: no single task sees all. The
    sorted rows are written once and read for both, as a second sort could draw other bounds of partitions.
    """
    ordered = cut(df.orderBy(*order).withColumn("_part", F.spark_partition_id()).withColumn("_id", F.monotonically_increasing_id()))
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_lo"))
    before = sizes.select("_part", "_lo", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    placed = ordered.join(F.broadcast(before), "_part")  # one row for each partition
    return placed.withColumn("_at", F.col("_before") + F.col("_id") - F.col("_lo")).drop("_part", "_id", "_lo", "_before")


def numbered_pages(df: DataFrame, size: int, *order) -> DataFrame:
    """df with page (from 0) in a total order; rows of one page are to be read together."""
    return numbered(df, *order).withColumn("page", F.floor(F.col("_at") / size)).drop("_at")


def keyset_page(df: DataFrame, key: str, after: Any = None, size: int = 1000) -> DataFrame:
    """The next rows after a key; a page shorter than size is the last one."""
    return (df if after is None else df.where(F.col(key) > F.lit(after))).orderBy(key).limit(size)


# Names of a GraphQL answer and ours; answers lack content_hash, extracted_at and synced_at of a fact.
CAMEL = {
    "uniqueId": "unique_id", "title": "title", "url": "url", "imageUrl": "image", "videoUrl": "video_url", "content": "content", "summary": "summary", "subtitle": "subtitle", "editorialLead": "editorial_lead",
    "category": "category", "tags": "tags", "agencyKey": "agency", "agencyName": "agency_name", "publishedAt": "published_at", "extractedAt": "extracted_at",
    "themL1Code": "theme_1_level_1_code", "themL1Label": "theme_1_level_1_label", "themL2Code": "theme_1_level_2_code", "themL2Label": "theme_1_level_2_label", "themL3Code": "theme_1_level_3_code", "themL3Label": "theme_1_level_3_label",
    "mostSpecificThemeCode": "most_specific_theme_code", "mostSpecificThemeLabel": "most_specific_theme_label", "contentEmbedding": "content_embedding", "sentimentLabel": "sentiment_label", "sentimentScore": "sentiment_score",
    "trendingScore": "trending_score", "wordCount": "word_count", "hasImage": "has_image", "hasVideo": "has_video", "imageBroken": "image_broken", "readabilityFlesch": "readability_flesch",
}
#: Keys of the features object that are columns of a search row, with their kinds.
NESTED = {"entities": "array<struct<text:string,type:string,count:int,canonical_id:string,salience:float>>", "view_count": "int"}


def from_camel(rows: DataFrame) -> DataFrame:
    """rows with our names; columns of other names are left out, nested features become columns, dates become epoch, year and month."""
    from gazetta.functions.dates import normalise

    out = [F.col(a).alias(b) for a, b in CAMEL.items() if a in rows.columns and b not in ("published_at", "extracted_at")]
    if "features" in rows.columns:
        out += [(F.from_json(F.get_json_object("features", f"$.{k}"), kind) if "<" in kind else F.get_json_object("features", f"$.{k}").try_cast(kind)).alias(k) for k, kind in NESTED.items()]
    for camel, name in (("publishedAt", "published_at"), ("extractedAt", "extracted_at")):
        if camel in rows.columns:
            out.append(F.coalesce(F.unix_seconds(normalise(F.col(camel)).cast("timestamp")), F.lit(0)).alias(f"{name}_ts"))
    mapped = rows.select(*out)
    if "publishedAt" not in rows.columns:
        return mapped
    at = F.when(F.col("published_at_ts") > 0, F.timestamp_seconds("published_at_ts"))
    return mapped.withColumns({"published_year": F.year(at), "published_month": F.month(at)})


def serialised(df: DataFrame) -> DataFrame:
    """df for a sink of plain values: times as ISO text, objects and maps as JSON."""
    from gazetta.functions.dates import iso_text

    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        out.append((iso_text(c) if kind.startswith("timestamp") else F.to_json(c) if kind.startswith(("struct", "map")) else c).alias(name))
    return df.select(*out)


def in_chunks(df: DataFrame, size: int, *order) -> DataFrame:
    """chunk, rows (an array): the rows in order, size of them in each chunk but the last."""
    own = F.struct(*df.columns)
    rows = F.array_sort(F.collect_list(F.struct("_at", own.alias("row"))))
    return numbered(df, *order).groupBy(F.floor(F.col("_at") / size).alias("chunk")).agg(F.transform(rows, lambda x: x["row"]).alias("rows"))


def batch_statistics(total: int, size: int) -> dict[str, int]:
    """How many batches of a size a total makes, and how large the last one is."""
    return {"total": total, "batch_size": size, "batches": -(-total // size), "last_batch": total - size * (max(0, -(-total // size) - 1))}


def agencies_of(spark: SparkSession, tree: dict[str, dict]) -> DataFrame:
    """The agency table of a parsed master: key -> name, type, parent, url."""
    rows = [(k, v.get("name"), v.get("type"), v.get("parent"), v.get("url")) for k, v in sorted(tree.items())]
    return spark.createDataFrame(rows, "key string, name string, type string, parent_key string, url string")


def probe(c: Catalog, tables: dict[str, tuple[str, ...]]) -> dict[str, list[str] | None]:
    """For each table the columns that it lacks; None where there is no such table."""
    return {name: [x for x in columns if not c.has(name, x)] if c.has(name) else None for name, columns in tables.items()}


def by_id(df: DataFrame, key: str, value: Any) -> DataFrame:
    return df.where(F.col(key) == value).limit(1)


def by_days(df: DataFrame, column: str, start: str, end: str | None = None) -> DataFrame:
    return df.where(in_days(F.col(column), start, end))


def of_partitions(df: DataFrame, column: str, start: str | None, end: str | None = None) -> DataFrame:
    """A scan that must name its days, so that no query reads every partition by accident."""
    if not start:
        raise ValueError(f"a range of {column} is required")
    return df.where((F.col(column) >= F.lit(start).cast("date")) & (F.col(column) <= F.lit(end or start).cast("date")))


def bronze(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Raw JSON documents in nested day folders; the schema is given, never inferred."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def gazetteer(spark: SparkSession, path: str, schema: str, lists: tuple[str, ...] = ("aliases",)) -> DataFrame:
    """Quoted CSV with a header; comma lists become arrays."""
    from gazetta.functions.text import split_tags

    df = spark.read.schema(schema).option("header", "true").option("quote", '"').option("escape", '"').csv(path)
    return df.withColumns({c: split_tags(F.col(c)) for c in lists})


def tree_rows(nodes: list[dict], level: int = 1, parent: str | None = None) -> list[tuple]:
    """(code, label, full_name, level, parent_code) of a nested tree of masters, parents first."""
    rows = []
    for n in nodes:
        code = str(n["code"])
        rows.append((code, n["label"], f"{code} {n['label']}", level, parent))
    for n in nodes:
        rows += tree_rows(n.get("children") or [], level + 1, str(n["code"]))
    return sorted(rows, key=lambda r: r[3]) if level == 1 else rows


def masters(spark: SparkSession, tree: list[dict]) -> DataFrame:
    """The theme table of a parsed YAML tree: a master file, small by nature."""
    return spark.createDataFrame(tree_rows(tree), "code string, label string, full_name string, level int, parent_code string")


def append_days(df: DataFrame, path: str, day: str, *cluster: str) -> None:
    """Writes whole days: days that df holds are replaced, others stay, so a day loaded twice is not doubled."""
    # days of any size: adaptive execution joins small ones and splits large ones
    ordered = df.hint("rebalance", day).sortWithinPartitions(day, *cluster)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def append(df: DataFrame, path: str, required: tuple[str, ...] = ()) -> None:
    """Appends; rows without a required value stop the job."""
    for c in required:
        df = df.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is required")).cast(df.schema[c].dataType)).otherwise(F.col(c)))
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Swaps a table for df, which may be computed from it: a new folder is written, then renamed."""
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    jvm = spark._jvm
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = at(path).getFileSystem(spark._jsc.hadoopConfiguration())
    old = f"{path.rstrip('/')}-before"
    if not fs.exists(at(path)) and fs.exists(at(old)):
        fs.rename(at(old), at(path))  # an earlier swap was cut off between its two renames
    had = fs.exists(at(path))
    if had:
        fs.delete(at(old), True)
        fs.rename(at(path), at(old))
    if not fs.rename(at(fresh), at(path)):
        if had:
            fs.rename(at(old), at(path))
        raise OSError(f"{path} could not be replaced")
    fs.delete(at(old), True)


def write_bronze(df: DataFrame, path: str, published_at: str = "published_at") -> None:
    """JSON documents under year/month/day of their publication."""
    ts = F.col(published_at)
    dated = df.withColumns({"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"), "day": F.date_format(ts, "dd")})
    dated.write.mode("append").partitionBy("year", "month", "day").json(path)


def publish(df: DataFrame, path: str, order: tuple = ("agency", "published_at"), reduced: tuple[str, ...] = ("published_at", "agency", "title", "url")) -> None:
    """A dataset by agency, newest first, and its reduced copy."""
    ordered = df.orderBy(F.asc(order[0]), F.desc(order[1]))
    ordered.write.mode("overwrite").parquet(f"{path}/full")
    ordered.select(*reduced).write.mode("overwrite").parquet(f"{path}/reduced")


def write_all(df: DataFrame, sinks: dict[str, Any]) -> dict[str, Exception | None]:
    """Gives df to each sink; an error stops the job only if no sink succeeds."""
    out: dict[str, Exception | None] = {}
    for name, sink in sinks.items():
        try:
            sink(df)
            out[name] = None
        except Exception as e:  # any kind of sink error counts the same
            out[name] = e
    if out and all(out.values()):
        raise next(e for e in out.values() if e)
    return out
