"""Exact dedup by deterministic block naming, with DataFrame operations only.

A document is cut into blocks of a fixed number of bytes. Equal blocks get one integer name:
blocks are dealt out by a hash bucket, sorted inside it, and named by bucket and rank, so two
names are equal only if the bytes are. Then adjacent pairs of names are named in the same way,
round by round, until every document has one name. Together with the byte length that name
identifies the normalised text without collisions; no hash decides equality.

Hot blocks (copies of one text may be a third of all rows) would meet in one task. The at most
HOT_KEYS most frequent ones are named apart: their distinct values collapse on the map side, the
few names are broadcast, and their rows are dealt out by row instead of by bucket.

Defined results: null text counts as empty; all empty texts are one group; rows that repeat both
doc_id and text are one document; a null doc_id is an id of its own and loses ties; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import HOT_FLOOR, HOT_KEYS, cut, documents, hottest

BLOCK_BYTES = 4096
#: A name is bucket * 2**23 + rank. The number of distinct keys in one of 2**40 buckets stays far below 2**23; checked at run time.
BUCKETS, RANKS = 1 << 40, 1 << 23


def name_by_sorting(rows: DataFrame, keys: list[str], row: list[str]) -> DataFrame:
    """rows without `keys` and with an integer `name`: equal exactly where all keys are equal (nulls too).

    row: columns by which the rows of hot keys are dealt out.
    """
    rows = rows.withColumn("h", F.xxhash64(*keys))
    hot = rows.join(F.broadcast(hottest(rows.select("h"), "h").select("h")), "h", "left_semi").select(*keys).distinct()
    hot = hot.select(*[F.col(k).alias(f"hot_{k}") for k in keys], (-F.row_number().over(Window.orderBy(*keys))).cast("long").alias("hot_name"))
    same = [F.col(k).eqNullSafe(F.col(f"hot_{k}")) for k in keys]
    rows = rows.join(F.broadcast(hot), same, "left").drop(*[f"hot_{k}" for k in keys])
    is_hot = F.col("hot_name").isNotNull()
    rows = rows.withColumn("bucket", F.pmod(F.when(is_hot, F.xxhash64(*row)).otherwise(F.col("h")), F.lit(BUCKETS)))
    rows = rows.withColumns({k: F.when(~is_hot, F.col(k)) for k in keys})
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*keys))
    named = rows.withColumn("rank", rank)
    name = F.coalesce("hot_name", F.when(F.col("rank") < RANKS, F.col("bucket") * RANKS + F.col("rank")).otherwise(F.raise_error(F.lit("too many keys in a bucket")).cast("long")))
    return named.withColumn("name", name).drop("h", "hot_name", "bucket", "rank", *keys)


def with_identity(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, row (a hash of both), n_points, n_bytes, text_sha256 and name.

    Two documents have equal (n_bytes, name) exactly where their normalised texts are equal.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", text.alias("t"))
    base = base.select("doc_id", F.xxhash64("doc_id", "t").alias("row"), F.char_length("t").alias("n_points"), F.regexp_replace("t", r"[\x20\x09-\x0D]+", "").cast("binary").alias("b"))
    last = F.floor((F.greatest(F.octet_length("b"), F.lit(1)) - 1) / block_bytes).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("b"), i * block_bytes + 1, F.lit(block_bytes)))
    base = base.select("doc_id", "row", F.struct("n_points", F.octet_length("b").alias("n_bytes"), F.unhex(F.sha2("b", 256)).alias("sha")).alias("meta"), pieces.alias("pieces"))
    blocks = base.select("doc_id", "row", "meta", F.posexplode("pieces").alias("i", "block")).withColumn("meta", F.when(F.col("i") == 0, F.col("meta")))
    named = name_by_sorting(blocks, ["block"], ["row", "i"])
    docs_named = cut(named.groupBy("row", "doc_id").agg(F.max("meta").alias("meta"), F.sort_array(F.collect_set(F.struct("i", "name"))).alias("s")).select("row", "doc_id", "meta", F.col("s.name").alias("names")))
    done = docs_named.where(F.size("names") == 1).select("row", "doc_id", F.element_at("names", 1).alias("name"))
    left = docs_named.where(F.size("names") > 1).select("row", "doc_id", "names")
    longest = left.agg(F.max(F.size("names"))).first()[0] or 1
    while longest > 1:
        pair = F.transform(F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int")), lambda i: F.struct(F.get("names", 2 * i).alias("a"), F.get("names", 2 * i + 1).alias("b")))
        pairs = left.select("row", "doc_id", F.posexplode(pair).alias("i", "p")).select("row", "doc_id", "i", "p.a", "p.b")
        left = cut(name_by_sorting(pairs, ["a", "b"], ["row", "i"]).groupBy("row", "doc_id").agg(F.sort_array(F.collect_list(F.struct("i", "name"))).alias("s")).select("row", "doc_id", F.col("s.name").alias("names")))
        done = done.unionByName(left.where(F.size("names") == 1).select("row", "doc_id", F.element_at("names", 1).alias("name")))
        left = left.where(F.size("names") > 1)
        longest = (longest + 1) // 2
    meta = docs_named.select("row", F.col("doc_id").alias("id"), "meta")
    same = [meta["row"] == done["row"], meta["id"].eqNullSafe(done["doc_id"])]
    return meta.join(done, same).select("doc_id", meta["row"], "meta.n_points", "meta.n_bytes", F.lower(F.hex("meta.sha")).alias("text_sha256"), "name")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of each document.

    Texts are equal when they are identical without ASCII white space. Of a group stays the
    document with most code points in its original text, then with the smallest doc_id.
    """
    named = cut(with_identity(docs, block_bytes))
    groups = named.groupBy("n_bytes", "name").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("n_points", (-F.col("doc_id")).alias("minus"), "row")).alias("best"))
    hot = groups.where(F.col("group_size") >= HOT_FLOOR).orderBy(F.desc("group_size"), "n_bytes", "name").limit(HOT_KEYS)
    names = ["n_bytes", "name"]
    many = named.join(F.broadcast(hot), names)
    few = named.join(F.broadcast(hot.select(*names)), names, "left_anti").join(groups, names)
    out = many.unionByName(few)
    return out.select("doc_id", (-F.col("best.minus")).alias("keep_id"), "group_size", (F.col("best.row") == F.col("row")).alias("kept"), "text_sha256")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS p, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS t FROM documents),
g AS (SELECT doc_id, t, first_value(doc_id) OVER (PARTITION BY t ORDER BY p DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
"""
