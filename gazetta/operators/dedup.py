"""Duplicates by key, collisions of identifiers, and differences of sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions import text


def keep_first(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """rows with group_size, place (1 stays) among the rows of equal keys."""
    w = Window.partitionBy(*keys)
    return rows.withColumn("group_size", F.count(F.lit(1)).over(w)).withColumn("place", F.row_number().over(w.orderBy(*order)))


def url_duplicates(news: DataFrame) -> DataFrame:
    """agency_key, url, keep_id, drop_ids, kept_embedding: rows with an embedding stay before others, then the lowest id."""
    order = F.struct(F.col("content_embedding").isNull().alias("without"), "id")
    groups = news.where("url is not null").groupBy("agency_key", "url").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(order)).alias("ids")).where("n > 1")
    return groups.select("agency_key", "url", F.col("ids")[0]["id"].alias("keep_id"), F.transform(F.slice("ids", 2, F.size("ids")), lambda x: x["id"]).alias("drop_ids"), (~F.col("ids")[0]["without"]).alias("kept_embedding"))


def without_url_duplicates(news: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(news without the later rows of each url, groups, dropped rows and groups whose kept row has an embedding)."""
    groups = url_duplicates(news)
    gone = groups.select(F.explode("drop_ids").alias("id"))
    report = groups.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum(F.size("drop_ids")), F.lit(0)).cast("long").alias("dropped"), F.count_if("kept_embedding").alias("preserved_with_embedding"))
    return news.join(gone, "id", "left_anti"), report


def orphans(index: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keys of the index that the source lacks."""
    return index.select(key).join(source.select(key), key, "left_anti").distinct()


def backfill_hashes(news: DataFrame) -> DataFrame:
    """news with content_hash where it was null."""
    return news.withColumn("content_hash", F.coalesce("content_hash", text.content_hash(F.col("title"), F.col("content"))))


def unique_ids(rows: DataFrame, base: Column, digest: Column, order: str, short: int = 6, longest: int = 32) -> DataFrame:
    """rows with unique_id: base_suffix, the suffix one digit longer for each row before it with the same id.

    A row that finds its id taken extends its own digest; equal digests fall back on a number.
    """
    start = rows.withColumn("_base", base).withColumn("_digest", digest).withColumn("_id", F.concat_ws("_", "_base", F.substring(F.col("_digest"), 1, short)))
    nth = F.row_number().over(Window.partitionBy("_id").orderBy(order))
    numbered = start.withColumn("_n", nth)
    size = F.least(F.lit(longest), F.lit(short) + F.col("_n") - 1)
    longer = F.concat_ws("_", "_base", F.substring("_digest", F.lit(1), size))
    over = F.when(F.col("_n") > longest - short + 1, F.concat(longer, F.lit("-"), F.col("_n").cast("string"))).otherwise(longer)
    return numbered.withColumn("unique_id", over).drop("_base", "_digest", "_id", "_n")


def registry_aliases(rows: DataFrame, name: str, key: str, id_: str) -> tuple[DataFrame, DataFrame]:
    """(alias_norm, entity_id) of aliases owned by one entity; alias_norm, owners of the others, which resolve to none."""
    each = rows.select(F.col(id_).alias("entity_id"), F.explode(text.aliases(F.col(name), F.col(key))).alias("alias"))
    owned = each.select("entity_id", text.alias_form(F.col("alias")).alias("alias_norm")).where("alias_norm <> ''").distinct()
    by_alias = owned.groupBy("alias_norm").agg(F.count(F.lit(1)).alias("owners"), F.min("entity_id").alias("entity_id"))
    return by_alias.where("owners = 1").select("alias_norm", "entity_id"), by_alias.where("owners > 1").select("alias_norm", "owners")


def seeded_registry(agencies: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(registry rows, aliases of one owner, aliases of several, sorted) of an agency table: key, name."""
    named = agencies.where("key is not null and name is not null").withColumn("entity_id", F.concat(F.lit(prefix), F.col("key")))
    all_ = text.aliases(F.col("name"), F.col("key"))
    registry = named.select(
        "entity_id", text.without_parenthetical(F.col("name")).alias("canonical_name"), F.lit("ORG").alias("type"), F.to_json(all_).alias("aliases"), F.lit(None).cast("string").alias("wikidata_id"),
        F.col("key").alias("agency_key"), F.lit(1.0).alias("confidence"), F.lit("agencies_seed").alias("provenance"), F.lit("{}").alias("extra"),
    )
    one, several = registry_aliases(named, "name", "key", "entity_id")
    return registry, one, several.orderBy("alias_norm")
