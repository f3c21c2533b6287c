"""Keyed writes as whole-frame results: inserts, upserts, partial updates, merges, deletes.

Plain Parquet has no row update; each function returns the table after the write, for the caller
to store (sources.catalog.replace swaps it in). Both frames may be large; all joins are on keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions import jsonx


def insert_only(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old and the rows of new whose key it lacks."""
    return old.unionByName(new.join(old.select(key), key, "left_anti").select(*old.columns))


def upsert(old: DataFrame, new: DataFrame, key: str, keep: tuple[str, ...] = (), ignore_nulls: bool = False) -> DataFrame:
    """new wins over old, all columns but `keep`; with ignore_nulls only where it is not null."""
    return _joined(old, new, key, "full", keep, ignore_nulls)


def update(old: DataFrame, new: DataFrame, key: str, keep: tuple[str, ...] = (), ignore_nulls: bool = False) -> DataFrame:
    """As upsert, but unknown keys are ignored."""
    return _joined(old, new, key, "left", keep, ignore_nulls)


def _joined(old: DataFrame, new: DataFrame, key: str, how: str, keep: tuple[str, ...], ignore_nulls: bool) -> DataFrame:
    o, n = old.withColumn("_old", F.lit(True)).alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    joined = o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), how)

    def value(c: str):
        if c not in new.columns:
            return F.col(f"o.{c}")
        if c not in old.columns:
            return F.col(f"n.{c}")
        if c == key or ignore_nulls:
            first, second = (f"o.{c}", f"n.{c}") if c in keep else (f"n.{c}", f"o.{c}")
            return F.coalesce(first, second)
        wins = F.col("n._new").isNotNull() & (F.col("o._old").isNull() if c in keep else F.lit(True))
        return F.when(wins, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))

    columns = [*old.columns, *(c for c in new.columns if c not in old.columns)]
    return joined.select(*(value(c).alias(c) for c in columns))


def merge_features(old: DataFrame, patches: DataFrame, known: DataFrame | None = None, key: str = "unique_id", column: str = "features", order: str | None = None) -> DataFrame:
    """Feature objects after shallow merges; several patches of a key are folded in order.

    known: the articles; patches of others are left out. Patches that are null or empty change nothing.
    """
    filled = patches.where(F.col(column).isNotNull() & (F.regexp_replace(column, r"\s", "") != "{}"))
    if known is not None:
        filled = filled.join(known.select(key), key, "left_semi")
    at = F.col(order) if order else F.lit(0)
    folded = filled.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(at.alias("o"), F.col(column).alias("p")))).alias("ps"))
    folded = folded.select(F.col(key).alias("_key"), jsonx.fold(F.transform("ps", lambda x: x["p"])).alias("_patch"))
    joined = old.join(folded, old[key] == folded["_key"], "full")
    return joined.select(F.coalesce(old[key], F.col("_key")).alias(key), F.when(F.col("_patch").isNull(), F.col(column)).otherwise(jsonx.merge(F.col(column), F.col("_patch"))).alias(column))


def accumulate(old: DataFrame, new: DataFrame, keys: list[str], *sums: str) -> DataFrame:
    """Ledgers added up by key."""
    return old.unionByName(new).groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def delete(table: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return table.join(ids.select(key), key, "left_anti")


def delete_cascade(tables: dict[str, DataFrame], ids: DataFrame, key: str) -> dict[str, DataFrame]:
    """All tables after the deletion of ids and of what belongs to them, by the same key."""
    return {name: delete(t, ids, key) for name, t in tables.items()}


def feature_patches(rows: DataFrame, *columns: str, key: str = "unique_id") -> DataFrame:
    """key, features: the columns of computed rows as JSON objects for merge_features; nulls are left out."""
    return rows.select(key, jsonx.patch_of(**{c: F.col(c) for c in columns}).alias("features"))


def with_updated_at(old: DataFrame, new: DataFrame, key: str, at, column: str = "updated_at") -> DataFrame:
    """new, where rows that differ from old (or are not there) have updated_at set to `at`, others keep theirs."""
    same = [c for c in new.columns if c in old.columns and c not in (key, column)]
    before = old.select(F.col(key).alias("_key"), F.col(column).alias("_at"), F.xxhash64(*same).alias("_h"))
    joined = new.drop(column).join(before, F.col(key) == F.col("_key"), "left")
    kept = F.when(F.col("_h") == F.xxhash64(*same), F.col("_at")).otherwise(at)
    return joined.withColumn(column, kept).drop("_key", "_at", "_h")


def denormalise_agency(news: DataFrame, agencies: DataFrame) -> DataFrame:
    """news with agency_key and agency_name of the agency that agency_id names, or nulls."""
    from .facts import left

    return left(news.drop("agency_key", "agency_name"), agencies, "agency_id", "id", {"key": "agency_key", "name": "agency_name"})


# Dataset columns of theme codes and the id columns they belong to; dataset columns that no table stores.
CODES = {"theme_1_level_1_code": "theme_l1_id", "theme_1_level_2_code": "theme_l2_id", "theme_1_level_3_code": "theme_l3_id", "most_specific_theme_code": "most_specific_theme_id"}
LABELS = ("theme_1_level_1", "theme_1_level_1_label", "theme_1_level_2_label", "theme_1_level_3_label", "most_specific_theme_label")


def theme_ids(frame: DataFrame, themes: DataFrame) -> DataFrame:
    """frame with theme ids instead of codes; unknown codes give null."""
    for code, id_ in CODES.items():
        if code in frame.columns:
            side = themes.select(F.col("code").alias("_code"), F.col("id").alias(id_))
            frame = frame.join(side, F.col(code) == F.col("_code"), "left").drop("_code", code)
    return frame


def update_from_dataset(news: DataFrame, frame: DataFrame, themes: DataFrame, key: str = "unique_id") -> DataFrame:
    """news after an update from dataset rows: label columns and nulls change nothing, codes become ids, unknown ones are skipped."""
    return update(news, theme_ids(frame.drop(*LABELS), themes), key, ignore_nulls=True)


def from_dataset(frame: DataFrame, agencies: DataFrame, themes: DataFrame, need_title: bool = False) -> tuple[DataFrame, DataFrame]:
    """(article rows of dataset rows, unique_id and reason of those that are skipped).

    Skipped are rows without published_at or of an unknown agency, and with need_title without a title.
    """
    known = agencies.select(F.col("key").alias("agency"), F.col("id").alias("agency_id"), F.col("name").alias("agency_name"))
    reason = F.when(F.col("published_at").isNull(), "no published_at").when(F.col("agency_id").isNull(), "unknown agency")
    if need_title:
        reason = reason.when(F.coalesce(F.col("title"), F.lit("")) == "", "no title")
    rows = frame.join(known, "agency", "left").withColumn("reason", reason)
    kept = theme_ids(rows.where("reason is null").drop("reason", *LABELS), themes)
    names = {"agency": "agency_key", "image": "image_url"}
    return kept.withColumnsRenamed({a: b for a, b in names.items() if a in kept.columns}), rows.where("reason is not null").select("unique_id", "reason")


def to_dataset(news: DataFrame, themes: DataFrame, start: str, end: str, agency: str | None = None) -> DataFrame:
    """Dataset rows of the articles of [start, end] days, of one agency if given, the newest first; theme ids become codes."""
    from gazetta.functions.dates import in_days

    rows = news.where(in_days(F.col("published_at"), start, end))
    if agency:
        rows = rows.where(F.col("agency_key") == agency)
    for code, id_ in CODES.items():
        if id_ in rows.columns:
            side = themes.select(F.col("id").alias("_id"), F.col("code").alias(code))
            rows = rows.join(side, F.col(id_) == F.col("_id"), "left").drop("_id", id_)
    names = {"agency_key": "agency", "image_url": "image"}
    return rows.withColumnsRenamed({a: b for a, b in names.items() if a in rows.columns}).orderBy(F.desc("published_at"), "unique_id")


def merge_gazetteer(registry: DataFrame, gazetteer: DataFrame, kind: str = "POLICY") -> DataFrame:
    """The registry after a gazetteer of one kind: fields are merged into `extra` of known entities of that kind; unknown entities are added.

    registry: entity_id, canonical_name, type, aliases (JSON), wikidata_id, confidence, provenance, extra (JSON);
    gazetteer: entity_id, canonical_name, domain, lifecycle_phase, wikidata_id, instance_of.
    """
    fields = ["domain", "lifecycle_phase", "wikidata_id", "instance_of"]
    patch = lambda names: F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    side = gazetteer.select(F.col("entity_id").alias("_id"), patch(fields).alias("_patch"))
    joined = registry.join(side, F.col("entity_id") == F.col("_id"), "left")
    merged = joined.withColumn("extra", F.when(F.col("_patch").isNotNull() & (F.col("type") == kind), jsonx.merge(F.col("extra"), F.col("_patch"))).otherwise(F.col("extra")))
    fresh = gazetteer.join(registry.select("entity_id"), "entity_id", "left_anti").select(
        "entity_id", "canonical_name", F.lit(kind).alias("type"), F.lit("[]").alias("aliases"), "wikidata_id", F.lit(0.9).alias("confidence"), F.lit("gazetteer").alias("provenance"),
        patch([f for f in fields if f != "wikidata_id"]).alias("extra"),
    )
    return merged.drop("_id", "_patch").unionByName(fresh, allowMissingColumns=True)


def rekey(news: DataFrame, features: DataFrame, ids: DataFrame, key: str = "unique_id") -> tuple[DataFrame, DataFrame]:
    """(news, features) under new ids, the old one kept as legacy_unique_id. ids: key, new_id; rows without a new id keep theirs."""
    side = ids.select(F.col(key).alias("_old"), F.col("new_id").alias("_new"))

    def moved(df: DataFrame, legacy: bool) -> DataFrame:
        joined = df.join(side, F.col(key) == F.col("_old"), "left")
        if legacy:
            joined = joined.withColumn("legacy_unique_id", F.coalesce("legacy_unique_id", key) if "legacy_unique_id" in df.columns else F.col(key))
        return joined.withColumn(key, F.coalesce("_new", key)).drop("_old", "_new")

    return moved(news, True), moved(features, False)


def undo_rekey(news: DataFrame, features: DataFrame, key: str = "unique_id") -> tuple[DataFrame, DataFrame]:
    """(news, features) under their legacy ids again; an error if any article has none."""
    if not news.where("legacy_unique_id is null").isEmpty():
        raise ValueError("articles without legacy_unique_id cannot go back")
    back = news.where(F.col(key) != F.col("legacy_unique_id")).select(F.col(key).alias("_old"), F.col("legacy_unique_id").alias("_new"))
    joined = features.join(back, F.col(key) == F.col("_old"), "left").withColumn(key, F.coalesce("_new", key)).drop("_old", "_new")
    return news.withColumn(key, F.col("legacy_unique_id")), joined


def merge_datasets(old: DataFrame, new: DataFrame, key: str, order: str, allow_update: bool) -> DataFrame:
    """Dataset append: the first of equal new keys counts; known keys are updated where values are not null, or left alone."""
    from .facts import latest

    first = latest(new, key, F.col(order)).drop(order)
    for c in (c for c in first.columns if c not in old.columns):
        old = old.withColumn(c, F.lit(None).cast(first.schema[c].dataType))
    return upsert(old, first, key, ignore_nulls=True) if allow_update else old.unionByName(first.join(old.select(key), key, "left_anti"), allowMissingColumns=True)
