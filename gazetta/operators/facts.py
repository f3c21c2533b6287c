"""Star joins: facts with their dimensions, and views over them.

Dimensions are joined without hints: Spark broadcasts those whose size it knows to be small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions import jsonx
from gazetta.functions.dates import in_days


def left(facts: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: dict[str, str]) -> DataFrame:
    """facts with some columns (dimension name -> new name) of the row that key points to, or nulls."""
    side = dim.select(F.col(dim_key).alias("_key"), *(F.col(k).alias(v) for k, v in columns.items()))
    return facts.join(side, facts[key] == side["_key"], "left").drop("_key")


def star(facts: DataFrame, dims: list[tuple[DataFrame, str, str, dict[str, str]]]) -> DataFrame:
    for dim, key, dim_key, columns in dims:
        facts = left(facts, dim, key, dim_key, columns)
    return facts


# The columns of the fact table, in order; required ones end with a mark.
FACTS = """unique_id string!, title string, url string, content_hash string, agency_key string, agency_name string,
theme_l1_code string, theme_l1_label string, theme_l2_code string, theme_l2_label string, most_specific_theme_code string, most_specific_theme_label string,
published_at timestamp_ntz!, extracted_at timestamp_ntz, synced_at timestamp_ntz!, word_count int, char_count int, paragraph_count int, has_image boolean, has_video boolean,
sentiment_score double, sentiment_label string, publication_hour int, publication_dow int, readability_flesch double"""

#: Typed features: name -> (path, kind).
FEATURES = {
    "sentiment_score": ("sentiment.score", "double"), "sentiment_label": ("sentiment.label", "string"), "word_count": ("word_count", "long"), "char_count": ("char_count", "long"),
    "paragraph_count": ("paragraph_count", "long"), "has_image": ("has_image", "boolean"), "has_video": ("has_video", "boolean"), "readability_flesch": ("readability_flesch", "double"),
    "publication_hour": ("publication_hour", "long"), "publication_dow": ("publication_dow", "long"), "view_count": ("view_count", "long"), "trending_score": ("trending_score", "double"),
}


def typed_features(features: Column) -> list[Column]:
    return [jsonx.typed(features, path, kind).alias(name) for name, (path, kind) in FEATURES.items()]


def themed(news: DataFrame, themes: DataFrame, names: dict[str, str]) -> DataFrame:
    """news with code and label of the themes that its id columns point to; names: id column -> prefix."""
    for column, name in names.items():
        news = left(news, themes, column, "id", {"code": f"{name}_code", "label": f"{name}_label"})
    return news


def _with_missing(df: DataFrame, **kinds: str) -> DataFrame:
    """df with null columns where it lacks them."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in kinds.items() if c not in df.columns})


def conform(rows: DataFrame, schema: str = FACTS) -> DataFrame:
    """rows with exactly the columns of a schema, in order and cast; a null in a required one stops the job."""
    out = []
    for name, kind in (x.split() for x in schema.split(",")):
        c = (F.col(name) if name in rows.columns else F.lit(None)).cast(kind.rstrip("!"))
        if kind.endswith("!"):
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{name} is required")).cast(kind.rstrip("!"))).otherwise(c)
        out.append(c.alias(name))
    return rows.select(*out)


def build_facts(news: DataFrame, themes: DataFrame, features: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Articles of [start, end] days with three theme levels, the most specific theme and typed features."""
    rows = _with_missing(news.where(in_days(F.col("published_at"), start, end)), most_specific_theme_id="long")
    levels = {f"theme_l{n}_id": f"theme_l{n}" for n in (1, 2, 3)} | {"most_specific_theme_id": "most_specific_theme"}
    rows = left(themed(rows, themes, levels), features, "unique_id", "unique_id", {"features": "features"})
    known = ["unique_id", "agency_key", "agency_name", "title", "url", "published_at", "extracted_at", "content_hash"]
    return rows.select(*[c for c in known if c in rows.columns], *[f"{n}_{c}" for n in levels.values() for c in ("code", "label")], *typed_features(F.col("features")))


def fact_table(news: DataFrame, themes: DataFrame, features: DataFrame, start: str, end: str | None = None, synced_at: Column | None = None) -> DataFrame:
    """The fact rows of [start, end] days with the columns of FACTS, as they are loaded."""
    at = F.current_timestamp() if synced_at is None else synced_at
    return conform(build_facts(news, themes, features, start, end).withColumn("synced_at", at))


def search_rows(news: DataFrame, themes: DataFrame, features: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """What search.documents takes: articles of [start, end] days with four themes, features and entities."""
    from .graph import ENTITIES

    rows = _with_missing(news.where(in_days(F.col("published_at"), start, end)), theme_l3_id="long", most_specific_theme_id="long")
    levels = {f"theme_l{n}_id": f"theme_1_level_{n}" for n in (1, 2, 3)}
    rows = themed(rows, themes, {**levels, "most_specific_theme_id": "most_specific_theme"})
    rows = left(rows, features, "unique_id", "unique_id", {"features": "features"})
    renamed = {"agency_key": "agency", "image_url": "image"}
    dropped = {*FEATURES, "features", *levels, "most_specific_theme_id"}
    own = [F.col(c).alias(renamed.get(c, c)) for c in rows.columns if c not in dropped]
    dated = [F.year("published_at").alias("published_year"), F.month("published_at").alias("published_month")]
    return rows.select(*own, *dated, *typed_features(F.col("features")), F.from_json(F.get_json_object("features", "$.entities"), ENTITIES).alias("entities"))


def bronze_rows(news: DataFrame, agencies: DataFrame, themes: DataFrame) -> DataFrame:
    """Whole articles with their agency as joined by id and four themes, for the raw archive or one message's article."""
    rows = left(news, agencies, "agency_id", "id", {"key": "agency_key_joined", "name": "agency_name_joined"})
    return themed(rows, themes, {**{f"theme_l{n}_id": f"theme_l{n}" for n in (1, 2, 3)}, "most_specific_theme_id": "most_specific_theme"})


def missing_days(rows: DataFrame, loaded: DataFrame, hash_column: str = "content_hash") -> tuple[DataFrame, DataFrame]:
    """(rows of days that are not loaded and complete, day, status and number of rows of each day).

    Status: loaded (skipped), failed (a row has no hash, so the whole day waits), or new.
    """
    dated = rows.withColumn("day", F.to_date("published_at"))
    have = loaded.select(F.to_date("published_at").alias("day")).distinct().withColumn("have", F.lit(True))
    days = dated.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.count(hash_column).alias("good")).join(have, "day", "left")
    status = F.when(F.col("have"), "loaded").when(F.col("good") < F.col("n"), "failed").otherwise("new")
    report = days.select("day", status.alias("status"), "n")
    return dated.join(report.where("status = 'new'").select("day"), "day", "left_semi").drop("day"), report


def with_themes(news: DataFrame, themes: DataFrame) -> DataFrame:
    """Articles with the labels of their levels and the deepest one."""
    for n in (1, 2, 3):
        news = left(news, themes, f"theme_l{n}_id", "id", {"label": f"theme_l{n}_label"})
    return news.withColumn("theme", F.coalesce("theme_l3_label", "theme_l2_label", "theme_l1_label"))


def flatten_tree(nodes: DataFrame, parents: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One level of a hierarchy: nodes (code part, label, parent) under rows of flatten_tree or roots."""
    up = parents.select(F.col("id").alias("_up"), F.col("code").alias("parent_code"))
    own = nodes.select(F.col(columns["id"]).cast("string").alias("id"), F.col(columns["label"]).alias("label"), F.col(columns["parent"]).cast("string").alias("_parent"))
    joined = own.join(up, own["_parent"] == up["_up"])
    code = F.concat_ws(".", "parent_code", F.lpad("id", 2, "0"))
    return joined.select("id", code.alias("code"), "label", F.concat_ws(" ", code, "label").alias("full_name"), "parent_code")


def latest(rows: DataFrame, key: str, *newest_first: Column) -> DataFrame:
    """The first row of each key in that order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*newest_first))).where("_n = 1").drop("_n")
