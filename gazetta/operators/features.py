"""Feature objects of articles, and which are missing or out of date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import annotate, jsonx, text
from gazetta.functions.dates import day_of_week


def columns() -> dict[str, Column]:
    """Plain features: name -> expression over content, image_url, video_url, published_at."""
    c = F.col("content")
    return {
        "word_count": text.word_count(c), "char_count": text.char_count(c), "paragraph_count": text.paragraph_count(c),
        "has_image": text.has_value(F.col("image_url")), "has_video": text.has_value(F.col("video_url")),
        "publication_hour": F.hour("published_at").cast("long"), "publication_dow": day_of_week(F.col("published_at")), "readability_flesch": text.flesch(c),
    }


#: Registry: name -> version. A feature whose stored version differs is computed again.
VERSIONS = {name: "1.0" for name in ("word_count", "char_count", "paragraph_count", "has_image", "has_video", "publication_hour", "publication_dow", "readability_flesch", "content_annotations")}


def outdated(stored: dict[str, str]) -> list[str]:
    return [name for name, version in VERSIONS.items() if stored.get(name) != version]


def compute(news: DataFrame, only: list[str] | None = None) -> DataFrame:
    """unique_id, features: a JSON object; features without a value are left out."""
    own = {k: v for k, v in columns().items() if only is None or k in only}
    return news.select("unique_id", F.to_json(F.struct(*(v.alias(k) for k, v in own.items()))).alias("features"))


def window(news: DataFrame, features: DataFrame, start: str, end: str, key: str = "readability_flesch", limit: int = 50_000) -> DataFrame:
    """Patches for the newest `limit` articles of [start, end) without that feature."""
    at = F.col("published_at")
    rows = news.where((at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz")))
    return compute(missing(rows, features, key).orderBy(F.desc("published_at"), "unique_id").limit(limit))


def recomputed(news: DataFrame, features: DataFrame, stored: dict[str, str]) -> DataFrame:
    """Patches of all articles: every plain feature of those that lack it, and the outdated ones of the others; annotations where their hash has changed."""
    from .stores import merge_features

    old = [k for k in outdated(stored) if k in columns()]
    fresh = compute(missing(news, features, next(iter(columns()))))
    again = compute(news.join(fresh.select("unique_id"), "unique_id", "left_anti"), old) if old else fresh.limit(0)
    spans = annotated(news.join(features.select("unique_id", "features"), "unique_id", "left")) if "entities" in news.columns else fresh.limit(0)
    return merge_features(fresh.unionByName(again), spans)


def annotated(news: DataFrame) -> DataFrame:
    """unique_id, features with content_annotations and their source hash, of articles whose hash has changed.

    news: unique_id, content, entities (array of structs), features (JSON, may be null).
    """
    fresh = news.withColumn("hash", annotate.source_hash("content", "entities"))
    known = (jsonx.typed(F.col("features"), "annotations_source_hash", "string") == F.col("hash")) & jsonx.has_key(F.col("features"), "content_annotations")
    todo = fresh.where(~F.coalesce(known, F.lit(False)))
    spans = annotate.annotations("content", "entities")
    return todo.select("unique_id", F.to_json(F.struct(spans.alias("content_annotations"), F.col("hash").alias("annotations_source_hash"))).alias("features"))


def missing(news: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Articles without a feature row or without that key."""
    side = features.select(F.col("unique_id").alias("_id"), "features")
    joined = news.join(side, news["unique_id"] == side["_id"], "left")
    return joined.where(~jsonx.has_key(F.col("features"), key)).drop("_id", "features")


def of_ids(features: DataFrame, ids: DataFrame) -> DataFrame:
    return features.join(ids.select("unique_id"), "unique_id", "left_semi")
