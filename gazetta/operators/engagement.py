"""Views, sessions and web events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions.urls import extract_or_null

ARTICLE = "/artigos/([a-z0-9][a-z0-9_-]+)"


def engagement(views: DataFrame, pattern: str = ARTICLE, prefix: str | None = "/artigos/", as_of: datetime | None = None, days: int = 30) -> DataFrame:
    """unique_id, view_count, unique_sessions by the id in url_path; views: url_path, session_id, created_at."""
    if as_of is not None:
        views = views.where(F.col("created_at") >= F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {days} DAY"))
    if prefix:
        views = views.where(F.col("url_path").startswith(prefix))
    found = views.withColumn("unique_id", extract_or_null(F.col("url_path"), pattern)).where("unique_id is not null")
    return found.groupBy("unique_id").agg(F.count(F.lit(1)).alias("view_count"), F.countDistinct("session_id").alias("unique_sessions"))


def object_of(key: Column, value: Column, order: Column) -> Column:
    """An aggregate: a JSON object of key -> value as text; null keys are left out, the last value in order wins, no keys give null."""
    entries = F.array_sort(F.collect_list(F.when(key.isNotNull(), F.struct(order.alias("o"), key.alias("k"), value.cast("string").alias("v")))))
    # by key and order, each entry beside the next one; the last of each key is followed by another key
    placed = F.array_sort(F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), i.alias("i"), e["v"].alias("v"))))
    beside = F.zip_with(placed, F.slice(placed, 2, F.greatest(F.size(placed), F.lit(1))), lambda e, n: F.struct(e["k"].alias("key"), e["v"].alias("value"), n["k"].alias("next")))
    last = F.filter(beside, lambda e: ~F.coalesce(e["next"] == e["key"], F.lit(False)))
    return F.when(F.count(key) > 0, F.to_json(F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))), {"ignoreNullFields": "false"}))


def pageviews(events: DataFrame, sessions: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Page views (event_type 1) in [start, end) with their session's columns."""
    return _in(events, start, end).where("event_type = 1").join(sessions, "session_id")


def custom_events(events: DataFrame, sessions: DataFrame, data: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Custom events (event_type 2) in [start, end) with their session and their data as one JSON object."""
    value = F.coalesce(F.col("string_value"), F.col("number_value").cast("string"))
    objects = data.groupBy(F.col("website_event_id").alias("event_id")).agg(object_of(F.col("data_key"), value, F.col("data_key")).alias("event_data"))
    return _in(events, start, end).where("event_type = 2").join(sessions, "session_id").join(objects, "event_id", "left")


def _in(events: DataFrame, start: datetime, end: datetime) -> DataFrame:
    at = F.col("created_at")
    return events.where((at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz")))


def daily_views(views: DataFrame, day: Column, *keys: str, user: str) -> DataFrame:
    return views.groupBy(day.alias("day"), *keys).agg(F.count(F.lit(1)).alias("views"), F.countDistinct(user).alias("users"))


def quota(usage: DataFrame, day: str, model: str, tokens: Column, limit: float, share: float = 0.8) -> DataFrame:
    """Accumulated use by day and model, and whether it has reached that share of the quota."""
    used = usage.groupBy(day, model).agg(F.sum(tokens).alias("used"))
    return used.withColumn("stop", F.col("used") >= share * limit)
