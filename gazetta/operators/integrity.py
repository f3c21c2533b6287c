"""Which articles to check next, and what a check changes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions import jsonx
from gazetta.functions.urls import null_unless_allowed

# Articles younger than the first interval are due again after the second; the rest after the last one.
TIERS = [("INTERVAL 3 HOUR", "INTERVAL 10 MINUTE"), ("INTERVAL 24 HOUR", "INTERVAL 1 HOUR"), ("INTERVAL 7 DAY", "INTERVAL 6 HOUR"), ("INTERVAL 30 DAY", "INTERVAL 24 HOUR"), (None, "INTERVAL 7 DAY")]


def tier(published_at: Column, as_of: Column) -> Column:
    """1 for the newest articles to 5."""
    out = F.lit(len(TIERS))
    for n, (age, _) in reversed([*enumerate(TIERS, 1)][:-1]):
        out = F.when(published_at > as_of - F.expr(age), F.lit(n)).otherwise(out)
    return out


def due(tier_: Column, has_state: Column, checked_at: Column, as_of: Column) -> Column:
    """Never checked, or longer ago than the tier allows; a state without a time is not due."""
    every = F.expr(TIERS[-1][1])
    for n, (_, wait) in reversed([*enumerate(TIERS, 1)][:-1]):
        every = F.when(tier_ == n, F.expr(wait)).otherwise(every)
    return F.coalesce(~has_state | (checked_at < as_of - every), F.lit(False))


def queue(news: DataFrame, as_of: datetime, limit: int, prefixes: list[str] | None = None, share: float = 0.25, horizon: str = "INTERVAL 5 MONTH") -> DataFrame:
    """The next `limit` articles: by tier, never checked first, oldest check first; the first share gets its content checked.

    news: unique_id, published_at, checked_at, has_state, and url columns if prefixes are given.
    """
    at = F.lit(as_of).cast("timestamp_ntz")
    rows = news.where(F.col("published_at") > at - F.expr(horizon)).withColumn("tier", tier(F.col("published_at"), at))
    rows = rows.where(due(F.col("tier"), F.col("has_state"), F.col("checked_at"), at))
    order = [F.col("tier"), F.col("has_state"), F.coalesce("checked_at", F.lit("1970-01-01").cast("timestamp_ntz")), F.col("unique_id")]
    top = rows.orderBy(*order).limit(limit)
    # at most `limit` rows meet here
    place, all_ = F.row_number().over(Window.orderBy(*order)), F.count(F.lit(1)).over(Window.partitionBy())
    out = top.withColumn("place", place).withColumn("check_content", F.col("place") <= F.greatest(F.lit(1), F.floor(all_ * share)))
    if prefixes is not None:
        for c in ("url", "image_url"):
            if c in out.columns:
                out = out.withColumn(c, null_unless_allowed(F.col(c), prefixes))
    return out


def merge_results(state: DataFrame, results: DataFrame, order: str | None = None) -> DataFrame:
    """unique_id, features, now_broken, now_fixed after checks.

    state: unique_id, features; results: unique_id, patch (JSON of the check). Results of one batch
    that repeat an id all see the state before; the last one by `order` counts, or without it by text.
    """
    last = F.max("patch") if order is None else F.max(F.struct(order, "patch"))["patch"]
    one = results.groupBy("unique_id").agg(last.alias("patch"))
    rows = one.join(state, "unique_id", "left")
    count = F.coalesce(jsonx.typed(F.col("features"), "integrity.check_count", "int"), F.lit(0)) + 1
    full = jsonx.merge(F.col("patch"), F.concat(F.lit('{"check_count":'), count.cast("string"), F.lit("}")))
    before, after = (jsonx.typed(F.col(c), p, "string") for c, p in (("features", "integrity.image_status"), ("patch", "image_status")))
    return rows.select("unique_id", jsonx.merge_at(F.col("features"), "integrity", full).alias("features"), F.coalesce(after == "broken", F.lit(False)).alias("now_broken"), F.coalesce((after == "ok") & (before == "broken"), F.lit(False)).alias("now_fixed"))


def thumbnail_backlog(news: DataFrame, features: DataFrame, limit: int) -> DataFrame:
    """Articles with a video, without an image, of which no thumbnail has failed; the newest first."""
    failed = F.coalesce(jsonx.typed(F.col("features"), "thumbnail_failed", "boolean"), F.lit(False))
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    rows = news.where(empty("image_url") & ~empty("video_url")).join(features.select("unique_id", "features"), "unique_id", "left").where(~failed)
    return rows.drop("features").orderBy(F.desc("published_at"), "unique_id").limit(limit)


def thumbnail_status(image_url: Column, video_url: Column, failed: Column) -> Column:
    """Why an article is skipped, or `eligible`."""
    filled = lambda c: F.coalesce(c != "", F.lit(False))
    return F.when(filled(image_url), "has_image").when(~filled(video_url), "no_video").when(F.coalesce(failed, F.lit(False)), "failed_before").otherwise("eligible")
