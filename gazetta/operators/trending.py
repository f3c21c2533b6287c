"""Rolling topic volume against its weekly mean."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions.dates import epoch

from .rolling import rolling_counts

DAY_S = 86_400


def theme_trending(articles: DataFrame, as_of: datetime) -> DataFrame:
    """unique_id, theme, published_at, volume_24h, daily_mean_7d, trending_score of the last 24 hours.

    articles: unique_id, theme (null is a theme of its own), published_at. Windows reach back from
    each article, bounds and equal seconds included.
    """
    at = F.lit(as_of).cast("timestamp_ntz")
    recent = articles.where(F.col("published_at") >= at - F.expr("INTERVAL 7 DAY")).select("unique_id", "theme", "published_at", epoch(F.col("published_at")).alias("s"))
    volumes = rolling_counts(recent, "theme", "s", {"volume_24h": DAY_S, "volume_7d": 7 * DAY_S})
    last_day = recent.where(F.col("published_at") >= at - F.expr("INTERVAL 24 HOUR"))
    counted = last_day.join(volumes.withColumnRenamed("theme", "t"), F.col("theme").eqNullSafe(F.col("t")) & (last_day["s"] == volumes["s"]))
    mean = F.col("volume_7d") / F.lit(7.0)
    score = F.when(mean > 0, F.round(F.col("volume_24h") / mean, 3)).otherwise(F.lit(0.0))
    return counted.select("unique_id", "theme", "published_at", "volume_24h", mean.alias("daily_mean_7d"), score.alias("trending_score"))
