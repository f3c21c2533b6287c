"""Entity trend detection: a window against its baseline, a score, and its evaluation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FLOOR = 0.001


def snapshot(rows: DataFrame, end: datetime, window_days: int = 7, baseline_days: int = 28, least: int = 3) -> DataFrame:
    """Per entity the articles and agencies of [end - window, end) and of the baseline before, in one pass.

    rows: entity_id, unique_id, agency, published_at. Entities with fewer than `least` articles in
    the window are left out.
    """
    at, ts = F.lit(end).cast("timestamp_ntz"), F.col("published_at")
    start = at - F.expr(f"INTERVAL {window_days} DAY")
    first = at - F.expr(f"INTERVAL {window_days + baseline_days} DAY")
    inside, before = (ts >= start) & (ts < at), (ts >= first) & (ts < start)
    only = lambda when, c: F.countDistinct(F.when(when, F.col(c)))
    out = rows.where((ts >= first) & (ts < at)).groupBy("entity_id").agg(
        only(inside, "unique_id").alias("window_count"), only(before, "unique_id").alias("baseline_count"),
        only(inside, "agency").alias("window_agencies"), only(before, "agency").alias("baseline_agencies"),
    ).where(F.col("window_count") >= least)
    return out.withColumns({"window_daily": F.col("window_count") / float(window_days), "baseline_daily": F.greatest(F.col("baseline_count") / float(baseline_days), F.lit(FLOOR))})


def passes(excluded_types: tuple[str, ...] = ("LOC",), type_column: str | None = "entity_type") -> Column:
    """The hard filters, which are also the label of the back-test."""
    ratio = F.col("window_daily") / F.col("baseline_daily")
    ok = (F.col("window_count") >= 3) & (F.col("window_agencies") > F.col("baseline_agencies")) & (ratio > 1.5) & (F.col("baseline_agencies") <= 20)
    return ok if type_column is None else ok & ~F.col(type_column).isin(*excluded_types)


def score(stats: DataFrame, novelty: str | None = None) -> DataFrame:
    """stats with volume_ratio and trending_score; passes() is to be applied before."""
    ratio = F.col("window_daily") / F.col("baseline_daily")
    agencies = F.col("window_agencies") / F.greatest(F.col("baseline_agencies"), F.lit(1))
    niche = 1 / (1 + F.col("baseline_agencies"))
    fresh = F.coalesce(F.col(novelty), F.lit(0.0)) if novelty else F.lit(0.0)
    return stats.withColumn("volume_ratio", ratio).withColumn("trending_score", 0.40 * ratio + 0.25 * agencies + 0.20 * niche * ratio + 0.15 * fresh)


def with_signals(stats: DataFrame, new_edges: DataFrame | None = None, novelty: DataFrame | None = None) -> DataFrame:
    """stats with new_edge_count (which no score uses) and novelty by entity; 0 where there is none."""
    for frame, name, zero in ((new_edges, "new_edge_count", F.lit(0).cast("long")), (novelty, "novelty", F.lit(0.0))):
        if frame is not None:
            stats = stats.join(frame.select("entity_id", name), "entity_id", "left").withColumn(name, F.coalesce(name, zero))
    return stats


def top(scored: DataFrame, limit: int = 0) -> DataFrame:
    """Scores, largest first; ties by entity."""
    out = scored.orderBy(F.desc("trending_score"), "entity_id")
    return out.limit(limit) if limit else out


def persist(old: DataFrame, scored: DataFrame, at: Column) -> DataFrame:
    """The score table after an upsert; entities without a name are left out, names and types of known ones stay."""
    from .stores import upsert

    named = scored.where(F.coalesce(F.col("canonical_name") != "", F.lit(False)))
    columns = ["entity_id", "canonical_name", "trending_score", "volume_ratio", "window_count", "window_agencies"]
    fresh = named.select(*columns, F.coalesce("entity_type", F.lit("")).alias("type"), at.alias("computed_at"))
    return upsert(old, fresh, "entity_id", keep=("canonical_name", "type"))


def snapshots(rows: DataFrame, ends: list[datetime], window_days: int = 7, baseline_days: int = 28, least: int = 3) -> DataFrame:
    """snapshot() for several ends in one pass, with end_at: each row goes to the few ends that it is near to."""
    stamps = [F.lit(e).cast("timestamp_ntz") for e in ends]
    ts = F.col("published_at")
    near = F.filter(F.array(*stamps), lambda e: (ts < e) & (ts >= e - F.expr(f"INTERVAL {window_days + baseline_days} DAY")))
    each = rows.withColumn("end_at", F.explode(near))
    inside = ts >= F.col("end_at") - F.expr(f"INTERVAL {window_days} DAY")
    only = lambda when, c: F.countDistinct(F.when(when, F.col(c)))
    out = each.groupBy("end_at", "entity_id").agg(
        only(inside, "unique_id").alias("window_count"), only(~inside, "unique_id").alias("baseline_count"),
        only(inside, "agency").alias("window_agencies"), only(~inside, "agency").alias("baseline_agencies"),
    ).where(F.col("window_count") >= least)
    return out.withColumns({"window_daily": F.col("window_count") / float(window_days), "baseline_daily": F.greatest(F.col("baseline_count") / float(baseline_days), F.lit(FLOOR))})


def ndcg_with_ties(rows: DataFrame, group: str, score_: str, relevance: str, k: int = 10) -> DataFrame:
    """group, ndcg at k, where rows of equal score share the mean of the gains of their places."""
    def gained(by: str, name: str) -> DataFrame:
        ties = rows.groupBy(group, by).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(relevance).cast("double")).alias("mean"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        ranked = ties.withColumn("lo", before + 1).where(F.col("lo") <= k)
        last = F.least(F.col("lo") + F.col("n") - 1, F.lit(k))
        discount = F.aggregate(F.sequence("lo", last), F.lit(0.0), lambda s, r: s + 1 / F.log2(r + 1))
        return ranked.groupBy(group).agg(F.sum(F.col("mean") * discount).alias(name))

    out = gained(score_, "dcg").join(gained(relevance, "ideal"), group)
    return out.select(group, F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")).otherwise(F.lit(0.0)).alias("ndcg"))


def backtest(rows: DataFrame, ends: list[datetime], window_days: int = 7, baseline_days: int = 28, types: DataFrame | None = None) -> DataFrame:
    """end_at, positives, ndcg of the scorer at each end against the hard filters as labels; ends without entities are left out.

    types: entity_id, entity_type. Entities that pass no filter score 0.
    """
    stats = snapshots(rows, ends, window_days, baseline_days)
    if types is not None:
        stats = stats.join(types.select("entity_id", "entity_type"), "entity_id")
    label = F.coalesce(passes(type_column=None if types is None else "entity_type"), F.lit(False))
    scored = score(stats).withColumn("label", label.cast("int")).withColumn("s", F.when(label, F.col("trending_score")).otherwise(F.lit(0.0)))
    counts = scored.groupBy("end_at").agg(F.sum("label").alias("positives"))
    return counts.join(ndcg_with_ties(scored, "end_at", "s", "label"), "end_at")


def mean_ndcg(tested: DataFrame) -> DataFrame:
    """points, positives and ndcg: the means over all ends of a back-test."""
    return tested.agg(F.count(F.lit(1)).alias("points"), F.avg("positives").alias("positives"), F.avg("ndcg").alias("ndcg"))


def ndcg(rows: DataFrame, group: str, rank_by: list[Column], relevance: str, k: int = 10) -> DataFrame:
    """group, dcg, ideal, ndcg at k."""
    def gained(order: list[Column], name: str) -> DataFrame:
        ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("r") <= k)
        return ranked.groupBy(group).agg(F.sum(F.col(relevance) / F.log2(F.col("r") + 1)).alias(name))

    out = gained(rank_by, "dcg").join(gained([F.desc(relevance)], "ideal"), group)
    return out.withColumn("ndcg", F.when(F.col("ideal") > 0, F.col("dcg") / F.col("ideal")).otherwise(F.lit(0.0)))
