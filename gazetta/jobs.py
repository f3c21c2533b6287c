"""Jobs over a catalogue of tables: what a scheduler calls, in the order of AFTER.

A job returns one frame, or several by name; the caller stores them. Jobs that write results back
return the whole table after the merge.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions import jsonx
from gazetta.operators import dedup, engagement, facts, features, graph, integrity, search, similarity, stores, trending, trends
from gazetta.sources.catalog import Catalog


def sync_facts(c: Catalog, start: str, end: str | None = None) -> DataFrame:
    """Fact rows of [start, end] days with their day, for sources.catalog.append_days."""
    return facts.fact_table(c.table("news"), c.table("themes"), c.table("news_features"), start, end).withColumn("published_date", F.to_date("published_at"))


def backfill_facts(c: Catalog, start: str, end: str | None = None) -> dict[str, DataFrame]:
    """Fact rows of days that are not loaded yet and complete, and what became of each day."""
    rows = facts.fact_table(c.table("news"), c.table("themes"), c.table("news_features"), start, end)
    fresh, report = facts.missing_days(rows, c.table("fato_noticias"))
    return {"fato_noticias": fresh.withColumn("published_date", F.to_date("published_at")), "days": report}


def sync_dimensions(c: Catalog) -> dict[str, DataFrame]:
    return {"dim_agencies": c.table("agencies"), "dim_themes": c.table("themes")}


def sync_events(c: Catalog, start: datetime, end: datetime) -> dict[str, DataFrame]:
    """Page views and custom events of [start, end) with their sessions."""
    events, sessions = c.table("website_event"), c.table("session")
    return {"umami_pageviews": engagement.pageviews(events, sessions, start, end), "umami_events": engagement.custom_events(events, sessions, c.table("event_data"), start, end)}


def _merged(c: Catalog, patches: DataFrame) -> DataFrame:
    return stores.merge_features(c.table("news_features").select("unique_id", "features"), patches, c.table("news"))


def compute_trending(c: Catalog, as_of: datetime) -> DataFrame:
    """Feature objects with the trending scores of the last day's articles."""
    rows = c.table("fato_noticias").select("unique_id", F.col("theme_l1_code").alias("theme"), "published_at")
    return _merged(c, stores.feature_patches(trending.theme_trending(rows, as_of), "trending_score"))


def aggregate_engagement(c: Catalog, as_of: datetime) -> DataFrame:
    """Feature objects with views and sessions of articles."""
    return _merged(c, stores.feature_patches(engagement.engagement(c.table("umami_pageviews"), as_of=as_of), "view_count", "unique_sessions"))


def similar_articles(c: Catalog, as_of: datetime, days: int = 1, least: float = 0.8, k: int = 5) -> DataFrame:
    """Feature objects with the articles most similar to each one of the last days."""
    from pyspark.sql import Window

    embedded = c.table("news").where("content_embedding is not null").select("unique_id", F.col("content_embedding").alias("vector"), "published_at")
    # similarity works on integer ids: each article's hash, checked to be its own
    rows = embedded.withColumn("id", F.xxhash64("unique_id"))
    clash = F.count(F.lit(1)).over(Window.partitionBy("id"))
    rows = rows.withColumn("id", F.when(clash > 1, F.raise_error(F.lit("two articles have one hash")).cast("long")).otherwise(F.col("id")))
    targets = rows.where(F.col("published_at") >= F.lit(as_of - timedelta(days=days)).cast("timestamp_ntz"))
    pairs = similarity.similar_topk(targets.select("id", "vector"), rows.select("id", "vector"), least, k)
    names = rows.select("id", "unique_id")
    named = pairs.join(names.withColumnsRenamed({"id": "similar_id", "unique_id": "similar"}), "similar_id").join(names.withColumnsRenamed({"id": "target", "unique_id": "name"}), F.col("unique_id") == F.col("target"))
    grouped = similarity.grouped(named.select(F.col("name").alias("unique_id"), F.col("similar").alias("similar_id"), "similarity"))
    return _merged(c, stores.feature_patches(grouped, "similar_articles"))


def _entities(c: Catalog) -> DataFrame:
    own = F.from_json(F.get_json_object("features", "$.entities"), graph.ENTITIES)
    return c.table("news").join(c.table("news_features").select("unique_id", "features"), "unique_id").withColumn("entities", own)


def project_graph(c: Catalog, least: int = 2) -> dict[str, DataFrame]:
    """Mentions and all edges, computed anew."""
    registry = c.table("entity_registry")
    found = graph.mentions(_entities(c), registry)
    pairs = graph.co_mentions(found, least).withColumn("kind", F.lit("co_mention"))
    parent = jsonx.typed(F.col("extra"), "parent_qid", "string")
    built = graph.all_edges(graph.subordinate_by_agency(registry, c.table("agencies")), graph.subordinate_by_parent(registry, parent), graph.is_agency(registry))
    return {"news_entities": found, "entity_edges": graph.all_edges(pairs, graph.unweighted(built))}


def export_graph(c: Catalog) -> dict[str, DataFrame]:
    """The stored graph after a merge of registry and edges."""
    nodes, edges, stale = graph.merge_graph(c.table("graph_nodes"), c.table("graph_edges"), c.table("entity_registry"), graph.export_edges(c.table("entity_edges")))
    return {"graph_nodes": nodes, "graph_edges": edges, "stale_nodes": stale}


def entity_trending(c: Catalog, end: datetime, novelty: bool = False) -> DataFrame:
    """The score table after an upsert of the entities that trend at `end`."""
    news = c.table("news").withColumn("agency", F.col("agency_key"))
    mentioned = c.table("news_entities").select("entity_id", "unique_id", "published_at")
    rows = mentioned.join(news.select("unique_id", "agency"), "unique_id")
    registry = c.table("entity_registry").select("entity_id", "canonical_name", F.col("type").alias("entity_type"))
    start, first = end - timedelta(days=7), end - timedelta(days=35)
    fresh = None
    if novelty:
        at = lambda lo, hi: (F.col("published_at") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("published_at") < F.lit(hi).cast("timestamp_ntz"))
        vectors = mentioned.join(news.select("unique_id", F.col("content_embedding").alias("vector")).where("vector is not null"), "unique_id")
        fresh = similarity.novelty(vectors.where(at(start, end)), vectors.where(at(first, start)), "entity_id")
    stats = trends.with_signals(trends.snapshot(rows, end).join(registry, "entity_id"), graph.new_edges(c.table("entity_edges"), start, end), fresh)
    scored = trends.score(stats.where(trends.passes()), "novelty" if novelty else None)
    old = c.table("entity_trending_scores") if c.has("entity_trending_scores") else scored.select("entity_id", "canonical_name", F.col("entity_type").alias("type"), "trending_score", "volume_ratio", "window_count", "window_agencies", F.lit(end).cast("timestamp_ntz").alias("computed_at")).limit(0)
    return trends.persist(old, scored, F.lit(end).cast("timestamp_ntz"))


def backtest_trends(c: Catalog, end: datetime, points: int = 20, step_days: int = 3) -> dict[str, DataFrame]:
    """NDCG at each of some ends before a date, and their mean."""
    rows = c.table("news_entities").select("entity_id", "unique_id", "published_at").join(c.table("news").select("unique_id", F.col("agency_key").alias("agency")), "unique_id")
    tested = trends.backtest(rows, [end - timedelta(days=step_days * i) for i in range(points)], types=c.table("entity_registry").select("entity_id", F.col("type").alias("entity_type")))
    return {"points": tested, "mean": trends.mean_ndcg(tested)}


def integrity_queue(c: Catalog, as_of: datetime, limit: int = 1000) -> DataFrame:
    state = c.table("news_features").select("unique_id", F.get_json_object("features", "$.integrity").alias("i"))
    rows = c.table("news").join(state, "unique_id", "left").withColumns({"has_state": F.col("i").isNotNull(), "checked_at": F.try_to_timestamp(F.get_json_object("i", "$.image_checked_at")).cast("timestamp_ntz")})
    return integrity.queue(rows, as_of, limit)


def thumbnails(c: Catalog, limit: int = 100) -> DataFrame:
    return integrity.thumbnail_backlog(c.table("news"), c.table("news_features"), limit)


def compute_features(c: Catalog) -> DataFrame:
    """Feature objects with missing and outdated features and annotations; versions come from the table of that name, if there is one."""
    stored = {r.name: r.version for r in c.table("feature_versions").collect()} if c.has("feature_versions", "name", "version") else dict(features.VERSIONS)
    old = c.table("news_features").select("unique_id", "features")
    entities = old.select("unique_id", F.from_json(F.get_json_object("features", "$.entities"), graph.ENTITIES).alias("entities"))
    news = c.table("news").join(entities, "unique_id", "left")
    return stores.merge_features(old, features.recomputed(news, old, stored))


def backfill_features(c: Catalog, start: str, end: str, limit: int = 50_000) -> DataFrame:
    """Feature objects after a backfill of the newest articles of [start, end) that lack the reading ease."""
    return _merged(c, features.window(c.table("news"), c.table("news_features"), start, end, limit=limit))


def recognise_entities(c: Catalog, recognise: Callable[[DataFrame], DataFrame], key: str = "entities") -> DataFrame:
    """Feature objects after a backfill of entities by a given function from articles (without them) to unique_id, features."""
    return _merged(c, recognise(features.missing(c.table("news"), c.table("news_features"), key)))


def canonicalise_entities(c: Catalog) -> DataFrame:
    """Feature objects whose entities carry the id that their name has among the registry's aliases; known ids stay."""
    from gazetta.functions import text

    each = _entities(c).select("unique_id", F.posexplode("entities").alias("i", "e")).withColumn("alias_norm", text.alias_form(F.col("e.text")))
    found = each.join(c.table("entity_aliases").select("alias_norm", F.col("entity_id").alias("found")), "alias_norm", "left")
    own = F.struct("e.text", "e.type", "e.count", F.coalesce("e.canonical_id", "found").alias("canonical_id"), "e.salience")
    grouped = found.groupBy("unique_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", own.alias("e")))), lambda x: x["e"]).alias("entities"))
    return _merged(c, stores.feature_patches(grouped, "entities"))


def sync_search(c: Catalog, start: str, end: str | None = None, mode: str = "incremental", force: bool = False) -> DataFrame:
    """The search table after an import of [start, end] days."""
    rows = facts.search_rows(c.table("news"), c.table("themes"), c.table("news_features"), start, end)
    index = c.table("search_documents") if c.has("search_documents") else None
    return search.import_documents(index, search.documents(rows), mode, force)[0]


def detect_orphans(c: Catalog) -> DataFrame:
    return dedup.orphans(c.table("search_documents").select(F.col("id").alias("unique_id")), c.table("news"), "unique_id")


def delete_orphans(c: Catalog) -> DataFrame:
    """The search table without documents of articles that are gone."""
    return stores.delete(c.table("search_documents"), detect_orphans(c).withColumnRenamed("unique_id", "id"), "id")


JOBS: dict[str, Callable] = {f.__name__: f for f in (
    sync_facts, backfill_facts, sync_dimensions, sync_events, compute_trending, aggregate_engagement, similar_articles, project_graph, export_graph, entity_trending, backtest_trends,
    integrity_queue, thumbnails, compute_features, backfill_features, canonicalise_entities, sync_search, detect_orphans, delete_orphans,
)}
#: Job -> jobs that must have run before.
AFTER = {
    "compute_trending": ["sync_facts"], "aggregate_engagement": ["sync_events"], "project_graph": ["canonicalise_entities"], "export_graph": ["project_graph"], "entity_trending": ["project_graph"], "backtest_trends": ["project_graph"],
    "sync_search": ["compute_features", "compute_trending", "aggregate_engagement"], "detect_orphans": ["sync_search"], "delete_orphans": ["sync_search"],
}
