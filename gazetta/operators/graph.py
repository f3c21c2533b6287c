"""The entity graph: mentions, co-mention and structural edges, and look-ups in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions.dates import iso_text

ENTITIES = "array<struct<text:string,type:string,count:int,canonical_id:string,salience:float>>"


def mentions(news: DataFrame, registry: DataFrame) -> DataFrame:
    """unique_id, entity_id, type, count, salience, published_at; news: unique_id, published_at, entities (array of structs)."""
    each = news.select("unique_id", "published_at", F.explode("entities").alias("e")).where("e.canonical_id is not null")
    known = each.join(registry.select(F.col("entity_id").alias("known")), F.col("e.canonical_id") == F.col("known"), "left_semi")
    return known.groupBy("unique_id", F.col("e.canonical_id").alias("entity_id"), "published_at").agg(
        F.max("e.type").alias("type"), F.sum(F.coalesce("e.count", F.lit(1))).cast("int").alias("count"), F.max("e.salience").alias("salience")
    )


#: Entities of one article of which one task forms all pairs; more are split.
ENTITIES_AT_ONCE = 1024
#: Parts that the entities of such an article are dealt out to.
PARTS = 64


def co_mentions(rows: DataFrame, least: int = 2) -> DataFrame:
    """src_id < dst_id, weight, article_count, first_seen, last_seen of entities in the same article.

    rows: unique_id, entity_id, published_at. An article's entities meet in one row, whose pairs are
    formed in place; those of an article with more than ENTITIES_AT_ONCE are dealt out by parts,
    and the pairs of two parts are one row.
    """
    one = rows.where("entity_id is not null").groupBy("unique_id", "entity_id").agg(F.min("published_at").alias("lo"), F.max("published_at").alias("hi"))
    entity = F.struct(F.col("entity_id").alias("e"), "lo", "hi")
    articles = one.groupBy("unique_id").agg(F.array_sort(F.collect_list(entity)).alias("es"))
    whole, part = articles.where(F.size("es") <= ENTITIES_AT_ONCE), lambda e: F.pmod(F.xxhash64(e), F.lit(PARTS))
    few = whole.select("es", F.posexplode("es").alias("i", "a")).select("a", F.explode(F.slice("es", F.col("i") + 2, F.size("es"))).alias("b"))
    parts = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda k: F.struct(F.filter("es", lambda x: part(x["e"]) == k).alias("es")))
    many = articles.where(F.size("es") > ENTITIES_AT_ONCE).select(parts.alias("ps")).select("ps", F.posexplode("ps").alias("i", "p"))
    met = many.select(F.col("p.es").alias("es"), F.explode(F.slice("ps", F.col("i") + 1, F.size("ps"))).alias("q")).repartition(F.xxhash64("q.es", "es"))
    crossed = met.select(F.explode("es").alias("x"), F.col("q.es").alias("others")).select("x", F.explode("others").alias("y"))
    # pairs within one part come from its meeting with itself, both ways round
    ordered = crossed.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "x", "y")
    same = part(F.col("x.e")) == part(F.col("y.e"))
    more = ordered.where("a.e <> b.e").where(~same | (F.col("x") == F.col("a"))).select("a", "b")
    pairs = few.unionByName(more)
    # one row for each (article, pair), so a count is a count of distinct articles
    out = pairs.groupBy(F.col("a.e").alias("src_id"), F.col("b.e").alias("dst_id")).agg(F.count(F.lit(1)).alias("weight"), F.min("a.lo").alias("first_seen"), F.max("a.hi").alias("last_seen"))
    return out.where(F.col("weight") >= least).select("src_id", "dst_id", "weight", F.col("weight").alias("article_count"), "first_seen", "last_seen")


def structural(child_of: DataFrame, kind: str) -> DataFrame:
    """Edges (src_id, dst_id, kind) without loops and repeats; child_of: src_id, dst_id."""
    return child_of.where("src_id <> dst_id").select("src_id", "dst_id", F.lit(kind).alias("kind")).distinct()


def unweighted(edges: DataFrame) -> DataFrame:
    """Structural edges as they are stored: weights of 0, never seen."""
    never = F.lit(None).cast("timestamp_ntz")
    return edges.withColumns({"weight": F.lit(0).cast("long"), "article_count": F.lit(0).cast("long"), "first_seen": never, "last_seen": never})


def is_agency(registry: DataFrame) -> DataFrame:
    """Organisations and the seeded entity of their agency; registry: entity_id, type, agency_key, provenance."""
    own = registry.where("type = 'ORG' and agency_key is not null").select(F.col("entity_id").alias("src_id"), "agency_key")
    seed = registry.where("provenance = 'agencies_seed'").select(F.col("entity_id").alias("dst_id"), "agency_key")
    return structural(own.join(seed, "agency_key"), "is_agency")


def rebuilt(edges: DataFrame, fresh: DataFrame, *kinds: str) -> DataFrame:
    """The edge table after all edges of some kinds have been replaced."""
    return all_edges(edges.where(~F.col("kind").isin(*kinds)), fresh.where(F.col("kind").isin(*kinds)))


def new_edges(edges: DataFrame, start, end) -> DataFrame:
    """entity_id, new_edge_count: co-mention edges first seen in [start, end)."""
    at = F.col("first_seen")
    inside = edges.where((F.col("kind") == "co_mention") & (at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(end).cast("timestamp_ntz")))
    return degrees(inside).withColumnRenamed("edges", "new_edge_count")


def subordinate_by_agency(registry: DataFrame, agencies: DataFrame) -> DataFrame:
    """Organisations below the organisation of their agency's parent."""
    own = registry.where("agency_key is not null").select("agency_key", F.col("entity_id").alias("src_id"))
    up = registry.where("agency_key is not null").select(F.col("agency_key").alias("parent_key"), F.col("entity_id").alias("dst_id"))
    tree = agencies.where("parent_key is not null").select(F.col("key").alias("agency_key"), "parent_key")
    return structural(tree.join(own, "agency_key").join(up, "parent_key"), "subordinate_to")


def subordinate_by_parent(registry: DataFrame, parent: Column) -> DataFrame:
    """Entities below the entity that a JSON field names."""
    up = registry.select(F.col("entity_id").alias("dst_id"))
    return structural(registry.select(F.col("entity_id").alias("src_id"), parent.alias("up")).join(up, F.col("up") == F.col("dst_id")), "subordinate_to")


def all_edges(*frames: DataFrame) -> DataFrame:
    """Edges of all frames, each (src_id, dst_id, kind) once."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.dropDuplicates(["src_id", "dst_id", "kind"])


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("src_id", "dst_id", "weight").unionByName(edges.select(F.col("dst_id").alias("src_id"), F.col("src_id").alias("dst_id"), "weight"))


def related(edges: DataFrame, entity, limit: int = 0) -> DataFrame:
    """entity_id, weight of the direct neighbours; with a limit the heaviest, ties by id."""
    out = both_ways(edges).where(F.col("src_id") == entity).groupBy(F.col("dst_id").alias("entity_id")).agg(F.max("weight").alias("weight"))
    return out.orderBy(F.desc("weight"), "entity_id").limit(limit) if limit else out


def network(edges: DataFrame, entity, depth: int = 2) -> DataFrame:
    """entity_id, depth of all entities within `depth` edges."""
    ways = both_ways(edges).select("src_id", "dst_id")
    reach = ways.where(F.col("src_id") == entity).select(F.col("src_id").alias("entity_id"), F.lit(0).alias("depth")).distinct()
    edge = reach
    for step in range(1, depth + 1):
        edge = edge.join(ways, edge["entity_id"] == ways["src_id"]).select(F.col("dst_id").alias("entity_id"), F.lit(step).alias("depth")).distinct()
        reach = reach.unionByName(edge)
    return reach.groupBy("entity_id").agg(F.min("depth").alias("depth"))


def degrees(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src_id", "dst_id")).alias("entity_id")).groupBy("entity_id").agg(F.count(F.lit(1)).alias("edges"))


# Names of relationships in the graph export; other kinds are skipped.
RELATIONS = {"co_mention": "CO_MENTIONED", "subordinate_to": "SUBORDINATE_TO", "is_agency": "IS_AGENCY"}


def export_edges(edges: DataFrame) -> DataFrame:
    """Edges with the name of their relationship, dates as ISO text; edges of unknown kind are left out."""
    names = F.create_map(*[F.lit(x) for pair in RELATIONS.items() for x in pair])
    named = edges.withColumn("relation", F.try_element_at(names, F.col("kind"))).where("relation is not null")
    return named.withColumns({c: iso_text(F.col(c)) for c in ("first_seen", "last_seen") if c in edges.columns})


def export_nodes(registry: DataFrame) -> DataFrame:
    """The nodes of the graph: entity_id, name, type, wikidata_id, agency_key."""
    return registry.select("entity_id", F.col("canonical_name").alias("name"), "type", "wikidata_id", "agency_key")


def merge_graph(nodes: DataFrame, edges: DataFrame, registry: DataFrame, exported: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, stale nodes) of a stored graph after an export.

    Nodes and edges are upserted; edges need both ends. Nodes that the registry lacks are stale and go with
    their edges, but nothing goes if the registry is empty: an empty read must never clear the graph.
    """
    from .stores import upsert

    fresh = export_nodes(registry)
    all_nodes = upsert(nodes, fresh, "entity_id")
    stale = nodes.join(fresh.select("entity_id"), "entity_id", "left_anti")
    if fresh.isEmpty():
        stale = stale.limit(0)
    kept = all_nodes.join(stale.select("entity_id"), "entity_id", "left_anti")
    keys = ["src_id", "dst_id", "relation"]
    joined = exported.drop("kind").unionByName(edges.join(exported.select(*keys), keys, "left_anti"), allowMissingColumns=True)
    for end in ("src_id", "dst_id"):
        joined = joined.join(kept.select(F.col("entity_id").alias(end)), end, "left_semi")
    return kept, joined, stale
