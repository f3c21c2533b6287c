"""Queries of the larger compositions: searches, facts, graph, trends and stores over stand-in tables.

Orders stand in for articles (with made-up agency and theme ids), nations for themes and agencies.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions import jsonx
from gazetta.operators import dedup, engagement, facts, features, graph, search, similarity, stores, trends, validate
from gazetta.plans.registry import newest, query
from gazetta.sources import catalog


def _news(t) -> DataFrame:
    key, custkey = F.col("o_orderkey"), F.col("o_custkey")
    return t("orders").select(
        key.cast("string").alias("unique_id"), F.concat(F.lit(" "), F.col("o_orderpriority")).alias("title"), F.col("o_orderdate").alias("published_at"),
        (custkey % 25).cast("int").alias("agency_id"), F.concat(F.lit("N"), (custkey % 25).cast("string")).alias("agency_key"), F.when(key % 4 == 0, "x").alias("image_url"),
        F.when(key % 9 != 0, F.col("o_orderstatus")).alias("content_hash"),
        *(((key + n) % m).cast("int").alias(f"theme_l{n}_id") for n, m in ((1, 30), (2, 40), (3, 50))), (key % 27).cast("int").alias("most_specific_theme_id"),
    )


def _themes(t) -> DataFrame:
    return t("nation").select(F.col("n_nationkey").alias("id"), F.concat(F.lit("T"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("label"))


def _agencies(t) -> DataFrame:
    parent = F.when(F.col("n_nationkey") % 3 != 0, F.concat(F.lit("N"), (F.floor(F.col("n_nationkey") / 3) * 3).cast("string")))
    return t("nation").select(F.col("n_nationkey").alias("id"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("key"), F.col("n_name").alias("name"), parent.alias("parent_key"))


def _features(t) -> DataFrame:
    own = F.struct(
        F.struct((F.col("o_orderkey") % 10 / 10.0).alias("score"), F.col("o_orderstatus").alias("label")).alias("sentiment"), (F.col("o_orderkey") % 500).alias("word_count"),
        (F.col("o_orderkey") % 2 == 0).alias("has_image"), F.when(F.col("o_orderkey") % 5 == 0, F.col("o_custkey")).alias("view_count"),
    )
    return t("orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("string").alias("unique_id"), F.to_json(own).alias("features"))


_NEWS = """
WITH n AS (SELECT o_orderkey AS k, o_orderkey::varchar AS unique_id, ' ' || o_orderpriority AS title, o_orderdate AS published_at, o_custkey % 25 AS agency_id, 'N' || (o_custkey % 25) AS agency_key,
  CASE WHEN o_orderkey % 4 = 0 THEN 'x' END AS image_url, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus END AS content_hash, (o_orderkey + 1) % 30 AS l1, (o_orderkey + 2) % 40 AS l2, (o_orderkey + 3) % 50 AS l3,
  o_orderkey % 27 AS tm, o_orderkey % 3 = 0 AS f, o_orderstatus, o_custkey FROM orders),
th AS (SELECT n_nationkey AS id, 'T' || n_nationkey AS code, n_name AS label FROM nation),
ag AS (SELECT n_nationkey AS id, 'N' || n_nationkey AS key, n_name AS name, CASE WHEN n_nationkey % 3 <> 0 THEN 'N' || (n_nationkey // 3 * 3) END AS parent_key FROM nation)
"""
_JOINS = "LEFT JOIN th t1 ON t1.id = l1 LEFT JOIN th t2 ON t2.id = l2 LEFT JOIN th t3 ON t3.id = l3 LEFT JOIN th tm ON tm.id = n.tm"
_IN_MAY = "published_at >= TIMESTAMP '1997-05-01' AND published_at < TIMESTAMP '1997-06-01'"


# ---- searches, facts, archive

@query(_NEWS + f"""
SELECT unique_id AS id, agency_key AS agency, trim(title) AS title, cast(epoch(published_at) AS bigint) AS published_at, cast(year(published_at) AS integer) AS published_year, cast(month(published_at) AS integer) AS published_month,
  image_url AS image, t1.code AS theme_1_level_1_code, t2.label AS theme_1_level_2_label, t3.code AS theme_1_level_3_code, tm.code AS most_specific_theme_code, tm.label AS most_specific_theme_label,
  CASE WHEN f THEN o_orderstatus END AS sentiment_label, CASE WHEN f THEN k % 10 / 10.0::double END AS sentiment_score, CASE WHEN f AND k % 500 > 0 THEN cast(k % 500 AS bigint) END AS word_count,
  CASE WHEN f THEN k % 2 = 0 END AS has_image, CASE WHEN f AND k % 5 = 0 AND o_custkey > 0 THEN o_custkey END AS view_count
FROM n {_JOINS} WHERE {_IN_MAY}""")
def search_star_join(t) -> DataFrame:
    docs = search.documents(facts.search_rows(_news(t), _themes(t), _features(t), "1997-05-01", "1997-05-31"))
    return docs.select("id", "agency", "title", "published_at", "published_year", "published_month", "image", "theme_1_level_1_code", "theme_1_level_2_label", "theme_1_level_3_code", "most_specific_theme_code", "most_specific_theme_label", "sentiment_label", "sentiment_score", "word_count", "has_image", "view_count")


@query(_NEWS + f"""
SELECT unique_id, title, content_hash, agency_key, t1.code AS theme_l1_code, t1.label AS theme_l1_label, t2.code AS theme_l2_code, tm.code AS most_specific_theme_code, tm.label AS most_specific_theme_label,
  published_at, TIMESTAMP '2024-01-01' AS synced_at, CASE WHEN f THEN cast(k % 500 AS integer) END AS word_count, CASE WHEN f THEN k % 2 = 0 END AS has_image, CASE WHEN f THEN k % 10 / 10.0::double END AS sentiment_score,
  25 AS n_columns FROM n {_JOINS} WHERE {_IN_MAY}""")
def fact_rows(t) -> DataFrame:
    rows = facts.fact_table(_news(t), _themes(t), _features(t), "1997-05-01", "1997-05-31", F.lit("2024-01-01").cast("timestamp_ntz"))
    names = ["unique_id", "title", "content_hash", "agency_key", "theme_l1_code", "theme_l1_label", "theme_l2_code", "most_specific_theme_code", "most_specific_theme_label", "published_at", "synced_at", "word_count", "has_image", "sentiment_score"]
    return rows.select(*names, F.lit(len(rows.columns)).alias("n_columns"))


@query(_NEWS + f"""
SELECT unique_id, ag.key AS agency_key_joined, ag.name AS agency_name_joined, t1.label AS theme_l1_label, t3.code AS theme_l3_code, tm.code AS most_specific_theme_code
FROM n LEFT JOIN ag ON ag.id = agency_id {_JOINS} WHERE {_IN_MAY}""")
def bronze_join(t) -> DataFrame:
    news = catalog.by_days(_news(t), "published_at", "1997-05-01", "1997-05-31")
    return facts.bronze_rows(news, _agencies(t), _themes(t)).select("unique_id", "agency_key_joined", "agency_name_joined", "theme_l1_label", "theme_l3_code", "most_specific_theme_code")


@query(_NEWS + f"""
, d AS (SELECT cast(published_at AS date) AS day, count(*) AS n, count(content_hash) AS good FROM n WHERE {_IN_MAY} GROUP BY 1)
SELECT day, CASE WHEN day(day) % 3 = 0 THEN 'loaded' WHEN good < n THEN 'failed' ELSE 'new' END AS status, n FROM d""")
def backfill_days(t) -> DataFrame:
    news = catalog.by_days(_news(t), "published_at", "1997-05-01", "1997-05-31")
    return facts.missing_days(news, news.where("day(published_at) % 3 = 0"))[1]


@query(_NEWS + """
SELECT unique_id AS id, unique_id, agency_key, trim(title) AS title, image_url, cast(epoch(published_at) AS bigint) AS published_at, cast(year(published_at) AS integer) AS published_year, cast(month(published_at) AS integer) AS published_month FROM n""")
def alternate_documents(t) -> DataFrame:
    return search.alternate_documents(_news(t).drop("content_hash"))


@query(r"""
WITH m AS (SELECT doc_id, CAST(regexp_matches(lower(text), '(^|[^a-z0-9])the([^a-z0-9]|$)') AS integer) AS a, CAST(regexp_matches(lower(text), '(^|[^a-z0-9])of([^a-z0-9]|$)') AS integer) AS b, source FROM documents)
SELECT doc_id, 1.0::double * (a + b) AS score FROM m WHERE a + b = 2 ORDER BY score DESC, doc_id LIMIT 15""")
def ranked_search(t) -> DataFrame:
    return search.ranked(t("documents"), ["the", "of"], {"text": 1.0}, F.col("doc_id"), limit=15).select("doc_id", "score")


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '(^|[^a-z0-9])licen')")
def prefix_search(t) -> DataFrame:
    return search.matching(t("documents"), ["licen"], "text", prefix=True).select("doc_id")


@query(r"""
SELECT doc_id FROM documents WHERE regexp_matches(lower(text), '(^|[^a-z0-9])licenses?([^a-z0-9]|$)') AND regexp_matches(lower(text), '(^|[^a-z0-9])softwares?([^a-z0-9]|$)')""")
def stemmed_search(t) -> DataFrame:
    return search.matching_stems(t("documents"), "licenses para softwares", "text").select("doc_id")


@query("""
SELECT 'trending_score' AS mode, p_partkey AS id, place FROM (SELECT *, row_number() OVER (ORDER BY p_size DESC NULLS LAST, p_partkey) AS place FROM part) WHERE place <= 10
UNION ALL SELECT 'view_count', p_partkey, place FROM (SELECT *, row_number() OVER (ORDER BY CASE WHEN p_partkey % 2 = 0 THEN p_retailprice END DESC NULLS LAST, p_partkey) AS place FROM part) WHERE place <= 10""")
def sort_modes(t) -> DataFrame:
    rows = t("part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("trending_score"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_retailprice")).alias("view_count"))
    out = [search.sorted_by(rows, mode, limit=10).withColumn("mode", F.lit(mode)) for mode in ("trending_score", "view_count")]
    numbered = [dedup.keep_first(df, ["mode"], F.desc_nulls_last(m), F.col("id")) for df, m in zip(out, ("trending_score", "view_count"), strict=True)]
    return numbered[0].unionByName(numbered[1]).select("mode", "id", "place")


@query("""
SELECT o_orderkey AS unique_id, o_orderdate AS published_at FROM orders, (SELECT max(o_orderdate) AS m FROM orders) WHERE o_custkey % 25 = 7 AND o_orderdate >= m - INTERVAL 30 DAY ORDER BY o_orderdate DESC, o_orderkey""")
def agency_last_30_days(t) -> DataFrame:
    orders = t("orders")
    recent = orders.where((F.col("o_custkey") % 25 == 7) & (F.col("o_orderdate") >= F.lit(newest(orders, "o_orderdate") - timedelta(days=30)).cast("timestamp_ntz")))
    return recent.orderBy(F.desc("o_orderdate"), "o_orderkey").select(F.col("o_orderkey").alias("unique_id"), F.col("o_orderdate").alias("published_at"))


# ---- graph

_REGISTRY = """
WITH er AS (SELECT 's' || s_suppkey AS entity_id, CASE WHEN s_acctbal > 0 THEN 'ORG' ELSE 'PER' END AS type, CASE WHEN s_suppkey % 7 <> 0 THEN 'N' || s_nationkey END AS agency_key,
  CASE WHEN s_suppkey % 4 = 0 THEN 'agencies_seed' ELSE 'found' END AS provenance, CASE WHEN s_suppkey % 5 = 0 THEN 's' || (s_suppkey // 2) END AS parent FROM supplier),
ag AS (SELECT 'N' || n_nationkey AS key, CASE WHEN n_nationkey % 3 <> 0 THEN 'N' || (n_nationkey // 3 * 3) END AS parent_key FROM nation)
"""


def _registry(t) -> DataFrame:
    parent = F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("s"), F.floor(F.col("s_suppkey") / 2).cast("string")))
    return t("supplier").select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("entity_id"), F.col("s_name").alias("canonical_name"), F.when(F.col("s_acctbal") > 0, "ORG").otherwise("PER").alias("type"),
        F.when(F.col("s_suppkey") % 7 != 0, F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))).alias("agency_key"), F.when(F.col("s_suppkey") % 4 == 0, "agencies_seed").otherwise("found").alias("provenance"),
        F.lit(None).cast("string").alias("wikidata_id"), F.to_json(F.struct(parent.alias("parent_qid"))).alias("extra"),
    )


@query(_REGISTRY + """
, e AS (SELECT DISTINCT o.entity_id AS src_id, a.entity_id AS dst_id, 'is_agency' AS kind FROM er o JOIN er a ON a.agency_key = o.agency_key AND a.provenance = 'agencies_seed' WHERE o.type = 'ORG' AND o.entity_id <> a.entity_id
UNION SELECT DISTINCT c.entity_id, p.entity_id, 'subordinate_to' FROM ag JOIN er c ON c.agency_key = ag.key JOIN er p ON p.agency_key = ag.parent_key WHERE c.entity_id <> p.entity_id
UNION SELECT DISTINCT c.entity_id, p.entity_id, 'subordinate_to' FROM er c JOIN er p ON p.entity_id = c.parent WHERE c.entity_id <> p.entity_id)
SELECT *, 0::bigint AS weight, 0::bigint AS article_count, NULL::timestamp AS first_seen FROM e""")
def registry_edges(t) -> DataFrame:
    registry = _registry(t)
    built = graph.all_edges(graph.is_agency(registry), graph.subordinate_by_agency(registry, _agencies(t)), graph.subordinate_by_parent(registry, jsonx.typed(F.col("extra"), "parent_qid", "string")))
    return graph.unweighted(built).select("src_id", "dst_id", "kind", "weight", "article_count", "first_seen")


@query("""
WITH old AS (SELECT 's' || s_suppkey AS entity_id, 'old' AS name FROM supplier WHERE s_suppkey % 2 = 0), new AS (SELECT 's' || s_suppkey AS entity_id, s_name AS name FROM supplier WHERE s_suppkey % 3 <> 1)
SELECT 'node' AS what, entity_id, name FROM new UNION ALL SELECT 'stale', entity_id, name FROM old WHERE entity_id NOT IN (SELECT entity_id FROM new)
UNION ALL SELECT 'edge', a.entity_id, 'r' || n_nationkey FROM new a JOIN nation ON a.entity_id = 's' || n_nationkey JOIN new b ON b.entity_id = 's' || (n_nationkey + 1)""")
def graph_merge(t) -> DataFrame:
    name = lambda c: F.concat(F.lit("s"), c.cast("string"))
    registry = _registry(t).join(t("supplier").where("s_suppkey % 3 <> 1").select(name(F.col("s_suppkey")).alias("entity_id")), "entity_id", "left_semi")
    old = t("supplier").where("s_suppkey % 2 = 0").select(name(F.col("s_suppkey")).alias("entity_id"), F.lit("old").alias("name"), *(F.lit(None).cast("string").alias(c) for c in ("type", "wikidata_id", "agency_key")))
    n = F.col("n_nationkey")
    ends = t("nation").select(name(n).alias("src_id"), name(n + 1).alias("dst_id"), F.concat(F.lit("r"), n.cast("string")).alias("relation"))
    nodes, edges, stale = graph.merge_graph(old, ends.limit(0), registry, ends)
    out = [df.select(F.lit(what).alias("what"), "entity_id", "name") for what, df in (("node", nodes), ("stale", stale), ("edge", edges.select(F.col("src_id").alias("entity_id"), F.col("relation").alias("name"))))]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("""
WITH e AS (SELECT l_suppkey AS a, l_partkey AS b, min(l_shipdate) AS first_at FROM lineitem GROUP BY ALL), i AS (SELECT * FROM e WHERE first_at >= TIMESTAMP '1998-03-01' AND first_at < TIMESTAMP '1998-04-01')
SELECT entity_id, count(*) AS new_edge_count FROM (SELECT 's' || a AS entity_id FROM i UNION ALL SELECT 'p' || b FROM i) GROUP BY 1""")
def new_edges(t) -> DataFrame:
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    edges = t("lineitem").groupBy(name("s", "l_suppkey").alias("src_id"), name("p", "l_partkey").alias("dst_id")).agg(F.min("l_shipdate").alias("first_seen")).withColumn("kind", F.lit("co_mention"))
    return graph.new_edges(edges, datetime(1998, 3, 1), datetime(1998, 4, 1))


@query("""
WITH e AS (SELECT n_nationkey AS src_id, n_regionkey AS dst_id, CASE WHEN n_nationkey % 2 = 0 THEN 'a' ELSE 'b' END AS kind FROM nation)
SELECT src_id, dst_id, kind FROM e WHERE kind = 'b' UNION SELECT src_id + 100, dst_id, 'a' FROM e WHERE src_id < 5""")
def rebuild_by_kind(t) -> DataFrame:
    edges = t("nation").select(F.col("n_nationkey").alias("src_id"), F.col("n_regionkey").alias("dst_id"), F.when(F.col("n_nationkey") % 2 == 0, "a").otherwise("b").alias("kind"))
    fresh = edges.where("src_id < 5").select((F.col("src_id") + 100).alias("src_id"), "dst_id", F.lit("a").alias("kind"))
    return graph.rebuilt(edges, fresh, "a")


# ---- trends

_ENDS = [datetime(1998, 6, 1) - timedelta(days=9 * i) for i in range(5)]


@query("""
WITH r AS (SELECT l_suppkey AS entity_id, l_orderkey AS u, o_custkey % 25 AS agency, o_orderdate AS ts FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
e AS (SELECT TIMESTAMP '1998-06-01' - to_days(cast(9 * i AS integer)) AS e FROM range(5) AS x(i)),
s AS (SELECT e, entity_id, count(DISTINCT u) FILTER (ts >= e - INTERVAL 14 DAY) AS wc, count(DISTINCT u) FILTER (ts < e - INTERVAL 14 DAY) AS bc,
  count(DISTINCT agency) FILTER (ts >= e - INTERVAL 14 DAY) AS wa, count(DISTINCT agency) FILTER (ts < e - INTERVAL 14 DAY) AS ba FROM r, e WHERE ts >= e - INTERVAL 35 DAY AND ts < e GROUP BY 1, 2),
d AS (SELECT *, (wc / 14.0::double) / greatest(bc / 21.0::double, 0.001::double) AS v FROM s WHERE wc >= 3),
l AS (SELECT *, cast(wa > ba AND v > 1.5 AND ba <= 20 AS integer) AS label FROM d),
k AS (SELECT *, CASE WHEN label = 1 THEN 0.40::double * v + 0.25::double * wa / greatest(ba, 1) + 0.20::double * v / (1 + ba) ELSE 0 END AS sc FROM l),
p AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY sc DESC) AS a, row_number() OVER (PARTITION BY e ORDER BY label DESC) AS b FROM k),
g AS (SELECT *, avg(CASE WHEN a <= 10 THEN 1 / log2(a + 1) ELSE 0 END) OVER (PARTITION BY e, sc) AS da FROM p)
SELECT e AS end_at, sum(label)::bigint AS positives, round(CASE WHEN sum(label) > 0 THEN sum(label * da) / sum(label / log2(b + 1)) FILTER (b <= 10) ELSE 0 END, 6) AS ndcg FROM g GROUP BY e""")
def trend_backtest(t) -> DataFrame:
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_suppkey").alias("entity_id"), F.col("l_orderkey").alias("unique_id"), (F.col("o_custkey") % 25).alias("agency"), F.col("o_orderdate").alias("published_at"))
    return trends.backtest(rows, _ENDS, window_days=14, baseline_days=21).withColumn("ndcg", F.round("ndcg", 6))


@query("""
WITH j AS (SELECT lang, n_chars // 400 AS s, quality::double AS q FROM documents JOIN labels USING (doc_id) WHERE lang IS NOT NULL),
a AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY s DESC) AS r, row_number() OVER (PARTITION BY lang ORDER BY q DESC) AS i FROM j),
b AS (SELECT *, avg(CASE WHEN r <= 10 THEN 1 / log2(r + 1) ELSE 0 END) OVER (PARTITION BY lang, s) AS d FROM a)
SELECT lang, round(CASE WHEN sum(q) > 0 THEN sum(q * d) / sum(q / log2(i + 1)) FILTER (i <= 10) ELSE 0 END, 6) AS ndcg FROM b GROUP BY lang""")
def ndcg_of_ties(t) -> DataFrame:
    rows = t("documents").join(t("labels"), "doc_id").where("lang is not null").withColumn("s", F.floor(F.col("n_chars") / 400))
    return trends.ndcg_with_ties(rows, "lang", "s", "quality").withColumn("ndcg", F.round("ndcg", 6))


@query("""
WITH o AS (SELECT s_suppkey AS entity_id, 'old' AS canonical_name, 'OLD' AS type, 1.0::double AS trending_score FROM supplier WHERE s_suppkey % 2 = 0),
n AS (SELECT s_suppkey AS entity_id, s_name AS canonical_name, s_acctbal AS trending_score FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 5 <> 0)
SELECT coalesce(o.entity_id, n.entity_id) AS entity_id, coalesce(o.canonical_name, n.canonical_name) AS canonical_name, coalesce(o.type, '') AS type, coalesce(n.trending_score, o.trending_score) AS trending_score
FROM o FULL JOIN n ON o.entity_id = n.entity_id""")
def trend_upsert(t) -> DataFrame:
    rows = t("supplier").select(F.col("s_suppkey").alias("entity_id"), F.when(F.col("s_suppkey") % 5 != 0, F.col("s_name")).alias("canonical_name"), F.lit(None).cast("string").alias("entity_type"), F.col("s_acctbal").alias("trending_score"), *(F.lit(1).alias(c) for c in ("volume_ratio", "window_count", "window_agencies")))
    old = rows.where("entity_id % 2 = 0").select("entity_id", F.lit("old").alias("canonical_name"), F.lit("OLD").alias("type"), F.lit(1.0).alias("trending_score"), "volume_ratio", "window_count", "window_agencies", F.lit(None).cast("timestamp_ntz").alias("computed_at"))
    return trends.persist(old, rows.where("entity_id % 3 = 0"), F.lit("2024-01-01").cast("timestamp_ntz")).select("entity_id", "canonical_name", "type", "trending_score")


@query("SELECT s_suppkey AS entity_id, s_acctbal AS trending_score FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 10")
def top_trending(t) -> DataFrame:
    return trends.top(t("supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_acctbal").alias("trending_score")), 10)


# ---- stores

@query(_NEWS + """
SELECT n.unique_id, CASE WHEN k % 2 = 0 THEN coalesce(c.id, l1) ELSE l1 END AS theme_l1_id, CASE WHEN k % 2 = 0 AND k % 4 <> 0 THEN 'new' ELSE title END AS title
FROM n LEFT JOIN th c ON c.code = 'T' || (k % 60)""")
def dataset_update(t) -> DataFrame:
    key = F.col("unique_id").cast("long")
    frame = _news(t).where(key % 2 == 0).select("unique_id", F.concat(F.lit("T"), (key % 60).cast("string")).alias("theme_1_level_1_code"), F.lit("label").alias("theme_1_level_1_label"), F.when(key % 4 != 0, "new").alias("title"))
    return stores.update_from_dataset(_news(t), frame, _themes(t)).select("unique_id", "theme_l1_id", "title")


@query(_NEWS + """
, x AS (SELECT unique_id, CASE WHEN k % 11 <> 0 THEN published_at END AS p, 'N' || (k % 30) AS a, k % 35 AS c FROM n)
SELECT unique_id, CASE WHEN p IS NULL THEN 'no published_at' WHEN ag.id IS NULL THEN 'unknown agency' ELSE '' END AS reason, CASE WHEN p IS NOT NULL AND ag.id IS NOT NULL THEN ag.name END AS agency_name,
  CASE WHEN p IS NOT NULL AND ag.id IS NOT NULL THEN th.id END AS theme_l1_id FROM x LEFT JOIN ag ON ag.key = a LEFT JOIN th ON th.id = c""")
def dataset_gates(t) -> DataFrame:
    key = F.col("unique_id").cast("long")
    frame = _news(t).select("unique_id", F.when(key % 11 != 0, F.col("published_at")).alias("published_at"), F.concat(F.lit("N"), (key % 30).cast("string")).alias("agency"), F.concat(F.lit("T"), (key % 35).cast("string")).alias("theme_1_level_1_code"), F.lit("x").alias("most_specific_theme_label"))
    kept, skipped = stores.from_dataset(frame, _agencies(t), _themes(t))
    return kept.select("unique_id", F.lit("").alias("reason"), "agency_name", "theme_l1_id").unionByName(skipped, allowMissingColumns=True)


@query(_NEWS + f"SELECT unique_id, agency_key AS agency, image_url AS image, published_at, t1.code AS theme_1_level_1_code, tm.code AS most_specific_theme_code FROM n {_JOINS} WHERE {_IN_MAY} AND agency_key = 'N3'")
def dataset_range(t) -> DataFrame:
    return stores.to_dataset(_news(t), _themes(t), "1997-05-01", "1997-05-31", "N3").select("unique_id", "agency", "image", "published_at", "theme_1_level_1_code", "most_specific_theme_code")


@query("""
WITH x AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'new-' || o_orderkey ELSE o_orderkey::varchar END AS unique_id, o_orderkey::varchar AS legacy FROM orders)
SELECT 'news' AS what, unique_id, legacy AS legacy_unique_id FROM x UNION ALL SELECT 'features', unique_id, NULL FROM x WHERE k % 3 = 0
UNION ALL SELECT 'back', legacy, legacy FROM x UNION ALL SELECT 'features back', legacy, NULL FROM x WHERE k % 3 = 0""")
def rekeyed(t) -> DataFrame:
    news = _news(t).select("unique_id")
    ids = news.where(F.col("unique_id").cast("long") % 2 == 0).withColumn("new_id", F.concat(F.lit("new-"), F.col("unique_id")))
    moved, own = stores.rekey(news, _features(t), ids)
    back, own_back = stores.undo_rekey(moved, own)
    none = F.lit(None).cast("string").alias("legacy_unique_id")
    out = [moved.select(F.lit("news").alias("what"), "unique_id", "legacy_unique_id"), own.select(F.lit("features").alias("what"), "unique_id", none), back.select(F.lit("back").alias("what"), "unique_id", "legacy_unique_id"), own_back.select(F.lit("features back").alias("what"), "unique_id", none)]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("""
SELECT s_suppkey AS entity_id, CASE WHEN s_suppkey % 2 = 0 AND s_suppkey % 3 = 0 THEN 'D' || s_nationkey WHEN s_suppkey % 2 <> 0 AND s_suppkey % 3 = 0 THEN 'D' || s_nationkey END AS domain,
  CASE WHEN s_suppkey % 2 = 0 THEN CASE WHEN s_suppkey % 4 = 0 THEN 'ORG' ELSE 'POLICY' END ELSE 'POLICY' END AS type, CASE WHEN s_suppkey % 2 = 0 THEN 1 END AS kept FROM supplier
WHERE (s_suppkey % 2 = 0 OR s_suppkey % 3 = 0) AND NOT (s_suppkey % 4 = 0) UNION ALL SELECT s_suppkey, NULL, 'ORG', 1 FROM supplier WHERE s_suppkey % 4 = 0""")
def gazetteer_merge(t) -> DataFrame:
    rows = t("supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("canonical_name"), F.concat(F.lit("D"), F.col("s_nationkey").cast("string")).alias("domain"))
    none = lambda c: F.lit(None).cast("string").alias(c)
    registry = rows.where("entity_id % 2 = 0").select("entity_id", "canonical_name", F.when(F.col("entity_id") % 4 == 0, "ORG").otherwise("POLICY").alias("type"), F.lit("[]").alias("aliases"), none("wikidata_id"), F.lit(1.0).alias("confidence"), F.lit("found").alias("provenance"), F.lit('{"kept":1}').alias("extra"))
    gazetteer = rows.where("entity_id % 3 = 0").select("entity_id", "canonical_name", "domain", none("lifecycle_phase"), none("wikidata_id"), none("instance_of"))
    out = stores.merge_gazetteer(registry, gazetteer)
    return out.select("entity_id", jsonx.typed(F.col("extra"), "domain", "string").alias("domain"), "type", jsonx.typed(F.col("extra"), "kept", "int").alias("kept"))


@query("""
WITH v AS (SELECT user_id AS u, count(*) AS n, count(DISTINCT event_type) AS s FROM events GROUP BY 1)
SELECT c_custkey AS unique_id, v.n AS view_count, v.s AS unique_sessions, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS kept FROM customer LEFT JOIN v ON v.u = c_custkey WHERE v.u IS NOT NULL OR c_custkey % 2 = 0""")
def engagement_upsert(t) -> DataFrame:
    known = t("customer").select(F.col("c_custkey").alias("unique_id"))
    old = t("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("unique_id"), F.to_json(F.struct(F.col("c_mktsegment").alias("kept"))).alias("features"))
    views = t("events").select(F.concat(F.lit("/u/"), F.col("user_id").cast("string")).alias("url_path"), F.col("event_type").alias("session_id"))
    found = engagement.engagement(views, pattern="/u/([0-9]+)", prefix="/u/").withColumn("unique_id", F.col("unique_id").cast("long"))
    out = stores.merge_features(old, stores.feature_patches(found, "view_count", "unique_sessions"), known)
    return out.select("unique_id", *(jsonx.typed(F.col("features"), c, kind).alias(c) for c, kind in (("view_count", "long"), ("unique_sessions", "long"), ("kept", "string"))))


@query("""
SELECT 'documents' AS what, count(*) AS n FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT 'labels', count(*) FROM labels WHERE doc_id % 3 <> 0""")
def delete_cascade(t) -> DataFrame:
    docs = t("documents")
    left = stores.delete_cascade({"documents": docs, "labels": t("labels")}, docs.where("doc_id % 3 = 0").select("doc_id"), "doc_id")
    return validate.report(*(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("what"), "n") for k, df in left.items()))


@query("""
SELECT p_partkey AS k, CASE WHEN p_partkey % 2 = 0 THEN p_size + 1 ELSE p_size END AS v, CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2020-01-01' END AS updated_at FROM part""")
def updated_rows(t) -> DataFrame:
    old = t("part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("v"), F.lit("2020-01-01").cast("timestamp_ntz").alias("updated_at"))
    new = old.withColumn("v", F.when(F.col("k") % 2 == 0, F.col("v") + 1).otherwise(F.col("v")))
    return stores.with_updated_at(old, new, "k", F.lit("2024-01-01").cast("timestamp_ntz"))


@query(_NEWS + "SELECT unique_id, ag.key AS agency_key, ag.name AS agency_name FROM n LEFT JOIN ag ON ag.id = agency_id")
def denormalised_agency(t) -> DataFrame:
    return stores.denormalise_agency(_news(t), _agencies(t)).select("unique_id", "agency_key", "agency_name")


@query("""
WITH g AS (SELECT *, row_number() OVER (PARTITION BY p_partkey % 40, p_brand ORDER BY NOT (p_size > 25), p_partkey) AS n FROM part) SELECT p_partkey AS id FROM g WHERE n = 1""")
def url_cleanup(t) -> DataFrame:
    news = t("part").select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 40).alias("agency_key"), F.col("p_brand").alias("url"), F.when(F.col("p_size") > 25, F.lit(1)).alias("content_embedding"))
    return dedup.without_url_duplicates(news)[0].select("id")


@query("""
WITH n AS (SELECT n_nationkey AS k, n_name AS name FROM nation)
SELECT 'agency_N' || k AS entity_id, name AS canonical_name, 'ORG' AS type, 'N' || k AS agency_key, '["' || name || ' (X' || (k % 20) || ')","' || name || '","X' || (k % 20) || '","N' || k || '"]' AS aliases, k % 20 < 5 AS clash FROM n""")
def seeded_registry(t) -> DataFrame:
    n = F.col("n_nationkey")
    agencies = t("nation").select(F.concat(F.lit("N"), n.cast("string")).alias("key"), F.concat("n_name", F.lit(" (X"), (n % 20).cast("string"), F.lit(")")).alias("name"))
    rows, one, several = dedup.seeded_registry(agencies, "agency_")
    own = rows.withColumn("alias_norm", F.lower(F.get_json_object("aliases", "$[2]"))).join(several.select("alias_norm", F.lit(True).alias("clash")), "alias_norm", "left")
    return own.select("entity_id", "canonical_name", "type", "agency_key", "aliases", F.coalesce("clash", F.lit(False)).alias("clash"))


# ---- events and streams

@query("""
SELECT event_id, event_type AS name, s.n AS session_events, '{"a":"' || (json_extract_string(props, '$.k')) || '","t":"' || event_type || '"}' AS event_data FROM events JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) s USING (user_id)
WHERE event_type NOT IN ('view', 'click') AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'""")
def custom_events(t) -> DataFrame:
    events = t("events").select("event_id", F.col("user_id").alias("session_id"), F.col("event_type").alias("name"), F.when(F.col("event_type").isin("view", "click"), 1).otherwise(2).alias("event_type"), F.col("ts").alias("created_at"), "props")
    sessions = events.groupBy("session_id").agg(F.count(F.lit(1)).alias("session_events"))
    one = lambda key, s, n: F.struct(F.lit(key).alias("data_key"), s.alias("string_value"), n.alias("number_value"))
    none = F.lit(None).cast("string")
    data = events.select(F.col("event_id").alias("website_event_id"), F.explode(F.array(one("t", F.col("name"), F.lit(None).cast("int")), one("a", none, jsonx.typed(F.col("props"), "k", "int")))).alias("x")).select("website_event_id", "x.*")
    return engagement.custom_events(events, sessions, data, datetime(2024, 1, 5), datetime(2024, 1, 20)).select("event_id", "name", "session_events", "event_data")


# ---- checks

@query(_NEWS + """
SELECT 'agency_copy' AS check_name, count(*) FILTER (k % 6 = 0) AS bad FROM n UNION ALL SELECT 'theme_coverage', CASE WHEN count(CASE WHEN tm < 25 THEN 1 END) * 100.0 / count(*) < 95 THEN 1 ELSE 0 END FROM n
UNION ALL SELECT 'hash_coverage', CASE WHEN count(content_hash) * 100.0 / count(*) < 50 THEN 1 ELSE 0 END FROM n""")
def validation_thresholds(t) -> DataFrame:
    news = _news(t).withColumn("agency_key", F.when(F.col("unique_id").cast("long") % 6 == 0, "other").otherwise(F.col("agency_key")))
    return validate.report(
        validate.disagreement("agency_copy", news, _agencies(t), "agency_id", "id", {"agency_key": "key"}),
        validate.below("theme_coverage", news, F.col("most_specific_theme_id") < 25, 95), validate.below("hash_coverage", news, F.col("content_hash").isNotNull(), 50),
    )


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(t) -> DataFrame:
    return validate.counts_by(t("orders").withColumnRenamed("o_orderstatus", "status"), "status")


@query("""
SELECT o_orderkey::varchar AS operation, o_orderstatus AS status, o_orderdate AS started_at, 60.0::double * (o_orderkey % 7) AS duration_seconds FROM orders ORDER BY o_orderdate DESC, o_orderkey::varchar LIMIT 100""")
def recent_runs(t) -> DataFrame:
    at = F.col("o_orderdate")
    log = t("orders").select(F.col("o_orderkey").cast("string").alias("operation"), F.col("o_orderstatus").alias("status"), at.alias("started_at"), (at + F.make_dt_interval(mins=(F.col("o_orderkey") % 7).cast("int"))).alias("completed_at"))
    return validate.recent_runs(log).select("operation", "status", "started_at", "duration_seconds")


@query("SELECT count(*) FILTER (lang = 'xx' OR doc_id % 2 = 0) AS old_n, count(*) AS new_n FROM documents")
def count_difference(t) -> DataFrame:
    docs = t("documents")
    return validate.count_difference(docs.where("doc_id % 2 = 0"), docs).select("old_n", "new_n")


@query("SELECT doc_id FROM documents WHERE doc_id % 7 = 0 AND n_chars IS NOT NULL")
def sample_compare(t) -> DataFrame:
    docs = t("documents").select("doc_id", "n_chars", "lang")
    changed = docs.withColumn("n_chars", F.when(F.col("doc_id") % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")))
    return validate.sample_differences(docs, changed, "doc_id", ["n_chars", "lang"], one_in=1).select("doc_id")


@query("""
WITH o AS (SELECT doc_id, lang FROM documents WHERE doc_id % 2 = 0), n AS (SELECT doc_id, n_chars FROM documents WHERE doc_id % 3 = 0)
SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, o.lang, n.n_chars FROM o FULL JOIN n ON o.doc_id = n.doc_id""")
def dataset_merge(t) -> DataFrame:
    docs = t("documents")
    new = docs.where("doc_id % 3 = 0").select("doc_id", "n_chars", F.col("n_chars").alias("place"))
    return stores.merge_datasets(docs.where("doc_id % 2 = 0").select("doc_id", "lang"), new, "doc_id", "place", True)


@query(r"""
SELECT doc_id, cast(len(list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) AS bigint) AS word_count, length(coalesce(text, '')) AS char_count, coalesce(source <> '', false) AS has_image FROM documents WHERE doc_id % 2 = 0""")
def computed_features(t) -> DataFrame:
    news = t("documents").select(F.col("doc_id").alias("unique_id"), F.col("text").alias("content"), F.col("source").alias("image_url"), F.lit(None).cast("string").alias("video_url"), F.lit(None).cast("timestamp_ntz").alias("published_at"))
    have = news.where("unique_id % 2 <> 0").select("unique_id", F.lit('{"word_count":1}').alias("features"))
    out = features.compute(features.missing(news, have, "word_count"))
    return out.select(F.col("unique_id").alias("doc_id"), *(jsonx.typed(F.col("features"), c, k).alias(c) for c, k in (("word_count", "long"), ("char_count", "long"), ("has_image", "boolean"))))


@query("SELECT doc_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN 'known' END, substring(sha256('a' || chr(10) || doc_id), 1, 16)) AS content_hash FROM documents")
def hash_backfill(t) -> DataFrame:
    news = t("documents").select("doc_id", F.lit("A").alias("title"), F.col("doc_id").cast("string").alias("content"), F.when(F.col("doc_id") % 2 == 0, "known").alias("content_hash"))
    return dedup.backfill_hashes(news).select("doc_id", "content_hash")


@query("""
WITH t AS (SELECT * FROM embeddings), p AS (SELECT t.vec_id AS unique_id, e.vec_id AS similar_id, list_cosine_similarity(t.embedding::double[], e.embedding::double[]) AS s FROM t JOIN embeddings e ON e.vec_id <> t.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY round(s, 12) DESC, similar_id) AS n FROM p WHERE s > 0.3) SELECT unique_id, similar_id, n AS rank FROM r WHERE n <= 3""")
def similar_all(t) -> DataFrame:
    """Every vector against all others: the plan of many targets."""
    rows = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return similarity.similar_topk(rows, rows, least=0.3, k=3).select("unique_id", "similar_id", "rank")


