"""The registered queries: each applies one operator to the tables that stand in for its inputs.

Where SQL can say the same, it stands beside the query.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions import annotate, dates, jsonx, text, urls
from gazetta.operators import dedup, engagement, facts, features, graph, integrity, rolling, search, similarity, stores, trending, trends, validate
from gazetta.plans.registry import QUERIES, SQL, newest, query
from gazetta.sources import catalog

__all__ = ["QUERIES", "SQL"]

# ---- trending and rolling counts

_ROLLING = """
WITH e AS (SELECT event_id, event_type, ts, cast(floor(epoch(ts)) AS bigint) AS s, max(ts) OVER () AS m FROM events),
w AS (SELECT *, count(*) OVER (PARTITION BY event_type ORDER BY s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS v,
  count(*) OVER (PARTITION BY event_type ORDER BY s RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) / 7.0::double AS a
  FROM e WHERE ts >= m - INTERVAL 7 DAY)
"""


@query(_ROLLING + """SELECT event_id, event_type, v AS volume_24h, round(a, 6) AS daily_mean_7d,
  CASE WHEN a > 0 THEN round(v / a, 3) ELSE 0.0::double END AS trending_score FROM w WHERE ts >= m - INTERVAL 24 HOUR""")
def trending_by_type(t) -> DataFrame:
    events = t("events").select(F.col("event_id").alias("unique_id"), F.col("event_type").alias("theme"), F.col("ts").alias("published_at"))
    out = trending.theme_trending(events, newest(events, "published_at"))
    return out.select(F.col("unique_id").alias("event_id"), F.col("theme").alias("event_type"), "volume_24h", F.round("daily_mean_7d", 6).alias("daily_mean_7d"), "trending_score")


@query("""
WITH e AS (SELECT event_type, cast(floor(epoch(ts)) AS bigint) AS s FROM events),
w AS (SELECT DISTINCT event_type, s, count(*) OVER (PARTITION BY event_type ORDER BY s RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS volume FROM e)
SELECT event_type, s, volume, place FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY volume DESC, s) AS place FROM w) WHERE place <= 3""")
def rolling_rank(t) -> DataFrame:
    counts = rolling.rolling_counts(t("events").withColumn("s", dates.epoch(F.col("ts"))), "event_type", "s", {"volume": 86400})
    return dedup.keep_first(counts, ["event_type"], F.desc("volume"), F.col("s")).drop("group_size").where("place <= 3")


# ---- facts and views

@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderdate, c_mktsegment, n_name, r_name FROM lineitem
JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
WHERE o_orderdate >= DATE '1996-03-01' AND o_orderdate < DATE '1996-04-01'""")
def fact_star_join(t) -> DataFrame:
    orders = catalog.by_days(t("orders"), "o_orderdate", "1996-03-01", "1996-03-31")
    rows = t("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = facts.star(rows, [
        (t("customer"), "o_custkey", "c_custkey", {"c_mktsegment": "c_mktsegment", "c_nationkey": "nation_key"}),
        (t("nation"), "nation_key", "n_nationkey", {"n_name": "n_name", "n_regionkey": "region_key"}),
        (t("region"), "region_key", "r_regionkey", {"r_name": "r_name"}),
    ])
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_orderdate", "c_mktsegment", "n_name", "r_name")


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS integer) AS k, try_cast(json_extract_string(props, '$.k') AS double) > 50 AS large FROM events")
def fact_projection_json(t) -> DataFrame:
    k = jsonx.typed(F.col("props"), "k", "int")
    return t("events").select("event_id", k.alias("k"), (jsonx.typed(F.col("props"), "k", "double") > 50).alias("large"))


@query("""
SELECT s_suppkey, n_name, r_name, coalesce(n_name, r_name) AS deepest FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""")
def labels_view(t) -> DataFrame:
    rows = facts.star(t("supplier"), [(t("nation"), "s_nationkey", "n_nationkey", {"n_name": "n_name", "n_regionkey": "k"}), (t("region"), "k", "r_regionkey", {"r_name": "r_name"})])
    return rows.select("s_suppkey", "n_name", "r_name", F.coalesce("n_name", "r_name").alias("deepest"))


@query("""
WITH r AS (SELECT lpad(r_regionkey::varchar, 2, '0') AS code, r_name AS label, r_regionkey AS id FROM region),
n AS (SELECT r.code || '.' || lpad(n_nationkey::varchar, 2, '0') AS code, n_name AS label, r.code AS parent_code FROM nation JOIN r ON r.id = n_regionkey)
SELECT code, label, code || ' ' || label AS full_name, 1 AS level, NULL::varchar AS parent_code FROM r UNION ALL SELECT code, label, code || ' ' || label, 2, parent_code FROM n""")
def theme_tree_flatten(t) -> DataFrame:
    roots = t("region").select(F.col("r_regionkey").cast("string").alias("id"), F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("code"), F.col("r_name").alias("label"))
    first = roots.select("id", "code", "label", F.concat_ws(" ", "code", "label").alias("full_name"), F.lit(1).alias("level"), F.lit(None).cast("string").alias("parent_code"))
    second = facts.flatten_tree(t("nation"), roots, {"id": "n_nationkey", "label": "n_name", "parent": "n_regionkey"}).withColumn("level", F.lit(2))
    return first.unionByName(second).drop("id")


@query("SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1")
def latest_per_key(t) -> DataFrame:
    return facts.latest(t("events"), "user_id", F.desc("ts"), F.col("event_id")).select("user_id", "event_id", "event_type", "ts")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5")
def filtered_scan(t) -> DataFrame:
    return catalog.select_rows(t("orders"), {"o_orderstatus": "F"}, [F.desc("o_totalprice"), F.col("o_orderkey")], limit=20, offset=5).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1997-02-01'")
def publish_reduced(t) -> DataFrame:
    rows = t("orders").where(dates.in_range_inclusive(F.col("o_orderdate"), "1997-01-01", "1997-02-01"))
    return rows.orderBy("o_orderpriority", F.desc("o_orderdate"), "o_orderkey").select("o_orderkey", "o_orderdate", "o_orderpriority")


# ---- engagement and events

@query(r"""
WITH p AS (SELECT nullif(regexp_extract(url, '/([a-z]{2})/[0-9]+', 1), '') AS lang, regexp_extract(url, 'https?://([^/]+)', 1) AS host FROM pages)
SELECT lang AS unique_id, count(*) AS view_count, count(DISTINCT host) AS unique_sessions FROM p WHERE lang IS NOT NULL GROUP BY 1""")
def engagement_url(t) -> DataFrame:
    views = t("pages").select(F.col("url").alias("url_path"), F.regexp_extract("url", "https?://([^/]+)", 1).alias("session_id"))
    return engagement.engagement(views, pattern="/([a-z]{2})/[0-9]+", prefix=None)


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, '{' || string_agg('"' || event_type || '":"' || n || '"', ',' ORDER BY event_type) || '}' AS event_data FROM c GROUP BY user_id""")
def event_pivot_object(t) -> DataFrame:
    counts = t("events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("user_id").agg(engagement.object_of(F.col("event_type"), F.col("n"), F.col("event_type")).alias("event_data"))


@query("""
WITH s AS (SELECT user_id, min(ts) AS started, count(*) AS n FROM events GROUP BY 1)
SELECT e.event_id, e.user_id, e.event_type, s.n AS session_events, e.ts >= s.started + INTERVAL 1 DAY AS returning_user FROM events e JOIN s USING (user_id)
WHERE e.event_type IN ('view', 'click') AND e.ts >= TIMESTAMP '2024-01-05' AND e.ts < TIMESTAMP '2024-01-20'""")
def event_session_join(t) -> DataFrame:
    events = t("events").select("event_id", F.col("user_id").alias("session_id"), "event_type", F.col("ts").alias("created_at"))
    session = events.groupBy("session_id").agg(F.min("created_at").alias("started"), F.count(F.lit(1)).alias("session_events"))
    typed = events.withColumn("name", F.col("event_type")).withColumn("event_type", F.when(F.col("name").isin("view", "click"), 1).otherwise(2))
    rows = engagement.pageviews(typed, session, datetime(2024, 1, 5), datetime(2024, 1, 20))
    return rows.select("event_id", F.col("session_id").alias("user_id"), F.col("name").alias("event_type"), "session_events", (F.col("created_at") >= F.col("started") + F.expr("INTERVAL 1 DAY")).alias("returning_user"))


@query("SELECT cast(ts AS date) AS day, event_type, count(*) AS views, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def daily_views(t) -> DataFrame:
    return engagement.daily_views(t("events"), F.to_date("ts"), "event_type", user="user_id")


@query("SELECT cast(ts AS date) AS day, event_type, round(sum(value), 6) AS used, sum(value) >= 0.8 * 5000 AS stop FROM events GROUP BY ALL")
def quota_ledger(t) -> DataFrame:
    day = F.to_date("ts").alias("day")
    old, new = (t("events").where(test).select(day, "event_type", "value") for test in ("event_id % 2 = 0", "event_id % 2 <> 0"))
    ledger = stores.accumulate(old, new, ["day", "event_type"], "value")
    return engagement.quota(ledger, "day", "event_type", F.col("value"), 5000).withColumn("used", F.round("used", 6))


# ---- text, dates, identifiers

@query(r"""
SELECT doc_id, cast(len(list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) AS bigint) AS word_count, length(coalesce(text, '')) AS char_count,
  cast(len(list_filter(string_split(coalesce(text, ''), chr(10) || chr(10)), lambda p: regexp_matches(p, '[^ \t\n\x0B\f\r]'))) AS bigint) AS paragraph_count, coalesce(source <> '', false) AS has_source FROM documents""")
def text_features(t) -> DataFrame:
    c = F.col("text")
    return t("documents").select("doc_id", text.word_count(c).alias("word_count"), text.char_count(c).alias("char_count"), text.paragraph_count(c).alias("paragraph_count"), text.has_value(F.col("source")).alias("has_source"))


@query(r"""
WITH x AS (SELECT doc_id, len(list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) AS w,
  greatest(len(regexp_extract_all(coalesce(text, ''), '[.!?]+')), 1) AS s, len(regexp_extract_all(lower(coalesce(text, '')), '[aeiouyáàâãäéèêëíìîïóòôõöúùûü]+')) AS v FROM documents)
SELECT doc_id, s AS sentences, v AS syllables, CASE WHEN w >= 10 THEN round(206.835::double - 1.015::double * w / s - 84.6::double * v / w, 2) END AS readability FROM x""")
def flesch_inputs(t) -> DataFrame:
    c = F.col("text")
    return t("documents").select("doc_id", text.sentence_count(c).alias("sentences"), text.syllable_count(c).alias("syllables"), text.flesch(c).alias("readability"))


@query("SELECT o_orderkey, cast(isoyear(o_orderdate) * 100 + week(o_orderdate) AS bigint) AS iso_week, cast(isodow(o_orderdate) - 1 AS bigint) AS dow, cast(hour(o_orderdate) AS bigint) AS hour, cast(floor(epoch(o_orderdate)) AS bigint) AS seconds FROM orders")
def iso_week_dow_hour(t) -> DataFrame:
    d = F.col("o_orderdate")
    return t("orders").select("o_orderkey", dates.iso_week(d).alias("iso_week"), dates.day_of_week(d).alias("dow"), F.hour(d).cast("long").alias("hour"), dates.epoch(d).alias("seconds"))


_ASCII = rf"regexp_replace(translate(coalesce({{0}}, ''), '{text.MARKED}', '{text.PLAIN}'), '[^\x00-\x7F]', '', 'g')"
_HASH_FORM = r"trim(regexp_replace(regexp_replace(lower(" + _ASCII + r"), '[^0-9A-Za-z_ \t\n\x0B\f\r]', '', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g'))"


@query(f"""
WITH x AS (SELECT doc_id, {_HASH_FORM.format('source')} AS a, {_HASH_FORM.format('text')} AS b FROM documents)
SELECT doc_id, CASE WHEN a <> '' OR b <> '' THEN substring(sha256(a || chr(10) || b), 1, 16) END AS content_hash FROM x""")
def content_hash(t) -> DataFrame:
    return t("documents").select("doc_id", text.content_hash(F.col("source"), F.col("text")).alias("content_hash"))


_SLUG = r"regexp_replace(regexp_replace(lower(" + _ASCII + r"), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(f"""
WITH x AS (SELECT p_partkey, {_SLUG.format('p_name')} AS s, substring(md5(p_brand || '_' || p_name), 1, 6) AS h FROM part)
SELECT p_partkey, CASE WHEN s = '' THEN 'sem-titulo' ELSE s END || '_' || h AS unique_id FROM x""")
def readable_id(t) -> DataFrame:
    return t("part").select("p_partkey", text.readable_id(F.col("p_name"), F.col("p_brand"), F.col("p_name")).alias("unique_id"))


@query(r"SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_name, ' '), lambda x: trim(x)), lambda x: length(x) BETWEEN 1 AND 100), '|') AS tags FROM part")
def tag_clean(t) -> DataFrame:
    return t("part").select("p_partkey", F.array_join(text.clean_tags(F.split("p_name", " ")), "|").alias("tags"))


@query(f"""
WITH e AS (SELECT p_partkey AS id, trim(regexp_replace({_ASCII.format('lower(x)')}, '[ \t\n]+', ' ', 'g')) AS alias_norm FROM part, unnest([trim(p_name), trim(p_brand)]) AS u(x)),
d AS (SELECT DISTINCT id, alias_norm FROM e WHERE alias_norm <> ''),
g AS (SELECT alias_norm, count(*) AS owners, min(id) AS entity_id FROM d GROUP BY 1)
SELECT alias_norm, owners, CASE WHEN owners = 1 THEN entity_id END AS entity_id FROM g""")
def alias_collisions(t) -> DataFrame:
    one, several = dedup.registry_aliases(t("part"), "p_name", "p_brand", "p_partkey")
    return one.withColumn("owners", F.lit(1).cast("long")).unionByName(several.withColumn("entity_id", F.lit(None).cast("long")))


@query("SELECT page_id, CASE WHEN url LIKE 'https://m.%' OR url LIKE 'https://www.%' THEN url END AS url FROM pages")
def allowlist_nullify(t) -> DataFrame:
    return t("pages").select("page_id", urls.null_unless_allowed(F.col("url"), ["https://m.", "https://www."]).alias("url"))


@query()
def accent_fold(t) -> DataFrame:
    return t("documents").select("doc_id", F.sha2(annotate.accent_fold("text"), 256).alias("folded_sha256"))


@query()
def content_annotations(t) -> DataFrame:
    """Annotates every text with the first words of its own lines and of its source."""
    docs = t("documents").where("text is not null")
    named = F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), lambda x: F.struct(F.substring_index(F.trim(x), " ", 2).alias("text"), F.lit("ORG").alias("type"), F.lit(1).alias("count"), F.sha2(x, 256).alias("canonical_id")))
    rows = docs.select("doc_id", "text", F.array_distinct(named).alias("entities"))
    return rows.select("doc_id", F.size(annotate.annotations("text", "entities")).alias("n_spans"), annotate.source_hash("text", "entities").alias("source_hash"))


# ---- vectors

@query("""
WITH t AS (SELECT * FROM embeddings WHERE vec_id % 5 = 0),
p AS (SELECT t.vec_id AS unique_id, e.vec_id AS similar_id, list_cosine_similarity(t.embedding::double[], e.embedding::double[]) AS s FROM t JOIN embeddings e ON e.vec_id <> t.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY round(s, 12) DESC, similar_id) AS n FROM p WHERE s > 0.3)
SELECT unique_id, similar_id, round(s, 6) AS similarity, n AS rank FROM r WHERE n <= 5""")
def similar_topk(t) -> DataFrame:
    rows = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return similarity.similar_topk(rows.where("id % 5 = 0"), rows, least=0.3, k=5).withColumn("similarity", F.round("similarity", 6))


@query("""
WITH t AS (SELECT * FROM embeddings WHERE vec_id % 5 = 0),
p AS (SELECT t.vec_id AS unique_id, e.vec_id AS similar_id, list_cosine_similarity(t.embedding::double[], e.embedding::double[]) AS s FROM t JOIN embeddings e ON e.vec_id <> t.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY round(s, 12) DESC, similar_id) AS n FROM p WHERE s > 0.3)
SELECT unique_id, string_agg(similar_id, ',' ORDER BY n) AS similar_articles FROM r WHERE n <= 5 GROUP BY 1""")
def similar_grouped(t) -> DataFrame:
    rows = t("embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    pairs = similarity.similar_topk(rows.where("id % 5 = 0"), rows, least=0.3, k=5).withColumn("similarity", F.round("similarity", 12))
    return similarity.grouped(pairs).select("unique_id", F.array_join(F.col("similar_articles").cast("array<string>"), ",").alias("similar_articles"))


@query("""
WITH u AS (SELECT label, vec_id, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
c AS (SELECT label, list(m ORDER BY d) AS c FROM (SELECT label, d, avg(x) AS m FROM u WHERE vec_id % 5 <> 0 GROUP BY ALL) GROUP BY label)
SELECT label, round(1 - avg(list_cosine_similarity(embedding::double[], c)), 6) AS novelty FROM embeddings JOIN c USING (label) WHERE vec_id % 5 = 0 GROUP BY label""")
def semantic_novelty(t) -> DataFrame:
    rows = t("embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))
    out = similarity.novelty(rows.where("vec_id % 5 = 0"), rows.where("vec_id % 5 <> 0"), "label")
    return out.withColumn("novelty", F.round("novelty", 6))


# ---- entity graph

_EDGES = """
WITH m AS (SELECT l_orderkey AS u, l_suppkey AS e, min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem GROUP BY ALL),
g AS (SELECT a.e AS src_id, b.e AS dst_id, count(*) AS weight, min(a.lo) AS first_seen, max(a.hi) AS last_seen FROM m a JOIN m b ON a.u = b.u AND a.e < b.e GROUP BY ALL HAVING count(*) >= 2)
"""


def _mention_rows(t) -> DataFrame:
    return t("lineitem").select(F.col("l_orderkey").alias("unique_id"), F.col("l_suppkey").alias("entity_id"), F.col("l_shipdate").alias("published_at"))


@query(_EDGES + "SELECT * FROM g")
def co_mention_edges(t) -> DataFrame:
    return graph.co_mentions(_mention_rows(t)).drop("article_count")


@query(_EDGES + "SELECT e AS entity_id, max(weight) AS weight FROM (SELECT dst_id AS e, weight FROM g WHERE src_id = 5 UNION ALL SELECT src_id, weight FROM g WHERE dst_id = 5) GROUP BY 1")
def related_entities(t) -> DataFrame:
    return graph.related(graph.co_mentions(_mention_rows(t)), 5)


@query(_EDGES.replace("HAVING count(*) >= 2", "HAVING count(*) >= 5") + """, w AS (SELECT src_id AS a, dst_id AS b FROM g UNION ALL SELECT dst_id, src_id FROM g),
one AS (SELECT DISTINCT b AS e FROM w WHERE a = 5), two AS (SELECT DISTINCT w.b AS e FROM one JOIN w ON w.a = one.e)
SELECT e AS entity_id, min(d) AS depth FROM (SELECT DISTINCT a AS e, 0 AS d FROM w WHERE a = 5 UNION ALL SELECT e, 1 FROM one UNION ALL SELECT e, 2 FROM two) GROUP BY 1""")
def entity_network(t) -> DataFrame:
    return graph.network(graph.co_mentions(_mention_rows(t), least=5), 5)


@query(_EDGES + "SELECT e AS entity_id, count(*) AS edges FROM (SELECT src_id AS e FROM g UNION ALL SELECT dst_id FROM g) GROUP BY 1")
def edge_degrees(t) -> DataFrame:
    return graph.degrees(graph.co_mentions(_mention_rows(t)))


@query("""
SELECT l_orderkey AS unique_id, l_suppkey::varchar AS entity_id, max(l_returnflag) AS type, cast(sum(l_linenumber) AS integer) AS count, round(max(l_discount)::double, 6) AS salience
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE s_acctbal > 0 GROUP BY l_orderkey, l_suppkey""")
def entity_mentions(t) -> DataFrame:
    entity = F.struct(F.lit(None).cast("string").alias("text"), F.col("l_returnflag").alias("type"), F.col("l_linenumber").cast("int").alias("count"), F.col("l_suppkey").cast("string").alias("canonical_id"), F.col("l_discount").cast("double").alias("salience"))
    news = t("lineitem").groupBy(F.col("l_orderkey").alias("unique_id")).agg(F.collect_list(entity).alias("entities")).withColumn("published_at", F.lit(None).cast("timestamp_ntz"))
    registry = t("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("entity_id"))
    return graph.mentions(news, registry).select("unique_id", "entity_id", "type", "count", F.round("salience", 6).alias("salience"))


@query("""
SELECT DISTINCT 's' || s_suppkey AS src_id, 'n' || s_nationkey AS dst_id, 'is_agency' AS kind FROM supplier
UNION SELECT DISTINCT 'n' || n_nationkey, 'r' || n_regionkey, 'subordinate_to' FROM nation""")
def structural_edges(t) -> DataFrame:
    name = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    up = t("nation").select(name("n", "n_nationkey").alias("src_id"), name("r", "n_regionkey").alias("dst_id"))
    own = t("supplier").select(name("s", "s_suppkey").alias("src_id"), name("n", "s_nationkey").alias("dst_id"))
    return graph.all_edges(graph.structural(own, "is_agency"), graph.structural(up, "subordinate_to"))


# ---- trends

@query("""
WITH r AS (SELECT l_suppkey AS entity_id, l_orderkey AS u, o_custkey % 25 AS agency, o_orderdate AS ts FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
b AS (SELECT *, TIMESTAMP '1998-06-01' AS e FROM r),
s AS (SELECT entity_id, count(DISTINCT u) FILTER (ts >= e - INTERVAL 14 DAY) AS window_count, count(DISTINCT u) FILTER (ts < e - INTERVAL 14 DAY) AS baseline_count,
  count(DISTINCT agency) FILTER (ts >= e - INTERVAL 14 DAY) AS window_agencies, count(DISTINCT agency) FILTER (ts < e - INTERVAL 14 DAY) AS baseline_agencies
  FROM b WHERE ts >= e - INTERVAL 35 DAY AND ts < e GROUP BY 1),
d AS (SELECT *, (window_count / 14.0::double) / greatest(baseline_count / 21.0::double, 0.001::double) AS v FROM s WHERE window_count >= 3)
SELECT entity_id, window_count, baseline_count, window_agencies, baseline_agencies, round(v, 6) AS volume_ratio,
  round(0.40::double * v + 0.25::double * window_agencies / greatest(baseline_agencies, 1) + 0.20::double * v / (1 + baseline_agencies), 6) AS trending_score
FROM d WHERE window_agencies > baseline_agencies AND v > 1.5 AND baseline_agencies <= 20""")
def entity_trend_scores(t) -> DataFrame:
    rows = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_suppkey").alias("entity_id"), F.col("l_orderkey").alias("unique_id"), (F.col("o_custkey") % 25).alias("agency"), F.col("o_orderdate").alias("published_at"))
    stats = trends.snapshot(rows, datetime(1998, 6, 1), window_days=14, baseline_days=21)
    out = trends.score(stats.where(trends.passes(type_column=None)))
    return out.select("entity_id", "window_count", "baseline_count", "window_agencies", "baseline_agencies", F.round("volume_ratio", 6).alias("volume_ratio"), F.round("trending_score", 6).alias("trending_score"))


@query("""
WITH j AS (SELECT lang, doc_id, n_chars, quality::double AS q FROM documents JOIN labels USING (doc_id)),
a AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS r, row_number() OVER (PARTITION BY lang ORDER BY q DESC) AS i FROM j)
SELECT lang, round(sum(q / log2(r + 1)) FILTER (r <= 10), 6) AS dcg, round(sum(q / log2(i + 1)) FILTER (i <= 10), 6) AS ideal,
  round(CASE WHEN sum(q / log2(i + 1)) FILTER (i <= 10) > 0 THEN sum(q / log2(r + 1)) FILTER (r <= 10) / sum(q / log2(i + 1)) FILTER (i <= 10) ELSE 0 END, 6) AS ndcg FROM a GROUP BY lang""")
def ndcg_at_10(t) -> DataFrame:
    rows = t("documents").join(t("labels"), "doc_id").withColumn("rel", F.col("quality").cast("double"))
    out = trends.ndcg(rows, "lang", [F.desc("n_chars"), F.col("doc_id")], "rel")
    return out.select("lang", *(F.round(c, 6).alias(c) for c in ("dcg", "ideal", "ndcg")))


# ---- queues, duplicates, differences

@query("""
WITH m AS (SELECT max(o_orderdate) AS a FROM orders),
x AS (SELECT o_orderkey, o_orderdate AS p, o_orderstatus <> 'O' AS h, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 20 DAY END AS c, a FROM orders, m WHERE o_orderdate > a - INTERVAL 5 MONTH),
t AS (SELECT *, CASE WHEN p > a - INTERVAL 3 HOUR THEN 1 WHEN p > a - INTERVAL 24 HOUR THEN 2 WHEN p > a - INTERVAL 7 DAY THEN 3 WHEN p > a - INTERVAL 30 DAY THEN 4 ELSE 5 END AS tier FROM x),
d AS (SELECT *, row_number() OVER (ORDER BY tier, h, coalesce(c, TIMESTAMP '1970-01-01'), o_orderkey) AS place FROM t
  WHERE NOT h OR c < a - CASE tier WHEN 1 THEN INTERVAL 10 MINUTE WHEN 2 THEN INTERVAL 1 HOUR WHEN 3 THEN INTERVAL 6 HOUR WHEN 4 THEN INTERVAL 24 HOUR ELSE INTERVAL 7 DAY END)
SELECT o_orderkey AS unique_id, tier, place, place <= greatest(1, floor(least(100, (SELECT count(*) FROM d)) * 0.25)) AS check_content FROM d WHERE place <= 100""")
def priority_queue(t) -> DataFrame:
    orders = t("orders")
    news = orders.select(F.col("o_orderkey").alias("unique_id"), F.col("o_orderdate").alias("published_at"), (F.col("o_orderstatus") != "O").alias("has_state"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 20 DAY")).alias("checked_at"))
    return integrity.queue(news, newest(orders, "o_orderdate"), 100).select("unique_id", "tier", "place", "check_content")


@query("""
SELECT event_id AS unique_id, ts AS published_at FROM events WHERE event_type <> 'view' AND coalesce(try_cast(json_extract_string(props, '$.k') AS integer), 0) % 2 = 0 ORDER BY ts DESC, event_id LIMIT 100""")
def thumbnail_backlog(t) -> DataFrame:
    events = t("events")
    news = events.select(F.col("event_id").alias("unique_id"), F.col("ts").alias("published_at"), F.when(F.col("event_type") == "view", "image").alias("image_url"), F.lit("video").alias("video_url"))
    failed = F.coalesce(jsonx.typed(F.col("props"), "k", "int"), F.lit(0)) % 2 != 0
    flags = events.select(F.col("event_id").alias("unique_id"), F.to_json(F.struct(failed.alias("thumbnail_failed"))).alias("features"))
    return integrity.thumbnail_backlog(news, flags, 100).select("unique_id", "published_at")


@query("""
WITH g AS (SELECT *, count(*) OVER (PARTITION BY text) AS group_size, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS place FROM documents)
SELECT doc_id, group_size, place FROM g WHERE group_size > 1""")
def dedup_canonical(t) -> DataFrame:
    docs = t("documents").withColumn("h", F.sha2("text", 256))
    return dedup.keep_first(docs, ["h"], F.col("doc_id")).where("group_size > 1").select("doc_id", "group_size", "place")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphans_anti(t) -> DataFrame:
    return dedup.orphans(t("documents"), t("labels"), "doc_id")


@query("""
WITH u AS (SELECT p_partkey, 'p' || (p_partkey % 40) AS agency_key, p_brand AS url, p_size > 25 AS emb FROM part),
g AS (SELECT *, row_number() OVER (PARTITION BY agency_key, url ORDER BY NOT emb, p_partkey) AS n, count(*) OVER (PARTITION BY agency_key, url) AS c FROM u)
SELECT agency_key, url, min(p_partkey) FILTER (n = 1) AS keep_id, count(*) FILTER (n > 1) AS dropped, bool_or(emb) FILTER (n = 1) AS kept_embedding FROM g WHERE c > 1 GROUP BY 1, 2""")
def url_dedup(t) -> DataFrame:
    news = t("part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("p"), (F.col("p_partkey") % 40).cast("string")).alias("agency_key"), F.col("p_brand").alias("url"), F.when(F.col("p_size") > 25, F.lit(1)).alias("content_embedding"))
    out = dedup.url_duplicates(news)
    return out.select("agency_key", "url", "keep_id", F.size("drop_ids").cast("long").alias("dropped"), "kept_embedding")


@query(f"""
WITH x AS (SELECT p_partkey, {_SLUG.format('p_brand')} AS s, md5(p_brand) AS h FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY s || '_' || substring(h, 1, 6) ORDER BY p_partkey) AS n FROM x)
SELECT p_partkey, s || '_' || substring(h, 1, cast(least(32, 5 + n) AS integer)) || CASE WHEN n > 27 THEN '-' || n ELSE '' END AS unique_id FROM n""")
def unique_id_collisions(t) -> DataFrame:
    return dedup.unique_ids(t("part"), text.slug(F.col("p_brand")), F.md5("p_brand"), "p_partkey").select("p_partkey", "unique_id")


@query("SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR toxic = 0")
def backfill_missing(t) -> DataFrame:
    flags = t("labels").select(F.col("doc_id").alias("unique_id"), F.when(F.col("toxic") != 0, F.lit('{"toxic":1}')).otherwise(F.lit("{}")).alias("features"))
    return features.missing(t("documents").withColumnRenamed("doc_id", "unique_id"), flags, "toxic").select(F.col("unique_id").alias("doc_id"))


# ---- stores

@query("""
WITH o AS (SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS s FROM orders WHERE o_orderkey % 2 = 0), n AS (SELECT o_orderkey AS k, -o_totalprice AS p, NULL::varchar AS s FROM orders WHERE o_orderkey % 3 = 0)
SELECT 'insert' AS mode, k, p, s FROM o UNION ALL SELECT 'insert', k, p, s FROM n WHERE k NOT IN (SELECT k FROM o)
UNION ALL SELECT 'upsert', coalesce(n.k, o.k), CASE WHEN n.k IS NULL THEN o.p ELSE n.p END, CASE WHEN n.k IS NULL THEN o.s ELSE n.s END FROM o FULL JOIN n ON o.k = n.k
UNION ALL SELECT 'partial', o.k, coalesce(n.p, o.p), coalesce(n.s, o.s) FROM o LEFT JOIN n ON o.k = n.k
UNION ALL SELECT 'delete', k, p, s FROM o WHERE k NOT IN (SELECT k FROM n)""")
def upsert_merge(t) -> DataFrame:
    rows = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s"))
    old, new = rows.where("k % 2 = 0"), rows.where("k % 3 = 0").select("k", (-F.col("p")).alias("p"), F.lit(None).cast("string").alias("s"))
    out = {"insert": stores.insert_only(old, new, "k"), "upsert": stores.upsert(old, new, "k"), "partial": stores.update(old, new, "k", ignore_nulls=True), "delete": stores.delete(old, new, "k")}
    frames = [df.select(F.lit(mode).alias("mode"), "k", "p", "s") for mode, df in out.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@query("""
SELECT event_id, cast(json_extract_string(props, '$.k') AS integer) AS k, event_type AS t, CASE WHEN event_id % 2 = 0 THEN 'x' END AS extra, event_id % 3 = 0 AS has_note FROM events""")
def json_merge(t) -> DataFrame:
    patch = F.concat(F.lit('{"t":"'), F.col("event_type"), F.lit('"'), F.when(F.col("event_id") % 2 == 0, F.lit(',"extra":"x"')).otherwise(F.lit("")), F.when(F.col("event_id") % 3 == 0, F.lit(',"note":null')).otherwise(F.lit("")), F.lit("}"))
    merged = t("events").select("event_id", jsonx.merge(F.col("props"), patch).alias("f"))
    return merged.select("event_id", jsonx.typed(F.col("f"), "k", "int").alias("k"), jsonx.typed(F.col("f"), "t", "string").alias("t"), jsonx.typed(F.col("f"), "extra", "string").alias("extra"), jsonx.has_key(F.col("f"), "note").alias("has_note"))


@query("""
SELECT user_id AS unique_id, arg_max(cast(json_extract_string(props, '$.k') AS integer), event_id) AS k, count(*) AS n, arg_max(event_type, event_id) AS last_type FROM events GROUP BY 1""")
def feature_fold(t) -> DataFrame:
    events = t("events")
    patches = events.select(F.col("user_id").alias("unique_id"), jsonx.merge(F.col("props"), F.to_json(F.struct(F.col("event_type").alias("t")))).alias("features"), F.col("event_id").alias("at"))
    old = events.groupBy(F.col("user_id").alias("unique_id")).agg(F.to_json(F.struct(F.count(F.lit(1)).alias("n"), F.lit(-1).alias("k"))).alias("features"))
    out = stores.merge_features(old, patches, order="at")
    return out.select("unique_id", jsonx.typed(F.col("features"), "k", "int").alias("k"), jsonx.typed(F.col("features"), "n", "long").alias("n"), jsonx.typed(F.col("features"), "t", "string").alias("last_type"))


@query("""
WITH x AS (SELECT event_id, event_type, cast(json_extract_string(props, '$.k') AS integer) AS k FROM events)
SELECT event_id AS unique_id, CASE WHEN k % 2 = 0 THEN 'broken' ELSE 'ok' END AS status, CASE WHEN event_type = 'click' THEN k + 1 ELSE 1 END AS check_count, k % 2 = 0 AS now_broken, k % 2 <> 0 AND event_type = 'click' AS now_fixed FROM x""")
def integrity_merge(t) -> DataFrame:
    events, k = t("events"), jsonx.typed(F.col("props"), "k", "int")
    before = F.to_json(F.struct(F.struct(F.lit("broken").alias("image_status"), k.alias("check_count")).alias("integrity"), F.lit(1).alias("other")))
    state = events.where("event_type = 'click'").select(F.col("event_id").alias("unique_id"), before.alias("features"))
    results = events.select(F.col("event_id").alias("unique_id"), F.to_json(F.struct(F.when(k % 2 == 0, "broken").otherwise("ok").alias("image_status"))).alias("patch"))
    out = integrity.merge_results(state, results)
    return out.select("unique_id", jsonx.typed(F.col("features"), "integrity.image_status", "string").alias("status"), jsonx.typed(F.col("features"), "integrity.check_count", "int").alias("check_count"), "now_broken", "now_fixed")


# ---- search

@query("""
WITH v AS (SELECT 'lang' AS field, lang AS value FROM documents UNION ALL SELECT 'source', source FROM documents),
c AS (SELECT field, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY ALL)
SELECT field, value, n FROM (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS p FROM c) WHERE p <= 5""")
def facets(t) -> DataFrame:
    return search.facet(t("documents"), "lang", "source")


@query(r"""
WITH m AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE regexp_matches(lower(text), '(^|[^a-z0-9])the([^a-z0-9]|$)') AND regexp_matches(lower(text), '(^|[^a-z0-9])license([^a-z0-9]|$)'))
SELECT min(doc_id) AS doc_id, h AS content_hash FROM m GROUP BY h""")
def search_group_by_hash(t) -> DataFrame:
    docs = search.matching(t("documents"), ["the", "license"], "text")
    grouped = search.one_of_group(docs, F.sha2("text", 256), F.col("doc_id"))
    return grouped.select("doc_id", F.sha2("text", 256).alias("content_hash"))


@query("""
WITH d AS (SELECT DISTINCT user_id, event_type FROM events)
SELECT user_id, string_agg(event_type, '|' ORDER BY event_type) FILTER (event_type = 'click') AS org, string_agg(event_type, '|' ORDER BY event_type) FILTER (event_type NOT IN ('click', 'view')) AS misc FROM d GROUP BY 1""")
def entity_buckets(t) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "ORG").when(F.col("event_type") == "view", "PER").otherwise("X")
    entity = F.struct(F.col("event_type").alias("text"), kind.alias("type"), F.lit(None).cast("string").alias("canonical_id"))
    rows = t("events").groupBy("user_id").agg(F.array_sort(F.collect_list(entity)).alias("e"))
    fields = search.entity_fields(F.col("e"))
    return rows.select("user_id", F.array_join(fields["entity_org"], "|").alias("org"), F.array_join(fields["entity_misc"], "|").alias("misc"))


@query(r"""
SELECT doc_id AS id, cast(n_chars AS bigint) AS published_at, cast(isoyear(to_timestamp(n_chars) AT TIME ZONE 'UTC') * 100 + week(to_timestamp(n_chars) AT TIME ZONE 'UTC') AS bigint) AS published_week, nullif(trim(source), '') AS title, nullif(trim(lang), '') AS category, CASE WHEN n_chars > 0 THEN n_chars END AS char_count FROM documents""")
def search_documents(t) -> DataFrame:
    rows = t("documents").select(F.col("doc_id").alias("unique_id"), F.timestamp_seconds("n_chars").alias("published_at"), F.col("source").alias("title"), F.col("lang").alias("category"), F.col("n_chars").alias("char_count"))
    return search.documents(rows).select("id", "published_at", "published_week", "title", "category", "char_count")


# ---- checks

@query("""
SELECT lang, count(*) AS total, cast(count(quality) AS bigint) AS covered, round(100.0::double * count(quality) / count(*), 2) AS percent FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def coverage_stats(t) -> DataFrame:
    return validate.coverage(t("documents").join(t("labels"), "doc_id", "left"), F.col("quality").isNotNull(), "lang")


@query("""
SELECT 'customer_name' AS check_name, count(*) FILTER (c_name IS NULL) AS bad FROM customer UNION ALL SELECT 'order_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'document_label', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'order_key', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'line_order_part', count(*) FROM (SELECT l_orderkey, l_partkey FROM lineitem GROUP BY ALL HAVING count(*) > 1) UNION ALL SELECT 'negative_balance', count(*) FROM customer WHERE c_acctbal < 0""")
def validation_report(t) -> DataFrame:
    return validate.report(
        validate.not_null("customer_name", t("customer"), "c_name"), validate.foreign_key("order_customer", t("orders"), "o_custkey", t("customer"), "c_custkey"),
        validate.foreign_key("document_label", t("documents"), "doc_id", t("labels"), "doc_id"), validate.unique("order_key", t("orders"), "o_orderkey"),
        validate.unique("line_order_part", t("lineitem"), "l_orderkey", "l_partkey"), validate.count_of("negative_balance", t("customer"), F.col("c_acctbal") < 0),
    )


from gazetta.plans import services, small_functions  # noqa: E402, F401  (they register theirs, too)
