"""Queries of single functions and scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions import dates, jsonx, text, urls
from gazetta.operators import features, integrity, stores
from gazetta.plans.registry import query
from gazetta.sources import catalog
from gazetta.streaming import streams


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 7")
def point_lookup(t) -> DataFrame:
    return catalog.by_id(t("orders"), "o_orderkey", 7).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, cast(floor((row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1) / 1000) AS bigint) AS page FROM orders")
def numbered_pages(t) -> DataFrame:
    return catalog.numbered_pages(t("orders"), 1000, F.desc("o_totalprice"), F.col("o_orderkey")).select("o_orderkey", F.col("page").cast("long").alias("page"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50")
def keyset_page(t) -> DataFrame:
    return catalog.keyset_page(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 100, 50)


@query("SELECT cast(floor((row_number() OVER (ORDER BY p_partkey) - 1) / 300) AS bigint) AS chunk, p_partkey FROM part")
def row_chunks(t) -> DataFrame:
    chunks = catalog.in_chunks(t("part").select("p_partkey"), 300, F.asc_nulls_last("p_partkey"))
    return chunks.select(F.col("chunk").cast("long").alias("chunk"), F.explode("rows").alias("r")).select("chunk", "r.p_partkey")


@query("""
SELECT event_id AS unique_id, event_type AS title, cast(floor(epoch(ts)) AS bigint) AS published_at_ts, cast(year(ts) AS integer) AS published_year, cast(month(ts) AS integer) AS published_month, cast(json_extract_string(props, '$.k') AS integer) AS view_count FROM events""")
def camel_rows(t) -> DataFrame:
    rows = t("events").select(F.col("event_id").alias("uniqueId"), F.col("event_type").alias("title"), F.concat(dates.iso_text(F.col("ts")), F.lit("Z")).alias("publishedAt"), F.regexp_replace("props", '"k"', '"view_count"').alias("features"), F.lit(1).alias("unknownName"))
    return catalog.from_camel(rows).drop("entities")


@query("""
SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts, '{"t":"' || event_type || '"}' AS own FROM events""")
def serialised_rows(t) -> DataFrame:
    return catalog.serialised(t("events").select("event_id", "ts", F.struct(F.col("event_type").alias("t")).alias("own")))


@query("""
SELECT o_orderkey, o_orderdate AS parsed, cast(epoch(o_orderdate) AS bigint) AS seconds, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate - INTERVAL 3 HOUR END AS normal FROM orders""")
def date_parse(t) -> DataFrame:
    key, at = F.col("o_orderkey"), F.col("o_orderdate")
    written = F.when(key % 2 == 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(at, "dd/MM/yyyy"))
    zoned = F.when(key % 5 != 0, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'+03:00'")).otherwise(F.lit("none"))
    return t("orders").select("o_orderkey", dates.parse(written).cast("timestamp_ntz").alias("parsed"), dates.parse_epoch(written).alias("seconds"), dates.normalise(zoned).alias("normal"))


@query("""
SELECT event_id, k > 50 AS large, CASE WHEN event_type = 'view' THEN 0 ELSE 1 END AS n FROM (SELECT *, cast(json_extract_string(props, '$.k') AS integer) AS k FROM events)""")
def json_arrays(t) -> DataFrame:
    k = jsonx.typed(F.col("props"), "k", "int")
    held = F.to_json(F.struct(F.array(F.struct(k.alias("v"))).alias("a")))
    coerced = F.when(F.col("event_type") == "view", "no json").otherwise(F.to_json(F.array(F.struct(k.alias("v")))))
    kind = "array<struct<v:int>>"
    return t("events").select("event_id", jsonx.contains(held, "a", kind, lambda x: x["v"] > 50).alias("large"), F.size(jsonx.as_objects(coerced, kind)).alias("n"))


@query("""
WITH p AS (SELECT p_partkey, '  ' || lower(p_name) || ' ' AS t, '  small ring ' AS q FROM part),
g AS (SELECT p_partkey, list_distinct(list_transform(range(1, length(t) - 1), lambda i: substring(t, i, 3))) AS a, list_distinct(list_transform(range(1, length(q) - 1), lambda i: substring(q, i, 3))) AS b FROM p)
SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::double, 6) AS similarity FROM g""")
def trigram_similarity(t) -> DataFrame:
    return t("part").select("p_partkey", F.round(text.trigram_similarity(F.col("p_name"), F.lit("Small Ring")), 6).alias("similarity"))


@query("""
SELECT p_partkey, p_name AS short, p_brand AS brackets, p_name || '|' || p_type AS tags FROM part""")
def names_and_tags(t) -> DataFrame:
    named = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") "))
    listed = F.concat(F.lit(" ,"), "p_name", F.lit(" , "), "p_type", F.lit(",,"))
    return t("part").select("p_partkey", text.without_parenthetical(named).alias("short"), text.parenthetical(named).alias("brackets"), F.array_join(text.split_tags(listed), "|").alias("tags"))


@query("""
SELECT page_id, 'raw/2024/01/' || lpad((1 + page_id % 9)::varchar, 2, '0') || '/' || page_id || '.html' AS path, page_id % 3 <> 0 AS valid FROM pages""")
def paths_and_schemes(t) -> DataFrame:
    day = F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("page_id") % 9).cast("int"))
    url = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("ftp"), F.substring_index("url", ":", -1))).otherwise(F.col("url"))
    return t("pages").select("page_id", urls.day_path("raw", day, F.col("page_id").cast("string"), ".html").alias("path"), urls.valid_scheme(url).alias("valid"))


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 'has_image' WHEN event_id % 3 = 0 THEN 'no_video' WHEN event_id % 5 = 0 THEN 'failed_before' ELSE 'eligible' END AS status FROM events""")
def thumbnail_states(t) -> DataFrame:
    video, failed = F.when(F.col("event_id") % 3 != 0, "v"), F.when(F.col("event_id") % 5 == 0, F.lit(True))
    return t("events").select("event_id", integrity.thumbnail_status(F.when(F.col("event_type") == "view", "i"), video, failed).alias("status"))


@query("SELECT doc_id AS unique_id, quality FROM labels WHERE doc_id % 2 = 0")
def features_of_ids(t) -> DataFrame:
    own = t("labels").select(F.col("doc_id").alias("unique_id"), F.to_json(F.struct("quality")).alias("features"))
    found = features.of_ids(own, t("documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("unique_id")))
    return found.select("unique_id", jsonx.typed(F.col("features"), "quality", "int").alias("quality"))


@query("SELECT o.o_orderkey AS k, CASE WHEN o.o_orderkey % 3 = 0 THEN -o.o_totalprice ELSE o.o_totalprice END AS p, CASE WHEN o.o_orderkey % 3 <> 0 THEN o.o_orderstatus END AS s FROM orders o")
def update_all_columns(t) -> DataFrame:
    rows = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("s"))
    new = rows.where("k % 3 = 0").select("k", (-F.col("p")).alias("p"), F.lit(None).cast("string").alias("s"))
    return stores.update(rows, new.unionByName(new.limit(1).withColumn("k", F.lit(-1).cast("long"))), "k")


# Text, and the ASCII characters of its compatibility decomposition, from the Unicode tables.
_FORMS = [
    ("nº 5, 1ª", "no 5, 1a"), ("½", "12"), ("ő š ž", "o s z"), ("ﬁm", "fim"), ("m² x…", "m2 x..."), ("a b", "a b"), ("Łódź", "odz"), ("Ção", "Cao"),
    ("ＡＢ", "AB"), ("™", "TM"), ("ßæ", ""), ("日本", ""), ("é", "e"), ("①", "1"), ("", ""),
]


@query("SELECT a AS ascii FROM (VALUES " + ", ".join(f"('{b}')" for _, b in _FORMS) + ") AS v(a)")
def ascii_forms(t) -> DataFrame:
    given = t("region").where("r_regionkey = 0").select(F.explode(F.array(*(F.lit(a) for a, _ in _FORMS))).alias("x"))
    return given.select(text.to_ascii(F.col("x")).alias("ascii"))


@query("SELECT event_type, cast(date_trunc('day', ts) AS date) AS day, count(*) AS views FROM events GROUP BY ALL")
def stream_daily_views(t) -> DataFrame:
    """The windows of a stream over the table, read as files until the end, as its last complete result."""
    import uuid

    static = t("events").select("ts", "event_type", "user_id")
    spark, name = static.sparkSession, f"views_{uuid.uuid4().hex}"
    files = static.inputFiles()  # a file by itself is read through a pattern, many through their folder
    path = f"{files[0][:-1]}[{files[0][-1]}]" if len(files) == 1 else files[0].rsplit("/", 1)[0]
    rows = streams.read(spark, path, "event_id long, ts timestamp_ntz, user_id long, event_type string").withColumn("ts", F.col("ts").cast("timestamp"))
    counted = streams.views(rows, "ts", "event_type", late="400 days").drop("users")
    counted.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).select("event_type", F.to_date("start").alias("day"), "views")
