"""Jobs, the command line, and the larger compositions on small frames."""

from __future__ import annotations

import datetime as dt
import json
import random
import struct
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from gazetta import jobs, session
from gazetta.__main__ import arguments
from gazetta.functions import annotate, text, vectors
from gazetta.migrations import Migration, Registry
from gazetta.operators import engagement, facts, graph, integrity, search, similarity, stores, trends
from gazetta.sources import catalog

DAY = dt.datetime(2024, 6, 1)
LONG = "One two three four five six seven eight nine ten. Agência One."


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("catalogue"))

    def put(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{d}/{name}.parquet")

    e = lambda t, kind="ORG", c=None: {"text": t, "type": kind, "count": 1, "canonical_id": c, "salience": 0.5}
    ids = [f"n{i}" for i in range(12)]
    news = [(u, i % 3, f"a{i % 3}", f"Agency {i % 3}", f"Title {u}", LONG if i % 2 else "Short.", "", None, 1, 2, None, 2, DAY - dt.timedelta(days=i // 4, hours=i), None, "h" if i != 9 else None, [1.0, float(i % 2), 0.0]) for i, u in enumerate(ids)]
    put("news", news, "unique_id string, agency_id int, agency_key string, agency_name string, title string, content string, image_url string, video_url string, theme_l1_id int, theme_l2_id int, theme_l3_id int, most_specific_theme_id int, published_at timestamp_ntz, extracted_at timestamp_ntz, content_hash string, content_embedding array<float>")
    put("themes", [(1, "01", "One"), (2, "01.01", "Two")], "id int, code string, label string")
    put("agencies", [(i, f"a{i}", f"Agency {i}", "a0" if i else None) for i in range(3)], "id int, key string, name string, parent_key string")
    feats = [(u, json.dumps({"entities": [e("Agency 0", c="q0"), e(" agency 1 ")], "word_count": 3})) for u in ids[:6]] + [(ids[6], "{}")]
    put("news_features", feats, "unique_id string, features string")
    put("entity_registry", [("q0", "Agency 0", "ORG", "a0", "agencies_seed", None, '{"parent_qid":"q1"}'), ("q1", "Agency 1", "ORG", "a1", "agencies_seed", None, "{}"), ("q2", "Twin", "ORG", "a1", "found", None, "{}")], "entity_id string, canonical_name string, type string, agency_key string, provenance string, wikidata_id string, extra string")
    put("entity_aliases", [("agency 1", "q1")], "alias_norm string, entity_id string")
    put("fato_noticias", [("x", "01", DAY - dt.timedelta(days=2))], "unique_id string, theme_l1_code string, published_at timestamp_ntz")
    put("umami_pageviews", [(f"/artigos/{ids[0]}", "s1", DAY), (f"/artigos/{ids[0]}", "s2", DAY), ("/artigos/other", "s1", DAY)], "url_path string, session_id string, created_at timestamp_ntz")
    put("website_event", [(1, "s1", 1, "/a", None, DAY), (2, "s1", 2, "/a", "click", DAY)], "event_id int, session_id string, event_type int, url_path string, event_name string, created_at timestamp_ntz")
    put("session", [("s1", "pt")], "session_id string, language string")
    put("event_data", [(2, "k", "v", None)], "website_event_id int, data_key string, string_value string, number_value double")
    return catalog.Catalog(spark, d)


def features_of(df):
    return {r.unique_id: json.loads(r.features) for r in df.collect()}


def test_fact_jobs(tables):
    out = jobs.sync_facts(tables, "2024-05-31", "2024-06-01")
    assert len(out.columns) == 26 and out.schema["word_count"].dataType.simpleString() == "int"
    assert {r.most_specific_theme_code for r in out.collect()} == {"01.01"}
    back = jobs.backfill_facts(tables, "2024-05-28", "2024-06-01")
    status = {r.day: r.status for r in back["days"].collect()}
    assert status[dt.date(2024, 5, 30)] in ("loaded", "new") and "failed" in status.values()
    assert back["fato_noticias"].where("content_hash is null").count() == 0
    assert set(jobs.sync_dimensions(tables)) == {"dim_agencies", "dim_themes"}
    with pytest.raises(Exception, match="required"):
        facts.conform(out.withColumn("synced_at", F.lit(None).cast("timestamp_ntz"))).collect()


def test_feature_jobs(tables):
    views = features_of(jobs.aggregate_engagement(tables, DAY))
    assert (views["n0"]["view_count"], views["n0"]["unique_sessions"], views["n0"]["word_count"]) == (2, 2, 3) and "other" not in views
    near = features_of(jobs.similar_articles(tables, DAY, days=1, least=0.8, k=2))
    # all even articles have one vector: any two of them, ties by hash
    assert len(near["n0"]["similar_articles"]) == 2 and set(near["n0"]["similar_articles"]) <= {f"n{i}" for i in (2, 4, 6, 8, 10)}
    made = features_of(jobs.compute_features(tables))
    assert made["n7"]["word_count"] == 12 and made["n1"]["word_count"] == 3 and "readability_flesch" in made["n7"]
    assert [s["type"] for s in made["n1"]["content_annotations"]] == [] or made["n1"]["content_annotations"][0]["type"] == "ORG"
    filled = features_of(jobs.backfill_features(tables, "2024-05-01", "2024-07-01", limit=3))
    assert sum("publication_dow" in f for f in filled.values()) == 3
    known = features_of(jobs.canonicalise_entities(tables))
    assert [x["canonical_id"] for x in known["n0"]["entities"]] == ["q0", "q1"]
    named = jobs.recognise_entities(tables, lambda news: news.select("unique_id", F.lit('{"entities":[]}').alias("features")))
    assert features_of(named)["n11"] == {"entities": []} and len(features_of(named)["n0"]["entities"]) == 2


def test_trending_job(tables):
    assert features_of(jobs.compute_trending(tables, DAY))["n0"]["word_count"] == 3


def test_graph_and_trend_jobs(spark, tables, tmp_path):
    out = jobs.project_graph(tables, least=1)
    kinds = {(r.src_id, r.dst_id, r.kind): r.weight for r in out["entity_edges"].collect()}
    assert kinds == {("q2", "q1", "is_agency"): 0, ("q1", "q0", "subordinate_to"): 0, ("q2", "q0", "subordinate_to"): 0, ("q0", "q1", "subordinate_to"): 0}
    for name, df in out.items():
        df.write.parquet(f"{tables.root}/{name}.parquet")
    scores = jobs.entity_trending(tables, DAY + dt.timedelta(days=1), novelty=True)
    assert rows(scores, "entity_id", "canonical_name", "window_count", "window_agencies") == [("q0", "Agency 0", 6, 3)]
    tested = jobs.backtest_trends(tables, DAY + dt.timedelta(days=1), points=3)
    assert tested["mean"].first().ndcg == 1.0
    spark.createDataFrame([("old", "x", None, None, None), ("q0", "x", None, None, None)], "entity_id string, name string, type string, wikidata_id string, agency_key string").write.parquet(f"{tables.root}/graph_nodes.parquet")
    spark.createDataFrame([("old", "q0", "IS_AGENCY", 1, 1, None, None)], "src_id string, dst_id string, relation string, weight long, article_count long, first_seen string, last_seen string").write.parquet(f"{tables.root}/graph_edges.parquet")
    merged = jobs.export_graph(tables)
    assert rows(merged["stale_nodes"], "entity_id") == [("old",)] and rows(merged["graph_nodes"], "entity_id") == [("q0",), ("q1",), ("q2",)]
    assert ("old", "q0") not in rows(merged["graph_edges"], "src_id", "dst_id")
    nodes, _, stale = graph.merge_graph(tables.table("graph_nodes"), tables.table("graph_edges"), tables.table("entity_registry").limit(0), graph.export_edges(tables.table("entity_edges")))
    assert stale.count() == 0 and nodes.count() == 2


def test_search_jobs(spark, tables):
    docs = jobs.sync_search(tables, "2024-05-25", "2024-06-01")
    one = {r.id: r for r in docs.collect()}["n0"]
    assert (one.agency, one.most_specific_theme_label, one.entities, one.entity_canonical, one.word_count, one.published_year) == ("a0", "Two", ["Agency 0", "agency 1"], ["q0"], 3, 2024)
    docs.write.parquet(f"{tables.root}/search_documents.parquet")
    _, stats = search.import_documents(docs, docs.limit(2))
    assert stats["skipped"]
    again, stats = search.import_documents(docs, docs.limit(2), force=True)
    assert stats == {"total_processed": 2, "total_indexed": 2, "errors": 0, "skipped": False} and again.count() == docs.count()
    _, stats = search.import_documents(docs, docs.withColumn("id", F.when(F.col("id") != "n1", F.col("id"))), mode="incremental")
    assert stats["errors"] == 1
    assert jobs.detect_orphans(tables).count() == 0 and jobs.delete_orphans(tables).count() == 12


def test_event_and_check_jobs(tables):
    out = jobs.sync_events(tables, DAY, DAY + dt.timedelta(days=1))
    assert rows(out["umami_pageviews"], "event_id") == [(1,)] and rows(out["umami_events"], "event_data") == [('{"k":"v"}',)]
    assert jobs.integrity_queue(tables, DAY + dt.timedelta(days=1), 5).count() == 5
    assert jobs.thumbnails(tables, 5).count() == 0


def test_jobs_are_ordered():
    assert set(jobs.AFTER) | {x for v in jobs.AFTER.values() for x in v} <= set(jobs.JOBS)


def test_arguments():
    assert arguments("entity_trending", {"end": "2024-06-01"}) == {"end": DAY}
    assert arguments("sync_facts", {"start": "2024-06-01", "end": "2024-06-02"}) == {"start": "2024-06-01", "end": "2024-06-02"}
    with pytest.raises(ValueError, match="needs start"):
        arguments("sync_facts", {"end": "2024-06-01"})
    with pytest.raises(ValueError, match="takes no limit"):
        arguments("sync_facts", {"start": "2024-06-01", "limit": 3})


def test_command_line(tables, tmp_path, spark):
    from gazetta.__main__ import main

    main(["thumbnails", "--tables", tables.root, "--out", str(tmp_path), "--limit", "3"])
    assert spark.read.parquet(f"{tmp_path}/thumbnails.parquet").count() == 0


def test_ascii_forms_against_unicode(spark):
    r = random.Random(2)
    given = ["nº 5", "1ª", "a b", "ő š ž", "½ ² …", "ﬁ ﬀ ﬃ", "Ⅷ ㎏ ℃", "ÀÇÑ", "Łß", "日本"] + ["".join(chr(r.choice([r.randrange(32, 0x3000), r.randrange(0xF900, 0xFFFD), r.randrange(32, 128)])) for _ in range(30)) for _ in range(200)]
    given = [x for x in given if "\x01" not in x and "\x02" not in x]
    got = [x.a for x in spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, x string").orderBy("i").select(text.to_ascii(F.col("x")).alias("a")).collect()]
    assert got == [unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode() for x in given]


def test_binary_vectors(spark):
    vector = [0.0, -0.0, 1.0, -2.5, 3.14159, 1e-40, -1e30, 0.1]
    data = struct.pack(f"!H{len(vector)}f", len(vector), *vector)
    df = spark.createDataFrame([(1, data), (2, data[:-1]), (3, b""), (4, None)], "i int, b binary")
    out = {x.i: x.v for x in df.select("i", vectors.parse_binary(F.col("b")).alias("v")).collect()}
    assert out[1] == list(struct.unpack(f"!{len(vector)}f", data[2:])) and out[2] is out[3] is out[4] is None


def test_annotations_follow_the_match():
    entities = [{"text": "Orgão X", "type": " org ", "count": 1, "canonical_id": "q"}, {"text": "ao x y", "type": None, "count": 9, "canonical_id": None}]
    found = annotate.annotate_text("O órgão X e o Orgão  x.", entities)
    assert [(s["type"], s["text"]) for s in found] == [("ORG", "órgão X"), ("ORG", "Orgão  x")]


def test_co_mentions_of_crowded_articles(spark, monkeypatch):
    monkeypatch.setattr(graph, "ENTITIES_AT_ONCE", 5)
    r = random.Random(4)
    data = [(f"u{u}", f"e{e}", DAY) for u, n in enumerate([3, 5, 6, 20, 40]) for e in r.sample(range(50), n)]
    df = spark.createDataFrame(data + data[:7], "unique_id string, entity_id string, published_at timestamp_ntz")
    want = {}
    for u in {x[0] for x in data}:
        own = sorted({x[1] for x in data if x[0] == u})
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                want[a, b] = want.get((a, b), 0) + 1
    assert {(x.src_id, x.dst_id): x.weight for x in graph.co_mentions(df, least=1).collect()} == want
    assert graph.co_mentions(df.limit(0)).count() == 0


def test_similar_in_blocks(spark, monkeypatch):
    r = random.Random(6)
    data = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(120)] + [(200, None), (201, [0.0] * 4)]
    df = spark.createDataFrame(data, "id long, vector array<float>").repartition(3)
    whole = rows(similarity.similar_topk(df, df, least=0.3, k=4), "unique_id", "similar_id", "rank")
    monkeypatch.setattr(similarity, "BLOCK", 25)
    assert rows(similarity.similar_topk(df, df, least=0.3, k=4), "unique_id", "similar_id", "rank") == whole and len(whole) > 300
    grouped = df.withColumn("key", (F.col("id") % 3).cast("string"))
    centre = {x.key: x.centroid for x in similarity.centroids(grouped, "key").collect()}
    for k in "012":
        own = [v for i, v in data if str(i % 3) == k and v is not None]
        assert centre[k] == pytest.approx([sum(c) / len(own) for c in zip(*own, strict=True)], abs=1e-6)


def test_results_in_order(spark):
    state = spark.createDataFrame([("a", "{}")], "unique_id string, features string")
    results = spark.createDataFrame([("a", '{"image_status":"zz"}', 1), ("a", '{"image_status":"aa"}', 2)], "unique_id string, patch string, at int")
    assert json.loads(integrity.merge_results(state, results, "at").first().features)["integrity"]["image_status"] == "aa"


def test_event_objects_keep_the_last_value(spark):
    data = [(1, f"k{i % 50}", str(i), i) for i in range(400)]
    out = spark.createDataFrame(data, "e int, k string, v string, o int").groupBy("e").agg(engagement.object_of(F.col("k"), F.col("v"), F.col("o")).alias("j")).first().j
    assert json.loads(out) == {f"k{i}": str(350 + i) for i in range(50)}


def test_pages_and_chunks(spark):
    df = spark.range(95).withColumn("v", 95 - F.col("id")).repartition(7)
    paged = rows(catalog.numbered_pages(df, 10, F.col("v")), "id", "page")
    assert all(page == (94 - i) // 10 for i, page in paged) and len(paged) == 95
    assert catalog.batch_statistics(95, 10) == {"total": 95, "batch_size": 10, "batches": 10, "last_batch": 5}
    assert [len(r.rows) for r in catalog.in_chunks(df, 30, F.col("v")).orderBy("chunk").collect()] == [30, 30, 30, 5]
    assert rows(catalog.keyset_page(df.select("id"), "id", 90, 10)) == [(91,), (92,), (93,), (94,)] and catalog.count_rows(df, {"id": 3}) == 1


def test_pages_and_chunks_of_several_partitions(spark):
    """More rows than a sort samples, in partitions that are not joined: two sorts would draw other bounds."""
    df = spark.range(100_000).withColumn("v", 99_999 - F.col("id")).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunks = {r.chunk: [x.id for x in r.rows] for r in catalog.in_chunks(df.select("id"), 300, F.col("id")).collect()}
        assert sum(len(x) for x in chunks.values()) == 100_000
        assert chunks == {k: list(range(300 * k, min(100_000, 300 * k + 300))) for k in range(334)}
        assert catalog.numbered_pages(df, 300, F.col("v")).where("page <> floor(v / 300)").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [x.id for x in catalog.in_chunks(df.select("id"), 300, F.desc("id")).where("chunk = 333").first().rows] == [*range(99, -1, -1)]


def test_cut_and_stored_tables_leave_no_shuffle_files(spark, tmp_path):
    common = pytest.importorskip("gazetta.llm.common")
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}
    before = files()
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    tables = [session.cut(df), common.stored(df)[0]]  # df stays, so a collection of garbage would leave its files
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert all(rows(x, "k", "count") == [(k, 100) for k in range(10)] for x in [*tables, df, df])
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_replace_heals_a_cut_off_swap(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(f"{path}-before")
    catalog.replace(spark.read.parquet(f"{path}-before").where("id < 2"), path)
    assert spark.read.parquet(path).count() == 2
    catalog.replace(spark.range(7), f"{tmp_path}/new")
    assert spark.read.parquet(f"{tmp_path}/new").count() == 7


def test_masters_and_probes(spark, tables):
    assert rows(catalog.agencies_of(spark, {"b": {"name": "B", "parent": "a"}, "a": {"name": "A", "type": "t", "url": "u"}})) == [("a", "A", "t", None, "u"), ("b", "B", None, "a", None)]
    assert catalog.probe(tables, {"themes": ("id", "zz"), "nothing": ("id",)}) == {"themes": ["zz"], "nothing": None}


def test_rekeying_needs_legacy_ids(spark):
    news = spark.createDataFrame([("a", None), ("b", "x")], "unique_id string, legacy_unique_id string")
    with pytest.raises(ValueError):
        stores.undo_rekey(news, news)


def test_stamp(spark):
    r = Registry()
    for v in (1, 2, 3):
        r.add(Migration(v, f"m{v}", lambda s, d: {}))
    assert [(v, s) for v, s, _ in r.stamp(2, {1})] == [(2, "stamped")]
    with pytest.raises(ValueError):
        r.stamp(9, set())


def test_scores_keep_names(spark):
    old = spark.createDataFrame([("a", "Old", "T", 1.0, 1.0, 1, 1, None)], "entity_id string, canonical_name string, type string, trending_score double, volume_ratio double, window_count int, window_agencies int, computed_at timestamp_ntz")
    new = spark.createDataFrame([("a", "New", "ORG", 2.0, 3.0, 4, 5), ("b", None, "ORG", 2.0, 3.0, 4, 5), ("c", "C", None, 2.0, 3.0, 4, 5)], "entity_id string, canonical_name string, entity_type string, trending_score double, volume_ratio double, window_count int, window_agencies int")
    out = trends.persist(old, new, F.lit(DAY).cast("timestamp_ntz"))
    assert rows(out, "entity_id", "canonical_name", "type", "trending_score") == [("a", "Old", "T", 2.0), ("c", "C", "", 2.0)]


def test_stems(spark):
    df = spark.createDataFrame([(1, "Novas ações dos hospitais"), (2, "nova ação do hospital"), (3, "os papéis e o homem"), (4, None)], "i int, t string")
    assert rows(search.matching_stems(df, "ação hospitais", "t"), "i") == [(1,), (2,)]
    assert rows(search.matching_stems(df, "papel dos homens", "t"), "i") == [(3,)]
    assert search.matching_stems(df, "de os para", "t").count() == 4
    words = ["acoes", "paes", "hospitais", "papeis", "farois", "homens", "flores", "luzes", "casas", "mes", "onibus"]
    got = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").orderBy("i").select(search.stem(F.col("w")).alias("s")).collect()
    assert [x.s for x in got] == ["acao", "pao", "hospital", "papel", "farol", "homem", "flor", "luz", "casa", "mes", "onibu"]
