"""Operators on small frames with literal results."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from gazetta.migrations import Migration, Registry
from gazetta.operators import dedup, engagement, facts, features, graph, integrity, rolling, search, similarity, stores, trends, validate
from gazetta.sources import catalog
from gazetta.streaming import streams


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def test_rolling_counts_against_brute_force(spark):
    r = random.Random(1)
    data = [(r.choice(["a", "a", "a", None, "b"]), r.randrange(0, 20_000)) for _ in range(400)]
    got = {(x.k, x.s): (x.short, x.long) for x in rolling.rolling_counts(spark.createDataFrame(data, "k string, s long"), "k", "s", {"short": 100, "long": 9000}).collect()}
    for k, s in data:
        assert got[k, s] == tuple(sum(k2 == k and s - w <= s2 <= s for k2, s2 in data) for w in (100, 9000))
    assert len(got) == len(set(data))


def test_object_of(spark):
    df = spark.createDataFrame([(1, "b", "x", 1), (1, "a", "1", 2), (1, "b", "y", 3), (1, None, "z", 4), (2, None, "z", 1)], "e int, k string, v string, o int")
    out = df.groupBy("e").agg(engagement.object_of(F.col("k"), F.col("v"), F.col("o")).alias("j"))
    assert rows(out) == [(1, '{"a":"1","b":"y"}'), (2, None)]


def test_engagement(spark):
    df = spark.createDataFrame([("/artigos/" + "a" * 32, "s1"), ("/artigos/governo-anuncia-programa_a3f2e1", "s1"), ("/artigos/governo-anuncia-programa_a3f2e1", "s2"), ("/sobre", "s1"), ("/artigos/", "s1")], "url_path string, session_id string")
    assert rows(engagement.engagement(df)) == [("a" * 32, 1, 1), ("governo-anuncia-programa_a3f2e1", 2, 2)]


def test_graph(spark):
    e = lambda c, n=1: ("t", "ORG", n, c, 0.5)
    day = dt.datetime(2024, 1, 1)
    news = spark.createDataFrame([("u1", day, [e("q1"), e("q1", None), e("q2"), e(None), e("zz")]), ("u2", day, [e("q1"), e("q2")]), ("u3", day, [e("q1"), e("q3")])], f"unique_id string, published_at timestamp_ntz, entities {graph.ENTITIES}")
    registry = spark.createDataFrame([("q1",), ("q2",), ("q3",)], "entity_id string")
    found = graph.mentions(news, registry)
    assert rows(found, "unique_id", "entity_id", "count")[:2] == [("u1", "q1", 2), ("u1", "q2", 1)]
    assert rows(graph.co_mentions(found), "src_id", "dst_id", "weight") == [("q1", "q2", 2)]
    edges = graph.co_mentions(found, least=1)
    assert rows(graph.network(edges, "q2")) == [("q1", 1), ("q2", 0), ("q3", 2)]
    assert rows(graph.structural(spark.createDataFrame([("a", "b"), ("a", "b"), ("c", "c")], "src_id string, dst_id string"), "k")) == [("a", "b", "k")]
    assert rows(graph.export_edges(spark.createDataFrame([("a", "is_agency"), ("b", "other")], "src_id string, kind string")), "relation") == [("IS_AGENCY",)]


BASE = {"entity_id": "e", "entity_type": "ORG", "window_count": 5, "baseline_count": 10, "window_agencies": 5, "baseline_agencies": 3, "window_daily": 2.0, "baseline_daily": 0.8}


@pytest.mark.parametrize(("change", "stays"), [({}, True), ({"entity_type": "LOC"}, False), ({"window_count": 2}, False), ({"window_daily": 0.8}, False), ({"window_agencies": 3}, False), ({"baseline_agencies": 21, "window_agencies": 30}, False)])
def test_trend_filters(spark, change, stays):
    df = spark.createDataFrame([{**BASE, **change}])
    out = trends.score(df.where(trends.passes())).collect()
    assert bool(out) == stays
    if out:
        assert out[0].trending_score == pytest.approx(0.4 * 2.5 + 0.25 * 5 / 3 + 0.2 * 2.5 / 4)


def test_similar(spark):
    vectors = [[1.0, 0.0], [0.99, 0.01], [0.9, 0.3], [0.0, 1.0], None, [0.0, 0.0]]
    df = spark.createDataFrame([*enumerate(vectors)], "id long, vector array<float>")
    out = similarity.similar_topk(df.where("id = 0"), df, least=0.8, k=5)
    assert [r[:2] for r in rows(out, "unique_id", "similar_id")] == [(0, 1), (0, 2)]
    pairs = spark.createDataFrame([("a", "b", 0.95), ("a", "c", 0.85), ("b", "a", 0.95)], "unique_id string, similar_id string, similarity double")
    assert rows(similarity.grouped(pairs)) == [("a", ["b", "c"]), ("b", ["a"])]
    assert similarity.similar_topk(df.limit(0), df).count() == 0


def test_stores(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "n"), (3, "c", "m")], "k int, v string, w string")
    assert rows(stores.insert_only(old, new, "k")) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "m")]
    assert rows(stores.upsert(old, new, "k")) == [(1, "a", "x"), (2, None, "n"), (3, "c", "m")]
    assert rows(stores.upsert(old, new, "k", keep=("w",))) == [(1, "a", "x"), (2, None, "y"), (3, "c", "m")]
    assert rows(stores.update(old, new, "k", ignore_nulls=True)) == [(1, "a", "x"), (2, "b", "n")]
    assert rows(stores.delete(old, new, "k")) == [(1, "a", "x")]
    wide = spark.createDataFrame([(2, None, 7, 1), (2, "z", 8, 2), (3, "c", 9, 3)], "k int, v string, extra int, n int")
    assert rows(stores.merge_datasets(old, wide, "k", "n", True)) == [(1, "a", "x", None), (2, "b", "y", 7), (3, "c", None, 9)]
    assert rows(stores.merge_datasets(old, wide, "k", "n", False), "k", "extra") == [(1, None), (2, None), (3, 9)]


def test_merge_features(spark):
    old = spark.createDataFrame([("a", '{"x":1,"y":{"p":1}}'), ("b", "{}")], "unique_id string, features string")
    patches = spark.createDataFrame([("a", '{"x":2}', 1), ("a", '{"y":null}', 2), ("c", '{"n":1}', 1), ("zz", '{"n":1}', 1), ("b", "{}", 1)], "unique_id string, features string, at int")
    known = spark.createDataFrame([("a",), ("b",), ("c",)], "unique_id string")
    out = {r.unique_id: json.loads(r.features) for r in stores.merge_features(old, patches, known, order="at").collect()}
    assert out == {"a": {"x": 2, "y": None}, "b": {}, "c": {"n": 1}}


def test_integrity(spark):
    now = dt.datetime(2024, 6, 1)
    ago = lambda **k: now - dt.timedelta(**k)
    df = spark.createDataFrame([
        ("new", ago(hours=1), None, False), ("just", ago(hours=1), ago(minutes=5), True), ("due", ago(hours=1), ago(minutes=20), True),
        ("old", ago(days=100), ago(days=8), True), ("fresh", ago(days=100), ago(days=6), True), ("lost", ago(hours=1), None, True), ("gone", ago(days=200), None, False),
    ], "unique_id string, published_at timestamp_ntz, checked_at timestamp_ntz, has_state boolean")
    out = integrity.queue(df, now, 10).orderBy("place").collect()
    assert [(r.unique_id, r.tier, r.check_content) for r in out] == [("new", 1, True), ("due", 1, False), ("old", 5, False)]
    assert integrity.queue(df.limit(0), now, 10).count() == 0
    state = spark.createDataFrame([("a", '{"integrity":{"image_status":"broken","check_count":3},"k":1}')], "unique_id string, features string")
    results = spark.createDataFrame([("a", '{"image_status":"ok"}'), ("b", '{"image_status":"broken"}')], "unique_id string, patch string")
    got = {r.unique_id: r for r in integrity.merge_results(state, results).collect()}
    assert json.loads(got["a"].features) == {"integrity": {"image_status": "ok", "check_count": 4}, "k": 1}
    assert (got["a"].now_fixed, got["a"].now_broken, got["b"].now_fixed, got["b"].now_broken) == (True, False, False, True)


def test_dedup(spark):
    df = spark.createDataFrame([(1, "x", "u", None), (2, "x", "u", 1), (3, "x", "v", None), (4, "y", "u", None), (5, "x", None, None), (6, "x", "u", 1)], "id int, agency_key string, url string, content_embedding int")
    assert rows(dedup.url_duplicates(df)) == [("x", "u", 2, [6, 1], True)]
    a = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    b = spark.createDataFrame([("a",), ("c",)], "k string")
    assert rows(dedup.orphans(a, b, "k")) == [("b",), ("d",)]
    assert rows(dedup.orphans(b, a, "k")) == [] == rows(dedup.orphans(a.limit(0), b, "k"))
    ids = dedup.unique_ids(spark.createDataFrame([(i,) for i in range(40)], "n int"), F.lit("t"), F.md5(F.lit("same")), "n")
    assert ids.select("unique_id").distinct().count() == 40
    one, several = dedup.registry_aliases(spark.createDataFrame([("e1", "Órgão A (OA)", "oa"), ("e2", "Órgão B (OA)", "ob")], "id string, n string, k string"), "n", "k", "id")
    assert rows(several, "alias_norm") == [("oa",)]
    assert ("orgao a", "e1") in rows(one)


def test_features(spark):
    df = spark.createDataFrame([("a", "One two.\n\nThree", "", "v", dt.datetime(2024, 6, 17, 14), [("One", "ORG", 1, "q1")], None)], "unique_id string, content string, image_url string, video_url string, published_at timestamp_ntz, entities array<struct<text:string,type:string,count:int,canonical_id:string>>, features string")
    assert json.loads(features.compute(df).first().features) == {"word_count": 3, "char_count": 15, "paragraph_count": 2, "has_image": False, "has_video": True, "publication_hour": 14, "publication_dow": 0}
    first = features.annotated(df).first().features
    assert json.loads(first)["content_annotations"] == [{"start": 0, "end": 3, "type": "ORG", "text": "One", "canonical_id": "q1"}]
    assert features.annotated(df.withColumn("features", F.lit(first))).count() == 0
    assert features.outdated({k: "1.0" for k in features.VERSIONS if k != "has_image"}) == ["has_image"]
    have = spark.createDataFrame([("a", '{"word_count":3}')], "unique_id string, features string")
    assert features.missing(df.drop("features"), have, "word_count").count() == 0
    assert features.missing(df.drop("features"), have, "char_count").count() == 1


def test_search(spark):
    df = spark.createDataFrame([(1, "Educação pública", ["a", " b ", "", "x" * 101], "h"), (2, "educacao privada", None, "h"), (3, " ", [], None)], "unique_id int, title string, tags array<string>, content_hash string").withColumn("published_at", F.lit(None).cast("timestamp"))
    out = {r.id: r for r in search.documents(df).collect()}
    assert (out[1].tags, out[2].tags, out[3].title, out[3].published_at, out[3].published_week) == (["a", "b"], None, None, 0, None)
    assert rows(search.matching(df, ["educacao"], "title"), "unique_id") == [(1,), (2,)]
    assert rows(search.one_of_group(df, F.col("content_hash"), F.col("unique_id")), "unique_id") == [(1,), (3,)]
    assert rows(search.facet(df, "content_hash", "tags", top=2)) == [("content_hash", "h", 2), ("tags", " b ", 1), ("tags", "", 1)]


def test_validate(spark):
    a = spark.createDataFrame([(1, 5, None), (2, 6, "x"), (2, None, "y")], "id int, fk int, v string")
    b = spark.createDataFrame([(5,)], "id int")
    got = rows(validate.report(validate.not_null("n", a, "v"), validate.foreign_key("f", a, "fk", b, "id"), validate.unique("u", a, "id")))
    assert got == [("f", 1), ("n", 1), ("u", 1)]
    assert rows(validate.count_difference(a, b)) == [(3, 1, -2, 66.67)]


def test_facts(spark):
    day = dt.datetime(2024, 1, 2)
    news = spark.createDataFrame([("a", 1, 2, None, day, "t"), ("b", None, None, None, day + dt.timedelta(days=1), "t")], "unique_id string, theme_l1_id int, theme_l2_id int, theme_l3_id int, published_at timestamp_ntz, title string")
    themes = spark.createDataFrame([(1, "01", "One"), (2, "01.01", "Two")], "id int, code string, label string")
    feats = spark.createDataFrame([("a", '{"sentiment":{"score":0.5,"label":"pos"},"word_count":"bad","has_image":true}')], "unique_id string, features string")
    out = facts.build_facts(news, themes, feats, "2024-01-02").collect()
    assert [(r.unique_id, r.theme_l2_code, r.theme_l3_code, r.sentiment_score, r.word_count, r.has_image) for r in out] == [("a", "01.01", None, 0.5, None, True)]
    assert facts.build_facts(news, themes, feats, "2024-01-02", "2024-01-03").count() == 2
    assert rows(facts.with_themes(news, themes), "unique_id", "theme") == [("a", "Two"), ("b", None)]


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (2, "b", dt.date(2024, 1, 2))], "id int, v string, d date")
    path = f"{tmp_path}/t.parquet"
    catalog.append_days(df, path, "d")
    catalog.append_days(df.where("id = 2").withColumn("v", F.lit("c")), path, "d")
    assert rows(spark.read.parquet(path), "id", "v") == [(1, "a"), (2, "c")]
    c = catalog.Catalog(spark, str(tmp_path))
    assert c.has("t", "id") and not c.has("t", "zz") and not c.has("nothing") and c.dataset("nothing") is None
    plain = f"{tmp_path}/p"
    df.write.parquet(plain)
    catalog.replace(spark.read.parquet(plain).withColumn("id", F.col("id") + 1), plain)
    assert rows(spark.read.parquet(plain), "id") == [(2,), (3,)]
    with pytest.raises(ValueError):
        catalog.of_partitions(df, "d", None)
    assert rows(catalog.select_rows(df, {"v": None})) == [] and catalog.select_rows(df, {}, limit=0).count() == 2
    catalog.write_bronze(df.withColumn("published_at", F.col("d").cast("timestamp")), f"{tmp_path}/bronze")
    assert catalog.bronze(spark, f"{tmp_path}/bronze/year=2024", "id int, v string").count() == 2
    (tmp_path / "g.csv").write_text('id,aliases\n1,"a, b"\n')
    assert rows(catalog.gazetteer(spark, f"{tmp_path}/g.csv", "id int, aliases string")) == [(1, ["a", "b"])]
    tree = [{"code": "01", "label": "A", "children": [{"code": "01.01", "label": "B", "children": [{"code": "01.01.01", "label": "C"}]}]}]
    assert [(r[0], r[3], r[4]) for r in catalog.tree_rows(tree)] == [("01", 1, None), ("01.01", 2, "01"), ("01.01.01", 3, "01.01")]

    def fails(_):
        raise OSError("down")

    done = []
    assert isinstance(catalog.write_all(df, {"a": done.append, "b": fails})["b"], OSError) and len(done) == 1
    with pytest.raises(OSError):
        catalog.write_all(df, {"b": fails})


def test_streams(spark, tmp_path):
    import base64

    data = [(base64.b64encode(json.dumps({"unique_id": u}).encode()).decode(), dt.datetime(2024, 1, 1, 10, i)) for i, u in enumerate(["a", "b", "a"])] + [("!!", dt.datetime(2024, 1, 1)), (base64.b64encode(b"{}").decode(), dt.datetime(2024, 1, 1))]
    spark.createDataFrame(data, "data string, event_time timestamp").write.parquet(f"{tmp_path}/in")
    stream = streams.read(spark, f"{tmp_path}/in", "data string, event_time timestamp")
    good, bad = streams.envelopes(stream)
    seen, dead, marks = [], [], set()

    def handler(batch):
        ids = [r.unique_id for r in batch.collect()]
        if "b" in ids and not marks:
            seen.extend(sorted(ids))

    run = streams.handled(handler, lambda b, e: dead.append(e), marks.__contains__, marks.add)
    streams.start(streams.once(good), run, f"{tmp_path}/ck", every=None).awaitTermination(60)
    assert seen == ["a", "b"] and marks and not dead
    batch = spark.read.parquet(f"{tmp_path}/in")
    assert streams.envelopes(batch)[1].count() == 2
    poison = streams.handled(lambda b: 1 / 0, lambda b, e: dead.append(e), set().__contains__, marks.add)
    poison(batch, 99)
    assert len(dead) == 1 and 99 in marks


def test_streaming_views_equal_batch(spark, tmp_path):
    data = [(dt.datetime(2024, 1, 1 + i % 3, 5), "k", i % 4) for i in range(30)] + [(dt.datetime(2024, 2, 1), "k", 1)]
    spark.createDataFrame(data, "ts timestamp, event_type string, user_id int").write.parquet(f"{tmp_path}/in")
    out = streams.views(streams.read(spark, f"{tmp_path}/in", "ts timestamp, event_type string, user_id int"), "ts", "event_type")
    q = out.writeStream.format("memory").queryName("v").outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(60)
    got = rows(spark.table("v").select(F.to_date("start"), "views"))
    assert got == [(dt.date(2024, 1, d), 10) for d in (1, 2, 3)]


def test_migrations(spark):
    r = Registry()
    r.add(Migration(1, "a", lambda s, d: {"rows": 1}, lambda s, d: {"rows": -1}))
    r.add(Migration(2, "b", lambda s, d: 1 / 0))
    with pytest.raises(ValueError):
        r.add(Migration(2, "c", lambda s, d: {}))
    assert [(v, s) for v, s, _ in r.run(spark, set())] == [(1, "applied"), (2, "failed")]
    assert r.undo(spark, 1) == {"rows": -1}
    r.add(Migration(4, "d", lambda s, d: {}))
    with pytest.raises(ValueError):
        r.pending(set())
