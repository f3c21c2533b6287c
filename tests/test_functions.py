"""Scalar functions and annotations against fixed results."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gazetta.functions import annotate, dates, jsonx, text, urls, vectors


def one(spark, value, kind, *exprs):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return list(df.select(*[e(F.col("x")) for e in exprs]).first())


@pytest.mark.parametrize(("content", "words"), [("Hello world foo bar", 4), ("Hello\nworld\nfoo", 3), (None, 0), ("", 0), ("  ", 0)])
def test_words(spark, content, words):
    assert one(spark, content, "string", text.word_count) == [words]


@pytest.mark.parametrize(("content", "n"), [("First\n\nSecond\n\nThird", 3), ("First\n\n\n\nSecond", 2), (None, 0)])
def test_paragraphs(spark, content, n):
    assert one(spark, content, "string", text.paragraph_count) == [n]


def test_hour_and_day(spark):
    assert one(spark, dt.datetime(2024, 6, 17, 14, 30), "timestamp_ntz", F.hour, dates.day_of_week) == [14, 0]
    assert one(spark, dt.datetime(2024, 6, 16), "timestamp_ntz", dates.day_of_week) == [6]


def test_reading_ease(spark):
    assert one(spark, "too few words", "string", text.flesch) == [None]
    assert one(spark, " ".join(["cat"] * 10) + ".", "string", text.flesch) == [round(206.835 - 10.15 - 84.6, 2)]


@pytest.mark.parametrize(("title", "content", "digest"), [("Lula", "conteudo", "7af6a8c98b1e027b"), ("Governo anuncia programa", "Texto da notícia", "ca58538e360baaf4"), ("", None, None), ("", "", None)])
def test_content_hash(spark, title, content, digest):
    df = spark.createDataFrame([(title, content)], "a string, b string")
    assert df.select(text.content_hash(F.col("a"), F.col("b"))).first()[0] == digest


@pytest.mark.parametrize(("raw", "form"), [("Educação Pública", "educacao publica"), ("R$ 1 bilhão em 2025", "r 1 bilhao em 2025")])
def test_hash_form(spark, raw, form):
    assert one(spark, raw, "string", text.hash_form) == [form]


@pytest.mark.parametrize(("title", "slug"), [("Hello World", "hello-world"), ("R$ 100,00 — crédito & mais!", "r-100-00-credito-mais"), ("", ""), ("!@#$%", ""), ("ab " * 60, "ab-" * 33)])
def test_slug(spark, title, slug):
    assert one(spark, title, "string", text.slug) == [slug.strip("-")]


def test_readable_id_without_title(spark):
    assert one(spark, "", "string", lambda c: text.readable_id(c, F.lit("a")))[0].startswith("sem-titulo_")


@pytest.mark.parametrize(("epoch", "week"), [(1736899200, 202503), (1704067200, 202401), (0, None), (-1, None), (None, None)])
def test_iso_week(spark, epoch, week):
    assert one(spark, epoch, "long", dates.iso_week_of_epoch) == [week]


def test_aliases(spark):
    df = spark.createDataFrame([("Ministério da Educação (MEC)", "mec")], "n string, k string")
    assert df.select(text.aliases(F.col("n"), F.col("k"))).first()[0] == ["Ministério da Educação (MEC)", "Ministério da Educação", "MEC", "mec"]


def test_urls(spark):
    ok = lambda c: urls.allowed(c, ["https://a/"])
    for value, want in (("https://a/x", True), ("http://b", False), (None, True), ("", True)):
        assert one(spark, value, "string", ok) == [want]
    assert one(spark, "ftp://x", "string", urls.valid_scheme) == [False]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [round(r[0], 6) for r in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [0.707107, 0.0]


MERGES = [
    (None, '{"a":1}', {"a": 1}), ('{"a":1}', '{"b":2}', {"a": 1, "b": 2}), ('{"a":1}', '{"a":2}', {"a": 2}), ('{"a":{"x":1,"y":2}}', '{"a":{"x":3}}', {"a": {"x": 3}}),
    ('{"a":1}', '{"a":null}', {"a": None}), ('{"a":1}', "{}", {"a": 1}), ('{"a":1}', None, {"a": 1}), ('{"a":[1,{"b":[]}]}', '{"c":"é"}', {"a": [1, {"b": []}], "c": "é"}),
]


def merged(spark, old, patch):
    df = spark.createDataFrame([(old, patch)], "a string, b string")
    return json.loads(df.select(jsonx.merge(F.col("a"), F.col("b"))).first()[0])


@pytest.mark.parametrize(("old", "patch", "want"), MERGES)
def test_merge(spark, old, patch, want):
    assert merged(spark, old, patch) == want


objects = st.dictionaries(st.sampled_from("abcd"), st.one_of(st.none(), st.integers(-9, 9), st.text("xyé", max_size=3), st.dictionaries(st.sampled_from("pq"), st.booleans(), max_size=2)), max_size=4)


@settings(max_examples=15, deadline=None)
@given(rows=st.lists(st.tuples(objects, objects), min_size=1, max_size=20))
def test_merge_laws(spark, rows):
    df = spark.createDataFrame([(json.dumps(a), json.dumps(b)) for a, b in rows], "a string, b string")
    m = jsonx.merge(F.col("a"), F.col("b"))
    for (a, b), r in zip(rows, df.select(m, jsonx.merge(m, F.col("b"))).collect(), strict=True):
        assert json.loads(r[0]) == {**a, **b} == json.loads(r[1])


def test_merge_at(spark):
    df = spark.createDataFrame([('{"integrity":{"a":1,"b":2},"k":3}',), ("{}",), (None,)], "x string")
    got = [json.loads(r[0]) for r in df.select(jsonx.merge_at(F.col("x"), "integrity", F.lit('{"b":5}'))).collect()]
    assert got == [{"integrity": {"a": 1, "b": 5}, "k": 3}, {"integrity": {"b": 5}}, {"integrity": {"b": 5}}]


def entity(name, kind="ORG", count=1, canonical=None):
    return {"text": name, "type": kind, "count": count, "canonical_id": canonical}


def spans(content, *entities):
    return [(s["start"], s["end"], s["text"]) for s in annotate.annotate_text(content, entities)]


def test_annotations():
    assert spans("O MEC anunciou novidades.", entity("MEC")) == [(2, 5, "MEC")]
    assert spans("Ministério da Educação, Educação", entity("Educação"), entity("Ministério da Educação")) == [(0, 22, "Ministério da Educação"), (24, 32, "Educação")]
    assert [x[2] for x in spans("A EDUCACAO e a educação importam.", entity("Educação"))] == ["EDUCACAO", "educação"]
    assert spans("Die Straße ist hier.", entity("Strasse")) == [(4, 10, "Straße")]
    assert spans("A MECANICA do COMEÇO. Mas o MEC sim.", entity("MEC")) == [(28, 31, "MEC")]
    assert spans("o  Banco \n Central.", entity("Banco Central")) == [(3, 18, "Banco \n Central")]
    decomposed = "Educação ja"
    assert spans(decomposed, entity("Educação")) == [(0, 10, decomposed[:10])]
    assert annotate.annotate_text("MEC", [entity("MEC", "ORG", 1), entity("MEC", "POLICY", 9)])[0]["type"] == "POLICY"
    assert annotate.annotate_text(None, [entity("x")]) == [] == annotate.annotate_text("x", None)


def test_source_hash_depends_on_entities():
    a = annotate.source_digest("x", [entity("m")])
    assert a == annotate.source_digest("x", [entity("m")]) != annotate.source_digest("x", [entity("n")])


def test_to_ascii_is_nfkd(spark):
    import unicodedata

    odd = ["1º 2ª", "a\u00a0b", "ő Ő ş", "fim… x²", "½ ﬁm", "e\u0301 Å ß æ", "日本 ㎏ Ⅷ\U0001d400", "", None, "…", "a……b", "…½", "\x01…\x02"]
    odd += ["-".join(map(chr, range(a, min(a + 4096, 0xD800)))) for a in range(1, 0xD800, 4096)] + ["".join(map(chr, range(a, a + 4096))) for a in range(0xF000, 0x30000, 4096)]
    df = spark.createDataFrame([*enumerate(odd)], "i int, t string").select("i", text.to_ascii(F.col("t")).alias("a"), text.slug(F.col("t")).alias("s"), text.hash_form(F.col("t")).alias("h"), text.alias_form(F.col("t")).alias("n"))
    got = {r.i: r for r in df.collect()}
    for i, t in enumerate(odd):
        assert got[i].a == unicodedata.normalize("NFKD", t or "").encode("ascii", "ignore").decode()
    assert (got[0].s, got[0].h, got[1].s, got[1].n, got[2].s, got[3].n) == ("1o-2a", "1o 2a", "a-b", "a b", "o-o-s", "fim... x2")
