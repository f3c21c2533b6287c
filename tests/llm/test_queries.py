"""The registered queries on a small folder of tables, against plain versions; and cases that all operators share."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gazetta.llm import bpe_reuse, language_id, licenses, line_dedup, lm_scoring, near_dedup, pieces, repeats, token_files
from gazetta.llm.queries import QUERIES

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TOKEN = re.compile("[^\x20\x09-\x0d]+")


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    words = {"en": ["the", "of", "house", "green", "water", "License", "walks"], "fr": ["le", "où", "maison", "çà", "verte", "été"], "de": ["der", "Straße", "grün", "wäre", "haus"]}
    out = []
    for i in range(70):
        lang = r.choice([*words])
        text = " ".join(r.choices(words[lang] + [f"{lang}{k}" for k in range(60)], k=r.choice([1, 4, 30, 120])))
        out.append((text, lang))
    out += [out[3], out[3], out[5]]
    out += [(out[7][0] + " and more of it", out[7][1]), (None, None), ("", "en"), ("12 34 !", "en"), (" ".join(["word"] * 3000), "en"), ("x" * 3000, None)]
    out.append(("It is Licensed under the Apache License, Version 2.0; CC BY, all rights reserved. " * 2, "en"))
    long = " ".join(r.choices(words["en"], k=400))
    out += [("start " + long, "en"), (long + " end", "en")]
    return [(3 * i, t, lang) for i, (t, lang) in enumerate(out)]


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("small"))
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in corpus], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, "the of house green water walks le")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def rows_of(spark, folder, name):
    return {r.doc_id: r for r in QUERIES[name](spark, folder).collect()}


def test_token_files_query(spark, folder, corpus):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, start = rows_of(spark, folder, "op4_token_files"), 0
    for i, t, _ in sorted(corpus):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_repeats_query(spark, folder, corpus):
    first, got = {}, rows_of(spark, folder, "op5_repeats")
    for i, t, _ in sorted(corpus):
        b = (t or "").encode()
        mark = bytearray(len(b))
        for k in range(len(b) - 49):
            if first.get(b[k : k + 50], i) < i:
                mark[k : k + 50] = b"\1" * 50
        for k in range(len(b) - 49):
            first.setdefault(b[k : k + 50], i)
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(b), sum(mark), len(re.findall(b"\1+", bytes(mark))), sha(kept))


def test_bpe_query(spark, folder, corpus):
    tokenizer, got = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), rows_of(spark, folder, "op7_bpe_reuse")
    for i, t, _ in corpus:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False)))


def test_near_dedup_query(spark, folder, corpus):
    sets = {}
    for i, t, _ in corpus:
        w = TOKEN.findall((t or "").translate(LOW))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for i, a in sets.items():
            for j, b in sets.items():
                if a and 100 * len(a & b) >= 75 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    for i, x in rows_of(spark, folder, "op8_near_dedup").items():
        assert (x.n_shingles, x.component_id, x.kept) == (len(sets[i]), label[i], i == label[i])


def test_language_query(spark, folder, corpus):
    got = rows_of(spark, folder, "op6_language_id")
    right = []
    for i, t, lang in corpus:
        out = zlib.crc32(str(i).encode()) % 4 == 2
        assert got[i].held_out == out and 0 <= got[i].score <= 1
        assert (got[i].lang_pred == "und") == (re.search(r"[^\W\d_]", t or "") is None)
        if out and lang and got[i].lang_pred != "und" and len(t) > 100:
            right.append(got[i].lang_pred == lang)
    assert len(right) > 4 and sum(right) >= 0.9 * len(right)  # held-out documents alone


def test_languages_have_no_rank(spark):
    """A language of one short text among many others is learned as well."""
    data = [(i, f"{chr(97 + i % 20) * 5} " * 30, f"l{i % 20}") for i in range(400)] + [(1000, "ωωω ψψψ " * 20, "zz")]
    rows = language_id.sample(spark.createDataFrame(data, "doc_id long, text string, lang string"), size=200)
    assert len({lang for _, lang, _ in rows}) == 21 and len(rows) <= 400


def mixture(train, held, texts):
    """Plain deleted interpolation of bigram, unigram and uniform, by exact ratios."""
    end, start = None, ("start",)

    def grams(docs):
        one, two, n = Counter(), Counter(), 0
        for own in docs:
            one.update(own)
            two.update(zip([start, *own], own))  # noqa: B905
            n += 1
        one[start] = n
        return one, two

    def parts(one, two, own):
        n, v = sum(c for w, c in one.items() if w != start), sum(w != start for w in one)
        for before, w in zip([start, *own], own):  # noqa: B905
            c = one[before]
            bucket = min(lm_scoring.BUCKETS - 1, 1 + int(math.log2(c))) if c else 0
            yield bucket, (two[before, w] / c if c else 0.0, one[w] / max(1, n), 1 / (v + 1))

    assert end is None
    one, two = grams(train)
    seen = [p for own in held for p in parts(one, two, own)]
    mix = {b: np.full(3, 1 / 3) for b in range(lm_scoring.BUCKETS)}
    for _ in range(lm_scoring.ROUNDS):
        sums = {b: np.full(3, 1e-3) for b in mix}
        for b, q in seen:
            share = mix[b] * q
            sums[b] += share / share.sum()
        mix = {b: s / s.sum() for b, s in sums.items()}
    one, two = grams(train + held)
    return [sum(math.log10(float(mix[b] @ np.array(q))) for b, q in parts(one, two, own)) for own in texts]


def test_lm_query(spark, folder, corpus):
    got = rows_of(spark, folder, "op9_lm_scoring")
    own = {i: [*TOKEN.findall((t or "").translate(LOW)), None] for i, t, _ in corpus}
    part = {i: zlib.crc32(str(i).encode()) % 7 for i in own}
    want = mixture([own[i] for i in own if part[i] not in (2, 3)], [own[i] for i in own if part[i] == 3], [*own.values()])
    for i, w in zip(own, want, strict=True):
        assert got[i].held_out == (part[i] == 2)
        assert got[i].score == pytest.approx(w, rel=0.02, abs=0.05)  # ratios are rounded to an eighth of a power of two


def test_counts_do_not_wrap():
    x = np.array([[5_000_000_000, 1], [0, 7]], "u8")
    assert (lm_scoring.unpack_counts(lm_scoring.pack_counts(x)) == x).all()
    assert (lm_scoring.unpack_counts(lm_scoring.pack_counts(x % 100)) == x % 100).all()


def test_licenses_query(spark, folder, corpus):
    x = rows_of(spark, folder, "op10_licenses")[next(i for i, t, _ in corpus if t and "Apache" in t)]
    assert (x.n_base, x.base_labels, x.labels, x.score) == (4, "cc-by,reserved", "apache-2.0,cc-by,reserved", 1.0)


def test_near_dedup_recall_at_the_threshold(spark):
    """Of pairs of similarity 0.75 to 0.79 at least 99 in 100 are found."""
    r, texts = random.Random(13), []
    while len(texts) < 600:
        base = [f"p{len(texts)}w{i}" for i in range(r.randrange(104, 160))]
        other = list(base)
        for at in r.sample(range(4, len(base) - 4, 5), r.choice([3, 4])):
            other[at] = "changed" + str(at)
        a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (base, other))
        if 0.75 <= len(a & b) / len(a | b) < 0.79:
            texts += [" ".join(base), " ".join(other)]
    got = {x.doc_id: x.component_id for x in near_dedup.near_components(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")).collect()}
    assert sum(got[i + 1] == i for i in range(0, 600, 2)) >= 297


def test_links_among_sets():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 60, 400, dtype="u8")
    sets = [np.unique(np.concatenate([base[: 300 - 10 * k], r.integers(0, 1 << 60, 10 * k, dtype="u8")])) for k in range(12)] + [np.unique(r.integers(0, 1 << 60, 50, dtype="u8")) for _ in range(5)]
    label = [*range(17)]
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                both = len(np.intersect1d(a, b))
                if 100 * both >= 75 * (len(a) + len(b) - both):
                    label[i] = label[j] = min(label[i], label[j])
    got = [*range(17)]
    for a, b in near_dedup.links_among([*range(17)], [*range(17)], sets, 75) * 17:
        got[a] = got[b] = min(got[a], got[b])
    assert got == label


def test_other_tokenizers_encode_whole_texts(spark, corpus, tmp_path):
    """A tokenizer of another build than the operator is made for gives right ids as well."""
    df = spark.createDataFrame([(i, t) for i, t, _ in corpus[:20]], "doc_id long, text string")
    byte, word = (Tokenizer.from_file(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    assert pieces.is_byte_level(byte) and not pieces.is_byte_level(word) and pieces.is_word_level(word) and not pieces.is_word_level(byte)
    for x in bpe_reuse.encode_decode(df, public_tokenizers.path("byte_bpe_50k.json")).collect():
        ids = byte.encode(dict(df.collect())[x.doc_id] or "", add_special_tokens=False).ids
        assert x.ids == ids and x.decoded == byte.decode(ids, skip_special_tokens=False)
    token_files.write_token_files(df, f"{tmp_path}/t", public_tokenizers.path("word_bpe_49k.json"), 7)
    for x in token_files.read_token_files(spark, f"{tmp_path}/t").collect():
        assert x.ids == [*word.encode(dict(df.collect())[x.doc_id] or "", add_special_tokens=False).ids, 7]


def test_run_index_walks_back_through_the_text():
    r = np.random.default_rng(5)
    for text in (r.integers(0, 3, 500), np.zeros(300), np.tile(r.integers(0, 9, 20), 30)):
        text = text.astype("u1")
        rank, _ = repeats.suffix_order(text)
        order = sorted(range(len(text)), key=lambda i: text[i:].tobytes())
        assert np.argsort(rank).tolist() == order
        index, row = repeats.RunIndex(text, rank), np.array([0])
        for at in range(len(text) - 1, -1, -1):
            row = index.longer(row)
            assert row[0] == rank[at] + 1
    assert len(repeats.RunIndex(np.tile(text[:20], 30), repeats.suffix_order(np.tile(text[:20], 30))[0]).heads) < 60


@pytest.mark.parametrize("name", [*QUERIES])
def test_odd_tables(spark, tmp_path, name):
    """Null ids, repeated rows, clashing columns, and a table without rows."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    data = [(None, text), (1, text), (1, text), (1, "other text of the same id"), (2, None), (2, None), (None, None), (3, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, [1], "x", 2) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long, spans array<int>, row string, n long")
    spark.createDataFrame([(None, "nine ten"), (5, None), (5, text), (5, text)], "item_id long, text string").write.parquet(f"{tmp_path}/a/benchmark.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/b/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    full, none = (QUERIES[name](spark, f"{tmp_path}/{x}").collect() for x in "ab")
    distinct = {"op1_exact_dedup": 6}  # rows that repeat both doc_id and text are one document
    assert len(full) == distinct.get(name, len(data)) and none == []
    if name == "op5_repeats":
        assert sum(x.n_removed for x in full if x.doc_id is None) == len(text) and sum(x.n_removed for x in full if x.doc_id == 1) == 0


def test_line_positions_are_winnowed(spark):
    lines = [f"line {i} {i * 7919 % 104729}" for i in range(400)]
    df = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    chosen = line_dedup.positions(df).count()
    assert 0.4 * 400 < chosen < 0.6 * 400  # of windows of three, every second line is a minimum
    assert line_dedup.positions(df.select("doc_id", F.lit("a\nb").alias("text"))).count() == 0
    assert licenses.RARE >= licenses.VOTES
