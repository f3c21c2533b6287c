"""Each operator against a plain or brute-force version."""

from __future__ import annotations

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gazetta.llm import bpe_reuse, common, components, decontaminate, exact_dedup, language_id, licenses, line_dedup, lm_scoring, near_dedup, repeats, token_files

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TOKEN = re.compile("[^\x20\x09-\x0d]+")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def test_exact_dedup(docs, texts, empty):
    got = by_id(exact_dedup.exact_dedup(docs, block_bytes=16))
    normal = [re.sub("[\x20\x09-\x0d]", "", t or "") for t in texts]
    groups = {}
    for i, n in enumerate(normal):
        groups.setdefault(n, []).append(i)
    for i, n in enumerate(normal):
        keep = min(groups[n], key=lambda j: (-len(texts[j] or ""), j))
        assert (got[i].keep_id, got[i].group_size, got[i].kept, got[i].text_sha256) == (keep, len(groups[n]), i == keep, sha(n))
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_of_hot_groups(spark):
    data = [(i, "same text" if i % 2 else f"own {i // 4}") for i in range(5000)] + [(None, "same text"), (None, None), (7, "same text")]
    out = exact_dedup.exact_dedup(spark.createDataFrame(data, "doc_id long, text string"), block_bytes=4).collect()
    sizes = Counter(r.group_size for r in out)
    assert sizes[2501] == 2501 and sizes[2] == 2500 and len(out) == 5002 and sum(r.kept for r in out) == 1252


def windows(words):
    return [words] if 0 < len(words) < 10 else [words[i : i + 10] for i in range(len(words) - 9)]


@pytest.mark.parametrize("item_bytes", [1 << 20, 60])
def test_decontaminate(spark, docs, texts, empty, item_bytes):
    r = random.Random(1)
    long = [t for t in texts if t and len(t.split()) > 30]
    items = [" ".join(t.split()[3:20]).upper() for t in long[:6]] + ["w1 w2", "w3", "", None, "w9 w9 w9", long[0][:40], long[0]] + [" ".join(r.choices(["w1", "w2"], k=12)) for _ in range(3)]
    bench = spark.createDataFrame([*enumerate(items), (0, items[0])], "item_id long, text string")
    got = {x.doc.doc_id: x for x in decontaminate.decontaminate(docs, bench, item_bytes=item_bytes).collect()}
    split = lambda t: WORD.findall((t or "").translate(LOW))
    all_ = [(str(k), w) for k, t in enumerate(items) for w in windows(split(t))]
    for i, t in enumerate(texts):
        words, hit, found = split(t), set(), set()
        for name, w in all_:
            for at in range(len(words) - len(w) + 1):
                if words[at : at + len(w)] == w:
                    hit.update(range(at, at + len(w)))
                    found.add(name)
        x = got[i]
        assert (x.n_words, x.n_hit, x.items) == (len(words), len(hit), sorted(found))
        if hit:
            assert split(x.clean_text) == [w for k, w in enumerate(words) if k not in hit]
        else:
            assert x.clean_text is None
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert all(x.n_hit == 0 for x in decontaminate.decontaminate(docs, bench.limit(0)).collect())


def kept_lines(texts, run, long):
    lines = {i: [(k, x) for k, x in enumerate((t or "").split("\n")) if re.search(r"[^ \t\x0B\f\r]", x)] for i, t in enumerate(texts)}
    first, gone, every = {}, {}, []
    for i, own in lines.items():
        for at in range(len(own) - run + 1):
            every.append((tuple(x for _, x in own[at : at + run]), (i, at), [k for k, _ in own[at : at + run]]))
        every += [((x,), (i, at), [k]) for at, (k, x) in enumerate(own) if len(x) >= long]
    for key, place, _ in every:
        first[key] = min(first.get(key, place), place)
    for key, place, ks in every:
        if place > first[key]:
            gone.setdefault(place[0], set()).update(ks)
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())) for i, t in enumerate(texts)}, gone


def test_line_dedup(spark, empty):
    r = random.Random(2)
    pool = [f"line {i} " + "y" * r.choice([3, 30]) for i in range(30)]
    texts = ["\n".join(r.choice([*pool, "", " "]) for _ in range(r.choice([1, 6, 30]))) for _ in range(60)] + [None, "", "\n"]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").withColumns({"gone": F.lit(1), "n_lines": F.lit(2)})
    got = by_id(line_dedup.line_dedup(df.drop("n_lines"), run=2, long=25))
    want, gone = kept_lines(texts, 2, 25)
    for i, t in enumerate(texts):
        assert (got[i].kept_text, got[i].n_removed) == (want[i], len(gone.get(i, ())))
    assert line_dedup.line_dedup(empty).count() == 0


def test_pipeline_deletes_passages_of_over_50_words(spark):
    import corpus_pipeline

    line = lambda n, w, k: " ".join(f"{w}{i:0{k}}" for i in range(n))
    passages = [line(26, "a", 5) + "\n\n" + line(25, "b", 5), line(51, "c", 1), line(26, "d", 2) + "\n" + line(25, "e", 2)]
    short = line(25, "f", 2) + "\n" + line(25, "g", 2)
    assert all(len(x) < 200 for p in [*passages, short] for x in p.split("\n"))
    texts = [f"own {d}\n{p}\nend {d}" for d, p in enumerate([*passages, short] * 2)] + [None, ""]
    data = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = by_id(corpus_pipeline.drop_repeated_lines(spark, data, ""))
    for d in range(8):
        assert got[d].text == (texts[d] if d < 4 or d == 7 else f"own {d}\n" + "\n" * (d == 4) + f"end {d}")
    assert all(r.n_removed == 0 for r in line_dedup.line_dedup(data).collect())


def test_line_dedup_of_sizes_by_brute_force(spark):
    r = random.Random(8)
    pool = [" ".join(["y" * r.choice([1, 9])] * r.choice([1, 3, 5])) + f" {i}" for i in range(12)]
    texts = ["\n".join(r.choices([*pool, ""], k=r.choice([1, 3, 8]))) for _ in range(60)] + [None]
    first, gone, every = {}, {}, []
    for d, t in enumerate(texts):
        own = [(k, x) for k, x in enumerate((t or "").split("\n")) if x]
        for n in (1, 2, 3, 4):
            for at in range(len(own) - n + 1):
                w = [x for _, x in own[at : at + n]]
                if n == 4 or sum(map(len, w)) >= 45 or sum(len(x.split()) for x in w) > 9:
                    every.append((tuple(w), (d, at), [k for k, _ in own[at : at + n]]))
    for key, place, _ in every:
        first[key] = min(first.get(key, place), place)
    for key, place, ks in every:
        if place > first[key]:
            gone.setdefault(place[0], set()).update(ks)
    got = by_id(line_dedup.line_dedup(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string"), 4, 45, 9))
    assert any(gone.values()) and all(got[d].n_removed == len(gone.get(d, ())) for d in range(len(texts)))


def test_token_files(spark, docs, texts, empty, tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    path = f"file://{tmp_path}/t"
    token_files.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    got, start = by_id(token_files.read_token_files(spark, path)), 0
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids) == (start, len(ids), ids)
        start += len(ids)
    crc = by_id(token_files.read_token_files(spark, path).mapInArrow(token_files._crc, "doc_id long, start long, n_tokens long, ids_crc32 long"))
    assert crc[0].ids_crc32 == zlib.crc32(np.array(got[0].ids, "<u4").tobytes())
    token_files.write_token_files(empty, f"{path}-0", public_tokenizers.path("byte_bpe_50k.json"), 2)
    assert token_files.read_token_files(spark, f"{path}-0").count() == 0


def test_token_files_have_page_indexes(spark, docs, tmp_path):
    import pyarrow.parquet as pq

    token_files.write_token_files(docs, f"{tmp_path}/t", public_tokenizers.path("byte_bpe_50k.json"), 2)
    for p in tmp_path.glob("t/*.parquet"):
        m = pq.ParquetFile(p).metadata
        ids = m.row_group(0).column(m.num_columns - 1)
        assert "element" in ids.path_in_schema and any("DICTIONARY" in e for e in ids.encodings) and ids.has_offset_index
        assert any("DELTA" in e for e in m.row_group(0).column(1).encodings)


def test_token_files_learn_each_word_once():
    """Marks and ends of lines beside words make no pieces of their own."""
    r, words = random.Random(8), ["Haus", "größer", "the", "Éan", "x"]
    texts = ["".join(r.choice(words) + r.choice([" ", ". ", ", ", "\n", ".\n", ",\n", "!!! ", "$$\n"]) for _ in range(200)) for _ in range(50)]
    e = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    lengths, ids = e.encode(pa.array(texts), 2)
    want = [[*x.ids, 2] for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == [*map(len, want)] and ids.tolist() == sum(want, [])
    assert sum(len(x) for x in vars(e).values() if isinstance(x, dict)) <= 2 * len(words) + 10


def test_token_files_are_cut_at_safe_places_only():
    r = random.Random(9)
    near = [*" \n\t\r.,'!&<|12_", "  ", "\x00", "\x1c", "\x7f", "\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u3000", "\u200b", "’", "—", "。", "'s", "'LL", "<|endoftext|>"]
    near += ["word", "É", "ß", "×", "÷", "ƀ", "ª", "º", "µ", "²", "я", "日本", "\U0001f642", "e\u0301", "ŉ"]
    texts = ["".join(r.choice(near) for _ in range(r.choice([0, 1, 2, 5, 12]))) for _ in range(20_000)]
    e = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    lengths, ids = e.encode(pa.array(["x. ", *texts])[1:], 2)
    want = [[*x.ids, 2] for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert lengths.tolist() == [*map(len, want)] and ids.tolist() == [i for x in want for i in x]


def test_token_files_forget_long_pieces(monkeypatch):
    monkeypatch.setattr(token_files, "WORDS", 100)
    e, r = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(4)
    for _ in range(20):
        text = "".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(3000))
        _, ids = e.encode(pa.array([text]), 2)
        assert ids.tolist() == [*e.tokenizer.encode(text, add_special_tokens=False).ids, 2] and len(e.places) <= 2


def test_token_files_with_a_special_string_of_letters(tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.add_special_tokens(["stop"])
    tokenizer.save(f"{tmp_path}/t.json")
    lengths, ids = token_files.Encoder(f"{tmp_path}/t.json").encode(pa.array(["stop", "nonstop", "a stop. b"]), 2)
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in ("stop", "nonstop", "a stop. b")]
    assert lengths.tolist() == [*map(len, want)] and ids.tolist() == sum(want, [])


def test_repeats(spark, docs, texts, empty):
    first = {}
    all_ = {i: (t or "").encode() for i, t in enumerate(texts)}
    for i, b in all_.items():
        for j in range(len(b) - 49):
            first.setdefault(b[j : j + 50], i)
    got = by_id(repeats.cut_repeats(docs))
    for i, b in all_.items():
        mark = bytearray(len(b))
        for j in range(len(b) - 49):
            if first[b[j : j + 50]] < i:
                mark[j : j + 50] = b"\1" * 50
        assert [(s.start, s.end) for s in got[i].spans] == [m.span() for m in re.finditer(b"\1+", bytes(mark))]
        assert bytes(got[i].kept) == bytes(x for x, y in zip(b, mark, strict=True) if not y)
    assert repeats.cut_repeats(empty).count() == 0


def test_language_id(spark, docs, empty):
    r = random.Random(3)
    words = {"aa": ["kuba", "lomi", "keta"], "bb": ["strng", "xchto", "prff"], "cc": ["éèà", "ñuñó", "ùîô"]}
    data = [(i, " ".join(r.choices(words[k], k=r.choice([3, 40, 400]))), k) for i, k in enumerate(r.choices([*words], [8, 2, 1], k=400))]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    test = language_id.held_out(F.col("doc_id"), 4, 2)
    network = language_id.fit(df.where(~test), size=300)
    out = {x.doc.doc_id: x for x in language_id.predict(df, network).collect()}
    assert sum(out[i].lang_pred == k for i, _, k in data) >= 0.98 * len(data)
    odd = {x.doc.doc_id: x for x in language_id.predict(docs, network).collect()}
    for row in docs.collect():
        letters = bool(re.search(r"[^\W\d_]", row.text or ""))
        assert (odd[row.doc_id].lang_pred != "und") == letters and 0 <= odd[row.doc_id].score <= 1
    assert language_id.fit(empty) is None
    assert {x.lang_pred for x in language_id.predict(docs, None).collect()} == {"und"}


def test_bpe_reuse(spark, docs, texts, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = by_id(bpe_reuse.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")))
    digests = by_id(bpe_reuse.digests(bpe_reuse.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))))
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert (got[i].ids, got[i].decoded) == (ids, decoded)
        assert (digests[i].n_tokens, digests[i].ids_sha256, digests[i].decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(decoded))
    assert bpe_reuse.encode_decode(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_bpe_reuse_keeps_only_ids():
    """A word of the memory takes its own bytes and those of its ids, not its tokens."""
    r = random.Random(3)
    words = {"".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(5000)}
    c = bpe_reuse.Codec(public_tokenizers.path("word_bpe_49k.json"))
    c.learn({w.encode() for w in words})
    held = {id(x): sys.getsizeof(x) for w, v in c.words.items() for x in ((w, v) if isinstance(v, bytes) else (w, v, *v))}
    assert len(c.words) == len(words) and sum(held.values()) <= 110 * len(words)


def test_bpe_reuse_bounds_the_bytes_it_keeps(monkeypatch):
    """Scripts without spaces: a text is one word, and equal characters are one chunk."""
    monkeypatch.setattr(bpe_reuse, "KEPT", 50_000, raising=False)
    monkeypatch.setattr(bpe_reuse, "BYTES", 20_000, raising=False)
    path, r = public_tokenizers.path("word_bpe_49k.json"), random.Random(4)
    tokenizer, c = Tokenizer.from_file(path), bpe_reuse.codec(path)
    texts = ["".join(chr(r.randrange(0x4E00, 0x9000)) for _ in range(n)) for n in [3000] * 20 + [9000]] + ["x" * n for n in range(9000, 9020)] + [None, ""]
    batch, at, most = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts).cast(pa.binary())}), 0, 0
    for out in bpe_reuse._run(iter([batch, batch.slice(0, 0)]), path):
        for ids, decoded in zip(out.column("ids").to_pylist(), out.column("decoded").to_pylist(), strict=True):
            want = tokenizer.encode(texts[at] or "", add_special_tokens=False).ids
            assert (ids, decoded) == (want, tokenizer.decode(want, skip_special_tokens=False))
            at += 1
        most = max(most, sum(map(len, [*c.words, *c.chunks])))
    assert at == len(texts) and most <= 2 * (50_000 + 30_000) and not c.words and not c.chunks


def shingle_set(t):
    w = TOKEN.findall((t or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_near_dedup(docs, texts, empty):
    sets = [shingle_set(t) for t in texts]
    parent = [*range(len(texts))]

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    got = by_id(near_dedup.near_components(docs))
    for i, s in enumerate(sets):
        assert (got[i].n_shingles, got[i].component_id) == (len(s), root(i))
    assert near_dedup.near_components(empty).count() == 0


def test_near_dedup_keeps_chains_and_ignores_common_passages(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    chain = [[r.choice(words) for _ in range(120)]]
    for _ in range(30):
        own = list(chain[-1])
        own[r.randrange(120)] = r.choice(words)
        chain.append(own)
    passage = [r.choice(words) for _ in range(60)]
    lonely = [passage + [r.choice(words) for _ in range(60)] for _ in range(80)]
    every = chain + lonely
    ids = r.sample(range(1000), len(every))
    out = by_id(near_dedup.near_components(spark.createDataFrame([(i, " ".join(w)) for i, w in zip(ids, every, strict=True)], "doc_id long, text string")))
    assert {out[i].component_id for i in ids[: len(chain)]} == {min(ids[: len(chain)])}
    assert all(out[i].component_id == i for i in ids[len(chain) :])


def test_near_dedup_finds_links_whose_buckets_are_led_by_others(spark):
    """In each group 20 texts with smaller ids, near neither, lead the buckets of the last two, of similarity 0.77."""
    r, texts = random.Random(9), []
    for g in range(100):
        base = [f"g{g}w{i}" for i in range(204)]
        places = r.sample(range(5, 200, 6), 30)
        for k in range(22):
            own = list(base)
            for at in r.sample(places[5:], 6) if k < 20 else places[:2] if k == 20 else places[2:5]:
                own[at] = f"g{g}k{k}at{at}"
            texts.append(" ".join(own))
    got = by_id(near_dedup.near_components(spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")))
    sets = [shingle_set(t) for t in texts]
    for g in range(0, len(texts), 22):
        assert all(100 * len(sets[g + i] & sets[j]) < 75 * len(sets[g + i] | sets[j]) for i in range(20) for j in (g + 20, g + 21))
        assert 100 * len(sets[g + 20] & sets[g + 21]) >= 75 * len(sets[g + 20] | sets[g + 21])
        assert got[g + 21].component_id == g + 20


def test_sketch_fills_and_estimates():
    r = np.random.default_rng(0)
    for n in (1, 3, 50, 5000):
        x = r.integers(0, 1 << 63, n, dtype="u8")
        assert (near_dedup.sketch(x) != np.iinfo("u8").max).all()
    a = r.integers(0, 1 << 63, 1000, dtype="u8")
    b = np.concatenate([a[:800], r.integers(0, 1 << 63, 200, dtype="u8")])
    assert abs((near_dedup.sketch(a) == near_dedup.sketch(b)).mean() - 800 / 1200) < 0.1


def test_components(spark):
    r = random.Random(6)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(90)]
    links = [(a, b) for a, b in links if a != b]
    near = {}
    for a, b in links:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for row in components.components(spark.createDataFrame(links, "a long, b long")).collect():
        seen, todo = set(), [row.node]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += near[x]
        assert row.component == min(seen)


def test_lm_scoring(docs, texts, empty):
    out = language_id.held_out(F.col("doc_id"), 7, 2)
    got = by_id(lm_scoring.score(docs, ~out, language_id.held_out(F.col("doc_id"), 7, 3)))
    tokens = {i: [*TOKEN.findall((t or "").translate(LOW)), None] for i, t in enumerate(texts)}
    train = [i for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for i in train for w in tokens[i])
    n, v = sum(count.values()), len(count)
    for i, own in tokens.items():
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        x = got[i]
        assert (x.n_tokens, x.n_known, x.train_tokens) == (len(own), sum(count[w] > 0 for w in own), n)
        assert x.base_score == pytest.approx(base) and math.isfinite(x.score) and x.score < 0
    assert sum(x.score for x in got.values()) > sum(x.base_score for x in got.values())
    assert lm_scoring.score(empty, F.lit(True), F.lit(False)).count() == 0


def test_weights_maximise_held_out_likelihood():
    side = 2 * lm_scoring.RATIO_BITS * lm_scoring.STEP + 2
    high = int(lm_scoring._rounded(np.array([1024.0]))[0])
    cells = np.array([(3 * side + high) * side + 0, (3 * side + 0) * side + high])
    mix = lm_scoring.weights(cells, np.array([90.0, 10.0]))
    assert mix[:, 3] == pytest.approx([0.9, 0.1, 0.0], abs=0.02)
    assert mix.sum(0) == pytest.approx(np.ones(lm_scoring.BUCKETS))


def test_licenses(spark, docs, texts, empty):
    more = ["CC-BY cc by, All Rights RESERVED the General public LICENSE", "ccK by cc byK licenKe", "Licensed under the Apache License, Version 2.0", "x " * 50 + "Released under the MIT license.", "mit license", None]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    got = by_id(licenses.license_scan(df))
    for i, t in [*enumerate(texts), *((1000 + i, t) for i, t in enumerate(more))]:
        w = WORD.findall((t or "").translate(LOW))
        places = [(k, label) for p, label in licenses.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        x = got[i]
        assert (x.n_words, x.n_base, x.first_word, x.last_word) == (len(w), len(places), min([k for k, _ in places], default=None), max([k for k, _ in places], default=None))
        assert x.base_labels == ",".join(sorted({label for _, label in places})) and 0 <= x.score <= 1
        assert set(filter(None, x.base_labels.split(","))) <= set(filter(None, x.labels.split(",")))
    assert (got[1002].labels, got[1003].labels, got[1004].labels) == ("apache-2.0", "mit", "")
    assert licenses.license_scan(empty).count() == 0


def test_licenses_finds_several_in_one_long_text(spark):
    text = {label: words for label, words, _ in reversed(licenses.TEMPLATES)}
    full = {label: max((w for x, w, _ in licenses.TEMPLATES if x == label), key=len) for label in text}
    prose = " ".join(["person files copy source purpose software deed waiving mozilla affero creative dedicated"] * 300)
    sets = [["mit", "apache-2.0"], ["bsd", "mit"], ["apache-2.0", "bsd", "gpl-3.0", "mit"], ["mit"], sorted(full)]
    data = [(i, f" {prose} ".join([full, text][i == 1][k] for k in labels) + f" {prose}") for i, labels in enumerate(sets)]
    got = by_id(licenses.license_scan(spark.createDataFrame(data, "doc_id long, text string")))
    for i, labels in enumerate(sets):
        assert set(labels) <= set(got[i].labels.split(",")) and got[i].score == 1.0


def test_native_operators_run_no_python(docs):
    for df in (exact_dedup.exact_dedup(docs), line_dedup.line_dedup(docs), licenses.license_scan(docs)):
        assert not re.search("Python|Pandas|MapInArrow|ArrowEval", df._jdf.queryExecution().executedPlan().toString())


def test_scratch_of_tests(spark):
    assert common.scratch(spark).endswith("/tmp/checkpoints")
