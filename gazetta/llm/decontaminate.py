"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton of all items is built over words. Document words are streamed through it; it
yields the length of the longest suffix read so far that occurs in some item. Wherever that is
at least `window` words, or covers a whole item that has fewer, the words are hit. Runs of hit
words are the spans that are cut from the text; a document of which more than a given share is
hit can be dropped by its `coverage`.

Test items are bounded per automaton (ITEM_BYTES of text): a larger test set is dealt into
several automata, and documents pass one after the other. Documents are never shuffled.

Defined results: null or wordless texts have no words and no hits; a null or wordless item never
matches; an item with a null item_id is cut but not listed; equal item_ids are listed once;
repeated rows are judged one by one; extra columns are ignored; empty tables give no hits or rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, table

WINDOW = 10
#: Bytes of item text in one automaton, which takes about a hundred times as much memory.
ITEM_BYTES = 1 << 20
FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"

#: Words are runs of [0-9a-z] and non-ASCII bytes after lower-casing A-Z; the length in bytes stays.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


class Automaton:
    """Generalised suffix automaton of word sequences.

    full[v] lists (length, item) of items shorter than the window that end in state v or in its
    suffixes; tops[v] is the state of the last `window` words of state v; items[u] the items in
    which such a state occurs.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window, self.next, self.link, self.size = window, [{}], [-1], [0]
        ends = [(name, words, self._add(words)) for name, words in items if words]
        self.least = min([window, *(len(words) for _, words, _ in ends)])
        n = len(self.next)
        self.tops = [self._top(v) for v in range(n)]
        self.items: dict[int, set] = {}
        own: dict[int, list] = {}
        for name, words, states in ends:
            if len(words) < window:
                own.setdefault(self._state(words), []).append((len(words), name))
            for v in states:
                while v > 0 and self.size[v] >= window:
                    seen = self.items.setdefault(v, set())
                    if name in seen:
                        break
                    seen.add(name)
                    v = self.link[v]
        self.full: dict[int, list] = {}
        if own:
            for v in sorted(range(1, n), key=self.size.__getitem__):
                if found := own.get(v, []) + self.full.get(self.link[v], []):
                    self.full[v] = found

    def _new(self, size: int, link: int, moves: dict) -> int:
        self.size.append(size)
        self.link.append(link)
        self.next.append(moves)
        return len(self.size) - 1

    def _split(self, v: int, word: bytes, child: int) -> int:
        """The state of the longest string of v followed by word, cut from child if that is longer."""
        if self.size[child] == self.size[v] + 1:
            return child
        copy = self._new(self.size[v] + 1, self.link[child], dict(self.next[child]))
        while v >= 0 and self.next[v].get(word) == child:
            self.next[v][word] = copy
            v = self.link[v]
        self.link[child] = copy
        return copy

    def _add(self, words: list[bytes]) -> list[int]:
        last, states = 0, []
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word, self.next[last][word])
            else:
                v, fresh = last, self._new(self.size[last] + 1, 0, {})
                while v >= 0 and word not in self.next[v]:
                    self.next[v][word] = fresh
                    v = self.link[v]
                if v >= 0:
                    self.link[fresh] = self._split(v, word, self.next[v][word])
                last = fresh
            states.append(last)
        return states

    def _state(self, words: list[bytes]) -> int:
        v = 0
        for word in words:
            v = self.next[v][word]
        return v

    def _top(self, v: int) -> int:
        while v > 0 and self.size[self.link[v]] >= self.window:
            v = self.link[v]
        return v

    def stream(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Maximal [start, end) of hit words, and the items of which a window occurs."""
        after, link, size, window, least = self.next, self.link, self.size, self.window, self.least
        state = length = 0
        spans: list[list[int]] = []
        found: set = set()
        for at, word in enumerate(words):
            to = after[state].get(word)
            if to is None:
                while state and to is None:
                    state = link[state]
                    to = after[state].get(word)
                if to is None:
                    length = 0
                    continue
                length = size[state]
            state = to
            length += 1
            if length < least:
                continue
            reach = 0
            if length >= window:
                reach = window
                found |= self.items.get(self.tops[state], set())
            for n, name in self.full.get(state, ()):
                if n <= length:
                    reach = max(reach, n)
                    found.add(name)
            if reach:
                start = at + 1 - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, at + 1])
        return spans, found


def _mark(batches: Iterator[pa.RecordBatch], automaton) -> Iterator[pa.RecordBatch]:
    a = automaton.value
    for batch in batches:
        n_words, all_spans, all_items = [], [], []
        spans_before, items_before = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
        for text, spans, items in zip(batch.column("text"), spans_before, items_before, strict=True):
            words = words_of(text.as_py() or b"")
            more, found = a.stream(words)
            n_words.append(len(words))
            all_spans.append(_merge(spans, more) if spans else [{"start": s, "end": e} for s, e in more])
            all_items.append(sorted({*items, *(x for x in found if x is not None)}))
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("text"), pa.array(n_words, pa.int64()), pa.array(all_spans, spans_type), pa.array(all_items, pa.list_(pa.string()))], names=["doc", "text", "n_words", "spans", "items"])


def _merge(spans: list[dict], more: list[list[int]]) -> list[dict]:
    out: list[list[int]] = []
    for s, e in sorted([[x["start"], x["end"]] for x in spans] + more):
        if out and out[-1][1] >= s:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [{"start": s, "end": e} for s, e in out]


def _cut_spans(text: bytes, spans: list[dict]) -> bytes:
    """text without the bytes from the first to the last word of each span."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(WORDS))]
    kept, at = [], 0
    for x in spans:
        kept.append(text[at : places[x["start"]][0]])
        at = places[x["end"] - 1][1]
    return b"".join([*kept, text[at:]])


def _finish(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column("text"), batch.column("spans").to_pylist()
        clean = [_cut_spans(texts[i].as_py(), x).decode("utf-8") if x else None for i, x in enumerate(spans)]
        out = {k: batch.column(k) for k in ("doc", "n_words", "spans", "items")} | {"clean_text": pa.array(clean, pa.string())}
        if with_text:
            out["text"] = texts
        yield pa.RecordBatch.from_pydict(out)


def automata(benchmark: DataFrame, window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> Iterator[Automaton]:
    """One automaton for each bounded share of the items."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // item_bytes)
    for k in range(n):
        share = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).distinct().orderBy("item_id", "text")
        yield Automaton([(x.item_id, words_of(bytes(x.text))) for x in share.collect()], window)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_bytes: int = ITEM_BYTES, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """doc (the carried columns), n_words, n_hit, coverage, spans (of words), items, clean_text (null where nothing is hit).

    If text is carried, it is a column of its own, as bytes.
    """
    with_text = "text" in carry
    out = docs.select(F.struct(*(c for c in carry if c != "text")).alias("doc"), F.col("text").cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"))
    kind = out.schema["doc"].dataType.simpleString()
    all_ = [*automata(benchmark, window, item_bytes)] or [Automaton([], window)]
    shared = [docs.sparkSession.sparkContext.broadcast(a) for a in all_]
    for a in shared[:-1]:
        out = cut(out.mapInArrow(lambda batches, a=a: _mark(batches, a), f"doc {kind}, text binary, {FOUND}"))
    out = out.mapInArrow(lambda batches: _finish(_mark(batches, shared[-1]), with_text), f"doc {kind}, {FOUND}, clean_text string" + ", text binary" * with_text)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.withColumn("n_hit", n_hit).withColumn("coverage", F.when(F.col("n_words") > 0, F.col("n_hit") / F.col("n_words")).otherwise(F.lit(0.0)))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


#: Windows of every item, joined to every place of a document by their words.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT cast(item_id AS varchar) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS k FROM b, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS k FROM d, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS r(i)),
hits AS (SELECT dw.doc_id, dw.i, dw.n, iw.item FROM dw JOIN iw ON dw.k = iw.k AND dw.n = iw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + n)) AS r(p) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hits GROUP BY doc_id)
SELECT d.doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
