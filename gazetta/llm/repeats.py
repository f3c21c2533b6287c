"""Dedup of repeated byte strings through run-compressed Burrows-Wheeler transforms.

Every byte that is covered by a string of LENGTH bytes which also starts in a document with a
smaller doc_id is removed. Documents are read in blocks; strings never cross documents.

1. Each string of LENGTH bytes has a minimizer, the least hash of its MER-byte substrings, so equal
   strings have equal ones wherever they stand. A block asks, by shards of the hash space, which of
   its minimizers another document has too. Only strings with shared minimizers can repeat.
2. Neighbouring strings with one minimizer form one fragment. Blocks send the distinct fragments
   with shared minimizers, each with its earliest document, to the minimizer's shard.
3. A shard builds the run-compressed transform of its fragments, in parts of bounded size, with a
   sample at the ends of runs: the earliest document of the rows before. The matching statistics of
   all fragments are streamed through the runs, step by step to the row of every string; the interval
   of rows that agree with it in LENGTH bytes names its earliest document.
4. The answers, run-length coded, go back to the blocks, which mark and cut the repeats.

Only minimizers, fragments that may repeat, and answers travel; copies collapse in their block
before that. One transform of everything could not be built on many machines; the shards' transforms
hold all strings that may repeat, each in one place. Matching lengths beyond LENGTH are not needed.

Defined results: null text is empty; texts shorter than LENGTH lose nothing; documents with equal
doc_ids do not remove from each other; a null doc_id comes last; extra columns are ignored; an
empty table gives an empty result. Whole fragments and minimizers are told apart by 64-bit hashes;
the strings inside a shard are compared by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blobs import gather, pack, pack_sorted, shares, tidied, unpack, unpack_sorted
from .common import cut, dealt, documents
from .hashing import VALUES, mix, powers

LENGTH, MER = 50, 16
BLOCK_BYTES = 3 << 19
#: Bytes of text for each shard that compares minimizers, bytes of fragments for each that compares these, and at once in it.
SHARD_TEXT, SHARD_BYTES, SORTED_BYTES = 16 << 20, 2 << 20, 1 << 20
#: Bytes between sampled rows: a walk's steps.
STRIDE = 64
LAST = np.iinfo("i8").max
BLOCK_SCHEMA = "block string, n_bytes long, doc_id array<long>, length array<int>, text binary"
_NONE = np.uint64(0)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, "u1")])
    return np.ndarray(len(text), ">u8", padded, strides=(1,)).astype("u8")


def _mers(text: np.ndarray) -> np.ndarray:
    """A hash of the MER bytes from each place on; odd, so never _NONE."""
    eight = _words(text)
    return mix(eight[: len(text) - 8] * np.uint64(0x9E3779B97F4A7C15) ^ mix(eight[8:])) | np.uint64(1)


def fragments(text: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Minimizer, start, number of strings and document index of each fragment of the block."""
    n = len(text)
    none = np.empty(0, "i8")
    if n < LENGTH:
        return none.astype("u8"), none, none, none
    h = _mers(text)
    least, width, want = h[: n - MER + 1], 1, LENGTH - MER + 1
    while width * 2 <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
    least = least[: n - LENGTH + 1].copy()
    ends = np.cumsum(lengths)
    # strings that would cross the end of their document
    for back in range(1, LENGTH):
        at = ends - back
        least[at[(at >= 0) & (at < len(least))]] = _NONE
    new = np.concatenate([[True], least[1:] != least[:-1]])
    heads = ends[ends < len(least)]
    new[heads] = True
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(least)))
    real = least[starts] != _NONE
    starts, counts = starts[real], counts[real]
    return least[starts], starts, counts, np.searchsorted(ends, starts, "right")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

    def out() -> pa.RecordBatch:
        lengths = [len(x) for x in texts]
        one = {"block": pa.array([f"{part}-{n}"]), "n_bytes": pa.array([sum(lengths)], pa.int64()), "doc_id": pa.array([ids], pa.list_(pa.int64())), "length": pa.array([lengths], pa.list_(pa.int32()))}
        return pa.RecordBatch.from_pydict(one | {"text": pa.array([pack(np.frombuffer(b"".join(texts), "u1"))], pa.binary())})

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            ids.append(doc_id)
            texts.append(text.as_py() or b"")
            size += len(texts[-1]) + 64
            if size >= BLOCK_BYTES:
                yield out()
                n, ids, texts, size = n + 1, [], [], 0
    if ids:
        yield out()


def _by_shard(batches: Iterator[pa.RecordBatch], answer) -> Iterator[pa.RecordBatch]:
    """answer(rows) for the rows of each shard, which stand together."""
    rows: list[dict] = []
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if rows and row["shard"] != rows[0]["shard"]:
                yield answer(rows)
                rows = []
            rows.append(row)
    if rows:
        yield answer(rows)


def _ask_shared(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """A block's distinct minimizers, and whether two of its own documents have them."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            ids = np.array([LAST if x is None else x for x in row["doc_id"]], "i8")
            minimizers, _, _, doc = fragments(unpack(row["text"], "u1"), np.array(row["length"], "i8"))
            who = ids[doc]
            order = np.lexsort((who, minimizers))
            keys, first = np.unique(minimizers[order], return_index=True)
            last = np.append(first[1:], len(order)) - 1
            local = who[order][first] != who[order][last] if len(keys) else np.empty(0, bool)
            own = shares(keys, shards)
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _, _ in own], pa.int32()), pa.array([row["block"]] * len(own), pa.string()), pa.array([pack_sorted(keys[a:b]) for _, a, b in own], pa.binary()), pa.array([pack(local[a:b]) for _, a, b in own], pa.binary())], names=["shard", "block", "keys", "local"])


def _answer_shared(rows: list[dict]) -> pa.RecordBatch:
    """For each key of a block: whether another document has it."""
    keys = [unpack_sorted(r["keys"]) for r in rows]
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    weight = np.bincount(at, 1.0 + np.concatenate([unpack(r["local"], "u1") for r in rows]))
    shared = (weight > 1)[at]
    ends = np.cumsum([0, *map(len, keys)])
    parts = [shared[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    return pa.RecordBatch.from_arrays([pa.array([r["shard"] for r in rows], pa.int32()), pa.array([r["block"] for r in rows]), pa.array([pack(x) for x in parts], pa.binary()), pa.array([int(x.sum()) for x in parts], pa.int64())], names=["shard", "block", "shared", "n_shared"])


class Block:
    """A block's text and its distinct fragments with shared minimizers, in the order of its questions."""

    def __init__(self, row: dict):
        self.ids = np.array([LAST if i is None else i for i in row["doc_id"]], "i8")
        self.raw_ids, self.lengths = row["doc_id"], np.array(row["length"], "i8")
        self.text = unpack(row["text"], "u1")
        minimizers, starts, counts, doc = fragments(self.text, self.lengths)
        parts = [unpack(x["shared"], "?") for x in sorted(row["shared"] or [], key=lambda x: x["shard"])]
        shared = np.concatenate(parts) if parts else np.empty(0, bool)
        keys = np.unique(minimizers)
        own = shared[np.searchsorted(keys, minimizers)] if len(keys) else np.empty(0, bool)
        self.minimizers, self.starts, self.counts, self.doc = (x[own] for x in (minimizers, starts, counts, doc))
        hashes = fragment_hashes(self.text, self.starts, self.counts + LENGTH - 1)
        order = np.lexsort((self.ids[self.doc], hashes, self.minimizers))
        m, h = self.minimizers[order], hashes[order]
        new = np.concatenate([[True], (m[1:] != m[:-1]) | (h[1:] != h[:-1])]) if len(m) else np.empty(0, bool)
        self.firsts = order[new]  # of equal fragments the one of the earliest document
        self.at = np.empty(len(order), "i8")  # which distinct fragment each fragment is
        self.at[order] = np.cumsum(new) - 1


def fragment_hashes(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each fragment's bytes."""
    up, down = powers(len(text) + 1)
    sums = np.zeros(len(text) + 1, "u8")
    np.cumsum(VALUES[text] * up[:-1], out=sums[1:])
    return mix((sums[starts + sizes] - sums[starts]) * down[starts] + sizes.astype("u8"))


def _ask_earliest(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            b = Block(row)
            own = shares(b.minimizers[b.firsts], shards)
            out: list[list] = [[], [], [], []]
            for s, x, y in own:
                f = b.firsts[x:y]
                sizes = b.counts[f] + LENGTH - 1
                for to, v in zip(out, (s, pack(sizes.astype("i4")), pack(b.ids[b.doc[f]]), pack(b.text[gather(b.starts[f], sizes)])), strict=True):
                    to.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array([row["block"]] * len(own), pa.string()), *(pa.array(x, pa.binary()) for x in out[1:])], names=["shard", "block", "sizes", "docs", "bytes"])


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row of each suffix of text in their sorted order, and ranks that agree where 32 bytes do.

    Prefix doubling from the first eight bytes on; only suffixes that are not told apart yet go on.
    """
    n, depth, at32 = len(text), 8, None
    words = _words(text)
    order = np.argsort(words)
    new = np.concatenate([[True], words[order][1:] != words[order][:-1]])
    rank = np.empty(n, "i8")
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    while True:
        at32 = rank.copy() if depth == 32 else at32
        tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(tied):
            return rank, rank if at32 is None else at32
        after = tied + depth
        # a suffix that ends before the next part is smaller the shorter it is
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + n + 1, n - tied)
        key = (rank[tied].astype("u8") << np.uint64(32)) | second.astype("u8")
        order = np.argsort(key)
        key = key[order]
        old = key >> np.uint64(32)
        i = np.arange(len(key))
        start = lambda x: np.maximum.accumulate(np.where(np.concatenate([[True], x[1:] != x[:-1]]), i, 0))  # noqa: B023, E731
        rank[tied[order]] = old.astype("i8") + start(key) - start(old)
        depth *= 2


class RunIndex:
    """The run-compressed Burrows-Wheeler transform of a text: heads of its runs, and where each run's first row leads.

    Row 0 is the empty suffix. A step from the row of a suffix to that of the suffix one byte longer needs
    the runs alone: rows of one run lead to neighbouring rows.
    """

    def __init__(self, text: np.ndarray, rank: np.ndarray):
        n = len(text)
        before = np.empty(n + 1, "i4")
        before[0] = text[-1] + 1
        before[rank[1:] + 1] = text[:-1].astype("i4") + 1
        before[rank[0] + 1] = 0  # nothing stands before the whole text
        self.heads = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        sizes = np.diff(np.append(self.heads, n + 1))
        by_byte = np.argsort(before[self.heads], kind="stable")
        self.leads = np.empty(len(sizes), "i8")
        self.leads[by_byte] = np.cumsum(sizes[by_byte]) - sizes[by_byte]

    def longer(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that are one byte longer."""
        run = np.searchsorted(self.heads, rows, "right") - 1
        return self.leads[run] + rows - self.heads[run]


def earliest(text: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """The earliest document of each string of LENGTH bytes of each fragment, one after the other.

    text is the fragments, each followed by a zero. The matching statistics of all fragments are
    streamed at once: from sampled rows, STRIDE bytes apart, steps through the runs lead to the row of
    every string. Rows that agree in LENGTH bytes are an interval; its document is the least
    of the samples kept at the ends of the runs within it.
    """
    n = len(text)
    rank, at32 = suffix_order(text)
    index = RunIndex(text, rank)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    places = gather(begin, sizes - LENGTH + 1)
    # intervals of rows that agree in LENGTH = 32 + 18 bytes: two overlapping halves
    order = np.empty(n, "i8")
    order[rank] = np.arange(n)
    half = at32[np.minimum(order + LENGTH - 32, n - 1)]
    first = at32[order]
    interval = np.concatenate([[True, True], (first[1:] != first[:-1]) | (half[1:] != half[:-1])])
    owner = np.full(n + 1, LAST)
    owner[rank[places] + 1] = np.repeat(docs, sizes - LENGTH + 1)
    ends = np.flatnonzero(interval | np.isin(np.arange(n + 1), index.heads))
    samples = np.minimum.reduceat(owner, ends)
    least = np.minimum.reduceat(samples, np.flatnonzero(interval[ends]))
    which = np.cumsum(interval) - 1
    # each walk goes back over the strings that start in its stretch
    count = sizes - LENGTH + 1
    stretches = -(-count // STRIDE)
    nth = np.arange(stretches.sum()) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    low = np.repeat(begin, stretches) + nth * STRIDE
    high = np.minimum(low + STRIDE, np.repeat(begin + count, stretches))
    rows, found = rank[high] + 1, np.full(n, LAST)
    while len(rows):
        rows, high = index.longer(rows), high - 1
        found[high] = least[which[rows]]
        on = high > low
        rows, high, low = rows[on], high[on], low[on]
    return found[places]


def _runs(text: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """earliest() of fragments one after the other, run-length coded for each: values, lengths, and runs of each fragment."""
    apart = np.zeros(len(text) + len(sizes), "u1")
    apart[gather(np.cumsum(sizes + 1) - (sizes + 1), sizes)] = text
    found = earliest(apart, sizes, docs)
    counts = sizes - LENGTH + 1
    begin = np.cumsum(counts) - counts
    new = np.concatenate([[True], found[1:] != found[:-1]])
    new[begin] = True
    heads = np.flatnonzero(new)
    firsts = np.searchsorted(heads, begin)
    return found[heads], np.diff(np.append(heads, len(found))), np.diff(np.append(firsts, len(heads)))


def _answer_earliest(rows: list[dict]) -> pa.RecordBatch:
    texts, sizes, docs, hashes, minimizers = [], [], [], [], []
    for r in rows:
        text, own = unpack(r["bytes"], "u1"), unpack(r["sizes"], "i4").astype("i8")
        starts = np.cumsum(own) - own
        texts.append(text)
        sizes.append(own)
        docs.append(unpack(r["docs"], "i8"))
        hashes.append(fragment_hashes(text, starts, own))
        # all strings of a fragment have one minimizer: the least hash inside it
        minimizers.append(np.minimum.reduceat(_mers(np.append(text, np.zeros(MER, "u1"))), np.stack([starts, starts + own - MER + 1], 1).ravel())[::2])
    text, all_sizes = np.concatenate(texts), np.concatenate(sizes)
    starts = np.cumsum(all_sizes) - all_sizes
    _, first, at = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    least = np.full(len(first), LAST)
    np.minimum.at(least, at, np.concatenate(docs))
    # strings with different minimizers differ, so a shard is sorted by parts
    m = np.concatenate(minimizers)[first]
    order = np.argsort(m, kind="stable")
    place = np.empty(len(order), "i8")
    place[order] = np.arange(len(order))
    first, at, least, m = first[order], place[at], least[order], m[order]
    part = (np.cumsum(all_sizes[first]) // SORTED_BYTES)[np.searchsorted(m, m)]  # a minimizer's fragments stay together
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(first)]
    values, lengths, per = ([np.empty(0, "i8")] for _ in range(3))
    for a, b in zip(edges, edges[1:], strict=False):
        if a == b:
            continue
        own = all_sizes[first[a:b]]
        for to, x in zip((values, lengths, per), _runs(text[gather(starts[first[a:b]], own)], own, least[a:b]), strict=True):
            to.append(x)
    values, lengths, per = (np.concatenate(x) for x in (values, lengths, per))
    begin = np.cumsum(per) - per
    out: list[tuple] = []
    ends = np.cumsum([0, *map(len, sizes)])
    for a, b in zip(ends, ends[1:], strict=False):
        runs = gather(begin[at[a:b]], per[at[a:b]])
        out.append((pack(values[runs]), pack(lengths[runs].astype("i4"))))
    return pa.RecordBatch.from_arrays([pa.array([r["shard"] for r in rows], pa.int32()), pa.array([r["block"] for r in rows]), pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())], names=["shard", "block", "first", "runs"])


def _cut_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            b = Block(row)
            answers = sorted(row["answers"] or [], key=lambda x: x["shard"])
            found = np.concatenate([np.empty(0, "i8"), *(np.repeat(unpack(x["first"], "i8"), unpack(x["runs"], "i4")) for x in answers)])
            counts = b.counts[b.firsts]
            begin = np.cumsum(counts) - counts
            gone = found[gather(begin[b.at], b.counts)] < np.repeat(b.ids[b.doc], b.counts)
            places = gather(b.starts, b.counts)[gone]
            steps = np.zeros(len(b.text) + 1, "i4")
            steps[places] += 1
            np.subtract.at(steps, places + LENGTH, 1)
            covered = np.cumsum(steps[:-1]) > 0
            ends = np.cumsum(b.lengths)
            rows = []
            for doc_id, s, e in zip(b.raw_ids, ends - b.lengths, ends, strict=True):
                own = covered[s:e]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]])))
                rows.append((doc_id, [{"start": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2], strict=True)], int(e - s), b.text[s:e][~own].tobytes()))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array([r[3] for r in rows], pa.binary()),
            ], names=["doc_id", "n_bytes", "spans", "kept"])


def cut_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (removed byte ranges), kept (the other bytes) of every text."""
    formed = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(_blocks, BLOCK_SCHEMA)
    blocks = dealt(formed, formed.rdd.getNumPartitions(), "block")
    shards = -(-(blocks.agg(F.sum("n_bytes")).first()[0] or 1) // SHARD_TEXT) or 1
    asked = blocks.select("block", "doc_id", "length", "text").mapInArrow(lambda b: tidied(_ask_shared(b, shards)), "shard int, block string, keys binary, local binary")
    to_shards = asked.repartition(F.col("shard")).sortWithinPartitions("shard", "block")
    shared = cut(to_shards.mapInArrow(lambda b: _by_shard(b, _answer_shared), "shard int, block string, shared binary, n_shared long"))
    # a fragment has some 67 bytes on average
    more = -(-67 * (shared.agg(F.sum("n_shared")).first()[0] or 1) // SHARD_BYTES) or 1
    flags = shared.groupBy("block").agg(F.collect_list(F.struct("shard", "shared")).alias("shared"))
    texts = blocks.select("block", "doc_id", "length", "text").join(flags.hint("shuffle_merge"), "block", "left")
    parts = texts.mapInArrow(lambda b: tidied(_ask_earliest(b, more)), "shard int, block string, sizes binary, docs binary, bytes binary")
    sent = parts.repartition(F.col("shard")).sortWithinPartitions("shard", "block")
    answers = cut(sent.mapInArrow(lambda b: tidied(_by_shard(b, _answer_earliest)), "shard int, block string, first binary, runs binary"))
    whole = texts.join(answers.groupBy("block").agg(F.collect_list(F.struct("shard", "first", "runs")).alias("answers")).hint("shuffle_merge"), "block", "left")
    return whole.mapInArrow(lambda b: tidied(_cut_repeats(b)), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cut_repeats(documents(spark, sf_dir))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
