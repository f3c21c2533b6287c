"""Language-model scoring by deleted interpolation.

The model mixes three maximum-likelihood estimates of a token: after the token before it (bigram),
alone (unigram), and uniform over the vocabulary and one unknown token. The mixture weights depend
on how often the context was seen, by powers of two. They are learned by expectation-maximisation
on held-out counts: a seventh of the training documents is deleted from the counts, and the weights
are those under which the remaining counts predict the deleted ones best. The counts that score
use all training documents.

Counts cover every training token, however many there are. Blocks of documents are tokenised once
into compact rows (distinct words as sorted 64-bit hashes, tokens as indices of these).
Each block asks for the counts of its n-grams: the hashes are dealt out by value to shards, a shard
adds up all blocks' counts and answers each block in the order of its question. So what travels is
one number for each distinct n-gram of a block, a frequent word costs one entry a block, no shard
depends on one key, and nothing but a few bounded tables reaches the driver: the sum of tokens,
the size of the vocabulary, and the held-out counts by rounded ratios of the three estimates.

Defined results: null and empty texts are the end token alone; a null doc_id is never learned from
and is not held out; repeated rows are learned and scored one by one; without training tokens the
estimates fall back to the uniform one; extra columns are ignored; an empty table gives an empty
result. Words are told apart by 63 bits of a hash, bigrams by 55.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blobs import pack, pack_sorted, shares, tidied, unpack, unpack_sorted
from .common import cut, dealt, documents
from .hashing import combine, word_hashes
from .language_id import held_out

#: Bytes of text in a block, before its last document.
BLOCK_BYTES = 8 << 20
#: Contexts are told apart by the power of two of their count, up to this one.
BUCKETS = 24
#: Ratios of estimates are rounded to this part of a power of two, and bounded by 2**RATIO_BITS.
STEP, RATIO_BITS = 8, 40
ROUNDS = 30
_END = np.uint64(0x1B873593CC9E2D51)
_START = np.uint64(0x85EBCA6BC2B2AE35)
#: Tokens of all blocks for each shard that adds up their n-grams.
SHARD_TOKENS = 3 << 20
#: Bigrams have this bit, words have not; the last byte of bigrams is left out, most of what travels is bigrams.
_PAIR, _KEPT_BITS = np.uint64(1 << 63), np.uint64((1 << 64) - 256)
BLOCK_SCHEMA = "block string, n_tokens long, doc_id array<long>, role array<int>, length array<int>, words binary, tokens binary"
#: Roles of documents: scored only, training, training but deleted from the counts that the weights are learned with.
SCORED, KEPT, DELETED = 0, 1, 2


def _block(name: str, rows: list[tuple]) -> dict:
    """A block's distinct words as sorted hashes without the top bit, and its tokens as indices of these."""
    lengths = [len(words) + 1 for _, _, words in rows]
    words, at = np.unique(np.concatenate([np.append(w, _END) for _, _, w in rows]) >> np.uint64(1), return_inverse=True)
    planes = at.astype("<u4").view("u1").reshape(-1, 4).T
    return {"block": name, "n_tokens": sum(lengths), "doc_id": [d for d, _, _ in rows], "role": [r for _, r, _ in rows], "length": lengths, "words": pack_sorted(words), "tokens": pack(planes)}


def pack_counts(x: np.ndarray) -> bytes:
    """Counts in 32 bits where they fit, else in 64; the first byte tells."""
    size = 4 if not x.size or x.max() < 1 << 32 else 8
    return bytes([size]) + pack(x.astype(f"u{size}"))


def unpack_counts(x: bytes) -> np.ndarray:
    return unpack(x[1:], f"u{x[0]}").astype("u8").reshape(2, -1)


class Grams:
    """The n-grams of a block: distinct words, then distinct bigrams as hashes with the top bit, and where each token has its own."""

    def __init__(self, row: dict):
        self.lengths, self.roles = np.array(row["length"]), np.array(row["role"])
        self.first = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        words = unpack_sorted(row["words"])
        self.word_at = np.ascontiguousarray(unpack(row["tokens"], "u1").reshape(4, -1).T).view("<u4").ravel()
        own = words[self.word_at]
        before = np.concatenate([[_START], own[:-1]])
        before[self.first] = _START
        pairs, at = np.unique((combine([before, own], 2) | _PAIR) & _KEPT_BITS, return_inverse=True)
        self.pair_at = at + len(words)
        self.keys = np.concatenate([words, pairs])
        self.order = np.argsort(self.keys)

    def uses(self) -> np.ndarray:
        """How often kept and deleted documents use each n-gram."""
        role = np.repeat(self.roles, self.lengths)
        n = len(self.keys)
        return np.stack([np.bincount(self.word_at[role == r], minlength=n) + np.bincount(self.pair_at[role == r], minlength=n) for r in (KEPT, DELETED)]).astype("u4")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, n, rows, size = TaskContext.get().partitionId(), 0, [], 0

    def out() -> pa.RecordBatch:
        one = _block(f"{part}-{n}", rows)
        kinds = {"block": pa.string(), "n_tokens": pa.int64(), "doc_id": pa.list_(pa.int64()), "role": pa.list_(pa.int32()), "length": pa.list_(pa.int32())}
        return pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k, pa.binary())) for k, v in one.items()], names=list(one))

    for batch in batches:
        for doc_id, role, text in zip(*(batch.column(k) for k in ("doc_id", "role", "text")), strict=True):
            text = text.as_py() or b""
            rows.append((doc_id.as_py(), role.as_py(), word_hashes(text)))
            size += len(text) + 64
            if size >= BLOCK_BYTES:
                yield out()
                n, rows, size = n + 1, [], 0
    if rows:
        yield out()


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _ask(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """A block's question to each shard: a range of hashes, and how often the block uses them in training."""
    for batch in batches:
        for row in _rows(batch):
            g = Grams(row)
            keys, uses = g.keys[g.order], g.uses()[:, g.order]
            own = shares(keys, shards)
            yield pa.RecordBatch.from_arrays([
                pa.array([s for s, _, _ in own], pa.int32()), pa.array([row["block"]] * len(own), pa.string()),
                pa.array([pack_sorted(keys[a:b]) for _, a, b in own], pa.binary()), pa.array([pack(uses[:, a:b]) for _, a, b in own], pa.binary()),
            ], names=["shard", "block", "keys", "uses"])


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of all blocks, to each block in the order of its question; rows come by shard."""

    def answers(rows: list[tuple]) -> pa.RecordBatch:
        keys = [unpack_sorted(k) for _, _, k, _ in rows]
        uses = np.concatenate([unpack(u, "u4").reshape(2, -1) for _, _, _, u in rows], 1).astype("f8")
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        kept, deleted = (np.bincount(at, w, len(distinct)).astype("u8") for w in uses)
        word = distinct < _PAIR
        ends = np.cumsum([0, *(len(k) for k in keys)])
        counts = [pack_counts(np.stack([kept[at[a:b]], deleted[at[a:b]]])) for a, b in zip(ends, ends[1:], strict=False)]
        all_ = (kept + deleted)[word]
        sums = [[int(x) for x in (kept[word].sum(dtype="u8"), all_.sum(dtype="u8"), (kept[word] > 0).sum(), (all_ > 0).sum())]] + [[0] * 4] * (len(rows) - 1)
        return pa.RecordBatch.from_arrays([pa.array([s for s, _, _, _ in rows], pa.int32()), pa.array([b for _, b, _, _ in rows]), pa.array(counts, pa.binary()), pa.array(sums, pa.list_(pa.int64()))], names=["shard", "block", "counts", "sums"])

    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in ("shard", "block", "keys", "uses")), strict=True):
            if rows and row[0] != rows[0][0]:
                yield answers(rows)
                rows = []
            rows.append(row)
    if rows:
        yield answers(rows)


class Estimates(Grams):
    """Counts and estimates for every token of a block."""

    def __init__(self, row: dict, vocabulary: tuple[int, int], total: tuple[int, int]):
        super().__init__(row)
        parts = [unpack_counts(x["counts"]) for x in sorted(row["answers"], key=lambda x: x["shard"])]
        self.counts = np.empty((2, len(self.keys)), "u8")
        self.counts[:, self.order] = np.concatenate(parts, 1)
        self.vocabulary, self.total = vocabulary, total

    def of(self, all_: bool, documents_: int) -> tuple[np.ndarray, ...]:
        """Context buckets and the three estimates; from the kept counts, or from all training counts."""
        c = self.counts[0] + self.counts[1] if all_ else self.counts[0]
        word, pair = c[self.word_at].astype("f8"), c[self.pair_at].astype("f8")
        context = np.concatenate([[0.0], word[:-1]])
        context[self.first] = documents_
        with np.errstate(divide="ignore", invalid="ignore"):
            bigram = np.where(context > 0, pair / context, 0.0)
        unigram = word / max(1, self.total[all_])
        bucket = np.where(context > 0, np.minimum(BUCKETS - 1, 1 + np.log2(np.maximum(context, 1))), 0).astype("i8")
        return word, bucket, bigram, unigram, 1 / (self.vocabulary[all_] + 1)


def _rounded(ratio: np.ndarray) -> np.ndarray:
    """0 for 0, else the rounded logarithm of a ratio, from 1 on."""
    with np.errstate(divide="ignore"):
        logs = np.clip(np.log2(ratio), -RATIO_BITS, RATIO_BITS)
    return np.where(ratio > 0, np.round((logs + RATIO_BITS) * STEP) + 1, 0).astype("i8")


def _held_counts(batches: Iterator[pa.RecordBatch], v: tuple, n: tuple, d: tuple) -> Iterator[pa.RecordBatch]:
    """Deleted tokens, counted by context bucket and rounded ratios of bigram and unigram to uniform."""
    side = 2 * RATIO_BITS * STEP + 2
    for batch in batches:
        for row in _rows(batch):
            e = Estimates(row, v, n)
            _, bucket, bigram, unigram, uniform = e.of(False, d[0])
            own = np.repeat(e.roles == DELETED, e.lengths)
            cells, counts = np.unique(((bucket * side + _rounded(bigram / uniform)) * side + _rounded(unigram / uniform))[own], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(counts, pa.int64())], names=["cell", "n"])


def weights(cells: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of each context bucket, by expectation-maximisation."""
    side = 2 * RATIO_BITS * STEP + 2
    ratio = lambda q: np.where(q > 0, 2.0 ** ((q - 1) / STEP - RATIO_BITS), 0.0)
    bucket, estimates = cells // side**2, np.stack([ratio(cells // side % side), ratio(cells % side), np.ones(len(cells))])
    mix = np.full((3, BUCKETS), 1 / 3)
    for _ in range(ROUNDS):
        parts = mix[:, bucket] * estimates
        parts *= counts / parts.sum(0)
        sums = np.stack([np.bincount(bucket, p, BUCKETS) for p in parts]) + 1e-3
        mix = sums / sums.sum(0)
    return mix


def _score(batches: Iterator[pa.RecordBatch], v: tuple, n: tuple, d: tuple, mix: list) -> Iterator[pa.RecordBatch]:
    mix = np.array(mix)
    for batch in batches:
        for row in _rows(batch):
            e = Estimates(row, v, n)
            word, bucket, bigram, unigram, uniform = e.of(True, sum(d))
            m = mix[:, bucket]
            logs = np.log10(m[0] * bigram + m[1] * unigram + m[2] * uniform)
            base = np.log10((word + 1) / (n[1] + v[1] + 1))
            sums = [np.add.reduceat(x, e.first) for x in (logs, base, (word > 0).astype("i8"))]
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_id"], pa.int64()), pa.array(e.lengths, pa.int64()), pa.array(sums[2], pa.int64()), pa.array(sums[1]), pa.array(sums[0])], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def score(docs: DataFrame, training: F.Column, deleted: F.Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every text.

    training: the documents learned from; deleted: those of them that the mixture weights are
    learned on.
    """
    role = F.when(training & deleted, DELETED).when(training, KEPT).otherwise(SCORED)
    rows = docs.select("doc_id", role.alias("role"), F.col("text").cast("binary").alias("text"))
    formed = rows.mapInArrow(lambda b: tidied(_blocks(b)), BLOCK_SCHEMA)
    blocks = dealt(formed, formed.rdd.getNumPartitions(), "block")  # so the answers go to the blocks, twice
    d = blocks.select(F.explode("role").alias("r")).agg(F.count_if(F.col("r") == KEPT), F.count_if(F.col("r") == DELETED)).first()
    shards = -(-(blocks.agg(F.sum("n_tokens")).first()[0] or 1) // SHARD_TOKENS)
    asked = blocks.mapInArrow(lambda b: tidied(_ask(b, shards)), "shard int, block string, keys binary, uses binary")
    to_shards = asked.repartition(F.col("shard")).sortWithinPartitions("shard", "block")
    answers = cut(to_shards.mapInArrow(lambda b: tidied(_answer(b)), "shard int, block string, counts binary, sums array<long>"))
    s = answers.agg(*(F.coalesce(F.sum(F.col("sums")[i]), F.lit(0)) for i in range(4))).first()
    n, v, d = (s[0], s[1]), (s[2], s[3]), tuple(d)
    of_block = answers.groupBy("block").agg(F.collect_list(F.struct("shard", "counts")).alias("answers"))
    whole = blocks.join(of_block.hint("shuffle_merge"), "block")
    held = whole.where(F.array_contains("role", DELETED)).mapInArrow(lambda b: _held_counts(b, v, n, d), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    mix = weights(np.array([x.cell for x in held], "i8"), np.array([x.n for x in held], "f8")).tolist()
    scored = whole.mapInArrow(lambda b: tidied(_score(b, v, n, d, mix)), "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("train_tokens", F.lit(n[1]).cast("long"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 7, 2)
    scored = score(documents(spark, sf_dir), ~out & F.col("doc_id").isNotNull(), held_out(F.col("doc_id"), 7, 3))
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
