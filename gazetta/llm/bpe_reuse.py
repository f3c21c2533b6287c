"""BPE encoding and decoding with reuse of content-defined chunks.

A text is cut where a rolling hash of the last eight bytes is zero in eight bits, so equal
passages of different documents fall into equal chunks wherever they stand. A chunk is encoded
once by each task that meets it and remembered as (head, ids, tail): the ids of the words that
white space bounds inside the chunk, and the open pieces at its ends. At a joint the tail, all
chunks without white space, and the next head are put together and encoded again; what stands
beyond the white space on both sides then agrees with the encoding of the whole text, because the
tokenizer's pre-tokens hold no white space. Words inside new chunks are remembered too. Only ids
are remembered; the tokens of a batch are looked up and joined by whole arrays.

A tokenizer of another build, which is read from its file, encodes and decodes whole texts.
Memories are bounded in number and bytes and emptied when full, so only speed depends on them.
Nothing is shuffled.

Defined results: null text is empty and gives no ids; equal rows stay; a null doc_id is kept;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blobs import tidied
from .common import documents
from .pieces import MEMORY, SIMPLE, encode_each, is_word_level, load, no_collection, pre_token_ids

SCHEMA = "doc_id long, ids array<int>, decoded string"
#: Average chunk: 2**CHUNK_BITS bytes.
CHUNK_BITS = 8
#: Chunks that a task keeps at most, and bytes of the words, and of the chunks, that it keeps with their ids: scripts
#: without spaces have long ones. Texts that are encoded at once, and their bytes unless one alone has more.
CHUNKS, KEPT, ROWS, BYTES = 20_000, 16 << 20, 500, 4 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INNER = re.compile(rb"([^ \t\n\r\x0b\x0c]*)[ \t\n\r\x0b\x0c](?:(.*)[ \t\n\r\x0b\x0c])?([^ \t\n\r\x0b\x0c]*)", re.S)
_CODECS: dict[str, "Codec"] = {}


def cuts(text: bytes) -> list[int]:
    """Ends of the chunks of text."""
    if len(text) < 9:
        return [len(text)] if text else []
    rolling = np.ndarray(len(text) - 7, "<u8", text, strides=(1,)) * _MULTIPLIER
    ends = np.flatnonzero(rolling >> np.uint64(64 - CHUNK_BITS) == 0) + 8
    out = ends.tolist()
    if not out or out[-1] != len(text):
        out.append(len(text))
    return out


def parts_of(word: bytes) -> list[bytes] | None:
    """The normalised pre-tokens of a plain word; null of others."""
    if word.isalpha():
        return [word.lower()]
    if word[-1:] in b".," and word[:-1].isalpha():
        return [word[:-1].lower(), word[-1:]]
    if word.isascii():
        return None
    m = SIMPLE.fullmatch(word.decode("utf-8"))
    return [x.encode() for x in m[0].lower().partition(m[2])[:2]] if m and m[2] else [m[0].lower().encode()] if m else None


class Codec:
    """Encodes and decodes whole texts with one tokenizer; chunks are reused only if its pre-tokens hold no white space."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.by_chunks = is_word_level(self.tokenizer)
        self.one = pre_token_ids(self.tokenizer)
        vocabulary = {i: x for x, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.tokens = pa.array([vocabulary.get(i, "") for i in range(max(vocabulary) + 1)], pa.string())
        self.forget_words()
        self.forget_chunks()

    def forget_words(self) -> None:
        self.words: dict[bytes, bytes] = {}  # ids as little-endian int32
        self.word_bytes = 0

    def forget_chunks(self) -> None:
        self.chunks: dict[bytes, tuple[bytes, bytes, bytes] | None] = {}
        self.chunk_bytes = 0

    def learn(self, words: set[bytes]) -> None:
        """Encodes words that are not known yet, each plain part of them once."""
        odd, new = [], words.difference(self.words)
        for w in new:
            parts = parts_of(w)
            if parts is None:
                odd.append(w)
                continue
            for x in parts:
                if x not in self.words:
                    self.words[x] = self.one(x.decode("utf-8")).tobytes()
            if w not in self.words:
                self.words[w] = self.words[parts[0]] if len(parts) == 1 else self.join(parts)
        for w, ids in zip(odd, encode_each(self.tokenizer, [x.decode("utf-8") for x in odd]), strict=True):
            self.words[w] = ids.tobytes()
        self.word_bytes += sum(len(w) + len(self.words[w]) for w in new)

    def join(self, words: list[bytes]) -> bytes:
        return b"".join(map(self.words.__getitem__, words))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        if not self.by_chunks:
            return pa.array([self.tokenizer.decode(x.as_py(), skip_special_tokens=False) for x in ids], pa.string())
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.tokens.take(ids.values)), " ")

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_chunks:
            return [x.tobytes() for x in encode_each(self.tokenizer, [x.decode("utf-8") for x in texts])]
        if len(self.words) > MEMORY or self.word_bytes > KEPT:
            self.forget_words()
        if len(self.chunks) > CHUNKS or self.chunk_bytes > KEPT:
            self.forget_chunks()
        pieces = []
        for text in texts:
            ends = cuts(text)
            pieces.append([text[a:b] for a, b in zip([0, *ends], ends, strict=False)])
        split = {}
        for c in set().union(*pieces).difference(self.chunks):
            m = _INNER.fullmatch(c)
            split[c] = m and (m[1], (m[2] or b"").split(), m[3])
        joints = [self.joints(own, split) for own in pieces]
        self.learn(set().union(*(x[1] for x in split.values() if x), *joints))
        for c, x in split.items():
            self.chunks[c] = x and (x[0], self.join(x[1]), x[2])
            self.chunk_bytes += len(c) + sum(map(len, self.chunks[c] or ()))
        return [self.assemble(own, words) for own, words in zip(pieces, joints, strict=True)]

    def joints(self, own: list[bytes], split: dict) -> list[bytes]:
        """The words at the joints of a text's chunks, and at its ends; empty ones too."""
        out, open_ = [], b""
        for c in own:
            x = split[c] if c in split else self.chunks[c]
            if x is None:
                open_ += c
            else:
                out.append(open_ + x[0])
                open_ = x[-1]
        return [*out, open_]

    def assemble(self, own: list[bytes], joints: list[bytes]) -> bytes:
        inner = [x for x in map(self.chunks.__getitem__, own) if x]
        ids = [self.words[joints[0]]]
        for x, w in zip(inner, joints[1:], strict=True):
            ids += (x[1], self.words[w])
        return b"".join(ids)


def codec(path: str) -> Codec:
    """Kept for all tasks of a worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """batch in parts of at most ROWS rows and BYTES of text, or one row."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()):
        if i > start and (i - start == ROWS or size + n > BYTES):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def _run(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for whole in batches:
        for batch in _slices(whole):
            with no_collection():
                rows = c.encode([x or b"" for x in batch.column("text").to_pylist()])
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in rows])]).astype("i4")
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, c.decode(ids)], names=["doc_id", "ids", "decoded"])
    c.forget_words()
    c.forget_chunks()


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids, decoded of every text, as the tokenizers library gives them for the whole text."""
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(lambda batches: tidied(_run(batches, tokenizer)), SCHEMA)


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *more)


def op7_bpe_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(encode_decode(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))
