"""Token files: encoded documents in Parquet, in doc_id order, with selective reads.

Each file holds `part, doc_id, n_tokens, file_start, ids`. The ids are one list column with
dictionary encoding, at most 16 bits a token for a vocabulary of 50 thousand, the other columns
with delta encoding (Parquet version 2 pages); row groups and pages have fixed sizes and page
indexes, so a reader that wants a range of doc_id, or the lengths alone, reads no other tokens.
Files come from Spark's writer: any store works, and a lost task leaves no half file.

Documents are dealt out by ranges of doc_id, so part numbers follow doc_id. A task counts its own
tokens; the offsets of whole parts are a running sum of one number for each part, read back from
the length columns alone.

Defined results: null text is empty and yields the end id alone; a null doc_id comes first; equal
doc_ids are ordered by a hash of their text; repeated rows stay; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import re
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blobs import gather, tidied
from .common import documents, own_folder
from .pieces import LETTERS, encode_each, is_byte_level, load, no_collection, pre_token_ids

FILE_SCHEMA = "part int, doc_id long, n_tokens long, file_start long, ids array<int>"
ROW_GROUP_BYTES, PAGE_BYTES = 16 << 20, 128 << 10
#: Bytes of text in one file, texts that are encoded at once, and pieces that a worker keeps at most, from task to task,
#: of at most so many ids on average (scripts without spaces have long ones).
FILE_BYTES, ROWS, WORDS, IDS = 16 << 20, 500, 800_000, 8
#: Bits of `_kinds`: a space or end of line, a mark; times BEFORE: may stand before one of these.
BLANK, MARK, BEFORE, HIGH = 1, 2, 4, 128
_MEMORIES: dict[str, "Encoder"] = {}


class Encoder:
    """Token ids of whole texts by pieces: words with the space before them, marks, ends of lines.

    Texts are cut by `_cuts`, and their distinct pieces found and put together again, by whole
    arrays. Tokenizers of another build than byte-level ones encode whole texts.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.by_pieces = is_byte_level(self.tokenizer)
        self.one = pre_token_ids(self.tokenizer)
        special = "".join(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        marks = "".join(x for x in string.punctuation if x not in special)
        self.kinds = _kinds(marks)
        self.simple = re.compile(rf" ?(?:{LETTERS}|[0-9]+" + (f"|[{re.escape(marks)}]+" if marks else "") + ")")
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}  # by piece
        self.ids, self.ends = array("i"), array("q", [0])  # of all pieces, in the order of their places

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each text with the end id, and all ids."""
        if not self.by_pieces:
            end = np.array([end_id], "<i4").tobytes()
            whole = [x.tobytes() + end for x in encode_each(self.tokenizer, texts.to_pylist())]
            return np.array([len(x) // 4 for x in whole], "i8"), np.frombuffer(b"".join(whole), "<i4")
        texts = texts.cast(pa.string())
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, "i4", len(texts) + 1, 4 * texts.offset)
        data = data.slice(bounds[0], bounds[-1] - bounds[0]).to_pybytes() if data else b""
        bounds = bounds - bounds[0]
        cuts = _cuts(data, bounds, self.kinds)
        pieces = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype("i4")), pa.py_buffer(data)).dictionary_encode()
        places = self.placed(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
        ends = np.asarray(self.ends)
        starts = ends[places]
        sizes = ends[places + 1] - starts
        until = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(cuts, bounds)]  # ids before each text
        return np.diff(until) + 1, np.insert(np.asarray(self.ids)[gather(starts, sizes)], until[1:], end_id)

    def placed(self, pieces: list[str]) -> np.ndarray:
        """The place of each of these distinct pieces, after the new ones have been learned."""
        with no_collection():
            if len(self.places) > WORDS or len(self.ids) > IDS * WORDS:
                self.forget()
            out = np.fromiter(map(self.places.get, pieces, itertools.repeat(-1)), "i8", len(pieces))
            missing = np.flatnonzero(out < 0)
            new = [pieces[i] for i in missing.tolist()]
            self.learn(new)
            out[missing] = np.fromiter(map(self.places.__getitem__, new), "i8", len(new))
        return out

    def learn(self, pieces: list[str]) -> None:
        odd, one, simple, places = [], self.one, self.simple.fullmatch, self.places
        for piece in pieces:
            if simple(piece) is None:
                odd.append(piece)
                continue
            self.ids.extend(one(piece))
            self.ends.append(len(self.ids))
            places[piece] = len(places)
        for piece, ids in zip(odd, encode_each(self.tokenizer, odd), strict=True):
            self.ids.extend(ids)
            self.ends.append(len(self.ids))
            places[piece] = len(places)


def _kinds(marks: str) -> bytes:
    """What each byte is: where a text may be cut before it in the low bits, what may stand there before it in the high ones."""
    out = bytearray(256)
    for c in range(256):
        x = chr(c)
        if c >= 128:
            out[c] = HIGH
        elif not x.isspace():
            out[c] = BEFORE * BLANK
            if x.isalpha():
                out[c] |= BEFORE * MARK
            elif x in marks:
                out[c] |= MARK
        elif x in " \n":
            out[c] = BLANK
    return bytes(out)


def _cuts(data: bytes, bounds: np.ndarray, kinds: bytes) -> np.ndarray:
    """Where pieces start, and the end. Each is a bound of pre-tokens that depends on no text beyond it.

    Texts are cut at their bounds, before a space or end of line behind what is no white space,
    before a mark behind a letter, and between a single end of line and what is no white space.
    Where the bytes beside do not tell for certain, there is no cut.
    """
    x, kind = np.frombuffer(data, "u1"), np.frombuffer(data.translate(kinds), "u1")
    cut = np.zeros(len(x) + 1, bool)
    cut[1:-1] = kind[1:] & kind[:-1] // BEFORE & (BLANK | MARK) > 0
    at = 1 + np.flatnonzero((kind[1:] & (BLANK | MARK) > 0) & (kind[:-1] == HIGH))
    last, second, third = x[at - 1], x[at - 2], x[at - 3]
    latin = (second >= 0xC3) & (second <= 0xC5) & ((second > 0xC3) | (last != 0x97) & (last != 0xB7))
    white = (second == 0xC2) | (third >= 0xE1) & (third <= 0xE3) & np.isin(second, (0x80, 0x81, 0x9A))  # and some others
    cut[at] = np.where(kind[at] & MARK, latin, ~white)
    cut[bounds] = True
    line = np.flatnonzero((x[:-1] == 10) & ((kind[1:] >= BEFORE) & (kind[1:] < HIGH) | (x[1:] >= 0xC3) & (x[1:] <= 0xDF)))
    cut[line[cut[line]] + 1] = True
    return np.flatnonzero(cut)


def encoder(path: str) -> Encoder:
    """Kept for all tasks of a worker."""
    if path not in _MEMORIES:
        _MEMORIES[path] = Encoder(path)
    return _MEMORIES[path]


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    e, part, start = encoder(path), TaskContext.get().partitionId(), 0
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            batch = whole.slice(at, ROWS)
            lengths, ids = e.encode(pc.fill_null(batch.column("text"), ""), end_id)
            ends = np.cumsum(lengths)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype("i4")), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(lengths), part, "i4")), batch.column("doc_id"), pa.array(lengths), pa.array(start + ends - lengths), lists], names=["part", "doc_id", "n_tokens", "file_start", "ids"])
            start += int(ends[-1])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, files: int | None = None) -> None:
    """Writes the token ids of all texts to `files` Parquet files under path (default: one for each FILE_BYTES of text)."""
    n = files or 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // FILE_BYTES
    ordered = docs.select("doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    encoded = ordered.mapInArrow(lambda batches: tidied(_encode(batches, tokenizer, end_id)), FILE_SCHEMA)
    options = {
        "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": ROW_GROUP_BYTES, "parquet.page.size": PAGE_BYTES, "parquet.dictionary.page.size": 1 << 20,
        "parquet.enable.dictionary": "false", "parquet.enable.dictionary#ids.list.element": "true", "compression": "snappy",
    }
    encoded.write.options(**options).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens, ids.

    The offsets are one number for each file, so their size is bounded by the number of files.
    """
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    offsets = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("offset"))
    return rows.join(F.broadcast(offsets), "part").select("doc_id", (F.col("offset") + F.col("file_start")).alias("start"), "n_tokens", "ids")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets, values = ids.offsets.to_numpy(), memoryview(np.ascontiguousarray(ids.values.to_numpy().astype("<u4"))).cast("B")
        crc = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("doc_id", "start", "n_tokens")), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = own_folder(spark, "tokens")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return read_token_files(spark, path).mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
