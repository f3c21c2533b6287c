"""Language ID with a byte convolutional network.

Filters of several widths slide over the bytes of fixed windows, the largest response of each
filter in a window is kept, and a softmax layer turns these into log probabilities. A document's
are the mean over all its windows, weighted by bytes; its score is the share of the best language.
The network is trained in numpy on a bounded sample of labelled windows, drawn from whole texts
by a hash, so that each language has about equally many. Prediction reads every byte of every
text, batch by batch, and shuffles nothing.

Defined results: null texts and texts without a letter are `und` with score 0; without any
labelled row all are; a null or empty lang is no label; a null doc_id is never learned from and
is not held out; repeated rows are predicted alike; ties go to the first language in order; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .blobs import tidied
from .common import documents

WINDOW = 512
#: Windows of the training sample: its documented bound, whatever the input.
SAMPLE = 6000
WIDTHS, FILTERS = (2, 3, 4), 16
EPOCHS, BATCH, RATE, SEED = 10, 50, 0.01, 7
UNKNOWN = "und"
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], "u1")
_LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of doc_id as text leaves that remainder; false for null."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


@dataclass
class Network:
    languages: list[str]
    filters: list[np.ndarray]  # for each width: [width, 256, FILTERS]
    dense: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> Network:
        filters = [rng.normal(0, (1 / w) ** 0.5, (w, 256, FILTERS)).astype("f4") for w in WIDTHS]
        n = len(WIDTHS) * FILTERS
        return cls(languages, filters, rng.normal(0, n**-0.5, (n, len(languages))).astype("f4"), np.zeros(len(languages), "f4"))

    def pooled(self, x: np.ndarray, places: bool = False):
        """Largest response of each filter in each window; with the places if asked for."""
        out, at = [], []
        for table in self.filters:
            width = len(table)
            n = x.shape[1] - width + 1
            acc = table[0][x[:, :n]]
            for j in range(1, width):
                acc += table[j][x[:, j : j + n]]
            if places:
                at.append(where := acc.argmax(1))
                out.append(np.take_along_axis(acc, where[:, None], 1)[:, 0])
            else:
                out.append(acc.max(1))
        h = np.maximum(np.concatenate(out, 1), 0)
        return (h, at) if places else h

    def log_softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.dense + self.bias
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Log probabilities of each window, by small batches that stay in the cache."""
        return np.concatenate([self.log_softmax(self.pooled(x[i : i + 16])) for i in range(0, len(x), 16)])

    def train(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        weights = [*self.filters, self.dense, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        steps = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                own = order[i : i + BATCH]
                h, at = self.pooled(x[own], places=True)
                d = np.exp(self.log_softmax(h))
                d[np.arange(len(own)), y[own]] -= 1
                d /= len(own)
                back = (d @ self.dense.T) * (h > 0)
                grads = []
                for k, table in enumerate(self.filters):
                    g, part = np.zeros_like(table), back[:, k * FILTERS : (k + 1) * FILTERS]
                    for j in range(len(table)):
                        np.add.at(g[j], (np.take_along_axis(x[own], at[k] + j, 1), np.arange(FILTERS)[None]), part)
                    grads.append(g)
                grads += [h.T @ d, d.sum(0)]
                steps += 1
                for w, g, m, v in zip(weights, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= RATE * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-6)


def as_windows(text: bytes) -> np.ndarray:
    """The whole text in windows, A-Z in lower case, the last one filled up with zeros."""
    n = max(1, -(-len(text) // WINDOW))
    x = np.zeros(n * WINDOW, "u1")
    x[: len(text)] = _LOWER[np.frombuffer(text, "u1")]
    return x.reshape(n, WINDOW)


def sample(labelled: DataFrame, size: int = SAMPLE) -> list:
    """About `size` rows (lang, window), in a fixed order, each language about equally often.

    Windows are drawn by a hash from their numbers alone; then those drawn, whose number is bounded, are
    broadcast to the texts. So no text moves, and no language is left out by its rank.
    """
    rows = labelled.select("lang", "doc_id", F.col("text").cast("binary").alias("b")).where("lang <> '' and length(b) > 0")
    places = rows.select("lang", "doc_id", F.xxhash64("b").alias("h"), F.ceil(F.octet_length("b") / WINDOW).alias("n"))
    counts = places.groupBy("lang").agg(F.sum("n").alias("windows"))
    share = size / max(1, counts.count())
    each = places.join(counts, "lang").select("lang", "doc_id", "h", "windows", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("i"))
    u = (F.pmod(F.xxhash64("doc_id", "i"), F.lit(1 << 40)) + 1) / float(1 << 40)
    drawn = each.withColumn("key", -F.log(u) * F.col("windows")).where(F.col("key") <= share).drop("windows").distinct().orderBy("key", "lang", "doc_id", "h", "i").limit(2 * size)
    found = rows.withColumn("h", F.xxhash64("b")).join(F.broadcast(drawn), ["lang", "doc_id", "h"])
    windows = found.select("key", "lang", "doc_id", "i", F.substring("b", F.col("i") * WINDOW + 1, F.lit(WINDOW)).alias("window")).distinct()
    return sorted((x.key, x.lang, bytes(x.window)) for x in windows.collect())


def fit(labelled: DataFrame, size: int = SAMPLE) -> Network | None:
    """A network trained on (text, lang) of the labelled rows; None without any."""
    rows = sample(labelled, size)
    if not rows:
        return None
    languages = sorted({lang for _, lang, _ in rows})
    rng = np.random.default_rng(SEED)
    network = Network.fresh(languages, rng)
    x = np.concatenate([as_windows(w) for _, _, w in rows])
    network.train(x, np.array([languages.index(lang) for _, lang, _ in rows]), rng)
    return network


def has_letter(text: bytes) -> bool:
    return bool(re.search(rb"[A-Za-z]", text) or (not text.isascii() and _LETTER.search(text.decode("utf-8", "replace"))))


def _predict(batches: Iterator[pa.RecordBatch], shared, with_text: bool) -> Iterator[pa.RecordBatch]:
    network: Network | None = shared.value

    def one(text: bytes) -> tuple[str, float]:
        if network is None or not has_letter(text):
            return UNKNOWN, 0.0
        logs = network.windows(as_windows(text))
        bytes_in = np.full(len(logs), WINDOW, "f8")
        bytes_in[-1] = len(text) - WINDOW * (len(logs) - 1)
        mean = bytes_in @ logs / bytes_in.sum()
        share = np.exp(mean - mean.max())
        best = int(share.argmax())
        return network.languages[best], float(share[best] / share.sum())

    for whole in batches:
        for at in range(0, whole.num_rows, 250):  # few texts at a time are copied
            batch = whole.slice(at, 250)
            found = [one(x.as_py() or b"") for x in batch.column("text")]
            out = {"doc": batch.column("doc"), "lang_pred": pa.array([x for x, _ in found], pa.string()), "score": pa.array([x for _, x in found], pa.float64())}
            if with_text:
                out["text"] = batch.column("text")
            yield pa.RecordBatch.from_pydict(out)


def predict(docs: DataFrame, network: Network | None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """doc (the carried columns), lang_pred, score and, if it is carried, text (as bytes) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    rows = docs.select(F.struct(*(c for c in carry if c != "text")).alias("doc"), F.col("text").cast("binary").alias("text"))
    with_text = "text" in carry
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, lang_pred string, score double" + ", text binary" * with_text
    return rows.mapInArrow(lambda batches: tidied(_predict(batches, shared, with_text)), schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    network = fit(docs.where(~held_out(F.col("doc_id"), 4, 2) & F.col("doc_id").isNotNull()))
    out = held_out(F.col("doc.doc_id"), 4, 2)
    return predict(docs, network).select("doc.doc_id", out.alias("held_out"), "lang_pred", "score")
