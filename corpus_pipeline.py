"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
as the next one's docs. All but the last return the columns of documents, extra ones included.

Defined results: null and empty texts have no letter, so the first stage drops them; rows that
repeat both doc_id and text are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.llm import bpe_reuse, decontaminate, language_id, line_dedup, near_dedup
from gazetta.llm.common import documents, own_folder, remove, table

#: A document whose best language has a smaller share than this is in no known language.
LEAST_SCORE = 0.35
#: A document of which benchmark passages make up more than this goes as a whole.
MOST_COVERAGE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or in no known language."""
    network = language_id.fit(docs.where("doc_id is not null"))
    found = language_id.predict(docs, network, tuple(docs.columns))
    return found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*_carried(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later repeats of runs of lines or of whole-line passages of over 50 words, and documents of which nothing is left by that."""
    found = line_dedup.line_dedup(docs, words=line_dedup.WORDS)
    left = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return _with_text(left, docs.columns, F.col("kept_text"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each near-duplicate component."""
    gone = near_dedup.near_components(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages from texts, and drops documents that mostly consist of them."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), carry=tuple(docs.columns))
    left = found.where(F.col("coverage") <= MOST_COVERAGE).select(*_carried(docs), F.col("clean_text").alias("clean text"))
    return _with_text(left, docs.columns, F.coalesce(F.col("clean text"), F.col("text")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded text."""
    encoded = bpe_reuse.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return bpe_reuse.digests(encoded, "ids")


def _carried(docs: DataFrame) -> list:
    """The columns of docs, of a frame that has carried them."""
    return [F.col("text").cast("string").alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]


def _with_text(found: DataFrame, columns: list[str], text) -> DataFrame:
    """`columns` with that text; n_chars follows where the text has changed."""
    changed = ~text.eqNullSafe(F.col("text"))
    new = {"text": text.alias("text"), "n_chars": F.when(changed, F.char_length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars") if "n_chars" in columns else None}
    return found.select(*[new.get(c, F.col(c)) for c in columns])


STAGES = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", remove_benchmarks),
    ("BPE encoding and decoding", encode),
]

#: SQL cannot express the first and the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = own_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            remove(spark, f"{folder}/{k - 1}")
    return docs
