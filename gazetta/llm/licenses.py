"""Licence scans with a positional rare-token index, with DataFrame operations only.

Licence texts are templates of words. Their words (but the commonest) form an index of postings
(word, template, position). Every document's words are looked up in it. Of each template the RARE
words vote that the file holds and that have the highest inverse document frequency in the whole corpus:
a choice for each template, so that in a file of several licences one does not take the votes
of the others. A word at place p that a template has at position q votes for that template starting
at p - q. A start with enough votes holds the template's rare words in their relative positions; it
counts if the template's mandatory key phrase stands at its own relative position as well, so
votes are counted at such starts only. The phrases of the base list are found in the same look-up,
wherever their words stand consecutively.

Only the words found in the index are shuffled, by document; the templates are fixed and small.

Defined results: null text is empty; a document without licence words has no labels, null places
and score 0; documents with a base phrase score 1, others the share of the best template's indexed
words that stand in place; rows that repeat both doc_id and text are all returned, with
the places of one of them; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, documents

#: The votes a start needs, and the words of a template that have votes in a file.
VOTES, RARE = 3, 12

# Phrases that count wherever they stand, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Label, template words, mandatory key phrase of two or three words inside it.
TEMPLATES = [
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lesser general public"),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", "affero general public"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "permission is hereby"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "source and binary"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain by waiving all rights", "the public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released"),
]

# Words too common to be indexed.
COMMON = set("a all and any are as by can code for form free in into is it of or that the this to under use who with work you".split())


def _values(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A literal table of strings, integers and nulls."""
    lit = lambda x: "null" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return spark.sql("SELECT * FROM VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + f" AS t({names})")


def postings(spark: SparkSession) -> DataFrame:
    """word, template, label, at (position in the template), indexed (indexed words of the template)."""
    rows = []
    for t, (label, text, _) in enumerate(TEMPLATES):
        own = [(w, i) for i, w in enumerate(text.split()) if w not in COMMON]
        rows += [(w, t, label, i, len(own)) for w, i in own]
    return _values(spark, rows, "word, template, label, at, indexed")


def phrases(spark: SparkSession) -> DataFrame:
    """w, n1, n2 (null: two words), template (null: base phrase), label, at (position in the template)."""
    rows = []
    for phrase, label in BASE.items():
        rows.append(((*phrase.split(), None)[:3], None, label, 0))
    for t, (label, text, key) in enumerate(TEMPLATES):
        words, own = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(own)] == own)
        rows.append(((*own, None)[:3], t, label, at))
    return _values(spark, [(*p, *rest) for p, *rest in rows], "w, n1, n2, template, label, at")


def word_array(text) -> F.Column:
    """The words of text; A-Z in lower case.

    lower() also changes other letters, but only the Kelvin sign becomes an ASCII letter by it,
    so that sign is replaced before by another non-ASCII letter.
    """
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    return F.regexp_extract_all(plain, F.lit(WORD), F.lit(0))


def scan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with their number of words, places of base phrases, verified templates)."""
    spark = docs.sparkSession
    listed, post = phrases(spark), postings(spark)
    # one pass over the texts: a row at place -1 for each, and one for each word that is in the index or starts a phrase
    known = sorted({w for _, text, _ in TEMPLATES for w in text.split() if w not in COMMON} | {p.split()[0] for p in [*BASE, *(key for _, _, key in TEMPLATES)]})
    keyed = docs.select("doc_id", F.xxhash64("text").alias("row"), word_array(F.col("text")).alias("words"))
    at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(*known))
    place = lambda i, own: F.struct(i.cast("long").alias("p"), own(0).alias("w"), own(1).alias("n1"), own(2).alias("n2"))
    found = F.when(F.size("words") > 0, F.transform(at, lambda i: place(i, lambda k: F.get("words", i + k)))).otherwise(F.array().cast("array<struct<p:bigint,w:string,n1:string,n2:string>>"))
    each = F.concat(F.array(place(F.lit(-1), lambda k: F.lit(None).cast("string"))), found)
    seen = cut(keyed.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), F.explode(each).alias("x")).select("doc_id", "row", "n_words", "x.*"))
    counted = seen.where("p = -1").select("doc_id", "row", "n_words")
    index = post.select(F.col("word").alias("w")).distinct().withColumn("in_index", F.lit(True))
    starts = listed.groupBy("w").agg(F.collect_list(F.struct("n1", "n2", "template", "label", "at")).alias("starts"))
    vocabulary = index.join(starts, "w", "full")
    follows = F.filter("starts", lambda s: (s.n1 == F.col("n1")) & (s.n2.isNull() | s.n2.eqNullSafe(F.col("n2"))))
    hits = seen.where("p >= 0").join(F.broadcast(vocabulary), "w").withColumn("stand", F.coalesce(follows, F.array())).where(F.col("in_index") | (F.size("stand") > 0))
    hits = hits.select("doc_id", "row", "p", F.when(F.col("in_index"), F.col("w")).alias("word"), "stand").distinct()
    stands = hits.select("doc_id", "row", "p", F.explode("stand").alias("s")).select("doc_id", "row", "p", "s.template", "s.label", "s.at")
    base = stands.where("template is null").select("doc_id", "row", "p", "label")
    keys = stands.where("template is not null").select("doc_id", "row", "template", (F.col("p") - F.col("at")).alias("start")).distinct()
    words = hits.where("word is not null").select("doc_id", "row", "p", "word")
    # the rarest words that a file holds of each template whose key phrase it has
    own = words.select("doc_id", "row", "word").distinct()
    frequency = own.groupBy("word").agg(F.count(F.lit(1)).alias("files"))  # a row for each word of the fixed index
    held = own.join(F.broadcast(post.select("word", "template").distinct()), "word").join(F.broadcast(frequency), "word")
    asked = keys.select(F.col("doc_id").alias("a_doc"), F.col("row").alias("a_row"), F.col("template").alias("a_template")).distinct()
    wanted = held.join(asked, F.col("doc_id").eqNullSafe(F.col("a_doc")) & (F.col("row") == F.col("a_row")) & (F.col("template") == F.col("a_template")), "left_semi")
    by_rarity = F.row_number().over(Window.partitionBy("doc_id", "row", "template").orderBy("files", "word"))
    rare = wanted.withColumn("nth", by_rarity).where(F.col("nth") <= RARE).select(F.col("doc_id").alias("r_doc"), F.col("row").alias("r_row"), F.col("template").alias("r_template"), F.col("word").alias("r_word"))
    # of each start with its key phrase, these words and where they should stand
    places = keys.join(F.broadcast(post), "template").select("doc_id", "row", "template", "label", "indexed", "start", "at", "word", (F.col("start") + F.col("at")).alias("p"))
    votes_of = F.col("doc_id").eqNullSafe(F.col("r_doc")) & (F.col("row") == F.col("r_row")) & (F.col("template") == F.col("r_template")) & (F.col("word") == F.col("r_word"))
    due = places.join(rare, votes_of, "left_semi")
    stand = due["doc_id"].eqNullSafe(words["doc_id"]) & (due["row"] == words["row"]) & (due["p"] == words["p"]) & (due["word"] == words["word"])
    votes = due.join(words, stand, "left_semi").groupBy("doc_id", "row", "template", "label", "indexed", "start").agg(F.countDistinct("at").alias("votes"))
    enough = votes.where(F.col("votes") >= F.least(F.lit(VOTES), F.col("indexed")))
    return counted, base, enough


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document."""
    counted, base, verified = scan(docs)
    of_base = base.select("doc_id", "row", "label", "p", F.lit(1.0).alias("share"))
    of_templates = verified.select("doc_id", "row", "label", F.lit(None).cast("long").alias("p"), F.least(F.col("votes") / F.least("indexed", F.lit(RARE)), F.lit(1.0)).alias("share"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = of_base.unionByName(of_templates).groupBy("doc_id", "row").agg(
        F.count("p").alias("n_base"), F.min("p").alias("first_word"), F.max("p").alias("last_word"),
        joined(F.when(F.col("p").isNotNull(), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"), F.max("share").alias("score"),
    )
    same = counted["doc_id"].eqNullSafe(found["doc_id"]) & (counted["row"] == found["row"])
    out = counted.join(found, same, "left")
    return out.select(counted["doc_id"], "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
