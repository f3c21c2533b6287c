"""Search documents, and filters, facets, groups and keyword look-ups over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions import text
from gazetta.functions.dates import epoch, iso_week_of_epoch

# Entity type -> field; other types go to entity_misc.
BUCKETS = {"ORG": "entity_org", "PER": "entity_per", "LOC": "entity_loc", "EVENT": "entity_event", "POLICY": "entity_policy"}
OTHER = "entity_misc"


def optional(c: Column) -> Column:
    """Trimmed text, or null where nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def positive(c: Column) -> Column:
    return F.when(c > 0, c)


def entity_fields(entities: Column) -> dict[str, Column]:
    """Texts of entities by type, each once in order; all texts; sorted canonical ids. Empty arrays are null."""
    filled = F.filter(entities, lambda e: F.coalesce(F.trim(e["text"]) != "", F.lit(False)))
    texts = lambda test: _or_null(F.array_distinct(F.transform(F.filter(filled, test), lambda e: F.trim(e["text"]))))
    kind_of = lambda e: F.upper(F.trim(e["type"]))
    of_type = lambda kind: lambda e: kind_of(e) == kind
    out = {field: texts(of_type(kind)) for kind, field in BUCKETS.items()}
    out[OTHER] = texts(lambda e: ~F.coalesce(kind_of(e).isin(*BUCKETS), F.lit(False)))
    out["entities"] = texts(lambda e: F.lit(True))
    out["entity_canonical"] = _or_null(F.array_sort(F.array_distinct(F.filter(F.transform(filled, lambda e: F.trim(e["canonical_id"])), lambda x: x.isNotNull() & (x != "")))))
    return out


def _or_null(a: Column) -> Column:
    return F.when(F.size(a) > 0, a)


def documents(rows: DataFrame) -> DataFrame:
    """Search documents of joined article rows; fields without a value are null.

    rows: unique_id, title, published_at, and any of the other article, theme and feature columns.
    """
    have = set(rows.columns)
    strings = [c for c in ("agency", "title", "url", "image", "video_url", "category", "content", "summary", "subtitle", "editorial_lead", "theme_1_level_1_code", "theme_1_level_1_label", "theme_1_level_2_code", "theme_1_level_2_label", "theme_1_level_3_code", "theme_1_level_3_label", "most_specific_theme_code", "most_specific_theme_label", "sentiment_label", "content_hash") if c in have]
    counts = [c for c in ("word_count", "char_count", "paragraph_count", "view_count", "unique_sessions", "published_year", "published_month") if c in have]
    seconds = F.coalesce(epoch(F.col("published_at")), F.lit(0))
    out = [F.col("unique_id").alias("id"), F.col("unique_id").alias("unique_id"), F.greatest(seconds, F.lit(0)).alias("published_at"), iso_week_of_epoch(seconds).alias("published_week")]
    out += [optional(F.col(c)).alias(c) for c in strings] + [positive(F.col(c)).alias(c) for c in counts]
    if "extracted_at" in have:
        out.append(positive(epoch(F.col("extracted_at"))).alias("extracted_at"))
    out += [F.col(c) for c in ("sentiment_score", "trending_score", "readability_flesch", "has_image", "has_video") if c in have]
    if "tags" in have:
        out.append(_or_null(text.clean_tags(F.col("tags"))).alias("tags"))
    if "entities" in have:
        out += [c.alias(k) for k, c in entity_fields(F.col("entities")).items()]
    if "content_embedding" in have:
        out.append(F.col("content_embedding").alias("content_embedding"))
    return rows.select(*out)


def facet(docs: DataFrame, *fields: str, top: int = 5) -> DataFrame:
    """field, value, n: the most frequent values of each field; of arrays, the elements."""
    kinds = dict(docs.dtypes)
    parts = [F.col(f) if kinds[f].startswith("array") else F.array(F.col(f).cast("string")) for f in fields]
    each = docs.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), p.alias("values")) for f, p in zip(fields, parts, strict=True)))).alias("x"))
    counts = each.select("x.field", F.explode("x.values").alias("value")).where("value is not null").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("n"), "value"))
    return counts.withColumn("place", place).where(F.col("place") <= top).drop("place")


def tokens(content: Column) -> Column:
    """Distinct folded words."""
    return F.array_distinct(F.filter(F.split(F.lower(text.to_ascii(content)), "[^a-z0-9]+"), lambda w: w != ""))


# Frequent Portuguese words without a meaning of their own, folded.
STOP = "a ao aos as com como da das de dele dela do dos e em entre era essa esse esta este eu foi ha isso isto ja mais mas me na nao nas no nos o os ou para pela pelas pelo pelos por qual quando que quem se sem ser seu sua so sao tambem te tem um uma".split()
# Plural endings of folded Portuguese words, and what stands in the singular.
PLURALS = [("oes$", "ao"), ("aes$", "ao"), ("ais$", "al"), ("eis$", "el"), ("ois$", "ol"), ("ns$", "m"), ("([rz])es$", "$1"), ("([aeiou])s$", "$1")]


def stem(word: Column) -> Column:
    """The singular of a folded word of more than three letters, by its ending: the first that fits."""
    out = word
    for ending, singular in reversed(PLURALS):
        out = F.when(word.rlike(ending), F.regexp_replace(word, ending, singular)).otherwise(out)
    return F.when(F.char_length(word) > 3, out).otherwise(word)


def matching_stems(docs: DataFrame, query: str, *fields: str) -> DataFrame:
    """Documents of which the fields together hold all words of a query in any number, words without a meaning aside."""
    stems = lambda c: F.array_distinct(F.transform(F.filter(tokens(c), lambda w: ~w.isin(*STOP)), stem))
    return docs.where(F.size(F.array_except(stems(F.lit(query)), stems(F.concat_ws(" ", *fields)))) == 0)


def matching(docs: DataFrame, query: list[str], *fields: str, prefix: bool = False) -> DataFrame:
    """Documents of which the fields together hold all words of the query; with prefix, words that begin so."""
    words = tokens(F.concat_ws(" ", *fields))
    if prefix:
        begun = lambda q: F.exists(words, lambda w: w.startswith(q))
        return docs.where(F.lit(True) if not query else reduce(Column.__and__, map(begun, query)))
    return docs.where(F.size(F.array_intersect(words, F.array(*(F.lit(q) for q in query)))) == len(set(query)))


def ranked(docs: DataFrame, query: list[str], fields: dict[str, float], *ties: Column, limit: int = 10) -> DataFrame:
    """The `limit` best documents that hold all words of the query, with score: the weights of the fields each word stands in."""
    weight = F.lit(0.0)
    for field, w in fields.items():
        weight += w * F.size(F.array_intersect(tokens(F.col(field)), F.array(*(F.lit(q) for q in sorted(set(query))))))
    return matching(docs, query, *fields).withColumn("score", weight).orderBy(F.desc("score"), *ties).limit(limit)


#: Orders of a result list; the first is the usual one.
SORTS = ("published_at", "trending_score", "view_count")


def sorted_by(docs: DataFrame, mode: str = SORTS[0], key: str = "id", limit: int = 0) -> DataFrame:
    """Documents by a number, largest first, those without it last; ties by key."""
    if mode not in SORTS:
        raise ValueError(f"{mode} is none of {SORTS}")
    out = docs.orderBy(F.desc_nulls_last(mode), key)
    return out.limit(limit) if limit else out


def alternate_documents(news: DataFrame) -> DataFrame:
    """The other build of documents: names of article columns, the agency by name, no feature fields.

    news: joined article rows; fields that are missing or empty are null.
    """
    have = set(news.columns)
    # Fields of this build.
    names = "agency_key title url image_url category content summary subtitle editorial_lead theme_l1_code theme_l1_label theme_l2_code theme_l2_label theme_l3_code theme_l3_label most_specific_theme_code most_specific_theme_label".split()
    seconds = lambda c: epoch(F.col(c))
    out = [F.col("unique_id").alias("id"), F.col("unique_id"), F.coalesce(seconds("published_at"), F.lit(0)).alias("published_at")]
    out += [F.when(F.col(c) != "", F.trim(F.col(c))).alias(c) for c in names if c in have]
    if "agency_name" in have:
        out.append(F.when(F.col("agency_name") != "", F.col("agency_name")).alias("agency"))
    if "extracted_at" in have:
        out.append(seconds("extracted_at").alias("extracted_at"))
    out += [F.year("published_at").alias("published_year"), F.month("published_at").alias("published_month")]
    if "content_embedding" in have:
        out.append(_or_null(F.col("content_embedding")).alias("content_embedding"))
    return news.select(*out)


def import_documents(index: DataFrame | None, docs: DataFrame, mode: str = "full", force: bool = False) -> tuple[DataFrame | None, dict]:
    """(the index after an upsert of docs, statistics). A full import into a filled index is skipped unless forced.

    Documents without an id are errors and are left out; of several with one id, one is indexed.
    """
    from .stores import upsert

    stats = {"total_processed": 0, "total_indexed": 0, "errors": 0, "skipped": False}
    if index is not None and mode == "full" and not force and not index.isEmpty():
        return index, {**stats, "skipped": True}
    n = docs.agg(F.count(F.lit(1)).alias("n"), F.count("id").alias("good")).first()
    stats |= {"total_processed": n.n, "total_indexed": n.good, "errors": n.n - n.good}
    fresh = docs.where("id is not null").dropDuplicates(["id"])
    return (fresh if index is None else upsert(index, fresh, "id")), stats


def one_of_group(docs: DataFrame, group: Column, *order: Column, limit: int = 1) -> DataFrame:
    """The first documents of each group; those without a group all stay."""
    place = F.row_number().over(Window.partitionBy("_g").orderBy(*order))
    return docs.withColumn("_g", group).withColumn("_p", place).where((F.col("_p") <= limit) | F.col("_g").isNull()).drop("_g", "_p")


def inverted_index(docs: DataFrame, key: str, *fields: str) -> DataFrame:
    """token, id pairs, for repeated look-ups by join."""
    return docs.select(F.explode(tokens(F.concat_ws(" ", *fields))).alias("token"), F.col(key).alias("id"))
