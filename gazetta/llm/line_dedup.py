"""Line dedup by winnowing over line hashes, with DataFrame operations only.

A document is the sequence of its lines that are not blank. Of each window of RUN consecutive
lines the smallest line hash is selected: a fingerprint, with its position. Neighbouring windows
mostly select the same one, so about every second line is a position, and two equal windows,
wherever they stand, have selected the same fingerprint at the same place within.

1. Each position is one row: its fingerprint and the hashes of the lines around it, as far as a
   window that selects it can reach.
2. Positions whose fingerprint stands nowhere else are dropped.
3. The others are joined by fingerprint and extended: to both sides of the position, by comparing
   the hashes of the neighbouring lines, to every window that selects it. Positions that agree
   in one of these match there; a group of any size is compared with its first place only.
4. The first place in order of (doc_id, position) stays. Lines of later matches are deleted, so a
   whole repeated run of RUN or more lines goes.

A line of LONG or more characters is a window by itself. With `words`, so are fewer lines than RUN
that together have LONG characters or more than `words` words: then every passage of more words
that fills whole lines has a window. The query is without, as its SQL fixes the rule; the
pipeline's stage is with WORDS.

Counts and first places are pre-aggregated on the map side; the joins back have plain exchanges on
both sides, whose hot partitions Spark splits.

Defined results: null text has no lines and stays null; blank lines are never deleted or counted;
lines end at \\n and are compared exactly, by two 64-bit hashes; rows that repeat both doc_id and
text are the same place; a null doc_id comes first; windows may overlap, within one document too;
extra columns are kept by line_dedup and ignored by the query; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents

RUN, LONG = 3, 200
#: Of the pipeline: a repeated passage of more words than this goes, however few its lines.
WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def positions(docs: DataFrame, run: int = RUN, long: int = LONG, words: int | None = None) -> DataFrame:
    """doc_id, row, print (a selected line hash), p (the line's number), near, reach.

    near: the lines (i, h, g) that a window selecting this one can hold. reach: start and size of
    each such window within near.
    """
    more = lambda x: [] if words is None else [F.regexp_count(x, F.lit(r"[^ \t\x0B\f\r]+")).alias("words")]
    line = lambda x, i: F.struct(i.alias("i"), F.xxhash64(x).alias("h"), F.xxhash64(F.lit(1), x).alias("g"), F.char_length(x).alias("chars"), x.rlike(r"[^ \t\x0B\f\r]").alias("full"), *more(x))
    own = F.filter(F.transform(_lines(F.col("text")), line), lambda x: x["full"])
    each = docs.select("doc_id", F.xxhash64("text").alias("row"), own.alias("l")).where(F.size("l") > 0)
    # the lines around each place p, and where p is among them
    low = lambda p: F.greatest(p - (run - 1), F.lit(0))
    around = F.transform("l", lambda x, p: F.struct((p - low(p)).alias("at"), F.slice("l", low(p) + 1, p - low(p) + run).alias("near")))
    rows = each.select("doc_id", "row", F.explode(around).alias("x")).select("doc_id", "row", F.get("x.near", F.col("x.at"))["h"].alias("print"), "x.at", "x.near")
    hashes = F.transform("near", lambda x: x["h"])

    def counts(start: Column, n: int) -> Column:
        """Whether n lines from start on are a window."""
        lines = F.slice("near", start + 1, n)
        total = lambda c: F.aggregate(lines, F.lit(0), lambda s, x: s + x[c])
        enough = total("chars") >= long
        return F.lit(True) if n == run else enough if words is None else enough | (total("words") > words)

    def windows(n: int) -> Column:
        """The windows of n lines that hold the position and of which it is the least hash."""
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size("near") - n, F.lit(0))), lambda s: (s <= F.col("at")) & (s + n > F.col("at")) & (s + n <= F.size("near")))
        chosen = F.filter(starts, lambda s: (F.array_min(F.slice(hashes, s + 1, n)) == F.col("print")) & counts(s, n))
        return F.transform(chosen, lambda s: F.struct(s.alias("start"), F.lit(n).alias("size")))

    sizes = [run, 1] if words is None else [*range(1, run + 1)]
    reach = F.concat(*(windows(n) for n in dict.fromkeys(sizes)))
    lean = F.transform("near", lambda x: F.struct(x["i"].alias("i"), x["h"].alias("h"), x["g"].alias("g")))
    reached = rows.withColumn("reach", reach).where(F.size("reach") > 0)
    return reached.select("doc_id", "row", "print", F.get("near", F.col("at"))["i"].alias("p"), "reach", lean.alias("lean")).withColumnRenamed("lean", "near")


def matches(selected: DataFrame) -> DataFrame:
    """doc_id, row, at (line numbers), k1, k2: positions extended to the windows that select them."""
    each = selected.select("doc_id", "row", "near", F.explode("reach").alias("w"))
    part = lambda c: F.transform(F.slice("near", F.col("w.start") + 1, F.col("w.size")), lambda x: x[c])
    return each.select("doc_id", "row", part("i").alias("at"), F.xxhash64(part("h")).alias("k1"), F.xxhash64(part("g")).alias("k2"))


def repeated_lines(docs: DataFrame, run: int = RUN, long: int = LONG, words: int | None = None) -> DataFrame:
    """doc_id, row, gone: the line numbers that are deleted from a document."""
    selected = cut(positions(docs, run, long, words))
    here = F.struct("doc_id", "row", "p")
    prints = cut(selected.groupBy("print").agg(F.min(here).alias("lo"), F.max(here).alias("hi")).where("lo < hi").select("print"))
    extended = cut(matches(selected.join(prints, "print")))
    place = F.struct("doc_id", "row", F.col("at")[0].alias("p"))
    firsts = cut(extended.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").select("k1", "k2", "first"))
    later = extended.join(firsts, ["k1", "k2"]).where(place > F.col("first"))
    return later.select("doc_id", "row", F.explode("at").alias("i")).groupBy("doc_id", "row").agg(F.collect_set("i").alias("gone"))


def line_dedup(docs: DataFrame, run: int = RUN, long: int = LONG, words: int | None = None) -> DataFrame:
    """docs with n_lines, n_removed and kept_text (null for null text) of every row; columns of docs with these names are replaced."""
    gone = repeated_lines(docs, run, long, words).select(F.col("doc_id").alias("_gone_id"), F.col("row").alias("_gone_row"), F.col("gone").alias("_gone"))
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (F.xxhash64("text") == F.col("_gone_row"))
    joined = docs.join(gone, same, "left").drop("_gone_id", "_gone_row")
    lines = _lines(F.col("text"))
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone"))
    kept = F.array_join(F.transform(keep, lambda i: F.get(lines, i)), "\n")
    return joined.withColumns({
        "n_lines": F.coalesce(F.size(F.filter(lines, lambda x: x.rlike(r"[^ \t\x0B\f\r]"))), F.lit(0)).cast("long"),
        "n_removed": F.coalesce(F.size("_gone"), F.lit(0)).cast("long"),
        "kept_text": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept),
    }).drop("_gone")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
x AS (SELECT doc_id, i - 1 AS i, l[i] AS line, regexp_matches(l[i], '[^ \t\x0B\f\r]') AS f FROM d, unnest(range(1, len(l) + 1)) AS r(i)),
s AS (SELECT doc_id, i, line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM x WHERE f),
w AS (SELECT a.doc_id, a.k, 3 AS n, [a.line, b.line, c.line] AS t FROM s a JOIN s b ON b.doc_id = a.doc_id AND b.k = a.k + 1 JOIN s c ON c.doc_id = a.doc_id AND c.k = a.k + 2
  UNION ALL SELECT doc_id, k, 1, [line] FROM s WHERE length(line) >= 200),
f AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id, k) AS nth FROM w),
g AS (SELECT DISTINCT doc_id, k + j AS k FROM f, unnest(range(0, n)) AS r(j) WHERE nth > 1),
p AS (SELECT s.doc_id, s.i FROM s JOIN g USING (doc_id, k)),
o AS (SELECT x.doc_id, count(*) FILTER (x.f) AS n_lines, count(p.i) AS n_removed, string_agg(x.line, chr(10) ORDER BY x.i) FILTER (p.i IS NULL) AS kept FROM x LEFT JOIN p ON p.doc_id = x.doc_id AND p.i = x.i GROUP BY x.doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents LEFT JOIN o ON o.doc_id = documents.doc_id
"""
