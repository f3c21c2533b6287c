"""Text features, identifiers and normal forms as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters with marks and their plain letters, in the same order, as in the SQL.
MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"

# Every character that is not ASCII and of which the NFKD form has ASCII characters, with these.
_ASCII = {c: x for c in map(chr, [*range(0x80, 0xD800), *range(0xE000, 0x110000)]) if unicodedata.decomposition(c) and (x := unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode())}
#: Those of one ASCII character, and those of several.
SINGLE = {c: x for c, x in _ASCII.items() if len(x) == 1}
LONGER = {c: x for c, x in _ASCII.items() if len(x) > 1}

BLANKS = r"[ \t\n\x0B\f\r]+"


def _or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def word_count(text: Column) -> Column:
    """Runs of characters between white space; null has none."""
    return F.size(F.filter(F.split(_or_empty(text), BLANKS), lambda w: w != "")).cast("long")


def char_count(text: Column) -> Column:
    return F.char_length(_or_empty(text)).cast("long")


def paragraph_count(text: Column) -> Column:
    """Parts between empty lines that are not blank."""
    return F.size(F.filter(F.split(_or_empty(text), "\n\n"), lambda p: F.regexp_replace(p, BLANKS, "") != "")).cast("long")


def has_value(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def sentence_count(text: Column) -> Column:
    """Runs of closing marks; at least one."""
    return F.greatest(F.regexp_count(_or_empty(text), F.lit(r"[.!?]+")), F.lit(1)).cast("long")


def syllable_count(text: Column) -> Column:
    """Groups of vowels: an own approximation, the same for all languages."""
    return F.regexp_count(F.lower(_or_empty(text)), F.lit("[aeiouyáàâãäéèêëíìîïóòôõöúùûü]+")).cast("long")


def flesch(text: Column) -> Column:
    """Reading ease to two places; null under ten words."""
    words = word_count(text)
    ease = 206.835 - 1.015 * words / sentence_count(text) - 84.6 * syllable_count(text) / words
    return F.when(words >= 10, F.round(ease, 2))


def to_ascii(text: Column) -> Column:
    """The ASCII characters of the NFKD form; it is formed character by character, so no UDF is needed."""
    single = F.translate(_or_empty(text), "".join(SINGLE), "".join(SINGLE.values()))
    longer = f"[{''.join(LONGER)}]"
    table = F.str_to_map(F.lit("\x01".join(f"{c}\x02{x}" for c, x in LONGER.items())), F.lit("\x01"), F.lit("\x02"))
    parts = F.split(single, f"(?={longer})|(?<={longer})")
    whole = F.array_join(F.transform(parts, lambda p: F.coalesce(F.try_element_at(table, p), p)), "")
    return F.regexp_replace(F.when(single.rlike(r"[^\x00-\x7F]") & single.rlike(longer), whole).otherwise(single), r"[^\x00-\x7F]", "")


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def hash_form(text: Column) -> Column:
    """Lower case, without marks and punctuation, single spaces."""
    return collapse(F.regexp_replace(F.lower(to_ascii(text)), r"[^0-9A-Za-z_ \t\n\x0B\f\r]", ""))


def alias_form(text: Column) -> Column:
    """As hash_form, but punctuation stays."""
    return collapse(F.lower(to_ascii(text)))


def content_hash(title: Column, content: Column) -> Column:
    """16 hex digits over both normal forms; null if both are empty."""
    a, b = hash_form(title), hash_form(content)
    return F.when((a != "") | (b != ""), F.substring(F.sha2(F.concat(a, F.lit("\n"), b), 256), 1, 16))


def slug(title: Column, most: int = 100) -> Column:
    """Lower-case words joined by dashes, cut at the last dash within `most` characters."""
    whole = F.regexp_replace(F.regexp_replace(F.lower(to_ascii(title)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    head = F.substring(whole, 1, most)
    at_dash = F.regexp_replace(head, "-[^-]*$", "")
    return F.when(F.char_length(whole) <= most, whole).when(F.substring(whole, most + 1, 1) == "-", F.regexp_replace(head, "-+$", "")).otherwise(at_dash)


def id_suffix(*parts: Column, size: int = 6) -> Column:
    return F.substring(F.md5(F.concat_ws("_", *parts)), 1, size)


def readable_id(title: Column, *parts: Column) -> Column:
    s = slug(title)
    return F.concat_ws("_", F.when(s == "", F.lit("sem-titulo")).otherwise(s), id_suffix(*parts))


def parenthetical(name: Column) -> Column:
    """What stands in brackets at the end; null without."""
    return F.nullif(F.trim(F.regexp_extract(name, r"\(([^()]*)\)\s*$", 1)), F.lit(""))


def without_parenthetical(name: Column) -> Column:
    return F.trim(F.regexp_replace(name, r"\s*\([^()]*\)\s*$", ""))


def aliases(name: Column, key: Column) -> Column:
    """Name, name without brackets, acronym and key: trimmed, filled, each once, in that order."""
    parts = F.array(F.trim(name), without_parenthetical(name), parenthetical(name), F.trim(key))
    return F.array_distinct(F.filter(parts, lambda x: x.isNotNull() & (x != "")))


def clean_tags(tags: Column, most: int = 100) -> Column:
    """Trimmed tags of 1 to `most` characters, in order, repeats included."""
    return F.filter(F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: F.trim(t)), lambda t: F.char_length(t).between(1, most))


def split_tags(text: Column) -> Column:
    return F.filter(F.transform(F.split(_or_empty(text), ","), lambda t: F.trim(t)), lambda t: t != "")


def trigrams(text: Column) -> Column:
    """Distinct runs of three characters of the padded lower-case text."""
    t = F.concat(F.lit("  "), F.lower(_or_empty(text)), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length(t) - 2), lambda i: F.substring(t, i, F.lit(3))))


def trigram_similarity(a: Column, b: Column) -> Column:
    x, y = trigrams(a), trigrams(b)
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))
