"""URL rules."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def allowed(url: Column, prefixes: list[str]) -> Column:
    """Null and empty are allowed; others need one of the prefixes."""
    return url.isNull() | (url == "") | reduce(or_, (url.startswith(p) for p in prefixes), F.lit(False))


def null_unless_allowed(url: Column, prefixes: list[str]) -> Column:
    return F.when(allowed(url, prefixes), url)


def extract_or_null(text: Column, pattern: str) -> Column:
    """The first group, or null where nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def valid_scheme(url: Column) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))).isin("http", "https"), F.lit(False))


def day_path(root: str, published_at: Column, name: Column, ending: str) -> Column:
    """root/YYYY/MM/DD/name.ending"""
    return F.concat(F.lit(f"{root}/"), F.date_format(published_at, "yyyy/MM/dd"), F.lit("/"), name, F.lit(ending))
