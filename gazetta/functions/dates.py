"""Dates, half-open ranges and ISO weeks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp of any kind, read as UTC."""
    return F.unix_seconds(ts.cast("timestamp"))


def in_days(ts: Column, start: str, end: str | None = None) -> Column:
    """From the start of the first day to before the day after the last one; one day without end."""
    last = F.date_add(F.to_date(F.lit(end or start)), 1)
    return (ts >= F.to_date(F.lit(start)).cast("timestamp_ntz")) & (ts < last.cast("timestamp_ntz"))


def in_range_inclusive(ts: Column, start: str, end: str) -> Column:
    """Both ends at midnight, both included: the variant of published datasets."""
    return (ts >= F.lit(start).cast("timestamp_ntz")) & (ts <= F.lit(end).cast("timestamp_ntz"))


def iso_week(ts: Column) -> Column:
    """ISO year * 100 + ISO week."""
    return (F.extract(F.lit("YEAROFWEEK"), ts) * 100 + F.extract(F.lit("WEEK"), ts)).cast("long")


def iso_week_of_epoch(seconds: Column) -> Column:
    return F.when(seconds > 0, iso_week(F.timestamp_seconds(seconds)))


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts).cast("long")


def parse(text: Column) -> Column:
    """A timestamp from ISO text or day/month/year; null where neither fits."""
    formats = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy HH:mm", "dd/MM/yyyy")
    return F.coalesce(F.try_to_timestamp(text), *(F.try_to_timestamp(text, F.lit(f)) for f in formats))


def normalise(text: Column) -> Column:
    """A timestamp without zone, in UTC, of ISO text with or without a zone; null where that is none."""
    return F.to_utc_timestamp(F.try_to_timestamp(text), F.current_timezone()).cast("timestamp_ntz")


def iso_text(ts: Column) -> Column:
    """ISO text; microseconds only where there are any."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros))


def parse_epoch(text: Column) -> Column:
    return F.coalesce(F.unix_seconds(parse(text)), F.lit(0))
