"""Hashes, JSON and time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")), 256)


def file_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def extracted_json(c: Column) -> Column:
    """The text itself if it is a JSON object, ``{}`` for none, else an object that holds the text."""
    ok = F.try_parse_json(c).isNotNull() & F.substring(F.ltrim(c), 1, 1).isin("{", "[")
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("{}")).when(ok, c).otherwise(F.to_json(F.struct(c.alias("raw_content"))))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def epoch(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def elapsed(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1_000_000


def remaining(start: Column, now: Column, done: Column, total: Column) -> Column:
    """Mean seconds an item so far, times the items left; null before the first."""
    return F.when(done > 0, elapsed(start, now) / done * (total - done))


def split_budget(total: int) -> dict[str, int]:
    """Tokens for a description and for a readme."""
    return {"description": total * 2 // 10, "readme": total * 6 // 10}
