"""Numeric measures of packages and changes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def popularity(downloads: Column, stars: Column, readme_chars: Column) -> Column:
    """Thousands of downloads, ten a star, one for 500 characters of readme; two decimals, half up."""
    return F.round(F.coalesce(downloads, F.lit(0)) / 1000 + 10 * F.coalesce(stars, F.lit(0)) + F.coalesce(readme_chars, F.lit(0)) / 500, 2)


def change_impact(old: Column, new: Column) -> Column:
    """Difference of the line counts over the larger one, 1 at most; 1 for an added or removed text, 0 without lines."""
    lines = lambda c: F.when(F.coalesce(c, F.lit("")) == "", 0).otherwise(F.regexp_count(c, F.lit("\n")) + 1)
    a, b = lines(old), lines(new)
    return F.when((a == 0) & (b == 0), F.lit(0.0)).when((a == 0) | (b == 0), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.abs(a - b) / F.greatest(a, b)))


def impact_tag(impact: Column) -> Column:
    """Thresholds are strict."""
    return F.when(impact > 0.5, "high_impact").when(impact > 0.2, "medium_impact").otherwise("low_impact")


def change_type(added: Column, deleted: Column) -> Column:
    many = (added > 100) | (deleted > 100)
    return F.when(added > 2 * deleted, "feature_addition").when(deleted > 2 * added, "cleanup_removal").when(many, "major_refactor").otherwise("minor_change")


def commit_impact(added: Column, deleted: Column) -> Column:
    return F.least(F.lit(10.0), (added + deleted) / 10)


def diff_summary(old: Column, new: Column) -> Column:
    lines = lambda c: F.regexp_count(c, F.lit("\n")) + 1
    delta = lines(new) - lines(old)
    gone, none = F.coalesce(new, F.lit("")) == "", F.coalesce(old, F.lit("")) == ""
    return F.when(none, "added").when(gone, "removed").when(delta > 0, F.format_string("%d more lines", delta)).when(delta < 0, F.format_string("%d fewer lines", -delta)).otherwise("same number of lines")


def share(part: Column, whole: Column, scale: float = 100.0) -> Column:
    """``part`` of ``whole`` in ``scale``; 0 where there is no whole."""
    return F.coalesce(F.try_divide(part * scale, whole), F.lit(0.0)).cast("double")
