"""Rules of the trust verdict."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VERDICTS = ("ALLOW", "DENY", "DEFER", "FLAG")


def quality(docs: Column, sentiment: Column, ecosystem: Column) -> Column:
    """Mean of the documentation score, the sentiment's score and the ecosystem score; unknown ones are 5."""
    feeling = F.when(sentiment == "positive", 8.0).when(sentiment == "negative", 3.0).otherwise(5.0)
    return (F.coalesce(docs, F.lit(5.0)) + feeling + F.coalesce(ecosystem, F.lit(5.0))) / 3


def verdict(score: Column, sentiment: Column) -> Column:
    """``struct(verdict, reason)``; a null score or sentiment meets no condition on it."""
    rule = lambda v, why: F.struct(F.lit(v).alias("verdict"), F.lit(why).alias("reason"))
    good, bad = F.coalesce(sentiment == "positive", F.lit(False)), F.coalesce(sentiment == "negative", F.lit(False))
    return (
        F.when(score >= 8, rule("ALLOW", "high quality"))
        .when((score >= 6) & good, rule("ALLOW", "good quality, well received"))
        .when(score < 4, rule("DENY", "low quality"))
        .when(bad, rule("FLAG", "badly received"))
        .otherwise(rule("DEFER", "not enough to decide"))
    )


def suggestion(steps: Column) -> Column:
    """What the reasoning steps suggest by themselves."""
    has = lambda a, b: F.exists(steps, lambda s: F.lower(s).contains(a) & F.lower(s).contains(b))
    return F.when(F.coalesce(F.size(steps), F.lit(0)) <= 0, "DEFER: no reasoning").when(has("quality", "high"), "ALLOW: high quality").when(has("sentiment", "positive"), "ALLOW: positive sentiment").otherwise("DEFER: more analysis needed")


def confidence(authority: Column, steps: Column, decided: Column) -> Column:
    """5, plus up to 2 for the sources' authority in tenths, up to 2 for the steps in fifths, and 1 or 0.5 for a decision;
    10 at most."""
    settled = F.when(decided == "ALLOW", 1.0).when(decided == "DENY", 0.5).otherwise(0.0)
    return F.least(F.lit(5.0) + F.least(F.coalesce(authority, F.lit(0)) / 10.0, F.lit(2.0)) + F.least(steps * 0.2, F.lit(2.0)) + settled, F.lit(10.0))


def execution_id(text: Column, unique: Column, epoch: Column) -> Column:
    """``exec-<8 hex of the input's digest>-<8 of a unique text>-<seconds>``; the last two are given, so runs can agree."""
    return F.concat_ws("-", F.lit("exec"), F.substring(F.sha2(text, 256), 1, 8), F.substring(unique, 1, 8), epoch.cast("string"))


def intact(execution: Column, *fields: Column) -> Column:
    """Does the id hold the first 16 hex digits of the fields' digest?"""
    return F.contains(execution, F.substring(F.sha2(F.concat_ws("", *fields), 256), 1, 16))


def still_valid(expiry: Column, now: Column | None = None) -> Column:
    return expiry.isNull() | ((F.current_timestamp() if now is None else now) < expiry)
