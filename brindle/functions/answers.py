"""Cleaning and checking of model answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

#: In the order that decides between several.
CATEGORIES = "AI|Database|Web Framework|Networking|Serialization|Utilities|DevTools|ML|Cryptography|Unknown".split("|")


def answer_of(c: Column) -> Column:
    """The text before the end mark, stripped."""
    return strip(F.get(F.split(F.coalesce(c, F.lit("")), r"<\|end\|>", 2), F.lit(0)))


def category_of(c: Column) -> Column:
    """The first category, in list order, that the answer names as a whole word; empty for no answer."""
    text = answer_of(c)
    out = F.when(F.coalesce(c, F.lit("")) == "", F.lit(""))
    for name in CATEGORIES:
        out = out.when(text.rlike(rf"(?iU)\b{name}\b"), F.lit(name))
    return out.otherwise(F.lit("Unknown"))


def fact_pairs(c: Column) -> Column:
    """Facts and counterfacts paired in order, blocks apart by an empty line; what has no partner is dropped."""
    text = answer_of(c)
    part = lambda mark, name, until: F.regexp_extract_all(text, F.lit(rf"(?s){mark}\s*{name}:?\s*(.*?)(?={until}|\z)"), 1)
    facts, counter = part("✅", "Factual", "❌"), part("❌", "Counterfactual", "✅")
    n = F.least(F.size(facts), F.size(counter))
    both = F.zip_with(F.slice(facts, 1, n), F.slice(counter, 1, n), lambda a, b: F.concat(F.lit("✅ Factual: "), strip(a), F.lit("\n❌ Counterfactual: "), strip(b)))
    return F.array_join(both, "\n\n")


def general_answer(c: Column, drop_blank_lines: bool = False) -> Column:
    text = answer_of(c)
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: strip(x) != ""), "\n") if drop_blank_lines else text


def score_of(c: Column, least: float = 0.0) -> Column:
    """The first number, between ``least`` and 10; 5 where there is none."""
    found = F.regexp_extract(F.coalesce(c, F.lit("")), r"([0-9]+\.?[0-9]*)", 1).try_cast("double")
    return F.when(found.isNull(), F.lit(5.0)).otherwise(F.greatest(F.lit(least), F.least(F.lit(10.0), found)))


def valid_category(c: Column, exact: bool = False) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    names = [n.lower() for n in CATEGORIES]
    if exact:
        return strip(low).isin(names)
    found = F.lit(False)
    for n in names:
        found = found | low.contains(n)
    return found


def valid_pairs(c: Column, least: int = 1) -> Column:
    text = F.coalesce(c, F.lit(""))
    return (F.regexp_count(text, F.lit("✅")) >= least) & (F.regexp_count(text, F.lit("❌")) >= least)


def simpler_prompt(c: Column, most: int | None = 8000, drop_examples: bool = False) -> Column:
    """White space collapsed; without worked examples if asked; cut to ``most`` characters with an ellipsis."""
    text = F.regexp_replace(c, r"(?s)<example>.*?</example>", "") if drop_examples else c
    text = F.regexp_replace(F.regexp_replace(text, r"\n\s*\n+", "\n"), r" +", " ")
    return text if most is None else F.when(F.char_length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text)
