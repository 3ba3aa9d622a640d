"""Text expressions: repositories, sections, truncation, snippets, titles and scores. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What ends a line for the sectioning operators, as a pattern.
LINE_END = "\r\n|[\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
HEADER = r"(?U)^#+\s+"
#: Priorities of section headings, first match wins; other sections have 5, text before any heading 10.
PRIORITIES = ((10, "usage|example|getting started"), (9, "feature|overview|about"), (8, "install|setup|config"), (7, "api|interface"))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def canonical_name(c: Column) -> Column:
    """Stripped and lower-cased, without a leading ``crate:`` and then ``rust:``."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "^crate:", ""), "^rust:", "")


_LINK = r"github\.com[/:]([^/\s]+)/([^/\s?#]+)"
#: Each variant's pattern of owner and name.
REPOSITORY_VARIANTS = {"full": _LINK, "to_dot": _LINK, "path": r"github\.com/([^/]+)/([^/]+)", "dotless": r"github\.com[/:]([^/]+)/([^/.]+)", "anchored": r"^https?://github\.com/([^/]+)/([^/]+?)(?:\.git)?/?$"}


def repository_of(url: Column, variant: str = "full") -> Column:
    """``struct(owner, repo)`` of a forge link, null where there is none.

    Variants: ``full`` keeps dots and drops a trailing ``.git``; ``to_dot`` ends the name at the first dot; ``path`` takes
    web links only, with whatever stands between slashes; ``dotless`` knows no name with a dot; ``anchored`` takes a link
    to a repository itself, not to a page in it.
    """
    pattern = REPOSITORY_VARIANTS[variant]
    owner, repo = F.regexp_extract(url, pattern, 1), F.regexp_extract(url, pattern, 2)
    name = F.substring_index(repo, ".", 1) if variant == "to_dot" else F.regexp_replace(repo, r"\.git$", "") if variant in ("full", "path") else repo
    return F.when((owner != "") & (name != ""), F.struct(owner.alias("owner"), name.alias("repo")))


def estimate_tokens(c: Column) -> Column:
    """A quarter of the code points, rounded down."""
    return F.floor(F.char_length(F.coalesce(c, F.lit(""))) / 4)


def truncate_prefix(c: Column, max_tokens: int, separator: str = "\n\n") -> Column:
    """The paragraphs whose running token estimate stays within ``max_tokens``, stripped.

    Estimates are not negative, so stopping at the first that doesn't fit keeps exactly a prefix: only its length is
    folded, the text is joined once.
    """
    parts = F.split(F.coalesce(c, F.lit("")), F.lit(_quoted(separator)), -1)
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("n"))
    fit = F.aggregate(
        parts,
        start,
        lambda a, p: F.when(a["sum"] + estimate_tokens(p) <= max_tokens, F.struct((a["sum"] + estimate_tokens(p)).alias("sum"), (a["n"] + 1).alias("n"))).otherwise(F.struct(F.lit(1 << 60).cast("bigint").alias("sum"), a["n"].alias("n"))),
        lambda a: a["n"],
    )
    return strip(F.array_join(F.slice(parts, 1, fit), separator))


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once: what a lambda captures is evaluated anew for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cut_at(lines: Column, is_heading: Callable[[Column], Column], body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of the lines and of where sections start: -1 for the text before any heading, then each heading's line."""
    marks = lambda own: F.concat(F.array(F.lit(-1)), F.filter(F.transform(own, lambda x, i: F.when(is_heading(x), i)), lambda i: i.isNotNull()))
    return bound(lines, lambda own: bound(marks(own), lambda starts: body(own, starts)))


def sections(c: Column) -> Column:
    """``array<struct<heading,content,priority,index>>``: the text cut at markdown headings, in order.

    A section's content has its heading line and ends in a line feed; sections without content are left out. A fenced
    block tagged for the language lifts a section to 8 at least. Lines are split once, so the cost is that of the text.
    """
    text = F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), LINE_END, "\n"), "\n\\z", "")

    def section(lines: Column, starts: Column, start: Column, k: Column) -> Column:
        until = F.coalesce(F.get(starts, k + 1), F.size(lines))
        own = F.slice(lines, F.greatest(start, F.lit(0)) + 1, until - F.greatest(start, F.lit(0)))
        heading = F.when(start < 0, F.lit("Introduction")).otherwise(F.regexp_replace(F.get(lines, start), HEADER, ""))
        rank = F.when(start < 0, F.lit(10))
        for value, words in PRIORITIES:
            rank = rank.when(heading.rlike(rf"(?iU)\b({words})\b"), F.lit(value))
        fenced = F.exists(own, lambda x: ~x.rlike(HEADER) & (x.contains("```rust") | x.contains("```no_run")))
        rank = rank.otherwise(F.lit(5))
        return F.struct(heading.alias("heading"), F.concat(F.array_join(own, "\n"), F.lit("\n")).alias("content"), F.when(fenced, F.greatest(rank, F.lit(8))).otherwise(rank).alias("priority"), k.alias("index"))

    cut = _cut_at(F.split(text, "\n", -1), lambda x: x.rlike(HEADER), lambda lines, starts: F.transform(starts, lambda start, k: section(lines, starts, start, k)))
    return F.filter(cut, lambda s: s["content"].rlike(r"(?U)\S"))


def smart_truncate(c: Column, max_tokens: int = 1000) -> Column:
    """The sections of highest priority that fit ``max_tokens``, stable; a text within the budget stays as it is.

    A section that doesn't fit is cut to the rest and ends the result if more than 100 tokens are left, else it is passed
    over and later ones may still fit.
    """
    ordered = F.array_sort(F.transform(sections(c), lambda s: F.struct((-s["priority"]).alias("rank"), s["index"].alias("index"), F.concat(F.lit("## "), s["heading"], F.lit("\n"), s["content"], F.lit("\n")).alias("text"))))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("bigint").alias("used"), F.lit(False).alias("done"))

    def step(a: Column, s: Column) -> Column:
        cost = estimate_tokens(s["text"])
        room = (F.lit(max_tokens) - a["used"]) * 4
        part = F.when(F.char_length(s["text"]) > room, F.concat(F.substring(s["text"], F.lit(1), room.cast("int")), F.lit("..."))).otherwise(s["text"])
        take = F.struct(F.concat(a["out"], F.array(s["text"])).alias("out"), (a["used"] + cost).alias("used"), a["done"].alias("done"))
        last = F.struct(F.concat(a["out"], F.array(part)).alias("out"), a["used"].alias("used"), F.lit(True).alias("done"))
        return F.when(a["done"], a).when(a["used"] + cost <= max_tokens, take).when(a["used"] < max_tokens - 100, last).otherwise(a)

    cut = F.aggregate(ordered, start, step, lambda a: F.array_join(a["out"], ""))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("")).when(estimate_tokens(c) <= max_tokens, c).otherwise(cut)


def code_snippets(c: Column, most: int = 5) -> Column:
    """The first fenced blocks of more than 10 characters, stripped."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"```(?:rust|no_run|ignore|compile_fail)?\s*([\s\S]*?)```"), 1)
    return F.slice(F.filter(F.transform(found, strip), lambda x: F.char_length(x) > 10), 1, most)


def readme_sections(c: Column) -> Column:
    """A map from lower-case headings with underscores to their text; text before any is ``intro``, the last of equal
    headings wins, and a heading without lines has no entry."""

    def entry(lines: Column, starts: Column, start: Column, k: Column) -> Column:
        until = F.coalesce(F.get(starts, k + 1), F.size(lines))
        own = F.slice(lines, start + 2, until - start - 1)
        name = F.when(start < 0, F.lit("intro")).otherwise(F.replace(F.lower(strip(F.regexp_replace(F.get(lines, start), "^#+|#+$", ""))), F.lit(" "), F.lit("_")))
        return F.struct(name.alias("key"), strip(F.array_join(own, "\n")).alias("value"), (until - start - 1).alias("n"))

    cut = _cut_at(F.split(F.coalesce(c, F.lit("")), "\n", -1), lambda x: x.startswith("#"), lambda lines, starts: F.transform(starts, lambda start, k: entry(lines, starts, start, k)))

    def last_of_each(found: Column) -> Column:
        by_key = F.array_sort(F.transform(found, lambda e, i: F.struct(e["key"].alias("key"), i.alias("i"))))
        kept = bound(by_key, lambda own: F.filter(F.transform(own, lambda x, i: F.when(~x["key"].eqNullSafe(F.get(own, i + 1)["key"]), x["i"])), lambda i: i.isNotNull()))
        return F.transform(F.array_sort(kept), lambda i: F.struct(F.get(found, i)["key"].alias("key"), F.get(found, i)["value"].alias("value")))

    last = bound(F.filter(cut, lambda e: e["n"] > 0), last_of_each)
    return F.when(F.coalesce(c, F.lit("")) == "", F.map_from_entries(F.array().cast("array<struct<key:string,value:string>>"))).otherwise(F.map_from_entries(last))


def title_of(c: Column) -> Column:
    """The first ``# `` line among the first five, else ``Untitled``."""
    found = F.filter(F.slice(F.split(F.coalesce(c, F.lit("")), "\n", -1), 1, 5), lambda x: x.startswith("# "))
    return F.coalesce(strip(F.substring(F.get(found, F.lit(0)), 3, 1 << 30)), F.lit("Untitled"))


def quality_score(c: Column, structured: Column | None = None) -> Column:
    """0 for no text; 3, 2 or 1 by length over 1000, 500, 100; 2 with structured data; 1 for naming a title or a
    description; 10 at most."""
    n = F.char_length(F.coalesce(c, F.lit("")))
    size = F.when(n > 1000, 3.0).when(n > 500, 2.0).when(n > 100, 1.0).otherwise(0.0)
    data = F.lit(0.0) if structured is None else F.when(F.coalesce(structured, F.lit("")).isin("", "{}"), 0.0).otherwise(2.0)
    named = F.when(F.lower(c).contains("title") | F.lower(c).contains("description"), 1.0).otherwise(0.0)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.least(size + data + named, F.lit(10.0)))


def download_count(c: Column) -> Column:
    """The number before the word ``downloads``, thousands separators dropped."""
    return F.regexp_replace(F.regexp_extract(c, r"([0-9][0-9,]*)\s+downloads", 1), ",", "").try_cast("bigint")


def feature_text(features: Column, most: int = 8) -> Column:
    """One line per feature: its name and what it needs."""
    line = lambda f: F.concat(F.lit("- "), f["name"], F.when(F.size(f["dependencies"]) > 0, F.concat(F.lit(" (needs "), F.array_join(f["dependencies"], ", "), F.lit(")"))).otherwise(F.lit("")))
    return F.array_join(F.transform(F.slice(features, 1, most), line), "\n")


def features_of_map(c: Column) -> Column:
    """A map of features as the ordered list form."""
    return F.transform(F.map_entries(c), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("dependencies")))


def features_of_names(c: Column) -> Column:
    """A list of names as the list form."""
    return F.transform(c, lambda n: F.struct(n.alias("name"), F.array().cast("array<string>").alias("dependencies")))
