"""Facts in HTML pages: title, description, links, keywords, main text, counts."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import download_count, quality_score

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
SELECTORS = {"docs": ("main",), "readme": ("article", ".readme", "main")}


class _Page(HTMLParser):
    def __init__(self, host: str):
        super().__init__(convert_charrefs=True)
        self.host, self.open, self.text, self.links = host, [], {}, []
        self.keywords: list[str] = []
        self.all: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "a" and a.get("href"):
            self.links.append(a["href"])
        if tag not in VOID:
            self.open.append((tag, frozenset((a.get("class") or "").split())))
            for name in self._names():
                self.text.setdefault(name, [])

    def _names(self):
        tag, classes = self.open[-1]
        return [tag, *("." + c for c in classes)]

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        if any(t in ("script", "style") for t, _ in self.open):
            return
        self.all.append(data)
        names = {n for t, c in self.open for n in (t, *("." + x for x in c))}
        for n in names:
            self.text.setdefault(n, []).append(data)
        if self.open and self.open[-1][0] == "a" and any("keywords" in c for _, c in self.open):
            self.keywords.append(data.strip())

    def first(self, *names):
        for n in names:
            if "".join(self.text.get(n, [])).strip():
                return "".join(self.text[n]).strip()
        return None


def _heading(html: str) -> str:
    """What stands between the first ``<h1>`` and ``</h1>``, without tags; entities count only when whole. ``""`` for none."""
    start = html.find("<h1")
    start = html.find(">", start) if start >= 0 else -1
    end = html.find("</h1>", start) if start >= 0 else -1
    if end < 0:
        return ""
    tagged, close, rest = html[start + 1 : end].rpartition(">")  # beyond the last > there is no tag to look for
    text = re.sub("<[^>]+>", "", tagged + close) + rest
    for entity, char in ENTITIES:
        text = text.replace(entity, char)
    return text.strip(SPACES)


def _anchors(html: str) -> int:
    """Places of ``<a ... href=``, one a tag at most: what the markup has, commented out or not."""
    return sum(0 <= (at := part.find("<a ")) and part.find("href=", at + 3) >= 0 for part in html.split(">"))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", kind: str = "readme", host: str = "github.com") -> DataFrame:
    """``id_col, title, description, forge_link, links, keywords, content, heading, anchors, downloads, quality_score``: one
    row a page.

    The content is the text of the first of the kind's places that has any, else of the whole page; broken markup gives
    what could be read, a null page nulls. ``heading`` and ``anchors`` are of the markup as it is written, where the parser
    mends it: it takes a cut ``&amp`` for an entity.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for html in batch["_html"]:
                if html is None:
                    out.append((None, None, None, [], [], None, None, None))
                    continue
                page = _Page(host)
                page.feed(html)
                page.close()
                text = page.first(*SELECTORS.get(kind, ())) or "".join(page.all).strip()
                out.append((page.first("h1", "title"), page.first(".description"), next((x for x in page.links if host in x), None), page.links, page.keywords, text, _heading(html), _anchors(html)))
            found = pd.DataFrame(out, columns=["title", "description", "forge_link", "links", "keywords", "content", "heading", "anchors"]).astype({"anchors": "Int32"})
            found.insert(0, "_id", batch["_id"].to_numpy())
            yield found

    source = pages.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))
    kind_of = source.schema["_id"].dataType.simpleString()
    out = source.mapInPandas(run, f"_id {kind_of}, title string, description string, forge_link string, links array<string>, keywords array<string>, content string, heading string, anchors int")
    return out.withColumnRenamed("_id", id_col).withColumns({"downloads": download_count(F.col("content")), "quality_score": quality_score(F.col("content"))})
