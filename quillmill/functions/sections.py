"""Sections of marked-up documents: a parser for XML articles and HTML pages, and a native splitter."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import ColumnLike, as_text, strip, tags_removed

# Section titles and their canonical names, in the order in which they are tried.
SYNONYMS = {
    "introduction": "introduction", "intro": "introduction", "background": "background", "methods": "methods", "materials and methods": "methods",
    "methods and materials": "methods", "methodology": "methods", "experimental procedures": "methods", "experimental section": "methods",
    "patients and methods": "methods", "subjects and methods": "methods", "results": "results", "results and discussion": "results",
    "findings": "results", "discussion": "discussion", "conclusion": "conclusion", "conclusions": "conclusion", "summary": "conclusion",
}


def canonical(title: str) -> str | None:
    """A title's canonical name: an exact synonym, else the first one that it contains."""
    key = title.strip().lower()
    return SYNONYMS.get(key) or next((name for word, name in SYNONYMS.items() if word in key), None)


def _text(node: ET.Element) -> str:
    return " ".join(" ".join(t.split()) for t in node.itertext() if t.strip())


def article_sections(xml: str) -> dict[str, str]:
    """{name: text} of an XML article, with its title and abstract; unparsable text has none."""
    try:
        root = ET.fromstring(xml)
    except (ET.ParseError, ValueError):
        return {}
    found: dict[str, str] = {}
    for name, tag in (("title", "article-title"), ("abstract", "abstract")):
        node = next(root.iter(tag), None)
        if node is not None and (text := _text(node)):
            found[name] = text
    for section in root.iter("sec"):
        title = section.find("title")
        name = canonical(_text(title)) if title is not None else None
        text = " ".join(filter(None, (_text(child) for child in section if child is not title)))
        if name and text:
            found.setdefault(name, text)
    return found


class _Page(HTMLParser):
    """Text under each heading of a page; scripts and styles are skipped."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: dict[str, list[str]] = {"": []}
        self.heading, self.in_heading, self.skipped = "", False, 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in ("script", "style"):
            self.skipped += 1
        if tag in ("title", "h1", "h2", "h3"):
            self.in_heading, self.heading = True, ""

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.skipped = max(0, self.skipped - 1)
        if tag in ("title", "h1", "h2", "h3"):
            self.in_heading, self.heading = False, " ".join(self.heading.split())

    def handle_data(self, data: str) -> None:
        if self.skipped:
            return
        if self.in_heading:
            self.heading += data
        elif data.strip():
            self.found.setdefault(self.heading, []).append(" ".join(data.split()))


def page_sections(html: str) -> dict[str, str]:
    """{heading: text} of an HTML page, text before any heading under the empty one."""
    page = _Page()
    page.feed(html)
    page.close()
    return {k: " ".join(v) for k, v in page.found.items() if v}


def with_sections(df: DataFrame, column: str, kind: str = "xml") -> DataFrame:
    """df and `sections` (map), `n_sections`, `chars_total`, parsed in Arrow batches; null has none."""
    parse = article_sections if kind == "xml" else page_sections

    @F.pandas_udf("map<string,string>")
    def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda x: parse(x) if x else {})

    out = df.withColumn("sections", parsed(F.col(column)))
    return out.withColumns({"n_sections": F.size("sections"), "chars_total": total_chars("sections")})


def total_chars(sections: ColumnLike) -> Column:
    return F.aggregate(F.map_values(sections), F.lit(0).cast("long"), lambda a, v: a + F.length(v))


def split_by_tag(markup: ColumnLike, tag: str = "sec") -> Column:
    """Texts of a tag's elements without nesting, tags stripped: native, no parser."""
    inner = F.regexp_extract_all(as_text(markup), F.lit(f"(?s)<{tag}(?: [^>]*)?>(.*?)</{tag}>"), F.lit(1))
    return F.transform(inner, lambda x: strip(F.regexp_replace(tags_removed(x), r"\s+", " ")))
