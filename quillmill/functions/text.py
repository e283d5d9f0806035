"""Text columns: blanks, control characters, joining, sentences, prompts, replies."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ColumnLike = Column | str
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnLike) -> Column:
    """White space of every kind off both ends (trim() takes spaces alone)."""
    return F.btrim(col(c), F.lit(" \t\n\x0b\f\r"))


def as_text(c: ColumnLike) -> Column:
    """Text without null: null is empty."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def clean(c: ColumnLike) -> Column:
    return strip(as_text(c))


def is_blank(c: ColumnLike) -> Column:
    return clean(c) == ""


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text, null as empty."""
    return df.select([as_text(F.col(f"`{c}`")).alias(c) for c in df.columns])


def without_control(df: DataFrame) -> DataFrame:
    """Control characters out of every string column."""
    strings = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.select([F.regexp_replace(F.col(f"`{c}`"), CONTROL, "").alias(c) if c in strings else F.col(f"`{c}`") for c in df.columns])


def joined(*columns: ColumnLike, by: str = " ") -> Column:
    return F.concat_ws(by, *[as_text(c) for c in columns])


def reason(*fragments: Column) -> Column:
    """Fragments that apply (are not null), joined by "; "."""
    return F.concat_ws("; ", *fragments)


def has(c: ColumnLike, pattern: str, ignore_case: bool = True) -> Column:
    return as_text(c).rlike(("(?i)" if ignore_case else "") + pattern)


def holds_after_removing(c: ColumnLike, removed: str, wanted: str) -> Column:
    """Whether a pattern still matches once all matches of another are gone."""
    return F.regexp_replace(as_text(c), f"(?i){removed}", " ").rlike(f"(?i){wanted}")


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    """a / b, and 0 where b is 0 or null."""
    return F.when(col(b) > 0, col(a) / col(b)).otherwise(F.lit(0.0))


def tags_removed(c: ColumnLike) -> Column:
    return F.regexp_replace(as_text(c), "<[^>]+>", "")


def squeezed(c: ColumnLike) -> Column:
    """Lower case, one space between words, none around them."""
    return strip(F.regexp_replace(F.lower(as_text(c)), r"\s+", " "))


def map_text(sections: ColumnLike, by: str = " ") -> Column:
    """All values of a map that are not empty, as one text."""
    return F.array_join(F.filter(F.map_values(col(sections)), lambda v: v.isNotNull() & (v != "")), by)


def keys_matching(sections: ColumnLike, pattern: str, by: str = ",") -> Column:
    """Names of the sections in which a pattern matches."""
    return F.array_join(F.map_keys(F.map_filter(col(sections), lambda _, v: v.rlike(f"(?i){pattern}"))), by)


def tiered_match(c: ColumnLike, tiers: Sequence[tuple[str, str]], width: int = 200) -> Column:
    """struct(best, matched): the first tier that matches, and each tier's first match as "tier:text | ..."."""
    found = [(name, F.regexp_extract(as_text(c), f"(?i){pattern}", 0)) for name, pattern in tiers]
    best = F.coalesce(*[F.when(m != "", F.lit(name)) for name, m in found], F.lit(""))
    matched = F.concat_ws(" | ", *[F.when(m != "", F.concat(F.lit(f"{name}:"), m)) for name, m in found])
    return F.struct(best.alias("best"), F.left(matched, F.lit(width)).alias("matched"))


def distinct_sentences(texts: Iterable[ColumnLike], pattern: str, stop: str = "", longest: int = 0) -> Column:
    """Matches of a sentence pattern over several texts, stripped, each once, in order.

    If every match ends at the first `stop` in it and has at most `longest`
    characters, saying so makes the search linear: the pattern is then tried on
    the last characters before each stop alone. Results are the same.
    """
    found = f"(?i){pattern}"

    def ending(segments: Column) -> Column:
        tails = F.transform(F.slice(segments, 1, F.size(segments) - 1), lambda s: F.regexp_extract(F.concat(F.right(s, F.lit(longest - 1)), F.lit(stop)), found, 0))
        return F.filter(tails, lambda x: x != "")

    if stop and longest:
        each = [ending(F.split(as_text(t), re.escape(stop))) for t in texts]
    else:
        each = [F.regexp_extract_all(as_text(t), F.lit(found), F.lit(0)) for t in texts]
    return F.array_distinct(F.transform(F.concat(*each), lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")))


def budgeted_prompt(title: ColumnLike, sections: ColumnLike, snippets: Column, order: Sequence[str], budget: int = 5000, snippet_limit: int = 1500) -> Column:
    """A prompt of a title, snippets and sections within a budget of code points.

    Snippets come first, joined by line ends and cut at their limit; each
    section in order gets what is left. Labels and separators are not charged.
    Sections that are missing, or come when nothing is left, are left out.
    """
    snippet = F.left(F.array_join(snippets, "\n"), F.lit(snippet_limit))
    head = F.when(F.size(snippets) > 0, F.concat(F.lit("[VARIANTS]\n"), snippet))
    left = F.lit(budget) - F.when(F.size(snippets) > 0, F.length(snippet)).otherwise(0)
    parts: list[Column] = [head]
    for name in order:
        text = F.element_at(col(sections), F.lit(name))
        given = F.when(text.isNotNull() & (left > 0), F.left(text, F.greatest(left, F.lit(0))))
        parts.append(F.when(given.isNotNull(), F.concat(F.lit(f"[{name.upper()}]\n"), given)))
        left = left - F.coalesce(F.length(given), F.lit(0))
    return F.concat(F.lit("Title: "), as_text(title), F.lit("\n\n"), F.concat_ws("\n\n", *parts))


def capped_prompt(title: ColumnLike, names: ColumnLike, texts: ColumnLike, each: int = 4000, total: int = 11000, least: int = 20) -> Column:
    """A title and "[name]" texts, each cut, those of at most `least` code points left out, the whole cut again."""
    pairs = F.filter(F.arrays_zip(col(names).alias("name"), col(texts).alias("text")), lambda p: F.length(p["text"]) > least)
    body = F.transform(pairs, lambda p: F.concat(F.lit("["), p["name"], F.lit("]\n"), F.left(p["text"], F.lit(each))))
    return F.left(F.concat(F.lit("Title: "), as_text(title), F.lit("\n\n"), F.array_join(body, "\n\n")), F.lit(total))


def reply_json(c: ColumnLike) -> Column:
    """A model's reply without its thinking and code fences."""
    bare = F.regexp_replace(as_text(c), r"(?s)<think>.*?</think>", "")
    return strip(F.regexp_replace(bare, r"(?m)^\s*```[a-zA-Z]*\s*$", ""))


def parsed_reply(c: ColumnLike, schema: str) -> Column:
    return F.from_json(reply_json(c), schema)


def band(score: ColumnLike, high: float = 0.7, middle: float = 0.4) -> Column:
    """HIGH, MID or LOW; a null score is LOW."""
    s = F.coalesce(col(score), F.lit(0.0))
    return F.when(s >= high, "HIGH").when(s >= middle, "MID").otherwise("LOW")


def below(score: ColumnLike, limit: float = 0.7) -> Column:
    """Whether a score is under a limit; a null one counts as 0."""
    return F.coalesce(col(score), F.lit(0.0)) < limit


def any_of(terms: Iterable[str], field: str = "") -> str:
    """A boolean search query: terms quoted and joined by OR, in brackets."""
    return "(" + " OR ".join(f'"{t}"{field}' for t in terms) + ")"


def search_query(groups: Iterable[Iterable[str]], language: str, first_year: int, last_year: int) -> str:
    """Term groups joined by OR, then language and years by AND."""
    terms = " OR ".join(any_of(g, "[Title/Abstract]") for g in groups)
    return f"({terms}) AND {language}[Language] AND {first_year}:{last_year}[dp]"


def search_condition(groups: Iterable[Iterable[str]], language: str, first_year: int, last_year: int, body: Column, lang: Column, year: Column) -> Column:
    """What search_query asks for, as a condition on a table: any term in the body, without regard to case, the language and the years."""
    terms = [term for group in groups for term in group]
    found = F.lit(False)
    for term in terms:
        found = found | F.lower(body).contains(term.lower())
    return F.coalesce(found & (F.lower(lang) == language.lower()) & year.between(first_year, last_year), F.lit(False))
