"""Vocabularies of thousands of terms, found in one pass over each text by an automaton."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Terms in one automaton. A larger vocabulary is parted by a hash of the term, and each part is a pass of its own.
MOST_TERMS = 200_000
_WORD = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _automaton(terms: list[str]):
    import ahocorasick

    made = ahocorasick.Automaton()
    for term in terms:
        made.add_word(term, term)
    if terms:
        made.make_automaton()
    return made


def _hits(text: str, automaton, whole_words: bool) -> dict[str, int]:
    found: dict[str, int] = {}
    for end, term in automaton.iter(text):
        start = end - len(term) + 1
        if whole_words and (start and text[start - 1] in _WORD and term[0] in _WORD or end + 1 < len(text) and text[end + 1] in _WORD and term[-1] in _WORD):
            continue
        found[term] = found.get(term, 0) + 1
    return found


def term_hits(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text", term: str = "term", whole_words: bool = True, fold: bool = False, most: int = MOST_TERMS) -> DataFrame:
    """(key, term, n): how often each text has each term, overlapping ones too; texts without any have no row.

    One pass over the texts for every `most` terms, whose time does not grow with
    their number. At the edges of whole words stands no ASCII letter, digit or
    underscore beside one of the term; fold compares A-Z without case, and terms
    are then given in small letters. Null and empty texts and terms match nothing; repeated terms count
    once; repeated rows of docs repeat; other columns are dropped.
    """
    wanted = terms.select(F.col(term).cast("string").alias("term")).where("term <> ''")
    if fold:
        wanted = wanted.select(F.translate("term", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("term"))
    wanted = wanted.distinct()
    parts = -(-wanted.count() // most) or 1
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("text <> ''")
    schema = f"key {dict(rows.dtypes)['key']}, term string, n long"
    out = None
    for part in range(parts):
        own = wanted.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == part) if parts > 1 else wanted
        held = docs.sparkSession.sparkContext.broadcast(sorted(r.term for r in own.toLocalIterator()))  # about `most`

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            automaton = _automaton(held.value)
            for batch in batches:
                found = [(k, t, n) for k, s in zip(batch["key"], batch["text"]) if len(held.value) for t, n in _hits(s.translate(_FOLD) if fold else s, automaton, whole_words).items()]
                yield pd.DataFrame(found, columns=["key", "term", "n"])

        hits = rows.mapInPandas(run, schema)
        out = hits if out is None else out.union(hits)
    return out.withColumnRenamed("key", key)
