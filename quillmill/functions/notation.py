"""Variant notation: normal forms, identifiers, positions, relevance."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.text import ColumnLike, as_text, clean, col, squeezed, strip

# One-letter residues and their three-letter names.
RESIDUES = {
    "a": "ala", "r": "arg", "n": "asn", "d": "asp", "c": "cys", "q": "gln", "e": "glu", "g": "gly", "h": "his", "i": "ile", "l": "leu",
    "k": "lys", "m": "met", "f": "phe", "p": "pro", "s": "ser", "t": "thr", "w": "trp", "y": "tyr", "v": "val", "x": "xaa",
}


def alternation(words) -> str:
    """A pattern of words, the longest first, so that no word hides a longer one that begins with it; equally long ones by letters."""
    return "|".join(re.escape(w) for w in sorted(set(words), key=lambda w: (-len(w), w)))


_THREE = alternation(RESIDUES.values())


def coding_normal(c: ColumnLike) -> Column:
    """A coding variant without transcript and deleted or duplicated bases, prefix in lower case."""
    out = clean(c)
    for pattern, put in (
        (r"(?i)^[A-Z]+_[0-9.]+\s*:\s*", ""),
        (r"(?i)(del)[ACGT]+$", "$1"),
        (r"(?i)(dup)[ACGT]+$", "$1"),
        (r"C\.", "c."),
        (r"P\.", "p."),
    ):
        out = F.regexp_replace(out, pattern, put)
    return strip(out)


def coding_key(c: ColumnLike) -> Column:
    return F.lower(coding_normal(c))


def _spelled(body: Column, before: str, after: str) -> Column:
    """One-letter residues between two contexts by their three-letter names, one rewrite for each letter."""
    for letter, name in RESIDUES.items():
        body = F.regexp_replace(body, f"{before}{letter}{after}", f"$1{name}$2" if "(" in before else f"{name}$1")
    return body


def protein_normal(c: ColumnLike) -> Column:
    """A protein variant for comparison: lower case, spelled residues, "ter" for stops, no residue before a frameshift's stop.

    Blank stays blank. As a consequence of the residue table, a final X is xaa, not a stop.
    """
    h = clean(c)
    bare = F.regexp_replace(F.regexp_replace(h, r"^[Pp]\.\((.+)\)$", "p.$1"), r"^[Pp]\.", "")
    body = F.lower(F.regexp_replace(F.replace(bare, F.lit("*"), F.lit("ter")), r"fs([0-9])", "fster$1"))
    body = _spelled(body, "^", "([0-9]+)")
    body = _spelled(body, "([0-9])", "(?=fster|ter|$|[0-9])()")
    body = F.regexp_replace(body, f"({_THREE})([0-9]+)(?:{_THREE})(fster[0-9]+)", "$1$2$3")
    return F.when(h == "", "").otherwise(F.concat(F.lit("p."), body))


def parsed_id(c: ColumnLike) -> Column:
    """struct(coding, protein) of an identifier like #gene#c.1A>G or #gene#p.R1X."""
    return F.struct(F.regexp_extract(as_text(c), r"#(c\.[^#\s]+)", 1).alias("coding"), F.regexp_extract(as_text(c), r"#(p\.[^#\s]+)", 1).alias("protein"))


def positions(c: ColumnLike) -> Column:
    """Distinct runs of digits, in order."""
    return F.array_distinct(F.regexp_extract_all(as_text(c), F.lit("[0-9]+"), F.lit(0)))


# What makes a mention relevant to truncation, in lower case. A
# word's edge is spelled out, so that every engine reads it alike.
_EDGE, _END = "(?:^|[^a-z0-9_])", "(?:$|[^a-z0-9_])"
RELEVANT = "|".join([
    f"{_EDGE}fs{_END}", "frameshift", "fsTer", "fsX", f"{_EDGE}ter{_END}", "nonsense", f"{_EDGE}stop{_END}", f"{_EDGE}trunc", "[*x][0-9]+", f"x{_END}",
    f"{_EDGE}del{_END}", f"{_EDGE}dup{_END}", f"{_EDGE}ins{_END}", "delins", "ext[*]", f"{_EDGE}ext[a-z]", "splice", "splicing",
])


def is_relevant(mention: ColumnLike, identifier: ColumnLike, pattern: str = RELEVANT) -> Column:
    return F.lower(F.concat_ws(" ", as_text(mention), as_text(identifier))).rlike(pattern)


def valid_coding(c: ColumnLike) -> Column:
    """The value if it looks like a coding variant, else empty; the row stays."""
    return F.when(clean(c).rlike(r"(?i)^c\.[0-9_+\-*]"), clean(c)).otherwise("")


def valid_protein(c: ColumnLike) -> Column:
    return F.when(clean(c).rlike(r"(?i)^p\."), clean(c)).otherwise("")


def one_of(c: ColumnLike, allowed: tuple[str, ...], default: str) -> Column:
    """Upper-cased value of a closed list, or the default."""
    value = F.upper(clean(c))
    return F.when(value.isin(*allowed), value).otherwise(default)


def loose_boolean(c: ColumnLike, default: bool = True) -> Column:
    """Booleans that came as text: false, no, 0 and n are false, null is the default."""
    return F.when(col(c).isNull(), F.lit(default)).otherwise(~F.lower(clean(c)).isin("false", "no", "0", "n", ""))


def is_disease_id(c: ColumnLike) -> Column:
    return clean(c).rlike("^[0-9]{5,6}$")


def paired_lists(a: ColumnLike, b: ColumnLike, by: str = ";") -> Column:
    """Two delimited lists as an array of (left, right), the shorter padded with empty text."""
    pairs = F.arrays_zip(F.split(as_text(a), by).alias("left"), F.split(as_text(b), by).alias("right"))
    return F.transform(pairs, lambda p: F.struct(clean(p["left"]).alias("left"), clean(p["right"]).alias("right")))


def word_overlap(wanted: ColumnLike, given: ColumnLike) -> Column:
    """The share of the wanted text's distinct words that the given one has; 0 for no words, -1 for a given one marked { or ?."""
    a, b = F.array_distinct(F.split(squeezed(wanted), " ")), F.array_distinct(F.split(squeezed(given), " "))
    share = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when(squeezed(wanted) == "", F.lit(0.0)).when(as_text(given).rlike(r"^[{?]"), F.lit(-1.0)).otherwise(share)
