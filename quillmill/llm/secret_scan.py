"""Secret scanning: a wide pattern, then a random forest against false findings.

Everything that touches the tables is a DataFrame expression. The trees are
grown on the driver from a bounded sample of labelled findings and applied as
expressions over arrays of their nodes. What makes a label (a known format, or
the word that a value is assigned to) is cut out of the value and its
neighbourhood before the features are made, so that the forest judges by the
value's make, its path and the words around it, and also finds secrets that
are not assigned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.support import session, settle
from quillmill.llm.trees import forest

#: What may be a secret: a whole run of twelve key characters or more with a digit, quoted or not.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{12,}"
# Formats that are secrets, and the words before an assigned one.
KNOWN_FORMATS = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_(live|test)_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$"
ASSIGNED = r"(?i)[A-Za-z_-]*(password|passwd|pwd|secret|token|api_?key|access_?key|credential)s?[\"']?\s{0,2}[:=]\s{0,2}[\"']?$"
ASSIGNED_INSIDE = r"(?i)^[A-Za-z_-]*(password|passwd|pwd|secret|token|api_?key|access_?key|credential)s?=(?=.)"
PATH_WORDS = r"(?i)(https?:|www\.|/[a-z]+/|\.html|\.com|file|path|src=|href=)"
CODE_WORDS = r"(?i)(user|login|config|env|export|header|client|server|account)"
#: Findings fitted on, at most, and documents that they come from, about; words in the dictionary; characters of context on each side.
SAMPLE_FINDINGS, SAMPLE_DOCS, DICTIONARY_WORDS, CONTEXT = 20_000, 400_000, 300, 40
#: Findings of every how manieth document are not fitted on, but give the false findings removed and the secrets kept.
JUDGED = 5
FEATURES = [
    "length", "digits", "uppers", "lowers", "marks", "changes", "letter_to_digit", "distinct", "longest_letters", "hex", "covered", "path_near", "quoted", "equals", "all_digits",
    "prose_before", "prose_after", "code_before", "code_after", "known_words", "ended",
]


def dictionary(docs: DataFrame, size: int = DICTIONARY_WORDS, text_column: str = "text") -> list[str]:
    """The most frequent words of 4 to 12 letters in all documents: `size` of them, of equal ones the first by letters."""
    word = F.explode(F.split(F.lower(F.col(text_column)), "[^a-z]+")).alias("word")
    counted = docs.select(word).where(F.length("word").between(4, 12)).groupBy("word").count()
    return [r.word for r in counted.orderBy(F.desc("count"), "word").limit(size).collect()]


def find_candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, start, end, value, before, after) of every candidate, places in code points.

    Null and empty texts have none; repeated rows have theirs each; an empty
    table gives an empty result. The text between two candidates is cut to the
    context on either side before rows are made; places are a running sum of
    lengths over the candidates of one text.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where(text.rlike(CANDIDATE))
    rows = rows.select("doc_id", F.monotonically_increasing_id().alias("row"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("values"), F.split(text, CANDIDATE, -1).alias("gaps"))
    around = F.transform(
        F.arrays_zip("values", F.slice("gaps", 1, F.size("values")).alias("l"), F.slice("gaps", 2, F.size("values")).alias("r")),
        lambda c: F.struct(c["values"].alias("value"), F.length(c["l"]).alias("gap"), F.right(c["l"], F.lit(CONTEXT)).alias("before"), F.left(c["r"], F.lit(CONTEXT)).alias("after")),
    )
    found = rows.select("doc_id", "row", F.posexplode(around).alias("i", "c")).select("doc_id", "row", "i", "c.*")
    end = F.sum(F.col("gap") + F.length("value")).over(Window.partitionBy("row").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    return found.withColumn("end", end).select("doc_id", (F.col("end") - F.length("value")).alias("start"), "end", "value", "before", "after")


def with_features(found: DataFrame, words: list[str]) -> DataFrame:
    """found and `x`, the FEATURES of each candidate as an array of doubles; nulls count as empty."""
    given = lambda c: F.coalesce(F.col(c), F.lit(""))
    v = F.regexp_replace(given("value"), ASSIGNED_INSIDE, "")
    before, after = F.regexp_replace(given("before"), ASSIGNED, ""), given("after")
    n = F.greatest(F.length(v), F.lit(1)).cast("double")
    share = lambda kept: F.length(F.regexp_replace(v, f"[^{kept}]", "")) / n
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]", "b"), "[A-Z]", "B"), "[0-9]", "0"), "[+/_=-]", "-")
    changes = (F.length(F.regexp_replace(classes, r"(.)\1+", "$1")) - 1) / n
    to_digit = F.size(F.regexp_extract_all(classes, F.lit("[bB]0"), F.lit(0))) / n
    letters = F.array_max(F.transform(F.regexp_extract_all(v, F.lit("[A-Za-z]+"), F.lit(0)), lambda s: F.length(s)))
    rest = F.regexp_replace(F.lower(v), "|".join(sorted(words, key=lambda w: (-len(w), w))) or "$^", "")
    near = F.array_distinct(F.regexp_extract_all(F.lower(F.concat_ws(" ", before, after)), F.lit("[a-z]{4,}"), F.lit(0)))
    known = F.size(F.array_intersect(near, F.array(*map(F.lit, words)).cast("array<string>"))) / F.greatest(F.size(near), F.lit(1))
    flag = lambda c: c.cast("double")
    x = [n, share("0-9"), share("A-Z"), share("a-z"), share("+/_=-"), changes, to_digit, F.size(F.array_distinct(F.split(v, ""))) / n, F.coalesce(letters, F.lit(0)) / n, flag(v.rlike("^[0-9a-f]+$")), 1 - F.length(rest) / n]
    x += [flag(before.rlike(PATH_WORDS) | v.rlike("/.*/")), flag(after.rlike("^[\"'`]")), flag(v.rlike("=.")), flag(v.rlike("^[0-9-]+$"))]
    x += [flag(before.rlike(r"[a-z]{2,}[ ,.]+$")), flag(after.rlike(r"^[ ,.]+[a-z]{2,}")), flag(before.rlike(CODE_WORDS)), flag(after.rlike(CODE_WORDS)), known, flag(after.rlike(r"^\s*$|^[.]?\s*\n"))]
    return found.withColumn("x", F.array(*[c.cast("double") for c in x]))


def labelled_findings(found: DataFrame) -> DataFrame:
    """found and `y`: 1 for a known format or an assigned value that mixes digits and letters, else 0.

    Findings labelled by hand can take their place in fit().
    """
    mixed = F.col("value").rlike("[A-Za-z]") & F.col("value").rlike("[0-9].*[0-9].*[0-9]")
    return found.withColumn("y", (F.col("value").rlike(KNOWN_FORMATS) | (mixed & (F.col("before").rlike(ASSIGNED) | F.col("value").rlike(ASSIGNED_INSIDE)))).cast("int"))


def fit(labelled: DataFrame, findings: int = SAMPLE_FINDINGS) -> list[list[tuple]]:
    """(x, y) -> a forest, from at most `findings` distinct ones by hash, half of either label where there are enough."""
    got = []
    for y in (0, 1):
        rows = labelled.where(F.col("y") == y).select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(findings // 2)
        got += [(r.x, y) for r in rows.collect()]
    if len({y for _, y in got}) < 2:
        return [[(-1, 0.0, 0, 0, float(got[0][1]) if got else 0.0)]]
    return forest(np.array([x for x, _ in got], dtype=float), np.array([y for _, y in got]))


def forest_score(trees: list[list[tuple]], x: str = "x") -> Column:
    """The mean of the trees' values for the array column x, as one expression over arrays of nodes."""
    total = F.lit(0.0)
    for tree in trees:
        total = total + _tree_value(tree, F.col(x))
    return total / F.lit(float(len(trees)))


def _tree_value(tree: list[tuple], x: Column) -> Column:
    feature, threshold, left, right, value = (F.array(*[F.lit(v) for v in column]) for column in zip(*tree))

    def step(node: Column, _: Column) -> Column:
        asked = F.get(feature, node)
        return F.when(asked < 0, node).when(F.get(x, asked) <= F.get(threshold, node), F.get(left, node)).otherwise(F.get(right, node))

    return F.get(value, F.aggregate(F.sequence(F.lit(1), F.lit(max(1, _depth(tree, 0)))), F.lit(0), step))


def _depth(tree: list[tuple], at: int) -> int:
    feature, _, left, right, _ = tree[at]
    return 0 if feature < 0 else 1 + max(_depth(tree, left), _depth(tree, right))


def measured(taught: DataFrame, trees: list[list[tuple]], threshold: float = 0.5) -> dict[str, float]:
    """Of labelled findings (x, y): their number, the share of false ones removed and of secrets kept."""
    kept = forest_score(trees) >= threshold
    row = taught.agg(F.count("*").alias("findings"), F.count_if(F.col("y") == 0).alias("false"), F.count_if((F.col("y") == 0) & ~kept).alias("removed"), F.count_if((F.col("y") == 1) & kept).alias("kept")).first()
    return {"findings": row.findings, "false_removed": row.removed / max(1, row["false"]), "secrets_kept": row.kept / max(1, row.findings - row["false"])}


def taught_findings(docs: DataFrame, words: list[str], id_column: str = "doc_id", text_column: str = "text", found: DataFrame | None = None) -> DataFrame:
    """(x, y, judged) of the findings of about SAMPLE_DOCS documents; `judged` are those of every JUDGED-th document, for measured().

    `found` has the documents' candidates with their features, if they are there already.
    """
    every = max(1, docs.count() // SAMPLE_DOCS)
    found = with_features(find_candidates(docs, id_column, text_column), words) if found is None else found
    found = labelled_findings(found.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(every)) == 0))
    return found.select("x", "y", (F.coalesce(F.pmod(F.shiftright(F.xxhash64("doc_id"), 8), F.lit(JUDGED)), F.lit(1)) == 0).alias("judged"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, start, end, value, score, is_secret) of every candidate.

    `labelled` (value, before, after, y) has findings judged by hand; without it
    the fixed formats and assignments label the candidates themselves. Documents
    without candidates have no row; ids may be null; repeated rows repeat; other
    columns are dropped; an empty table gives an empty result.
    """
    session()
    words = dictionary(docs, text_column=text_column)
    found = settle(with_features(find_candidates(docs, id_column, text_column), words))
    taught = taught_findings(docs, words, id_column, text_column, found).where("not judged") if labelled is None else with_features(labelled, words)
    trees = fit(taught)
    scored = found.withColumn("score", forest_score(trees))
    return scored.select("doc_id", "start", "end", "value", "score", (F.col("score") >= threshold).alias("is_secret"))
