"""Model calls as pluggable functions over Arrow batches, with deterministic defaults.

Calls go out once for each distinct input, and a call that fails gives a status
instead of stopping the run. The number of partitions bounds how many run at
once, and all tasks together keep a rate, retries included.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions.schemas import Items, Record, Value, violations
from quillmill.functions.text import reply_json
from quillmill.sources.pacing import no_wait, shared_slots, task_wait

Call = Callable[[str], str]


def keyword_scorer(terms: dict[str, str]) -> Call:
    """The default scorer: the share of named patterns that a text matches, as text."""

    def score(text: str) -> str:
        return f"{sum(bool(re.search(p, text, re.I)) for p in terms.values()) / max(1, len(terms)):.4f}"

    return score


def pattern_extractor(pattern: str, by: str = "|") -> Call:
    """The default extractor: distinct matches in order."""

    def extract(text: str) -> str:
        return by.join(dict.fromkeys(m.group() for m in re.finditer(pattern, text)))

    return extract


def patiently(call: Call, tries: int = 3, first_wait: float = 1.0, wait: Callable[[], float] = no_wait) -> Callable[[str], tuple[str | None, str]]:
    """(reply, "") or (None, error): each try waits for its turn, and retries twice as long as the one before."""

    def run(text: str) -> tuple[str | None, str]:
        error = ""
        for i in range(tries):
            try:
                wait()
                return call(text), ""
            except Exception as e:  # one record never stops the run
                error = f"{type(e).__name__}: {e}"
                if i + 1 < tries:
                    time.sleep(first_wait * 2**i)
        return None, error

    return run


def with_reply(df: DataFrame, column: str, call: Call, at_once: int | None = None, tries: int = 3, rate: float | None = None, first_wait: float = 1.0, out: str = "reply") -> DataFrame:
    """df with `out` and `out`_error for each text; every distinct text is sent once. Null texts have neither. A rate needs `at_once`."""
    asked = df.select(F.col(column).alias("_text")).where("_text is not null").distinct()
    if at_once:
        asked = asked.repartition(at_once)
    elif rate:
        raise ValueError("say how many tasks share the rate")
    slots = shared_slots(df.sparkSession, rate, at_once or 1)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = patiently(call, tries, first_wait, task_wait(slots))
        for batch in batches:
            got = [run(t) for t in batch["_text"]]
            yield pd.DataFrame({"_text": batch["_text"], out: [a for a, _ in got], f"{out}_error": [e for _, e in got]})

    replies = asked.mapInPandas(ask, f"_text string, {out} string, {out}_error string")
    # Keyed by digests: whole texts are not moved as keys.
    key = lambda c: F.sha2(F.col(c), 256)
    keyed = replies.select(key("_text").alias("_key"), out, f"{out}_error")
    return df.withColumn("_key", key(column)).join(keyed, "_key", "left").drop("_key")


def with_normal(df: DataFrame, column: str, call: Call | None, local: F.Column, out: str = "normal", **how) -> DataFrame:
    """df with `out`, the service's form of each value, and the local rules' where there is no service or it fails or gives nothing.

    Every distinct value is sent once; a null value has a null form. Nothing is
    sent where the session's spark.quillmill.skipRemote is true.
    """
    if call is None or df.sparkSession.conf.get("spark.quillmill.skipRemote", "false") == "true":
        return df.withColumn(out, F.when(F.col(column).isNotNull(), local))
    sent = with_reply(df, column, call, out="_normal", **how)
    good = F.when((F.col("_normal_error") == "") & (F.col("_normal") != ""), F.col("_normal"))
    return sent.withColumn(out, F.when(F.col(column).isNotNull(), F.coalesce(good, local))).drop("_normal", "_normal_error")


def healthy(probe: Callable[[], bool], tries: int = 3, wait: float = 1.0) -> bool:
    """Whether a service answers, asked by the driver before a run."""
    for i in range(tries):
        try:
            if probe():
                return True
        except Exception:
            pass
        if i + 1 < tries:
            time.sleep(wait)
    return False


@dataclass(frozen=True)
class Extraction:
    """How an extractor is asked and what it is to return: extractors differ in this alone."""

    call: Call
    declared: Record
    array: str = "findings"
    schema: str = ""
    tries: int = 3
    at_once: int = 4
    rate: float | None = None
    first_wait: float = 1.0


def extracted(df: DataFrame, column: str, how: Extraction) -> DataFrame:
    """df with `findings`, `status` and `problems`.

    status: done, failed (no reply after all tries; problems has the error),
    invalid (a reply that does not keep to the record; problems says where) or
    skipped (a null text). findings are those of a reply that is done, else null.
    """
    sent = with_reply(df, column, how.call, at_once=how.at_once, tries=how.tries, rate=how.rate, first_wait=how.first_wait, out="_said")
    wrong = violations(reply_json("_said"), how.declared)
    status = F.when(F.col(column).isNull(), "skipped").when(F.col("_said").isNull(), "failed").when(F.size(wrong) > 0, "invalid").otherwise("done")
    problems = F.when(F.col("status") == "failed", F.col("_said_error")).when(F.col("status") == "invalid", F.array_join(wrong, "; ")).otherwise("")
    findings = F.from_json(reply_json("_said"), f"struct<{how.array}:{how.schema or FINDINGS}>")[how.array]
    return sent.withColumn("status", status).withColumns({"problems": problems, "findings": F.when(F.col("status") == "done", findings)}).drop("_said", "_said_error")


#: The record that an extractor is to return; at most ten findings, class H or N.
FINDING = "struct<gene:string,disease:string,omim:string,hgvs_coding:string,hgvs_protein:string,gof_effect:string,class:string,is_human:string,note:string,evidence_text:string>"
FINDINGS = f"array<{FINDING}>"


def findings_valid(findings: str = "findings", most: int = 10) -> F.Column:
    """Whether an extraction keeps to the declared record: at most ten findings, classes H or N."""
    return (F.size(findings) <= most) & F.forall(findings, lambda f: F.upper(F.coalesce(f["class"], F.lit("N"))).isin("H", "N"))


def lacks_core_field(findings: str = "findings") -> F.Column:
    """Whether any finding has neither a coding nor a protein variant, or no gene."""
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    return F.exists(findings, lambda f: empty(f["gene"]) | (empty(f["hgvs_coding"]) & empty(f["hgvs_protein"])))

_TEXT, _OPTIONAL = Value(), Value(null=True)
#: The declared reply: every field there, class H or N, at most ten findings, nothing else.
REPLY = Record({"findings": Items(Record({"gene": _TEXT, "disease": _TEXT, "omim": _OPTIONAL, "hgvs_coding": _OPTIONAL, "hgvs_protein": _OPTIONAL, "gof_effect": _TEXT, "class": Value(one_of=("H", "N")), "is_human": Value("boolean"), "note": _OPTIONAL, "evidence_text": _TEXT}), most=10)})


def extractor(call: Call, **how) -> Extraction:
    """The extractor of all variants: the declared reply, three tries."""
    return Extraction(call, REPLY, **how)


def stop_loss_extractor(call: Call, **how) -> Extraction:
    """The extractor of variants that lose a stop: an object with a list of findings, whose fields may be lacking; one try."""
    open_record = Record({"findings": Items(Record({"class": Value(null=True)}, required=(), closed=False))}, closed=False)
    return Extraction(call, open_record, **{"tries": 1} | how)
