"""Labelled documents: all that may be learned from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.support import crc_rest

#: Labelled rows that a classifier is fitted on, at most.
SAMPLE_ROWS = 20_000


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(text, y) of at most `rows` labelled documents, none held out, ids and labels not null.

    Those with the smallest hashes of their ids, and of equal ids of their texts;
    rows with the same id, text and label count once, so an id or a row that is
    often repeated takes no more than its place. Two tables are broadcast: `rows` ids
    with a label, and `rows` ids with a text's hash and a label.
    """
    own = training_ids(labels, label)
    share = min(1.0, 1.1 * rows / max(1, own.count()))  # so that each task hands on its share of the sample only
    own = own.where(F.pmod(F.shiftright(F.xxhash64("doc_id"), 8), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1))
    picked = own.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(rows)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    kept = texts.select("doc_id", "_h").join(F.broadcast(picked), "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "_h", "y").limit(rows)
    return texts.join(F.broadcast(kept), ["doc_id", "_h"]).dropDuplicates(["doc_id", "_h", "y"]).select("text", "y")


def training_ids(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) of all labels that are 0 or 1 and not held out, each once."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & (crc_rest("doc_id", 5) != 0)).distinct()


def held_out(id_column: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text is divisible by 5; a null id is not held out."""
    return F.coalesce(crc_rest(id_column, 5) == 0, F.lit(False))
