"""A cleaning pipeline over documents: each stage is one operator, written and read again between."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import decontaminate, near_text, pii, quality, sentencepieces
from quillmill.llm.support import remove, shared_folder, table

#: A document stays if its quality score is at least this.
LEAST_QUALITY = 0.3


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; labels come from the labels table.

    A null or empty text is scored like any other; rows with a null or repeated
    id are judged each; equal texts have one fate; an empty table stays empty.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = "quality_score"
    while score in docs.columns:
        score += "_"
    return quality.with_scores(docs, model, score_column=score).where(F.col(score) >= LEAST_QUALITY).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a similarity of 0.8 or more.

    The one with the smallest id stays, and one row of it; texts without words
    are alike; rows with a null id belong to no group and stay; an empty table
    stays empty.
    """
    return near_text.drop_near_duplicates(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts stay; ids are not looked at; equal texts have one fate;
    an empty table stays empty.
    """
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text.

    Null texts stay null; every row stays, repeated ones too; an empty table
    stays empty.
    """
    out = pii.redact(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_chars, decoded_sha256): SentencePiece ids and what they decode to.

    Null texts are empty; ids may be null; repeated rows repeat; an empty table
    gives an empty result.
    """
    return sentencepieces.encode_and_decode(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("pii", redact_pii),
    ("sentencepiece", encode_pieces),
]

#: SQL can express none of the fitted stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's table is removed when the next one is written, the last one when the driver ends."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    atexit.register(remove, spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
