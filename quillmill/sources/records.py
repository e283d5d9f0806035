"""Article records in bulk XML: typed rows, and what cannot be read beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions.text import as_text
from quillmill.sources.services import flat_record

TAG = "PubmedArticle"
_DATE = "PubDate: struct<Year: string, MedlineDate: string>"
_ARTICLE = f"Article: struct<ArticleTitle: string, Abstract: struct<AbstractText: array<string>>, Journal: struct<JournalIssue: struct<{_DATE}>>>"
_CITATION = f"MedlineCitation struct<PMID: string, {_ARTICLE}, MeshHeadingList: struct<MeshHeading: array<struct<DescriptorName: string>>>>"
_IDS = "PubmedData struct<ArticleIdList: struct<ArticleId: array<struct<_VALUE: string, _IdType: string>>>>"
SCHEMA = f"{_CITATION}, {_IDS}, _bad string"


def record_texts(spark: SparkSession, path: str, tag: str = TAG) -> tuple[DataFrame, DataFrame]:
    """(xml) of whole records and (xml) of beginnings that have no end.

    Files are parted at the end tag, so a large file is read by many tasks; what
    stands before a record's own begin tag is no part of it.
    """
    parts = spark.read.option("lineSep", f"</{tag}>").text(path).select(F.split("value", rf"(?=<{tag}[\s>])").alias("p"))
    begun = parts.select(F.filter("p", lambda x: x.rlike(rf"^<{tag}[\s>]")).alias("p")).where(F.size("p") > 0)
    whole = begun.select(F.concat(F.try_element_at("p", F.lit(-1)), F.lit(f"</{tag}>")).alias("xml"))
    return whole, begun.select(F.explode(F.slice("p", 1, F.greatest(F.size("p") - 1, F.lit(0)))).alias("xml"))


def article_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects): (pmid, doi, year, title, abstract, mesh), and (xml, reason) of records that are no XML, have no end, no id or no article.

    The year is the first four characters of the year, or of the free date
    without one; parts of an abstract are joined by a space; the first DOI
    counts; tags inside titles and abstracts stay.
    """
    whole, broken = record_texts(spark, path)
    read = whole.select("xml", F.from_xml("xml", SCHEMA, {"rowTag": TAG, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    head = F.col("r.MedlineCitation")
    reason = F.when(F.col("r").isNull() | F.col("r._bad").isNotNull(), "not well-formed").when(as_text(head["PMID"]) == "", "no id").when(head["Article"].isNull(), "no article")
    marked = read.withColumn("reason", reason)
    article, date = head["Article"], head["Article"]["Journal"]["JournalIssue"]["PubDate"]
    nothing = F.array().cast("array<string>")
    nested = marked.where("reason is null").select(
        head["PMID"].alias("pmid"),
        F.transform(F.col("r.PubmedData.ArticleIdList.ArticleId"), lambda x: F.struct(x["_IdType"].alias("type"), x["_VALUE"].alias("value"))).alias("article_ids"),
        F.coalesce(date["Year"], date["MedlineDate"]).alias("date"),
        article["ArticleTitle"].alias("title"),
        F.coalesce(article["Abstract"]["AbstractText"], nothing).alias("abstract_parts"),
        F.coalesce(F.transform(head["MeshHeadingList"]["MeshHeading"], lambda m: F.struct(m["DescriptorName"].alias("name"))), F.array().cast("array<struct<name:string>>")).alias("subjects"),
    )
    rejects = marked.where("reason is not null").select("xml", "reason").union(broken.select("xml", F.lit("no end").alias("reason")))
    return flat_record(nested), rejects
