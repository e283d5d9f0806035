"""The queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm import alignment, decontaminate, fill_middle, hmm, pii, quality, secret_scan, sentencepieces, simhash, toxicity, url_filter, warc, winnowing
from quillmill.llm.support import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_and_decode(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "copies")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digests(pii.find_spans(docs, pii.fit(docs)))


def op6_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(table(spark, sf_dir, "documents"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_comparison(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(fill_middle.transform(table(spark, sf_dir, "documents")))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_statistics(table(spark, sf_dir, "documents"))


#: Hosts, beginnings of paths and what is decided of them.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules).drop("root")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_toxicity, op2_sentencepiece, op3_simhash, op4_quality, op5_pii, op6_hmm, op7_winnowing, op8_warc, op9_secrets, op10_decontamination, op11_fill_middle, op12_alignment, op13_url_filter)}

SQL: dict[str, str] = {
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS kept FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
        FROM m""",
    "op11_fill_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        s AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                     CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
        f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                     CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM s),
        o AS (SELECT *, substr(text, 1, a) AS p, substr(text, a + 1, b - a) AS m, substr(text, b + 1) AS t FROM f)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || t || '<M>' || m ELSE '<S>' || t || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM o""",
    # Links with a whole address, canonical ones first, as the given pages would write them.
    "op13_url_filter": r"""
        WITH RECURSIVE r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        page AS (SELECT page_id, url, html, regexp_extract(coalesce(url, ''), '(?s)://(.*)$', 1) AS rest FROM pages),
        cut AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM page),
        own AS (SELECT page_id, url, html, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM cut),
        link AS (SELECT url AS a, unnest(regexp_extract_all(html, '<link rel="canonical" href="([^"]*://[^"]*)"', 1) || regexp_extract_all(html, '<meta http-equiv="refresh" content="[0-9]*; *url=([^"]*://[^"]*)"', 1)) AS b FROM own),
        edge AS (SELECT regexp_extract(a, '^[^#]*') AS a, regexp_extract(b, '^[^#]*') AS b FROM link),
        near(a, b) AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge UNION SELECT n.a, e.b FROM near n, (SELECT a, b FROM edge UNION SELECT b, a FROM edge) e WHERE n.b = e.a),
        ends AS (SELECT DISTINCT a AS node, translate(regexp_extract(a, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(a, '://[^/?#]*([^?#]*)', 1) AS path FROM near),
        judged AS (SELECT node, arg_max(v, length(h || p)) AS v FROM ends, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY node),
        bad AS (SELECT DISTINCT n.a AS node FROM near n JOIN judged j ON j.node = n.b WHERE j.v = 'block'),
        fits AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM own, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
        SELECT o.page_id, o.host, o.path, f.rule, coalesce(f.v, CASE WHEN regexp_extract(o.url, '^[^#]*') IN (SELECT node FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
        FROM own o LEFT JOIN fits f USING (page_id)""",
}
