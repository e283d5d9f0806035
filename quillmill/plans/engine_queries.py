"""Queries of what the engine does beside single operators: rates, records, schemas, state, vocabularies, numbering, rules over tables; with their SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions import detectors as D
from quillmill.functions import models, text
from quillmill.functions.schemas import Items, Record, Value, violations
from quillmill.functions.vocabulary import term_hits
from quillmill.operators import curation as C
from quillmill.operators import rows as R
from quillmill.plans.io_queries import sql, stacked
from quillmill.plans.queries import t
from quillmill.sources import readers, records, services, sinks, workbook
from quillmill.sources.files import scratch


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


# ---- numbering and running totals over all rows -------------------------------------------------


@sql("""
    WITH n AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS n FROM lineitem)
    SELECT CAST(n // 1000 AS BIGINT) AS batch, count(*) AS n, CAST(min(l_orderkey) AS BIGINT) AS first, CAST(max(l_orderkey) AS BIGINT) AS last FROM n GROUP BY 1""")
def q_global_batches(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    made = R.in_batches(rows, ["l_orderkey", "l_linenumber"], 1000)
    return made.groupBy("batch").agg(F.count("*").alias("n"), F.min("l_orderkey").cast("long").alias("first"), F.max("l_orderkey").cast("long").alias("last"))


@sql("""
    WITH g AS (SELECT l_orderkey, l_linenumber, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS v FROM lineitem GROUP BY ALL),
    s AS (SELECT l_orderkey, l_linenumber, sum(v) OVER (ORDER BY l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS total FROM g)
    SELECT CAST(l_linenumber AS BIGINT) AS line, count(*) AS n, CAST(max(total) AS BIGINT) AS most, CAST(sum(total % 9973) AS BIGINT) AS rest FROM s GROUP BY 1""")
def q_global_running(spark, d):
    rows = t(spark, d, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").cast("long").alias("line")).agg(F.sum(F.col("l_quantity").cast("long")).alias("v"))
    made = R.running_total(rows, "v", ["l_orderkey", "line"], [], "total")
    return made.groupBy("line").agg(F.count("*").alias("n"), F.max("total").alias("most"), F.sum(F.col("total") % 9973).alias("rest"))


@sql("""
    WITH h AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN event_type ELSE 'hot' END AS k, props FROM events)
    SELECT 'first' AS part, k, min(event_id) AS id, CAST(1 AS BIGINT) AS n FROM h GROUP BY k UNION ALL SELECT 'last', k, max(event_id), 1 FROM h GROUP BY k UNION ALL SELECT 'losers', k, NULL, count(*) - 1 FROM h GROUP BY k""")
def q_hot_key(spark, d):
    """One key has nine tenths of the rows."""
    rows = t(spark, d, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, F.col("event_type")).otherwise("hot").alias("k"), "props")
    one = lambda df, part: df.select(F.lit(part).alias("part"), "k", F.col("event_id").alias("id"), F.lit(1).cast("long").alias("n"))
    lost = R.losers(rows, ["k"], ["event_id"]).groupBy("k").agg(F.count("*").alias("n")).select(F.lit("losers").alias("part"), "k", F.lit(None).cast("long").alias("id"), "n")
    return stacked(one(R.keep_first(rows, ["k"], ["event_id"]), "first"), one(R.keep_last(rows, ["k"], ["event_id"]), "last"), lost)


# ---- services -----------------------------------------------------------------------------------


def _sometimes(keys):
    if keys[0] == "13":
        raise OSError("no answer")
    return {k: k for k in keys}


@sql("SELECT CAST(tasks AS BIGINT) AS tasks, count(*) + 2 * count(*) FILTER (WHERE n_nationkey = 13) AS calls, CAST(0 AS BIGINT) AS over FROM nation, (VALUES (1), (3), (8)) t(tasks) GROUP BY tasks")
def q_rate(spark, d):
    """The calls of all tasks, retries included, and how many tenths of a second had more than the rate's."""
    rate, width = 100.0, 10
    ids = t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"))
    parts = []
    for tasks in (1, 3, 8):
        called = services.fetched(ids, _sometimes, size=1, at_once=tasks, rate=rate, first_wait=0.0).select(F.explode("called").alias("at"))
        every = called.agg(F.sort_array(F.collect_list("at")).alias("at"))  # of 27 calls
        early = F.filter(F.sequence(F.lit(0), F.size("at") - 1 - width), lambda i: F.get("at", i + width) - F.get("at", i) < F.lit(width / rate - 1e-4))
        parts.append(every.select(F.lit(tasks).cast("long").alias("tasks"), F.size("at").cast("long").alias("calls"), F.size(early).cast("long").alias("over")))
    return stacked(*parts)


_ASKED = [["license", "password"], ["token"]]


@sql("""
    WITH f AS (SELECT doc_id, 1995 + doc_id % 31 AS year FROM documents WHERE lang = 'en' AND (contains(lower(text), 'license') OR contains(lower(text), 'password') OR contains(lower(text), 'token'))),
    n AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY length(CAST(doc_id AS VARCHAR)), CAST(doc_id AS VARCHAR)) - 1 AS place, count(*) OVER (PARTITION BY year) AS total FROM f),
    k AS (SELECT * FROM n WHERE place < 4)
    SELECT 'found' AS part, CAST(year AS BIGINT) AS year, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM k GROUP BY year UNION ALL SELECT 'capped', year, count(*), CAST(sum(doc_id) AS BIGINT) FROM k WHERE total > 4 GROUP BY year
    UNION ALL SELECT 'two years', year, count(*), CAST(sum(doc_id) AS BIGINT) FROM k WHERE year BETWEEN 2003 AND 2004 GROUP BY year UNION ALL SELECT 'resumed', year, count(*), CAST(sum(doc_id) AS BIGINT) FROM k WHERE place >= 2 GROUP BY year
    UNION ALL SELECT 'probe', NULL, count(*), NULL FROM f WHERE year BETWEEN 1995 AND 2025
    UNION ALL SELECT '(("license"[Title/Abstract] OR "password"[Title/Abstract]) OR ("token"[Title/Abstract])) AND en[Language] AND 1995:2025[dp]', NULL, count(*), NULL FROM f""")
def q_search(spark, d):
    """A search over documents: evaluated as a condition, served with a cap, read by year and page with filters pushed down."""
    docs = t(spark, d, "documents").withColumn("year", (1995 + F.col("doc_id") % 31).cast("int"))
    wanted = docs.where(text.search_condition(_ASKED, "en", 1995, 2025, F.col("text"), F.col("lang"), F.col("year")))
    serve = services.table_search(wanted.select("year", F.col("doc_id").cast("string").alias("id")), cap=4)

    def within(query, year, at, size):
        if "two" in query and not 2003 <= year <= 2004 or "rest" in query and size and at < 2:
            raise OSError("asked for what a filter excludes")
        return serve(query, year, at, size)

    source = services.search_source(within, 1995, 2025, cap=4, page=3)
    by = lambda df, part: df.groupBy(F.col("year").cast("long").alias("year")).agg(F.count("*").alias("n"), F.sum(F.col("id").cast("long")).alias("ids")).select(F.lit(part).alias("part"), "year", "n", "ids")
    every = services.searched(spark, source, "all")
    two = services.searched(spark, source, "two").where("year >= 2003 and year < 2005")
    rest = services.searched(spark, source, "rest").where("place >= 2")
    asked = text.search_query([["license", "password"], ["token"]], "en", 1995, 2025)
    counted = wanted.agg(F.count("*").alias("n"))
    plain = lambda n, part: n.select(F.lit(part).alias("part"), F.lit(None).cast("long").alias("year"), "n", F.lit(None).cast("long").alias("ids"))
    probe = spark.range(1).select(F.lit(services.search_count(serve, "all", 1995, 2025)).cast("long").alias("n"))
    return stacked(by(every, "found"), by(every.where("capped"), "capped"), by(two, "two years"), by(rest, "resumed"), plain(probe, "probe"), plain(counted, asked))


# ---- records and schemas ------------------------------------------------------------------------


def _escaped(c):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


@sql(r"""
    WITH x AS (SELECT item_id AS i, trim(regexp_replace(text, '[ \t\n\f\r\v]+', ' ', 'g')) AS s FROM benchmark),
    k AS (SELECT * FROM x WHERE i % 17 <> 0 AND i % 19 <> 0 AND i % 23 <> 0)
    SELECT CAST(i AS VARCHAR) AS pmid, CASE WHEN i % 2 = 0 THEN '10.1/' || i ELSE '' END AS doi, CASE WHEN i % 3 < 2 THEN CAST(1980 + i % 40 AS VARCHAR) ELSE '' END AS year, 'About <' || i || '> & more' AS title,
           CASE WHEN i % 5 = 0 THEN '' ELSE s || ' Part two of ' || i END AS abstract, CASE WHEN i % 4 = 0 THEN '' ELSE 'Humans|Topic ' || i % 7 END AS mesh FROM k
    UNION ALL SELECT 'not well-formed', '', '', '', CAST(count(*) AS VARCHAR), '' FROM x WHERE i % 17 = 0 UNION ALL SELECT 'no id', '', '', '', CAST(count(*) AS VARCHAR), '' FROM x WHERE i % 19 = 0 AND i % 17 <> 0
    UNION ALL SELECT 'no end', '', '', '', CAST(count(*) AS VARCHAR), '' FROM x WHERE i % 23 = 0 AND i % 17 <> 0 AND i % 19 <> 0""")
def q_article_records(spark, d):
    """Items as bulk XML of articles, some broken, read back as typed records and rejects."""
    root, i = scratch(spark), F.col("item_id")
    key, body = i.cast("string"), _escaped(F.trim(F.regexp_replace("text", r"[ \t\n\f\r\v]+", " ")))
    lit = F.lit
    date = F.when(i % 3 == 0, F.concat(lit("<Year>"), (1980 + i % 40).cast("string"), lit("</Year><Month>Jan</Month>"))).when(i % 3 == 1, F.concat(lit("<MedlineDate>"), (1980 + i % 40).cast("string"), lit(" Jan-Feb</MedlineDate>"))).otherwise("")
    abstract = F.when(i % 5 == 0, "").otherwise(F.concat(lit('<Abstract><AbstractText Label="BACKGROUND">'), body, lit("</AbstractText><AbstractText>Part two of "), key, lit("</AbstractText></Abstract>")))
    mesh = F.when(i % 4 == 0, "").otherwise(F.concat(lit('<MeshHeadingList><MeshHeading><DescriptorName UI="D1">Humans</DescriptorName></MeshHeading><MeshHeading><DescriptorName>Topic '), (i % 7).cast("string"), lit("</DescriptorName></MeshHeading></MeshHeadingList>")))
    doi = F.when(i % 2 == 0, F.concat(lit('<ArticleId IdType="doi">10.1/'), key, lit("</ArticleId>"))).otherwise("")
    broken = F.when(i % 17 == 0, "<Open>").otherwise("")
    pmid = F.when((i % 19 == 0) & (i % 17 != 0), "").otherwise(F.concat(lit('<PMID Version="1">'), key, lit("</PMID>")))
    head = [lit('<PubmedArticle>\n<MedlineCitation Status="MEDLINE">'), pmid, broken, lit("<Article><Journal><JournalIssue><PubDate>"), date, lit("</PubDate></JournalIssue></Journal><ArticleTitle>About &lt;"), key, lit("&gt; &amp; more</ArticleTitle>"), abstract, lit("</Article>")]
    tail = [mesh, lit('</MedlineCitation><PubmedData><ArticleIdList><ArticleId IdType="pubmed">'), key, lit("</ArticleId>"), doi, lit("</ArticleIdList></PubmedData></PubmedArticle>")]
    cut = (i % 23 == 0) & (i % 17 != 0) & (i % 19 != 0)
    # A record that is cut off is followed by one that is whole; it may also be the last of its file.
    follower = lit('<PubmedArticle><MedlineCitation><PMID/></MedlineCitation></PubmedArticle>')
    whole = F.when(cut, F.concat(*head, follower)).otherwise(F.concat(*head, *tail))
    t(spark, d, "benchmark").select(whole.alias("value")).repartition(3).write.text(root)
    good, bad = records.article_records(spark, root)
    reasons = bad.where("not xml like '%<PMID/>%'").groupBy("reason").agg(F.count("*").cast("string").alias("n"))
    return stacked(good.withColumn("mesh", F.array_join("mesh", "|")), reasons.select(F.col("reason").alias("pmid"), *[lit("").alias(c) for c in ("doi", "year", "title")], F.col("n").alias("abstract"), lit("").alias("mesh")))


_FINDING = Record({"gene": Value(), "class": Value(one_of=("H", "N")), "is_human": Value("boolean"), "omim": Value(null=True)})
_REPLY = Record({"findings": Items(_FINDING, most=3)})


@sql("""
    WITH p AS (SELECT p_partkey AS k, p_partkey % 11 AS f, p_partkey % 6 AS n FROM part)
    SELECT CAST(k AS BIGINT) AS k, CASE WHEN f = 0 THEN '$: not JSON' WHEN f = 1 THEN '$: not an object' WHEN f = 2 THEN '$.findings: missing' WHEN f = 3 THEN '$.findings: not an array' ELSE array_to_string(list_sort(list_filter([
        CASE WHEN n > 3 THEN '$.findings: too many' END, CASE WHEN f = 4 AND n > 0 THEN '$.findings[].gene: missing' END, CASE WHEN f = 5 AND n > 0 THEN '$.findings[].class: not allowed' END,
        CASE WHEN f = 6 AND n > 0 THEN '$.findings[].is_human: not boolean' END, CASE WHEN f = 7 AND n > 0 THEN '$.findings[]: not declared' END, CASE WHEN f = 8 THEN '$: not declared' END,
        CASE WHEN f = 9 AND n > 0 THEN '$.findings[].gene: not string' END], lambda x: x IS NOT NULL)), '; ') END AS problems FROM p""")
def q_schema_rules(spark, d):
    """Replies made of parts with one fault each, against a declared record."""
    f, n = F.col("p_partkey") % 11, (F.col("p_partkey") % 6).cast("int")
    lit = F.lit
    gene = F.when(f == 4, "").when(f == 9, '"gene": null, ').otherwise(F.concat(lit('"gene": "'), F.col("p_brand"), lit('", ')))
    kind = F.when(f == 5, "Q").otherwise("H")
    human = F.when(f == 6, '"yes"').otherwise("true")
    one = F.concat(lit("{"), gene, lit('"class": "'), kind, lit('", "is_human": '), human, F.when(f == 7, ', "more": 1').otherwise(""), lit(', "omim": null}'))
    many = F.array_join(F.array_repeat(one, n), ", ")
    reply = F.when(f == 0, '{"findings": [').when(f == 1, "[]").when(f == 2, "{}").when(f == 3, '{"findings": "none"}').otherwise(F.concat(lit('{"findings": ['), many, lit("]"), F.when(f == 8, ', "extra": 0').otherwise(""), lit("}")))
    rows = t(spark, d, "part").select(F.col("p_partkey").cast("long").alias("k"), reply.alias("reply"))
    return rows.select("k", F.array_join(violations("reply", _REPLY), "; ").alias("problems"))


def _extracting(prompt: str) -> str:
    k = int(prompt.split()[-1])
    if k % 10 == 3:
        raise OSError("no answer")
    finding = {"gene": f"G{k}", "disease": "x", "omim": None, "hgvs_coding": None, "hgvs_protein": f"p.R{k}*", "gof_effect": "x", "class": "H", "is_human": True, "note": None, "evidence_text": "x"}
    if k % 10 == 4:
        del finding["note"]
    return "```json\n" + json.dumps({"findings": [finding] * (k % 3)}) + "\n```"


@sql("""
    WITH v AS (SELECT p_partkey AS k, p_partkey % 100 AS m FROM part)
    SELECT how, CASE WHEN m % 10 = 3 THEN 'failed' WHEN how = 'all' AND m % 10 = 4 AND m % 3 > 0 THEN 'invalid' ELSE 'done' END AS status, count(*) AS n,
           CAST(sum(CASE WHEN m % 10 = 3 OR (how = 'all' AND m % 10 = 4 AND m % 3 > 0) THEN 0 ELSE m % 3 END) AS BIGINT) AS findings FROM v, (VALUES ('all'), ('stop loss')) h(how) GROUP BY 1, 2""")
def q_extractors(spark, d):
    """The same replies by two configurations of the extractor: one holds them to the declared record, the other to a list of findings."""
    rows = t(spark, d, "part").select(F.concat(F.lit("text of "), (F.col("p_partkey") % 100).cast("string")).alias("prompt"))
    parts = []
    for name, how in (("all", models.extractor(_extracting, first_wait=0.0)), ("stop loss", models.stop_loss_extractor(_extracting, first_wait=0.0))):
        got = models.extracted(rows, "prompt", how)
        parts.append(got.groupBy("status").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.size("findings"), F.lit(0)).cast("long")).alias("findings")).withColumn("how", F.lit(name)))
    return stacked(*parts)


# ---- counters, state, sinks ---------------------------------------------------------------------


@sql("""
    SELECT 'read' AS part, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents UNION ALL SELECT 'bad', (SELECT count(*) FROM nation), NULL
    UNION ALL SELECT 'counted read', count(*), NULL FROM documents UNION ALL SELECT 'counted bad', (SELECT count(*) FROM nation), NULL
    UNION ALL SELECT 'streamed read', count(*), NULL FROM documents UNION ALL SELECT 'streamed bad', (SELECT count(*) FROM nation), NULL UNION ALL SELECT 'streamed again', 0, NULL""")
def q_observed(spark, d):
    """Records and bad lines counted by the job that writes them, for a folder and for a stream."""
    root, schema = scratch(spark), "doc_id long, lang string, n_chars long"
    bad = t(spark, d, "nation").select(F.concat(F.lit('{"doc_id": '), "n_name").alias("value"))
    t(spark, d, "documents").select("doc_id", "lang", "n_chars").select(F.to_json(F.struct("*")).alias("value")).union(bad).repartition(3).write.text(f"{root}/in")
    seen = readers.copy_counted(spark, f"{root}/in", schema, f"{root}/out")
    streams = [readers.stream_counted(spark, f"{root}/in", schema, f"{root}/stream", f"{root}/state", 2) for _ in range(2)]
    written = spark.read.parquet(f"{root}/out").groupBy(F.col("status").alias("part")).agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))
    one = lambda part, n: spark.range(1).select(F.lit(part).alias("part"), F.lit(n).cast("long").alias("n"), F.lit(None).cast("long").alias("ids"))
    sums = streams[0].agg(F.sum("read").alias("read"), F.sum("bad").alias("bad"))
    streamed = sums.select(F.explode(F.array(F.struct(F.lit("streamed read").alias("part"), F.col("read").alias("n")), F.struct(F.lit("streamed bad").alias("part"), F.col("bad").alias("n")))).alias("x")).select("x.part", "x.n", F.lit(None).cast("long").alias("ids"))
    return stacked(written, one("counted read", seen["read"]), one("counted bad", seen["bad"]), streamed, streams[1].agg(F.count("*").alias("n")).select(F.lit("streamed again").alias("part"), "n", F.lit(None).cast("long").alias("ids")))


@sql("""
    WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 7 = 0 THEN 'failed' WHEN s_suppkey % 5 = 0 THEN 'done' WHEN s_suppkey % 2 = 0 THEN 'absent' ELSE 'done' END AS status FROM supplier)
    SELECT part, status, count(*) AS n, CAST(sum(k) AS BIGINT) AS ids FROM s, (VALUES ('before'), ('compacted'), ('an older reader')) p(part) GROUP BY 1, 2 UNION ALL SELECT 'todo', 'failed', count(*), CAST(sum(k) AS BIGINT) FROM s WHERE status = 'failed'""")
def q_state_log(spark, d):
    """Statuses that change twice, folded by reading and by compaction; a reader from before the compaction goes on."""
    root, key = scratch(spark), F.col("s_suppkey")
    keys = t(spark, d, "supplier").select(key.cast("string").alias("key"), "s_suppkey")
    for part, status in ((keys, F.when(key % 2 == 0, "absent").otherwise("done")), (keys.where(key % 5 == 0), F.lit("failed")), (keys.where((key % 5 == 0) | (key % 7 == 0)), F.when(key % 7 == 0, "failed").otherwise("done"))):
        sinks.record_progress(spark, part.withColumn("status", status), root)
    log = sinks.StateLog(spark, root)
    by = lambda df, part: df.groupBy(F.lit(part).alias("part"), "status").agg(F.count("*").alias("n"), F.sum(F.col("key").cast("long")).alias("ids"))
    old = log.current()
    before = by(R.kept(old), "before")
    log.compact()
    todo = sinks.still_to_do(spark, keys.select("key"), root).select("key", F.lit("failed").alias("status"))
    return stacked(before, by(log.current(), "compacted"), by(old, "an older reader"), by(todo, "todo"))


@sql("SELECT CAST(n_nationkey AS BIGINT) AS place, CASE n_regionkey WHEN 1 THEN 'FFFFC7CE' WHEN 3 THEN 'FFC6EFCE' END AS fill, true AS bold, true AS frozen FROM nation")
def q_workbook_styles(spark, d):
    path = scratch(spark) + "/report.xlsx"
    workbook.write_workbook(spark, {"nations": t(spark, d, "nation").orderBy("n_nationkey").select("n_nationkey", "n_regionkey")}, path, fills={"1": "FFFFC7CE", "3": "FFC6EFCE"}, fill_by="n_regionkey")
    return workbook.row_fills(spark, path, "nations").withColumnRenamed("_ord", "place")


@sql("SELECT 'file ' || s_suppkey AS stem, CAST(s_suppkey AS BIGINT) AS key, s_name AS name FROM supplier UNION ALL SELECT 'written', count(*), NULL FROM supplier UNION ALL SELECT 'skipped', count(*), NULL FROM supplier UNION ALL SELECT 'left by a broken run', 0, NULL")
def q_exported_files(spark, d):
    """A file for each row, moved into place when all are whole: a second run skips them, one that breaks off leaves none."""
    root = scratch(spark)
    rows = t(spark, d, "supplier").select(F.concat(F.lit("file "), F.col("s_suppkey").cast("string")).alias("stem"), F.col("s_suppkey").cast("long").alias("key"), F.col("s_name").alias("name"))
    written, skipped = sinks.export_documents(rows, "stem", f"{root}/a")[0], sinks.export_documents(rows, "stem", f"{root}/a")[1]
    try:
        sinks.export_documents(rows.withColumn("name", F.when(F.col("key") > 5, F.raise_error(F.lit("stopped"))).otherwise(F.col("name"))), "stem", f"{root}/b")
    except Exception as e:
        if "stopped" not in str(e):
            raise
    left = len([n for n in sinks.Files(spark).names(f"{root}/b")])
    one = lambda part, n: spark.range(1).select(F.lit(part).alias("stem"), F.lit(n).cast("long").alias("key"), F.lit(None).cast("string").alias("name"))
    back = readers.json_folder(spark, f"{root}/a", "key long, name string").select("stem", "key", "name")
    return stacked(back, one("written", written), one("skipped", skipped), one("left by a broken run", left))


# ---- vocabularies and rules ---------------------------------------------------------------------


@sql("""
    WITH t AS (SELECT DISTINCT regexp_extract(text, '[a-z]{5,}') AS term FROM documents), v AS (SELECT term FROM t WHERE term <> ''),
    w AS (SELECT item_id, unnest(string_split_regex(coalesce(text, ''), '[^A-Za-z0-9_]+')) AS word FROM benchmark)
    SELECT item_id, count(DISTINCT word) AS terms, count(*) AS hits FROM w JOIN v ON v.term = w.word GROUP BY item_id""")
def q_vocabulary(spark, d):
    """The first long word of every document as a vocabulary, found in the benchmark in one pass."""
    terms = t(spark, d, "documents").select(F.regexp_extract("text", "[a-z]{5,}", 0).alias("term"))
    hits = term_hits(t(spark, d, "benchmark"), terms, "item_id")
    return hits.groupBy("item_id").agg(F.count("*").alias("terms"), F.sum("n").alias("hits"))


_PHRASES = ("seen in Zea mays", "the dCREB2 fly", "mutant loricrin", "no gain-of-function, but toxic gain", "No GOF effect", "a hypermorph", "loss of function", "loss of function, dominant negative", "a locked closed conformation", "slightly diminish the VRAC activity", "a locked closed state", "nothing to see", "it lacks any real gain-of-function")
_GENES = ("LOXL2", "OPA1", "EMD", "TBX6", "KCNJ1", "KAT6A", "ALAS2", "CLCN2", "BRCA1")
_IDS = ("1", "14961560", "10532965", " ")


def _pick(values, number):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _list(values) -> str:
    return "[" + ", ".join(map(quoted, values)) + "]"


def _matches(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {quoted(pattern)}, 'i')"


@sql(f"""
    WITH r AS (SELECT doc_id, {_list(_GENES)}[1 + doc_id % {len(_GENES)}] AS g, {_list(_IDS)}[1 + doc_id // 9 % {len(_IDS)}] AS p, {_list(_PHRASES)}[1 + doc_id // 2 % {len(_PHRASES)}] || ' of ' || source AS s,
               CASE WHEN doc_id % 4 = 0 THEN 'NOT_GOF' ELSE '' END AS strict, CASE WHEN doc_id % 3 = 0 THEN 'c.1670_1671TC>GA' ELSE '' END AS coding FROM documents),
    m AS (SELECT *, {_matches('s', D.NON_HUMAN)} AS other, {_matches('s', D.MISMATCH)} AS mismatch, {_matches('s', D.NEGATED_CLAIM)} AS negated, {_matches('s', D.CLAIM)} AS claim, {_matches('s', D.LOSS)} AS loss,
          {_matches(f"regexp_replace(s, {quoted(D.NEGATED_CLAIM)}, ' ', 'gi')", D.CLAIM)} AS still FROM r),
    a AS (SELECT doc_id, CASE WHEN other THEN 'EXCLUDE_NONHUMAN_EVIDENCE' WHEN g = 'LOXL2' AND mismatch THEN 'EXCLUDE_GENE_EVIDENCE_MISMATCH' WHEN g = 'OPA1' AND p = '14961560' THEN 'REVIEW_POSSIBLE_LOF_HAPLOINSUFFICIENCY'
        WHEN negated AND still THEN 'REVIEW_MECHANISM' WHEN negated THEN 'EXCLUDE_NO_GOF_EVIDENCE' WHEN g = 'EMD' AND claim THEN 'REVIEW_MECHANISM' WHEN g = 'EMD' THEN 'EXCLUDE_NON_GOF_LOF'
        WHEN g IN ('TBX6', 'CLCN2') AND loss AND NOT claim THEN 'EXCLUDE_NON_GOF_LOF' WHEN g = 'KCNJ1' AND p = '10532965' AND NOT claim THEN 'EXCLUDE_NON_GOF_LOF' WHEN g = 'KCNJ1' AND strict = 'NOT_GOF' THEN 'EXCLUDE_NON_GOF_LOF'
        WHEN trim(p) = '' AND g = 'KAT6A' THEN 'REVIEW_PMID_MISSING_POSSIBLE_GOF' WHEN trim(p) = '' AND g = 'ALAS2' AND contains(coding, '1670_1671') THEN 'REVIEW_PMID_MISSING_POSSIBLE_GOF' ELSE 'KEEP' END AS action FROM m)
    SELECT doc_id, action, CASE WHEN action = 'KEEP' THEN 'YES' WHEN starts_with(action, 'EXCLUDE') THEN 'NO' ELSE 'REVIEW' END AS final FROM a""")
def q_real_cascade(spark, d):
    """The first round's rules over rows made of documents: genes, ids and phrases by the document's number."""
    n = F.col("doc_id")
    rows = t(spark, d, "documents").select(
        "doc_id", _pick(_GENES, n).alias("gene"), _pick(_IDS, F.floor(n / 9)).alias("pmid"), F.concat(_pick(_PHRASES, F.floor(n / 2)), F.lit(" of "), "source").alias("evidence_text"),
        F.when(n % 4 == 0, "NOT_GOF").otherwise("").alias("strict_gof_status"), F.when(n % 3 == 0, "c.1670_1671TC>GA").otherwise("").alias("hgvs_coding"),
    )
    return C.with_qc(rows).select("doc_id", F.col("qc_round1_action").alias("action"), F.col("include_in_final_dataset_round1").alias("final"))


_SNIPPETS = ("purchased from a shop", "a.b@lab.edu", "p.R5* activates", "Department of internal medicine", "", "TaqMan probe", "the University of X")


@sql(f"""
    WITH r AS (SELECT doc_id, ['True', 'false', 'TRUE', ''][1 + doc_id % 4] AS found, {_list(_SNIPPETS)}[1 + doc_id // 4 % {len(_SNIPPETS)}] AS s, {_list(_SNIPPETS)}[1 + doc_id // 3 % {len(_SNIPPETS)}] AS c, CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'true' ELSE 'False' END AS cue FROM documents)
    SELECT doc_id, CASE WHEN lower(found) <> 'true' THEN '' WHEN {_matches("CASE WHEN s <> '' THEN s ELSE c END", D.BAD_SECTION)} THEN 'BAD_SECTION' WHEN lower(cue) = 'true' THEN 'GOOD' ELSE 'VARIANT_ONLY_NO_GOF' END AS quality FROM r""")
def q_context_quality(spark, d):
    n = F.col("doc_id")
    cue = F.when(n % 3 == 1, "true").when(n % 3 == 2, "False")
    rows = t(spark, d, "documents").select("doc_id", _pick(("True", "false", "TRUE", ""), n).alias("grobid_variant_found"), _pick(_SNIPPETS, F.floor(n / 4)).alias("grobid_snippet"), _pick(_SNIPPETS, F.floor(n / 3)).alias("grobid_variant_context"), cue.alias("grobid_gof_cue_found"))
    return rows.select("doc_id", C.context_quality().alias("quality"))


_SAID = (*_PHRASES, *_SNIPPETS, "nonsense-mediated decay", "NEOMORPHIC", "it aggregates", "constitutively active", "reading frame")


@sql(f"""
    WITH r AS (SELECT doc_id, {_list(_SAID)}[1 + doc_id % {len(_SAID)}] || ' ' || lang || ' ' || {_list(_SAID)}[1 + doc_id // 5 % {len(_SAID)}] AS s FROM documents)
    SELECT doc_id, concat_ws(',', {", ".join(f"CASE WHEN {_matches('s', p)} THEN {quoted(n)} END" for n, p in D.DETECTORS.items())}) AS found FROM r""")
def q_detectors(spark, d):
    """All detectors over two phrases a document."""
    n = F.col("doc_id")
    rows = t(spark, d, "documents").select("doc_id", F.concat_ws(" ", _pick(_SAID, n), "lang", _pick(_SAID, F.floor(n / 5))).alias("s"))
    flagged = rows.select("doc_id", *D.detected("s", **D.DETECTORS))
    return flagged.select("doc_id", F.concat_ws(",", *[F.when(F.col(c), c) for c in D.DETECTORS]).alias("found"))


@sql("SELECT doc_id, source || '|' || coalesce(lang, '') || '|' || n_chars || '|' || doc_id || '|' || length(text) AS line FROM documents")
def q_columns_order(spark, d):
    """Every row's values in the new order of columns."""
    docs = t(spark, d, "documents").select("doc_id", F.length("text").alias("length"), "lang", "source", "n_chars")
    out = R.reordered(docs, ["source", "lang", "none"], ["n_"])
    return out.select("doc_id", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in out.columns]).alias("line"))
