"""Queries of sources, sinks, services, model calls and the real rules, with their SQL.

Files are written below the folder of scratch() and read back; services answer
in process.
"""

from __future__ import annotations

import json

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions import models, notation, sections, text
from quillmill.operators import joins as J
from quillmill.operators import rows as R
from quillmill.plans import pipelines
from quillmill.plans.queries import query, t
from quillmill.sources import readers, services, sinks, workbook
from quillmill.sources.files import scratch
from quillmill.streaming.incremental import append_new

#: The queries' SQL, by name.
SQL: dict[str, str] = {}


def sql(statement: str):
    def keep(f):
        SQL[f.__name__] = statement
        return query(f)

    return keep


def stacked(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def counted(df: DataFrame, name: str, key: str) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.sum(F.col(key).cast("long")).alias("ids")).withColumn("part", F.lit(name))


@sql("""
    WITH d AS (SELECT count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents)
    SELECT 'strict' AS part, n, ids FROM d UNION ALL SELECT 'tolerant', n, ids FROM d UNION ALL SELECT 'kept', n, ids FROM d UNION ALL SELECT 'appended', n, ids FROM d
    UNION ALL SELECT 'read', n, NULL FROM d UNION ALL SELECT 'bad', (SELECT count(*) FROM nation), NULL""")
def q_json_lines(spark, d):
    root, schema = scratch(spark), "doc_id long, lang string, n_chars long"
    docs = t(spark, d, "documents").select("doc_id", "lang", "n_chars")
    for _ in range(2):  # the second run appends nothing
        sinks.append_json(docs, f"{root}/good", ["doc_id"], schema)
    bad = t(spark, d, "nation").select(F.concat(F.lit('{"doc_id": '), "n_name").alias("value"))
    docs.select(F.to_json(F.struct("*")).alias("value")).union(bad).write.text(f"{root}/mixed")
    kept, rejects = readers.json_lines_with_rejects(spark, f"{root}/mixed", schema)
    counts = readers.reading_counts(kept, rejects).select(F.col("status").alias("part"), "n", F.lit(None).cast("long").alias("ids"))
    tolerant = readers.json_lines(spark, f"{root}/mixed", schema, strict=False)
    return stacked(counted(readers.json_lines(spark, f"{root}/good", schema), "strict", "doc_id"), counted(tolerant, "tolerant", "doc_id"), counted(kept, "kept", "doc_id"), counted(readers.json_lines(spark, f"{root}/good", schema).distinct(), "appended", "doc_id"), counts)


@sql("SELECT CAST(n_nationkey AS VARCHAR) AS stem, n_name AS name, (SELECT count(*) FROM nation) AS written, (SELECT count(*) FROM nation) AS skipped FROM nation")
def q_json_folder(spark, d):
    root = scratch(spark)
    rows = t(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    written, skipped = sinks.export_documents(rows, "key", root)[0], sinks.export_documents(rows, "key", root)[1]
    return readers.json_folder(spark, root, "key long, name string").select("stem", "name", F.lit(written).cast("long").alias("written"), F.lit(skipped).cast("long").alias("skipped"))


@sql("SELECT 'documents' AS part, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents UNION ALL SELECT 'of one bucket', count(*), CAST(sum(doc_id) AS BIGINT) FROM documents WHERE doc_id = 5")
def q_bucketed_documents(spark, d):
    root = scratch(spark)
    sinks.write_documents(t(spark, d, "documents").select("doc_id", "lang"), root, 16, "doc_id")
    back = spark.read.schema("doc_id long, lang string, bucket int").json(root)
    bucket = F.pmod(F.xxhash64(F.lit(5).cast("long")), F.lit(16))
    return stacked(counted(back, "documents", "doc_id"), counted(back.where((F.col("bucket") == bucket) & (F.col("doc_id") == 5)), "of one bucket", "doc_id"))


@sql("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CASE WHEN s_nationkey % 3 = 0 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS nation, form FROM supplier, (VALUES ('csv'), ('tsv')) f(form)")
def q_delimited(spark, d):
    root = scratch(spark)
    rows = t(spark, d, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_nationkey") % 3 != 0, F.col("s_nationkey")).alias("nation"))
    sinks.write_delimited(rows, f"{root}/c", ",")
    sinks.write_delimited(rows, f"{root}/t")
    return stacked(*[readers.delimited(spark, f"{root}/{form[0]}", by).drop("_ord").withColumn("form", F.lit(form)) for form, by in (("csv", ","), ("tsv", "\t"))])


@sql("SELECT CAST(n_nationkey AS VARCHAR) AS id, row_number() OVER (ORDER BY CAST(n_nationkey AS VARCHAR)) - 1 AS place FROM nation")
def q_id_list(spark, d):
    root = scratch(spark)
    twice = t(spark, d, "nation").select("n_nationkey").union(t(spark, d, "nation").select("n_nationkey"))
    sinks.write_lines(twice, "n_nationkey", root)
    ids = readers.id_list(spark, root).agg(F.sort_array(F.collect_list("id")).alias("ids"))  # sorted as text, as ids are
    return ids.select(F.posexplode("ids").alias("place", "id")).select(F.col("place").cast("long").alias("place"), "id")


@sql("""
    SELECT 'text' AS part, n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation UNION ALL SELECT 'typed', n_name, CAST(n_regionkey + 1 AS VARCHAR) FROM nation
    UNION ALL SELECT 'ids', CAST(r AS VARCHAR), '' FROM (SELECT DISTINCT n_regionkey AS r FROM nation) UNION ALL SELECT 'sheets', 'nations,high', ''""")
def q_workbook(spark, d):
    path = scratch(spark) + "/report.xlsx"
    rows = t(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")
    made = workbook.write_workbook(spark, {"nations": rows, "high": rows.where("n_regionkey > 2"), "none": rows.where("n_regionkey > 99")}, path, only_filled=("none",), fills={"1": "FFFFC7CE"}, fill_by="n_regionkey")
    typed = workbook.read_records(spark, path, "n_name string, n_regionkey long", "nations").select(F.lit("typed").alias("part"), F.col("n_name").alias("name"), (F.col("n_regionkey") + 1).cast("string").alias("region"))
    as_text = workbook.read_sheet(spark, path, ["n_name", "n_regionkey"], "nations")
    ids = workbook.ids_of(as_text, "n_regionkey").select(F.lit("ids").alias("part"), F.col("n_regionkey").alias("name"), F.lit("").alias("region"))
    sheets = readers.literal(spark, [{"part": "sheets", "name": ",".join(made), "region": ""}], "part string, name string, region string")
    return stacked(as_text.select(F.lit("text").alias("part"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")), typed, ids, sheets)


@sql("SELECT 'all' AS view, count(*) AS n FROM labels UNION ALL SELECT 'good', count(*) FROM labels WHERE quality = 1 UNION ALL SELECT 'toxic', count(*) FROM labels WHERE toxic = 1 UNION ALL SELECT 'all_json', count(*) FROM labels UNION ALL SELECT 'side_json', count(*) FROM labels WHERE toxic = 1")
def q_views_written(spark, d):
    root, labels = scratch(spark), t(spark, d, "labels")
    sinks.write_views(labels, {"all": F.lit(True), "good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}, f"{root}/views")
    sinks.write_with_side(labels, f"{root}/all", f"{root}/side", F.col("toxic") == 1)
    json_count = lambda name: readers.json_lines(spark, f"{root}/{name}", labels.schema).agg(F.count("*").alias("n")).withColumn("view", F.lit(f"{name}_json"))
    return stacked(spark.read.parquet(f"{root}/views").groupBy("view").agg(F.count("*").alias("n")), json_count("all"), json_count("side"))


def _full(keys):
    if "13" in keys:
        raise OSError("no answer")
    return {k: f"full text of {k}" for k in keys if int(k) % 3}


def _abstracts(keys):
    return {k: f"abstract of {k}, " + "x" * (int(k) % 7) * 10 for k in keys}


def _mapping(keys):
    return json.dumps({"records": [{"pmid": k, "pmcid": f"PMC{k}"} if int(k) % 2 else {"pmid": k} for k in keys]})


def _titles(keys):
    return "".join(f'<DocSum><Id>{k}</Id>' + (f'<Item Name="Title" Type="String">Title {k}</Item>' if int(k) % 4 else "") + "</DocSum>" for k in keys)


@sql("""
    WITH i AS (SELECT n_nationkey AS k FROM nation), f AS (SELECT k, CASE WHEN k = 13 THEN 'failed' WHEN k % 3 <> 0 THEN 'done' ELSE 'absent' END AS s FROM i)
    SELECT 'full ' || s AS part, count(*) AS n, CAST(sum(k) AS BIGINT) AS ids FROM f GROUP BY 1
    UNION ALL SELECT 'new', count(*), CAST(sum(k) AS BIGINT) FROM f WHERE s = 'done' AND k >= 10
    UNION ALL SELECT CASE WHEN s = 'done' THEN 'full_text 0.7' ELSE 'abstract_only 0.4' END, count(*), CAST(sum(k) AS BIGINT) FROM f WHERE s = 'done' OR length('abstract of ' || k || ', ') + k % 7 * 10 >= 50 GROUP BY 1
    UNION ALL SELECT 'mapped', count(*), CAST(sum(k) AS BIGINT) FROM i WHERE k % 2 = 1 UNION ALL SELECT 'titled', count(*), CAST(sum(k) AS BIGINT) FROM i WHERE k % 4 <> 0""")
def q_fetch(spark, d):
    ids = t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"))
    full = services.fetched(ids, _full, size=1, at_once=2, first_wait=0.0)
    best = services.with_fallback(full, services.fetched(ids, _abstracts, size=10, at_once=2))
    new = services.fetched(ids, _full, size=1, at_once=2, first_wait=0.0, have=ids.where("cast(id as int) < 10")).where("status = 'done'")
    by = lambda df, part: df.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.sum(F.col("id").cast("long")).alias("ids"))
    mapped = services.mapped_ids(ids, _mapping, at_once=2).where(F.col("pmcid") == F.concat(F.lit("PMC"), "id"))
    titled = services.fetched_titles(ids, _titles, at_once=2).where(F.col("title") == F.concat(F.lit("Title "), "id"))
    return stacked(by(full, F.concat(F.lit("full "), "status")), counted(new, "new", "id"), by(best, F.concat_ws(" ", "source", F.col("score").cast("string"))), counted(mapped, "mapped", "id"), counted(titled, "titled", "id"))


@sql("""
    WITH g AS (SELECT conv_id, list(role ORDER BY turn, role, text) AS roles, list(text ORDER BY turn, role, text) AS texts FROM conversations GROUP BY conv_id)
    SELECT CAST(conv_id AS VARCHAR) AS pmid, CASE WHEN conv_id % 2 = 0 THEN '10.1/' || conv_id ELSE '' END AS doi, CAST(1990 + conv_id % 30 AS VARCHAR) AS year, '' AS title, array_to_string(texts, ' ') AS abstract, array_to_string(roles, '|') AS mesh FROM g""")
def q_flat_record(spark, d):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    x = t(spark, d, "conversations").groupBy("conv_id").agg(turns.alias("x"))
    ids = F.array(F.struct(F.lit("pii").alias("type"), F.lit("S1").alias("value")), F.struct(F.when(F.col("conv_id") % 2 == 0, "doi").otherwise("pmc").alias("type"), F.concat(F.lit("10.1/"), F.col("conv_id").cast("string")).alias("value")), F.struct(F.lit("pmc").alias("type"), F.lit("later").alias("value")))
    nested = x.select(F.col("conv_id").alias("pmid"), ids.alias("article_ids"), F.concat((1990 + F.col("conv_id") % 30).cast("string"), F.lit(" Jan 3")).alias("date"), F.lit(None).cast("string").alias("title"), F.col("x.text").alias("abstract_parts"), F.transform("x.role", lambda r: F.struct(r.alias("name"))).alias("subjects"))
    return services.flat_record(nested).withColumn("mesh", F.array_join("mesh", "|"))


@sql(r"""
    WITH x AS (SELECT item_id, trim(regexp_replace(text, '[ \t\n\f\r\v]+', ' ', 'g')) AS s FROM benchmark)
    SELECT item_id, CAST(4 AS BIGINT) AS n_sections, CAST(2 * length(s) + length('Item ' || item_id) + length('first of ' || item_id) AS BIGINT) AS chars_total, 'first of ' || item_id AS methods, s AS results, s AS abstract FROM x""")
def q_article_sections(spark, d):
    body = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    key = F.col("item_id").cast("string")
    parts = [F.lit("<article><front><article-title>Item "), key, F.lit("</article-title><abstract><p>"), body, F.lit("</p></abstract></front><body><sec><title>Materials and Methods</title><p>first of "), key, F.lit("</p></sec><sec><title>Our Results here</title><p>"), body, F.lit("</p></sec><sec><title>Methods</title><p>never taken</p></sec><sec><title>Thanks</title><p>x</p></sec></body></article>")]
    out = sections.with_sections(t(spark, d, "benchmark").select("item_id", F.concat(*parts).alias("xml")), "xml")
    return out.select("item_id", F.col("n_sections").cast("long").alias("n_sections"), "chars_total", *[F.element_at("sections", F.lit(s)).alias(s) for s in ("methods", "results", "abstract")])


@sql("""
    SELECT 'flat' AS part, role AS name, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY role
    UNION ALL SELECT 'map', 'r ' || role, count(*), CAST(sum(length(text)) AS BIGINT) FROM conversations WHERE role <> 'system' GROUP BY role
    UNION ALL SELECT 'distinct', v, 0, NULL FROM (SELECT DISTINCT role AS v FROM conversations UNION SELECT DISTINCT lang FROM documents UNION SELECT DISTINCT source FROM documents)
    UNION ALL SELECT 'rewritten', upper(role), count(*), CAST(sum(length(text)) AS BIGINT) FROM conversations GROUP BY role""")
def q_nested(spark, d):
    root = scratch(spark)
    docs = t(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("role", "text")).alias("turns"))
    counts = lambda df, part, name: df.groupBy(F.lit(part).alias("part"), name.alias("name")).agg(F.count("*").alias("n"), F.sum(F.length("text").cast("long")).alias("chars"))
    by_role = t(spark, d, "conversations").groupBy("conv_id", "role").agg(F.collect_list(F.struct("role", "text")).alias("turns"))
    maps = by_role.groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("r "), "role").alias("k"), F.col("turns")))).alias("m"))
    seen = R.distinct_values((docs.select(F.col("turns.role").alias("roles")), ["roles"]), (t(spark, d, "documents"), ["lang", "source"]))
    docs.write.json(f"{root}/a")
    sinks.rewrite_json(spark, f"{root}/a", f"{root}/b", "conv_id long, turns array<struct<role:string,text:string>>", "turns", role=F.upper)
    again = readers.json_lines(spark, f"{root}/b", "conv_id long, turns array<struct<role:string,text:string>>")
    return stacked(
        counts(R.flattened(docs, ["conv_id"], "turns"), "flat", F.col("role")),
        counts(R.flattened_map(maps, "m", "key").where("role <> 'system'"), "map", F.col("key")),
        seen.select(F.lit("distinct").alias("part"), F.col("value").alias("name"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("chars")),
        counts(R.flattened(again, ["conv_id"], "turns"), "rewritten", F.col("role")),
    )


@sql("""
    WITH f AS (SELECT p_size AS k, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE p_brand END AS gene, CASE WHEN p_partkey % 3 = 0 THEN 'c.' || p_partkey || 'del' WHEN p_partkey % 3 = 1 THEN '' ELSE 'x' || p_partkey END AS coding,
      CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'p.R' || p_size || '*' END AS protein, CASE WHEN p_partkey % 13 = 0 THEN 'Q' ELSE 'h' END AS class, CASE WHEN p_partkey % 5 = 0 THEN 'No' ELSE 'yes' END AS human FROM part)
    SELECT CAST(k AS BIGINT) AS k, count(*) <= 10 AND bool_and(class = 'h') AS valid, bool_or(gene = '' OR (coding = '' AND protein = '')) AS lacks, CAST(count(*) FILTER (WHERE length(gene) >= 2 AND human = 'yes') AS BIGINT) AS human,
      CAST(count(*) FILTER (WHERE starts_with(coding, 'c.')) AS BIGINT) AS codings, CAST(count(*) FILTER (WHERE protein <> '') AS BIGINT) AS proteins FROM f GROUP BY k""")
def q_findings(spark, d):
    n = F.col("p_partkey")
    made = {"gene": F.when(n % 11 == 0, "").otherwise(F.col("p_brand")), "hgvs_coding": F.when(n % 3 == 0, F.concat(F.lit("c."), n.cast("string"), F.lit("del"))).when(n % 3 == 1, "").otherwise(F.concat(F.lit("x"), n.cast("string"))), "hgvs_protein": F.when(n % 7 == 0, "").otherwise(F.concat(F.lit("p.R"), F.col("p_size").cast("string"), F.lit("*"))), "class": F.when(n % 13 == 0, "Q").otherwise("h"), "is_human": F.when(n % 5 == 0, "No").otherwise("yes")}
    docs = t(spark, d, "part").groupBy(F.col("p_size").cast("long").alias("k")).agg(F.collect_list(F.struct(*[c.alias(k) for k, c in made.items()])).alias("findings"))
    flags = docs.select("k", models.findings_valid().alias("valid"), models.lacks_core_field().alias("lacks"))
    rows = R.flattened(docs, ["k"], "findings")
    counts = rows.groupBy("k").agg(F.count_if((F.length("gene") >= 2) & notation.loose_boolean("is_human")).alias("human"), F.count_if(notation.valid_coding("hgvs_coding") != "").alias("codings"), F.count_if(notation.valid_protein("hgvs_protein") != "").alias("proteins"))
    return flags.join(counts, "k")


@sql("""
    WITH n AS (SELECT doc_id, doc_id % 40 AS k, 'c.' || (n_chars % 900) AS coding, 'p.' || (doc_id % 700) AS protein, regexp_extract(text, '[a-z]+') || ' ' || (doc_id % 300) AS mention FROM documents),
    m AS (SELECT item_id % 37 AS k, 'c.' || (item_id * 7 % 900) AS coding, 'p.' || (item_id * 3 % 700) AS protein FROM benchmark),
    r AS (SELECT *, doc_id % 2 = 0 AS relevant FROM n), e AS (SELECT r.*, EXISTS (SELECT 1 FROM m WHERE m.k = r.k AND (m.coding = r.coding OR m.protein = r.protein OR list_has_any(regexp_extract_all(r.mention, '[0-9]+'), regexp_extract_all(m.coding || ' ' || m.protein, '[0-9]+')))) AS covered FROM r WHERE relevant AND k IN (SELECT k FROM m))
    SELECT 'covered' AS part, count(*) FILTER (WHERE covered) AS n FROM e UNION ALL SELECT 'rows', count(*) FROM e UNION ALL SELECT 'missed in context', count(*) FROM e WHERE NOT covered AND doc_id % 3 = 0
    UNION ALL SELECT 'unseen', count(DISTINCT k) FROM r WHERE relevant AND k NOT IN (SELECT k FROM m)""")
def q_recall_audit(spark, d):
    key = F.col("doc_id")
    notes = t(spark, d, "documents").select((key % 40).alias("pmid"), F.concat(F.lit("#g#c."), (F.col("n_chars") % 900).cast("string"), F.lit("#p."), (key % 700).cast("string"), F.when(key % 2 == 0, " nonsense").otherwise("")).alias("normalized_id"), F.concat_ws(" ", F.regexp_extract("text", "[a-z]+", 0), (key % 300).cast("string")).alias("first"), F.when(key % 3 == 0, "a hypermorph").otherwise("").alias("context_text"))
    notes = notes.withColumn("mention_text", F.regexp_replace("first", "[a-z]+", "m"))  # invented words may hold the patterns
    model = t(spark, d, "benchmark").select((F.col("item_id") % 37).alias("pmid"), F.concat(F.lit("c."), (F.col("item_id") * 7 % 900).cast("string")).alias("hgvs_coding"), F.concat(F.lit("p."), (F.col("item_id") * 3 % 700).cast("string")).alias("hgvs_protein"))
    checked, share, missed, unseen = pipelines.evaluate_recall(notes, model)
    one = lambda df, part: df.agg(F.count("*").alias("n")).withColumn("part", F.lit(part))
    return stacked(share.select(F.col("covered").alias("n"), F.lit("covered").alias("part")), one(checked, "rows"), one(missed, "missed in context"), one(unseen, "unseen"))


@sql("SELECT CASE WHEN coalesce(score, 0) < 0.7 THEN 'below' ELSE 'above' END AS side, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE (doc_id % 10) / 10 END AS score FROM labels) GROUP BY 1")
def q_score_below(spark, d):
    rows = t(spark, d, "labels").select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("doc_id") % 10 / 10).alias("score"))
    low = rows.where(text.below("score")).withColumn("side", F.lit("below"))
    return stacked(low, rows.where(~text.below("score")).withColumn("side", F.lit("above"))).groupBy("side").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@sql("""
    WITH k AS (SELECT n_nationkey AS k FROM nation)
    SELECT 'todo' AS part, count(*) AS n, CAST(sum(k) AS BIGINT) AS ids FROM k WHERE k % 4 IN (2, 3) UNION ALL SELECT 'todo at first', count(*), CAST(sum(k) AS BIGINT) FROM k
    UNION ALL SELECT 'merged', count(*), CAST(sum(CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END) AS BIGINT) FROM k UNION ALL SELECT 'healthy', 1, NULL UNION ALL SELECT 'there already', (SELECT count(*) FROM documents WHERE lang = 'de' AND regexp_matches(text, 'ein')), NULL""")
def q_state(spark, d):
    root = scratch(spark)
    keys = t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("key"))
    first = counted(sinks.still_to_do(spark, keys, f"{root}/none"), "todo at first", "key")
    status = F.element_at(F.array(F.lit("done"), F.lit("absent"), F.lit("failed")), (F.col("key").cast("int") % 4 + 1))
    sinks.record_progress(spark, keys.where("cast(key as int) % 4 < 3").withColumn("status", status), f"{root}/state")
    a, b = keys.withColumn("v", F.lit(1)), keys.where("cast(key as int) % 2 = 0").withColumn("v", F.lit(2))
    merged = readers.merged_last(a, b, key="key").agg(F.count("*").alias("n"), F.sum("v").alias("ids")).withColumn("part", F.lit("merged"))
    there = R.existing(t(spark, d, "documents"), {"lang": "de"}, "text", "ein")
    answers = iter([False, False, True])  # a service that answers late
    more = readers.literal(spark, [{"part": "healthy", "n": int(models.healthy(lambda: next(answers), wait=0.0)) - int(models.healthy(lambda: False, tries=2, wait=0.0))}, {"part": "there already", "n": there}], "part string, n long, ids long")
    return stacked(counted(sinks.still_to_do(spark, keys, f"{root}/state"), "todo", "key"), first, merged, more)


@sql("SELECT 'sink' AS part, count(*) AS n, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS total FROM events WHERE value IS NOT NULL UNION ALL SELECT 'side', count(*), CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) FROM events WHERE floor(value) > 50 UNION ALL SELECT 'rejects', count(*), CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) FROM events WHERE floor(value) < 10")
def q_stream_sides(spark, d):
    """Two files, the second with rows of the first again; a batch that breaks off after the sink was written; a new checkpoint."""
    root, events = scratch(spark), t(spark, d, "events")
    whole = lambda df: df.select("event_id", "event_type", F.floor("value").cast("long").alias("v"))
    third = F.col("event_id") % 3 == 0
    events.where(third).coalesce(1).write.parquet(f"{root}/in")
    run = lambda state, side: append_new(spark, f"{root}/in", events.schema, f"{root}/sink", f"{root}/{state}", ["event_id"], whole, side=(side, f"{root}/side"), pattern="*.parquet")
    broken = F.when(F.col("v") > 50, F.raise_error(F.lit("stopped"))).otherwise(F.lit(False)).cast("boolean")
    try:
        run("first", broken)
    except StreamingQueryException:
        pass
    run("first", F.col("v") > 50)
    events.where(~third | (F.col("event_id") % 5 == 0)).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run("second", F.col("v") > 50)
    append_new(spark, d, events.schema, f"{root}/good", f"{root}/state", ["event_id"], whole, reject=(F.col("v") < 10, f"{root}/bad"), pattern="events.parquet")
    return stacked(*[spark.read.parquet(f"{root}/{folder}").agg(F.count("*").alias("n"), F.sum("v").alias("total")).withColumn("part", F.lit(part)) for part, folder in (("sink", "sink"), ("side", "side"), ("rejects", "bad"))])


def _normaliser(value: str) -> str:
    if value.endswith("7"):
        raise OSError("no answer")
    return "" if value.endswith("8") else f"remote {value}"


@sql("SELECT doc_id, lpad(CAST(doc_id % 100 AS VARCHAR), 3, '0') AS found, CASE WHEN doc_id % 10 IN (7, 8) THEN 'local v' || (doc_id % 100) ELSE 'remote v' || (doc_id % 100) END AS normal, 'local v' || (doc_id % 100) AS offline FROM labels")
def q_model_calls(spark, d):
    rows = t(spark, d, "labels").select("doc_id", F.concat(F.lit("v"), (F.col("doc_id") % 100).cast("string")).alias("value"), F.concat(F.lit("id "), F.lpad((F.col("doc_id") % 100).cast("string"), 3, "0"), F.lit(" end")).alias("s"))
    local = F.concat(F.lit("local "), "value")
    rows = models.with_normal(rows, "value", _normaliser, local, tries=2, first_wait=0.0, at_once=4)
    rows = models.with_normal(rows, "value", None, local, out="offline")
    return models.with_reply(rows, "s", models.pattern_extractor("[0-9]+"), at_once=4).select("doc_id", F.col("reply").alias("found"), "normal", "offline")


SQL["q_llm_mock"] = """
    WITH m AS (SELECT doc_id, CAST(regexp_matches(text, 'token|password|AKIA', 'i') AS INT) + CAST(regexp_matches(text, 'license|licensed', 'i') AS INT) + CAST(regexp_matches(text, '(^|[^A-Za-z0-9_])the([^A-Za-z0-9_]|$)', 'i') AS INT) AS n FROM documents)
    SELECT doc_id, round(n / 3, 4) AS score, CASE WHEN n = 3 THEN 'HIGH' WHEN n = 2 THEN 'MID' ELSE 'LOW' END AS band FROM m"""


SQL["q_html_sections"] = r"""
    WITH h AS (SELECT page_id, regexp_extract_all(regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '<x>', 'g'), '<[^>]*>|[^<]+') AS pieces FROM pages),
    t AS (SELECT page_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS i FROM h),
    e AS (SELECT *, regexp_matches(piece, '(?i)^<(title|h[123])[ >]') AS opens, regexp_matches(piece, '(?i)^</(title|h[123])[ >]') AS closes FROM t),
    g AS (SELECT *, count(*) FILTER (WHERE opens) OVER w AS part, coalesce(max(CASE WHEN opens THEN 2 * i + 1 WHEN closes THEN 2 * i END) OVER w, 0) % 2 = 1 AS heading FROM e WINDOW w AS (PARTITION BY page_id ORDER BY i)),
    d AS (SELECT page_id, part, i, heading, regexp_replace(replace(replace(replace(piece, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;?', '&', 'g') AS s FROM g WHERE NOT starts_with(piece, '<')),
    k AS (SELECT page_id, part, trim(regexp_replace(string_agg(s, '' ORDER BY i), '\s+', ' ', 'g')) AS name FROM d WHERE heading GROUP BY page_id, part),
    b AS (SELECT d.page_id, coalesce(k.name, '') AS name, string_agg(trim(regexp_replace(s, '\s+', ' ', 'g')), ' ' ORDER BY i) AS body FROM d LEFT JOIN k ON k.page_id = d.page_id AND k.part = d.part WHERE NOT d.heading AND regexp_matches(s, '\S') GROUP BY 1, 2)
    SELECT p.page_id, CAST(count(b.body) AS INTEGER) AS n_sections, CAST(coalesce(sum(length(b.body)), 0) AS BIGINT) AS chars_total, coalesce(string_agg(b.name, '|' ORDER BY b.name), '') AS headings
    FROM pages p LEFT JOIN b ON b.page_id = p.page_id GROUP BY p.page_id"""


@sql("SELECT p_partkey, regexp_extract(lower(p_name), 'part number|metal|part|red|pa', 0) AS word FROM part")
def q_alternation(spark, d):
    words = ["part", "pa", "metal", "red", "part number"]
    return t(spark, d, "part").select("p_partkey", F.regexp_extract(F.lower("p_name"), notation.alternation(words), 0).alias("word"))
