"""Queries of the operators over the given tables; plans/oracles.py has the same in SQL.

The tables hold invented words, so vocabularies are parameters here: the same
operators run with patterns that occur in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import models, notation, sections, text
from quillmill.operators import aggregates as A
from quillmill.operators import curation as C
from quillmill.operators import joins as J
from quillmill.operators import rows as R
from quillmill.operators.cascade import Cascade, Rule

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Patterns that the given texts hold.
SECRET, LICENCE, NO, THE = "token|password|AKIA", "license|licensed", "(^|[^A-Za-z0-9_])no([^A-Za-z0-9_]|$)", "(^|[^A-Za-z0-9_])the([^A-Za-z0-9_]|$)"


@query
def q_scan_clean(spark, d):
    docs = R.add_missing(t(spark, d, "documents"), ["note"]).where(~text.is_blank("text"))
    return text.without_control(docs).select("doc_id", F.left(text.strip("text"), F.lit(80)).alias("head"), F.length(text.strip("text")).cast("long").alias("n"), "note")


@query
def q_scan_topn(spark, d):
    return R.limited(t(spark, d, "documents"), 30, "doc_id").select("doc_id", "lang", "source")


@query
def q_null_cast(spark, d):
    rows = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", F.expr("try_cast(regexp_replace(text, '[^0-9]', '') as decimal(18,0))").cast("long").alias("number"), F.coalesce("quality", F.lit(-1)).alias("quality"), F.expr("try_cast(regexp_replace(source, '[^0-9]', '') as int)").alias("source_no"))


@query
def q_enum_guard(spark, d):
    kind = notation.one_of("event_type", ("CLICK", "VIEW", "PURCHASE"), "OTHER")
    kept = F.when(F.col("props").rlike("^[{]"), F.col("props")).otherwise("")
    return t(spark, d, "events").select("event_id", kind.alias("kind"), F.length(kept).cast("long").alias("props_n"))


@query
def q_add_missing_cols(spark, d):
    docs = t(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "source").withColumn("origin", F.lit("documents"))
    items = t(spark, d, "benchmark").select(F.col("item_id").alias("id")).withColumn("origin", F.lit("benchmark"))
    return R.union_by_name(docs, items).groupBy("origin", "lang", "source").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query
def q_flatten_json(spark, d):
    props = F.from_json(text.reply_json(F.concat(F.lit("<think>x</think>\n```json\n"), F.col("props"), F.lit("\n```"))), "map<string,string>")
    return t(spark, d, "events").select("event_id", F.explode(props).alias("name", "value")).groupBy("name").agg(F.count("*").alias("n"), F.count_distinct("value").alias("values"))


@query
def q_map_explode(spark, d):
    turns = F.map_from_entries(F.array_sort(F.collect_set(F.struct("role", F.lit(1)))))
    convs = t(spark, d, "conversations").groupBy("conv_id").agg(turns.alias("roles"))
    return A.presence_rates(convs, "roles").select("section", "n", F.round("share", 9).alias("share"))


@query
def q_vocab_flags(spark, d):
    body = text.joined("text", "source")
    return t(spark, d, "documents").select("doc_id", text.has(body, SECRET).alias("secret"), text.has(body, LICENCE).alias("licence"), text.has(body, THE).alias("the"), text.has(body, NO, False).alias("no"))


@query
def q_negation_retest(spark, d):
    return t(spark, d, "documents").select("doc_id", text.has("text", "the (and|of)").alias("negated"), text.holds_after_removing("text", "the (and|of)", "(and|of) th").alias("still"))


@query
def q_tiered_match(spark, d):
    half = F.floor(F.length("text") / 2).cast("int")
    halves = F.create_map(F.lit("first"), F.left("text", half), F.lit("second"), F.substring("text", half + 1, F.length("text")))
    tiers = [("tier1", SECRET), ("tier2", "licen[a-z]+"), ("tier3", "that [a-z]+")]
    found = text.tiered_match(text.map_text("s"), tiers)
    rows = t(spark, d, "documents").select("doc_id", halves.alias("s"))
    return rows.select("doc_id", found["best"].alias("best"), found["matched"].alias("matched"), text.keys_matching("s", "that [a-z]+").alias("hits"))


@query
def q_sentence_extract(spark, d):
    found = text.distinct_sentences(["text"], r"[A-Z][a-z ,]{0,60}[.]", stop=".", longest=62)
    return t(spark, d, "documents").select("doc_id", F.size(found).cast("long").alias("n"), F.array_join(found, "|").alias("sentences"))


@query
def q_prompt_budget(spark, d):
    third = F.floor(F.length("text") / 3).cast("int")
    parts = F.create_map(F.lit("abstract"), F.left("text", third), F.lit("results"), F.substring("text", third + 1, third), F.lit("methods"), F.substring("text", 2 * third + 1, F.length("text")))
    found = F.filter(F.array(F.left("text", F.lit(120))), lambda s: F.length(s) > 100)
    return t(spark, d, "documents").select("doc_id", text.budgeted_prompt("source", parts, found, ["abstract", "results", "methods"], budget=700, snippet_limit=90).alias("prompt"))


@query
def q_prompt_capped(spark, d):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    convs = t(spark, d, "conversations").groupBy("conv_id").agg(turns.alias("x"))
    return convs.select("conv_id", text.capped_prompt(F.col("conv_id").cast("string"), "x.role", "x.text", 200, 900, 20).alias("prompt"))


@query
def q_norm_code(spark, d):
    made = F.concat(F.lit(" NM_0012.3: C."), F.regexp_replace("p_brand", "[^0-9]", ""), F.lit("delTGCA "))
    return t(spark, d, "part").select("p_partkey", notation.coding_normal(made).alias("code"), notation.coding_key(F.concat(F.lit("P.X"), F.col("p_size").cast("string"), F.lit("dupA"))).alias("compare"))


@query
def q_norm_protein(spark, d):
    made = F.concat(F.lit("p.(Q"), F.col("p_size").cast("string"), F.lit("Rfs*"), (F.col("p_partkey") % 9).cast("string"), F.lit(")"))
    return t(spark, d, "part").select("p_partkey", notation.protein_normal(made).alias("frameshift"), notation.protein_normal(F.concat(F.lit("R"), F.col("p_size").cast("string"), F.lit("*"))).alias("stop"))


@query
def q_parse_id(spark, d):
    made = F.regexp_replace("url", "/", "#c.")
    found = notation.parsed_id(made)
    return t(spark, d, "pages").select("page_id", found["coding"].alias("coding"), found["protein"].alias("protein"))


@query
def q_positions(spark, d):
    found = notation.positions(F.concat("url", F.lit(" 7 "), F.col("page_id").cast("string")))
    return t(spark, d, "pages").select("page_id", F.array_join(found, ",").alias("numbers"), F.size(found).cast("long").alias("n"))


@query
def q_relevance_flag(spark, d):
    return t(spark, d, "pages").select("page_id", notation.is_relevant("url", F.col("page_id").cast("string")).alias("relevant"))


@query
def q_score_band(spark, d):
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    vectors = t(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), (F.round(norm * 1000) % 100 / 100).alias("score"))
    rows = t(spark, d, "labels").join(vectors, "doc_id", "left")
    return rows.groupBy(text.band("score").alias("band")).agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("good"))


@query
def q_html_tags(spark, d):
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    items = sections.split_by_tag("html", "li")
    return t(spark, d, "pages").select("page_id", text.tags_removed(title).alias("title"), F.size(items).cast("long").alias("n_items"), F.array_join(items, "|").alias("items"))


@query
def q_html_sections(spark, d):
    return sections.with_sections(t(spark, d, "pages").select("page_id", "html"), "html", "html").select("page_id", "n_sections", "chars_total", F.array_join(F.array_sort(F.map_keys("sections")), "|").alias("headings"))


@query
def q_record_flatten(spark, d):
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    x = t(spark, d, "conversations").groupBy("conv_id").agg(turns.alias("x"))
    first_user = F.coalesce(F.get(F.filter("x", lambda s: s["role"] == "user"), 0)["text"], F.lit(""))
    why = text.reason(F.when(F.size("x") > 4, "long"), F.when(F.exists("x", lambda s: s["role"] == "system"), "system"), F.concat(F.lit("turns="), F.size("x")))
    return x.select("conv_id", F.left(first_user, F.lit(40)).alias("opening"), F.left(F.array_join("x.role", " "), F.lit(60)).alias("roles"), why.alias("why"))


@query
def q_split_pairs(spark, d):
    path = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[.]", ";")
    rows = t(spark, d, "pages").select("page_id", F.posexplode(notation.paired_lists(path, F.regexp_replace("url", "[:/.]+", ";"))).alias("i", "p"))
    return rows.select("page_id", F.col("i").cast("long").alias("i"), "p.left", "p.right", notation.is_disease_id(F.concat("p.right")).alias("is_id"))


@query
def q_any_missing(spark, d):
    x = t(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("role", "text")).alias("x"))
    return x.select("conv_id", F.exists("x", lambda s: F.length(s["text"]) < 40).alias("any_short"), F.aggregate("x", F.lit(0).cast("long"), lambda a, s: a + F.length(s["text"])).alias("chars"), F.size("x").cast("long").alias("n"))


def fixture_cascade() -> Cascade:
    return Cascade(
        [
            Rule(text.has("text", SECRET), "EXCLUDE_SECRET", "secret in text"),
            Rule(text.has("text", LICENCE), "REVIEW_LICENCE", F.concat(F.lit("licence in "), F.col("source"))),
            Rule(F.col("_no") & text.holds_after_removing("text", NO, THE), "REVIEW_MECHANISM", "negated and claimed"),
            Rule(F.col("_no"), "EXCLUDE_NO_GOF_EVIDENCE", "negated"),
            Rule((F.col("lang") == "de") & (F.col("n_chars") < 200), "EXCLUDE_NON_GOF_LOF", "short"),
        ],
        "KEEP",
    )


def qc_documents(spark, d) -> DataFrame:
    decided = fixture_cascade().decided()
    return t(spark, d, "documents").withColumn("_no", text.has("text", NO, False)).withColumn("_q", decided).select("doc_id", "lang", "source", "n_chars", "text", F.col("_q.action").alias("action"), F.col("_q.reason").alias("reason"))


@query
def q_qc_cascade(spark, d):
    return qc_documents(spark, d).select("doc_id", "action", "reason")


def flagged(spark, d) -> DataFrame:
    mechanism = F.element_at(F.array(*[F.lit(m) for m in ("HYPERMORPH_TRUE_GOF", "TOXIC_GOF", "DOMINANT_NEGATIVE_ANTIMORPH", "LOSS_OF_FUNCTION_NON_GOF", "UNCERTAIN_OR_CONFLICTING")]), (F.col("doc_id") % 5 + 1).cast("int"))
    strict = F.when(F.col("doc_id") % 7 == 0, "TRUE_GOF").when(F.col("doc_id") % 7 == 1, "ANTIMORPH_DN").otherwise("")
    rows = qc_documents(spark, d).withColumns({"qc_round1_action": F.col("action"), "curated_mechanism_class": mechanism, "strict_gof_status": strict})
    return C.with_round1_flags(rows)


@query
def q_derived_flags(spark, d):
    return flagged(spark, d).select("doc_id", "curated_mechanism_class_round1", "strict_gof_status_round1", "include_in_final_dataset_round1", "include_in_strict_HN_analysis_round1", "hn_view_round1")


@query
def q_reclass_nine(spark, d):
    kind = F.element_at(F.array(*[F.lit(k) for k in ("frameshift", "stop_gain", "stop_loss", "NMD_escape", "missense")]), (F.col("n_chars") % 5 + 1).cast("int"))
    rows = flagged(spark, d).withColumns({"final_variant_type": kind, "hgvs_protein": F.when(F.col("doc_id") % 2 == 0, "p.R12*").otherwise("p.R12fs*4"), "gof_effect": F.when(F.col("doc_id") % 3 == 0, "neomorphic").otherwise(""), "evidence_text": F.lit(""), "evidence_strength": F.when(F.col("doc_id") % 4 == 0, "direct_functional").otherwise("insufficient")})
    return C.with_reclassification(rows).select("doc_id", "primary_variant_class", "stop_loss_subtype", "primary_gof_task", "gof_due_to_variant", "gof_evidence_strength", "nmd_escape_status", "hn_call", "include_in_core_task_dataset", "task_reclassification_reason")


@query
def q_notation_class(spark, d):
    protein = F.when(F.col("p_size") % 4 == 0, "p.*278Glyext*19").when(F.col("p_size") % 4 == 1, "p.Q5fs*2").when(F.col("p_size") % 4 == 2, "p.R5*").otherwise("p.R5G")
    coding = F.when(F.col("p_partkey") % 3 == 0, "c.5del").when(F.col("p_partkey") % 3 == 1, "c.5A>G").otherwise("c.*5A>G")
    rows = t(spark, d, "part").select("p_partkey", protein.alias("protein"), coding.alias("coding"))
    rows = rows.withColumn("variant", C.class_from_notation("coding", "protein"))
    return rows.select("p_partkey", "variant", C.subtype_from_notation("protein", F.col("variant")).alias("subtype"))


@query
def q_default_cols(spark, d):
    variant = F.when(F.col("o_orderstatus") == "F", "FRAMESHIFT").when(F.col("o_orderstatus") == "O", "STOP_LOSS").otherwise("OTHER")
    rows = t(spark, d, "orders").select("o_orderkey", variant.alias("primary_variant_class"), F.when(F.col("o_orderpriority").startswith("1"), "h").otherwise("n").alias("class"))
    cols = ["primary_variant_class", "primary_gof_task", "gof_due_to_variant", "gof_evidence_strength", "nmd_escape_status", "hn_call", "include_in_core_task_dataset", "stop_loss_subtype"]
    return C.with_augmented_defaults(rows).groupBy(*cols).agg(F.count("*").alias("n"))


@query
def q_lookup_last_wins(spark, d):
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    return J.last_wins_lookup(t(spark, d, "orders").select("o_orderkey"), lines, ["o_orderkey"], "l_returnflag", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"], "")


@query
def q_dedup_antijoin(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.col("text").alias("k"), "lang")
    base = t(spark, d, "benchmark").select(F.col("text").alias("k"), F.lit("en").alias("lang"))
    new, dup = J.new_rows(docs, base, ["k", "lang"], ["doc_id"])
    return new.withColumn("state", F.lit("new")).union(dup.withColumn("state", F.lit("duplicate"))).select("doc_id", "state")


@query
def q_resume_anti(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 10 == 0, "").otherwise(F.col("doc_id").cast("string")).alias("key"))
    done = t(spark, d, "labels").select(F.when(F.col("doc_id") % 10 == 0, "").otherwise(F.col("doc_id").cast("string")).alias("key"))
    return J.not_in(docs, done, ["key"], blank_matches=False).select("doc_id")


@query
def q_semi_ids(spark, d):
    return J.only_in(t(spark, d, "documents"), t(spark, d, "labels").where("toxic = 1"), ["doc_id"]).select("doc_id", "lang")


@query
def q_map_then_anti(spark, d):
    orders = t(spark, d, "orders").select("o_custkey", "o_orderkey")
    returned = t(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    customers = t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return J.mapped_then_new(customers, orders, "o_custkey", "o_orderkey", returned).groupBy("c_nationkey").agg(F.count("*").alias("n"))


@query
def q_bridge_coalesce(spark, d):
    rows = t(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nationkey"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).otherwise("").alias("n_name"))
    return J.bridged(rows, t(spark, d, "nation").select(F.col("n_nationkey").alias("nationkey"), "n_name"), "nationkey", "n_name").select("c_custkey", "n_name")


@query
def q_first_key(spark, d):
    gold = t(spark, d, "supplier").select(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_suppkey")).alias("a"), F.when(F.col("s_suppkey") % 2 == 1, F.col("s_nationkey").cast("long")).alias("b"), "s_name")
    rows = t(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("a"), F.col("c_nationkey").cast("long").alias("b"))
    joined = J.by_first_key(rows, gold, ["a", "b"], "s_name", lambda names: F.array_join(F.sort_array(names), ","))
    return joined.select("c_custkey", F.col("s_name").alias("names"))


@query
def q_fuzzy_exists(spark, d):
    key, word = F.col("doc_id"), F.regexp_extract("text", "^[A-Za-z]+", 0)
    numbers = F.array_join(notation.positions("text"), " ")
    notes = t(spark, d, "documents").select("doc_id", (key % 40).alias("pmid"), F.concat(F.lit("c."), (F.col("n_chars") % 900).cast("string")).alias("coding"), word.alias("protein"), numbers.alias("mention"))
    model = t(spark, d, "benchmark").select((F.col("item_id") % 40).alias("pmid"), F.concat(F.lit("c."), (F.col("item_id") * 7 % 900).cast("string")).alias("coding"), word.alias("protein"))
    return A.with_group_count(J.covered(notes, model), ["pmid"], "of_pmid").select("doc_id", "of_pmid", F.col("covered").cast("int").alias("covered"))


@query
def q_coverage(spark, d):
    rows = t(spark, d, "documents").join(t(spark, d, "labels").select("doc_id").distinct().withColumn("_x", F.lit(True)), "doc_id", "left").withColumn("covered", F.coalesce("_x", F.lit(False)))
    return A.coverage(rows, "covered").select("n", "covered", F.round("share", 9).alias("share"))


@query
def q_map_literal(spark, d):
    level = R.enum_mapped("o_orderpriority", {"1-URGENT": "TOP", "2-HIGH": "TOP", "3-MEDIUM": "MID"}, "REST")
    return t(spark, d, "orders").groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query
def q_top1_scored(spark, d):
    parts = t(spark, d, "part").select("p_brand", F.col("p_name").alias("pheno"), "p_partkey")
    scored = parts.withColumn("score", notation.word_overlap("p_brand", "pheno") + notation.word_overlap("pheno", F.lit("blue green Brand part metal widget")))
    return R.top_scored(scored, ["p_brand"], "score", ["p_partkey"]).select("p_brand", "p_partkey", F.round("score", 9).alias("score"))


@query
def q_disease_ids(spark, d):
    asked = t(spark, d, "nation").select(F.col("n_name").alias("gene"), F.concat_ws(" ", F.lit("syndrome"), "n_name").alias("disease"))
    rows = t(spark, d, "supplier").where("s_nationkey > 5").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    entries = rows.groupBy(F.col("n_name").alias("gene")).agg(F.array_sort(F.collect_list(F.struct("s_suppkey", F.concat(F.when(F.col("s_suppkey") % 3 == 0, "{").otherwise(""), F.lit("syndrome "), F.when(F.col("s_suppkey") % 5 == 0, F.col("n_name")).otherwise("other")).alias("p"), F.when(F.col("s_suppkey") % 2 == 0, (100000 + F.col("s_suppkey")).cast("string")).otherwise("x").alias("i")))).alias("x"))
    genes = entries.select("gene", F.array_join("x.p", ";").alias("phenotypes"), F.array_join("x.i", ";").alias("ids"))
    return J.disease_ids(asked, genes).select("gene", "id", "tag")


@query
def q_precise_list(spark, d):
    hits = t(spark, d, "documents").select(F.col("doc_id").alias("pmid"), "source")
    labels = t(spark, d, "labels").where("quality = 0").select(F.col("doc_id").alias("pmid"))
    items = t(spark, d, "benchmark").select(F.col("item_id").alias("pmid"))
    return J.precise_list(hits, F.col("source") == "src0", labels, items)


@query
def q_set_ops(spark, d):
    a, b = t(spark, d, "documents").select("doc_id"), t(spark, d, "labels").select("doc_id")
    c = t(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"))
    made = {"union": b.union(c).distinct(), "both": a.intersect(b), "only": a.exceptAll(b).distinct()}
    out = None
    for name, df in made.items():
        own = df.agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids")).withColumn("set", F.lit(name))
        out = own if out is None else out.unionByName(own)
    return out


@query
def q_value_counts(spark, d):
    return A.value_counts(t(spark, d, "events"), "event_type", "unclear")


@query
def q_cond_counts(spark, d):
    return A.conditional_counts(t(spark, d, "labels"), good=F.col("quality") == 1, bad=F.col("quality") == 0, toxic_good=(F.col("toxic") == 1) & (F.col("quality") == 1))


@query
def q_global_stats(spark, d):
    return t(spark, d, "documents").agg(F.count("*").alias("n"), F.round(F.avg("n_chars"), 6).alias("mean_chars"), F.count_distinct("source").alias("sources"))


@query
def q_group_index(spark, d):
    return A.grouped_index(t(spark, d, "conversations"), "conv_id", "role", "roles").select("conv_id", F.array_join("roles", ",").alias("roles"))


@query
def q_summary_stack(spark, d):
    rows = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left").select("lang", "source", F.coalesce(F.col("quality").cast("string"), F.lit("none")).alias("quality"))
    return A.summary(rows, ["lang", "source", "quality"])


@query
def q_prf1(spark, d):
    tokens = lambda df, key: df.select((F.col(key) % 4).alias("k"), F.explode(F.split(F.lower("text"), " ")).alias("w")).where("w <> ''")
    scores = A.set_scores(tokens(t(spark, d, "benchmark"), "item_id"), tokens(t(spark, d, "documents"), "doc_id"), ["k"], "w")
    return scores.select("tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query
def q_keys_without(spark, d):
    return A.keys_without(t(spark, d, "events"), "user_id", (F.col("event_type") == "purchase") & (F.col("value") > 90))


@query
def q_keep_first(spark, d):
    return R.keep_first(t(spark, d, "documents"), ["lang", "text"], ["doc_id"]).groupBy("lang").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query
def q_first_label(spark, d):
    return R.first_value(t(spark, d, "events").withColumn("o", F.struct("ts", "event_id")), "user_id", "event_type", "o", "label")


@query
def q_fallback_chain(spark, d):
    full = t(spark, d, "documents").where("n_chars > 2000").select(F.col("doc_id").alias("id"), "n_chars")
    short = t(spark, d, "documents").where("n_chars > 500").select(F.col("doc_id").alias("id"), "n_chars")
    return R.prioritised((full, "full"), (short, "short"), key="id").groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query
def q_batching(spark, d):
    return R.in_batches(t(spark, d, "documents").select("doc_id", "source"), "doc_id", 7, ["source"]).groupBy("source", "batch").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))


@query
def q_running_total(spark, d):
    rows = t(spark, d, "events").select("user_id", "event_id", F.floor("value").cast("long").alias("v"))
    return R.running_total(rows, "v", ["event_id"], ["user_id"], "total").select("event_id", "total")


@query
def q_views_split(spark, d):
    action = F.col("action")
    views = {"all": F.lit(True), "kept": action == "KEEP", "excluded": action.startswith("EXCLUDE"), "review": action.startswith("REVIEW"), "german": F.col("lang") == "de"}
    return R.in_views(qc_documents(spark, d), views).groupBy("view").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query
def q_stub_upsert(spark, d):
    labels = t(spark, d, "labels").select("doc_id", "quality", F.lit("v9").alias("origin"))
    docs = t(spark, d, "documents").select("doc_id", F.lit("new").alias("origin"))
    return J.insert_absent(labels, docs, ["doc_id"]).where(F.coalesce("origin", F.lit("")) != "v9").agg(F.count("*").alias("n"), F.count("quality").alias("known"), F.sum("doc_id").alias("ids"))


@query
def q_stream_append(spark, d):
    from quillmill.sources.files import scratch
    from quillmill.streaming.incremental import append_new

    root = scratch(spark)
    schema = t(spark, d, "events").schema
    flags = lambda df: df.select("event_id", "event_type", F.floor("value").cast("long").alias("v"))
    for _ in range(2):  # a second run finds nothing new
        append_new(spark, d, schema, f"{root}/sink", f"{root}/state", ["event_id"], flags, side=(F.col("v") > 50, f"{root}/side"), reject=(F.col("v").isNull(), f"{root}/bad"), pattern="events.parquet")
    return spark.read.parquet(f"{root}/sink").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@query
def q_llm_mock(spark, d):
    docs = t(spark, d, "documents").select("doc_id", F.col("text").alias("abstract"))
    scored = models.with_reply(docs, "abstract", models.keyword_scorer({"secret": SECRET, "licence": LICENCE, "the": THE}))
    return scored.select("doc_id", F.col("reply").cast("double").alias("score"), text.band(F.col("reply").cast("double")).alias("band"))


@query
def q_flagship(spark, d):
    docs = qc_documents(spark, d)
    labelled = J.last_wins_lookup(docs, t(spark, d, "labels").select("doc_id", "quality", "toxic"), ["doc_id"], "quality", ["toxic", "quality"], -1)
    return R.keep_first(labelled, ["lang", "text"], ["doc_id"]).groupBy("lang", "action", "quality").agg(F.count("*").alias("n")).orderBy("lang", "action", "quality")
