from pyspark.sql import functions as F

from quillmill.operators import aggregates as A
from quillmill.operators import curation as C
from quillmill.operators import joins as J
from quillmill.operators import rows as R
from quillmill.plans import pipelines as P


def qc(spark, **fields):
    return C.with_qc(spark.createDataFrame([tuple(fields.values())], ", ".join(f"{k} string" for k in fields))).first()


def test_every_qc_branch(spark):
    cases = [
        (dict(gene="X", evidence_text="in Zea mays"), "EXCLUDE_NONHUMAN_EVIDENCE"),
        (dict(gene="LOXL2", evidence_text="mutant loricrin"), "EXCLUDE_GENE_EVIDENCE_MISMATCH"),
        (dict(gene="OPA1", pmid="14961560"), "REVIEW_POSSIBLE_LOF_HAPLOINSUFFICIENCY"),
        (dict(gene="X", evidence_text="no gain-of-function, but toxic gain"), "REVIEW_MECHANISM"),
        (dict(gene="X", evidence_text="No GOF effect"), "EXCLUDE_NO_GOF_EVIDENCE"),
        (dict(gene="EMD", evidence_text="hypermorph"), "REVIEW_MECHANISM"),
        (dict(gene="EMD", evidence_text=None), "EXCLUDE_NON_GOF_LOF"),
        (dict(gene="TBX6", evidence_text="loss of function"), "EXCLUDE_NON_GOF_LOF"),
        (dict(gene="TBX6", evidence_text="loss of function, dominant negative"), "KEEP"),
        (dict(gene="KCNJ1", pmid="10532965"), "EXCLUDE_NON_GOF_LOF"),
        (dict(gene="KCNJ1", pmid="1", strict_gof_status="NOT_GOF"), "EXCLUDE_NON_GOF_LOF"),
        (dict(gene="KAT6A", pmid=" "), "REVIEW_PMID_MISSING_POSSIBLE_GOF"),
        (dict(gene="ALAS2", pmid=None, hgvs_coding="c.1670_1671TC>GA"), "REVIEW_PMID_MISSING_POSSIBLE_GOF"),
        (dict(gene="X", pmid="1"), "KEEP"),
    ]
    for fields, action in cases:
        assert qc(spark, **fields).qc_round1_action == action, fields


def test_round1_flags(spark):
    row = qc(spark, gene="X", pmid="1", curated_mechanism_class="TOXIC_GOF", strict_gof_status="")
    assert (row.include_in_final_dataset_round1, row.include_in_strict_HN_analysis_round1, row.hn_view_round1) == ("YES", "YES_NEOMORPH_DN", "INCLUDE")
    row = qc(spark, gene="EMD", curated_mechanism_class="HYPERMORPH")
    assert (row.curated_mechanism_class_round1, row.strict_gof_status_round1, row.hn_view_round1) == ("LOSS_OF_FUNCTION_NON_GOF", "EXCLUDED", "EXCLUDE")


def test_reclassification(spark):
    rows = [("NMD_escape", "p.R5fs*2", "", "KEEP", "YES", ""), ("NMD_escape", "p.R5*", "", "KEEP", "YES", ""), ("NMD_escape", "p.R5G", "", "KEEP", "YES", ""), ("stop_loss", "p.*5Glyext*9", "HYPERMORPH_TRUE_GOF", "KEEP", "YES", "a neomorphic effect"), ("frameshift", "", "LOF_MEDIATED_PATHWAY_ACTIVATION", "KEEP", "YES", ""), ("frameshift", "", "QC_FAIL_VARIANT_ID", "KEEP", "REVIEW", ""), ("frameshift", "", "TOXIC_GOF", "EXCLUDE_NO_GOF_EVIDENCE", "NO", "")]
    got = C.with_reclassification(spark.createDataFrame(rows, "final_variant_type string, hgvs_protein string, curated_mechanism_class string, qc_round1_action string, include_in_final_dataset_round1 string, gof_effect string")).collect()
    assert [r.primary_variant_class for r in got] == ["FRAMESHIFT", "STOP_GAIN", "FRAMESHIFT", "STOP_LOSS", "FRAMESHIFT", "QC_FAIL", "FRAMESHIFT"]
    assert [r.include_in_core_task_dataset for r in got] == ["YES", "YES", "YES", "YES", "NO", "REVIEW", "NO"]
    assert got[3].hn_call == "NEOMORPH" and got[3].stop_loss_subtype == "GENETIC_STOP_CODON_LOSS" and got[3].nmd_escape_status == "NOT_APPLICABLE"
    assert got[0].task_reclassification_reason == "NMD_escape hgvs remapped→FRAMESHIFT; mech=; nmd=NMD_ESCAPE_REPORTED"
    assert got[4].primary_gof_task == "OUT_OF_SCOPE_BROAD_GOF" and got[6].gof_evidence_strength == "NO_GOF_SHOWN"


def test_notation_class(spark):
    rows = [("c.1A>G", "p.*278Glyext*19"), ("c.5del", "p.R5G"), ("", "p.Q5fs*2"), ("", "p.R5*"), ("", "p.R5Ter"), ("c.*5A>G", ""), ("c.5fs", ""), ("c.5A>G", "p.R5G"), (None, None)]
    got = spark.createDataFrame(rows, "hgvs_coding string, hgvs_protein string").select(C.class_from_notation()).collect()
    assert [r[0] for r in got] == ["STOP_LOSS", "FRAMESHIFT", "FRAMESHIFT", "STOP_GAIN", "STOP_GAIN", "STOP_GAIN", "FRAMESHIFT", "OTHER", "OTHER"]


def test_last_wins_and_keep_first(spark):
    lookup = spark.createDataFrame([("g", "GOOD", 1), ("g", "", 2), ("h", "BAD", 1)], "k string, v string, _ord int")
    rows = spark.createDataFrame([("g",), ("h",), ("x",)], "k string")
    assert {(r.k, r.v) for r in J.last_wins_lookup(rows, lookup, ["k"], "v", ["_ord"]).collect()} == {("g", ""), ("h", "BAD"), ("x", "")}
    first = R.keep_first(lookup, ["k"], ["_ord"])
    assert sorted((r.k, r.v) for r in first.collect()) == [("g", "GOOD"), ("h", "BAD")]
    assert sorted(map(str, R.keep_first(first, ["k"], ["_ord"]).collect())) == sorted(map(str, first.collect()))
    assert R.losers(lookup, ["k"], ["_ord"]).count() + first.count() == lookup.count()


def test_new_rows_partition_the_input(spark):
    base = spark.createDataFrame([("a", "1")], "g string, p string")
    new, dup = J.new_rows(spark.createDataFrame([("a", "1", 1), ("b", "1", 2), ("b", "1", 3), ("c", "2", 4)], "g string, p string, _ord int"), base, ["g", "p"], ["_ord"])
    assert sorted(r._ord for r in new.collect()) == [2, 4] and sorted(r._ord for r in dup.collect()) == [1, 3]


def test_anti_joins(spark):
    todo, done = spark.createDataFrame([("",), ("a",), ("b",)], "k string"), spark.createDataFrame([("",), ("a",)], "k string")
    assert sorted(r.k for r in J.not_in(todo, done, ["k"], blank_matches=False).collect()) == ["", "b"]
    assert J.not_in(todo, done, ["k"]).count() + J.only_in(todo, done, ["k"]).count() == todo.count()


def test_covered(spark):
    notes = spark.createDataFrame([("1", "c.5A>G", "", "x"), ("1", "", "p.R9X", "y"), ("1", "", "", "at 77"), ("1", "", "", "at 78"), ("2", "", "", "77")], "pmid string, coding string, protein string, mention string")
    model = spark.createDataFrame([("1", "c.5A>G", ""), ("1", "c.77del", "p.R9X")], "pmid string, coding string, protein string")
    got = {(r.mention): r.covered for r in J.covered(notes, model).collect()}
    assert got == {"x": True, "y": True, "at 77": True, "at 78": False}


def test_disease_ids(spark):
    genes = spark.createDataFrame([("A", "{blue syndrome};red fever;red long fever", "123456;200001;200002"), ("B", "x", "12")], "gene string, phenotypes string, ids string")
    asked = spark.createDataFrame([("A", "Red fever"), ("A", "red spots"), ("A", "zzz yyy xxx"), ("A", ""), ("B", "x"), ("C", "x")], "gene string, disease string")
    got = {(r.gene, r.disease): (r.id, r.tag) for r in J.disease_ids(asked, genes).collect()}
    assert got == {("A", "Red fever"): ("200001", "exact"), ("A", "red spots"): ("200001", "partial:0.50"), ("A", "zzz yyy xxx"): ("200001", "first_valid"), ("A", ""): ("200001", "first_valid"), ("B", "x"): (None, "no_valid_id"), ("C", "x"): (None, "not_found")}


def test_scores(spark):
    gold, pred = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b")], "k int, v string"), spark.createDataFrame([(1, "a"), (1, "c"), (2, "a")], "k int, v string")
    row = A.set_scores(gold, pred, ["k"], "v").first()
    assert (row.tp, row.fp, row.fn, row.recall) == (1, 2, 1, 0.5)
    empty = A.set_scores(gold.limit(0), pred.limit(0), ["k"], "v").first()
    assert (empty.tp, empty.precision, empty.f1) == (0, 0.0, 0.0)


def test_columns_and_views(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, s string"), spark.createDataFrame([(2,)], "id int")
    assert sorted((r.id, r.s) for r in R.union_by_name(a, b).collect()) == [(1, "x"), (2, "")]
    assert R.reordered(a.withColumns({"qc_a": F.lit(1), "z": F.lit(2)}), ["z"], ["qc_"]).columns == ["z", "qc_a", "id", "s"]
    views = R.in_views(a, {"all": F.lit(True), "none": F.lit(False), "null": F.lit(None).cast("boolean")})
    assert [r.view for r in views.collect()] == ["all"]


FINDING = "struct<gene:string,hgvs_coding:string,hgvs_protein:string,class:string,is_human:string>"


def test_plans(spark):
    curated = P.curate(
        spark.createDataFrame([("A", "1", "c.1A>G", "frameshift", 1), ("EMD", "2", "", "stop_gain", 2)], "gene string, pmid string, hgvs_coding string, final_variant_type string, _ord int"),
        spark.createDataFrame([("A", "1", "c.1A>G", "true", "s", "true", 1), ("A", "1", "c.1A>G", "", "", "", 2)], "gene string, pmid string, hgvs_coding string, grobid_variant_found string, grobid_snippet string, grobid_gof_cue_found string, _ord int").withColumn("grobid_variant_context", F.lit("")),
    )
    assert sorted((r.gene, r.grobid_context_quality, r.include_in_core_task_dataset) for r in curated.collect()) == [("A", "", "YES"), ("EMD", "", "NO")]
    docs = spark.createDataFrame([("9", "p", "t", 1, [("A", "c.5del", "", "H", "true"), (None, "c.5del", "", "H", None), ("BB", "g.1", "x", "q", "false"), ("CC", "g.1", "p.R5*", "q", None), ("CC", "", "p.R5*", "N", None)])], f"pmid string, pmcid string, title string, _ord int, findings array<{FINDING}>")
    new, dup = P.augment(docs, curated, "stoploss_v1")
    assert [(r.gene, r.hgvs_coding, r["class"], r.primary_variant_class) for r in new.collect()] == [("CC", "", "N", "STOP_GAIN")] and dup.count() == 1
    published = P.publish(curated, new)
    assert published.count() == 3 and sum(r.augmentation_source == "stoploss_v1" for r in published.collect()) == 1
    yes, review, no = (published.where(F.col("include_in_core_task_dataset") == x).count() for x in ("YES", "REVIEW", "NO"))
    assert yes + review + no == published.count() and "gene" in P.quick_view(published).columns


def test_audit_and_evaluation(spark):
    docs = spark.createDataFrame([("1", "c", "t", {"results": "a stop-loss variant", "methods": "x"}), ("2", "d", "u", {"results": "none"})], "pmid string, pmcid string, title string, sections map<string,string>")
    hits = P.audit_hits(docs)
    assert [(r.pmid, r.best_tier, r.hit_sections) for r in hits.collect()] == [("1", "tier1", "results")]
    found = spark.createDataFrame([("5", "SL_direct"), ("6", "HGVS_ext"), ("1", "SL_direct")], "pmid string, query_label string")
    new, sure = P.audit_gap(docs, hits, found, spark.createDataFrame([("9",)], "pmid string"))
    assert sorted(r.pmid for r in new.collect()) == ["1", "5", "6"] and sorted(r.pmid for r in sure.collect()) == ["1", "5"]
    notes = spark.createDataFrame([("1", "R5X", "#1#p.R5X", "toxic gain"), ("3", "frameshift at 7", "", "")], "pmid string, mention_text string, normalized_id string, context_text string")
    model = spark.createDataFrame([("1", "c.9del", "p.R6X")], "pmid string, hgvs_coding string, hgvs_protein string")
    checked, share, missed, unseen = P.evaluate_recall(notes, model)
    assert (share.first().n, missed.count(), [r.pmid for r in unseen.collect()]) == (1, 1, ["3"])
    gold = spark.createDataFrame([("1", "", "c.5delA"), ("", "10.1/X", "c.7dup")], "pmid string, doi string, HGVS_coding_gold string")
    out = spark.createDataFrame([("1", "", [("A", "c.5del", "", "H", "")]), ("2", "10.1/x", [("A", "c.8dup", "", "H", "")]), ("4", "", [("A", "c.1del", "", "H", "")])], f"pmid string, doi string, findings array<{FINDING}>")
    row = P.evaluate_gold(out, gold).first()
    assert (row.tp, row.fp, row.fn) == (1, 1, 1)
