"""The rules over cases written out one by one."""

from pyspark.sql import functions as F

from quillmill.functions import detectors as D
from quillmill.functions import text
from quillmill.operators import curation as C
from quillmill.operators import rows as R
from quillmill.sources import readers, services

_QC_CASES = [
    (1, "X", "1", "", "", "in Zea mays", "EXCLUDE_NONHUMAN_EVIDENCE"), (2, "LOXL2", "1", "", "", "mutant loricrin", "EXCLUDE_GENE_EVIDENCE_MISMATCH"), (3, "OPA1", "14961560", "", "", None, "REVIEW_POSSIBLE_LOF_HAPLOINSUFFICIENCY"),
    (4, "X", "1", "", "", "no gain-of-function, but toxic gain", "REVIEW_MECHANISM"), (5, "X", "1", "", "", "No GOF effect", "EXCLUDE_NO_GOF_EVIDENCE"), (6, "EMD", "1", "", "", "hypermorph", "REVIEW_MECHANISM"),
    (7, "EMD", "1", "", "", None, "EXCLUDE_NON_GOF_LOF"), (8, "TBX6", "1", "", "", "loss of function", "EXCLUDE_NON_GOF_LOF"), (9, "TBX6", "1", "", "", "loss of function, dominant negative", "KEEP"),
    (10, "KCNJ1", "10532965", "", "", "", "EXCLUDE_NON_GOF_LOF"), (11, "KCNJ1", "1", "", "NOT_GOF", "", "EXCLUDE_NON_GOF_LOF"), (12, "KAT6A", " ", "", "", "", "REVIEW_PMID_MISSING_POSSIBLE_GOF"),
    (13, "ALAS2", None, "c.1670_1671TC>GA", "", "", "REVIEW_PMID_MISSING_POSSIBLE_GOF"), (14, "X", "1", "", "", "", "KEEP"), (15, "CLCN2", "1", "", "", "a locked closed state", "KEEP"), (16, "LRRC8A", "1", "", "", "slightly diminish the VRAC current", "KEEP"),
    (17, "CLCN2", "1", "", "", "a locked closed conformation", "EXCLUDE_NON_GOF_LOF"), (18, "LRRC8A", "1", "", "", "slightly diminish the VRAC activity", "EXCLUDE_NON_GOF_LOF"),
]

_DETECTOR_CASES = [
    (1, "Oryza sativa plants", "non_human"), (2, "dCREB gene", "non_human"), (3, "it lacks any real gain-of-function", "negated_claim,claim,claim_context"), (4, "locked-closed", "loss"), (5, "a locked closed state", ""), (6, "diminish the VRAC", ""),
    (7, "loricrin", "mismatch"), (8, "purchased from a shop", "bad_section"), (9, "nonsense-mediated decay", "decay"), (10, "NEOMORPHIC", "claim,new_function,claim_context"), (11, "it aggregates", "claim_context"), (12, "", ""), (13, None, ""),
]

_CONTEXT_CASES = [(1, "False", "seen", "", "true", ""), (2, "TRUE", "purchased from x", "", "true", "BAD_SECTION"), (3, "true", "", "a.b@lab.edu", "", "BAD_SECTION"), (4, "true", "p.R5* activates", "", "True", "GOOD"), (5, "true", "p.R5*", "", None, "VARIANT_ONLY_NO_GOF"), (6, None, "", "", "", "")]


def test_cascade_cases(spark):
    names = ("id", "gene", "pmid", "hgvs_coding", "strict_gof_status", "evidence_text")
    rows = readers.literal(spark, [dict(zip(names, c)) for c in _QC_CASES], "id long, gene string, pmid string, hgvs_coding string, strict_gof_status string, evidence_text string")
    got = {r.id: (r.qc_round1_action, r.include_in_final_dataset_round1) for r in C.with_qc(rows).collect()}
    assert got == {c[0]: (c[6], "YES" if c[6] == "KEEP" else "NO" if c[6].startswith("EXCLUDE") else "REVIEW") for c in _QC_CASES}


def test_detector_cases(spark):
    rows = readers.literal(spark, [{"id": i, "s": s} for i, s, _ in _DETECTOR_CASES], "id long, s string")
    flagged = rows.select("id", *D.detected("s", **D.DETECTORS))
    got = {r.id: r.found for r in flagged.select("id", F.concat_ws(",", *[F.when(F.col(n), n) for n in D.DETECTORS]).alias("found")).collect()}
    assert got == {i: found for i, _, found in _DETECTOR_CASES}


def test_context_cases(spark):
    names = ("id", "grobid_variant_found", "grobid_snippet", "grobid_variant_context", "grobid_gof_cue_found")
    rows = readers.literal(spark, [dict(zip(names, c)) for c in _CONTEXT_CASES], "id long, grobid_variant_found string, grobid_snippet string, grobid_variant_context string, grobid_gof_cue_found string")
    assert {r.id: r.quality for r in rows.select("id", C.context_quality().alias("quality")).collect()} == {c[0]: c[5] for c in _CONTEXT_CASES}


def test_columns_order(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert R.reordered(df, ["source", "lang", "none"], ["n_"]).columns == ["source", "lang", "n_chars", "doc_id", "text"]


def test_paged_search(spark):
    found = lambda asked, year, at, size: (95, [str(i) for i in range(at, min(95, at + size))])
    spark.dataSource.register(services.paged_search(found, cap=60, page=25))
    rows = spark.read.format("paged_search").option("query", "x").load().collect()
    assert sorted(int(r.id) for r in rows) == list(range(60)) and {r.total for r in rows} == {95}
    assert text.search_query([["a", "b c"], ["d"]], "english", 2000, 2003) == '(("a"[Title/Abstract] OR "b c"[Title/Abstract]) OR ("d"[Title/Abstract])) AND english[Language] AND 2000:2003[dp]'
