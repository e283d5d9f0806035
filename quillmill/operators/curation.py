"""The curation rules: quality control, derived flags, reclassification, defaults.

Enumerations and reasons are fixed values. Each function returns a column over
the curated table's columns; all are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import detectors as D
from quillmill.functions.text import as_text, clean, has, holds_after_removing, joined, reason
from quillmill.operators.cascade import Cascade, Rule, choose
from quillmill.operators.rows import add_absent, add_missing, enum_mapped

LOSS_ONLY_GENES = ("BSG", "CFHR5", "TBX6", "CLCN2", "LRRC8A")
TASK = {"FRAMESHIFT": "FRAMESHIFT_GOF", "STOP_GAIN": "STOP_GAIN_GOF", "STOP_LOSS": "STOP_LOSS_GOF", "QC_FAIL": "REVIEW", "OTHER": "OUT_OF_SCOPE_BROAD_GOF"}
STRENGTH = {"direct_functional": "DIRECT_FUNCTIONAL", "literature_claim_only": "STRONG_ASSERTION", "inferred_from_HGVS": "INFERRED_ONLY", "indirect_pathway": "INFERRED_ONLY", "insufficient": "UNCERTAIN", "qc_fail": "NO_GOF_SHOWN"}
CALL = {
    "HYPERMORPH_TRUE_GOF": "HYPERMORPH", "DOMINANT_NEGATIVE_ANTIMORPH": "DOMINANT_NEGATIVE_SEPARATE", "TOXIC_GOF": "TOXIC_GOF_SEPARATE", "NMD_ESCAPE_EFFECT_REVIEW": "NMD_ESCAPE_GOF_REVIEW",
    "LOSS_OF_FUNCTION_NON_GOF": "NON_GOF", "LOF_MEDIATED_PATHWAY_ACTIVATION": "NON_GOF", "QC_FAIL_VARIANT_ID": "REVIEW", "UNCERTAIN_OR_CONFLICTING": "REVIEW",
}
QC_COLUMNS = ("gene", "pmid", "hgvs_coding", "hgvs_protein", "strict_gof_status", "gof_effect", "evidence_text", "title", "curated_mechanism_class", "final_variant_type", "evidence_strength")


def qc_cascade() -> Cascade:
    """Non-human, mismatch, catalogue, negation, loss genes, missing ids; else KEEP."""
    gene, pmid, strict = clean("gene"), clean("pmid"), clean("strict_gof_status")
    text = joined("gof_effect", "evidence_text", "title")
    claim, negated = has(text, D.CLAIM), has(text, D.NEGATED_CLAIM)
    still = holds_after_removing(text, D.NEGATED_CLAIM, D.CLAIM)
    return Cascade(
        [
            Rule(has(text, D.NON_HUMAN), "EXCLUDE_NONHUMAN_EVIDENCE", "Evidence/title contains non-human organism context (rice/maize/Drosophila/Daphnia/GS3/NLD/dCREB2)"),
            Rule((gene == "LOXL2") & has(text, D.MISMATCH), "EXCLUDE_GENE_EVIDENCE_MISMATCH", "Gene=LOXL2 but evidence describes loricrin (LOR gene); likely extraction error"),
            Rule((gene == "OPA1") & (pmid == "14961560"), "REVIEW_POSSIBLE_LOF_HAPLOINSUFFICIENCY", "OPA1 frameshift from PMID 14961560 — variant catalogue table; no GOF cue in fulltext (gof_cue=False)"),
            Rule(negated & still, "REVIEW_MECHANISM", "Conflicting: explicit no-GOF statement AND independent GOF keyword present — manual review needed"),
            Rule(negated, "EXCLUDE_NO_GOF_EVIDENCE", "Explicit statement: 'no gain-of-function effect demonstrated' or equivalent"),
            Rule((gene == "EMD") & claim, "REVIEW_MECHANISM", "EMD: LOF disease gene (Emery-Dreifuss MD) but GOF override keyword present — review"),
            Rule(gene == "EMD", "EXCLUDE_NON_GOF_LOF", "EMD: X-linked Emery-Dreifuss MD — emerin loss/haploinsufficiency, no GOF evidence"),
            Rule(gene.isin(*LOSS_ONLY_GENES) & has(text, D.LOSS) & ~claim, "EXCLUDE_NON_GOF_LOF", F.concat(gene, F.lit(": evidence describes LOF/functional reduction only; no GOF override present"))),
            Rule((gene == "KCNJ1") & (pmid == "10532965") & ~claim, "EXCLUDE_NON_GOF_LOF", "KCNJ1 PMID 10532965: nonfunctional locked-closed channel conformation — mechanistic LOF"),
            Rule((gene == "KCNJ1") & (strict == "NOT_GOF"), "EXCLUDE_NON_GOF_LOF", F.concat(F.lit("KCNJ1: strict_gof_status=NOT_GOF (loss-of-function frameshift); PMID "), pmid)),
            Rule((pmid == "") & (gene == "KAT6A"), "REVIEW_PMID_MISSING_POSSIBLE_GOF", "KAT6A: plausible GOF (KAT6A syndrome), but no PMID — cannot validate"),
            Rule((pmid == "") & (gene == "ALAS2") & clean("hgvs_coding").contains("1670_1671"), "REVIEW_PMID_MISSING_POSSIBLE_GOF", "ALAS2 c.1670_1671TC>GA: 'increased specific activities' suggests GOF, but no PMID"),
        ],
        "KEEP",
    )


def context_quality() -> Column:
    """Of an external snippet: empty if the variant was not found, else by section and cue."""
    snippet = F.when(as_text("grobid_snippet") != "", F.col("grobid_snippet")).otherwise(as_text("grobid_variant_context"))
    return choose(
        (F.lower(as_text("grobid_variant_found")) != "true", ""),
        (has(snippet, D.BAD_SECTION), "BAD_SECTION"),
        (F.lower(as_text("grobid_gof_cue_found")) == "true", "GOOD"),
        default="VARIANT_ONLY_NO_GOF",
    )


def with_qc(df: DataFrame) -> DataFrame:
    """df with qc_round1_action, qc_round1_reason and the five flags that follow from them."""
    df = add_missing(df, QC_COLUMNS)
    decided = qc_cascade().decided()
    return with_round1_flags(df.withColumn("_qc", decided).withColumns({"qc_round1_action": F.col("_qc.action"), "qc_round1_reason": F.col("_qc.reason")}).drop("_qc"))


def with_round1_flags(df: DataFrame) -> DataFrame:
    action, mechanism, strict = F.col("qc_round1_action"), clean("curated_mechanism_class"), clean("strict_gof_status")
    excluded, reviewed = action.startswith("EXCLUDE"), action.startswith("REVIEW")
    final = choose((action.isin("KEEP", "ADD"), "YES"), (excluded, "NO"), default="REVIEW")
    analysed = choose(
        (excluded | reviewed, "NO"),
        ((strict == "TRUE_GOF") | mechanism.isin("HYPERMORPH", "HYPERMORPH_TRUE_GOF"), "YES"),
        (mechanism.isin("DOMINANT_NEGATIVE_ANTIMORPH", "NEOMORPH_TRUE_GOF", "TOXIC_GOF", "NMD_ESCAPE_EFFECT_REVIEW", "NMD_ESCAPE") | (strict == "ANTIMORPH_DN"), "YES_NEOMORPH_DN"),
        default="REVIEW",
    )
    return df.withColumns({
        "curated_mechanism_class_round1": choose((action.isin("EXCLUDE_NON_GOF_LOF", "EXCLUDE_NO_GOF_EVIDENCE"), "LOSS_OF_FUNCTION_NON_GOF"), (action == "EXCLUDE_NONHUMAN_EVIDENCE", "NON_HUMAN_EXCLUDE"), (action == "EXCLUDE_GENE_EVIDENCE_MISMATCH", "GENE_EVIDENCE_MISMATCH"), default=mechanism),
        "strict_gof_status_round1": choose((excluded, "EXCLUDED"), default=strict),
        "include_in_final_dataset_round1": final,
        "include_in_strict_HN_analysis_round1": analysed,
        "hn_view_round1": choose((analysed.isin("YES", "YES_NEOMORPH_DN"), "INCLUDE"), (final == "NO", "EXCLUDE"), default="REVIEW"),
    })


def with_reclassification(df: DataFrame) -> DataFrame:
    """The nine classification columns; each level may read those before it."""
    df = add_missing(df, (*QC_COLUMNS, "qc_round1_action", "include_in_final_dataset_round1"))
    kind, mechanism, protein, qc = as_text("final_variant_type"), as_text("curated_mechanism_class"), as_text("hgvs_protein"), as_text("qc_round1_action")
    effect, excluded = as_text("gof_effect"), as_text("qc_round1_action").startswith("EXCLUDE")
    escape = kind == "NMD_escape"
    df = df.withColumn("primary_variant_class", choose(
        (mechanism == "QC_FAIL_VARIANT_ID", "QC_FAIL"), (kind == "frameshift", "FRAMESHIFT"), (kind == "stop_gain", "STOP_GAIN"), (kind == "stop_loss", "STOP_LOSS"),
        (escape & ~has(protein, D.FRAMESHIFT) & has(protein, D.STOP), "STOP_GAIN"), (escape, "FRAMESHIFT"), default="OTHER",
    ))
    variant = F.col("primary_variant_class")
    df = df.withColumns({
        "stop_loss_subtype": choose((variant != "STOP_LOSS", "NOT_APPLICABLE"), (has(protein, "ext"), "GENETIC_STOP_CODON_LOSS"), default="NONSTOP_EXTENSION"),
        "primary_gof_task": choose((excluded | (mechanism == "LOSS_OF_FUNCTION_NON_GOF"), "NON_GOF_EXCLUDE"), (mechanism == "LOF_MEDIATED_PATHWAY_ACTIVATION", "OUT_OF_SCOPE_BROAD_GOF"), default=enum_mapped(variant, TASK, "REVIEW")),
        "gof_due_to_variant": choose(
            (qc.isin("EXCLUDE_NO_GOF_EVIDENCE", "EXCLUDE_NON_GOF_LOF", "EXCLUDE_NONHUMAN_EVIDENCE", "EXCLUDE_GENE_EVIDENCE_MISMATCH") | mechanism.isin("LOSS_OF_FUNCTION_NON_GOF", "QC_FAIL_VARIANT_ID"), "NO"),
            ((mechanism == "UNCERTAIN_OR_CONFLICTING") | (qc == "REVIEW_MECHANISM"), "CONFLICTING"),
            (mechanism.isin("HYPERMORPH_TRUE_GOF", "DOMINANT_NEGATIVE_ANTIMORPH", "TOXIC_GOF"), "YES"), default="REVIEW",
        ),
        "gof_evidence_strength": choose((mechanism == "LOSS_OF_FUNCTION_NON_GOF", "CONTRADICTS_GOF"), (qc == "EXCLUDE_NO_GOF_EVIDENCE", "NO_GOF_SHOWN"), default=enum_mapped(as_text("evidence_strength"), STRENGTH, "UNCERTAIN")),
        "nmd_escape_status": choose(
            ((variant == "STOP_LOSS") | (mechanism == "QC_FAIL_VARIANT_ID"), "NOT_APPLICABLE"), (escape, "NMD_ESCAPE_REPORTED"), (mechanism == "NMD_ESCAPE_EFFECT_REVIEW", "NMD_ESCAPE_INFERRED"),
            (mechanism == "LOSS_OF_FUNCTION_NON_GOF", "NMD_SENSITIVE_OR_DEGRADED"), (has(joined("gof_effect", "evidence_text"), D.DECAY), "NMD_ESCAPE_INFERRED"), default="UNKNOWN",
        ),
        "hn_call": choose((excluded, "NON_GOF"), ((mechanism == "HYPERMORPH_TRUE_GOF") & has(effect, D.NEW_FUNCTION), "NEOMORPH"), default=enum_mapped(mechanism, CALL, "REVIEW")),
    })
    task, round1 = F.col("primary_gof_task"), as_text("include_in_final_dataset_round1")
    df = df.withColumn("include_in_core_task_dataset", choose(
        (task.isin("NON_GOF_EXCLUDE", "OUT_OF_SCOPE_BROAD_GOF") | (round1 == "NO"), "NO"), ((round1 == "REVIEW") | (task == "REVIEW"), "REVIEW"),
        (task.isin("FRAMESHIFT_GOF", "STOP_GAIN_GOF", "STOP_LOSS_GOF") & (round1 == "YES"), "YES"), default="REVIEW",
    ))
    due, nmd, call, subtype = (F.col(c) for c in ("gof_due_to_variant", "nmd_escape_status", "hn_call", "stop_loss_subtype"))
    return df.withColumn("task_reclassification_reason", reason(
        F.when(escape, F.concat(F.lit("NMD_escape hgvs remapped→"), variant)),
        F.when((task == "NON_GOF_EXCLUDE") & excluded, F.concat(F.lit("QC_excluded:"), qc)).when(task == "NON_GOF_EXCLUDE", "mech=LOF_non_GOF").when((task == "OUT_OF_SCOPE_BROAD_GOF") & (mechanism == "LOF_MEDIATED_PATHWAY_ACTIVATION"), "LOF_mediated_pathway:indirect_GOF_out_of_scope").when(task == "OUT_OF_SCOPE_BROAD_GOF", F.concat(F.lit("variant_type_"), variant, F.lit("_not_primary_task"))),
        F.concat(F.lit("mech="), mechanism),
        F.when(call.isin("DOMINANT_NEGATIVE_SEPARATE", "TOXIC_GOF_SEPARATE", "NMD_ESCAPE_GOF_REVIEW", "NEOMORPH"), F.concat(F.lit("hn_call="), call)),
        F.when(subtype != "NOT_APPLICABLE", F.concat(F.lit("stop_loss_subtype="), subtype)),
        F.when(nmd.isin("NMD_ESCAPE_REPORTED", "NMD_ESCAPE_INFERRED", "NMD_SENSITIVE_OR_DEGRADED"), F.concat(F.lit("nmd="), nmd)),
        F.when(due == "NO", "no_GOF_evidence").when(due == "CONFLICTING", "conflicting_GOF_signals"),
        F.when(qc.startswith("REVIEW"), F.concat(F.lit("qc_flag:"), qc)),
    ))


def class_from_notation(coding: str | Column = "hgvs_coding", protein: str | Column = "hgvs_protein") -> Column:
    """A variant's class from its notation alone; stops in the protein are case-sensitive."""
    c, p = F.lower(as_text(coding)), as_text(protein)
    extended = has(p, D.EXTENSION)
    return choose(
        (extended, "STOP_LOSS"),
        (p.rlike("(?i)fs") | c.rlike("del|dup|ins"), "FRAMESHIFT"),
        (p.rlike(r"[*X]$|Ter$|Ter[0-9]"), "STOP_GAIN"),
        (c.rlike("fs"), "FRAMESHIFT"),
        (c.contains("*"), "STOP_GAIN"),
        default="OTHER",
    )


def subtype_from_notation(protein: str | Column, variant: Column) -> Column:
    return choose((variant != "STOP_LOSS", "NOT_APPLICABLE"), (has(as_text(protein), D.EXTENSION), "GENETIC_STOP_CODON_LOSS"), default="NONSTOP_EXTENSION")


def with_augmented_defaults(df: DataFrame) -> DataFrame:
    """Classification columns that augmented rows lack, from their class."""
    variant, kind = F.col("primary_variant_class"), F.upper(clean("class"))
    three = variant.isin("FRAMESHIFT", "STOP_GAIN", "STOP_LOSS")
    return add_absent(
        df,
        primary_gof_task=enum_mapped(variant, {k: v for k, v in TASK.items() if v.endswith("_GOF") and k != "OTHER"}, "REVIEW"),
        gof_due_to_variant=choose((kind == "H", "YES"), default="REVIEW"),
        gof_evidence_strength=F.lit("STRONG_ASSERTION"),
        nmd_escape_status=choose((variant == "STOP_LOSS", "NOT_APPLICABLE"), default="UNKNOWN"),
        hn_call=choose((kind == "H", "HYPERMORPH"), default="REVIEW"),
        include_in_core_task_dataset=choose((three, "YES"), default="REVIEW"),
        task_reclassification_reason=F.lit("augmented_stoploss_extraction_v1"),
        stop_loss_subtype=F.lit("NOT_APPLICABLE"),
    )
