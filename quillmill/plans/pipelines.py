"""The curation, augmentation, audit and evaluation plans, as lazy chains of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.functions import detectors as D
from quillmill.functions.notation import coding_key, is_relevant, loose_boolean, one_of, parsed_id, valid_coding, valid_protein
from quillmill.functions.text import all_text, as_text, clean, has, joined, keys_matching, map_text, tiered_match
from quillmill.operators import curation as C
from quillmill.operators.aggregates import coverage, set_scores
from quillmill.operators.joins import by_first_key, covered, last_wins_lookup, new_rows, precise_list
from quillmill.operators.rows import flattened, keep_first, union_by_name

KEYS = ("gene", "pmid", "hgvs_coding")


def curate(rows: DataFrame, validation: DataFrame, added: DataFrame | None = None, order: str = "_ord") -> DataFrame:
    """Curated rows with QC and classification; `added` rows come with their flags set and skip QC."""
    quality = validation.withColumn("grobid_context_quality", C.context_quality())
    checked = last_wins_lookup(C.with_qc(rows), quality, KEYS, "grobid_context_quality", [order])
    if added is not None:
        checked = union_by_name(checked, added)
    return C.with_reclassification(checked)


def augment(extractions: DataFrame, base: DataFrame, source: str, order: str = "_ord") -> tuple[DataFrame, DataFrame]:
    """(new, duplicates) findings of human genes, validated and classified by notation."""
    good = extractions.where(clean("error") == "") if "error" in extractions.columns else extractions
    rows = flattened(good, ["pmid", "pmcid", "title", order], "findings")
    kept = rows.withColumns({"gene": clean("gene"), "pmid": clean("pmid"), "hgvs_coding": valid_coding("hgvs_coding"), "hgvs_protein": valid_protein("hgvs_protein"), "class": one_of("class", ("H", "N"), "N"), "is_human": loose_boolean("is_human")})
    kept = kept.where((F.length("gene") >= 2) & F.col("is_human"))
    fresh, repeated = new_rows(kept, all_text(base.select(*KEYS)), KEYS, [order, "hgvs_protein"])
    variant = C.class_from_notation()
    classed = fresh.withColumns({"primary_variant_class": variant, "augmentation_source": F.lit(source)}).withColumn("stop_loss_subtype", C.subtype_from_notation("hgvs_protein", F.col("primary_variant_class")))
    return classed, repeated


def publish(base: DataFrame, augmented: DataFrame, order: str = "_ord") -> DataFrame:
    """Base and augmented rows, the base first; of equal (gene, pmid, coding, protein) the first stays."""
    first = base.withColumns({"augmentation_source": F.lit("base"), "_part": F.lit(0)})
    second = C.with_augmented_defaults(augmented).withColumn("_part", F.lit(1))
    return keep_first(union_by_name(first, second), [*KEYS, "hgvs_protein"], ["_part", order]).drop("_part")


def task_views() -> dict:
    """The views of the published table."""
    core, task = F.col("include_in_core_task_dataset"), F.col("primary_gof_task")
    return {
        "all_variants": F.lit(True), "core_frameshift": (core == "YES") & (task == "FRAMESHIFT_GOF"), "core_stop_gain": (core == "YES") & (task == "STOP_GAIN_GOF"),
        "core_stop_loss": (core == "YES") & (task == "STOP_LOSS_GOF"), "review": core == "REVIEW", "excluded": core == "NO",
    }


def quick_view(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in ("gene", "hgvs_coding", "hgvs_protein", "primary_variant_class", "primary_gof_task", "hn_call", "include_in_core_task_dataset", "pmid", "title") if c in df.columns])


def audit_hits(docs: DataFrame, tiers: list[tuple[str, str]] = D.TIERS, sections: str = "sections") -> DataFrame:
    """Documents in which a tier matches: best tier, matched terms, sections with a match of their own."""
    found = tiered_match(map_text(sections), tiers)
    any_tier = "|".join(p for _, p in tiers)
    out = docs.withColumn("_m", found).where("_m.best <> ''")
    return out.select("pmid", "pmcid", F.left(as_text("title"), F.lit(120)).alias("title"), F.col("_m.best").alias("best_tier"), F.col("_m.matched").alias("matched_terms"), keys_matching(sections, any_tier).alias("hit_sections"))


def audit_gap(corpus: DataFrame, corpus_hits: DataFrame, found: DataFrame, task: DataFrame, broad: tuple[str, ...] = ("HGVS_ext",)) -> tuple[DataFrame, DataFrame]:
    """(all new ids, the precise ones) to extract from.

    All: found by a search and not in the corpus, or a corpus hit, and not in
    the task. Precise: not found by broad queries alone, and of the corpus hits
    those of the first two tiers.
    """
    new = precise_list(found, F.lit(False), corpus, task).union(precise_list(corpus_hits, F.lit(False), task)).distinct()
    sure = precise_list(found, F.col("query_label").isin(*broad), corpus, task)
    return new, sure.union(precise_list(corpus_hits, ~F.col("best_tier").isin("tier1", "tier2"), task)).distinct()


def evaluate_recall(annotations: DataFrame, model: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(annotations with `covered`, coverage, missed in claim context, ids without any model row)."""
    parsed = parsed_id("normalized_id")
    relevant = annotations.where(is_relevant("mention_text", "normalized_id")).withColumns({"coding": parsed["coding"], "protein": parsed["protein"], "mention": F.col("mention_text")})
    own = model.select("pmid", F.col("hgvs_coding").alias("coding"), F.col("hgvs_protein").alias("protein"))
    checked = covered(relevant, own)
    missed = checked.where(~F.col("covered") & has(joined("context_text"), D.CLAIM_CONTEXT))
    unseen = relevant.select("pmid").distinct().join(model.select("pmid").distinct(), "pmid", "left_anti")
    return checked, coverage(checked, "covered"), missed, unseen


def evaluate_gold(extractions: DataFrame, gold: DataFrame, field: str = "hgvs_coding", gold_field: str = "HGVS_coding_gold") -> DataFrame:
    """Micro precision, recall and F1 of one field; gold is found by pmid, else by doi; papers without gold are left out."""
    keyed = gold.select(F.nullif(clean("pmid"), F.lit("")).alias("pmid"), F.nullif(F.lower(clean("doi")), F.lit("")).alias("doi"), coding_key(gold_field).alias("value"))
    papers = extractions.withColumns({"pmid": clean("pmid"), "doi": F.lower(clean("doi"))})
    with_gold = by_first_key(papers.select("pmid", "doi").distinct(), keyed, ["pmid", "doi"], "value").where("value is not null")
    wanted = with_gold.select("pmid", "doi", F.explode("value").alias("value")).where("value <> ''")
    own = flattened(papers, ["pmid", "doi"], "findings").select("pmid", "doi", coding_key(field).alias("value")).where("value <> ''")
    own = own.join(with_gold.select("pmid", "doi"), ["pmid", "doi"], "left_semi")
    return set_scores(wanted, own, ["pmid", "doi"], "value")
