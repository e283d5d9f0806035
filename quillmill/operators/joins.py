"""Joins: lookups, anti-joins, bridges, existence, scored matches.

No side is broadcast by hint: Spark broadcasts a side whose size it knows to
be small and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.notation import is_disease_id, paired_lists, positions, word_overlap
from quillmill.functions.text import as_text, clean
from quillmill.operators.rows import keep_first, keep_last


def last_wins_lookup(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], default: object = "") -> DataFrame:
    """rows and the value of the last lookup row of their key; a miss gives the default."""
    last = keep_last(lookup, keys, order).select(*keys, value)
    return rows.join(last, list(keys), "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def not_in(rows: DataFrame, done: DataFrame, on: Sequence[str], blank_matches: bool = True) -> DataFrame:
    """Rows whose key is not among the others'; with blank_matches off, rows with a blank key always stay."""
    keys = done.select(*on).distinct()
    if not blank_matches:
        keys = keys.where(F.concat_ws("", *[as_text(c) for c in on]) != "")
    return rows.join(keys, list(on), "left_anti")


def only_in(rows: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    return rows.join(ids.select(*on), list(on), "left_semi")


def new_rows(incoming: DataFrame, base: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(new, duplicates): rows whose key neither the base nor an earlier incoming row has, and the others."""
    known = base.select(*keys).distinct().withColumn("_known", F.lit(True))
    marked = incoming.join(known, list(keys), "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    fresh = keep_first(marked.where("not _known"), keys, order).drop("_known")
    repeated = _rest(marked.where("not _known"), keys, order).drop("_known")
    return fresh, marked.where("_known").drop("_known").unionByName(repeated)


def _rest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    from quillmill.operators.rows import losers

    return losers(df, keys, order)


def mapped_then_new(rows: DataFrame, mapping: DataFrame, key: str, target: str, done: DataFrame) -> DataFrame:
    """Rows with the id that a mapping gives them, without those whose id is done."""
    return not_in(rows.join(mapping.select(key, target), key), done, [target])


def bridged(rows: DataFrame, bridge: DataFrame, key: str, target: str, default: str = "") -> DataFrame:
    """rows with `target` from themselves if not blank, else from the bridge, else the default."""
    found = bridge.select(key, F.col(target).alias("_found"))
    own = F.when(clean(target) != "", F.col(target))
    return rows.join(found, key, "left").withColumn(target, F.coalesce(own, "_found", F.lit(default))).drop("_found")


def by_first_key(rows: DataFrame, gold: DataFrame, keys: Sequence[str], value: str, shape: Callable[[Column], Column] = lambda values: values) -> DataFrame:
    """rows with the gold values of the first key that finds some: a left join for each key, never an OR in one.

    `shape` makes what a row gets of a key's values (an array of distinct ones),
    once for each key and not for each row. Rows that get the same lie together,
    in as many parts as shuffles have, so a file of them holds long lists once.
    """
    out, lists = rows, None
    for i, k in enumerate(keys):
        known = gold.where(F.col(k).isNotNull())
        place = F.struct(F.lit(i).alias("key"), F.col(k).cast("string").alias("of")).alias("_at")
        own = known.groupBy(place).agg(shape(F.collect_set(value)).alias("_found"))
        lists = own if lists is None else lists.union(own)
        out = out.join(known.select(k).distinct().select(k, place.alias(f"_at{i}")), k, "left")
    marks = [f"_at{i}" for i in range(len(keys))]
    out = out.withColumn("_at", F.coalesce(*marks)).drop(*marks)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartitionByRange(parts, "_at", F.xxhash64(*keys)).join(lists, "_at", "left")
    return out.withColumn(value, F.col("_found")).drop("_at", "_found")


def covered(annotations: DataFrame, model: DataFrame, key: str = "pmid") -> DataFrame:
    """annotations (key, coding, protein, mention) that the model has rows for, with `covered`.

    Covered: a model row of the same key has the coding or the protein variant,
    or a number of the mention among its numbers. Each of the three is an
    equi-join with distinct model values, so no pairs within a key are made.
    """
    own = annotations.join(model.select(key).distinct(), key, "left_semi")
    numbers = F.explode(positions(F.concat_ws(" ", as_text("coding"), as_text("protein"))))
    has_coding = model.where(clean("coding") != "").select(key, "coding").distinct().withColumn("_c", F.lit(True))
    has_protein = model.where(clean("protein") != "").select(key, "protein").distinct().withColumn("_p", F.lit(True))
    model_numbers = model.select(key, numbers.alias("number")).distinct()
    hits = own.select(key, "mention", F.explode(positions("mention")).alias("number")).distinct().join(model_numbers, [key, "number"], "left_semi")
    has_number = hits.select(key, "mention").distinct().withColumn("_n", F.lit(True))
    out = own.join(has_coding, [key, "coding"], "left").join(has_protein, [key, "protein"], "left").join(has_number, [key, "mention"], "left")
    found = [F.coalesce(F.col(c), F.lit(False)) for c in ("_c", "_p", "_n")]
    return out.withColumn("covered", found[0] | found[1] | found[2]).drop("_c", "_p", "_n")


def disease_ids(asked: DataFrame, genes: DataFrame, partial: float = 0.5, exact: float = 0.99) -> DataFrame:
    """asked (gene, disease) with (id, tag) from genes (gene, phenotypes, ids: lists parted by ";").

    The valid id whose phenotype shares the most of the disease's words, from a
    share of `partial` on; else the first valid one, one not marked { or ?
    before one that is. Tags: exact, partial:<share>, first_valid, no_valid_id,
    not_found.
    """
    entries = genes.select("gene", F.posexplode(paired_lists("phenotypes", "ids")).alias("_ord", "e")).select("gene", "_ord", F.col("e.left").alias("pheno"), F.col("e.right").alias("id"))
    known = genes.select("gene").distinct().withColumn("_known", F.lit(True))
    pairs = asked.select("gene", "disease").distinct().join(entries.where(is_disease_id("id")), "gene")
    scored = pairs.withColumns({"score": word_overlap("disease", "pheno"), "marked": F.col("pheno").rlike(r"^[{?]").cast("int")})
    best = scored.groupBy("gene", "disease").agg(
        F.min_by(F.struct("id", "score"), F.struct(-F.col("score"), "_ord")).alias("best"),
        F.min_by("id", F.struct("marked", "_ord")).alias("first"),
    )
    hit = (clean("disease") != "") & (F.col("best.score") >= partial)
    tag = F.when(F.col("_known").isNull(), "not_found").when(F.col("first").isNull(), "no_valid_id").when(hit & (F.col("best.score") >= exact), "exact").when(hit, F.format_string("partial:%.2f", "best.score")).otherwise("first_valid")
    out = asked.join(known, "gene", "left").join(best, ["gene", "disease"], "left")
    return out.withColumns({"id": F.when(hit, F.col("best.id")).otherwise(F.col("first")), "tag": tag}).drop("_known", "best", "first")


def precise_list(hits: DataFrame, excluded: Column, *others: DataFrame, key: str = "pmid") -> DataFrame:
    """Distinct keys of the hits that are not excluded and in none of the other tables."""
    out = hits.where(~excluded).select(key).distinct()
    for other in others:
        out = not_in(out, other, [key])
    return out


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target, and the source's rows whose key it lacks, with null for columns that they lack."""
    return target.unionByName(not_in(source, target, keys).select(*[c for c in target.columns if c in source.columns]), allowMissingColumns=True)
