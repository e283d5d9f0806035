"""Aggregates: counts, summaries, indexes, recall and precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.text import ratio


def value_counts(df: DataFrame, column: str, default: str | None = None) -> DataFrame:
    """(value, n), the most frequent first, ties by value."""
    value = F.col(column) if default is None else F.coalesce(F.col(column), F.lit(default))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def conditional_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with the number of rows for which each condition holds, in one pass."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def grouped_index(df: DataFrame, key: str, value: str, out: str = "values") -> DataFrame:
    """(key, sorted distinct values)."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias(out))


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(label, value, n): counts by each of several columns and in all, from one scan."""
    long = df.select(F.explode(F.array(F.struct(F.lit("total").alias("label"), F.lit("").alias("value")), *[F.struct(F.lit(c).alias("label"), F.col(c).cast("string").alias("value")) for c in columns])).alias("s"))
    return long.groupBy("s.label", "s.value").agg(F.count("*").alias("n")).select("label", "value", "n")


def presence_rates(df: DataFrame, sections: str) -> DataFrame:
    """(section, n, share) of each key of a map column over all rows."""
    rows = df.agg(F.count("*").alias("rows"))
    keys = df.select(F.explode(F.map_keys(sections)).alias("section")).groupBy("section").agg(F.count("*").alias("n"))
    return keys.join(rows, how="cross").select("section", "n", ratio("n", "rows").alias("share"))  # one row on the right


def set_scores(gold: DataFrame, predicted: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(tp, fp, fn, precision, recall, f1) over distinct (keys, value) of both sides; 0 for an empty denominator."""
    on = [*keys, value]
    g, p = gold.select(*on).distinct().withColumn("_g", F.lit(1)), predicted.select(*on).distinct().withColumn("_p", F.lit(1))
    both = g.join(p, on, "full_outer")
    sums = both.agg(F.count_if(F.col("_g").isNotNull() & F.col("_p").isNotNull()).alias("tp"), F.count_if(F.col("_g").isNull()).alias("fp"), F.count_if(F.col("_p").isNull()).alias("fn"))
    scored = sums.withColumns({"precision": ratio("tp", F.col("tp") + F.col("fp")), "recall": ratio("tp", F.col("tp") + F.col("fn"))})
    return scored.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def coverage(df: DataFrame, flag: str) -> DataFrame:
    """(n, covered, share) of a boolean column."""
    return df.agg(F.count("*").alias("n"), F.count_if(F.col(flag)).alias("covered")).withColumn("share", ratio("covered", "n"))


def with_group_count(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    return df.withColumn(out, F.count("*").over(Window.partitionBy(*keys)))


def keys_without(df: DataFrame, key: str, flag: Column) -> DataFrame:
    """Keys of which no row has the flag."""
    return df.groupBy(key).agg(F.bool_or(flag).alias("_any")).where(~F.coalesce("_any", F.lit(False))).select(key)
