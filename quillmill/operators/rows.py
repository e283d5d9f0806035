"""Row-level relational operators: order, keep-first, batches, columns, views."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from decimal import Decimal
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.sources.files import kept

ORDER = "_ord"


def with_order(df: DataFrame, *by: str | Column) -> DataFrame:
    """df with `_ord`, the columns that order its rows, as one struct. DataFrames have no order of their own."""
    return df.withColumn(ORDER, F.struct(*[F.col(c).alias(c) if isinstance(c, str) else c for c in by]))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool = False) -> DataFrame:
    """The first row of each key by an explicit ascending order, nulls first; null keys are one key.

    Rows that tie in key and order are decided by a hash of the whole row, and
    of equal rows one stays. Each task finds the least place of each key, with
    texts in keys as 128-bit digests; then rows are joined with those places.
    So a key's rows are never sorted or brought together, however many it has.
    The table is read twice.
    """
    places, first = _places(df, keys, order, last)
    return places.join(first, ["_key", "_at"], "left_semi").dropDuplicates(["_key", "_at"]).drop("_key", "_at")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_first(df, keys, order, last=True)


def losers(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The rows that keep_first drops, each as often as it is there."""
    places, first = _places(df, keys, order)
    others = places.join(first, ["_key", "_at"], "left_anti").drop("_key", "_at")
    copies = places.join(first, ["_key", "_at"], "left_semi").groupBy("_key", "_at").agg(F.count("*").alias("_n"), F.first(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("_row"))
    again = copies.where("_n > 1").select("_row", F.explode(F.sequence(F.lit(2).cast("long"), "_n"))).select("_row.*")
    return others.unionByName(again)


def _places(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool = False) -> tuple[DataFrame, DataFrame]:
    """df with `_key` and `_at`, and the first (or last) place of each key."""
    kinds = dict(df.dtypes)
    short = [F.unhex(F.md5(F.col(k).cast("binary"))) if kinds.get(k) in ("string", "binary") else F.col(k) for k in keys]
    whole = _row_hash(df)
    at = [F.col(c) if isinstance(c, str) else c for c in order] + [whole]
    named = lambda cs, n: F.struct(*[c.alias(f"{n}{i}") for i, c in enumerate(cs)])
    places = df.select("*", named(short, "k").alias("_key"), named(at, "a").alias("_at"))
    best = F.max("_at") if last else F.min("_at")
    return places, places.groupBy("_key").agg(best.alias("_at"))


def _row_hash(df: DataFrame) -> Column:
    """A hash of a whole row, but for maps, which have none."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind])


def top_scored(df: DataFrame, keys: Sequence[str], score: str, order: Sequence[str]) -> DataFrame:
    """The row with the highest score of each key, of equal ones the first; rows without a score come last."""
    return keep_first(df, keys, [F.col(score).isNull(), -F.col(score), *order])


def first_value(df: DataFrame, key: str, value: str, order: str, out: str) -> DataFrame:
    """(key, out): the value of the first row of each key, by partial aggregation and without a sort."""
    return df.groupBy(key).agg(F.min_by(value, order).alias(out))


def in_batches(df: DataFrame, order: str | Sequence[str], size: int, parts: Sequence[str] = ()) -> DataFrame:
    """df with `batch`, the number of its fixed-size batch within each part, or over all rows if there are no parts."""
    order = [order] if isinstance(order, str) else list(order)
    if parts:
        numbered_rows = df.withColumn("_n", F.row_number().over(Window.partitionBy(*parts).orderBy(*order)) - 1)
    else:
        numbered_rows = numbered(df, order, "_n")
    return numbered_rows.withColumn("batch", F.floor(F.col("_n") / size).cast("long")).drop("_n")


def running_total(df: DataFrame, value: str, order: Sequence[str], parts: Sequence[str], out: str) -> DataFrame:
    """df with the sum of `value` over the rows up to each, within each part, or over all rows if there are no parts. Null values add nothing."""
    if not parts:
        return accumulated(df, value, order, out)
    w = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def numbered(df: DataFrame, order: Sequence[str], out: str = "n") -> DataFrame:
    """df with each row's number from 0 in the given order, over all rows.

    Tasks sort ranges of the order and number their own rows; the ranges' sizes
    are summed up and joined back. Ties are split among ranges and decided by a
    hash of the row, so that a frequent value is no task of its own. The ranges are
    written once, since other runs may draw them elsewhere.
    """
    return _offset(kept(_in_ranges(df, order)), F.count("*"), F.col("_place"), out)


def accumulated(df: DataFrame, value: str, order: Sequence[str], out: str = "total") -> DataFrame:
    """df with the sum of `value` over all rows up to each in the given order, by sums of ranges as numbered() does it.

    Null until the first value that is not null. Integers are summed as longs,
    decimals with 38 digits, others as doubles.
    """
    kind = dict(df.dtypes)[value]
    exact = kind.startswith("decimal")
    total = f"decimal(38,{kind.split(',')[1]}" if exact else "long" if kind in ("tinyint", "smallint", "int", "bigint") else "double"
    ranges = _in_ranges(df, order).withColumn("_value", F.col(value).cast(total))
    at, schema = ranges.columns.index("_value"), ranges.withColumn("_sum", F.col("_value")).withColumn("_seen", F.lit(0).cast("long")).schema

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        carry, seen = 0, 0
        for batch in batches:
            own = batch.column(at)
            counts = pc.add(pc.cumulative_sum(pc.is_valid(own).cast(pa.int64())), seen)
            filled = own.fill_null(pa.scalar(0, own.type) if not exact else pa.scalar(Decimal(0), own.type))
            if exact:
                sums = pa.array(list(accumulate(filled.to_pylist(), initial=carry))[1:], type=own.type)
            else:
                sums = pc.cumulative_sum(filled, start=pa.scalar(carry, own.type))
            if batch.num_rows:
                carry, seen = sums[-1].as_py(), counts[-1].as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns, sums, counts], names=schema.names)

    rows = kept(ranges.mapInArrow(run, schema))
    with_sums = _offset(rows, F.coalesce(F.sum("_value"), F.lit(0).cast(total)), F.col("_sum"), out, keep=("_part", "_seen"))
    with_seen = _offset(with_sums, F.count("_value"), F.col("_seen"), "_known", source=rows)
    return with_seen.withColumn(out, F.when(F.col("_known") > 0, F.col(out))).drop("_known")


def _in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    by = [*order, _row_hash(df)]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return rows.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"))


def _offset(rows: DataFrame, total: Column, own: Column, out: str, keep: Sequence[str] = (), source: DataFrame | None = None) -> DataFrame:
    """rows with `own` and the totals of all ranges before theirs: one row a range is scanned and broadcast."""
    sums = (source or rows).groupBy("_part").agg(total.alias("_t"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_before"))
    made = rows.join(F.broadcast(offsets), "_part")
    kind = dict(rows.select(own.alias("x")).dtypes)["x"]
    made = made.withColumn(out, (F.col("_before") + own).cast(kind))
    return made.drop("_before", *[c for c in ("_part", "_place", "_value", "_sum", "_seen") if c not in keep])


def limited(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def add_missing(df: DataFrame, columns: Sequence[str], default: str = "") -> DataFrame:
    return df.withColumns({c: F.lit(default) for c in columns if c not in df.columns})


def add_absent(df: DataFrame, **defaults: Column) -> DataFrame:
    """Columns that df lacks, each with its computed default; later ones may use earlier ones."""
    for name, value in defaults.items():
        if name not in df.columns:
            df = df.withColumn(name, value)
    return df


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by name; text columns that a side lacks are empty there."""
    out = dfs[0]
    strings = {f.name for d in dfs for f in d.schema if f.dataType.simpleString() == "string"}
    lacking = {c for d in dfs for c in strings if c not in d.columns}
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in lacking}) if lacking else out


def reordered(df: DataFrame, front: Sequence[str], prefixes: Sequence[str] = ()) -> DataFrame:
    """Fixed columns first, then those with a prefix, then the rest."""
    first = [c for c in front if c in df.columns]
    marked = [c for p in prefixes for c in df.columns if c.startswith(p) and c not in first]
    return df.select(*dict.fromkeys([*first, *marked, *df.columns]))


def in_views(df: DataFrame, views: dict[str, Column]) -> DataFrame:
    """Each row once for every view that it is in, with the view's name: one pass, ready for partitionBy("view")."""
    names = F.array_compact(F.array(*[F.when(p, F.lit(n)) for n, p in views.items()]))
    return df.select("*", F.explode(names).alias("view"))


def enum_mapped(c: str | Column, table: dict[str, str], default: str) -> Column:
    """A closed list's values by a table, others by the default."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col(c) if isinstance(c, str) else c), F.lit(default))


def prioritised(*sources: tuple[DataFrame, str], key: str) -> DataFrame:
    """One row of each key, from the first source that has it; `source` says which."""
    ranked = None
    for i, (df, name) in enumerate(sources):
        own = df.withColumns({"source": F.lit(name), "_place": F.lit(i)})
        ranked = own if ranked is None else ranked.unionByName(own, allowMissingColumns=True)
    return keep_first(ranked, [key], ["_place"]).drop("_place")


def flattened(docs: DataFrame, parent: Sequence[str], array: str) -> DataFrame:
    """A row for each struct of an array, with the parent's fields."""
    return docs.select(*parent, F.explode(array).alias("_e")).select(*parent, "_e.*")


def flattened_map(docs: DataFrame, column: str, key: str) -> DataFrame:
    """A row for each struct of each array of a map."""
    return docs.select(F.explode(column).alias(key, "_a")).select(key, F.explode("_a").alias("_e")).select(key, "_e.*")


def distinct_values(*sources: tuple[DataFrame, Sequence[str]], out: str = "value") -> DataFrame:
    """(value): distinct values that are not blank over several columns of several tables; an array's elements count each."""
    every = None
    for df, columns in sources:
        kinds = dict(df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)]).dtypes)
        arrays = [F.col(c).cast("array<string>") if kinds[f"c{i}"].startswith("array") else F.array(F.col(c).cast("string")) for i, c in enumerate(columns)]
        own = df.select(F.explode(F.array_distinct(F.flatten(F.array(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])))).alias(out))
        every = own if every is None else every.union(own)
    return every.where(F.trim(out) != "").distinct()


def existing(df: DataFrame, equal: dict[str, object], column: str, pattern: str) -> int:
    """How many rows have the given values and a column that matches: a warning says so if any has, and nothing is changed."""
    held = F.col(column).rlike(pattern)
    for name, value in equal.items():
        held = held & (F.col(name) == F.lit(value))
    n = df.where(held).count()
    if n:
        warnings.warn(f"{n} rows with {equal} have a {column} like {pattern}", stacklevel=2)
    return n
