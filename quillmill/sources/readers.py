"""Sources: JSON lines, folders of JSON, delimited text, id lists, literal rows, guarded paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmill.functions.text import all_text, clean


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path has anything, on any file system that Spark reads."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    statuses = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found)
    return bool(statuses)


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str, form: str = "parquet") -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(form).load(path)


def json_lines(spark: SparkSession, path: str, schema: StructType | str, strict: bool = True) -> DataFrame:
    """A bad line stops a strict read and is left out of a tolerant one."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def json_lines_with_rejects(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, the text of bad lines)."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("j"))
    return parsed.where("j._bad is null").select("j.*").drop("_bad"), parsed.where("j._bad is not null").select("value")


def marked_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Lines of JSON (value) -> the schema's fields, `line` (the text of a bad one, else null) and `status`: read or bad. Blank lines are none."""
    names = [f.name for f in StructType.fromDDL(schema)]
    parsed = lines.where(F.trim("value") != "").select("value", F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("j"))
    bad = F.col("j").isNull() | F.col("j._bad").isNotNull()
    return parsed.select(*[F.when(~bad, F.col("j")[n]).alias(n) for n in names], F.when(bad, F.col("value")).alias("line"), F.when(bad, "bad").otherwise("read").alias("status"))


def counted(df: DataFrame, name: str | Observation) -> DataFrame:
    """df that counts its records (read, bad) while something else reads it: no pass of its own."""
    kind = F.col("status")
    return df.observe(name, F.count_if(kind == "read").alias("read"), F.count_if(kind == "bad").alias("bad"))


def copy_counted(spark: SparkSession, path: str, schema: str, target: str) -> dict[str, int]:
    """Write a folder's JSON lines to target/status=read and the text of bad ones to target/status=bad, in one job that also counts them."""
    seen = Observation("reading")
    counted(marked_lines(spark.read.text(path), schema), seen).write.mode("overwrite").partitionBy("status").parquet(target)
    return {k: seen.get[k] for k in ("read", "bad")}


def stream_counted(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, files_at_once: int = 100) -> DataFrame:
    """The same for the files of a folder that were not seen before: (batch, read, bad) of this run's batches, counted as they are written.

    Of a run with more batches than spark.sql.streaming.numRecentProgressUpdates the last ones are returned.
    """
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_at_once).load(source)
    stream = counted(marked_lines(lines, schema), "reading").writeStream.partitionBy("status").format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    query = stream.trigger(availableNow=True).start()
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    rows = [(p["batchId"], p["observedMetrics"]["reading"]["read"], p["observedMetrics"]["reading"]["bad"]) for p in progress]
    return spark.createDataFrame(rows, "batch long, read long, bad long")


def reading_counts(rows: DataFrame, rejects: DataFrame) -> DataFrame:
    """(status, n) of two tables that are there already: how many records were read and how many were bad."""
    return rows.agg(F.count("*").alias("n")).withColumn("status", F.lit("read")).unionByName(rejects.agg(F.count("*").alias("n")).withColumn("status", F.lit("bad"))).select("status", "n")


def json_folder(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One document in each file, with its name without ending as `stem`."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # it comes encoded
    return df.withColumn("stem", F.regexp_replace(name, r"\.json$", ""))


def delimited(spark: SparkSession, path: str, by: str = ",", order: str | None = "_ord") -> DataFrame:
    """A table with a header, all text, null as empty.

    `order` is (file, start of the part of the file, line in that part): it
    orders rows by file name and then as they lie in the file.
    """
    df = spark.read.option("header", True).option("sep", by).option("inferSchema", False).csv(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    return all_text(df) if not order else df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns], place.alias(order))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(id) of the lines that are not blank."""
    return spark.read.text(path).select(clean("value").alias("id")).where("id <> ''").distinct()


def literal(spark: SparkSession, rows: Sequence[dict], schema: str | StructType) -> DataFrame:
    """An inline table; fields that a row lacks are null."""
    names = [f.name for f in (StructType.fromDDL(schema) if isinstance(schema, str) else schema)]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def merged_last(*maps: DataFrame, key: str) -> DataFrame:
    """Several (key, ...) tables as one; of equal keys the row of the last table stays."""
    from quillmill.operators.rows import keep_first

    out = None
    for i, df in enumerate(maps):
        own = df.withColumn("_place", F.lit(-i))
        out = own if out is None else out.unionByName(own)
    return keep_first(out, [key], ["_place", *[c for c in out.columns if c not in (key, "_place")]]).drop("_place")
