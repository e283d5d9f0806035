"""Sinks: views, JSON lines, delimited text, side outputs, state."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillmill.functions.text import without_control
from quillmill.operators.joins import not_in
from quillmill.operators.rows import in_views
from quillmill.sources.files import Files, opened
from quillmill.sources.readers import json_lines
from quillmill.streaming.keyed import KeyedSink, rows_id

#: The file of rows without a key, as Spark names their partition.
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"


def write_views(df: DataFrame, views: dict[str, Column], path: str) -> None:
    """Every view as a partition of one table, in one pass; control characters are stripped."""
    in_views(without_control(df), views).write.mode("overwrite").partitionBy("view").parquet(path)


def append_json(df: DataFrame, path: str, keys: list[str], schema: str | None = None) -> None:
    """Append the rows whose key the folder lacks, as a commit named by the rows: running it again appends nothing, and one that broke off is taken back first.

    Keys are looked up in an index beside the folder (see streaming.keyed), so
    the folder itself is not read.
    """
    spark = df.sparkSession
    kind = df.schema if schema is None else StructType.fromDDL(schema)
    df = df.persist()
    try:
        table, commit = KeyedSink(spark, path, keys, kind, form="json"), rows_id(df)
        if not table.holds(commit):
            table.begin(commit)
            table.unknown(df).write.mode("overwrite").json(f"{table.path}/commit={commit}")
            table.commit(commit)
    finally:
        df.unpersist()


def write_with_side(df: DataFrame, path: str, side_path: str, condition: Column) -> None:
    """All rows to one folder and those under a condition to another too, computed once.

    Both are parts named by the rows, so that a second run of the same rows
    writes its parts anew and doubles nothing.
    """
    df = df.persist()
    try:
        own = f"commit={rows_id(df)}"
        df.write.mode("overwrite").json(f"{path.rstrip('/')}/{own}")
        df.where(condition).write.mode("overwrite").json(f"{side_path.rstrip('/')}/{own}")
    finally:
        df.unpersist()


def write_documents(df: DataFrame, path: str, buckets: int = 256, key: str = "pmid") -> None:
    """Documents in folders by a hash of their key: many to a file, found again by bucket."""
    df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets))).write.mode("append").partitionBy("bucket").json(path)


def export_documents(df: DataFrame, key: str, folder: str, most: int | None = None) -> tuple[int, int]:
    """Each row as <folder>/<key>.json, those that are there are left as they are: (written, skipped).

    Tasks write the files of the rows that have none yet to a folder of this run,
    and tasks move them into place when all are whole, so a run whose rows break
    off leaves none. Of rows with one key the least by its JSON is written, and rows
    without a key are one named __HIVE_DEFAULT_PARTITION__. The folder lies where
    executors write single files: on a shared disk or a store that Arrow knows.
    With `most`, more rows than that are refused.
    """
    spark, files = df.sparkSession, Files(df.sparkSession)
    rows = df.select(F.coalesce(F.col(key).cast("string"), F.lit(_NO_KEY)).alias("name"), F.to_json(F.struct(*df.columns)).alias("body"))
    if most is not None and rows.limit(most + 1).count() > most:
        raise ValueError(f"over {most} rows: too many for a file each")
    folder = files.qualified(folder.rstrip("/"))
    aside = f"{folder}/_{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, there = opened(folder)
        own = f"{there}/{aside.rsplit('/', 1)[1]}/{uuid.uuid4().hex}"  # each try of a task has names of its own
        made = 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            if wrong := [n for n in names if ":" in n]:
                raise ValueError(f"Spark's readers open no file with a colon in its name: {wrong[0]}")
            new = [x.type == FileType.NotFound for x in fs.get_file_info([f"{there}/{n}.json" for n in names])]
            at: list[str | None] = [f"{own}-{made + i}" if x else None for i, x in enumerate(new)]
            for path, body in zip(at, batch.column(1).to_pylist()):
                if path:
                    with fs.open_output_stream(path) as out:
                        out.write(f"{body}\n".encode())
            made += len(names)
            yield pa.record_batch([batch.column(0), pa.array(at, type=pa.string()), batch.column(2)], names=["name", "at", "n"])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, there = opened(folder)
        for batch in batches:
            moved = 0
            for name, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                target = f"{there}/{name}.json"
                if fs.get_file_info(at).type == FileType.NotFound:  # an earlier try of this task has moved it
                    moved += 1
                elif fs.get_file_info(target).type == FileType.NotFound:
                    if "/" in name:
                        fs.create_dir(target.rsplit("/", 1)[0])
                    fs.move(at, target)
                    moved += 1
            yield pa.record_batch([pa.array([moved], type=pa.int64())], names=["moved"])

    try:
        files.create_folder(aside)
        one = rows.groupBy("name").agg(F.min("body").alias("body"), F.count("*").alias("n"))
        one.mapInArrow(write, "name string, at string, n long").write.parquet(f"{aside}/_made")
        made = spark.read.schema("name string, at string, n long").parquet(f"{aside}/_made")
        total = made.agg(F.sum("n").alias("n")).first().n or 0
        moved = made.where("at is not null").select("name", "at").mapInArrow(move, "moved long").agg(F.sum("moved").alias("n")).first().n or 0
    finally:
        for _ in range(5):  # tasks that are not stopped yet may add a file meanwhile
            files.delete(aside)
            if not files.exists(aside):
                break
    return moved, total - moved


def rewrite_json(spark: SparkSession, source: str, target: str, schema: str, array: str, **fields) -> None:
    """JSON lines written again with fields of the structs of an array changed: each by a function of its old value."""
    df = json_lines(spark, source, schema)
    kept = [f.name for f in df.schema[array].dataType.elementType]
    changed = F.transform(array, lambda x: F.struct(*[(fields[c](x[c]) if c in fields else x[c]).alias(c) for c in kept]))
    df.withColumn(array, changed).write.mode("errorifexists").json(target)


def write_delimited(df: DataFrame, path: str, by: str = "\t") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", by).csv(path)


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One id a line, sorted as text."""
    df.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def record_progress(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Append the statuses (key, status) of a run to the state's log: done, absent, failed. A later run's status of a key takes the place of an earlier one's."""
    log = StateLog(spark, path)
    df.select("key", "status").write.parquet(f"{log.path}/log={log.last() + 1:09d}")


def still_to_do(spark: SparkSession, keys: DataFrame, path: str) -> DataFrame:
    """Keys that are neither done nor known to be absent; failed ones come again."""
    return not_in(keys, StateLog(spark, path).current().where("status in ('done', 'absent')"), ["key"])


class StateLog:
    """The last status of each key: runs are appended to a log, which compact() folds into a base.

    pointer.json names the base and the last run in it. Replacing it is what
    makes a compaction count, and the base and the runs before it stay until the
    next one, so that readers go on with what they have found. One writer at a time.
    """

    SCHEMA = "key string, status string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self._files = spark, path.rstrip("/"), Files(spark)

    def _pointer(self) -> dict:
        at = f"{self.path}/pointer.json"
        return json.loads(self._files.read(at)) if self._files.exists(at) else {"base": "", "run": 0}

    def _runs(self) -> list[int]:
        """Numbers of the runs that are whole."""
        found = [n for n in self._files.names(self.path) if n.startswith("log=")]
        return [int(n[4:]) for n in found if self._files.exists(f"{self.path}/{n}/_SUCCESS")]

    def last(self) -> int:
        every = [int(n[4:]) for n in self._files.names(self.path) if n.startswith("log=")]
        return max([self._pointer()["run"], *every])

    def current(self) -> DataFrame:
        """(key, status): of a key in several runs the last one's; within a run failed, done, absent is the order in which they count."""
        return self._folded(self._pointer(), self._runs()).select("key", "status")

    def _folded(self, pointer: dict, runs: list[int]) -> DataFrame:
        parts = [self.spark.createDataFrame([], f"{self.SCHEMA}, run int")]
        if pointer["base"]:
            parts.append(self.spark.read.schema(f"{self.SCHEMA}, run int").parquet(f"{self.path}/{pointer['base']}"))
        new = [f"{self.path}/log={n:09d}" for n in runs if n > pointer["run"]]
        if new:
            number = F.regexp_extract(F.col("_metadata.file_path"), "/log=([0-9]+)/", 1).cast("int")
            parts.append(self.spark.read.schema(self.SCHEMA).parquet(*new).select("key", "status", number.alias("run")))
        every = parts[0].union(parts[1]) if len(parts) == 2 else parts[0] if len(parts) == 1 else parts[0].union(parts[1]).union(parts[2])
        return every.groupBy("key").agg(F.max(F.struct("run", "status")).alias("_last")).select("key", "_last.status", "_last.run")

    def compact(self) -> None:
        """Write the last statuses as a new base; the runs and the base that an earlier compaction left are removed."""
        before, runs = self._pointer(), self._runs()
        last = max([before["run"], *runs])
        if last == before["run"]:
            return
        base = f"base={last:09d}"
        self._folded(before, runs).write.mode("overwrite").parquet(f"{self.path}/{base}")
        self._files.write(f"{self.path}/pointer.json", json.dumps({"base": base, "run": last}).encode())
        for name in self._files.names(self.path):
            if name.startswith("base=") and name not in (base, before["base"]) or name.startswith("log=") and int(name[4:]) <= before["run"]:
                self._files.delete(f"{self.path}/{name}")
