"""A table that grows by commits and knows its keys: an index in buckets, and commits named by what they were made from.

Layout: the rows of a commit are in <sink>/commit=<id>, those of other outputs in
<folder>/commit=<id>. <sink>_keys holds the keys as runs: a commit adds one,
and MERGED runs of a level become one of the next, so the runs are few however
long the table lives. state.json names the runs that count and the last
commit: replacing it is what commits. Keys of a batch are looked up in the
buckets that they fall in, so a batch reads neither the table nor the index's
other buckets. One writer at a time.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from quillmill.operators.joins import not_in
from quillmill.sources.files import Files
from quillmill.sources.readers import path_exists

#: Runs of a level that are merged into one, and buckets of keys.
MERGED, BUCKETS = 8, 16


def content_id(parts: Iterable[tuple]) -> str:
    """A commit's name: what it was made from decides it, not when or as which batch."""
    return hashlib.sha256(json.dumps(sorted(map(list, parts)), default=str).encode()).hexdigest()[:32]


def rows_id(rows: DataFrame) -> str:
    """A commit's name from its rows, in whatever order and partitions they come."""
    row = rows.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).alias("a"), F.sum(F.xxhash64(F.lit(1), *rows.columns).cast("decimal(38,0)")).alias("b")).first()
    return content_id([(row.n, str(row.a), str(row.b))])


class KeyedSink:
    """One growing table, its key index and the folders that are written with it."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: StructType, others: Sequence[str] = (), buckets: int = BUCKETS, form: str = "parquet") -> None:
        self.spark, self.path, self.keys, self.others, self.form = spark, path.rstrip("/"), list(keys), [o.rstrip("/") for o in others], form
        self.schema, self.buckets, self._files, self._index = schema, buckets, Files(spark), f"{path.rstrip('/')}_keys"
        self._recover()

    def _state(self) -> dict:
        at = f"{self._index}/state.json"
        return json.loads(self._files.read(at)) if self._files.exists(at) else {"levels": [], "last": "", "buckets": self.buckets}

    def _recover(self) -> None:
        """Finish a commit that its state says was made, take back one that was begun only, and index a table that has no index."""
        begun = f"{self._index}/begun"
        if self._files.exists(begun):
            commit = self._files.read(begun).decode()
            if self._state()["last"] == commit:
                self._settled(commit)
            else:
                for folder in (self.path, *self.others):
                    self._files.delete(f"{folder}/commit={commit}")
                self._files.delete(f"{self._index}/run={commit}")
                self._files.delete(begun)
        self.buckets = self._state().get("buckets", self.buckets)
        if not self._files.exists(f"{self._index}/state.json") and path_exists(self.spark, f"{self.path}/*"):
            self._write_run("base", self._rows(self.path).select(*self.keys).distinct())
            self._write_state([["base"]], "")

    def holds(self, commit: str) -> bool:
        """Whether a commit is whole."""
        return self._files.exists(f"{self.path}/commit={commit}/_COMMITTED")

    def begin(self, commit: str) -> None:
        self._files.write(f"{self._index}/begun", commit.encode())

    def commit(self, commit: str) -> None:
        """Index the keys that the commit's rows have, then make it count."""
        self._write_run(commit, self._rows(f"{self.path}/commit={commit}").select(*self.keys))
        levels = [list(runs) for runs in self._state()["levels"]] or [[]]
        levels[0].append(commit)
        merged = []
        for level in range(len(levels)):
            if len(levels[level]) >= MERGED:
                name = f"{commit}-{level + 1}"
                self._write_run(name, self._read(levels[level]).drop("bucket"))
                merged += levels[level]
                levels[level] = []
                if level + 1 == len(levels):
                    levels.append([])
                levels[level + 1].append(name)
        self._write_state(levels, commit)
        self._settled(commit)
        for run in merged:
            self._files.delete(f"{self._index}/run={run}")

    def _rows(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema).format(self.form).load(path)

    def _settled(self, commit: str) -> None:
        self._files.write(f"{self.path}/commit={commit}/_COMMITTED", b"")
        self._files.delete(f"{self._index}/begun")

    def _write_state(self, levels: list[list[str]], last: str) -> None:
        self._files.write(f"{self._index}/state.json", json.dumps({"levels": levels, "last": last, "buckets": self.buckets}).encode())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write_run(self, name: str, keys: DataFrame) -> None:
        keys.withColumn("bucket", self._bucket()).repartition(self.buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self._index}/run={name}")

    def _read(self, runs: Sequence[str]) -> DataFrame:
        own = StructType([self.schema[k] for k in self.keys]).add("bucket", IntegerType())
        # A run without keys has no bucket folders, and so no files to read.
        paths = [f"{self._index}/run={r}" for r in runs if any(n.startswith("bucket=") for n in self._files.names(f"{self._index}/run={r}"))]
        if not paths:
            return self.spark.createDataFrame([], own)
        return self.spark.read.schema(own).option("basePath", self._index).parquet(*paths).select(*self.keys, "bucket")

    def known(self, rows: DataFrame) -> DataFrame:
        """The indexed keys of the buckets that the rows fall in."""
        buckets = [r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect()]  # as many as there are buckets
        runs = [r for level in self._state()["levels"] for r in level]
        return self._read(runs).where(F.col("bucket").isin(buckets)).select(*self.keys)

    def unknown(self, rows: DataFrame) -> DataFrame:
        """Rows whose key no commit has; a key with a null in it is never known."""
        return not_in(rows, self.known(rows), self.keys)


def committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all whole commits of a table, or of a folder that was written with it."""
    files = Files(spark)
    whole = [n for n in files.names(path) if n.startswith("commit=")]
    if not whole:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in whole])
