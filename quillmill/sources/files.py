"""Files and tables of a run on any file system that Spark reads: scratch tables, small state files."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession


class Files:
    """What the driver does with single files and folders, through Spark's own file systems."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        found = self._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self._conf), found

    def qualified(self, path: str) -> str:
        """The path with its file system's scheme."""
        fs, at = self._at(path)
        return fs.makeQualified(at).toString()

    def create_folder(self, path: str) -> None:
        fs, at = self._at(path)
        fs.mkdirs(at)

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, none if there is no such folder."""
        fs, at = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)

    def write(self, path: str, data: bytes, overwrite: bool = True) -> None:
        """Written whole beside its place and then moved there; without overwrite a file that is there is an error."""
        fs, at = self._at(path)
        if not overwrite and fs.exists(at):
            raise FileExistsError(path)
        beside = self._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{uuid.uuid4().hex}")
        out = fs.create(beside, False)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        if overwrite:
            fs.delete(at, False)
        if not fs.rename(beside, at):
            fs.delete(beside, False)
            raise FileExistsError(path)

    def read(self, path: str) -> bytes:
        fs, at = self._at(path)
        into = fs.open(at)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(into))
        finally:
            into.close()


def opened(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a qualified folder as tasks use it, and the folder's path there. Schemes that Arrow does not know are an error."""
    if folder.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    try:
        return arrow_fs.FileSystem.from_uri(folder)
    except pa.ArrowInvalid as e:
        raise ValueError(f"tasks cannot write single files to {folder}") from e


def scratch(spark: SparkSession) -> str:
    """A new folder's path below spark.checkpoint.dir; below a temporary folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="quillmill-")
    return f"{folder.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """df written as a table in a scratch folder and read back: what follows sees the same rows each time. Removed when the driver ends."""
    spark = df.sparkSession
    path, schema = scratch(spark), df.schema
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        Files(spark).delete(path)
    except Exception:  # the session may have ended: the folder's owner cleans up
        pass
