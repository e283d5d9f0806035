"""Incremental runs as streams of new files: append once, side outputs, state, quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmill.operators.rows import keep_first
from quillmill.streaming.keyed import KeyedSink, content_id

_FILE = ["_file_path", "_file_size", "_file_time"]


def append_new(
    spark: SparkSession, source: str, schema: str, sink: str, checkpoint: str, keys: list[str], transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    side: tuple[Column, str] | None = None, reject: tuple[Column, str] | None = None, form: str = "parquet", files_at_once: int = 100, pattern: str = "*",
) -> StreamingQuery:
    """Transform files of a folder, named by the pattern, not seen before and append the rows whose key the sink lacks; each key is written once.

    A batch is a commit named by its files. The sink's key index tells which
    keys it has, also to a stream with a new checkpoint, and a commit that is
    whole is not made again; one that broke off is taken back first. Rows under
    `reject` go to their own folder instead, and rows under `side` that are new
    to theirs besides, with the same commit: nothing of them is lost or
    doubled. Processes what is there, then ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        files = [tuple(r) for r in batch.select(*_FILE).distinct().collect()]  # files_at_once at most
        commit = content_id(files)
        made = transform(batch.drop(*_FILE))
        others = [x[1] for x in (side, reject) if x is not None]
        table = KeyedSink(spark, sink, keys, made.schema, others)
        if not files or table.holds(commit):
            return
        made = made.persist()
        try:
            table.begin(commit)
            own = lambda folder: f"{folder.rstrip('/')}/commit={commit}"
            good = made
            if reject is not None:
                made.where(reject[0]).write.mode("overwrite").parquet(own(reject[1]))
                good = made.where(~F.coalesce(reject[0], F.lit(False)))
            order = [c for c in made.columns if c not in keys] or keys
            keep_first(table.unknown(good), keys, order).write.mode("overwrite").parquet(own(sink))
            if side is not None:
                spark.read.schema(made.schema).parquet(own(sink)).where(side[0]).write.mode("overwrite").parquet(own(side[1]))
            table.commit(commit)
        finally:
            made.unpersist()

    stream = spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_at_once).option("pathGlobFilter", pattern).load(source)
    file = F.col("_metadata")
    stream = stream.select("*", file["file_path"].alias(_FILE[0]), file["file_size"].alias(_FILE[1]), file["file_modification_time"].cast("string").alias(_FILE[2]))
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return query


def once_within(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Each key once while its time is within the watermark: state stays bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
