"""Faults of the third round's findings that concern the engine's own queries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillmill.operators import joins as J
from quillmill.sources import readers, sinks


def test_tasks_move_the_files_of_rows(spark, tmp_path, monkeypatch):
    """The driver touches no single file, whatever their number; odd keys, rows without one and a second run included."""
    monkeypatch.delattr(sinks.Files, "rename", raising=False)
    folder = str(tmp_path / "out")
    rows = spark.range(300).select(F.concat(F.lit("k "), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    odd = spark.createDataFrame([(None, 1), (None, 0), ("_hidden", 2), ("in/side", 3), ("é?#%20", 4)], "k string, v long")
    assert sinks.export_documents(rows, "k", folder) == (300, 0)
    assert sinks.export_documents(rows.union(odd).repartition(7), "k", folder) == (4, 301)
    assert sinks.export_documents(odd, "k", f"file:{folder}") == (0, 5)
    got = {r.stem: r.v for r in readers.json_folder(spark, folder, "v long").where("v < 300").collect()}
    assert len(got) == 301 and got["k 7"] == 7 and got["é?#%20"] == 4
    hidden = {n: (tmp_path / "out" / f"{n}.json").read_text() for n in ("_hidden", "in/side", "__HIVE_DEFAULT_PARTITION__")}
    assert '"v":2' in hidden["_hidden"] and '"v":3' in hidden["in/side"] and '"v":0' in hidden["__HIVE_DEFAULT_PARTITION__"]
    assert not [n for n in sinks.Files(spark).names(folder) if not n.endswith(".json") and n != "in"]
    with pytest.raises(Exception, match="colon"):
        sinks.export_documents(rows.withColumn("k", F.lit("a:b")), "k", str(tmp_path / "none"))
    assert sinks.Files(spark).names(str(tmp_path / "none")) == []


def test_rows_with_one_list_lie_together(spark, tmp_path):
    """The list is made once for each key, and files hold it once: 25 lists of 60 kB for 20,000 rows, 1.2 GB as text."""
    gold = spark.range(75_000).select((F.col("id") % 25).alias("b"), F.lit(None).cast("int").alias("a"), F.format_string("name %015d", "id").alias("v"))
    gold = gold.union(spark.createDataFrame([(None, 7, "own"), (None, 7, "own"), (None, 8, None)], "b long, a int, v string"))
    rows = spark.range(20_000).select("id", F.col("id").alias("a"), F.when(F.col("id") % 101 != 0, F.col("id") % 26).alias("b"))
    out = J.by_first_key(rows, gold, ["a", "b"], "v", lambda x: F.array_join(F.sort_array(x), ","))
    out.write.parquet(str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(got.columns) == ["a", "b", "id", "v"] and got.count() == 20_000
    found = {r.id: (r.n, r.v) for r in got.select("id", F.length("v").alias("n"), F.left("v", F.lit(20)).alias("v")).collect()}
    assert found[7] == (3, "own") and found[8] == (0, "") and found[25] == (None, None) and found[101] == (None, None)
    assert all(found[i] == (3000 * 21 - 1, f"name {i % 26:015d}") for i in found if i > 8 and i % 101 and i % 26 < 25)
    files = [p.stat().st_size for p in (tmp_path / "out").glob("*.parquet")]
    assert len(files) > 1 and sum(files) < 8 << 20
