import json

import pytest
from pyspark.sql import functions as F

from quillmill.sources import readers, services, sinks, workbook
from quillmill.streaming.incremental import append_new


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": "1"}\nbroken\n{"k": "2"}\n')
    assert {r.k for r in readers.json_lines(spark, str(tmp_path / "a.jsonl"), "k string", strict=False).collect()} == {"1", "2"}
    with pytest.raises(Exception):
        readers.json_lines(spark, str(tmp_path / "a.jsonl"), "k string").collect()
    good, bad = readers.json_lines_with_rejects(spark, str(tmp_path / "a.jsonl"), "k string")
    assert {r.k for r in good.collect()} == {"1", "2"} and [r.value for r in bad.collect()] == ["broken"]


def test_folders_tables_and_lists(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs/12.json").write_text(json.dumps({"pmid": "12", "sections": {"results": "x"}}, indent=1))
    row = readers.json_folder(spark, str(tmp_path / "docs"), "pmid string, sections map<string,string>").first()
    assert (row.stem, row.sections) == ("12", {"results": "x"})
    (tmp_path / "t.tsv").write_text("a\tb\n1\t\n2\tx\n")
    assert [(r.a, r.b) for r in readers.delimited(spark, str(tmp_path / "t.tsv"), "\t").orderBy("_ord").collect()] == [("1", ""), ("2", "x")]
    (tmp_path / "ids.txt").write_text("7\n\n 8 \n7\n")
    assert sorted(r.id for r in readers.id_list(spark, str(tmp_path / "ids.txt")).collect()) == ["7", "8"]
    assert readers.read_or_empty(spark, str(tmp_path / "none"), "k string").count() == 0
    assert readers.literal(spark, [{"a": "1"}, {"b": 2}], "a string, b int").count() == 2
    a, b = spark.createDataFrame([("k", 1)], "k string, v int"), spark.createDataFrame([("k", 2)], "k string, v int")
    assert readers.merged_last(a, b, key="k").first().v == 2


def test_workbook_round_trip(spark, tmp_path):
    path = str(tmp_path / "x.xlsx")
    views = {"all": spark.createDataFrame([("a", "1 < 2"), ("b", None)], "k string, v string"), "none": spark.createDataFrame([], "k string")}
    assert workbook.write_workbook(spark, views, path, only_filled=("none",), fills={"a": "FFFFC7CE"}, fill_by="k") == ["all"]
    assert [(r.k, r.v, r.zz) for r in workbook.read_sheet(spark, path, ["k", "v", "zz"], "all").orderBy("_ord").collect()] == [("a", "1 < 2", ""), ("b", "", "")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("1", "A\x01"), ("2", "B")], "pmid string, a string")
    sinks.write_views(rows, {"all": F.lit(True), "b": F.col("a") == "B"}, str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).groupBy("view").count().count() == 2
    for _ in range(2):
        sinks.append_json(rows, str(tmp_path / "j"), ["pmid"], "pmid string, a string")
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    sinks.write_with_side(rows, str(tmp_path / "m"), str(tmp_path / "s"), F.col("a") == "B")
    assert spark.read.json(str(tmp_path / "s")).count() == 1
    sinks.write_documents(rows, str(tmp_path / "d"), 4)
    sinks.write_delimited(rows, str(tmp_path / "t"))
    sinks.write_lines(rows, "pmid", str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "d")).count() == spark.read.text(str(tmp_path / "l")).count() == 2
    sinks.record_progress(spark, spark.createDataFrame([("1", "done"), ("2", "failed"), ("3", "absent")], "key string, status string"), str(tmp_path / "state"))
    left = sinks.still_to_do(spark, spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "key string"), str(tmp_path / "state"))
    assert sorted(r.key for r in left.collect()) == ["2", "4"]


def test_services(spark):
    def search(query, year, offset, size):
        ids = [f"{year}-{i}" for i in range(25)] + ["same"]
        return len(ids), ids[offset : offset + size]

    got = services.search_ids(spark, services.search_source(search, 1999, 2001, cap=9999, page=10), "q")
    assert got.count() == 76 and got.where("capped").count() == 0

    def fetch(keys):
        if "bad" in keys:
            raise OSError("down")
        return {k: f"body of {k}" * 9 for k in keys if k != "gone"}

    ids = spark.createDataFrame([("a",), ("gone",), ("bad",)], "id string")
    rows = services.fetched(ids, fetch, size=1, first_wait=0)
    assert {(r.id, r.status) for r in rows.collect()} == {("a", "done"), ("gone", "absent"), ("bad", "failed")}
    chain = services.with_fallback(rows, services.fetched(spark.createDataFrame([("gone",), ("a",)], "id string"), lambda ks: {k: "x" * 60 for k in ks}, first_wait=0))
    assert {(r.id, r.source) for r in chain.collect()} == {("a", "full_text"), ("gone", "abstract_only")}
    record = spark.createDataFrame([("1", [("pii", "x"), ("doi", "10.1")], "2001 Jan", "t", ["a", "b"], [("m",)])], "pmid string, article_ids array<struct<type:string,value:string>>, date string, title string, abstract_parts array<string>, subjects array<struct<name:string>>")
    row = services.flat_record(record).first()
    assert (row.doi, row.year, row.abstract, row.mesh) == ("10.1", "2001", "a b", ["m"])


def test_stream_appends_each_key_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5), (2, None), (2, 7), (1, 6)], "id int, v int")
    run = lambda: append_new(spark, str(tmp_path / "in"), "id int, v int", str(tmp_path / "out"), str(tmp_path / "cp"), ["id"], side=(F.col("v") > 6, str(tmp_path / "side")), reject=(F.col("v").isNull(), str(tmp_path / "bad")))
    rows.write.parquet(str(tmp_path / "in"))
    run()
    rows.union(spark.createDataFrame([(3, 9)], "id int, v int")).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert sorted((r.id, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, 5), (2, 7), (3, 9)]
    assert spark.read.parquet(str(tmp_path / "side")).count() == 2 and spark.read.parquet(str(tmp_path / "bad")).count() == 2


def test_command_line(spark, tmp_path):
    from quillmill.__main__ import parser, run

    made = {"q": lambda spark, d: spark.range(int(d)).select("id")}
    out = str(tmp_path / "out")
    run(spark, parser().parse_args(["q", "--data", "3", "--output", out]), made)
    run(spark, parser().parse_args(["q", "--data", "3", "--test", "5", "--output", out, "--resume", "id"]), made)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
    run(spark, parser().parse_args(["q", "--data", "9", "--dry"]), made)


def test_batch_that_runs_again(spark, tmp_path):
    """Side rows and rejects of a batch are there once, though its stream forgot the batch."""
    import shutil

    spark.range(10).write.parquet(str(tmp_path / "in"))
    p = lambda name: str(tmp_path / name)
    for _ in range(2):
        append_new(spark, p("in"), "id long", p("sink"), p("state"), ["id"], side=(F.col("id") > 6, p("side")), reject=(F.col("id") < 2, p("bad")), pattern="*.parquet")
        shutil.rmtree(p("state"))
    assert [spark.read.parquet(p(x)).count() for x in ("sink", "side", "bad")] == [8, 3, 2]
