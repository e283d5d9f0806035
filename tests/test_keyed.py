"""Commits, key index, keep-first places and numbering without a partition column."""

import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quillmill.operators import rows as R
from quillmill.sources import sinks
from quillmill.streaming import keyed
from quillmill.streaming.incremental import append_new


def plan(df):
    return df._jdf.queryExecution().toString()


def test_side_rows_of_a_second_file_and_checkpoint(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    run = lambda state: append_new(spark, p("in"), "id long", p("sink"), p(state), ["id"], side=(F.col("id") % 2 == 1, p("side")), pattern="*.parquet")
    spark.createDataFrame([(1,), (2,)], "id long").coalesce(1).write.parquet(p("in"))
    run("a")
    spark.createDataFrame([(3,), (4,), (1,)], "id long").coalesce(1).write.mode("append").parquet(p("in"))
    run("b")
    ids = lambda name: sorted(r.id for r in spark.read.parquet(p(name)).collect())
    assert ids("sink") == [1, 2, 3, 4] and ids("side") == [1, 3]
    assert sorted(r.id for r in keyed.committed(spark, p("side"), "id long").collect()) == [1, 3]


@pytest.mark.parametrize("new_checkpoint", [False, True])
def test_batch_that_breaks_off(spark, tmp_path, new_checkpoint):
    p = lambda name: str(tmp_path / name)
    spark.range(20).coalesce(1).write.parquet(p("in"))
    broken = F.when(F.col("id") == 7, F.raise_error(F.lit("stopped"))).otherwise(F.lit(True)).cast("boolean")
    run = lambda state, side: append_new(spark, p("in"), "id long", p("sink"), p(state), ["id"], side=(side, p("side")), pattern="*.parquet")
    with pytest.raises(StreamingQueryException):
        run("a", broken)
    assert keyed.Files(spark).exists(p("sink_keys/begun"))
    if new_checkpoint:
        spark.range(15, 30).coalesce(1).write.mode("append").parquet(p("in"))
    run("b" if new_checkpoint else "a", F.col("id") > 5)
    most = 30 if new_checkpoint else 20
    assert sorted(r.id for r in spark.read.parquet(p("sink")).collect()) == list(range(most))
    assert sorted(r.id for r in spark.read.parquet(p("side")).collect()) == list(range(6, most))
    assert not keyed.Files(spark).exists(p("sink_keys/begun"))


def test_commit_that_was_made_but_not_settled(spark, tmp_path):
    """The state has the commit, the marker is lacking: the next run finishes it and keeps its rows."""
    p = lambda name: str(tmp_path / name)
    spark.range(5).coalesce(1).write.parquet(p("in"))
    run = lambda state: append_new(spark, p("in"), "id long", p("sink"), p(state), ["id"], pattern="*.parquet")
    run("a")
    last = keyed.KeyedSink(spark, p("sink"), ["id"], spark.range(1).schema)._state()["last"]
    files = keyed.Files(spark)
    files.delete(p(f"sink/commit={last}/_COMMITTED"))
    files.write(p("sink_keys/begun"), last.encode())
    shutil.rmtree(p("a"))
    run("a")
    assert sorted(r.id for r in spark.read.parquet(p("sink")).collect()) == list(range(5)) and files.exists(p(f"sink/commit={last}/_COMMITTED"))


def test_reads_of_a_batch_do_not_grow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "MERGED", 3)
    schema, path = spark.range(1).schema, str(tmp_path / "sink")
    read = []
    for i in range(11):
        table = keyed.KeyedSink(spark, path, ["id"], schema, buckets=4)
        rows = spark.range(10 * i, 10 * i + 15)
        if i:
            read.append(len(table.known(spark.range(5, 6)).inputFiles()))
            assert table.unknown(rows).count() == (10 if i else 15)
        name = keyed.content_id([(i,)])
        table.begin(name)
        table.unknown(rows).write.parquet(f"{path}/commit={name}")
        table.commit(name)
    assert max(read) <= 4 * 3 * 2 and sum(len(x) for x in table._state()["levels"]) <= 5
    assert spark.read.parquet(path).select("id").count() == 115 == spark.read.parquet(path).select("id").distinct().count()


def test_table_without_an_index_gets_one(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    spark.range(5).write.parquet(p("sink"))
    table = keyed.KeyedSink(spark, p("sink"), ["id"], spark.range(1).schema)
    assert sorted(r.id for r in table.unknown(spark.range(3, 8)).collect()) == [5, 6, 7]
    assert sorted(r.id for r in keyed.KeyedSink(spark, p("sink"), ["id"], spark.range(1).schema).unknown(spark.range(3, 8)).collect()) == [5, 6, 7]


def test_commits_are_named_by_content():
    assert keyed.content_id([("b", 1), ("a", 2)]) == keyed.content_id([("a", 2), ("b", 1)]) != keyed.content_id([("a", 2)])


def test_keep_first_of_a_hot_key(spark):
    """One key has 90 % of the rows; ties and equal rows; texts as keys; nulls are one key."""
    rows = [(None if i % 50 == 0 else "hot" if i % 10 else f"k{i % 7}", i % 13 if i % 5 else None, "text " * 20 + str(i % 40)) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, v int, body string").repartition(16)
    first, last, lost = R.keep_first(df, ["k"], ["v", "body"]), R.keep_last(df, ["k"], ["v", "body"]), R.losers(df, ["k"], ["v", "body"])
    low = lambda r: (r[1] is not None, r[1] or 0, r[2])
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    assert sorted(map(str, map(tuple, first.collect()))) == sorted(str(min(g, key=low)) for g in groups.values())
    assert sorted(map(str, map(tuple, last.collect()))) == sorted(str(max(g, key=low)) for g in groups.values())
    both = sorted(map(str, map(tuple, first.union(lost).collect())))
    assert both == sorted(map(str, rows))
    for df in (first, last, lost):
        assert "Window" not in plan(df)


def test_keep_first_is_the_same_on_any_partitioning(spark):
    df = spark.range(500).select((F.col("id") % 9).alias("k"), F.lit(1).alias("v"), F.col("id").alias("other"), F.array("id").alias("a"), F.create_map(F.lit("x"), "id").alias("m"))
    got = [sorted(map(str, R.keep_first(df.repartition(n), ["k"], ["v"]).collect())) for n in (1, 7)]
    assert got[0] == got[1] and len(got[0]) == 9
    assert R.keep_first(df.limit(0), ["k"], ["v"]).count() == R.losers(df.limit(0), ["k"], ["v"]).count() == 0


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 2, "x"), (1, 3, "y")], ["k", "a.b", "c d"])
    assert [tuple(r) for r in R.keep_first(df, ["k"], ["`a.b`"]).collect()] == [(1, 2, "x")]
    assert sorted(map(tuple, R.losers(df, ["k"], ["`a.b`"]).collect())) == [(1, 2, "x"), (1, 3, "y")]
    assert R.numbered(df, ["k", "`a.b`"]).select("n").distinct().count() == 3


def test_top_scored_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 0.5, 3), ("a", 0.5, 2), ("b", None, 4)], "k string, s double, o int")
    assert sorted(map(tuple, R.top_scored(df, ["k"], "s", ["o"]).collect())) == [("a", 0.5, 2), ("b", None, 4)]


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_numbers_over_all_rows(spark, n):
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 7919 % 1000).alias("o"), F.when(F.col("id") % 11 > 0, F.col("id") % 5).alias("v"))
    got = sorted(map(tuple, R.numbered(df.repartition(5), ["o", "id"]).select("n", "o", "id").collect()))
    assert [g[0] for g in got] == list(range(n)) and [g[1:] for g in got] == sorted(g[1:] for g in got)
    for kind in ("long", "decimal(12,2)", "double"):
        sums = R.running_total(df.withColumn("v", F.col("v").cast(kind)), "v", ["o", "id"], [], "total").orderBy("o", "id").collect()
        total = None
        for r in sums:
            total = total if r.v is None else (total or 0) + r.v
            assert r.total == total
    assert sorted(r.batch for r in R.in_batches(df, "id", 100).select("batch").distinct().collect()) == list(range(-(-n // 100)))


def test_ranges_are_even_where_a_value_is_frequent(spark):
    df = spark.range(40_000).select("id", F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id")).alias("o"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one range
    try:
        sizes = sorted(r["count"] for r in R._in_ranges(df, ["o"]).groupBy("_part").count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 8 and sizes[-1] < 2 * sizes[len(sizes) // 2]


def test_json_appends_and_side_files_once(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id long, s string")
    for _ in range(2):
        sinks.append_json(rows.dropDuplicates(["id"]), p("a"), ["id"])
        sinks.write_with_side(rows.repartition(3), p("all"), p("side"), F.col("id") > 1)
    sinks.append_json(spark.createDataFrame([(2, "d"), (3, "e")], "id long, s string"), p("a"), ["id"])
    read = lambda n: spark.read.schema("id long, s string").json(p(n))
    assert sorted(r.id for r in read("a").collect()) == [1, 2, 3] and read("all").count() == 3 and read("side").count() == 2
    assert keyed.rows_id(rows) == keyed.rows_id(rows.repartition(2)) != keyed.rows_id(rows.limit(2))
