"""Rates, searches, records, schemas, state, vocabularies and writers on small and odd inputs."""

import json
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quillmill.functions import models
from quillmill.functions.schemas import Items, Record, Value, keeps_to, violations
from quillmill.functions.vocabulary import term_hits
from quillmill.sources import readers, records, services, sinks, workbook
from quillmill.sources.pacing import LATE, Pace, Slots, shared_slots


class Clock:
    def __init__(self, late):
        self.now, self.late = 0.0, late

    def __call__(self):
        return self.now

    def sleep(self, s):
        self.now += s + next(self.late)


@pytest.mark.parametrize("tasks", [1, 3, 8])
def test_slots_keep_a_rate(tasks):
    """Whatever delays the tasks have, n + 1 calls of all of them take at least n / rate seconds."""
    rate, called = 10.0, []
    for i in range(tasks):
        clock = Clock(iter([0.0, 0.013, 0.019, 0.3, 0.0, 0.021, 0.07] * 99))
        pace = Pace(Slots(0.0, rate, tasks), i, clock, clock.sleep)
        for _ in range(40):
            called.append(pace.wait())
            clock.now += 0.004 * i
    called.sort()
    for n in (1, 5, 20):
        assert min(b - a for a, b in zip(called, called[n:])) >= n / rate - 1e-9
    assert len(called) == 40 * tasks and LATE < 1


def test_rate_of_tasks_that_run(spark):
    ids = spark.range(24).select(F.col("id").cast("string"))
    rows = services.fetched(ids, lambda keys: {k: k for k in keys}, size=1, at_once=4, rate=60.0).collect()
    at = sorted(r.called[0] for r in rows)
    assert len(at) == 24 and min(b - a for a, b in zip(at, at[6:])) >= 6 / 60.0 - 1e-3
    replies = models.with_reply(ids, "id", lambda s: s, at_once=3, rate=200.0)
    assert replies.where("reply = id").count() == 24
    with pytest.raises(ValueError):
        models.with_reply(ids, "id", lambda s: s, rate=5.0)
    with pytest.raises(ValueError):
        Slots.from_now(0, 1)


def test_no_rate_with_speculation(spark):
    assert shared_slots(spark, None, 3) is None and shared_slots(spark, 5.0, 3).tasks == 3
    with pytest.raises(ValueError):
        shared_slots(SimpleNamespace(conf={"spark.speculation": "true"}), 5.0, 3)


def test_search_reads_what_filters_leave(spark, tmp_path):
    log = str(tmp_path / "asked")

    def search(query, year, at, size):
        with open(log, "a") as f:
            f.write(f"{year} {at} {size}\n")
        return 10 * (year - 2000), [f"{year}-{i}" for i in range(at, min(10 * (year - 2000), at + size))]

    source = services.search_source(search, 2001, 2004, cap=25, page=4, pages_each=2)
    asked = lambda: [tuple(map(int, x.split())) for x in open(log)]
    rows = services.searched(spark, source, "q").where("year > 2001 and year <= 2003 and place >= 8").collect()
    assert sorted((r.year, r.place, r.capped) for r in rows) == [(2002, i, False) for i in range(8, 20)] + [(2003, i, True) for i in range(8, 25)]
    assert {y for y, _, _ in asked()} == {2002, 2003} and min(at for _, at, size in asked() if size) == 8
    assert services.searched(spark, source, "q").where("year = 2001").count() == 10
    assert services.searched(spark, source, "q").where("year = 1990").count() == 0
    assert services.searched(spark, source, "q").where("id like '2004-1%'").count() == 11
    with_rate = services.search_source(search, 2001, 2004, cap=25, page=4, rate=300.0)
    assert services.searched(spark, with_rate, "q", at_once=2).count() == 10 + 20 + 25 + 25
    ids = services.search_ids(spark, source, "q")
    assert ids.count() == 80 and ids.where("capped").count() == 50


def article(key="1", body="<ArticleTitle>T</ArticleTitle>", more=""):
    return f"<PubmedArticle><MedlineCitation><PMID>{key}</PMID><Article>{body}</Article></MedlineCitation>{more}</PubmedArticle>"


def test_records_and_rejects(spark, tmp_path):
    doi = '<PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/a</ArticleId><ArticleId IdType="doi">10.1/b</ArticleId></ArticleIdList></PubmedData>'
    cut = "<PubmedArticle><MedlineCitation><PMID>9</PMID><Article><Art"
    whole = '<?xml version="1.0"?>\n<PubmedArticleSet>' + article("1", "<ArticleTitle>A <i>b</i> &amp; c</ArticleTitle>", doi) + cut + article("2") + "\n" + article("") + "<PubmedArticle><MedlineCitation><PMID>3</PMID></MedlineCitation></PubmedArticle>" + article("4", "<b>") + "</PubmedArticleSet>"
    (tmp_path / "a.xml").write_text(whole)
    (tmp_path / "b.xml").write_text("")
    (tmp_path / "c.xml").write_text("no records here")
    good, bad = records.article_records(spark, str(tmp_path))
    got = {r.pmid: r for r in good.collect()}
    assert set(got) == {"1", "2"} and got["1"].doi == "10.1/a" and got["1"].title == "A <i>b</i> & c" and got["2"].year == "" and got["2"].mesh == [] and got["2"].abstract == ""
    assert sorted(r.reason for r in bad.collect()) == ["no article", "no end", "no id", "not well-formed"]


def test_large_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<Set>" + "\n".join(article(str(i), "<ArticleTitle>" + "x" * 500 + "</ArticleTitle>") for i in range(3000)) + "</Set>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        whole, broken = records.record_texts(spark, str(tmp_path))
        assert whole.rdd.getNumPartitions() > 5
        good, bad = records.article_records(spark, str(tmp_path))
        assert sorted(int(r.pmid) for r in good.select("pmid").collect()) == list(range(3000)) and bad.count() == broken.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_declared_records(spark):
    declared = Record({"a": Value("integer"), "b": Value("number", null=True), "c": Items(Items(Value(one_of=("x", "y")), least=1), most=2), "d": Record({"e": Value("boolean")}, required=(), closed=False)}, required=("a", "c"))
    cases = {
        '{"a": 1, "c": []}': [], '{"a": 1.5, "b": 2.5, "c": [["x"]]}': ["$.a: not integer"], '{"a": 1, "b": null, "c": [["z"], []]}': ["$.c[][]: not allowed", "$.c[]: too few"],
        '{"c": [["x"], ["y"], ["x"]], "d": {"e": 1, "f": 2}}': ["$.a: missing", "$.c: too many", "$.d.e: not boolean"], '{"a": null, "c": null}': ["$.a: not integer", "$.c: not an array"],
        '{"a": 1, "c": {}, "g": 0}': ["$.c: not an array", "$: not declared"], "null": ["$: not an object"], "": ["$: not JSON"], "nonsense": ["$: not JSON"], '{"a": 1, "c": [[1]]}': ["$.c[][]: not string"],
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "j string")
    got = {r.j: r for r in df.select("j", violations("j", declared).alias("v"), keeps_to("j", declared).alias("ok")).collect()}
    assert {k: sorted(v) for k, v in cases.items()} == {k: list(got[k].v) for k in cases} and got[None].v == ["$: not JSON"]
    assert [k for k in cases if got[k].ok] == ['{"a": 1, "c": []}']


def test_extractors_differ_by_configuration(spark):
    calls = []
    good = {"gene": "g", "disease": "d", "omim": None, "hgvs_coding": None, "hgvs_protein": "p", "gof_effect": "e", "class": "N", "is_human": False, "note": None, "evidence_text": "t"}

    def call(s):
        return {"good": json.dumps({"findings": [good]}), "many": json.dumps({"findings": [good] * 11}), "open": json.dumps({"findings": [{"gene": "g"}], "note": 1}), "text": "I cannot"}[s]

    df = spark.createDataFrame([("good",), ("many",), ("open",), ("text",), ("gone",), (None,)], "s string")
    strict = {r.s: r for r in models.extracted(df, "s", models.extractor(call, first_wait=0.0)).collect()}
    loose = {r.s: r for r in models.extracted(df, "s", models.stop_loss_extractor(call)).collect()}
    assert {k: r.status for k, r in strict.items()} == {"good": "done", "many": "invalid", "open": "invalid", "text": "invalid", "gone": "failed", None: "skipped"}
    assert {k: r.status for k, r in loose.items()} == {"good": "done", "many": "done", "open": "done", "text": "invalid", "gone": "failed", None: "skipped"}
    assert strict["many"].problems == "$.findings: too many" and strict["gone"].problems.startswith("KeyError") and strict["good"].findings[0].gene == "g" and strict["many"].findings is None
    assert len(loose["many"].findings) == 11 and loose["open"].findings[0].gene == "g" and not calls


def test_service_that_answers_late():
    answers = iter([OSError(), False, True])

    def probe():
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    assert models.healthy(probe, tries=3, wait=0.0)
    assert not models.healthy(lambda: False, tries=2, wait=0.0)


def test_state_changes_and_compaction(spark, tmp_path):
    path = str(tmp_path / "state")
    log = sinks.StateLog(spark, path)
    put = lambda **x: sinks.record_progress(spark, spark.createDataFrame(list(x.items()), "key string, status string"), path)
    now = lambda: {r.key: r.status for r in log.current().collect()}
    log.compact()
    assert now() == {}
    put(a="done", b="failed")
    put(a="failed", c="absent")
    assert now() == {"a": "failed", "b": "failed", "c": "absent"}
    log.compact()
    old = log.current()
    put(a="done", b="done")
    assert now() == {"a": "done", "b": "done", "c": "absent"}
    log.compact()
    log.compact()
    assert now() == {"a": "done", "b": "done", "c": "absent"} and {r.key: r.status for r in old.collect()} == {"a": "failed", "b": "failed", "c": "absent"}
    keys = spark.createDataFrame([("a",), ("d",)], "key string")
    assert [r.key for r in sinks.still_to_do(spark, keys, path).collect()] == ["d"]
    for i in range(4):
        put(**{f"k{i}": "done"})
        log.compact()
    names = sinks.Files(spark).names(path)
    assert len([n for n in names if n.startswith("base=")]) <= 2 and len([n for n in names if n.startswith("log=")]) <= 2 and len(now()) == 7


def test_run_that_broke_off_does_not_count(spark, tmp_path):
    path = str(tmp_path / "state")
    sinks.record_progress(spark, spark.createDataFrame([("a", "done")], "key string, status string"), path)
    spark.createDataFrame([("b", "done")], "key string, status string").write.parquet(f"{path}/log=000000002")
    sinks.Files(spark).delete(f"{path}/log=000000002/_SUCCESS")
    log = sinks.StateLog(spark, path)
    assert [r.key for r in log.current().collect()] == ["a"] and log.last() == 2


def plain_hits(text, terms, whole, fold):
    text = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if fold else text or ""
    edge = "[A-Za-z0-9_]"
    out = {}
    for t in set(filter(None, terms)):
        before = f"(?<!{edge})" if whole and re.match(edge, t[0]) else ""
        after = f"(?!{edge})" if whole and re.match(edge, t[-1]) else ""
        n = len(re.findall(f"(?={before}{re.escape(t)}{after})", text))
        if n:
            out[t] = n
    return out


@pytest.mark.parametrize("most", [1000, 3])
@pytest.mark.parametrize("whole, fold", [(True, False), (False, False), (True, True)])
def test_vocabulary(spark, most, whole, fold):
    terms = ["aa", "a", "aaa", "b c", "c", "é", "x-1", "-", "GOF", "gof", "", None, "a", "日本"]
    texts = [(1, "aa aaa a"), (2, "b c, bc b  c"), (3, "é éa aé x-1 x-12 GOF gof Gof"), (4, None), (5, ""), (6, "日本日本 a-a"), (6, "日本日本 a-a"), (None, "a")]
    docs = spark.createDataFrame([(i, t, "z") for i, t in texts], "doc_id long, text string, term string")
    got = sorted(map(str, map(tuple, term_hits(docs, spark.createDataFrame([(t,) for t in terms], "term string"), whole_words=whole, fold=fold, most=most).collect())))
    asked = [t.translate(str.maketrans("GOF", "gof")) if t and fold else t for t in terms]
    assert got == sorted(str((i, t, n)) for i, text in texts for t, n in plain_hits(text, asked, whole, fold).items())
    assert term_hits(docs, spark.createDataFrame([], "term string")).count() == term_hits(docs.limit(0), spark.createDataFrame([("a",)], "term string")).count() == 0


def test_files_for_rows(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.createDataFrame([("a b+c%", 1), ("x=y", 2), ("a b+c%", 0)], "k string, v int")
    assert sinks.export_documents(rows, "k", folder) == (2, 1)
    assert {(r.stem, r.v) for r in readers.json_folder(spark, folder, "k string, v int").collect()} == {("a b+c%", 0), ("x=y", 2)}
    assert sinks.export_documents(rows, "k", folder) == (0, 3)
    with pytest.raises(ValueError):
        sinks.export_documents(rows, "k", folder, most=2)
    broken = rows.withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("stopped"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stopped"):
        sinks.export_documents(broken, "k", str(tmp_path / "none"))
    assert sinks.Files(spark).names(str(tmp_path / "none")) == []


def test_counts_of_a_stream(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',), ("{",), ("  ",), ("[]",)], "value string").coalesce(1).write.text(p("in"))
    counts = readers.stream_counted(spark, p("in"), "a int", p("out"), p("state")).collect()
    assert [(r.read, r.bad) for r in counts] == [(spark.read.parquet(p("out")).where("status = 'read'").count(), spark.read.parquet(p("out")).where("status = 'bad'").count())] and counts[0].read + counts[0].bad == 4
    assert readers.stream_counted(spark, p("in"), "a int", p("out"), p("state")).count() == 0
    assert readers.copy_counted(spark, p("in"), "a int", p("copy")) == {"read": counts[0].read, "bad": counts[0].bad}


def test_styles_are_read_back(spark, tmp_path):
    data = workbook.workbook_bytes({"s": (["a", "b"], [[1, "x"], [2, "y"], [None, "z"]])}, fills={"2": "FF00FF00"}, fill_by="a")
    found = workbook.sheet_styles(data, "s")
    assert found["bold"] and found["frozen"] and found["fills"] == [None, "FF00FF00", None] and len(found["widths"]) == 2


def test_workbook_of_views(spark, tmp_path):
    """Order, odd characters, nulls, fills and widths; a view that fails leaves nothing, not even the old file's loss."""
    path = str(tmp_path / "r" / "a.xlsx")
    rows = spark.createDataFrame([(3, "x" * 90, "b"), (1, "a\x00&<é> \n b", None), (2, None, "hot")], "n int, s string, `c d` string")
    made = workbook.write_workbook(spark, {"all": rows.orderBy("n"), "none": rows.limit(0), "left": rows.limit(0)}, path, only_filled=("left",), fills={"hot": "FF112233"}, fill_by="c d")
    assert made == ["all", "none"]
    back = workbook.read_sheet(spark, path, ["n", "s", "c d"], "all").orderBy("_ord").collect()
    assert [tuple(r)[1:] for r in back] == [("1", "a&<é> \n b", ""), ("2", "", "hot"), ("3", "x" * 90, "b")]
    found = workbook.sheet_styles(open(path, "rb").read(), "all")
    assert found["bold"] and found["frozen"] and found["fills"] == [None, "FF112233", None] and found["widths"] == [3.0, 60.0, 6.0]
    assert workbook.sheet_styles(open(path, "rb").read(), "none")["fills"] == []
    with pytest.raises(Exception, match="stopped"):
        workbook.write_workbook(spark, {"all": rows.withColumn("n", F.when(F.col("n") > 1, F.raise_error(F.lit("stopped"))).otherwise(F.col("n")))}, path)
    with pytest.raises(ValueError):
        workbook.write_workbook(spark, {"all": rows}, path, most=2)
    assert workbook.read_sheet(spark, path, ["n"], "all").count() == 3
