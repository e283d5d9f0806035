import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmill.functions import detectors as D
from quillmill.functions import models, notation, sections, text


def values(spark, column, given, kind="string"):
    rows = [(i, x) for i, x in enumerate(given)]
    return [r[0] for r in spark.createDataFrame(rows, f"i int, x {kind}").orderBy("i").select(column).collect()]


def test_normal_forms(spark):
    codes = ["NM_0012.3:c.724_727delTGCT", "c.5dupA", " C.10delinsTT ", "c.10insA", None, ""]
    assert values(spark, notation.coding_normal("x"), codes) == ["c.724_727del", "c.5dup", "c.10delinsTT", "c.10insA", "", ""]
    proteins = ["p.(Q568fs*3)", "p.Gln568ArgfsTer3", "P.R123*", "R123X", "p.Q5Rfs*2", "", None, "p.q568rfs3"]
    assert values(spark, notation.protein_normal("x"), proteins) == ["p.gln568fster3", "p.gln568fster3", "p.arg123ter", "p.arg123xaa", "p.gln5fster2", "", "", "p.gln568fster3"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("cCpP.delupinsACGT_123> ", max_size=14), min_size=1, max_size=8))
def test_coding_key_is_idempotent_on_normal_forms(spark, given_):
    once = values(spark, notation.coding_normal("x"), given_)
    again = values(spark, notation.coding_normal("x"), once)
    third = values(spark, notation.coding_normal("x"), again)
    assert [len(a) >= len(b) for a, b in zip(once, again)] == [True] * len(once) and len(third) == len(again)


def test_identifiers_and_positions(spark):
    got = values(spark, notation.parsed_id("x"), ["#1#c.1A>G", "#1#p.R1X", "rs1##", None])
    assert [tuple(r) for r in got] == [("c.1A>G", ""), ("", "p.R1X"), ("", ""), ("", "")]
    assert values(spark, notation.positions("x"), ["p.R123G12c123", None]) == [["123", "12"], []]
    assert values(spark, notation.is_relevant("x", F.lit("")), ["p.Q5 fs", "R123X", "missense", "splicing", "Ter", "extra"]) == [True, True, False, True, True, True]


def test_guards(spark):
    assert values(spark, notation.valid_coding("x"), ["c.1A>G", "C.*5", "g.12", None]) == ["c.1A>G", "C.*5", "", ""]
    assert values(spark, notation.one_of("x", ("H", "N"), "N"), ["h", " N ", "x", None]) == ["H", "N", "N", "N"]
    assert values(spark, notation.loose_boolean("x"), ["false", "true", None, "No", "1"]) == [False, True, True, False, True]
    assert values(spark, text.band("x"), [0.7, 0.69, 0.4, 0.1, None], "double") == ["HIGH", "MID", "MID", "LOW", "LOW"]
    assert values(spark, text.strip("x"), ["\t a b \n", ""]) == ["a b", ""]


def test_detectors(spark):
    rows = ["No gain-of-function", "constitutively active", "Oryza sativa", "loss of function", "NMD", "neomorphic", "plain"]
    got = spark.createDataFrame([(r,) for r in rows], "x string").select("x", *text_flags()).collect()
    flags = {r.x: {k for k, v in r.asDict().items() if v is True} for r in got}
    assert flags["No gain-of-function"] >= {"negated_claim", "claim"} and flags["Oryza sativa"] == {"non_human"}
    assert "loss" in flags["loss of function"] and "decay" in flags["NMD"] and "new_function" in flags["neomorphic"] and flags["plain"] == set()


def text_flags():
    from quillmill.functions.detectors import detected

    return detected("x", **D.DETECTORS)


def test_tiers(spark):
    got = values(spark, text.tiered_match("x", D.TIERS), ["a stop-loss variant with p.*278Glyext", "translational readthrough", "none", None])
    assert [tuple(r) for r in got] == [("tier1", "tier1:stop-loss | tier2:p.*278Glyext"), ("tier3", "tier3:translational readthrough"), ("", ""), ("", "")]


def test_prompt_budget(spark):
    rows = spark.createDataFrame([("T", {"abstract": "A" * 30, "results": "We saw c.12A>G here. " + "R" * 90, "methods": "M" * 50})], "title string, s map<string,string>")
    found = text.distinct_sentences([F.element_at("s", F.lit("results"))], D.NOTATION_SENTENCE)
    prompt = rows.select(text.budgeted_prompt("title", "s", found, ["abstract", "results", "methods"], budget=100, snippet_limit=15)).first()[0]
    assert prompt == "Title: T\n\n[VARIANTS]\nWe saw c.12A>G \n\n[ABSTRACT]\n" + "A" * 30 + "\n\n[RESULTS]\nWe saw c.12A>G here. " + "R" * 34
    empty = spark.createDataFrame([("T", {})], "title string, s map<string,string>")
    assert empty.select(text.budgeted_prompt("title", "s", F.array().cast("array<string>"), ["abstract"])).first()[0] == "Title: T\n\n"


def test_replies(spark):
    reply = '<think>hm\n</think>\n```json\n{"findings": []}\n```'
    assert values(spark, text.reply_json("x"), [reply, None]) == ['{"findings": []}', ""]
    got = values(spark, text.parsed_reply("x", f"findings {models.FINDINGS}"), [reply, "broken"])
    assert got[0].findings == [] and (got[1] is None or got[1].findings is None)


def test_sections():
    xml = "<article><front><article-title>T</article-title><abstract><p>Ab</p></abstract></front><body><sec><title>2. Methods</title><p>m1</p><sec><title>Results</title><p>r</p></sec></sec><sec><title>methods</title><p>m2</p></sec></body></article>"
    assert sections.article_sections(xml) == {"title": "T", "abstract": "Ab", "methods": "m1 Results r", "results": "r"}
    assert sections.article_sections("<broken") == {}
    page = sections.page_sections("<html><title>X</title><script>no</script><p>a</p><h1>H &amp; I</h1>b<br>c</html>")
    assert page == {"X": "a", "H & I": "b c"}


def test_model_calls(spark):
    rows = spark.createDataFrame([(1, "a token"), (2, "a token"), (3, None), (4, "boom")], "id int, x string")

    def call(t):
        if t == "boom":
            raise ValueError("no")
        return str(len(t))

    got = {r.id: (r.reply, r.reply_error) for r in models.with_reply(rows, "x", call, first_wait=0).collect()}
    assert got == {1: ("7", ""), 2: ("7", ""), 3: (None, None), 4: (None, "ValueError: no")}
    assert models.healthy(lambda: True) and not models.healthy(lambda: 1 / 0, wait=0)


def test_query_composer():
    assert text.search_query([["a b"], ["c"]], "English", 1995, 2025) == '(("a b"[Title/Abstract]) OR ("c"[Title/Abstract])) AND English[Language] AND 1995:2025[dp]'


@pytest.mark.parametrize("wanted,given_,score", [("a b", "b c", 0.5), ("a", "{a}", -1.0), ("", "a", 0.0), ("A  b", "b a", 1.0)])
def test_word_overlap(spark, wanted, given_, score):
    assert spark.range(1).select(notation.word_overlap(F.lit(wanted), F.lit(given_))).first()[0] == score


def test_sentences_by_their_stop_are_those_of_the_pattern(spark):
    texts = ["", None, ".", "Aa. b.c. .. 9x. Aa.", "x" * 61 + ".", "y" * 62 + ".", "A, " * 40 + ". z.\nq", "no stop", "É é e. \n.", "a\n. b. B.", "1. a 2, b. " * 3]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    pattern = r"[A-Z][a-z ,]{0,60}[.]"
    got = df.select(text.distinct_sentences(["text"], pattern).alias("a"), text.distinct_sentences(["text"], pattern, stop=".", longest=62).alias("b")).collect()
    assert any(r.a for r in got) and all(r.a == r.b for r in got)
