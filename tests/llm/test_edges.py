"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillmill.llm import decontaminate, hmm, near_text, pii, quality, secret_scan, sentencepieces, simhash, toxicity, winnowing
from quillmill.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rep long, score double, node string, quality_score string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa"


def odd(spark):
    long_ = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    texts = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, WORDS), (5, WORDS), (6, WORDS), (None, WORDS), (None, None), (7, long_), (8, "x" * 100_000), (9, "a.b@c.de 10.0.0.1 token = \"b55e8abc1054b786f6b76df9eb5b259bbcc4c9e2\"")]
    return spark.createDataFrame([(i, t, None, "s", None, 1, 2.0, "n", None) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def operators(spark, labels):
    real = spark.read.parquet(f"{DATA}/documents.parquet")
    items = spark.createDataFrame([(1, WORDS), (1, WORDS), (2, None), (None, "x")], "item_id long, text string")
    toxic, good, personal = toxicity.fit(real, labels), quality.fit(real, labels), pii.fit(real)
    return {
        "toxicity": lambda d: toxicity.score_documents(d, toxic), "passages": lambda d: toxicity.find_passages(d, toxic), "quality": lambda d: quality.score_documents(d, good), "pii": lambda d: pii.digests(pii.find_spans(d, personal)),
        "redact": lambda d: pii.redact(d, personal), "hmm": hmm.score_documents, "winnow": winnowing.fingerprints, "edited": winnowing.edited_comparison, "simhash": simhash.near_duplicates, "near": near_text.drop_near_duplicates,
        "secrets": secret_scan.scan, "contaminated": lambda d: decontaminate.find_contamination(d, items), "clean": lambda d: decontaminate.clean_documents(d, items), "pieces": sentencepieces.encode_and_decode,
    }


def test_odd_rows(spark, labels):
    docs = odd(spark)
    n = docs.count()
    got = {name: f(docs).collect() for name, f in operators(spark, labels).items()}
    for name in ("toxicity", "quality", "pii", "redact", "hmm", "winnow", "edited", "simhash", "pieces"):
        assert len(got[name]) == n, name
    assert all(0 <= r.score <= 1 for name in ("toxicity", "quality") for r in got[name])
    by = {r.doc_id: r for r in got["simhash"]}
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1 and by[6].component_id == 5
    assert [r.component_id for r in got["simhash"] if r.doc_id is None and r.fp != 0] == [5]
    kept = [r.doc_id for r in got["near"]]
    assert sorted(i for i in kept if i is not None) == [1, 4, 5, 7, 8, 9] and kept.count(None) == 2
    assert {(r.doc_id, r.item_id) for r in got["contaminated"]} == {(5, 1), (6, 1), (None, 1)} and len(got["clean"]) == n - 4
    assert any(r.is_secret for r in got["secrets"] if r.doc_id == 9) and all(docs.where(F.col("doc_id") == r.doc_id).first().text[r.start : r.end] == r.value for r in got["secrets"] if r.doc_id == 9)
    copies = [r for r in got["hmm"] if r.doc_id == 5]
    assert len(copies) == 2 and copies[0] == copies[1]
    assert all(r.n_tokens == 1 for r in got["hmm"] if r.doc_id in (1, 2, 3))


def test_empty_tables(spark, labels):
    empty = odd(spark).limit(0)
    for name, f in operators(spark, labels).items():
        assert f(empty).count() == 0, name
    none = labels.limit(0)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert toxicity.score_documents(docs, toxicity.fit(docs, none)).where("predicted = 1").count() == 0
    assert quality.score_documents(docs, quality.fit(docs, none)).where("predicted = 0").count() == 0
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(docs, no_items).count() == 0 and decontaminate.clean_documents(docs, no_items).count() == docs.count()


def test_stages_on_odd_and_empty_rows(spark):
    for docs in (odd(spark), odd(spark).limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, DATA)
            assert out.columns == docs.columns, name
            out.collect()
        assert "ids" in corpus_pipeline.STAGES[-1][1](spark, docs, DATA).columns


def test_pipeline_decisions(spark):
    base = " ".join(f"word{i}" for i in range(200))
    near = base.replace("word50 ", "other ")
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").orderBy("item_id").first().text
    texts = {1: base, 2: base, 3: near, 4: f"{base[::-1]} {item} end", 5: "A quiet line, written to ab.1@mail5.example.com today. " + " ".join(f"calm{i}" for i in range(60)) + "."}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    docs = near_stage = corpus_pipeline.drop_near_duplicates(spark, docs, DATA)
    assert sorted(r.doc_id for r in near_stage.collect()) == [1, 4, 5]
    docs = corpus_pipeline.decontaminate_benchmark(spark, docs, DATA)
    assert sorted(r.doc_id for r in docs.collect()) == [1, 5]
    row = corpus_pipeline.redact_pii(spark, docs, DATA).where("doc_id = 5").first()
    assert "[EMAIL]" in row.text and "@" not in row.text and row.n_chars == len(row.text)


def test_accuracy_on_held_out_labels(spark):
    data = "/root/testdata/sf0.01"
    for name, label in (("op1_toxicity", "toxic"), ("op4_quality", "quality")):
        rows = QUERIES[name](spark, data).where("held_out").join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").select("score", F.col(label).alias("y")).collect()
        ones, zeros = [r.score for r in rows if r.y == 1], [r.score for r in rows if r.y == 0]
        assert sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros)) > 0.8, name


def test_secret_forest_matches_its_trees(spark):
    from quillmill.llm.trees import forest, tree_values
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.random((300, 4))
    y = (x[:, 0] + 0.2 * rng.random(300) > 0.6).astype(int)
    trees = forest(x, y, trees=5, depth=4)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "i int, x array<double>")
    got = [r.s for r in df.select("i", secret_scan.forest_score(trees).alias("s")).orderBy("i").collect()]
    wanted = sum(tree_values(t, x) for t in trees) / len(trees)
    assert np.allclose(got, wanted) and ((wanted > 0.5) == y).mean() > 0.9


def test_secret_plan_has_no_python(spark):
    df = secret_scan.scan(spark.read.parquet(f"{DATA}/documents.parquet"))
    plan = df._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
