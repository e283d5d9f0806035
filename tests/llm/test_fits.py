"""Whole queries of fitted operators against plain versions, and what their thresholds decide."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmill.llm import quality, secret_scan, toxicity
from quillmill.llm.queries import op1_toxicity, op4_quality, op9_secrets
from quillmill.llm.support import table

DATA = "/root/testdata/sf0.001"


def held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labelled(spark):
    docs = {r.doc_id: r.text or "" for r in table(spark, DATA, "documents").collect()}
    return docs, {r.doc_id: r for r in table(spark, DATA, "labels").collect() if r.doc_id in docs}


def test_toxicity_query(spark, labelled):
    """Counts, K, calibration and scores again, one text at a time, without Spark but for the parts."""
    docs, labels = labelled
    model = toxicity.fit(table(spark, DATA, "documents"), table(spark, DATA, "labels"))
    rows = [(docs[i], int(r.toxic)) for i, r in labels.items() if not held(i)]
    parts = {r.text: r.part for r in spark.createDataFrame([(t,) for t in {t for t, _ in rows}], "text string").select("text", F.pmod(F.xxhash64("text", F.lit(3)), F.lit(toxicity.FOLDS)).alias("part")).collect()}

    def counted(kept):
        a, b, n, sizes = Counter(), Counter(), Counter(), Counter()
        for text, y in {x for x in rows if parts[x[0]] in kept}:
            sizes[y] += 1
            words = Counter(toxicity.tokens(text.encode()))
            (a if y else b).update({u for w in words for u in toxicity.units(w)})
            if not y:
                for w, times in words.items():
                    for u in toxicity.units(w):
                        n[u] += times
        return toxicity.from_counts(sorted((u, a[u], b[u], n[u]) for u in a.keys() | b.keys()), sizes[1], sizes[0])

    everything = set(range(toxicity.FOLDS))
    plain, others = counted(everything), {p: counted(everything - {p}) for p in everything}
    assert model.scores == pytest.approx(plain.scores) and model.decay == pytest.approx(plain.decay)
    best = [(max((s for _, _, s, _ in others[parts[t]].passages(t.encode())[0]), default=0.0), len(toxicity.tokens(t.encode())), others[parts[t]].decay) for t, y in rows if not y]
    assert model.scale == pytest.approx(max(0.5, sum(s > 0 for s, _, _ in best)) / sum(max(n, 1) * math.exp(-d * s) for s, n, d in best))
    for r in op1_toxicity(spark, DATA).collect():
        x, _ = model.evidence(docs[r.doc_id].encode())
        assert r.score == pytest.approx(1 / (1 + math.exp(-(model.slope * x + model.offset)))) and r.predicted == (r.score >= 0.5) and r.held_out == held(r.doc_id)


def test_quality_query(spark, labelled):
    """Pairs' weights, the quantile and the scores again, and predicted is 1 exactly from the quantile on."""
    docs, labels = labelled
    model = quality.fit(table(spark, DATA, "documents"), table(spark, DATA, "labels"))
    rows = [(quality.features(docs[i].encode()), r.quality) for i, r in labels.items() if not held(i)]
    x, y = np.array([f for f, _ in rows]), np.array([q for _, q in rows])
    assert np.allclose(model.mean, x.mean(axis=0)) and model.cut == pytest.approx(np.quantile(model.strength(x), 1 - y.mean()), abs=1e-9)
    for r in op4_quality(spark, DATA).collect():
        strength = model.strength(np.array([quality.features(docs[r.doc_id].encode())]))[0]
        assert r.predicted == (strength >= model.cut) and r.held_out == held(r.doc_id)
        assert r.score == pytest.approx(1 / (1 + math.exp(-np.clip(model.slope * (strength - model.cut) + math.log(0.3 / 0.7), -30, 30))))


def test_the_quantile_decides():
    """Weights from preferences alone: another share of good documents moves the cut, and with it what is accepted."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4))
    strength = x[:, 0] * 2 - x[:, 1]
    taken = []
    for share in (0.2, 0.5, 0.8):
        y = (strength > np.quantile(strength, 1 - share)).astype(int)
        model = quality.fit_arrays(x, y)
        accepted = model.score(x) >= quality.ACCEPTED
        assert abs(accepted.mean() - share) < 0.01 and (accepted == (y == 1)).mean() > 0.95
        taken.append(accepted.mean())
        moved = quality.QualityModel(model.mean, model.spread, model.weights, model.cut + 1.0, model.slope, model.offset)
        assert (moved.score(x) >= quality.ACCEPTED).sum() < accepted.sum()
    assert taken == sorted(taken)


def test_a_score_column_takes_the_place_of_another(spark):
    docs = spark.createDataFrame([(1, "some words here", 9.0), (2, None, None)], "doc_id long, text string, score double")
    model = quality.fit_arrays(np.zeros((0, len(quality.FEATURES))), np.zeros(0))
    out = quality.with_scores(docs, model)
    assert out.columns == ["doc_id", "text", "score"] and all(0 <= r.score <= 1 for r in out.collect())


def plain_candidates(text):
    import re

    return [(m.start(), m.end(), m.group()) for m in re.finditer(r"[A-Za-z0-9+/_=-]{12,}", text) if re.search("[0-9]", m.group())]


def test_secret_candidates(spark, labelled):
    """Places and values of every candidate of whole texts, many in one text too."""
    docs, _ = labelled
    more = {-1: "é " + " ".join(f"key{i}abcdefgh {'word' * 4}" for i in range(3000)) + " 🙂", -2: None, -3: "", -4: "abcdefghijklmnop", -5: "1" * 50_000 + "\n" + "x" * 50_000 + "1"}
    both = {**docs, **more}
    df = spark.createDataFrame(list(both.items()), "doc_id long, text string")
    got = defaultdict(list)
    for r in secret_scan.find_candidates(df).collect():
        got[r.doc_id].append((r.start, r.end, r.value))
        text = both[r.doc_id]
        before, after = text[: r.start], text[r.end :]
        assert before.endswith(r.before) and after.startswith(r.after) and len(r.before) <= secret_scan.CONTEXT
    assert {i: sorted(x) for i, x in got.items()} == {i: x for i, t in both.items() if (x := plain_candidates(t or ""))}


def test_secret_query_and_its_figures(spark, labelled):
    docs, _ = labelled
    found = {(r.doc_id, r.start, r.end, r.value) for r in op9_secrets(spark, DATA).collect()}
    assert found == {(i, *c) for i, t in docs.items() for c in plain_candidates(t)}
    large = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8)
    words = secret_scan.dictionary(large)
    taught = secret_scan.taught_findings(large, words).cache()
    trees = secret_scan.fit(taught.where("not judged"))
    figures = secret_scan.measured(taught.where("judged"), trees)
    assert figures["findings"] > 50 and figures["false_removed"] > 0.95 and figures["secrets_kept"] > 0.95


def test_forest_does_not_see_the_assignment(spark):
    """The word that makes a label changes no feature."""
    value = "b55e8abc1054b786f6b76df9eb5b259bbcc4c9e2"
    rows = [(value, 'export token = "', '" end'), (value, 'export ', '" end'), (f"password={value}", "export ", " end"), (value, "export ", " end")]
    x = [r.x for r in secret_scan.with_features(spark.createDataFrame(rows, "value string, before string, after string"), ["word"]).select("x").collect()]
    assert x[2] == x[3] and [a for a, b in zip(x[0], x[1]) if a != b] == []
