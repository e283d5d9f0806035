"""Faults of the third round's findings that concern the operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quillmill.llm import near_text, quality
from quillmill.llm.support import mix


def test_quality_learns_from_all_pairs_of_all_labelled_documents(spark, monkeypatch):
    """The weights make the gradient over every pair vanish, the cut is the exact quantile, in several parts as in one."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.col("id") % 40 + 1), lambda i: F.when(F.xxhash64("id", i) % 7 < F.col("id") % 6, F.concat(F.lit("word"), i.cast("string"))).otherwise("XX!"))).alias("text"))
    labels = docs.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(10)) < F.col("doc_id") % 6 * 2).cast("int").alias("quality"))
    monkeypatch.setattr(quality, "_ROWS", 500)
    model = quality.fit(docs.repartition(5), labels)
    seen = docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).collect()
    x, y = np.array([quality.features(r.text.encode()) for r in seen]), np.array([r.quality for r in seen])
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.spread, x.std(axis=0) + 1e-6, atol=1e-6)
    z = model.units(x)
    s = model.strength(x)
    p = 1 / (1 + np.exp(s[y == 1][:, None] - s[y == 0][None, :]))
    gradient = quality.PAIRS * (z[y == 1].T @ p.mean(axis=1) / (y == 1).sum() - z[y == 0].T @ p.mean(axis=0) / (y == 0).sum()) - quality.RIDGE * model.weights
    assert abs(gradient).max() < 5e-3 * quality.PAIRS * abs(z[y == 1].mean(axis=0) - z[y == 0].mean(axis=0)).max()
    assert np.isclose(model.cut, np.quantile(s, 1 - y.mean()), rtol=0, atol=1e-9)
    monkeypatch.setattr(quality, "_ROWS", 1 << 16)
    one = quality.fit(docs, labels.union(labels))
    assert np.array_equal(one.weights, model.weights) and (one.cut, one.slope) == (model.cut, model.slope)


def test_near_duplicates_have_simhash_fingerprints(spark):
    """The segments on the ring are bits of a SimHash: a bit is that of over half the shingles, and few differ at a similarity of 0.8."""
    words = [f"w{i}" for i in range(304)]
    texts = [" ".join(words), " ".join(words[:266] + [f"x{i}" for i in range(38)]), "a b c", "", " ".join(words[:9]), " ".join(words[:8])]
    rows = spark.createDataFrame([(i, bytes([i]), t) for i, t in enumerate(texts)], "rep long, md5 binary, text string")
    got = {r.rep: r for r in near_text.sketched_rows(rows, 5).collect()}
    for i, text in enumerate(texts):
        grams, _ = near_text.shingle_sets([text.encode()], 5)
        hashes = [[int(h) for h in mix(np.array([g]) + near_text._SEEDS)] for g in np.unique(grams)]
        bits = np.unpackbits(np.frombuffer(got[i].sketch, np.uint8)).tolist()
        wanted = np.array([np.unpackbits(np.array(h, dtype=np.uint64).view(np.uint8)) for h in hashes]).sum(axis=0) * 2 > len(hashes)
        assert bits == wanted.astype(int).tolist() and (got[i].few is not None) == (len(hashes) <= 5)
    assert near_text.similarity(texts[0].encode(), texts[1].encode(), 5) < 0.8
    assert 0.11 < near_text.differing(*(np.frombuffer(got[i].sketch, np.uint8) for i in (0, 1))) / near_text.BITS < 0.2
    assert {(r.doc_id, r.component_id) for r in near_text.near_duplicate_classes(rows.withColumnRenamed("rep", "doc_id")).collect()} == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 4)}
