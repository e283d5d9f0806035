"""Features and labelled texts are those of whole texts, not of their beginnings."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillmill.llm import quality, toxicity


def plain(raw):
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n = max(1, len(words))
    return {
        "distinct": len(set(words)) / n**0.8,
        "most_common": max(Counter(words).values(), default=0) / n,
        "same_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "line_words": math.log1p(n / max(1, len(lines))),
    }


def named(raw):
    return dict(zip(quality.FEATURES, quality.features(raw)))


@pytest.mark.parametrize("block", [1 << 20, 1 << 10])
def test_all_lines_of_a_text_count(monkeypatch, block):
    monkeypatch.setattr(quality, "_BLOCK", block)
    late = b"".join(b"line %d of a text\n" % i for i in range(20_000)) + b"buy it now\n" * 200_000
    many = b"\n".join(b"two words%d" % i for i in range(90_000))
    for raw in (late, many, b"\n \n\t\n", b"\n", b"one", b"a\n\n a\na\r\na", late + b"x" * 5000 + b"\n" + many):
        got = named(raw)
        assert {k: got[k] for k in ("same_lines", "line_words")} == pytest.approx({k: plain(raw)[k] for k in ("same_lines", "line_words")})
    assert named(late)["same_lines"] > 0.9


@pytest.mark.parametrize("block", [1 << 20, 1 << 12])
def test_all_words_of_a_text_count(monkeypatch, block):
    monkeypatch.setattr(quality, "_BLOCK", block)
    tail = b" ".join(b"w%d" % i for i in range(300_000)) + b" spam" * 700_000
    for raw in (tail, tail.replace(b" ", b"\n"), b"a a b", b" ", b"x" * 9000 + b" y" * 9000):
        got = named(raw)
        assert {k: got[k] for k in ("distinct", "most_common")} == pytest.approx({k: plain(raw)[k] for k in ("distinct", "most_common")})
    assert named(tail)["most_common"] == 0.7


def test_texts_of_one_beginning_all_count_toxic_words(spark):
    header = "This document is licensed under the same terms as all others of its source. "
    texts = [(i, header + f"page{i} words{i} " + ("vilest " if i % 2 else "kindly ") + " ".join(f"w{i}x{j}" for j in range(5))) for i in range(400)]
    texts += [(1000 + i, header + "copied chanceword " + ("vilest" if i % 2 else "kindly")) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.scores.get(b"vilest ", 0) > 0 and b"chanceword " not in model.scores
    assert model == toxicity.fit(docs.orderBy(F.desc("doc_id")), labels)
