"""Texts that begin or end within a benchmark item, edited ones and small blocks, against all windows."""

import math
import time
from collections import Counter

import numpy as np
import pytest

from quillmill.llm import decontaminate
from quillmill.llm.support import hashed_words

BLOCKS_OF = decontaminate.blocks_of


def grams(words):
    k = min(5, len(words))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def plain(texts, items):
    """{(text, item)} with a window of the item's length, clipped at the text's end, that is similar enough."""
    counts = Counter(g for x in items for g in set(grams(x)))
    weight = lambda g: math.log(1 + len(items) / max(1, counts[g])) + 0.1
    found = {}
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            n, own = len(grams(item)), Counter(grams(item))
            k = min(5, len(item))
            if not set(text) & set(item):
                continue
            every = [tuple(text[j : j + k]) for j in range(len(text) - k + 1)]
            best = 0.0
            for at in range(len(every)):
                window = Counter(every[at : at + n])
                both = sum(c * weight(g) for g, c in (window & own).items())
                if both:
                    best = max(best, both / (sum(c * weight(g) for g, c in (window | own).items())))
            if best >= 0.8 - 1e-9:
                found[t, i] = best
    return found


def cut_texts(item, name):
    """The item's beginnings and ends, alone and with other words on their other side."""
    other = [f"{name}other{i}" for i in range(30)]
    for lost in range(1, len(item) // 4 + 6):
        if lost < len(item):
            yield item[:-lost]
            yield other + item[:-lost]
            yield item[lost:]
            yield item[lost:] + other


def found_by(index, texts):
    words, bounds = hashed_words([" ".join(x).encode() for x in texts], decontaminate._BREAKS)
    return {k: s for k, (s, _) in decontaminate.matches(words, bounds, index, 5, 0.8, 3).items()}


def test_texts_that_begin_or_end_within_an_item():
    items = [[f"n{n}w{i}" for i in range(n)] for n in (*range(1, 24), 30, 39, 40, 44, 60, 90)]
    texts = [t for item in items for t in cut_texts(item, item[0])]
    index = decontaminate.build_index([(i, " ".join(x)) for i, x in enumerate(items)], 5, 0.8, (8, 16, 32), 3)
    wanted = plain(texts, items)
    assert found_by(index, texts) == pytest.approx(wanted) and len(wanted) > 100


def test_items_with_common_passages_and_edited_texts():
    rng = np.random.default_rng(4)
    common = [f"common{i}" for i in range(60)]
    items = [[f"i{n}a{i}" for i in range(a)] + common[:b] + [f"i{n}c{i}" for i in range(c)] for n, (a, b, c) in enumerate(rng.integers(0, 25, (12, 3)).tolist()) if a + c > 8]
    items += [common + [f"x{i}" for i in range(9)]]
    texts = []
    for item in items:
        texts += cut_texts(item, item[0])
        for _ in range(6):
            edited = list(item)
            at = int(rng.integers(0, len(item)))
            edited[at : at + int(rng.integers(0, 2))] = [f"new{at}"] * int(rng.integers(0, 2))
            texts.append(["before", *edited, "after"])
    index = decontaminate.build_index([(i, " ".join(x)) for i, x in enumerate(items)], 5, 0.8, (8, 16, 32), 3)
    wanted = plain(texts, items)
    assert found_by(index, texts) == pytest.approx(wanted) and len(wanted) > 100


def test_similarities_do_not_depend_on_the_blocks(spark, monkeypatch):
    common = [f"common{i}" for i in range(12)]
    items = [[f"i{n}a{i}" for i in range(12 + n)] + common for n in range(9)]
    texts = [t for item in items for t in cut_texts(item, item[0])] + [items[0] + items[5]]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(texts)], "doc_id long, text string")
    benchmark = spark.createDataFrame([*((i, " ".join(x)) for i, x in enumerate(items)), (None, " ".join(common)), (99, None)], "item_id long, text string")
    wanted = plain(texts, items)
    for size in (5_000, 4):
        monkeypatch.setattr(decontaminate, "blocks_of", lambda b, n=size: BLOCKS_OF(b, n))
        got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find_contamination(docs, benchmark).collect()}
        assert got == pytest.approx(wanted)
        assert {r.doc_id for r in decontaminate.clean_documents(docs, benchmark).collect()} == set(range(len(texts))) - {t for t, _ in wanted}


@pytest.mark.parametrize("pairs", [1 << 20, 64])
def test_repeated_words(monkeypatch, pairs):
    monkeypatch.setattr(decontaminate, "PAIRS", pairs)
    line = [f"l{i}" for i in range(9)]
    items = [["w"] * 60, ["w"] * 9, line * 6, line, ["a", "b"] * 20, ["w"] * 20 + line + ["w"] * 20, ["w"] * 4]
    texts = [["w"] * n for n in (3, 8, 30, 47, 48, 61, 300)] + [line * n for n in (1, 4, 5, 9)] + [["x"] + line * 5 + ["w"] * 70, ["a", "b"] * 15 + ["c"] + ["a", "b"] * 30, ["w"] * 17 + line + ["w"] * 17]
    index = decontaminate.build_index([(i, " ".join(x)) for i, x in enumerate(items)], 5, 0.8, (8, 16, 32), 3)
    wanted = plain(texts, items)
    assert found_by(index, texts) == pytest.approx(wanted) and len(wanted) > 20


def test_a_long_text_of_one_word_costs_its_length():
    items = [["w"] * (60 + i) for i in range(20)]
    index = decontaminate.build_index([(i, " ".join(x)) for i, x in enumerate(items)], 5, 0.8, (8, 16, 32), 3)
    began = time.process_time()
    assert len(found_by(index, [["w"] * 100_000])) == 20
    assert time.process_time() - began < 30  # its product took minutes
