"""What tasks hold at once, and what they leave behind."""

import gc
import tracemalloc
import weakref

import numpy as np

from quillmill.llm import sentencepieces, support
from quillmill.llm.decontaminate import _BREAKS


def test_pieces_go_with_their_task():
    """No circle keeps a task's tables of words until the collector comes by."""
    gc.disable()
    try:
        pieces = sentencepieces.Pieces(sentencepieces._model(sentencepieces.MODEL))
        assert pieces.encode("some words, words and words") == pieces.processor.encode("some words, words and words")
        gone = weakref.ref(pieces)
        del pieces
        assert gone() is None
    finally:
        gc.enable()


def test_words_are_remembered_in_bounds(monkeypatch):
    monkeypatch.setattr(sentencepieces, "WORDS", 40)
    monkeypatch.setattr(sentencepieces, "BEGINNINGS", 60)
    pieces = sentencepieces.Pieces(sentencepieces._model(sentencepieces.MODEL))
    for n in range(0, 400, 10):
        text = " ".join(f"w{i * i}ordé{i}" for i in range(n, n + 10)) + " " + "x" * 80 + f"{n} and and"
        assert pieces.encode(text) == pieces.processor.encode(text)
        assert len(pieces.words) <= 40 and max(map(len, pieces.words)) <= sentencepieces.LONGEST_REMEMBERED


def test_words_hashed_in_blocks(monkeypatch):
    texts = [b"", b"One two,  three\n" * 40, b" ", b"x" * 9000 + b" y" + b"z" * 5000, b"\xc3\xa9t\xc3\xa9 AND so on", b"last"]
    for separator in (support.byte_class(support.SPACES), _BREAKS):
        monkeypatch.setattr(support, "HASHED_AT_ONCE", 1 << 20)
        words, bounds = support.hashed_words(texts, separator)
        for block in (1, 7, 100, 4096):
            monkeypatch.setattr(support, "HASHED_AT_ONCE", block)
            again, at = support.hashed_words(texts, separator)
            assert np.array_equal(words, again) and np.array_equal(bounds, at)


def test_hashing_holds_a_block():
    """8 MB of texts: 326 MB at once before they were hashed in blocks."""
    texts = [b"some words of a text " * 95] * 1000
    tracemalloc.start()
    support.hashed_words(texts * 4, _BREAKS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100_000_000
