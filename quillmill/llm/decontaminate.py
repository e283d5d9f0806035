"""Benchmark decontamination: SimHash of item-sized windows.

Every benchmark item gives windows of every size class that fits into it, and
every document gives windows of those sizes at every word. Fingerprints of the
two sides within `radius` bits are found by blocks: cut into radius + 1
pieces, two such fingerprints agree on one piece at least. An item of which a
text similar enough may keep no whole window (a short one, or one whose
weight lies in few shingles) is found by each of its shingles. The item and
the document's window of the item's own length, clipped where the text ends,
are then compared exactly: weighted Jaccard similarity of their shingles, rare
shingles of the whole benchmark weighing more, whichever block an item is in.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.support import byte_class, hashed_words, opened, raw_texts, session, share, shingle_hashes

#: Words in a shingle; least weighted similarity; differing bits; shingles in a window, by class.
SHINGLE, SIMILARITY, RADIUS, CLASSES = 5, 0.8, 3, (8, 16, 32)
#: Benchmark items in a block: the index of one block is what executors hold at once.
BLOCK_ITEMS, BLOCK_WORDS = 5_000, 500_000
#: Windows fingerprinted at once.
_STEP = 1 << 15
#: Pairs of a text's and the index's windows that are held at once.
PAIRS = 1 << 20
_BREAKS = byte_class(b" \t\n\v\f\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\0")


def window_fingerprints(grams: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(size, first window, SimHashes) of every `size` consecutive shingles, in blocks of windows.

    A bit is set if it is in over half of a window's hashes. Running sums of
    each bit serve all sizes; they may wrap, since only differences under 256
    are used.
    """
    if max(sizes, default=0) > 255:
        raise ValueError("window sizes fit in a byte")
    for at in range(0, len(grams), _STEP):
        some = grams[at : at + _STEP + max(sizes) - 1]
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.zeros((len(bits) + 1, 64), dtype=np.uint8)
        np.cumsum(bits, axis=0, dtype=np.uint8, out=sums[1:])
        for size in sizes:
            n = min(_STEP, len(some) - size + 1)
            if n > 0:
                inside = sums[size : size + n] - sums[:n]
                yield size, at, np.packbits(inside > size // 2, axis=1, bitorder="little").view(np.uint64)[:, 0]


@dataclass
class Index:
    """A block of items: their windows' fingerprints by class and by piece, and their weighted shingles."""

    ids: list[int]
    shingles: list[Counter]
    lengths: list[int]
    slack: list[int]  # shingles of an item that a similar text may lack at most: how far a kept row may be moved
    weights: dict[int, float]  # of the whole benchmark: shingles of two items or more
    total: float  # items of the whole benchmark
    classes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]]  # fingerprints, items, first and last offsets, pieces
    short: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # words in a shingle: sorted shingles, items, first and last offsets


def keeps_window(weights: list[float], size: int, shingle: int, similarity: float) -> bool:
    """Whether every text this similar to an item of these shingles keeps `size` of them in a row.

    At a similarity of s up to 1 - s of the item's weight is lost: all of it at
    an end of the item where the text ends or begins there. An edit inside the
    item loses shingle - 1 shingles in a row at least. The least weight whose
    loss leaves no such row must be more than may be lost.
    """
    n, gap = len(weights), max(1, shingle - 1)
    if n < size:
        return False
    sums = [0.0, *accumulate(weights)]
    best = [math.inf] * (n + 1)  # the least loss in the first i shingles if what is kept may go on at i
    least = math.inf
    for i in range(n + 1):
        best[i] = min(sums[i], best[i])
        if i:
            best[i] = min(best[i], best[i - 1] + weights[i - 1])
        kept = min(size - 1, n - i)
        least = min(least, best[i] + sums[n] - sums[i + kept])
        for j in range(i, i + kept + 1):
            if j + gap <= n:
                best[j + gap] = min(best[j + gap], best[i] + sums[j + gap] - sums[j])
    return least > (1 - similarity) * sums[n] + 1e-9


@lru_cache(maxsize=4096)
def _even_keeps(n: int, size: int, shingle: int, similarity: float) -> bool:
    return keeps_window([1.0] * n, size, shingle, similarity)


@dataclass
class Frequencies:
    """Of the whole benchmark: its items, and the sorted shingles of two items or more with their number of items."""

    items: int
    shingles: np.ndarray
    counts: np.ndarray

    def weights(self) -> dict[int, float]:
        return {h: math.log(1 + self.items / c) + 0.1 for h, c in zip(self.shingles.tolist(), self.counts.tolist())}


def item_shingles(words: np.ndarray, shingle: int) -> np.ndarray:
    return shingle_hashes(words, min(shingle, max(1, len(words))))


def frequencies(items: list[tuple[int, str]], shingle: int) -> Frequencies:
    """Those of a benchmark that is these items."""
    words, bounds = hashed_words([x.encode() for _, x in items], _BREAKS)
    seen = [np.unique(item_shingles(words[bounds[i] : bounds[i + 1]], shingle)) for i in range(len(items))]
    found, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *seen]), return_counts=True)
    return Frequencies(len(items), found[counts > 1], counts[counts > 1])


def benchmark_frequencies(benchmark: DataFrame, shingle: int) -> Frequencies:
    """Counted over all items in one aggregation; what one item only has needs no entry, since it weighs as what none has."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = hashed_words(raw_texts(batch.column(0)), _BREAKS)
            seen = [np.unique(item_shingles(words[bounds[i] : bounds[i + 1]], shingle)) for i in range(batch.num_rows)]
            yield pa.record_batch([pa.array(np.concatenate([np.empty(0, np.uint64), *seen]).view(np.int64))], names=["h"])

    found = rows.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").toArrow()
    hashes = found.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Frequencies(rows.count(), hashes[order], found.column("n").to_numpy()[order])


def build_index(items: list[tuple[int, str]], shingle: int, similarity: float, classes: tuple[int, ...], radius: int, whole: Frequencies | None = None) -> Index:
    """The index of a block of the benchmark that has these frequencies; without them the block is the benchmark."""
    whole = whole or frequencies(items, shingle)
    words, bounds = hashed_words([x.encode() for _, x in items], _BREAKS)
    each = [item_shingles(words[bounds[i] : bounds[i + 1]], shingle) for i in range(len(items))]
    weights, rare = whole.weights(), math.log(1 + whole.items) + 0.1
    made: dict[int, list] = {c: [[], [], []] for c in classes}
    apart: dict[int, list] = {}
    slack = [0] * len(items)
    for i, g in enumerate(each):
        if not bounds[i + 1] > bounds[i]:
            continue  # an item without words matches nothing
        own = [weights.get(h, rare) for h in g.tolist()]
        slack[i] = int(np.searchsorted(np.cumsum(np.sort(own)), (1 - similarity) * sum(own) + 1e-9, "right"))
        width = min(shingle, int(bounds[i + 1] - bounds[i]))
        even = min(own) == max(own)
        if not classes or width < shingle or not (_even_keeps(len(g), min(classes), shingle, similarity) if even else keeps_window(own, min(classes), shingle, similarity)):
            apart.setdefault(width, []).append((g, np.full(len(g), i), np.arange(len(g))))
        if width < shingle:
            continue
        for c in classes:
            if c <= len(g):
                fps = np.concatenate([f for _, _, f in window_fingerprints(g, (c,))])
                made[c][0].append(fps)
                made[c][1].append(np.full(len(fps), i))
                made[c][2].append(np.arange(len(fps)))
    short = {width: _stretches(*(np.concatenate(x) for x in zip(*found))) for width, found in apart.items()}
    index = {}
    for c, found in made.items():
        if found[0]:
            stretches = _stretches(*map(np.concatenate, found))
            index[c] = (*stretches, [_piece(stretches[0], p, radius) for p in range(radius + 1)])
    return Index([i for i, _ in items], [Counter(g.tolist()) for g in each], [len(g) for g in each], slack, weights, float(whole.items), index, short)


def _stretches(values: np.ndarray, items: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(value, item, first offset, last offset), sorted by value: equal values at offsets in a row are one stretch."""
    order = np.lexsort((offsets, items, values))
    v, i, o = values[order], items[order], offsets[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (i[1:] != i[:-1]) | (o[1:] != o[:-1] + 1)])[: len(v)]
    first = np.flatnonzero(new)
    return v[first], i[first], o[first], o[np.append(first[1:], len(v)) - 1]


def _cut(piece: int, radius: int) -> tuple[int, int]:
    a, b = 64 * piece // (radius + 1), 64 * (piece + 1) // (radius + 1)
    return a, b - a


def _piece_values(fps: np.ndarray, piece: int, radius: int) -> np.ndarray:
    at, width = _cut(piece, radius)
    return (fps >> np.uint64(at)) & np.uint64((1 << width) - 1)


def _piece(fps: np.ndarray, piece: int, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by the piece's value, sorted values, a table of the values' low 16 bits that occur)."""
    values = _piece_values(fps, piece, radius)
    order = np.argsort(values, kind="stable")
    present = np.zeros(1 << 16, dtype=bool)
    present[(values & np.uint64(0xFFFF)).astype(np.int64)] = True
    return order, values[order], present


def _expanded(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, j) for every low <= j < high of each row, in parts of about PAIRS pairs."""
    times = high - low
    sums = np.cumsum(times)
    edges = np.unique(np.searchsorted(sums, np.arange(0, (sums[-1] if len(sums) else 0) + PAIRS, PAIRS)))
    for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(rows)]):
        if i < j:
            n = times[i:j]
            yield np.repeat(rows[i:j], n), np.repeat(low[i:j], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def near_windows(fps: np.ndarray, indexed: tuple, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, indexed stretch) of every pair within the radius, in parts; a pair may come up once for each piece."""
    theirs, pieces = indexed[0], indexed[-1]
    for p, (order, values, present) in enumerate(pieces):
        own = _piece_values(fps, p, radius)
        rows = np.flatnonzero(present[(own & np.uint64(0xFFFF)).astype(np.int64)])
        for a, j in _expanded(rows, np.searchsorted(values, own[rows], "left"), np.searchsorted(values, own[rows], "right")):
            b = order[j]
            near = np.bitwise_count(fps[a] ^ theirs[b]) <= radius
            yield a[near], b[near]


def merged(spans: np.ndarray) -> np.ndarray:
    """Rows (text, item, low, high) sorted, those of one text and item that touch or overlap as one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
    new = np.concatenate([[True], (spans[1:, :2] != spans[:-1, :2]).any(axis=1)])
    step = spans[:, 3].max() - spans[:, 2].min() + 2  # lifts each text and item above those before it
    lift = (np.cumsum(new) - 1) * step
    reach = np.maximum.accumulate(spans[:, 3] + lift)
    new[1:] |= spans[1:, 2] + lift[1:] > reach[:-1] + 1
    first = np.flatnonzero(new)
    ends = np.append(first[1:], len(spans)) - 1
    return np.column_stack([spans[first, :3], reach[ends] - lift[ends]])


def weighted_similarity(a: Counter, b: Counter, index: Index) -> float:
    """Sum of the smaller weights over that of the larger; shingles that no item has weigh as one of a single item."""
    rare = math.log(1 + index.total) + 0.1
    both = sum(min(n, b[h]) * index.weights.get(h, rare) for h, n in a.items() if h in b)
    each = sum(n * index.weights.get(h, rare) for c in (a, b) for h, n in c.items())
    return both / (each - both) if each else 0.0


def best_window(grams: list[int], starts: int, item: int, index: Index) -> tuple[float, int]:
    """(similarity, start) of the first best window of the item's length among the first `starts`, moved shingle by shingle."""
    theirs, n = index.shingles[item], index.lengths[item]
    rare = math.log(1 + index.total) + 0.1
    weight = [index.weights.get(h, rare) for h in grams]
    whole = sum(c * index.weights.get(h, rare) for h, c in theirs.items())
    own = Counter(grams[:n])
    size = sum(weight[:n])
    both = sum(min(c, theirs[h]) * index.weights.get(h, rare) for h, c in own.items() if h in theirs)
    most, best = 0.0, 0
    for at in range(starts):
        s = both / (size + whole - both)
        if s > most + 1e-9:
            most, best = s, at
            if s >= 1:  # none can be better
                break
        h, w = grams[at], weight[at]
        both -= w if own[h] <= theirs.get(h, 0) else 0.0
        own[h] -= 1
        size -= w
        if at + n < len(grams):
            h, w = grams[at + n], weight[at + n]
            both += w if own[h] < theirs.get(h, 0) else 0.0
            own[h] += 1
            size += w
    return weighted_similarity(Counter(grams[best : best + n]), theirs, index), best


def matches(words: np.ndarray, bounds: np.ndarray, index: Index, shingle: int, similarity: float, radius: int) -> dict[tuple[int, int], tuple[float, int]]:
    """(text, item): (similarity, first word) of the best window, for items at least that similar.

    `words` are those of several texts in a row and `bounds` their first words;
    windows lie in one text each. Hits become spans of places where a window may
    begin, and spans that touch become one, so that a text and an item of
    repeated words cost what they hold and not their product.
    """
    best: dict[tuple[int, int], tuple[float, int]] = {}
    slack, lengths = np.array(index.slack, dtype=np.int64), index.lengths

    def span(a: np.ndarray, items: np.ndarray, first: np.ndarray, last: np.ndarray, size: int, width: int) -> np.ndarray:
        """Where a window of the item may begin if its stretch first..last lies at row a: (text, item, low, high), within the item's slack."""
        text = np.searchsorted(bounds, a, "right") - 1
        inside = a + size + width - 1 <= bounds[text + 1]
        a, text, items, first, last = (x[inside] for x in (a, text, items, first, last))
        low, high = bounds[text], bounds[text + 1] - width
        return merged(np.column_stack([text, items, np.clip(a - last - slack[items], low, high), np.clip(a - first + slack[items], low, high)]))

    def compare(spans: list[np.ndarray], grams: np.ndarray, width: int) -> None:
        """Every window that begins in a span, once."""
        for t, item, low, high in merged(np.concatenate([np.empty((0, 4), dtype=np.int64), *spans])).tolist():
            start, last = int(bounds[t]), int(bounds[t + 1]) - width + 1
            own = grams[low : min(high + lengths[item], last)].tolist()
            s, at = best_window(own, high - low + 1, item, index)
            if s >= similarity - 1e-9 and s > best.get((t, item), (0.0, 0))[0] + 1e-9:
                best[t, item] = (s, low + at - start)

    grams, spans = shingle_hashes(words, shingle), []
    for size, block, fps in window_fingerprints(grams, tuple(index.classes)) if index.classes else ():
        _, items, first, last, _ = theirs = index.classes[size]
        for a, b in near_windows(fps, theirs, radius):
            spans.append(span(a + block, items[b], first[b], last[b], size, shingle))
    compare(spans, grams, shingle)
    for width, (theirs, items, first, last) in index.short.items():
        own = grams if width == shingle else shingle_hashes(words, width)
        rows = np.flatnonzero(np.isin(own, theirs))
        found = _expanded(rows, np.searchsorted(theirs, own[rows], "left"), np.searchsorted(theirs, own[rows], "right"))
        compare([span(a, items[b], first[b], last[b], 1, width) for a, b in found], own, width)
    return best


def blocks_of(benchmark: DataFrame, items: int = BLOCK_ITEMS, words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items by id, in blocks of bounded size; an item without text is left out."""
    held, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").orderBy("item_id", "text").toLocalIterator():
        held.append((r.item_id, r.text))
        size += len(r.text.split())
        if len(held) >= items or size >= words:
            yield held
            held, size = [], 0
    if held:
        yield held


def find_contamination(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS, classes: tuple[int, ...] = CLASSES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, first_word) for every document and item that it contains, best window each.

    Words are separated by white space and ASCII punctuation, A-Z lowered. Every
    document is held against every item, a block of items at a time. Null and
    empty texts match nothing; repeated items (the same id and text) are found
    once for each row, and items without an id or a text not at all; repeated
    documents repeat, ids may be null, and extra columns are dropped. An empty
    table of documents or items gives an empty result.
    """
    spark = session()
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    names = ["doc_id", "item_id", "similarity", "first_word"]
    types = (pa.int64(), pa.int64(), pa.float64(), pa.int64())
    schema = "doc_id long, item_id long, similarity double, first_word long"

    def searched(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = opened(shared)
            for batch in batches:
                ids, texts, out = batch.column(0).to_pylist(), raw_texts(batch.column(1)), []
                words, bounds = hashed_words(texts, _BREAKS)
                for (i, item), (s, at) in matches(words, bounds, index, shingle, similarity, radius).items():
                    out.append((ids[i], index.ids[item], s, at))
                made = list(zip(*out)) if out else [()] * 4
                yield pa.record_batch([pa.array(c, type=t) for c, t in zip(made, types)], names=names)

        return run

    found, whole = spark.createDataFrame([], schema), benchmark_frequencies(benchmark, shingle)
    for block in blocks_of(benchmark):
        found = found.union(rows.mapInArrow(searched(share(spark, build_index(block, shingle, similarity, classes, radius, whole))), schema))
    return found


def clean_documents(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, radius: int = RADIUS, classes: tuple[int, ...] = CLASSES, text_column: str = "text") -> DataFrame:
    """docs without those that contain an item, in one pass over the texts for each block of items.

    Null and empty texts stay; ids are not looked at; no row is moved; other
    columns, whatever their names, stay. An empty table stays empty, and without
    items all rows stay.
    """
    spark = session()
    at = docs.columns.index(text_column)

    def kept(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = opened(shared)
            for batch in batches:
                words, bounds = hashed_words(raw_texts(batch.column(at)), _BREAKS)
                stay = np.ones(batch.num_rows, dtype=bool)
                stay[[i for i, _ in matches(words, bounds, index, shingle, similarity, radius)]] = False
                yield batch.filter(pa.array(stay))

        return run

    out, whole = docs, benchmark_frequencies(benchmark, shingle)
    for block in blocks_of(benchmark):
        out = out.mapInArrow(kept(share(spark, build_index(block, shingle, similarity, classes, radius, whole))), docs.schema)
    return out
