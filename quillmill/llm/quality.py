"""A quality classifier from pairwise preferences.

Bradley-Terry: of a labelled good and a labelled bad document, the good one is
preferred with probability sigmoid(w (x_good - x_bad)); w minimises the
logistic loss over all such pairs of the labelled documents that are not held
out. The pairs are never made: those of two narrow ranges of scores have one
probability, so a Newton step needs sums over the documents of each range. The threshold is the quantile of the
training scores that leaves the training share of good documents above it: a
document is accepted if and only if its score is at least that quantile, which
the reported score shows as ACCEPTED.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.labelled import held_out, training_ids
from quillmill.llm.support import raw_texts, session, settle

#: All pairs together weigh as much as so many do against the ridge.
PAIRS = 40_000
RIDGE = 20.0
#: Ranges of scores to a unit, in a Newton step and in the calibration.
RANGES, FINE_RANGES = 8, 256
#: A step below this ends the fit: ranges of 1 / RANGES know the weights to about half of it.
SETTLED = 2e-3
#: Sums are of integers, multiples of 1 / SCALE (of products 1 / 2^24), so that no order of adding changes them.
SCALE = 1 << 30
#: Rows of features that are summed at once; a table has about a part for each.
_ROWS = 1 << 16
#: The reported score of a document at the quantile.
ACCEPTED = 0.3
FEATURES = ["log_bytes", "log_words", "word_bytes", "upper", "digit", "mark", "mark_ended", "capitals", "same_as_last", "distinct", "most_common", "same_lines", "bar", "exclaimed", "long_words", "line_words", "no_stop", "high_bytes"]
_LETTERS, _UPPER, _DIGITS = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_UPPER[65:91] = True
_DIGITS[48:58] = True
_MARKS = np.zeros(256, bool)
_MARKS[np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~!", np.uint8)] = True
_ENDS = frozenset(b"#$%&*!|~^=+<>")
#: Bytes whose words and lines are looked at in a block, so that giant texts need no list of all of theirs.
_BLOCK = 1 << 20
_SPACE = re.compile(rb"[ \t\n\v\f\r]")


class _Tally:
    """How often each key occurs, as 64-bit hashes in sorted order: 16 bytes for each distinct key."""

    def __init__(self) -> None:
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: Counter) -> None:
        self.waiting.append((np.fromiter(map(hash, keys), np.int64, len(keys)), np.fromiter(keys.values(), np.int64, len(keys))))
        self.size += len(keys)
        if self.size > max(_BLOCK, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
        self.keys, self.counts = keys[first], np.add.reduceat(counts[order], first) if len(first) else counts
        self.waiting, self.size = [], 0

    def totals(self) -> tuple[int, int, int]:
        """Distinct keys, all keys, and the most frequent one's count."""
        self.merge()
        return len(self.keys), int(self.counts.sum()), int(self.counts.max(initial=0))


def _lines(raw: bytes) -> tuple[int, int]:
    """Distinct lines and all lines of a text, blank ones left out; a block ends with a line."""
    tally = _Tally()
    at = 0
    while at < len(raw):
        end = raw.find(b"\n", at + _BLOCK)
        end = end if end >= 0 else len(raw)
        tally.add(Counter(x for x in raw[at:end].split(b"\n") if x and not x.isspace()))
        at = end + 1
    return tally.totals()[:2]


def features(raw: bytes) -> list[float]:
    """FEATURES of a whole text, in blocks of about a megabyte; an empty text has zeros.

    All words and all lines count, whatever their number.
    """
    if not raw:
        return [0.0] * len(FEATURES)
    data = np.frombuffer(raw, np.uint8)
    histogram = np.bincount(data, minlength=256)
    letters = max(1, histogram[_LETTERS].sum())
    words = marked = capitals = same = long_ = 0
    tally = _Tally()
    last = b""
    at = 0
    while at < len(raw):
        end = at + _BLOCK
        if end < len(raw):  # a block ends before white space, so that no word is cut
            cut = _SPACE.search(raw, end)
            end = cut.start() if cut else len(raw)
        block = raw[at:end].split()
        at = end
        words += len(block)
        if not block:
            continue
        marked += sum(w[-1] in _ENDS for w in block)
        capitals += sum(w.isupper() and len(w) > 1 for w in block)
        same += (block[0] == last) + sum(map(bytes.__eq__, block, block[1:]))
        long_ += sum(len(w) > 24 for w in block)
        last = block[-1]
        tally.add(Counter(block))
    n = max(1, words)
    distinct, _, most = tally.totals()
    different, full = _lines(raw)
    return [
        math.log1p(len(raw)), math.log1p(words), min(20.0, len(raw) / n), histogram[_UPPER].sum() / letters, histogram[_DIGITS].sum() / len(raw), min(1.0, 5 * histogram[_MARKS].sum() / len(raw)),
        marked / n, capitals / n, same / n, distinct / n**0.8, most / n, 1 - different / max(1, full),
        min(1.0, 20 * histogram[124] / len(raw)), min(1.0, 20 * histogram[33] / len(raw)), long_ / n, math.log1p(n / max(1, full)), float(histogram[46] == 0), histogram[128:].sum() / len(raw),
    ]


@dataclass
class QualityModel:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float
    offset: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        """Bradley-Terry scores of rows of features."""
        return (self.units(x) * self.weights).sum(axis=1)  # row by row: equal rows have equal scores in any batch

    def units(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.concatenate([z, np.abs(z)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.strength(x) - self.cut) + self.offset, -30, 30)))


def fit_arrays(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, seed: int = 11) -> QualityModel:
    """A model of rows that are here already, by pairs drawn from them; fit() takes all pairs of a table."""
    from quillmill.llm.trees import calibrate

    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if len(y) == 0 or y.min() == y.max():
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(2 * width), 0.0, 0.0, 30.0 if len(y) == 0 or y.min() == 1 else -30.0)
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    model = QualityModel(mean, spread, np.zeros(2 * width), 0.0, 1.0, 0.0)
    z = np.clip((x - mean) / spread, -6, 6)
    z = np.concatenate([z, np.abs(z)], axis=1)
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(d.shape[1])
    for _ in range(30):  # Newton steps of the ridged logistic loss
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + RIDGE * np.eye(len(w)), d.T @ (1 - p) - RIDGE * w)
        w += step
        if abs(step).max() < 1e-6:
            break
    model.weights = w
    s = model.strength(x)
    model.cut = float(np.quantile(s, 1 - y.mean()))
    slope, _ = calibrate(s - model.cut, y)  # how fast the score moves away from the cut, not where it lies
    model.slope, model.offset = max(slope, 1e-3), math.log(ACCEPTED / (1 - ACCEPTED))
    return model


def _featured(docs: DataFrame, id_column: str) -> DataFrame:
    """(doc_id, h, x) of the documents that are not held out: a text's hash and its features."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(~held_out())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([features(raw) for raw in raw_texts(batch.column(2))], type=pa.list_(pa.float64()))], names=["doc_id", "h", "x"])

    return rows.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text").mapInArrow(run, "doc_id long, h long, x array<double>")


def _sums(rows: DataFrame, count: Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]]) -> tuple[np.ndarray, list[int]]:
    """Sorted keys and exact sums of the (keys, integers) that `count` makes of blocks of rows (x, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in [*batches, None]:  # features of a part: about _ROWS rows of 150 bytes
            if batch is not None:
                held.append(batch)
            if held and (batch is None or sum(b.num_rows for b in held) >= _ROWS):
                x = np.concatenate([b.column(0).flatten().to_numpy(zero_copy_only=False) for b in held]).reshape(-1, len(FEATURES))
                y = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in held]).astype(np.int64)
                held = []
                for at in range(0, len(x), _ROWS):
                    for keys, values in count(x[at : at + _ROWS], y[at : at + _ROWS]):
                        yield pa.record_batch([pa.array(keys.astype(np.int64)), pa.array(values.astype(np.int64))], names=["k", "v"])

    made = rows.mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    found = made.toArrow().sort_by("k")  # a bounded number: places in the sums of a range
    return found["k"].to_numpy(), [int(v) for v in found["v"].to_pylist()]


def _moments(rows: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Rows with label 0 and 1, and the mean and deviation of each feature."""
    width = len(FEATURES)
    at = np.arange(width)
    _, found = _sums(rows, lambda x, y: iter([(np.append(at, [width, width + 1]), np.append(np.rint(x * SCALE).astype(np.int64).sum(axis=0), [(y == 0).sum(), (y == 1).sum()]))]))
    if not found or not found[width] or not found[width + 1]:
        return found[width] if found else 0, found[width + 1] if found else 0, np.zeros(width), np.ones(width)
    n = found[width] + found[width + 1]
    mean = np.array([v / n for v in found[:width]]) / SCALE
    _, squares = _sums(rows, lambda x, y: iter([(at, np.rint((x - mean) ** 2 * SCALE).astype(np.int64).sum(axis=0))]))
    return found[width], found[width + 1], mean, np.sqrt(np.array([v / n for v in squares]) / SCALE) + 1e-6


def _ranged(s: np.ndarray, y: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges that occur, as 2 * number + label; the rows in their order; each range's first row."""
    code = 2 * np.floor(s * ranges).astype(np.int64) + y
    order = np.argsort(code, kind="stable")
    found, first = np.unique(code[order], return_index=True)
    return found, order, first


def _by_range(rows: DataFrame, model: QualityModel, ranges: int, products: bool) -> tuple[np.ndarray, np.ndarray]:
    """Labels, and for each range of scores that has rows: their number, and sums of their scores, units and, if asked for, products of units."""
    width = len(model.weights)
    upper = np.triu_indices(width)
    size = 2 + (width + len(upper[0]) if products else 0)

    def count(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        z = np.rint(model.units(x) * (1 << 12)) / (1 << 12)  # sums of such products are exact in doubles
        s = model.strength(x)
        found, order, first = _ranged(s, y, ranges)
        ends = np.append(first[1:], len(order))
        scores = np.add.reduceat(np.rint(s[order] * SCALE).astype(np.int64), first)
        for code, a, b, total in zip(found.tolist(), first.tolist(), ends.tolist(), scores.tolist()):
            own = [b - a, total]
            if products:
                part = z[order[a:b]]
                own += np.concatenate([part.sum(axis=0) * SCALE, (part.T @ part)[upper] * (1 << 24)]).astype(np.int64).tolist()
            yield code * 1024 + np.arange(size), np.array(own, dtype=np.int64)

    keys, values = _sums(rows, count)
    table = np.array(values, dtype=float).reshape(-1, size) / np.concatenate([[1.0], np.full(min(size - 1, 1 + width), SCALE), np.full(max(0, size - 2 - width), 1 << 24)])
    return keys[::size] // 1024 % 2, table


def _newton_step(w: np.ndarray, labels: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The step of the ridged loss over all pairs, from the sums of the ranges."""
    width = len(w)
    good, bad = table[labels == 1], table[labels == 0]
    n, m = good[:, 0], bad[:, 0]
    # The chance that the bad one is preferred, at the ranges' mean scores.
    p = 1 / (1 + np.exp(np.clip((good[:, 1] / n)[:, None] - (bad[:, 1] / m)[None, :], -500, 500)))
    q = p * (1 - p)
    zg, zb = good[:, 2 : 2 + width], bad[:, 2 : 2 + width]
    weight = PAIRS / (n.sum() * m.sum())
    gradient = weight * (zg.T @ (p @ m) - zb.T @ (p.T @ n)) - RIDGE * w
    flat = good[:, 2 + width :].T @ (q @ m) + bad[:, 2 + width :].T @ (q.T @ n)
    h = np.zeros((width, width))
    h[np.triu_indices(width)] = flat
    h = h + np.triu(h, 1).T
    cross = zg.T @ q @ zb
    return np.linalg.solve(weight * (h - cross - cross.T) + RIDGE * np.eye(width), gradient)


def _quantile(rows: DataFrame, model: QualityModel, n: int, share: float) -> float:
    """The quantile of all rows' scores, between two neighbours in order in proportion, each found by 16 bits at a time."""
    place = (n - 1) * share
    low = min(int(place), n - 1)
    ranks = [low, min(low + 1, n - 1)]
    found = [(0, r) for r in ranks]  # the bits so far, and the rank among the scores that begin so
    for shift in (48, 32, 16, 0):
        wanted = np.unique(np.array([bits for bits, _ in found], dtype=np.uint64))

        def count(x: np.ndarray, y: np.ndarray, shift: int = shift, wanted: np.ndarray = wanted) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            raw = (model.strength(x) + 0.0).view(np.uint64)
            raw = np.where(raw >> np.uint64(63), ~raw, raw | np.uint64(1 << 63))  # in the order of the scores
            if shift < 48:
                raw = raw[np.isin(raw >> np.uint64(shift + 16), wanted)]
            keys, times = np.unique(raw >> np.uint64(shift), return_counts=True)
            yield keys.view(np.int64), times

        keys, times = _sums(rows, count)
        pairs = sorted(zip((int(k) & (2**64 - 1) for k in keys), times))
        after = []
        for bits, rank in found:
            for k, t in pairs:
                if k >> 16 != bits and shift < 48:
                    continue
                if rank < t:
                    after.append((k, rank))
                    break
                rank -= t
        found = after
    values = np.array([bits & (2**63 - 1) if bits >> 63 else ~bits & (2**64 - 1) for bits, _ in found], dtype=np.uint64).view(np.float64)
    return float(values[0] + (values[1] - values[0]) * (place - low))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> QualityModel:
    """Fitted on all labelled documents that are not held out, in passes over a table of their features.

    Rows with the same id, text and label count once. The same rows give the
    same model on any partitioning. With labels of one kind only, every document
    has that kind's score; without labels every document is good.
    """
    from quillmill.llm.trees import calibrate

    session()
    found = _featured(docs, id_column).join(training_ids(labels, "quality"), "doc_id").dropDuplicates(["doc_id", "h", "y"])
    rows = settle(found.select("x", "y"))
    rows = settle(rows.repartition(1 + rows.count() // _ROWS))
    bad, good, mean, spread = _moments(rows)
    model = QualityModel(mean, spread, np.zeros(2 * len(mean)), 0.0, 0.0, 30.0 if good or not bad else -30.0)
    if not good or not bad:
        return model
    for _ in range(30):
        step = _newton_step(model.weights, *_by_range(rows, model, RANGES, True))
        model = QualityModel(mean, spread, model.weights + step, 0.0, 1.0, 0.0)
        if abs(step).max() < SETTLED:
            break
    model.cut = _quantile(rows, model, good + bad, 1 - good / (good + bad))
    y, table = _by_range(rows, model, FINE_RANGES, False)
    slope, _ = calibrate(table[:, 1] / table[:, 0] - model.cut, y, table[:, 0])  # how fast the score moves away from the cut, not where it lies
    model.slope, model.offset = max(slope, 1e-3), math.log(ACCEPTED / (1 - ACCEPTED))
    return model


def score_documents(docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted); predicted is 1 from ACCEPTED on, that is from the quantile on.

    Null texts count as empty; ids may be null or repeated; repeated rows have
    equal scores; other columns are dropped; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return with_scores(rows, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted"))


def with_scores(docs: DataFrame, model: QualityModel, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """docs and a score column, which takes the place of one of that name; the text column is the only one that is looked at.

    Null texts count as empty; ids may be null or repeated; an empty table stays
    empty, with the column.
    """
    session()
    if score_column in docs.columns:
        if score_column == text_column:
            raise ValueError("the score needs a column of its own")
        docs = docs.drop(score_column)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(raw) for raw in raw_texts(batch.column(at))], dtype=float).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], names=[*batch.schema.names, score_column])

    from pyspark.sql.types import DoubleType, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(score_column, DoubleType()))
