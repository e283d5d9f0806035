"""Toxic passages: maximum-scoring segments of token log-odds, calibrated by extreme values.

Every token has a score: the log-odds between toxic and other training texts
of the longest of its units, the word or a prefix of it, for which they are
significant under an informative Dirichlet prior; a small loss otherwise. A
text counts each of its tokens once, since a word that it has may be in it any
number of times. All maximal scoring segments of a text are found in one pass.
As in sequence statistics, a segment of score S in a text of n tokens has an
expectation of K n exp(-lambda S) among harmless texts; segments that are
unlikely enough are toxic passages. lambda follows from the scores' shares, K
is the likeliest for the best segments of harmless texts, and a text's evidence
is calibrated to a probability: both on texts that did not count for the
scores, FOLDS parts taking turns.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.labelled import SAMPLE_ROWS, held_out, training_sample
from quillmill.llm.support import opened, raw_texts, session, settle, share
from quillmill.llm.trees import calibrate

#: Pseudo-counts of the prior; least z and log-odds of a significant unit; most units kept; a neutral token's loss.
PRIOR, LEAST_Z, LEAST_ODDS, MOST_UNITS, LOSS = 200.0, 4.0, 1.5, 20_000, 0.04
#: Lengths of the prefixes that are units besides whole words, in bytes.
PREFIXES = (5, 6, 7, 8)
#: A passage is significant if fewer than this many are expected in a harmless text.
EXPECTED = 0.05
#: Parts of the training texts: each is scored by what the others count, for the calibration.
FOLDS = 3
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_BREAKS = bytes(32 if x in _PUNCTUATION else x for x in range(256))


def tokens(raw: bytes) -> list[bytes]:
    return raw.lower().translate(_BREAKS).split()


def units(word: bytes) -> list[bytes]:
    """The word, marked as whole, and its proper prefixes, the longest first."""
    return [word + b" ", *(word[:n] for n in reversed(PREFIXES) if len(word) > n)]


@dataclass
class ToxicityModel:
    scores: dict[bytes, float]
    heads: frozenset[bytes]  # how the words of any scored unit begin
    loss: float
    decay: float  # lambda
    scale: float  # K
    slope: float
    offset: float

    def passages(self, raw: bytes) -> tuple[list[tuple[int, int, float, float]], int]:
        """(first token, end token, score, expectation) of every maximal segment, and the number of tokens."""
        words = tokens(raw)
        heads, least = self.heads, PREFIXES[0]
        hits = [(i, s) for i, w in enumerate(words) if w[:least] in heads and (s := self.token_score(w))]
        n = len(words)
        out = []
        for start, end, score in maximal_segments(hits, self.loss):
            out.append((start, end, score, self.scale * max(n, 1) * math.exp(-self.decay * score)))
        return out, n

    def token_score(self, word: bytes) -> float:
        for u in units(word):
            if u in self.scores:
                return self.scores[u]
        return 0.0

    def evidence(self, raw: bytes) -> tuple[float, int]:
        """The summed excess of significant passages over what harmless texts reach, in nats, and their number."""
        found, _ = self.passages(raw)
        excess = [-math.log(max(e, 1e-300)) for _, _, _, e in found]
        strong = [x for x, (_, _, _, e) in zip(excess, found) if e <= EXPECTED]
        return min(60.0, sum(strong)) if strong else max([-8.0, *(min(x, 3.0) for x in excess)]), len(strong)

    def score(self, raw: bytes) -> tuple[float, int]:
        x, n = self.evidence(raw)
        return 1 / (1 + math.exp(-(self.slope * x + self.offset))), n


def maximal_segments(hits: list[tuple[int, float]], loss: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in one pass over (position, score).

    Positions without a score lose `loss` each. A candidate joins the nearest
    earlier one that begins lower if it ends higher; each candidate keeps the
    place of the nearest earlier one that begins lower, so the search is
    amortised over the pass. When none begins lower, earlier ones are final.
    """
    done: list[tuple[int, int, float]] = []
    open_: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, place of the nearest lower
    total, at = 0.0, 0
    for i, s in hits:
        total -= (i - at) * loss
        at = i + 1
        before, total = total, total + s
        if s <= 0:
            continue
        start, low, high = i, before, total
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][2] >= low:
                j = open_[j][4]
            if j < 0:
                done += [(a, b, r - left) for a, b, left, r, _ in open_]
                open_ = [(start, i + 1, low, high, -1)]
                break
            if open_[j][3] >= high:
                open_.append((start, i + 1, low, high, j))
                break
            start, low = open_[j][0], open_[j][2]
            del open_[j:]
    return done + [(a, b, r - left) for a, b, left, r, _ in open_]


def log_odds(counts: list[tuple[bytes, int, int]], ones: int, zeros: int) -> dict[bytes, float]:
    """Scores of significant units from (unit, toxic texts, other texts) with it: Dirichlet prior from both."""
    total = max(1, ones + zeros)
    ranked = []
    for unit, a, b in counts:
        prior = PRIOR * (a + b) / total / 2 + 0.5
        delta = math.log((a + prior) / (ones + PRIOR - a)) - math.log((b + prior) / (zeros + PRIOR - b))
        z = delta / math.sqrt(1 / (a + prior) + 1 / (b + prior))
        if abs(z) >= LEAST_Z and abs(delta) >= LEAST_ODDS:
            ranked.append((-abs(z), unit, delta))
    return {unit: delta for _, unit, delta in sorted(ranked)[:MOST_UNITS]}


def decay_rate(scores: list[tuple[float, float]]) -> float:
    """lambda > 0 with sum of p exp(lambda s) = 1, for (share, score) of negative mean."""
    low, high = 1e-6, 1.0
    value = lambda x: sum(p * math.exp(min(700, x * s)) for p, s in scores)
    if sum(p * s for p, s in scores) >= 0 or not any(s > 0 for _, s in scores):
        return 1.0
    while value(high) < 1 and high < 1e3:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 1 else (low, mid)
    return high


def from_counts(counts: list[tuple[bytes, int, int, int]], ones: int, zeros: int) -> ToxicityModel:
    """A model that is not calibrated yet, from (unit, toxic texts, other texts, its tokens in others)."""
    counts = [c for c in counts if c[1] + c[2] >= 4 and (c[1] >= 4 or c[2] >= 40)]
    scores = log_odds([c[:3] for c in counts], ones, zeros)
    quiet = {u: n for u, _, _, n in counts}
    others = max(1, sum(n for u, n in quiet.items() if u.endswith(b" ")))
    shares = sorted(((quiet[u] + 0.5) / others, s) for u, s in scores.items() if s > 0)
    neutral = max(0.0, 1 - sum(p for p, _ in shares))
    loss = max(LOSS, 1.5 * sum(p * s for p, s in shares))  # so that harmless texts drift down
    shares.append((neutral, -loss))
    heads = frozenset(u.removesuffix(b" ")[: PREFIXES[0]] for u in scores)
    return ToxicityModel(scores, heads, loss, decay_rate(shares), 1.0, 1.0, 0.0)


def likeliest_scale(best: list[tuple[float, int, float]]) -> float:
    """K from harmless texts' (best segment's score, tokens, lambda): the likeliest for extreme values; a text without a segment has 0."""
    weight = sum(max(n, 1) * math.exp(-min(700.0, decay * s)) for s, n, decay in best)
    return max(0.5, sum(s > 0 for s, _, _ in best)) / weight if weight > 0 else 0.1


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fitted on at most `rows` labelled documents that are not held out.

    Without toxic examples, or without others, every score is 0. The same rows
    give the same model, however they are partitioned.
    """
    spark = session()
    part = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(FOLDS)).cast("int").alias("part")
    sample = settle(training_sample(docs, labels, "toxic", rows).select("text", "y", part))
    # Copies of a text would make its chance words significant: of equal whole texts one counts words, whichever it is.
    apart = sample.withColumn("copy", F.md5("text")).dropDuplicates(["y", "copy"]).select("text", "y", "part")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, int], Counter] = {}
            for raw, y, p in zip(raw_texts(batch.column(0)), *(c.to_pylist() for c in batch.columns[1:])):
                have, times = found.setdefault((p, y), Counter()), found.setdefault((p, -1), Counter())
                seen: set[bytes] = set()
                for w, n in Counter(tokens(raw)).items():
                    of = units(w)
                    seen.update(of)
                    if y == 0:
                        for u in of:
                            times[u] += n
                have.update(seen)
            for p in sorted({p for p, _ in found}):
                ones, zeros, times = (found.get((p, y), Counter()) for y in (1, 0, -1))
                every = list(ones.keys() | zeros.keys())
                yield pa.record_batch([pa.array(every, type=pa.binary()), pa.array([p] * len(every), type=pa.int32()), *(pa.array([c[u] for u in every], type=pa.int64()) for c in (ones, zeros, times))], names=["unit", "part", "a", "b", "n"])

    sums = [F.sum(F.when(F.col("part") == p, F.col(c)).otherwise(0)).alias(f"{c}{p}") for p in range(FOLDS) for c in ("a", "b", "n")]
    whole = lambda c: "+".join(f"{c}{p}" for p in range(FOLDS))
    counted = apart.mapInArrow(count, "unit binary, part int, a long, b long, n long").groupBy("unit").agg(*sums).where(f"{whole('a')}+{whole('b')} >= 4 and ({whole('a')} >= 4 or {whole('b')} >= 40)")
    counts = sorted((bytes(r.unit), np.array(r[1:]).reshape(FOLDS, 3)) for r in counted.collect())  # units of a bounded sample
    sizes = {(r.part, r.y): r.n for r in apart.groupBy("part", "y").agg(F.count("*").alias("n")).collect()}

    def of(parts: list[int]) -> ToxicityModel:
        return from_counts([(u, *c[parts].sum(axis=0).tolist()) for u, c in counts], *(sum(sizes.get((p, y), 0) for p in parts) for y in (1, 0)))

    model, others = of(list(range(FOLDS))), [of([q for q in range(FOLDS) if q != p]) for p in range(FOLDS)]

    def asked(run, schema: str) -> list:
        """Of every text of the sample, what the model of the other parts says."""
        shared = share(spark, others)

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            models = opened(shared)
            for batch in batches:
                made = [(y, *run(models[p], raw)) for raw, y, p in zip(raw_texts(batch.column(0)), *(c.to_pylist() for c in batch.columns[1:]))]
                yield pa.RecordBatch.from_pylist([dict(zip(("y", "x", "n", "decay"), m)) for m in made], schema=pa.schema([("y", pa.int32()), ("x", pa.float64()), ("n", pa.int64()), ("decay", pa.float64())]))

        return sorted(tuple(r) for r in sample.mapInArrow(each, schema).collect())  # at most `rows`

    def best(own: ToxicityModel, raw: bytes) -> tuple[float, int, float]:
        found, n = own.passages(raw)
        return max((s for _, _, s, _ in found), default=0.0), n, own.decay

    schema = "y int, x double, n long, decay double"
    scale = likeliest_scale([(x, n, decay) for y, x, n, decay in asked(best, schema) if y == 0])
    for m in (model, *others):
        m.scale = scale
    pairs = asked(lambda own, raw: (*own.evidence(raw), own.decay), schema)
    x, y = np.array([p[1] for p in pairs]), np.array([p[0] for p in pairs])
    if len(y) == 0 or y.min() == y.max():
        model.slope, model.offset = 0.0, -30.0
    else:
        model.slope, model.offset = calibrate(x, y)
    return model


def score_documents(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: (doc_id, held_out, score, predicted, passages).

    Null and empty texts have no passages and the score of such texts; ids may
    be null or repeated; repeated rows have equal scores; other columns are
    dropped; an empty table gives an empty result.
    """
    spark = session()
    shared = share(spark, model)  # at most MOST_UNITS units

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened(shared)
        for batch in batches:
            found = [own.score(raw) for raw in raw_texts(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array([x for x, _ in found], type=pa.float64()), pa.array([n for _, n in found], type=pa.int64())], names=["doc_id", "score", "passages"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    scored = rows.mapInArrow(run, "doc_id long, score double, passages long")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def find_passages(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, first_token, end_token, score, expected) of every significant passage.

    Null and empty texts have none; ids may be null or repeated, and repeated
    rows have theirs each; other columns are dropped; an empty table gives an
    empty result.
    """
    session()
    names = ["doc_id", "first_token", "end_token", "score", "expected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *p) for i, raw in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))) for p in model.passages(raw)[0] if p[3] <= EXPECTED]
            made = list(zip(*rows)) if rows else [()] * 5
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(made, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=names)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, "doc_id long, first_token long, end_token long, score double, expected double")
