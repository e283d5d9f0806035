"""A hidden Markov language model over words.

Word counts cover all training documents. The most frequent words, and one
class for all others, are the symbols that hidden states emit; within the
class a word has its add-one share, whatever the state. Texts become symbols
once, in a settled table. The first parameters come from the counts of
neighbouring symbols in all training documents; then every round of Baum-Welch
runs over all of them: executors return expected counts, summed by symbol,
until the training likelihood gains less than a tolerance. Long texts are cut
into rows, whose transfer matrices give the exact message that enters each row
from either side, so that no transition and no token is left out.
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

from quillmill.llm.support import crc_rest, opened, raw_texts, session, settle, share

#: Hidden states; symbols with an emission of their own; words whose counts every executor has; symbols whose neighbours give the first parameters.
STATES, SYMBOLS, LEXICON, SEEDS = 6, 120_000, 120_000, 1_000
#: Rounds of Baum-Welch at most; they end when the log-likelihood of the training texts gains less than this share of itself.
ROUNDS, TOLERANCE = 8, 0.002
#: Tokens in a row, rows held at once, weight of the smoothing.
ROW, HELD_ROWS, SMOOTH = 512, 1024, 50.0
#: The end of a text; no word is empty.
END = b""
#: Numbers of what is no symbol among the expected counts: starts, likelihood, and then each state left.
_START, _LIKELIHOOD, _MOVES = -1, -2, -3


def words(raw: bytes) -> list[bytes]:
    return raw.lower().split()


@dataclass
class Rows:
    """Several texts' symbols in rows of at most ROW tokens, the longest rows first."""

    symbols: np.ndarray  # [token, row]
    lengths: np.ndarray  # [row], descending
    text: np.ndarray  # [row]
    part: np.ndarray  # [row], its place in its text
    last: np.ndarray  # [row], whether its text ends there

    @classmethod
    def of(cls, flat: np.ndarray, bounds: np.ndarray) -> Rows:
        """Of texts flat[bounds[i] : bounds[i + 1]], none empty."""
        sizes = np.diff(bounds)
        counts = -(-sizes // ROW)
        text = np.repeat(np.arange(len(sizes)), counts)
        part = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = bounds[:-1][text] + part * ROW
        lengths = np.minimum(ROW, bounds[1:][text] - first)
        order = np.argsort(-lengths, kind="stable")
        first, lengths, text, part = first[order], lengths[order], text[order], part[order]
        width = int(lengths[0]) if len(lengths) else 0
        symbols = flat[np.minimum(first[None, :] + np.arange(width)[:, None], max(0, len(flat) - 1))]
        return cls(symbols, lengths, text, part, part == counts[text] - 1)

    def some(self, a: int, b: int) -> Rows:
        width = int(self.lengths[a]) if a < len(self.lengths) else 0
        return Rows(self.symbols[:width, a:b], self.lengths[a:b], self.text[a:b], self.part[a:b], self.last[a:b])

    def live(self) -> list[int]:
        """For each place, how many rows have a token there."""
        return (len(self.lengths) - np.searchsorted(self.lengths[::-1], np.arange(len(self.symbols)), "right")).tolist()


@dataclass
class HiddenMarkov:
    start: np.ndarray  # [state]
    move: np.ndarray  # [from, to]
    emit: np.ndarray  # [symbol, state]

    def transfer(self, rows: Rows) -> np.ndarray:
        """[row, state before, last state] of each row, up to a factor; before a text's first row any state is the same."""
        s, n = len(self.start), len(rows.lengths)
        onward = np.ascontiguousarray(self.move.T)
        product, moved = np.empty((s, s, n)), np.empty((s, s, n))  # rows last: long runs for every operation
        for t, n in enumerate(rows.live()):
            own = moved[:, :, :n]
            if t == 0:
                own[:] = np.where(rows.part == 0, self.start[None, :, None], self.move[:, :, None])
            else:
                np.matmul(onward, product[:, :, :n], out=own)
            if t % 8 == 7 or t < 2:
                own /= own.max(axis=(0, 1))
            np.multiply(own, self.emit.take(rows.symbols[t, :n], axis=0).T, out=product[:, :, :n])
        return np.ascontiguousarray((product / product.max(axis=(0, 1))).transpose(2, 0, 1))

    def messages(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """(distribution of the state before each row given all before it, likelihood of all after it by its last state)."""
        s = len(self.start)
        before, after = np.full((len(rows.lengths), s), 1 / s), np.ones((len(rows.lengths), s))
        many = np.flatnonzero(~(rows.last & (rows.part == 0)))
        if not len(many):
            return before, after
        product = np.concatenate([self.transfer(Rows(rows.symbols[:, m], rows.lengths[m], rows.text[m], rows.part[m], rows.last[m])) for m in np.array_split(many, -(-len(many) // HELD_ROWS))])
        place = np.empty(len(rows.lengths), dtype=np.int64)
        place[many] = np.arange(len(many))
        order = many[np.lexsort((rows.part[many], rows.text[many]))]
        parts = [order[rows.part[order] == p] for p in range(int(rows.part[many].max()) + 1)]
        for here, there in zip(parts, parts[1:]):
            own = here[np.isin(rows.text[here], rows.text[there], assume_unique=True)]
            v = np.einsum("ij,ijk->ik", before[own], product[place[own]])
            before[there] = v / v.sum(axis=1, keepdims=True)
        for here, there in zip(parts[-2::-1], parts[:0:-1]):
            own = here[np.isin(rows.text[here], rows.text[there], assume_unique=True)]
            v = np.einsum("ijk,ik->ij", product[place[there]], after[there])
            after[own] = v / v.sum(axis=1, keepdims=True)
        return before, after

    def forward(self, rows: Rows, before: np.ndarray, kind: type = np.float64) -> tuple[np.ndarray, np.ndarray]:
        """(state distributions [token, state, row] given what came, log10 probability of each row given what came before it)."""
        onward, emit = np.ascontiguousarray(self.move.T, dtype=kind), self.emit.astype(kind)
        states = np.empty((len(rows.symbols), len(self.start), len(rows.lengths)), dtype=kind)
        logs = np.zeros(len(rows.lengths))
        enter = np.where(rows.part == 0, self.start[:, None], onward.astype(float) @ before.T).astype(kind)
        for t, n in enumerate(rows.live()):
            a = (enter if t == 0 else onward @ states[t - 1, :, :n]) * emit.take(rows.symbols[t, :n], axis=0).T
            total = a.sum(axis=0)
            logs[:n] += np.log10(total)
            np.divide(a, total, out=states[t, :, :n])
        return states, logs

    def log10_likelihood(self, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Exact log10 probabilities of texts of symbols, none empty."""
        rows, out = Rows.of(flat, bounds), np.zeros(len(bounds) - 1)
        before, _ = self.messages(rows)
        for at in range(0, len(rows.lengths), HELD_ROWS):
            some = rows.some(at, at + HELD_ROWS)
            _, logs = self.forward(some, before[at : at + HELD_ROWS])
            np.add.at(out, some.text, logs)
        return out

    def expected(self, flat: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Baum-Welch counts (start [state], moves [from, to], emitted [symbol, state]) and the log10 likelihood of texts, none empty."""
        s = len(self.start)
        rows = Rows.of(flat, bounds)
        before, after = self.messages(rows)
        start, moves, emitted, likelihood = np.zeros(s), np.zeros((s, s)), np.zeros((size, s)), 0.0
        for at in range(0, len(rows.lengths), HELD_ROWS):
            some = rows.some(at, at + HELD_ROWS)
            forward, logs = self.forward(some, before[at : at + HELD_ROWS], np.float32)
            likelihood += float(logs.sum())
            a, m = self._backward(some, forward, before[at : at + HELD_ROWS], after[at : at + HELD_ROWS])
            start += a
            moves += m
            live = some.live()
            symbols = np.concatenate([some.symbols[t, :n] for t, n in enumerate(live)])
            for j in range(s):
                emitted[:, j] += np.bincount(symbols, np.concatenate([forward[t, j, :n] for t, n in enumerate(live)]), size)
        return start, moves, emitted, likelihood

    def _backward(self, rows: Rows, states: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, moves) of rows; `states` become the states' probabilities given the whole text."""
        move, emit = self.move.astype(np.float32), self.emit.astype(np.float32)
        moves, live, later = np.zeros(self.move.shape), rows.live(), np.ascontiguousarray(after.T, dtype=np.float32)
        beta = np.empty((len(self.start), 0), dtype=np.float32)
        for t in range(len(live) - 1, -1, -1):
            own, n = states[t, :, : live[t]], beta.shape[1]
            ends = later[:, n : live[t]]
            ends = ends / (own[:, n:] * ends).sum(axis=0)
            if n:
                w = emit.take(rows.symbols[t + 1, :n], axis=0).T * beta
                onward = move @ w
                norm = (own[:, :n] * onward).sum(axis=0)
                moves += (own[:, :n] / norm) @ w.T
                beta = np.concatenate([onward / norm, ends], axis=1)
            else:
                beta = ends
            if t < len(live) - 1:
                states[t + 1, :, : live[t + 1]] = posterior
            posterior = own * beta
        if not len(live):
            return np.zeros(len(self.start)), moves * self.move
        states[0] = posterior
        head = rows.part == 0
        if not head.all():  # the move from the row before
            w = emit[rows.symbols[0, ~head]].T * beta[:, ~head]
            prior = before[~head].T.astype(np.float32)
            moves += (prior / (prior * (move @ w)).sum(axis=0)) @ w.T
        return posterior[:, head].sum(axis=1, dtype=float), moves * self.move


@dataclass
class Symbols:
    """How often each symbol occurs in the training texts, and how many words it stands for (the last one for all unknown words as one too)."""

    counts: np.ndarray
    words: np.ndarray

    def shares(self) -> np.ndarray:
        """The add-one shares of the base model."""
        return (self.counts + self.words) / (self.counts + self.words).sum()


def re_estimated(start: np.ndarray, moves: np.ndarray, emitted: np.ndarray, symbols: Symbols) -> HiddenMarkov:
    """A model from expected counts. Every word is seen once more, in each state by its mass: one state alone is the base model. Emissions lean on the base shares."""
    states = len(start)
    mass = (emitted.sum(axis=0) + 1e-9) / (emitted.sum() + 1e-9 * states)
    emit = emitted + symbols.words[:, None] * mass + SMOOTH * symbols.shares()[:, None]
    move = (moves + 0.1) / (moves.sum(axis=1, keepdims=True) + 0.1 * states)
    return HiddenMarkov((start + 0.1) / (start.sum() + 0.1 * states), move, emit / emit.sum(axis=0))


def first_model(neighbours: np.ndarray, symbols: Symbols, states: int) -> HiddenMarkov:
    """From counts of neighbouring symbols among the first few: symbols that keep the same company begin in one state.

    The company is that of a spectral embedding of the counts; its parts are
    found from the symbols furthest apart, without chance.
    """
    k = len(neighbours)
    both = neighbours + neighbours.T
    degree = both.sum(axis=1)
    emitted = np.repeat(symbols.counts[:, None] / states, states, axis=1)
    if k <= states or not degree.any():
        tilt = 1 + 0.1 * np.cos(np.arange(len(emitted))[:, None] * (1 + np.arange(states)))
        return re_estimated(np.ones(states), np.eye(states) + 1, emitted * tilt, symbols)
    scale = 1 / np.sqrt(degree + degree.mean())
    _, vectors = np.linalg.eigh(both * scale[:, None] * scale[None, :])
    point = vectors[:, -states:] * np.sqrt(scale)[:, None]
    point /= np.linalg.norm(point, axis=1, keepdims=True) + 1e-12
    centres = [point[degree.argmax()]]
    weight = np.sqrt(degree)
    for _ in range(states - 1):
        far = np.min([((point - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(point[(far * weight).argmax()])
    centre = np.array(centres)
    for _ in range(30):
        part = ((point[:, None, :] - centre[None]) ** 2).sum(axis=2).argmin(axis=1)
        centre = np.array([np.average(point[part == j], axis=0, weights=weight[part == j] + 1e-9) if (part == j).any() else centre[j] for j in range(states)])
    member = np.eye(states)[part]
    emitted[:k] = symbols.counts[:k, None] * (0.8 * member + 0.2 / states)
    moves = member.T @ neighbours @ member + 1.0
    mass = member.T @ degree + 1.0
    return re_estimated(mass / mass.sum(), moves, emitted, symbols)


@dataclass
class LanguageModel:
    markov: HiddenMarkov
    likelihoods: list[float]  # log10 of the training texts before each round


@dataclass
class Lexicon:
    """The most frequent words by number, the most frequent first, and what a word's number says."""

    number: dict[bytes, int]
    logs: np.ndarray  # log10(c + 1)
    rest: int  # words from this number on, and all others, share a symbol
    rest_mass: float  # of the words in that class, add-one counts and one for unknown words
    total: int  # N + V + 1


def count_words(train: DataFrame) -> DataFrame:
    """(word, c) of every token of (text) rows, each text ending in END."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for raw in raw_texts(batch.column(0)):
                held.update(words(raw))
            held[END] += batch.num_rows
            if len(held) > 300_000:
                yield _counts(held)
                held = Counter()
        if held:
            yield _counts(held)

    return train.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> list:
    """Rows (word, c) of the most frequent words, the most frequent first, at most `most`; the end of a text is always among them.

    A histogram of logarithms finds how many words each sixteenth of a doubling
    has, so that only words of the lexicon leave the executors. Where not all
    words of a step fit in, as many of it as do are taken by a hash of the word.
    """
    step = F.floor(F.log2("c") * 16).cast("int")
    others = counts.where(F.col("word") != F.lit(END))
    bins = others.groupBy(step.alias("bin")).agg(F.count("*").alias("n")).collect()  # 16 rows a doubling
    room, edge, share = max(0, most - 1), -1, 0.0
    for r in sorted(bins, key=lambda r: -r.bin):
        if r.n > room:
            edge, share = r.bin, room / r.n
            break
        room -= r.n
    some = F.pmod(F.xxhash64("word"), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
    # A step's words are those with counts from its least one on: no logarithm for each word again.
    first, after = (math.ceil(2 ** (b / 16) - 1e-9) for b in (edge, edge + 1))
    held = (F.col("word") == F.lit(END)) | (F.col("c") >= after) | ((F.col("c") >= first) & some) if edge >= 0 else F.lit(True)
    found = sorted(counts.where(held).collect(), key=lambda r: (-r.c, bytes(r.word)))
    over = len(found) - max(1, most)  # the hash's share is exact to a root of it
    while over > 0:
        last = next(i for i in range(len(found) - 1, -1, -1) if bytes(found[i].word) != END)
        del found[last]
        over -= 1
    return found


def _counts(held: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(held), type=pa.binary()), pa.array(list(held.values()), type=pa.int64())], names=["word", "c"])


_CODED = "doc_id long, text_key long, held_out boolean, n_known long, n_far long, base double, inner double, symbols array<int>, far array<binary>, times array<int>"


def coded(marked: DataFrame, lexicon) -> DataFrame:
    """(doc_id, text_key, held_out, text) -> the symbols of every text, what the lexicon says of its base score, and its words that the lexicon lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened(lexicon)
        number, end = own.number, own.number.get(END, -1)
        logs = np.append(own.logs, 0.0)  # the last one for numbers of -1
        known = np.append(own.logs > 0, False)
        total, rest_total = np.log10(own.total), np.log10(own.rest_mass) if own.rest_mass > 0 else 0.0
        for batch in batches:
            sums, symbols, far, times = [], [], [], []
            for raw in raw_texts(batch.column(3)):
                found = words(raw)
                at = [number.get(w, -1) for w in found]
                at.append(end)
                n = np.array(at, dtype=np.int64)
                missing = int((n < 0).sum()) - (end < 0)
                lacking = Counter(w for w, i in zip(found, at) if i < 0) if missing else {}
                symbol = np.where((n < 0) | (n >= own.rest), own.rest, n).astype(np.int32)
                inside = n[symbol == own.rest]
                sums.append((int(known[n].sum()), missing, logs[n].sum() - len(n) * total, logs[inside].sum() - len(inside) * rest_total))
                symbols.append(symbol)
                far.append(list(lacking))
                times.append(list(lacking.values()))
            made = list(zip(*sums)) if sums else [()] * 4
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in symbols])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(symbols) if symbols else np.empty(0, np.int32)))
            more = [pa.array(c, type=t) for c, t in zip(made, (pa.int64(), pa.int64(), pa.float64(), pa.float64()))]
            yield pa.record_batch([*batch.columns[:3], *more, lists, pa.array(far, type=pa.list_(pa.binary())), pa.array(times, type=pa.list_(pa.int32()))], names=[x.split()[0] for x in _CODED.split(", ")])

    return marked.select("doc_id", "text_key", "held_out", "text").mapInArrow(run, _CODED)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a batch of texts, and where each begins (n + 1 offsets)."""
    bounds = lists.offsets.to_numpy()
    return lists.values.to_numpy()[bounds[0] : bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def neighbour_counts(symbols: DataFrame, seeds: int) -> np.ndarray:
    """[symbol, the next] counts in all texts, of the first `seeds` symbols: at most seeds * seeds rows leave the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(seeds * seeds, dtype=np.int64)
        for batch in batches:
            flat, bounds = _flat(batch.column(0))
            if len(flat) > 1:
                pair = (flat[:-1] < seeds) & (flat[1:] < seeds)
                pair[bounds[1:-1] - 1] = False
                held += np.bincount(flat[:-1][pair].astype(np.int64) * seeds + flat[1:][pair], minlength=seeds * seeds)
        seen = np.flatnonzero(held)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(held[seen])], names=["pair", "n"])

    found = symbols.mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(seeds * seeds)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(seeds, seeds)


def fit(texts: DataFrame, symbols: Symbols, states: int = STATES, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> LanguageModel:
    """(symbols) of the training texts, settled, and how often they occur -> a language model.

    What the driver holds is bounded: SEEDS squared counts of neighbours, and a
    row of expected counts for each symbol. Without a text it is the shares alone.
    """
    spark = session()
    size, tokens = len(symbols.counts), symbols.counts.sum()
    model = first_model(neighbour_counts(texts, min(SEEDS, size - 1)) if tokens else np.zeros((0, 0)), symbols, states)
    likelihoods: list[float] = []
    for _ in range(rounds if tokens else 0):
        summed = texts.mapInArrow(_expectation(share(spark, model), size, states), "symbol int, counts array<double>").groupBy("symbol")
        got = summed.agg(*[F.sum(F.get("counts", F.lit(j))).alias(f"c{j}") for j in range(states)]).toArrow()
        number = got.column("symbol").to_numpy()
        table = np.stack([got.column(f"c{j}").to_numpy() for j in range(states)], axis=1)
        emitted, own = np.zeros((size, states)), {int(s): table[i] for i, s in enumerate(number) if s < 0}
        emitted[number[number >= 0]] = table[number >= 0]
        likelihoods.append(float(own[_LIKELIHOOD].sum()))
        model = re_estimated(own[_START], np.stack([own[_MOVES - j] for j in range(states)]), emitted, symbols)
        if len(likelihoods) > 1 and likelihoods[-1] - likelihoods[-2] < tolerance * abs(likelihoods[-2]):
            break
    return LanguageModel(model, likelihoods)


def _expectation(model, size: int, states: int):
    """Expected counts of a partition: a row for each symbol seen, for the start, for each state left, and the likelihood (in the first place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened(model)
        start, moves, emitted, likelihood = np.zeros(states), np.zeros((states, states)), np.zeros((size, states)), np.zeros(states)
        for batch in batches:
            if not batch.num_rows:
                continue
            a, m, e, log = own.expected(*_flat(batch.column(0)), size)
            start += a
            moves += m
            emitted += e
            likelihood[0] += log
        seen = np.flatnonzero(emitted.sum(axis=1) > 0)
        rows = np.concatenate([emitted[seen], start[None], likelihood[None], moves])
        ids = np.concatenate([seen, [_START, _LIKELIHOOD], _MOVES - np.arange(states)]).astype(np.int32)
        for at in range(0, len(ids), 5000):
            yield pa.record_batch([pa.array(ids[at : at + 5000]), pa.array(list(rows[at : at + 5000]), type=pa.list_(pa.float64()))], names=["symbol", "counts"])

    return run


def score_documents(docs: DataFrame, held: F.Column | None = None, states: int = STATES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Learn from the documents that are not held out, then score all.

    One row per document: (doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score). `held` marks the rows held out and may look at the
    columns doc_id and text only; by default crc32 of the id modulo 7 is 2. A
    null text is empty and has one token, its end; a row with a null id is
    learned from; repeated rows are counted and scored each. Without any
    training row, every word is unknown. An empty table gives an empty result.
    Ties in frequency are ordered by the word. Other columns are dropped.
    """
    return scored_with_model(docs, held, states, id_column, text_column)[0]


def scored_with_model(docs: DataFrame, held: F.Column | None = None, states: int = STATES, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, LanguageModel]:
    """score_documents() and the model that it learned."""
    spark = session()
    marked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    marked = marked.withColumn("held_out", F.coalesce(crc_rest("doc_id", 7) == 2 if held is None else held, F.lit(False))).withColumn("text_key", F.xxhash64("text"))
    counts = settle(count_words(marked.where("not held_out").select("text")))
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = total.n or 0, total.v
    ranked = most_frequent(counts, LEXICON) if n else []
    rest = min(SYMBOLS, len(ranked))
    own = np.array([r.c for r in ranked[:rest]], dtype=float)
    symbols = Symbols(np.append(own, n - own.sum()), np.append(np.ones(rest), v - rest + 1))
    rest_mass = float(symbols.counts[-1] + symbols.words[-1])
    lexicon = Lexicon({bytes(r.word): i for i, r in enumerate(ranked)}, np.log10(np.array([r.c + 1.0 for r in ranked])), rest, rest_mass, n + v + 1)
    texts = settle(coded(marked, share(spark, lexicon)))
    lm = fit(texts.where("not held_out").select("symbols"), symbols, states)
    known = share(spark, lm.markov)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        markov = opened(known)
        for batch in batches:
            flat, bounds = _flat(batch.column(7))
            likely = markov.log10_likelihood(flat, bounds) if batch.num_rows else np.empty(0)
            yield pa.record_batch([*batch.columns[:3], pa.array(np.diff(bounds)), *batch.columns[3:6], pa.array(batch.column(6).to_numpy() + likely)], names=["doc_id", "text_key", "held_out", "n_tokens", "n_known", "n_far", "base_score", "score"])

    far = texts.where("n_far > 0").select("doc_id", "text_key", F.explode(F.arrays_zip("far", "times")).alias("f")).select("doc_id", "text_key", F.col("f.far").alias("word"), F.col("f.times").alias("n")).join(counts, "word")
    far = far.groupBy("doc_id", "text_key").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more"), F.sum("n").alias("known_far"))
    repeated = texts.groupBy("doc_id", "text_key").agg(F.count("*").alias("times")).where("times > 1")  # their sums hold each copy's
    same = "a.doc_id <=> b.doc_id and a.text_key = b.text_key"
    times = F.coalesce(F.col("b.times"), F.lit(1))
    far = far.alias("a").join(repeated.alias("b"), F.expr(same), "left").select("a.doc_id", "a.text_key", (F.col("a.more") / times).alias("more"), (F.col("a.known_far") / times).cast("long").alias("known_far"))
    near = texts.select("doc_id", "text_key", "held_out", "n_known", "n_far", "base", "inner", "symbols").mapInArrow(scored, "doc_id long, text_key long, held_out boolean, n_tokens long, n_known long, n_far long, base_score double, score double")
    joined = near.alias("a").join(far.alias("b"), F.expr(same), "left")
    more, known_far = F.coalesce(F.col("b.more"), F.lit(0.0)), F.coalesce(F.col("b.known_far"), F.lit(0))
    out = joined.select("a.doc_id", "a.held_out", "a.n_tokens", (F.col("a.n_known") + known_far).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), (F.col("a.base_score") + more).alias("base_score"), (F.col("a.score") + more).alias("score"))
    return out, lm
