"""Alignment of two tokenizers' tokens over the same bytes.

Every byte of a batch of texts is a bit in two packed bitsets, which mark where
tokens of A and of B end. Their AND has the shared cuts, which part the tokens
into groups; popcounts summed over words (rank) tell how many tokens end before
a cut, so a cut's byte is turned into ranges of tokens of A and of B. The OR has
a bit for each pair of tokens that overlap: the piece of text between two
neighbouring ends lies in one token of each, whose numbers are ranks again.
How often an id pair is linked is counted over all documents.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.support import opened, session, settle, share

#: Where the public vocabularies are; parameters of every function here.
BYTES_MODEL, PIECES_MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: How byte-level vocabularies part a text into words. Fixed value.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text aligned at once; a longer text is aligned alone.
AT_ONCE = 1 << 20
#: Pairs that a task counts before it hands them on.
COUNTED = 1 << 20
#: The most frequent id pairs, at most so many, whose counts every task holds: 24 bytes each. The others' counts are joined.
HELD = 1 << 21
_LOW = np.uint64(1)


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """A byte-level BPE vocabulary: ids of a text and the bytes of each id."""

    def __init__(self, data: bytes) -> None:
        import tiktoken

        model = json.loads(data)["model"]
        letters, vocabulary = byte_letters(), model["vocab"]
        self.size = max(vocabulary.values()) + 1
        self.bytes = [b""] * self.size
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != sorted(made):
            raise ValueError("merges must be in the order of the ids that they make")
        self._encoding = tiktoken.Encoding("bytes", pat_str=WORDS, mergeable_ranks={b: i for i, b in enumerate(self.bytes)}, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._encoding.encode_to_numpy(x, disallowed_special=()).astype(np.int64) for x in texts]


class PieceTokens:
    """A SentencePiece vocabulary: ids of a text, before which it puts a space, and the bytes of each id."""

    def __init__(self, data: bytes) -> None:
        import sentencepiece

        self._processor = sentencepiece.SentencePieceProcessor(model_proto=data)
        p, self.size = self._processor, self._processor.get_piece_size()
        self.bytes = [bytes([int(p.id_to_piece(i)[3:-1], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode() for i in range(self.size)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, dtype=np.int64) for x in self._processor.encode(texts, num_threads=1)]


class Bits:
    """A packed bitset with ranks."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def at(cls, places: np.ndarray, size: int) -> Bits:
        marks = np.zeros((size + 64) // 64 * 64, dtype=bool)
        marks[places] = True
        return cls(np.packbits(marks, bitorder="little").view(np.uint64))

    def __and__(self, other: Bits) -> Bits:
        return Bits(self.words & other.words)

    def __or__(self, other: Bits) -> Bits:
        return Bits(self.words | other.words)

    def rank(self, places: np.ndarray) -> np.ndarray:
        """How many bits are set before each place."""
        word = places >> 6
        below = (_LOW << (places & 63).astype(np.uint64)) - _LOW
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def select(self) -> np.ndarray:
        """The places of all bits that are set."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


@dataclass
class Aligned:
    """Tokens of some texts, one text after another: ids, groups (how many tokens have ended at each shared cut) and links (numbers of tokens)."""

    a: np.ndarray
    b: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    #: Of each text: how many tokens, groups and links.
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray


class Pair:
    """Two vocabularies and the alignment of their tokens."""

    def __init__(self, a: bytes, b: bytes) -> None:
        self.a, self.b = ByteTokens(a), PieceTokens(b)
        self._lengths = [np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (self.a, self.b)]
        ids = [np.arange(self.a.size).astype(str).tolist(), np.arange(self.b.size).astype(str).tolist()]
        self._written = [x + "," for x in ids[0]] + [x + "|" for x in ids[0]] + [x + "," for x in ids[1]] + [x + ";" for x in ids[1]]

    def aligned(self, texts: list[str | None]) -> Aligned:
        """Texts that are null or empty, or that a vocabulary does not give back byte by byte, have no tokens."""
        spaced = [f" {x}" if x else "" for x in texts]
        own_a, own_b, size = self.a.encode(spaced), self.b.encode([x or "" for x in texts]), 0
        nothing = np.empty(0, dtype=np.int64)
        for i, x in enumerate(spaced):
            raw = x.encode()
            if not x or self._joined(self.a, own_a[i]) != raw or self._joined(self.b, own_b[i]) != raw:
                own_a[i] = own_b[i] = nothing
            else:
                size += len(raw)
        n_a, n_b = (np.array([len(x) for x in own], dtype=np.int64) for own in (own_a, own_b))
        a, b = (np.concatenate([*own, nothing]) for own in (own_a, own_b))
        end_a, end_b = np.cumsum(self._lengths[0][a]), np.cumsum(self._lengths[1][b])
        bits_a, bits_b = Bits.at(end_a, size), Bits.at(end_b, size)
        shared, either = (bits_a & bits_b).select(), (bits_a | bits_b).select()
        last = np.concatenate([[0], end_a])[np.cumsum(n_a)]  # where each text ends
        n_groups, n_links = (np.diff(np.searchsorted(x, last, side="right"), prepend=0) for x in (shared, either))
        return Aligned(a, b, bits_a.rank(shared) + 1, bits_b.rank(shared) + 1, bits_a.rank(either), bits_b.rank(either), n_a, n_b, n_groups, n_links)

    def _joined(self, tokens, ids: np.ndarray) -> bytes:
        return b"".join(map(tokens.bytes.__getitem__, ids.tolist()))

    def keys(self, x: Aligned) -> np.ndarray:
        """The id pair of each link as one number."""
        return x.a[x.link_a] * self.b.size + x.b[x.link_b]

    def written(self, x: Aligned) -> list[str]:
        """Each text's groups as `a1,a2|b1;a3|b2,b3`; of texts without tokens an empty string."""
        first_a, first_b = np.concatenate([[0], x.a_cut[:-1]]), np.concatenate([[0], x.b_cut[:-1]])
        out = np.empty(len(x.a) + len(x.b), dtype=np.int64)
        place_a = np.arange(len(x.a)) + np.repeat(first_b, x.a_cut - first_a)
        place_b = np.arange(len(x.b)) + np.repeat(x.a_cut, x.b_cut - first_b)
        kinds_a, kinds_b = x.a.copy(), x.b + 2 * self.a.size
        kinds_a[x.a_cut - 1] += self.a.size
        kinds_b[x.b_cut - 1] += self.b.size
        out[place_a], out[place_b] = kinds_a, kinds_b
        parts = list(map(self._written.__getitem__, out.tolist()))
        ends = np.cumsum(x.n_a + x.n_b).tolist()
        return ["".join(parts[i:j])[:-1] for i, j in zip([0, *ends], ends)]


def _portions(texts: list[str | None]) -> Iterator[slice]:
    first = size = 0
    for i, x in enumerate(texts):
        if size and size + 4 * len(x or "") > 4 * AT_ONCE:
            yield slice(first, i)
            first, size = i, 0
        size += 4 * len(x or "") + 1
    if first < len(texts):
        yield slice(first, len(texts))


def _shared_models(a_model: str, b_model: str) -> tuple:
    """(the models' files, broadcast; the size of the second vocabulary)."""
    with open(a_model, "rb") as a, open(b_model, "rb") as b:
        both = a.read(), b.read()
    return share(session(), both), PieceTokens(both[1]).size


def align(docs: DataFrame, a_model: str = BYTES_MODEL, b_model: str = PIECES_MODEL, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, a_ids, b_ids, a_ends, b_ends): tokens of both vocabularies and how many of each have ended at each shared cut.

    The space that the second vocabulary puts first belongs to the text. Texts
    that are null or empty, or that a vocabulary does not give back byte by byte,
    have no tokens; repeated rows repeat; extra columns are dropped; an empty
    table gives an empty one.
    """
    models, _ = _shared_models(a_model, b_model)
    names, lists = ["a_ids", "b_ids", "a_ends", "b_ends"], pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*opened(models))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _portions(texts):
                x = pair.aligned(texts[part])
                a, b, g = (np.cumsum(n)[:-1] for n in (x.n_a, x.n_b, x.n_groups))
                cuts = [np.split(c, g) for c in (x.a_cut, x.b_cut)]
                ends = [[c - n for c, n in zip(cut, np.concatenate([[0], at]))] for cut, at in zip(cuts, (a, b))]
                made = [np.split(x.a, a), np.split(x.b, b), *ends]
                yield pa.record_batch([batch.column(0)[part], *[pa.array([c.astype(np.int32) for c in column], type=lists) for column in made]], names=["doc_id", *names])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} array<int>" for n in names))


def pack(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Rising keys and how often each occurs: differences by planes of bytes, which compress, then the times."""
    steps = np.diff(keys, prepend=0)
    planes = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(keys) else 1
    wide = 1 if not len(times) or times.max() < 256 else 4
    body = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()
    return bytes([planes, wide]) + np.uint32(len(keys)).tobytes() + body + times.astype(f"<u{wide}").tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes, wide = data[0], data[1]
    n = int(np.frombuffer(data, dtype=np.uint32, count=1, offset=2)[0])
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :planes] = np.frombuffer(data, dtype=np.uint8, count=planes * n, offset=6).reshape(planes, n).T
    return np.cumsum(out.view("<u8")[:, 0].astype(np.int64)), np.frombuffer(data, dtype=f"<u{wide}", offset=6 + planes * n).astype(np.int64)


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, t = np.concatenate(keys), np.concatenate(times)
    order = np.argsort(k, kind="stable")
    k, t = k[order], t[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, dtype=np.int64)
    return k[first], np.add.reduceat(t, first) if len(k) else t


_STATS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _linked(docs: DataFrame, models, id_column: str, text_column: str) -> DataFrame:
    """A row for each document: _STATS and its id pairs, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(*opened(models))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in _portions(texts):
                x = pair.aligned(texts[part])
                keys, ends, packed = pair.keys(x), np.cumsum(x.n_links).tolist(), []
                for i, j in zip([0, *ends], ends):
                    packed.append(pack(*np.unique(keys[i:j], return_counts=True)))
                shas = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in pair.written(x)]
                yield pa.record_batch([batch.column(0)[part], *[pa.array(c, type=pa.int64()) for c in (x.n_a, x.n_b, x.n_groups, x.n_links)], pa.array(shas), pa.array(packed, type=pa.binary())], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"{_STATS}, links binary")


def _counted(linked: DataFrame) -> DataFrame:
    """(pair, n) over all documents: tasks count first, in bounded memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, held = [], [], 0
        for batch in batches:
            for data in batch.column(0):
                k, t = unpack(data.as_buffer())
                keys.append(k)
                times.append(t)
                held += len(k)
                if held > 2 * COUNTED:
                    k, t = _summed(keys, times)
                    if len(k) > COUNTED:
                        yield pa.record_batch([pa.array(k), pa.array(t)], names=["pair", "n"])
                        k, t = k[:0], t[:0]
                    keys, times, held = [k], [t], len(k)
        if held:
            yield pa.record_batch(list(map(pa.array, _summed(keys, times))), names=["pair", "n"])

    return linked.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, a_model: str = BYTES_MODEL, b_model: str = PIECES_MODEL, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(a_id, b_id, n): how many links of all documents hold each id pair; an empty table has none."""
    models, size = _shared_models(a_model, b_model)
    counts = _counted(settle(_linked(docs, models, id_column, text_column).select("links"), "zstd"))
    return counts.select(F.floor(F.col("pair") / size).cast("int").alias("a_id"), (F.col("pair") % size).cast("int").alias("b_id"), "n")


def link_statistics(docs: DataFrame, a_model: str = BYTES_MODEL, b_model: str = PIECES_MODEL, held: int = HELD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum) of every row.

    n_best counts links whose id pair is linked as often as any pair of its B id
    over all documents, count_sum sums over links how often theirs is. Texts are
    encoded once; the pairs of each are kept in a settled table. The counts of
    the most frequent pairs, `held` at most, are in every task; the rest of the
    links, of rarer pairs, are joined with theirs. Texts without tokens (see
    align) have zeros; repeated rows repeat; an empty table gives an empty one.
    """
    spark = session()
    models, size = _shared_models(a_model, b_model)
    linked = settle(_linked(docs, models, id_column, text_column).withColumn("row", F.monotonically_increasing_id()), "zstd")
    counts = settle(_counted(linked))
    top = counts.groupBy((F.col("pair") % size).alias("b")).agg(F.max("n").alias("_top"))  # B's ids at most
    marked = counts.withColumn("b", F.col("pair") % size).join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("_top")).alias("best"))
    bins = dict(marked.groupBy(F.floor(F.log2("n")).cast("int").alias("bin")).count().collect())  # 64 at most
    least, rest = 0, sum(bins.values())
    while rest > held:
        rest -= bins.get(least, 0)
        least += 1
    frequent = F.col("n") >= F.lit(1 << least)
    kept = marked.where(frequent).orderBy("pair").toArrow()
    known = share(spark, tuple(kept.column(c).to_numpy() for c in ("pair", "n", "best")))

    def found(data, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, times, place among the held pairs, whether it is one)."""
        k, t = unpack(data)
        at = np.minimum(np.searchsorted(pairs, k), max(0, len(pairs) - 1))
        return k, t, at, pairs[at] == k if len(pairs) else np.zeros(len(k), dtype=bool)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = opened(known)
        for batch in batches:
            sums = []
            for data in batch.column("links"):
                _, t, at, own = found(data.as_buffer(), pairs)
                t, at = t[own], at[own]
                sums.append((int(t[best[at]].sum()), int((t * n[at]).sum())))
            yield pa.record_batch([*batch.columns[:-1], *[pa.array(c, type=pa.int64()) for c in ([s[0] for s in sums], [s[1] for s in sums])]], names=[*batch.schema.names[:-1], "n_best", "count_sum"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = opened(known)[0]
        for batch in batches:
            for row, data in zip(batch.column(0), batch.column(1)):
                k, t, _, own = found(data.as_buffer(), pairs)
                k, t = k[~own], t[~own]
                yield pa.record_batch([pa.array(np.full(len(k), row.as_py()), type=pa.int64()), pa.array(k), pa.array(t)], names=["row", "pair", "times"])

    names = [x.split()[0] for x in _STATS.split(", ")]
    out = linked.select(*names, "row", "links").mapInArrow(summed, f"{_STATS}, row long, n_best long, count_sum long")
    if not least:
        return out.drop("row")
    rare = linked.select("row", "links").mapInArrow(others, "row long, pair long, times long").join(marked.where(~frequent), "pair")
    sums = rare.groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    plus = lambda c, more: (F.col(c) + F.coalesce(F.col(more), F.lit(0))).alias(c)
    return out.join(sums, "row", "left").select(*names, plus("n_best", "_best"), plus("count_sum", "_sum"))
