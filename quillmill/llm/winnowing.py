"""Document fingerprints by winnowing.

A rolling hash runs over all k-grams of code points. Of every `window`
consecutive hashes the smallest is kept, of equal ones the rightmost, with its
position. Two texts that share `k + window - 1` code points in a row share a
kept hash; shorter matches than k are never reported.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.support import mix, session, settle

K, WINDOW = 16, 32
_BASE = 0x9E3779B97F4A7C15
_HASH_BITS = 40
#: Code points hashed at once; positions in a block fit beside a hash in 64 bits.
_BLOCK = 1 << 22


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """40-bit hashes of every k-gram, by doubling a polynomial hash's length."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out, have = np.zeros(len(codes), dtype=np.uint64), 0
    power, length, factor = codes.astype(np.uint64) + np.uint64(1), 1, _BASE
    while True:
        if k & length:
            step = np.uint64(pow(_BASE, length, 1 << 64))
            out = out[: len(power) - have] * step + power[have : have + len(out)] if have else power
            have += length
            out = out[: len(codes) - have + 1]
        if have == k:
            return mix(out[:n]) >> np.uint64(64 - _HASH_BITS)
        power = power[:-length] * np.uint64(factor) + power[length:]
        length, factor = 2 * length, factor * factor & 0xFFFFFFFFFFFFFFFF


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) kept, by position. A text with fewer hashes than a
    window keeps the smallest of them; one shorter than k has its own hash at 0;
    an empty one keeps nothing."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(codes):
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    if len(codes) < k:
        return gram_hashes(codes, len(codes)), np.zeros(1, dtype=np.int64)
    hashes, places = [], []
    total, step = len(codes) - k + 1, _BLOCK
    for at in range(0, max(1, total - window + 1), step):
        h = gram_hashes(codes[at : at + step + window - 1 + k - 1], k)
        place = np.uint64(24)
        packed = (h << place) | (np.uint64((1 << 24) - 1) - np.arange(len(h), dtype=np.uint64))
        wide = min(window, len(h))
        least, width = packed, 1
        while width * 2 <= wide:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        if width < wide:
            more = wide - width
            least = np.minimum(least[:-more], least[more:])
        kept = least[np.concatenate([[True], least[1:] != least[:-1]])]
        hashes.append(kept >> place)
        places.append(at + ((1 << 24) - 1) - (kept & np.uint64((1 << 24) - 1)).astype(np.int64))
    h, p = np.concatenate(hashes), np.concatenate(places)
    first = np.concatenate([[True], p[1:] != p[:-1]])
    return h[first], p[first]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sets of hashes; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def digest(hashes: np.ndarray, places: np.ndarray) -> str:
    """A short name for a fingerprint: SHA-256 of its hashes and positions."""
    return hashlib.sha256(hashes.tobytes() + places.tobytes()).hexdigest()


def fingerprints(docs: DataFrame, k: int = K, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, hashes, positions) of every row, in order of position.

    Null and empty texts keep nothing; ids may be null; repeated rows stay
    repeated; extra columns are dropped; an empty table gives an empty result.
    """
    session()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [winnow(x or "", k, window) for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array([h.astype(np.int64) for h, _ in kept], type=pa.list_(pa.int64())), pa.array([p for _, p in kept], type=pa.list_(pa.int64()))], names=["doc_id", "hashes", "positions"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, "doc_id long, hashes array<long>, positions array<long>")


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_PENDING = "part int, last boolean, first boolean, text string"


def _compared(doc_id: int | None, text: str, after: str, k: int, window: int, own: tuple | None = None, following: tuple | None = None) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    own, following = own or winnow(text, k, window), following or winnow(after, k, window)
    changed = winnow(edited, k, window)
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), digest(*own), digest(*changed), likeness(own[0], changed[0]), likeness(own[0], following[0])


def edited_comparison(docs: DataFrame, k: int = K, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Each document's fingerprint against those of its edited text and of the next document.

    The edited text has its last floor(n / 2) code points replaced by the first
    as many of the next document by ascending doc_id; the last takes the first.
    A single document is followed by itself. Null ids sort first; rows with the
    same id are ordered by text. Null texts are empty. No document is held
    with another but the one after it: partitions are ranges of ids, and the
    two ends of each meet in a second, small step. Rows that share an id, or
    have none, are one range, and so one task. Extra columns are dropped; an empty
    table gives an empty result.
    """
    spark = session()
    ordered = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = None
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                own = winnow(text, k, window)
                if held is None:
                    rows.append((doc_id, *[None] * 6, part, False, True, text))
                else:
                    rows.append((*_compared(*held[:2], text, k, window, held[2], own), None, False, False, None))
                held = (doc_id, text, own)
            yield _batch(rows)
        if held is not None:
            yield _batch([(held[0], *[None] * 6, part, True, False, held[1])])

    schema = f"{RESULT}, {_PENDING}"
    columns = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.int32(), pa.bool_(), pa.bool_(), pa.string()]

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        made = list(zip(*rows)) if rows else [()] * len(columns)
        return pa.record_batch([pa.array(c, type=t) for c, t in zip(made, types)], names=columns)

    done = settle(ordered.mapInArrow(run, schema))
    # One row at each end of each partition: number the parts that have rows, in order, on those rows' ids alone.
    ends = [r.part for r in done.where("first").select("part").distinct().orderBy("part").collect()]
    following = spark.createDataFrame([(p, ends[(i + 1) % len(ends)]) for i, p in enumerate(ends)], "part int, following int")
    heads = done.where("first").select(F.col("part").alias("following"), F.col("text").alias("after"))
    tails = done.where("last").select("doc_id", "text", "part").join(following, "part").join(heads, "following").select("doc_id", "text", "after")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_compared(*r, k, window) for r in zip(*(c.to_pylist() for c in batch.columns))]
            made = list(zip(*rows)) if rows else [()] * 7
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(made, types)], names=columns[:7])

    return done.where("part is null").select(columns[:7]).union(tails.mapInArrow(finish, RESULT))
