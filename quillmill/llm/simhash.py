"""SimHash near-duplicates; candidates are pruned by pigeonring chains.

Two fingerprints that differ in at most `radius` bits, cut into `segments`
pieces on a ring, have a start from which every run of l pieces differs in at
most l * radius / segments bits. The run on which that budget stays below one
bit is equal on both sides: it is the join key. The longer runs prune, then
the whole fingerprints are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.components import connected_components
from quillmill.llm.support import Groups, in_block_pairs, raw_texts, session, settle

#: Shingles whose bits are unpacked at once.
BLOCK = 1 << 16
#: A key with more fingerprints than this is linked by flipped bits, or, for a radius other than 2, compared in pairs of blocks of about so many.
HOT_KEY = 2048


def simhash(raw: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned fingerprint of a text: A-Z lowered, words, shingles with repeats, XXH64.

    A bit is set if it is set in over half the shingles' hashes. Fewer words
    than a shingle give one shingle of them all; no words give zero.
    """
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    total = len(words) - shingle + 1
    counts = np.zeros(64, dtype=np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, total, BLOCK):
        end = min(at + BLOCK, total)
        grams = zip(*(words[at + j : end + j] for j in range(shingle)))
        hashes = np.fromiter((digest(join(g), seed) for g in grams), dtype=np.uint64, count=end - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint's 64 bits as a long.

    A null text counts as empty (fingerprint zero); other columns are dropped.
    """
    session()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(x, shingle, seed) for x in raw_texts(batch.column(1))], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


class Ring:
    """The cut of 64 bits into segments, and the budgets of runs that start at each."""

    def __init__(self, radius: int, segments: int) -> None:
        if radius < 0 or not radius < segments <= 64:
            raise ValueError("a ring needs more segments than differing bits")
        self.radius, self.segments = radius, segments
        self.starts = [64 * i // segments for i in range(segments + 1)]
        #: segments of the longest run that may not differ at all
        self.equal = max(n for n in range(1, segments + 1) if n * radius < segments)

    def width(self, start: int, run: int) -> int:
        """Bits in a run of segments from a start, around the ring."""
        return sum(self.starts[i % self.segments + 1] - self.starts[i % self.segments] for i in range(start, start + run))

    def masks(self, start: int) -> list[tuple[int, int]]:
        """(mask, budget) of each longer run, for bits rotated to the start."""
        return [((1 << self.width(start, n)) - 1, n * self.radius // self.segments) for n in range(self.equal + 1, self.segments + 1)]


def rotated(x: np.ndarray, by: int) -> np.ndarray:
    return x if by == 0 else (x >> np.uint64(by)) | (x << np.uint64(64 - by))


def within_chains(a: np.ndarray, b: np.ndarray, start: int, ring: Ring) -> np.ndarray:
    """Which pairs stay within the budget of every run from a start."""
    differ = rotated(a ^ b, ring.starts[start])
    alive = np.arange(len(differ))
    for mask, budget in ring.masks(start):
        alive = alive[np.bitwise_count(differ[alive] & np.uint64(mask & (2**64 - 1))) <= budget]
    return alive


def link_fingerprints(fps: DataFrame, radius: int = 2, segments: int = 7) -> DataFrame:
    """(fp, rep) distinct fingerprints -> (a, b) links between reps, enough to connect.

    Every pair of fingerprints that differ in at most `radius` bits is connected
    by the links returned. Within a key the pairs are compared in one sorted
    pass and only a spanning forest leaves the task. A key with over HOT_KEY
    fingerprints is not compared: two fingerprints are within two bits if and
    only if they share a value at most one flipped bit from both, so such keys
    meet at those values instead, in rows that grow with the group and not with
    its square. For another radius such a key is parted into blocks of about
    HOT_KEY, and every pair of blocks is compared under a key of its own.
    """
    ring = Ring(radius, segments)
    fp = F.col("fp")
    keys = []
    for i in range(segments):
        by, width = ring.starts[i], ring.width(i, ring.equal)
        turned = fp if by == 0 else F.shiftrightunsigned(fp, by).bitwiseOR(F.shiftleft(fp, 64 - by))
        held = turned.bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        keys.append(F.struct(F.lit(i).cast("int").alias("start"), held.alias("bits")))
    keyed = fps.select(F.explode(F.array(*keys)).alias("key"), "fp", "rep").select("key.start", "key.bits", "fp", "rep")
    hot_key = HOT_KEY
    if radius != 2:
        keyed, hot_key = in_block_pairs(keyed.withColumn("bits", F.xxhash64("start", "bits")), "bits", "rep", HOT_KEY), 1 << 62
    sorted_keys = keyed.select("start", "bits", "fp", "rep").repartition("start", "bits").sortWithinPartitions("start", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, hot in complete_runs(batches, 2, hot_key):
            start, bits, values, reps = (rows[:, j] for j in range(4))
            if hot:
                yield _out(start, values, reps, True)
                continue
            groups = Groups()
            fp_bits = values.view(np.uint64)
            for first, second in near_rows(start, bits):
                for s in np.unique(start[first]):
                    own = first[start[first] == s]
                    near = own[within_chains(fp_bits[own], fp_bits[own + second], int(s), ring)]
                    for x, y in zip(reps[near].tolist(), reps[near + second].tolist()):
                        groups.join(x, y)
            found = groups.links()
            if found:
                pair = np.array(found, dtype=np.int64)
                yield _out(np.zeros(len(pair), dtype=np.int64), pair[:, 0], pair[:, 1], False)

    session()
    out = settle(sorted_keys.mapInArrow(run, "start long, a long, b long, hot boolean"))
    cold = out.where("not hot").select("a", "b")
    if radius != 2:
        return cold
    return cold.union(_linked_by_flips(out.where("hot").select("start", F.col("a").alias("fp"), F.col("b").alias("rep"))))


def _out(start: np.ndarray, a: np.ndarray, b: np.ndarray, hot: bool) -> pa.RecordBatch:
    return pa.record_batch([pa.array(start), pa.array(a), pa.array(b), pa.array(np.full(len(a), hot))], names=["start", "a", "b", "hot"])


def _linked_by_flips(hot: DataFrame) -> DataFrame:
    flips = F.array(F.lit(0).cast("long"), *[F.expr(f"shiftleft(1L, {i})") for i in range(64)])
    near = hot.select("fp", "rep").distinct().select(F.explode(flips).alias("flip"), "fp", "rep").select(F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), "rep")
    least = near.groupBy("value").agg(F.min("rep").alias("b"))
    return near.join(least, "value").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()


def complete_runs(batches: Iterator[pa.RecordBatch], key_columns: int, hot: int) -> Iterator[tuple[np.ndarray, bool]]:
    """Rows of sorted integer batches as arrays that hold whole runs of equal keys.

    Runs longer than `hot` come as (rows, True), in parts; memory stays bounded.
    """
    carry, hot_key = None, None
    for batch in batches:
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]) if batch.num_rows else None
        if rows is None:
            continue
        rows = rows if carry is None else np.concatenate([carry, rows])
        keys = rows[:, :key_columns]
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = np.concatenate([[0], cuts, [len(rows)]])
        if hot_key is not None and tuple(keys[0]) == hot_key:  # the hot run goes on
            yield rows[: bounds[1]], True
            if len(bounds) == 2:
                carry = None
                continue
            bounds = bounds[1:]
        hot_key = None
        last = bounds[-2]
        yield from _split_hot(rows, bounds[:-1], hot)
        carry = rows[last:]
        if len(carry) > hot:
            hot_key = tuple(carry[0, :key_columns])
            yield carry, True
            carry = None
    if carry is not None and len(carry):
        yield from _split_hot(carry, np.array([0, len(carry)]), hot)


def _split_hot(rows: np.ndarray, bounds: np.ndarray, hot: int) -> Iterator[tuple[np.ndarray, bool]]:
    if len(bounds) < 2:
        return
    sizes = np.diff(bounds)
    for at in np.flatnonzero(sizes > hot):
        yield rows[bounds[at] : bounds[at + 1]], True
    keep = np.repeat(sizes <= hot, sizes)
    cold = rows[bounds[0] : bounds[-1]][keep]
    if len(cold):
        yield cold, False


def near_rows(*keys: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(rows, d): the rows whose key is also that of the row d further, for every d."""
    n = len(keys[0])
    rows, d = np.arange(n), 0
    while True:
        d += 1
        rows = rows[rows + d < n]
        for k in keys:
            rows = rows[k[rows] == k[rows + d]]
        if not len(rows):
            return
        yield rows, d


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, segments: int = 7, seed: int = 42, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: (doc_id, fp, component_id, copies).

    Documents whose fingerprints differ in at most `radius` bits are linked;
    component_id is the smallest doc_id reachable. Empty and null texts have
    fingerprint zero and are linked like others. Repeated rows stay repeated.
    A row with a null doc_id links others like any row, but lends no id: a group
    of such rows alone has a null component_id. An empty table gives an empty result.
    """
    own = settle(fingerprints(docs, shingle, seed, id_column, text_column))
    reps = settle(own.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    least, most, nameless = reps.agg(F.min("rep"), F.max("rep"), F.count("*") - F.count("rep")).first()
    most = 0 if least is None else most
    if nameless:  # nodes without an id come after all that have one
        reps = settle(reps.withColumn("rep", F.coalesce("rep", F.lit(most + 1) + F.monotonically_increasing_id())))
    roots = connected_components(link_fingerprints(reps.select("fp", "rep"), radius, segments))
    root = F.coalesce("root", "rep")
    classes = reps.join(roots, reps["rep"] == roots["node"], "left").select("fp", F.when(root <= most if least is not None else F.lit(False), root).alias("component_id"), "copies")
    return own.join(classes, "fp").select("doc_id", "fp", "component_id", "copies")
