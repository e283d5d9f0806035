"""Near-duplicate texts by exact Jaccard similarity of word shingles, candidates from a pigeonring of SimHash bits.

At a similarity of 0.8 two SimHash fingerprints differ in 0.152 of their bits
at most, on average: 9 or 10 of 64, and up to 20, which leaves no equal run
that would be a selective key. So the fingerprint has `BITS` bits, on a ring
of `SEGMENTS` segments. A pair becomes a candidate only through a chain: two
consecutive equal segments, in any place on the ring, are the join key, the
run of segments that follows may not differ much, then the whole fingerprints.
The similarity of candidates is computed from whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.components import connected_components
from quillmill.llm.simhash import complete_runs, near_rows
from quillmill.llm.support import SPACES, Groups, byte_class, hashed_words, in_block_pairs, in_blocks, mix, raw_texts, session, settle, shingle_hashes

#: Segments of 8 bits on the ring. With bits that differ in a share of 0.1514, no CHAIN in a row are equal for 2.7 of a million pairs (192 segments: 7.2).
SEGMENTS, CHAIN = 208, 2
BITS = 8 * SEGMENTS
#: Segments after a chain that are held with its key; a pair whose bits there differ in over a third (at 0.8, 5.6 deviations off) is none.
RUN, RUN_MOST = 16, 16 * 8 // 3
#: Candidates whose fingerprints differ in a larger share of the bits are not compared: at a similarity of 0.8 that is nine deviations off.
MOST_DIFFER = 0.23
#: Texts of up to so many different shingles have a key for each besides: of 5 and 4 of them, 0.19 of the bits differ.
FEW_SHINGLES = 5
#: Up to so many pairs of a key whose runs are alike are candidates at once; beyond, first those of stars and of spanning forests by estimate.
SMALL_KEY = 66
#: Texts with a key that are compared by their runs; a key with more is left to the forests as it is.
HOT_KEY = 2048
#: Texts of one key that are held in a task, about; a key with more is parted into blocks, and pairs of blocks.
LARGE_KEY = 4096
#: In the first round, a key's texts are tested with up to LEADERS of them, if their fingerprints differ in this share of the bits at most.
LEADERS, LIKELY = 32, 0.15
#: Texts of up to so many shingles lie with their key as sets; pairs with longer ones are compared from tables.
HELD_SHINGLES = 1024
#: Sets that one is compared with at once, and pairs held before a forest is made of them.
SETS_AT_ONCE, FOREST_PAIRS = 256, 150_000
#: Bytes of texts whose words are hashed at once, about.
TEXT_BYTES = 1 << 20
#: Buckets of ids, the bound of what is broadcast.
BUCKETS = 1 << 20
_SPACE = byte_class(SPACES)
_SEEDS = np.random.default_rng(20).integers(0, 1 << 63, BITS // 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Keys of shingles are larger than this, those of chains (start, two segments) smaller.
_SHINGLE_KEY = 1 << 62


def shingle_sets(texts: list[bytes], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' shingles and each text's first (n + 1 offsets); every text has one at least.

    Fewer words than a shingle are one shingle of them all, and no words one of their own.
    """
    words, bounds = hashed_words(texts, _SPACE)
    grams = shingle_hashes(words, shingle)
    parts, lengths = [], []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = grams[a : b - shingle + 1] if b - a >= shingle else shingle_hashes(words[a:b], b - a) ^ np.uint64(b - a) if b > a else np.zeros(1, dtype=np.uint64)
        parts.append(own)
        lengths.append(len(own))
    return np.concatenate(parts) if parts else grams[:0], np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def own_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The sorted different hashes of each text's shingles."""
    out: list[np.ndarray] = []
    held = np.cumsum([len(x) for x in texts]) // TEXT_BYTES if texts else np.empty(0)
    for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(held)) + 1):
        grams, bounds = shingle_sets([texts[i] for i in some], shingle)
        out += [np.unique(grams[x:y]) for x, y in zip(bounds[:-1], bounds[1:])]
    return out


def fingerprint(grams: np.ndarray) -> np.ndarray:
    """SimHash of BITS bits, as SEGMENTS bytes, of a set of shingles' hashes: a bit is 1 if it is in over half of them."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(grams), 255):
        bits = np.unpackbits(mix(grams[at : at + 255, None] + _SEEDS).view(np.uint8), axis=1)
        # Eight bytes are added at once: no sum of 255 bits leaves its byte.
        counts += np.add.reduce(bits.view(np.uint64), axis=0).view(np.uint8)
    return np.packbits(2 * counts > len(grams))


def similarity(a: bytes, b: bytes, shingle: int) -> float:
    """Exact Jaccard similarity of two texts' sets of shingles."""
    grams, bounds = shingle_sets([a, b], shingle)
    x, y = np.unique(grams[: bounds[1]]), np.unique(grams[bounds[1] :])
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of bits in which rows of segments differ."""
    return np.add.reduce(np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)), axis=-1, dtype=np.uint32)


def _across(sketch: np.ndarray, roots: np.ndarray, start: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(likeness, i, those j): pairs of rows of different roots whose fingerprints are alike, each pair once.

    A pair is left to the first start on the ring from which its chain is equal.
    The largest group comes last, so its rows are not held against each other.
    """
    _, root, size = np.unique(roots, return_inverse=True, return_counts=True)
    order = np.lexsort((root, size[root]))
    s, r = sketch[order], root[order]
    ends = np.append(np.flatnonzero(r[1:] != r[:-1]) + 1, len(r))
    others = ends[np.searchsorted(ends, np.arange(len(r)), side="right")]
    for i in range(len(r)):
        if others[i] == len(r):
            return
        same = 1 - differing(s[others[i] :], s[i]) / BITS
        near = np.flatnonzero(same >= 1 - MOST_DIFFER)
        if start > 0 and len(near):
            equal = s[others[i] + near] == s[i]
            before = (equal[:, :start] & equal[:, 1 : start + 1]).any(axis=1)
            near = near[~before]
        if len(near):
            yield same[near], int(order[i]), order[others[i] + near]


def _stars(sketch: np.ndarray, reps: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a text and the first of its key that it is likely to be similar to: as many as texts at most."""
    left, found = np.arange(len(reps)), []
    for _ in range(LEADERS):
        if len(left) < 2:
            break
        near = differing(sketch[left[1:]], sketch[left[0]]) <= LIKELY * BITS
        found += [(int(reps[left[0]]), j) for j in reps[left[1:][near]].tolist()]
        left = left[1:][~near]
    return found


def _forest(sketch: np.ndarray, reps: np.ndarray, roots: np.ndarray, tested: set[tuple[int, int]], start: int) -> list[tuple[int, int]]:
    """Pairs of a spanning forest of the groups of one key, the likeliest first; pairs tested before are left out."""
    found: list[tuple[float, int, int]] = []
    for same, i, js in _across(sketch, roots, start):
        made = [(-x, i, j) for x, j in zip(same.tolist(), js.tolist())]
        found += [f for f in made if tuple(sorted((int(reps[i]), int(reps[f[2]])))) not in tested] if tested else made
        if len(found) > FOREST_PAIRS:
            found = _spanning(found, roots)
    return [(int(reps[a]), int(reps[b])) for _, a, b in _spanning(found, roots)]


def _spanning(found: list[tuple[float, int, int]], roots: np.ndarray) -> list[tuple[float, int, int]]:
    groups = Groups()
    return [f for f in sorted(found) if groups.join(int(roots[f[1]]), int(roots[f[2]]))]


def sketched_rows(rows: DataFrame, shingle: int) -> DataFrame:
    """(rep, md5, text) -> (rep, md5, sketch, few): the SimHash fingerprint, and the shingles of a text that has FEW_SHINGLES at most."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = own_sets(raw_texts(batch.column(2)), shingle)
            few = [x.view(np.int64) if len(x) <= FEW_SHINGLES else None for x in sets]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([fingerprint(x).tobytes() for x in sets], type=pa.binary()), pa.array(few, type=pa.list_(pa.int64()))], names=["rep", "md5", "sketch", "few"])

    return rows.mapInArrow(sketch, "rep long, md5 binary, sketch binary, few array<long>")


def _segments(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, SEGMENTS)


def chains(sketched: DataFrame) -> DataFrame:
    """(rep, sketch, few) -> (key, rep, x, y): a row for each start on the ring, its CHAIN segments as key and the RUN after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                reps, s = some.column(0).to_numpy(), _segments(some.column(1).to_pylist())
                ring = np.concatenate([s, s[:, : CHAIN + RUN]], axis=1)
                key = np.arange(SEGMENTS, dtype=np.int64) << 8 * CHAIN
                for j in range(CHAIN):
                    key = key | ring[:, j : j + SEGMENTS].astype(np.int64) << 8 * j
                held = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(ring[:, CHAIN:], RUN, axis=1)[:, :SEGMENTS]).view(np.int64).reshape(-1, 2)
                few = [(g, r) for gs, r in zip(some.column(2).to_pylist(), reps.tolist()) for g in gs or ()]
                more = np.array(few, dtype=np.int64).reshape(-1, 2)
                none = np.zeros(len(more), dtype=np.int64)
                parts = [key.ravel(), more[:, 0] & (_SHINGLE_KEY - 1) | _SHINGLE_KEY], [np.repeat(reps, SEGMENTS), more[:, 1]], [held[:, 0], none], [held[:, 1], none]
                yield pa.record_batch([pa.array(np.concatenate(p)) for p in parts], names=["key", "rep", "x", "y"])

    return sketched.select("rep", "sketch", "few").mapInArrow(run, "key long, rep long, x long, y long")


def candidate_pairs(sketched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rep, sketch, few) of different texts -> all candidate pairs (a, b), a < b, of small keys, and (key, start, rep) of larger ones."""

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, hot in complete_runs(batches, 1, HOT_KEY):
            if hot:
                yield _met(rows[:, 1], rows[:, 0], True)
                continue
            key, reps, runs = rows[:, 0], rows[:, 1], np.ascontiguousarray(rows[:, 2:])
            near = [(first[alike], first[alike] + d) for first, d in near_rows(key) for alike in [differing(runs[first], runs[first + d]) <= RUN_MOST]]
            if not near:
                continue
            i, j = (np.concatenate(x) for x in zip(*near))
            at = np.searchsorted(key, key[i])  # a run's first row
            many = np.bincount(at, minlength=len(key))[at] > SMALL_KEY
            a, b = reps[i[~many]], reps[j[~many]]
            yield _met(np.minimum(a, b), np.maximum(a, b), False)
            members = np.unique(np.concatenate([i[many], j[many]]))
            yield _met(reps[members], key[members], True)

    keyed = chains(sketched).repartition("key").sortWithinPartitions("key")
    out = settle(keyed.mapInArrow(small, "a long, b long, hot boolean"))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (_segments(batch.column(j).to_pylist()) for j in (2, 3))
            keep = pa.array(differing(x, y) <= MOST_DIFFER * BITS, type=pa.bool_())
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    own = lambda c, s: sketched.select(F.col("rep").alias(c), F.col("sketch").alias(s))
    cold = out.where("not hot and a <> b").select("a", "b").distinct()
    cold = cold.join(own("a", "x"), "a").join(own("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(likely, "a long, b long")
    start = F.when(F.col("b") < F.lit(_SHINGLE_KEY), F.shiftright("b", 8 * CHAIN).cast("int")).otherwise(F.lit(0))
    return cold, out.where("hot").select(F.col("b").alias("key"), start.alias("start"), F.col("a").alias("rep"))


def _met(a: np.ndarray, b: np.ndarray, hot: bool) -> pa.RecordBatch:
    return pa.record_batch([pa.array(a), pa.array(b), pa.array(np.full(len(a), hot))], names=["a", "b", "hot"])


def pairs_across(hot: DataFrame, sketched: DataFrame, roots: DataFrame | None, tested: DataFrame | None) -> DataFrame:
    """(key, start, rep) of larger keys -> (key, a, b): stars of each key's texts, then a spanning forest, by estimate, of its groups.

    `roots` (node, root) and `tested` (key, a, b) come from the round before and
    are missing in the first. A key with over LARGE_KEY texts has stars or a
    forest for each block of them, dealt anew each round.
    """

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, start, reps, groups, sketch, _, known in _key_runs(batches):
            if len(reps):
                yield _pairs(key, _stars(sketch, reps) if first else _forest(sketch, reps, groups, known, start), False)

    first = roots is None
    rows = in_blocks(_open_rows(hot, roots), "key", "rep", LARGE_KEY, 1 if first else 2)
    return _by_key(rows, sketched, None, tested).mapInArrow(across, _FOUND).drop("sure")


def links_across(hot: DataFrame, sketched: DataFrame, roots: DataFrame, tested: DataFrame, rows: DataFrame, reps: DataFrame, shingle: int, least: float) -> DataFrame:
    """(key, a, b, sure) of every pair of a larger key that may still be a link between different roots.

    Pairs of texts with held sets are decided here, and only a spanning forest
    of their links leaves the task (sure); the others are candidates. Every pair
    of blocks of a key with over LARGE_KEY texts is a task's key of its own.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, bounds = shingle_sets(raw_texts(batch.column(1)), shingle)
            held = [np.unique(grams[x:y]).tobytes() if y - x <= HELD_SHINGLES else None for x, y in zip(bounds[:-1], bounds[1:])]
            yield pa.record_batch([batch.column(0), pa.array(held, type=pa.binary())], names=["rep", "grams"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, start, reps, groups, sketch, grams, known in _key_runs(batches):
            own, linked = [None if g is None else np.frombuffer(g, np.uint64) for g in grams], Groups()
            sure: list[tuple[int, int]] = []
            for _, i, js in _across(sketch, groups, start):
                short = [j for j in js.tolist() if own[i] is not None and own[j] is not None]
                for at in range(0, len(short), SETS_AT_ONCE):
                    some = short[at : at + SETS_AT_ONCE]
                    for j in [some[n] for n in np.flatnonzero(_likeness(own[i], [own[j] for j in some]) >= least)]:
                        if linked.join(int(groups[i]), int(groups[j])):
                            sure.append((int(reps[i]), int(reps[j])))
                if len(short) < len(js):
                    rest = [(int(reps[i]), int(reps[j])) for j in js.tolist() if own[i] is None or own[j] is None]
                    yield _pairs(key, [p for p in rest if tuple(sorted(p)) not in known], False)
            yield _pairs(key, sure, True)

    left = settle(_open_rows(hot, roots))
    held = settle(_texts(rows, reps, left.select("rep").distinct()).mapInArrow(sets, "rep long, grams binary"))
    return _by_key(in_block_pairs(left, "key", "rep", LARGE_KEY), sketched, held, tested).mapInArrow(across, _FOUND)


_FOUND = "key long, a long, b long, sure boolean"


def _open_rows(hot: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(key, start, rep, root) of the keys whose texts have different roots so far."""
    if roots is None:
        return hot.withColumn("root", F.col("rep"))
    rows = settle(hot.join(roots, hot["rep"] == roots["node"], "left").select("key", "start", "rep", F.coalesce("root", "rep").alias("root")))
    return rows.join(rows.groupBy("key").agg((F.min("root") < F.max("root")).alias("open")).where("open").select("key"), "key", "left_semi")


def _by_key(rows: DataFrame, sketched: DataFrame, held: DataFrame | None, tested: DataFrame | None) -> DataFrame:
    """(key, start, rep, root, sketch, grams) sorted by key, pairs tested before ahead of a key's texts, without sketches."""
    none = F.lit(None).cast("binary")
    rows = rows.join(sketched.select("rep", "sketch"), "rep")
    rows = rows.withColumn("grams", none) if held is None else rows.join(held, "rep", "left")
    rows = rows.select("key", "start", "rep", "root", "sketch", "grams")
    if tested is not None:
        rows = rows.unionByName(tested.select("key", F.lit(None).cast("int").alias("start"), F.col("a").alias("rep"), F.col("b").alias("root"), none.alias("sketch"), none.alias("grams")))
    return rows.repartition("key").sortWithinPartitions("key", F.col("sketch").isNotNull(), "rep")


def _likeness(one: np.ndarray | None, others: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of a sorted set and each of the others."""
    if not others:
        return np.empty(0)
    sizes = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    both = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return both / (len(one) + sizes - both)


def _pairs(key: int, pairs: list[tuple[int, int]], sure: bool) -> pa.RecordBatch:
    made = np.array(pairs, dtype=np.int64).reshape(-1, 2)
    return pa.record_batch([pa.array(np.full(len(made), key, dtype=np.int64)), pa.array(made.min(axis=1)), pa.array(made.max(axis=1)), pa.array(np.full(len(made), sure))], names=["key", "a", "b", "sure"])


def _key_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, list, set[tuple[int, int]]]]:
    """(key, start, reps, roots, sketches, sets, tested pairs) of each run of equal keys, held for one key at a time."""
    key, start, reps, groups, rows, grams, known = None, 0, [], [], [], [], set()
    out = lambda: (key, start, np.array(reps, dtype=np.int64), np.array(groups, dtype=np.int64), _segments(rows), grams, known)
    for batch in batches:
        for k, at, r, g, s, x in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if key is not None:
                    yield out()
                key, reps, groups, rows, grams, known = k, [], [], [], [], set()
            if s is None:
                known.add((r, g))
            else:
                start = at
                reps.append(r)
                groups.append(g)
                rows.append(s)
                grams.append(x)
    if key is not None:
        yield out()


def near_duplicate_classes(docs: DataFrame, shingle: int = 5, least: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, component_id) of every row with an id: the smallest id reachable through near-duplicates.

    Texts are near-duplicates at a Jaccard similarity of `least` or more of
    their sets of shingles, A-Z lowered; texts without words are alike. Equal
    texts are one text first. Null texts are empty; rows with a null id are
    left out; an empty table gives an empty result.
    """
    session()
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")).where("doc_id is not null")
    marked = rows.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("md5"), "text")
    # Texts stay where they are: of each row only its sketch is moved.
    sketched = settle(sketched_rows(marked.select(F.col("doc_id").alias("rep"), "md5", "text"), shingle))
    firsts = settle(sketched.groupBy("md5").agg(F.min("rep").alias("rep"), F.min_by(F.struct("sketch", "few"), "rep").alias("s")).select("md5", "rep", "s.sketch", "s.few"))
    reps = firsts.select("md5", "rep")
    cold, hot = candidate_pairs(firsts)
    sketch = firsts.select("rep", "sketch")
    # A text is tested with the first of its stars' middles only: what that leaves apart is left to the forests.
    chosen = settle(pairs_across(hot, sketch, None, None).groupBy("b").agg(F.min_by("key", F.struct("a", "key")).alias("key"), F.min("a").alias("a")).select("key", "a", "b"))
    roots = connected_components(_similar(rows, reps, settle(cold.union(chosen.select("a", "b")).distinct()), shingle, least))
    more = settle(pairs_across(hot, sketch, roots, chosen))
    roots = _joined(roots, [_similar(rows, reps, _fresh(more, chosen), shingle, least)])
    chosen = chosen.union(more)
    more = settle(links_across(hot, sketch, roots, chosen, rows, reps, shingle, least))
    roots = _joined(roots, [more.where("sure").select("a", "b"), _similar(rows, reps, _fresh(more.where("not sure"), chosen), shingle, least)])
    classes = reps.join(roots, reps["rep"] == roots["node"], "left").select("md5", F.coalesce("root", "rep").alias("component_id"))
    return sketched.select(F.col("rep").alias("doc_id"), "md5").join(classes, "md5").select("doc_id", "component_id")


def _fresh(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    """Those of the pairs that were not tested in any key."""
    return settle(pairs.select("a", "b").distinct().join(tested.select("a", "b").distinct(), ["a", "b"], "left_anti"))


def _joined(roots: DataFrame, links: list[DataFrame]) -> DataFrame:
    """Roots (node, root) after more links (a, b)."""
    every = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    links = [x for x in links if not x.isEmpty()]
    for more in links:
        every = every.union(more)
    return connected_components(every) if links else roots


def _texts(rows: DataFrame, reps: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, text) of distinct ids; rows are all (doc_id, text), reps (md5, rep)."""
    wanted = settle(reps.join(ids, "rep", "left_semi"))
    # Before texts are moved, most of those not wanted are left out by their ids' buckets: at most BUCKETS numbers.
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS))
    buckets = wanted.select(bucket("rep").alias("bucket")).distinct()
    some = rows.join(F.broadcast(buckets), bucket("doc_id") == F.col("bucket"), "left_semi")
    texts = some.select(F.col("doc_id").alias("rep"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("md5"), "text")
    return texts.join(wanted, ["rep", "md5"], "left_semi").dropDuplicates(["rep"]).select("rep", "text")


def _similar(rows: DataFrame, reps: DataFrame, pairs: DataFrame, shingle: int, least: float) -> DataFrame:
    """Those (a, b) of the settled pairs whose whole texts are similar."""
    if pairs.isEmpty():
        return pairs
    held = settle(_texts(rows, reps, pairs.select(F.col("a").alias("rep")).union(pairs.select(F.col("b").alias("rep"))).distinct()))
    both = pairs.join(held.select(F.col("rep").alias("a"), F.col("text").alias("left")), "a").join(held.select(F.col("rep").alias("b"), F.col("text").alias("right")), "b").select("a", "b", "left", "right")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = raw_texts(batch.column(2)), raw_texts(batch.column(3))
            place = {x: i for i, x in enumerate(dict.fromkeys(left + right))}
            sets = own_sets(list(place), shingle)
            keep = pa.array([bool(_likeness(sets[place[x]], [sets[place[y]]])[0] >= least) for x, y in zip(left, right)], type=pa.bool_())
            yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return settle(both.mapInArrow(verify, "a long, b long"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, least: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs with one document of each class: that with the smallest id, and one row of it.

    Rows with a null id belong to no class and stay.
    """
    classes = near_duplicate_classes(docs, shingle, least, id_column, text_column)
    gone = settle(classes.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct())
    kept = docs.join(gone, docs[id_column] == gone["gone"], "left_anti")
    if classes.groupBy("doc_id").count().where("count > 1").isEmpty():
        return kept
    return kept.where(F.col(id_column).isNotNull()).dropDuplicates([id_column]).union(kept.where(F.col(id_column).isNull()))
