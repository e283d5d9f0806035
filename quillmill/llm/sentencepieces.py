"""SentencePiece encoding and decoding; giant documents by a max-plus scan.

A BPE segmentation is the only path of pieces whose neighbours are all
compatible: merging the two pieces' text alone gives the two pieces back. So
encoding is a path problem over the max-plus semiring, where a compatible step
weighs 0 and any other minus infinity. A giant document is cut into chunks. A
chunk's transfer matrix leads from each state in which it may be entered (the
piece that crosses or ends at its left edge) to the states in which it is
left. The max-plus product is associative: products of neighbours go up a tree
over the chunks, the states on the path come down it, and then each chunk is
traced back and decoded alone from the states in which it is really entered
and left. Shorter
documents are parted where no piece holds both neighbours: one state is left
there, so words are scanned alone, and what a beginning of a word ends in is
remembered for all words that share it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.support import opened, session, settle, share

#: Where the public vocabularies are; a parameter of every function here.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Code points in a chunk; texts up to that are encoded in one task.
CHUNK = 1 << 16
#: Neighbours whose matrices are multiplied in one task, at every level of the tree.
FAN = 16
#: Words whose ids a task remembers, beginnings of words whose last piece it does, pairs of pieces, and code points of the longest of the words.
WORDS, BEGINNINGS, PAIRS, LONGEST_REMEMBERED = 1 << 18, 1 << 19, 1 << 19, 64
SPACE = "▁"
_START = 0
_NEVER = -np.inf


class Pieces:
    """The pieces of a BPE model with byte fallback, and which may follow each other.

    Characters without a piece are pieces of their own here, numbered from the
    size of the vocabulary; they become bytes in the end.
    """

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.size = self.processor.get_piece_size()
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        for i in range(n):
            piece = self.processor.id_to_piece(i)
            if self.processor.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (self.processor.is_control(i) or self.processor.is_unknown(i) or self.processor.is_unused(i)):
                self.id[piece], self.rank[piece] = i, -self.processor.get_score(i)
        #: Pieces that merging their own text gives, and the two that the last step merges.
        self.halves = {p: tuple(h) for p in self.id if len(p) > 1 and len(h := self.merged(p, 2)) == 2 and h[0] + h[1] == p}
        ranks = sorted(set(self.rank.values()))
        self.gap = min((b - a for a, b in zip(ranks, ranks[1:])), default=1.0) / 2
        made = lambda p: self.rank[p] if len(p) > 1 else -np.inf
        #: Pieces ranked before a part of theirs: near them, ranks do not tell what is merged first.
        odd = [p for p, h in self.halves.items() if max(map(made, h)) >= self.rank[p]]
        self.odd = [p for p in odd if not any(o in p for o in odd if o != p)]
        self.longest = max(map(len, self.id), default=1)
        #: Beginnings of pieces, and whether they are whole pieces.
        self.matches = {p[:n]: p[:n] in self.halves for p in self.id for n in range(2, len(p) + 1)}
        #: Ends of pieces; a whole piece has the pieces tried before it, and whether they are compatible.
        self.ends: dict[str, dict[str, bool] | None] = {p[n:]: None for p in self.id for n in range(len(p))}
        self.ends.update((p, {}) for p in self.id if len(p) == 1 or p in self.halves)
        self.pairs = 0
        #: The length of the last piece of each beginning of the words met.
        self.tails: dict[str, int] = {"": 0}
        inner = any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.id)
        self.free = re.compile(r"(?s).+" if inner else f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")
        #: Words and their ids. Nothing here leads back to this object: a task's tables are gone as soon as it ends.
        self.words: dict[str, tuple[int, ...]] = {}

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Plain BPE of a short text down to `least` parts: the best pair first, of equals the leftmost."""
        parts = list(text)
        while len(parts) > least:
            best = min(((self.rank.get(a + b, np.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(np.inf, 0))
            if best[0] == np.inf:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging a + b gives a and b, both whole."""
        if not a:
            return True
        fits = self.ends.get(b)
        if fits is None:
            fits = self.ends[b] = {}  # a character without a piece
        known = fits.get(a)
        if known is None:
            self.pairs += 1
            if self.pairs > PAIRS:
                for own in self.ends.values():
                    if own:
                        own.clear()
                self.pairs = 1
            both = a + b
            known = fits[a] = self.merged(both) == [a, b] if any(p in both for p in self.odd) else not self._crossed(a, b)
        return known

    def _crossed(self, a: str, b: str) -> bool:
        """Whether a merge across the edge comes before a and b are made, or after.

        The piece made last is taken apart first, of equals the right one; a
        merge across the edge at that time comes earlier if its rank is lower,
        or equal and further left.
        """
        rank, until = self.rank, np.inf
        while rank.get(a + b, np.inf) >= until or a + b not in rank:
            x = rank[a] if len(a) > 1 else -np.inf
            y = rank[b] if len(b) > 1 else -np.inf
            if x == y == -np.inf:
                return False
            if x > y:
                until, a = x, self.halves[a][1]
            else:
                until, b = y + self.gap, self.halves[b][0]
        return True

    def starting(self, text: str, at: int) -> Iterator[str]:
        """The pieces that match at a place, a lone character always among them."""
        yield text[at]
        for end in range(at + 2, min(len(text), at + self.longest) + 1):
            piece = text[at:end]
            whole = self.matches.get(piece)
            if whole:
                yield piece
            elif whole is None:
                return

    def entries(self, text: str, edge: int) -> list[tuple[str, int]]:
        """States in which a chunk may be entered at an edge: (piece, where it ends)."""
        out = []
        for start in range(max(0, edge - self.longest), edge):
            out += [(p, start + len(p)) for p in self.starting(text, start) if start + len(p) >= edge]
        return out

    def steps(self, text: str, states: list[tuple[str, int]], first: int, end: int, parents: bool = False):
        """Walk the compatible paths of a chunk [first, end) from the states.

        Returns {state left in: bits of the states it can be reached from}, and
        for each (place, piece) met the piece before it, if parents are kept.
        """
        alive: dict[int, dict[str, int]] = {}
        before: dict[tuple[int, str], str] = {}
        for i, (piece, at) in enumerate(states):
            alive.setdefault(at, {})
            alive[at][piece] = alive[at].get(piece, 0) | 1 << i
        for at in range(first, end):
            here = alive.pop(at, None)
            if not here:
                continue
            for piece in self.starting(text, at):
                bits, last = 0, ""
                for prior, own in here.items():
                    if self.compatible(prior, piece):
                        bits |= own
                        last = prior
                if bits:
                    to = alive.setdefault(at + len(piece), {})
                    to[piece] = to.get(piece, 0) | bits
                    if parents:
                        before[at + len(piece), piece] = last
        return {(piece, at): bits for at, own in alive.items() for piece, bits in own.items()}, before

    def transfer(self, text: str, first: int, end: int, head: bool) -> tuple[list[tuple[str, int]], list[tuple[str, int]], np.ndarray]:
        """(entry states, exit states, max-plus matrix) of a chunk; places count from its first character and its end."""
        states = [("", first)] if head else self.entries(text, first)
        left, _ = self.steps(text, states, first, end)
        exits = list(left)
        matrix = np.full((len(states), len(exits)), _NEVER)
        for j, s in enumerate(exits):
            for i in range(len(states)):
                if left[s] >> i & 1:
                    matrix[i, j] = 0.0
        return [(p, at - first) for p, at in states], [(p, at - end) for p, at in exits], matrix

    def traced(self, text: str, entry: tuple[str, int], leave: tuple[str, int], first: int, end: int) -> list[str]:
        """The pieces that begin in a chunk, traced back from the state it is left in."""
        _, before = self.steps(text, [(entry[0], first + entry[1])], first, end, parents=True)
        piece, at, out = leave[0], end + leave[1], []
        while at > first + entry[1]:
            out.append(piece)
            piece, at = before[at, piece], at - len(piece)
        return out[::-1]

    def path(self, text: str) -> list[str]:
        """The pieces of a text that is entered and left in one state.

        From one state at its start, each place is reached in one state alone:
        the last piece of what comes before, for that has one path. So the walk
        goes on from the longest beginning that was met in another word.
        """
        n, ends, tails = len(text), self.ends, self.tails
        last: list[str | None] = [None] * (n + 1)
        last[0] = ""
        kept = n <= LONGEST_REMEMBERED
        met = 0
        if kept:
            if len(tails) > BEGINNINGS:
                tails.clear()
                tails[""] = 0
            met = n
            while text[:met] not in tails:
                met -= 1
        for end in range(met + 1, n + 1):
            at = end - 1
            piece = text[at]
            fits = ends.get(piece)
            while True:
                if fits is not None or at == end - 1:
                    prior = last[at]
                    if prior is None:
                        prior = last[at] = text[at - tails[text[:at]] : at]
                    fit = fits.get(prior) if fits is not None else None
                    if fit or fit is None and self.compatible(prior, piece):
                        break
                at -= 1
                piece = text[at:end]
                fits = ends.get(piece)
            last[end] = piece
            if kept:
                tails[text[:end]] = len(piece)
        out = []
        while n:
            piece = last[n] or text[n - tails[text[:n]] : n]
            out.append(piece)
            n -= len(piece)
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        """Vocabulary numbers of a text, from the paths of its words; what is remembered is begun anew when it is full."""
        found, words = self.free.findall(escaped(text)), self.words
        new = set(found).difference(words)
        if len(words) + len(new) > WORDS:
            words.clear()
            new = set(found)
        for word in new:
            words[word] = tuple(self.ids(self.path(word)))
        ids = list(chain.from_iterable(map(words.__getitem__, found)))
        for word in new:
            if len(word) > LONGEST_REMEMBERED:
                del words[word]
        return ids

    def ids(self, pieces: list[str]) -> list[int]:
        """Vocabulary numbers; a character without a piece gives its bytes' numbers."""
        out: list[int] = []
        for p in pieces:
            known = self.id.get(p)
            out += [known] if known is not None else [self.byte[b] for b in p.encode()]
        return out


def escaped(text: str) -> str:
    """The text as the model sees it: a leading space, and spaces visible. Empty stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def combined(a: np.ndarray, exits: list, entries: list, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two neighbours' matrices; the left one's exits are matched to the right one's entries."""
    place = {s: i for i, s in enumerate(entries)}
    out = np.full((a.shape[0], b.shape[1]), _NEVER)
    for j, s in enumerate(exits):
        i = place.get(s)
        if i is not None:
            out = np.maximum(out, a[:, j, None] + b[i][None, :])
    return out


Node = tuple[list, list, np.ndarray]  # entry states, exit states, matrix


def joined(a: Node, b: Node) -> Node:
    """Two neighbours as one: associative, so that any tree over the chunks gives the same matrix."""
    return a[0], b[1], combined(a[2], a[1], b[0], b[2])


def scan(parts: list[Node], enter: int | None = None, leave: int | None = None) -> list[tuple[tuple[str, int], tuple[str, int]]]:
    """The (entry, exit) state of every one of a run of neighbours, given the states in which the run is entered and left.

    Without them the run is a whole text. Products from the left say which
    states are reached from the entry; a state of an edge that is reached and
    leads to the exit is on the path.
    """
    n = len(parts)
    forward = [parts[0][2][0 if enter is None else enter]]
    for i in range(1, n):
        forward.append(combined(forward[-1][None], parts[i - 1][1], parts[i][0], parts[i][2])[0])
    if leave is None:
        leave = next(j for j, (_, at) in enumerate(parts[-1][1]) if at == 0 and forward[-1][j] > _NEVER)
    on = []
    for i in range(n - 1, 0, -1):
        reached = {s: forward[i - 1][j] for j, s in enumerate(parts[i - 1][1])}
        first = int(np.argmax([reached.get(s, _NEVER) + parts[i][2][j, leave] for j, s in enumerate(parts[i][0])]))
        on.append((parts[i][0][first], parts[i][1][leave]))
        leave = parts[i - 1][1].index(parts[i][0][first])
    on.append((parts[0][0][0 if enter is None else enter], parts[0][1][leave]))
    return on[::-1]


def chunk_bounds(length: int, chunk: int, longest: int) -> list[tuple[int, int]]:
    """Chunks of about the same length, none shorter than the longest piece if the text is not."""
    chunk = max(chunk, 2 * longest)
    n = max(1, -(-length // chunk))
    return [(length * i // n, length * (i + 1) // n) for i in range(n)]


def encode_in_chunks(text: str, pieces: Pieces, chunk: int = CHUNK) -> list[int]:
    """One text by the scan, without Spark."""
    text = escaped(text)
    if not text:
        return []
    bounds = chunk_bounds(len(text), chunk, pieces.longest)
    parts = [pieces.transfer(text, a, b, a == 0) for a, b in bounds]
    return pieces.ids([p for (a, b), (entry, leave) in zip(bounds, scan(parts)) for p in pieces.traced(text, entry, leave, a, b)])


def _model(path: str) -> bytes:
    with open(path, "rb") as f:  # a vocabulary file beside the driver, half a megabyte
        return f.read()


def encode(docs: DataFrame, model: str = MODEL, chunk: int = CHUNK, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: (doc_id, ids array<int>).

    Null and empty texts have no ids; ids of documents may be null or repeated;
    repeated rows are encoded each; other columns are dropped; an empty table
    gives an empty result. Texts of over `chunk` code points are encoded by
    chunks in as many tasks as they have chunks; results are those of the whole
    text.
    """
    return _encoded(docs, model, chunk, id_column, text_column, False)


def encode_and_decode(docs: DataFrame, model: str = MODEL, chunk: int = CHUNK, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """encode(), and what the ids decode to: (doc_id, n_tokens, ids, decoded_chars, decoded_sha256).

    Short texts are decoded in the task that encodes them.
    """
    out = _encoded(docs, model, chunk, id_column, text_column, True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_chars", "decoded_sha256")


def _encoded(docs: DataFrame, model: str, chunk: int, id_column: str, text_column: str, decoded: bool) -> DataFrame:
    spark = session()
    pieces = Pieces(_model(model))
    held = share(spark, pieces)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = opened(held)
        for batch in batches:
            ids = [pieces.encode(x) for x in batch.column(1).to_pylist()]
            more = _digests(pieces.processor, ids) if decoded else []
            yield pa.record_batch([batch.column(0), pa.array(ids, type=pa.list_(pa.int32())), *more], names=["doc_id", "ids", "decoded_chars", "decoded_sha256"][: 2 + len(more)])

    schema = "doc_id long, ids array<int>" + ", decoded_chars long, decoded_sha256 string" * decoded
    short = rows.where(F.length("text") <= chunk).mapInArrow(whole, schema)
    return short.union(_encode_giants(rows.where(F.length("text") > chunk), held, pieces.longest, chunk, decoded))


def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def _digests(processor, ids: list) -> list[pa.Array]:
    """Code points and SHA-256 of what each list of ids decodes to."""
    texts = [processor.decode(x) if x else "" for x in ids]
    return [pa.array([len(t) for t in texts], type=pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], type=pa.string())]


_CHUNKS = "key string, doc_id long, part int, parts int, text string, first int, end int"
_STATE = "struct<piece:string,at:int>"


def _encode_giants(rows: DataFrame, held, longest: int, chunk: int, decoded: bool) -> DataFrame:
    """Chunks, their matrices, products up a tree of neighbours, states down it again, and each chunk's pieces from its own states."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        n = 0
        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                key, n = f"{TaskContext.get().partitionId()}:{n}", n + 1
                text = escaped(text)
                bounds = chunk_bounds(len(text), chunk, longest)
                for at in range(0, len(bounds), 64):
                    made = []
                    for i, (a, b) in list(enumerate(bounds))[at : at + 64]:
                        low = max(0, a - longest)
                        made.append((key, doc_id, i, len(bounds), text[low : b + longest], a - low, b - low))
                    yield _batch(made, (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32()), _CHUNKS)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = opened(held)
        state = pa.list_(pa.struct([("piece", pa.string()), ("at", pa.int32())]))
        for batch in batches:
            for key, _, part, _, text, first, end in zip(*(c.to_pylist() for c in batch.columns)):
                entries, exits, matrix = pieces.transfer(text, first, end, part == 0)
                yield _batch([(key, part, _states(entries), _states(exits), matrix.ravel().tolist())], (pa.string(), pa.int32(), state, state, pa.list_(pa.float64())), "key part entries exits matrix")

    def product(run):
        import pandas as pd

        run = run.sort_values("part")
        whole = reduce(joined, _nodes(run))
        return pd.DataFrame({"key": run["key"].to_numpy()[:1], "part": run["part"].to_numpy()[:1] // FAN, "entries": [_states(whole[0])], "exits": [_states(whole[1])], "matrix": [whole[2].ravel().tolist()]})

    def placed(run):
        import pandas as pd

        run = run.sort_values("part")
        parts = _nodes(run)
        enter, leave = run["enter"].iloc[0], run["leave"].iloc[0]
        on = scan(parts) if enter is None else scan(parts, parts[0][0].index((enter["piece"], int(enter["at"]))), parts[-1][1].index((leave["piece"], int(leave["at"]))))
        return pd.DataFrame({"key": run["key"].to_numpy(), "part": run["part"].to_numpy(), "enter": _states([a for a, _ in on]), "leave": _states([b for _, b in on])})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = opened(held)
        for batch in batches:
            made = []
            for key, doc_id, part, text, first, end, entry, leave in zip(*(c.to_pylist() for c in batch.columns)):
                found = pieces.traced(text, (entry["piece"], entry["at"]), (leave["piece"], leave["at"]), first, end)
                ids = pieces.ids(found)
                made.append((key, doc_id, part, ids, decoded_part(pieces.processor, ids, part == 0) if decoded else None))
            yield _batch(made, (pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.string()), "key doc_id part ids text")

    chunks = settle(rows.mapInArrow(cut, _CHUNKS))
    most = chunks.agg(F.max("parts")).first()[0] or 0
    spark = session()
    if not most:
        return spark.createDataFrame([], "doc_id long, ids array<int>" + ", decoded_chars long, decoded_sha256 string" * decoded)
    chunks = chunks.repartition(max(4 * spark.sparkContext.defaultParallelism, chunks.count() // 64), "key", "part")  # slow rows: a few a task
    node = f"key string, part int, entries array<{_STATE}>, exits array<{_STATE}>, matrix array<double>"
    levels = [settle(chunks.mapInArrow(matrices, node))]
    above = lambda df: df.groupBy("key", F.floor(F.col("part") / FAN).cast("int").alias("up"))
    while most > FAN:  # products of FAN neighbours, until a document has at most FAN nodes
        levels.append(settle(above(levels[-1]).applyInPandas(product, node)))
        most = -(-most // FAN)
    on_path = None
    for level in reversed(levels):
        if on_path is None:
            run = level.withColumns({"enter": F.lit(None).cast(_STATE), "leave": F.lit(None).cast(_STATE)})
        else:
            run = level.withColumn("up", F.floor(F.col("part") / FAN).cast("int")).join(on_path.withColumnRenamed("part", "up"), ["key", "up"]).drop("up")
        on_path = settle(above(run).applyInPandas(placed, f"key string, part int, enter {_STATE}, leave {_STATE}"))
    traced = chunks.join(on_path, ["key", "part"]).select("key", "doc_id", "part", "text", "first", "end", "enter", "leave").mapInArrow(trace, "key string, doc_id long, part int, ids array<int>, text string")
    whole = traced.groupBy("key", "doc_id").agg(F.array_sort(F.collect_list(F.struct("part", "ids", "text"))).alias("parts"))  # the rows of one document, as its result needs them
    text = F.array_join("parts.text", "")
    return whole.select("doc_id", F.flatten("parts.ids").alias("ids"), *([F.length(text).cast("long").alias("decoded_chars"), F.sha2(text, 256).alias("decoded_sha256")] if decoded else []))


def _nodes(run) -> list[Node]:
    """Rows (entries, exits, matrix) as nodes."""
    out = []
    for entries, exits, matrix in zip(run["entries"], run["exits"], run["matrix"]):
        a, b = ([(s["piece"], int(s["at"])) for s in x] for x in (entries, exits))
        out.append((a, b, np.array(matrix, dtype=float).reshape(len(a), len(b))))
    return out


def decoded_part(processor, ids: list[int], head: bool) -> str:
    """What the ids of a chunk decode to. A character's bytes lie in one chunk; only the text's first space is left out."""
    out, held = [], bytearray()
    for i in ids:
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            held.append(int(piece[3:5], 16))
            continue
        if held:
            out.append(held.decode("utf-8", "replace"))
            held = bytearray()
        out.append(piece)
    out.append(held.decode("utf-8", "replace"))
    text = "".join(out)
    return (text.removeprefix(SPACE) if head else text).replace(SPACE, " ")


def _states(states: list[tuple[str, int]]) -> list[dict]:
    return [{"piece": p, "at": at} for p, at in states]


def _batch(rows: list[tuple], types: tuple, names: str) -> pa.RecordBatch:
    names_ = [x.split()[0] for x in names.split(", ")] if "," in names else names.split()
    made = list(zip(*rows)) if rows else [()] * len(types)
    return pa.record_batch([pa.array(c, type=t) for c, t in zip(made, types)], names=names_)


def decode(encoded: DataFrame, model: str = MODEL, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, ids) -> (doc_id, text).

    Null and empty lists of ids give an empty text; a null doc_id stays; repeated
    rows repeat; other columns are dropped; an empty table gives an empty result.
    """
    held = session().sparkContext.broadcast(_model(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(held.value)
        for batch in batches:
            texts = [processor.decode(x) if x else "" for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, type=pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col(id_column).alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
