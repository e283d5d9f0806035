"""Personal data: base patterns, and candidates that boosted trees accept.

Base spans of e-mail addresses, IP addresses, card and phone numbers are those
of fixed patterns and checks. High-recall generators propose more spans, which
may overlap each other and the base's failures; gradient-boosted trees judge
their format and context, and those above their kind's calibrated threshold are
added where they overlap no span already held, best first.

The trees learn from where a span comes from, not from whether the base checks
hold for it: base spans of the documents are rewritten in forms that the base
patterns do not find (spaces, other separators, spelled-out signs, no plus) and
put back into their places, and the same forms with wrong digits are put there
and elsewhere. Documents are dealt to fitting, thresholds and a last part that
gives each kind's precision and recall.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.support import opened, session, share
from quillmill.llm.trees import boost, calibrate, tree_values

KINDS = ("email", "ip", "card", "phone")
# The base patterns. Look-behind and possessive repeats find the
# same leftmost matches without trying a run of digits again from each digit.
_TAIL = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|[\[(](?:at|AT)[\])]")
# Generators.
_MORE = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\s?(?:@|[\[(](?:at|AT)[\])])\s?[A-Za-z0-9-]{1,63}(?:\s?(?:\.|[\[(](?:dot|DOT)[\])])\s?[A-Za-z0-9-]{2,63}){1,4}"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\s?[.]\s?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}(?![0-9])|(?<![0-9])[0-9]{13,19}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])\+?[0-9]{0,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])|\b00[0-9]{9,13}\b"),
}
#: Documents whose candidates are fitted on, at most; candidates of them, at most; precision that the threshold must reach.
SAMPLE_DOCS, SAMPLE_SPANS, PRECISION = 6_000, 20_000, 0.98
#: Judged candidates of a kind that its threshold needs at least; fewer add nothing.
LEAST_JUDGED = 15
CUES = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "addr"), "card": ("card", "visa", "pay", "account"), "phone": ("tel", "phone", "call", "fax", "mobile")}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards in linear time."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _NAME:
            start -= 1
        found = _TAIL.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns that pass their checks, by kind and start; code points, end exclusive."""
    if not _ANY.search(text):
        return []
    out = [("email", a, b) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Spans that the generators propose, of any kind, overlapping or not."""
    if not _ANY.search(text):
        return []
    return [(kind, *m.span()) for kind in KINDS for m in _MORE[kind].finditer(text)]


def span_features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    s = text[start:end]
    digits = _digits(s)
    groups = re.findall(r"[0-9]+", s)
    before, after = text[max(0, start - 24) : start], text[end : end + 8]
    last, following = before[-1:], after[:1]
    parts = [int(x[-4:]) for x in groups[:6]]
    return [
        float(KINDS.index(kind)), len(s), len(digits), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0), float(luhn(digits)) if digits else 0.0, float(s.startswith("+")), float("(" in s), s.count(" "), s.count("-"), s.count("."),
        float("@" in s), sum(c.isalpha() for c in s), float(max(parts, default=0) <= 255), len(set(digits)), float(last.isspace() or not last), float(last.isalnum()), float(last in "$€#=:" and bool(last)), float(following.isspace() or not following), float(following.isalnum()), float(following in ".,;" and bool(following)), float(any(c in before.lower() for c in CUES[kind])), float(sum(c.isdigit() for c in before) > 3), float(len(re.findall(r"[A-Za-z]{2,}$", s)) > 0),
    ]


@dataclass
class PiiModel:
    trees: list
    slope: float
    offset: float
    thresholds: dict[str, float]  # by kind
    measured: dict[str, tuple[float, float, int]]  # by kind: precision, recall and number of true candidates of the last part

    def probability(self, x: np.ndarray) -> np.ndarray:
        f = sum((tree_values(t, x) for t in self.trees), np.zeros(len(x)))
        return 1 / (1 + np.exp(-np.clip(self.slope * f + self.offset, -30, 30)))

    def spans(self, text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """(base spans, all spans), each by kind as listed and start."""
        base = base_spans(text)
        found = [c for c in candidates(text) if not any(a < c[2] and c[1] < b for _, a, b in base)] if len(base) < 50 else _clear(candidates(text), base)
        if not found:
            return base, base
        p = self.probability(np.array([span_features(text, *c) for c in found], dtype=float))
        taken: list[tuple[str, int, int]] = []
        ends: list[tuple[int, int]] = []
        for i in sorted(range(len(found)), key=lambda i: (-p[i], found[i][1], found[i][0])):
            kind, a, b = found[i]
            if p[i] >= self.thresholds[kind] and _free(ends, a, b):
                taken.append(found[i])
        return base, sorted(base + taken, key=lambda c: (KINDS.index(c[0]), c[1]))


def _clear(found: list, base: list) -> list:
    """Those of the found spans that overlap no base span, by bisection."""
    from bisect import bisect_right

    held = sorted((a, b) for _, a, b in base)
    reach, top = [], 0
    for _, b in held:
        top = max(top, b)
        reach.append(top)
    starts = [a for a, _ in held]
    return [c for c in found if (i := bisect_right(starts, c[2] - 1)) == 0 or reach[i - 1] <= c[1]]


def _free(ends: list[tuple[int, int]], a: int, b: int) -> bool:
    """Whether [a, b) overlaps none of the sorted disjoint spans; if so it is put among them."""
    from bisect import bisect_left

    i = bisect_left(ends, (a, b))
    if (i < len(ends) and ends[i][0] < b) or (i and ends[i - 1][1] > a):
        return False
    ends.insert(i, (a, b))
    return True


def named(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def fit_arrays(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> PiiModel:
    """Trees on the candidates of part 0, calibration and thresholds on those of part 1, precision and recall on those of part 2."""
    never = dict.fromkeys(KINDS, 2.0)
    if len(y) < 60 or any((part == p).sum() < 20 or len(set(y[part == p])) < 2 for p in (0, 1)):
        return PiiModel([], 1.0, 0.0, never, {})  # nothing to learn from: no span is added
    model = PiiModel(boost(x[part == 0], y[part == 0].astype(float)), 1.0, 0.0, never, {})
    f = sum(tree_values(t, x[part == 1]) for t in model.trees)
    model.slope, model.offset = calibrate(f, y[part == 1])
    for k, kind in enumerate(KINDS):
        own = (part == 1) & (x[:, 0] == k)
        p, true = model.probability(x[own]), y[own]
        order = np.argsort(-p, kind="stable")
        precision = np.cumsum(true[order]) / np.arange(1, len(order) + 1)
        ends = np.append(np.flatnonzero(np.diff(p[order])), len(order) - 1) if len(order) else np.empty(0, dtype=int)  # equal probabilities are taken together
        good = ends[precision[ends] >= PRECISION] if len(ends) else ends
        if true.sum() >= LEAST_JUDGED and len(good):
            model.thresholds[kind] = max(0.5, float(p[order[good[-1]]]))
        last = (part == 2) & (x[:, 0] == k)
        taken, wanted = model.probability(x[last]) >= model.thresholds[kind], y[last] == 1
        model.measured[kind] = (float((taken & wanted).sum() / max(1, taken.sum())), float((taken & wanted).sum() / max(1, wanted.sum())), int(wanted.sum()))
    return model


def rewritten(kind: str, value: str, rng: np.random.Generator) -> str:
    """A base span's value in a form that people write and that the base pattern does not take as it is."""
    pick = int(rng.integers(0, 3))
    if kind == "email":
        name, _, host = value.partition("@")
        at = (" [at] ", "(at)", " @ ")[pick]
        return name + at + (host.replace(".", " [dot] ") if pick == 0 else host.replace(".", "(dot)") if pick == 1 else host)
    if kind == "ip":
        return value.replace(".", (" . ", ". ", " .")[pick])
    digits = _digits(value)
    if kind == "card":
        by = (".", " ", ".")[pick]
        return by.join(digits[i : i + 4] for i in range(0, 12, 4)) + by + digits[12:]
    tail = digits[-7:]
    area, country = digits[-10:-7] if len(digits) > 9 else digits[:-7], digits[:-10]
    return (f"00{digits}", f"({area}) {tail[:3]}-{tail[3:]}", f"{country} {area} {tail[:3]} {tail[3:]}".strip())[pick]


def wrong(kind: str, value: str, rng: np.random.Generator) -> str:
    """The same form with something that the kind cannot have: digits that fail Luhn's check, a part over 255, too few digits, a host without a top-level name."""
    if kind == "email":
        return re.sub(r"[A-Za-z-]{2,}$", lambda _: str(int(rng.integers(10, 99))), value)
    if kind == "card":
        at = max(i for i, c in enumerate(value) if c.isdigit())
        return value[:at] + str((int(value[at]) + int(rng.integers(1, 10))) % 10) + value[at + 1 :]
    if kind == "ip":
        return re.sub("[0-9]+", lambda _: str(int(rng.integers(256, 999))), value, count=1)
    groups = list(re.finditer("[0-9]+", value))
    return value[: groups[-1].start()].rstrip(" -") + "-" + str(int(rng.integers(1, 9))) if len(groups) > 1 else "00" + "".join(map(str, rng.integers(0, 10, 18)))


def taught(text: str, seed: str) -> list[tuple[list[float], int]]:
    """Candidates with known origin: (features, 1 for personal data).

    Each base span of the text is rewritten in its place, and its form is put,
    with wrong digits, into its place and into a place of the text drawn by
    chance. Of the candidates that the generators find at such a place, those
    of the kind that cover it are judged by its origin, and those of other
    kinds are false. Candidates that no base span touches are false if their
    digits cannot be the kind's; others are left out, for nothing tells.
    """
    rng = np.random.default_rng(int(hashlib.md5(seed.encode()).hexdigest()[:8], 16))
    base = base_spans(text)
    out: list[tuple[list[float], int]] = []

    def put(a: int, b: int, kind: str, value: str, true: int) -> None:
        low = max(0, a - 80)
        near = text[low:a] + value + text[b : b + 80]
        start, end = a - low, a - low + len(value)
        for k, x, y in candidates(near):
            shared = min(y, end) - max(x, start)
            if shared > 0 and (k != kind or shared >= 0.8 * max(y - x, len(value))):
                out.append((span_features(near, k, x, y), true if k == kind else 0))

    for kind, a, b in base:
        value = text[a:b]
        form = rewritten(kind, value, rng)
        put(a, b, kind, form, 1)
        put(a, b, kind, value if rng.random() < 0.5 else form, 1)
        put(a, b, kind, wrong(kind, form if rng.random() < 0.5 else value, rng), 0)
        words = [m.start() for m in re.finditer(r"(?<=\s)\S", text[max(0, a - 2000) : b + 2000])]
        if words:
            at = max(0, a - 2000) + words[int(rng.integers(0, len(words)))]
            put(at, at, kind, wrong(kind, form, rng) + " ", 0)
    for kind, a, b in _clear(candidates(text), base):
        if not _possible(kind, text[a:b]):
            out.append((span_features(text, kind, a, b), 0))
    return out


def _possible(kind: str, value: str) -> bool:
    """Whether the digits, or the host's last name, may be the kind's at all."""
    digits = _digits(value)
    if kind == "email":
        return bool(re.search(r"[A-Za-z]{2,}$", value))
    if kind == "ip":
        return all(int(x[-4:]) <= 255 for x in re.findall("[0-9]+", value))
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def fit(docs: DataFrame, rows: int = SAMPLE_DOCS, spans: int = SAMPLE_SPANS, id_column: str = "doc_id", text_column: str = "text") -> PiiModel:
    """Fitted on at most `spans` candidates of about `rows` documents, taken by hash.

    No labels are given: see taught(). A document's candidates are all in one of
    five parts of a hash of its text, of which three are for fitting, one for
    the thresholds and one for precision and recall.
    """
    session()
    own = docs.select(F.col(id_column).cast("string").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    every = max(1, docs.count() // rows)
    picked = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("doc_id", "text", F.greatest(F.pmod(F.xxhash64("text", F.lit(5)), F.lit(5)) - 2, F.lit(0)).cast("int").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(f"{i}:{j}", *f, p) for i, text, p in zip(*(c.to_pylist() for c in batch.columns)) if text for j, f in enumerate(taught(text, i or ""))]
            made = list(zip(*found)) if found else [()] * 4
            yield pa.record_batch([pa.array(c, type=t) for c, t in zip(made, (pa.string(), pa.list_(pa.float64()), pa.int32(), pa.int32()))], names=["id", "x", "y", "part"])

    got = picked.mapInArrow(run, "id string, x array<double>, y int, part int").orderBy(F.xxhash64("id"), "id", "x").limit(spans).collect()
    return fit_arrays(np.array([r.x for r in got], dtype=float), np.array([r.y for r in got]), np.array([r.part for r in got]))


def find_spans(docs: DataFrame, model: PiiModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: (doc_id, base, spans), arrays of (kind, start, end) by kind as listed and start.

    A null text is empty and has none; ids may be null or repeated; repeated
    rows have equal spans; other columns are dropped; an empty table gives an
    empty result. Of added spans that overlap, the likelier one stays, then the
    one that begins first.
    """
    shared = share(session_of(docs), model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names = ("kind", "start", "end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened(shared)
        for batch in batches:
            found = [own.spans(x or "") for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), *(pa.array([[dict(zip(names, s)) for s in f[j]] for f in found], type=kind) for j in (0, 1))], names=["doc_id", "base", "spans"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, base array<struct<kind:string,start:long,end:long>>, spans array<struct<kind:string,start:long,end:long>>")


def session_of(_: DataFrame):
    return session()


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span replaced by its kind in brackets; overlapping spans as one, by the kind of the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < at:
            if b > at:
                at = b
            continue
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: PiiModel, text_column: str = "text") -> DataFrame:
    """docs with every span replaced by its kind.

    Null texts stay null, empty ones empty; other columns, rows without ids and
    repeated rows are as they are; an empty table stays empty.
    """
    shared = share(session_of(docs), model)
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = opened(shared)
        for batch in batches:
            texts = [None if x is None else redacted(x, own.spans(x)[1]) for x in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, type=pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def digests(spans: DataFrame) -> DataFrame:
    """find_spans() -> counts of base spans by kind, the base's SHA-256 and all spans as text."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return spans.select("doc_id", *counts, F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
