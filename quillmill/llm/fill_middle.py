"""Fill-in-middle over an index of distinct texts.

Rows with the same text (SHA-256 and length in bytes agree) are one entry of
the index. An entry's boundary list says where each code point begins in the
UTF-8 bytes; it is a rising sequence, kept in Elias-Fano form and made once an
entry. An entry holds its documents' ids, so joining them back moves no text a
second time; each one's seeded cut is two selections from the list: bytes are
sliced, not counted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm.support import raw_texts, session

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 texts so many are cut, and of 100 cut ones so many have the suffix first.
RATE, SUFFIX_FIRST = 90, 20
#: Rows of one text that share an entry: a text with more has an entry for each such part of its rows.
SHARED = 256
#: The texts that may have more than one entry are at most so many; with their digests they are broadcast.
MOST_PARTED = 100_000
_SAMPLED = 1024
#: A one is at most so many bits after the one before it: a code point has four bytes at most.
_WIDEST = 5


class EliasFano:
    """A rising sequence: low bits packed, high bits in unary, the place of every 1024th one remembered."""

    def __init__(self, n: int, low: int, lower: np.ndarray, upper: np.ndarray, places: np.ndarray) -> None:
        self.n, self.low, self.lower, self.upper, self.places = n, low, lower, upper, places

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, most = len(values), int(values[-1])
        low = max(0, (most // n).bit_length() - 1)
        ones = (values >> low) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, dtype=np.uint8)
        bits[ones] = 1
        lower = np.packbits((values[:, None] >> np.arange(low)) & 1 == 1) if low else np.empty(0, dtype=np.uint8)
        return cls(n, low, lower, np.packbits(bits), ones[::_SAMPLED])

    def select(self, k: int) -> int:
        """The k-th value, from 0."""
        start, rest = int(self.places[k // _SAMPLED]), k % _SAMPLED
        first = start // 8
        window = np.unpackbits(self.upper[first : first + (_WIDEST * _SAMPLED) // 8 + 2])
        window[: start % 8] = 0
        one = first * 8 + int(np.flatnonzero(window)[rest])
        high = one - k
        if not self.low:
            return high
        at = k * self.low
        bits = np.unpackbits(self.lower[at // 8 : (at + self.low) // 8 + 1])[at % 8 : at % 8 + self.low]
        return (high << self.low) | int((bits.astype(np.int64) << np.arange(self.low)).sum())

    def pack(self) -> bytes:
        head = np.array([self.n, self.low, len(self.lower), len(self.places)], dtype=np.int64)
        return head.tobytes() + self.places.astype(np.int64).tobytes() + self.lower.tobytes() + self.upper.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> EliasFano:
        n, low, lower, places = (int(x) for x in np.frombuffer(data, dtype=np.int64, count=4))
        at = 32 + 8 * places
        return cls(n, low, np.frombuffer(data, dtype=np.uint8, count=lower, offset=at), np.frombuffer(data, dtype=np.uint8, offset=at + lower), np.frombuffer(data, dtype=np.int64, count=places, offset=32))


def boundaries(raw: bytes) -> EliasFano:
    """Where the code points begin in UTF-8 bytes, and last where they end."""
    data = np.frombuffer(raw, dtype=np.uint8)
    return EliasFano.of(np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data)))


def _seeds(doc_id: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of the hex SHA-256 of `1:` and the decimal id; a null id is empty there."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def text_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(digest, bytes, part, text, members, n, boundaries): an entry for each distinct text, with the ids of its documents.

    A text of more rows than a hundred-thousandth of all (256 at least) has an
    entry for each such part of them, dealt by id, so that no task gets a large
    group and no list of members is long; copies meet before they are moved. Equal
    rows, and rows of one text without ids, stay in one part. An empty table
    gives an empty one.
    """
    session()
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.octet_length("text").alias("bytes"))
    share = max(SHARED, docs.count() // MOST_PARTED)
    large = rows.groupBy("digest", "bytes").agg(F.count("*").alias("_rows")).where(F.col("_rows") > share)
    parts = large.select("digest", "bytes", F.ceil(F.col("_rows") / share).cast("int").alias("_parts"))
    keyed = rows.join(F.broadcast(parts), ["digest", "bytes"], "left")
    keyed = keyed.withColumn("part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_parts")).cast("int"), F.lit(0)))
    entries = keyed.groupBy("digest", "bytes", "part").agg(F.first("text").alias("text"), F.collect_list(F.struct("doc_id")).alias("members"))

    @F.arrow_udf("binary")
    def listed(texts: pa.Array) -> pa.Array:
        return pa.array([boundaries(x).pack() for x in raw_texts(texts)], type=pa.binary())

    return entries.withColumns({"n": F.length("text").cast("long"), "boundaries": listed("text")})


def transform(docs: DataFrame, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    n counts code points. Form is plain (the text as it is; no cut) for an empty
    text, one that holds a marker, and 100 - rate of 100 others; of the cut ones
    suffix_first of 100 are spm, the rest psm. A null text is empty; a null id
    seeds like an empty one; repeated rows repeat; an empty table gives an
    empty one; extra columns are dropped.
    """
    index = text_index(docs, id_column, text_column)
    h1, h2, h3, h4 = (F.col(f"_h{i}") for i in range(1, 5))
    rows = index.select(F.inline("members"), "text", "n", "boundaries").withColumns({f"_h{i + 1}": h for i, h in enumerate(_seeds(F.col("doc_id")))})
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.col("text").contains(marker)
    plain = (F.col("n") == 0) | marked | (h3 % 100 >= rate)
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    one, two = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    cut = rows.select("doc_id", "n", form.alias("form"), F.least(one, two).alias("_from"), F.greatest(one, two).alias("_to"), "text", "boundaries")

    @F.arrow_udf("string")
    def arranged(texts: pa.Array, lists: pa.Array, forms: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
        out = []
        for raw, packed, form, a, b in zip(raw_texts(texts), lists, forms.to_pylist(), starts.to_pylist(), ends.to_pylist()):
            if form != "plain":
                bounds = EliasFano.unpack(packed.as_buffer())
                a, b = bounds.select(a), bounds.select(b)
                prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
                p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
                raw = p + prefix + s + suffix + m + middle if form == "psm" else s + suffix + p + prefix + m + middle
            out.append(raw)
        return pa.array(out, type=pa.binary()).cast(pa.string())

    made = cut.withColumn("output", arranged("text", "boundaries", "form", "_from", "_to"))
    chars = lambda c: F.when(F.col("form") != "plain", c)
    return made.select("doc_id", "n", "form", chars(F.col("_from")).alias("prefix_chars"), chars(F.col("_to") - F.col("_from")).alias("middle_chars"), "output")


def restored(output: str | Column = "output", form: str | Column = "form") -> Column:
    """The text that an output was made from, by its markers and its form alone."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    second = F.when(form == "psm", SUFFIX).otherwise(PREFIX)
    a, b = F.position(second, output, F.lit(4)), F.position(F.lit(MIDDLE), output, F.lit(4))
    first, after, middle = F.substring(output, F.lit(4), a - 4), F.substring(output, a + 3, b - a - 3), F.substring(output, b + 3, F.length(output))
    return F.when(form == "plain", output).when(form == "psm", F.concat(first, middle, after)).otherwise(F.concat(after, middle, first))


def digests(made: DataFrame) -> DataFrame:
    """Outputs and the texts restored from them as SHA-256."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored()).alias("restored_sha256"))
