"""What the operators share: settled tables, Arrow columns, word hashes."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in an Arrow batch: some long texts must fit in a Python worker together.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
#: The bytes of the class [\x20\x09-\x0D], which part words.
SPACES = b" \t\n\v\f\r"
#: Bytes of texts whose words are hashed at once, about.
HASHED_AT_ONCE = 1 << 20


def session() -> SparkSession:
    """The running session, with Arrow batches bounded by rows and bytes; limits that someone has set stay.

    The setting holds for the whole session, since plans run after they are made.
    """
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    for name, value in BATCHES.items():
        if not spark.conf._jconf.contains(name):
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary one only in local mode, where every executor sees it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            folder = known.get()
        elif not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            folder = tempfile.mkdtemp(prefix="quillmill-")
            spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def settle(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here."""
    spark = session()
    path = f"{shared_folder(spark)}/settled/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    atexit.register(remove, spark, path)
    return spark.read.schema(schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system; one that is gone, or whose session has ended, is let be."""
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may have ended: the folder's owner cleans up
        pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_rest(id_column: str, by: int) -> F.Column:
    """crc32 of the id as text, modulo by."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % F.lit(by)


def raw_texts(column: pa.Array) -> list[bytes]:
    """The texts' UTF-8 bytes; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    x = 1
    for i in range(n):
        out[i] = x
        x = x * base & 0xFFFFFFFFFFFFFFFF
    return out


#: A word's hash is a polynomial in its bytes: powers for 4,096 places, and the next ones are these times a power of the last.
_POWERS = _powers(0x9E3779B97F4A7C15, 4096)
_FAR = pow(0x9E3779B97F4A7C15, 4096, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(separators: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(separators, dtype=np.uint8)] = True
    return out


def hashed_words(texts: list[bytes], separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lowered, and each text's first word (n + 1 offsets).

    Texts are hashed in blocks of about a megabyte that end where a word does:
    a byte takes some forty in between.
    """
    joined = b" ".join(texts)
    lengths = np.fromiter((len(x) + 1 for x in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    words, starts, at = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)], 0
    while at < len(joined):
        end = _block_end(joined, at, separator)
        hashes, first = _block_words(np.frombuffer(joined, dtype=np.uint8, count=end - at, offset=at), separator)
        words.append(hashes)
        starts.append(first + at)
        at = end
    if not joined:
        return words[0], np.zeros(len(texts) + 1, dtype=np.int64)
    return np.concatenate(words), np.searchsorted(np.concatenate(starts), bounds)


def _block_end(joined: bytes, at: int, separator: np.ndarray) -> int:
    """The first separator a block or more after `at`, or the end."""
    end = at + HASHED_AT_ONCE
    while end < len(joined):
        found = np.flatnonzero(separator[np.frombuffer(joined, dtype=np.uint8, count=min(4096, len(joined) - end), offset=end)])
        if len(found):
            return end + int(found[0])
        end += 4096
    return len(joined)


def _block_words(raw: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block's words and where they start."""
    data = _LOWER[raw]
    part = separator[data]
    inside = ~part
    first = inside.copy()
    first[1:] &= part[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), starts
    spans = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, spans)
    values = np.where(inside[starts[0] :], data[starts[0] :].astype(np.uint64) + np.uint64(1), np.uint64(0))
    values *= _POWERS[place & 4095]
    if spans.max() > 4096:
        values *= _powers(_FAR, int(spans.max()) // 4096 + 1)[place >> 12]
    return mix(np.add.reduceat(values, starts - starts[0])), starts


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles that start at each word; shorter at the end."""
    n = max(0, len(words) - k + 1)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h = h * np.uint64(0x9FB21C651E98DF25) + words[j : j + n]
    return mix(h)


def in_blocks(rows: DataFrame, key: str, member: str, size: int, salt: int) -> DataFrame:
    """rows whose key (long), if over `size` rows have it, is one of its blocks' instead, dealt by a hash of the member and the salt."""
    parted, n = _with_blocks(rows, key, size)
    block = F.pmod(F.xxhash64(member, F.lit(salt)), n)
    return parted.withColumn(key, F.when(n.isNull(), F.col(key)).otherwise(F.xxhash64(key, block, F.lit(salt)))).drop("_blocks")


def in_block_pairs(rows: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """rows whose key, if over `size` rows have it, is that of a pair of its blocks instead: a row for each pair that has its block.

    Any two rows of a key still meet under one key, and no key has much more
    than twice `size` rows.
    """
    parted, n = _with_blocks(rows, key, size)
    own = F.pmod(F.xxhash64(member), n)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda j: F.xxhash64(F.col(key), F.least(own, j), F.greatest(own, j)))
    made = parted.withColumn("_key", F.explode(F.when(n.isNull(), F.array(F.col(key))).otherwise(pairs)))
    return made.withColumn(key, F.col("_key")).drop("_key", "_blocks")


def _with_blocks(rows: DataFrame, key: str, size: int) -> tuple[DataFrame, F.Column]:
    large = rows.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > size).select(key, F.ceil(F.col("_n") / size).cast("long").alias("_blocks"))
    return rows.join(large, key, "left"), F.col("_blocks")


class Groups:
    """Union-find over ids; the smallest id of a group is its root."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = x
        while up.setdefault(top, top) != top:
            top = up[top]
        while up[x] != top:
            up[x], x = top, up[x]
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def links(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in list(self.up) if self.root(x) != x]


def share(spark: SparkSession, value: object):
    """Broadcast a bounded object together with its classes, for opened()."""
    from pyspark import cloudpickle

    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(shared):
    import pickle

    return pickle.loads(shared.value)
