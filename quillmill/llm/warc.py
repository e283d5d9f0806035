"""WARC archives compressed record by record with a Zstandard dictionary.

An archive begins with a skippable frame that holds a dictionary built from
its own records; each record is a frame of its own. Archives are rows with a
binary column, so Spark's writers put them wherever the cluster keeps tables.
"""

from __future__ import annotations

import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm.support import session, settle

#: Fixed values of the format: the dictionary frame's magic number, the profile of identical payloads.
DICTIONARY_MAGIC = 0x184D2A5D
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:quillmill:page:"
#: Bytes of records in an archive, of its dictionary, and of the records it is built from.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES = 16 << 20, 64 << 10, 1 << 20
#: Bytes of a record that are one sample.
PIECE_BYTES = 4 << 10


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    """A response, or a revisit of another record with the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{RECORD_ID}{page_id}>", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if url:
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {IDENTICAL}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from pieces of the records, spread over the whole archive.

    Where the pieces are too few or too alike to train on, they are the
    dictionary themselves, as raw content; no records give b"".
    """
    every = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    places = ((r, at) for r in records for at in range(0, len(r), PIECE_BYTES))
    pieces = [r[at : at + PIECE_BYTES] for i, (r, at) in enumerate(places) if i % every == 0]
    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, pieces)) // 16))
    if len(pieces) >= 16:
        try:
            return zstandard.train_dictionary(size, pieces, k=256, d=8).as_bytes()
        except zstandard.ZstdError:  # pieces too small or too alike for the trainer
            pass
    return b"".join(pieces)[:DICTIONARY_BYTES]


def archive(records: list[bytes], level: int = 3) -> bytes:
    plain = build_dictionary(records)
    known = zstandard.ZstdCompressionDict(plain) if plain else None
    packer = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True, write_checksum=True)
    stored = zstandard.ZstdCompressor(level=level).compress(plain) if plain else b""
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(stored)), stored, *map(packer.compress, records)])


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of an archive, one in memory at a time."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame leads this archive")
    known = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])) if size else None
    stream = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=known).stream_reader(io.BytesIO(memoryview(data)[8 + size :]), read_across_frames=True), 1 << 17)
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError("a record was expected")
        header = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            header[name.lower()] = value.strip()
        block = stream.read(int(header["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record ends early")
        yield header, block


def write_archives(pages: DataFrame, min_revisit: int = 1000, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """pages (page_id, url, html) -> (archive binary): every row as a record.

    Of equal payloads of at least `min_revisit` bytes, the one with the largest
    page_id is a response and the others revisit it; repeated rows with that id
    are all responses, and so are rows without an id. Null html is an empty
    payload, a null url leaves its header out. Equality is by SHA-1 and length.
    Other columns are dropped; an empty table gives no archive.
    """
    session()
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html").cast("long")})
    kept = rows.where(F.col("size") >= min_revisit).groupBy("digest", "size").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    kept = settle(kept)  # its size is known when the join is planned: while Spark's broadcast limit holds it, no page is moved
    marked = rows.join(kept, ["digest", "size"], "left").select("page_id", "url", "html", "digest", "size", F.when(F.col("page_id") != F.col("kept"), F.col("kept")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for page_id, url, payload, digest, n, refers_to in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()), *batch.columns[3:]))):
                held.append(record(page_id, url, payload, digest, n, refers_to, date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield pa.record_batch([pa.array([archive(held)], type=pa.binary())], names=["archive"])
                    held, size = [], 0
        if held:
            yield pa.record_batch([pa.array([archive(held)], type=pa.binary())], names=["archive"])

    return marked.mapInArrow(run, "archive binary")


def read_archives(archives: DataFrame) -> DataFrame:
    """(archive binary) -> (page_id, url, record_type, payload, payload_bytes, payload_digest, refers_to).

    A response's length and digest are those of the payload read; a revisit's
    come from its headers, and its payload is null. Archives that are null or
    empty hold nothing; repeated ones are read each; other columns are dropped;
    an empty table gives an empty result.
    """
    session()
    names = ["page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"]
    types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]

    def number(value: str | None) -> int | None:
        tail = (value or "").removeprefix(f"<{RECORD_ID}").removesuffix(">")
        return int(tail) if tail.lstrip("-").isdigit() else None

    def parsed(data: bytes) -> Iterator[tuple]:
        for header, block in read_records(data):
            head, _, payload = block.partition(b"\r\n\r\n")
            full = header["warc-type"] == "response"
            length = len(payload) if full else int(head.rpartition(b"Content-Length: ")[2])
            sha = hashlib.sha1(payload).hexdigest() if full else header["warc-payload-digest"].removeprefix("sha1:")
            if full and sha != header["warc-payload-digest"].removeprefix("sha1:"):
                raise ValueError("a payload differs from its digest")
            yield number(header["warc-record-id"]), header.get("warc-target-uri"), header["warc-type"], payload if full else None, length, sha, number(header.get("warc-refers-to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows: list[tuple] = []
                archive = data.as_py()
                for row in parsed(archive) if archive else ():
                    rows.append(row)
                    if len(rows) == 500:
                        yield pa.record_batch([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)

    return archives.mapInArrow(run, "page_id long, url string, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def export_archives(archives: DataFrame, folder: str) -> int:
    """Write each archive row as <folder>/part-<n>.warc.zst through Hadoop's file systems; returns their number.

    Rows pass the driver one at a time.
    """
    spark = session()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    for row in archives.toLocalIterator():
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/part-{n:05d}.warc.zst")
        out = path.getFileSystem(conf).create(path, True)
        try:
            out.write(bytearray(row.archive))
        finally:
            out.close()
        n += 1
    return n


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives, then read them back, without the payloads themselves."""
    return read_archives(settle(write_archives(pages))).drop("payload")
