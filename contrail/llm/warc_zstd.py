"""Operator 3: WARC archives compressed with a dictionary.

An archive begins with a skippable Zstandard frame that holds a dictionary
built from archived records; each record follows as a frame of its own,
compressed with it, so that any record can be read alone.

The dictionary is trained once on the ``sample`` records with the smallest
hashes among those of at most ``sample_bytes`` payload bytes (a bounded,
documented sample of the training; every record is archived whole).  Payload
digests are grouped with partial aggregation to the smallest page id; the pages
then meet that id by digest in a plain join, which Spark splits where one
payload is very frequent.  A task streams its records into one file; the
manifest, written by Spark's committer, names the files of the attempts that
count.

Defined results: a null html is an empty payload; of records with equal
payloads of at least ``min_bytes`` bytes the smallest page id is the response
(each row that carries it, if rows repeat) and the others revisit it; a null
page id is never the smallest unless all are null, when all are responses; a
null url is left out of the record and null again when read; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import open_store, settled, work_folder

# Fixed values of the formats
SKIPPABLE = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

MIN_BYTES = 0
DICTIONARY_BYTES = 64 * 1024
SAMPLE = 256
SAMPLE_BYTES = 32 * 1024
LEVEL = 3
READ_BYTES = 64 * 1024


def record_uri(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None,
           revisit: bool = False) -> bytes:
    """One WARC record; a revisit keeps the HTTP head but not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
            .encode())
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {record_uri(page_id, digest)}", f"WARC-Date: {DATE}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
            f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_uri(refers_to, digest)}",
                 f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(url: str) -> str:
    """Control characters percent-encoded: a header is one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def parse(data: bytes) -> dict:
    """Headers and payload of a record; the payload of a revisit is None."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"no WARC record: {first[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    n = int(fields["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != b"\r\n\r\n":
        raise ValueError("record cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    http_fields = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and b32_sha1(payload) != digest:
        raise ValueError("payload doesn't match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"),
            "payload": payload if kind == "response" else None, "payload_bytes": int(http_fields["Content-Length"]),
            "payload_digest": digest, "record_type": kind, "refers_to": number("X-Refers-To-Page-ID")}


def b32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the records; their own bytes where they are too few to train."""
    if not records:
        return b""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


class Writer:
    """Frames of one archive."""

    def __init__(self, out, dictionary: bytes, level: int = LEVEL):
        self.out, self.bytes = out, 0
        d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compress = zstandard.ZstdCompressor(level=level, dict_data=d).compress
        if dictionary:
            self._put(struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, rec: bytes) -> None:
        self._put(self.compress(rec))


def read_records(src, read_bytes: int = READ_BYTES) -> Iterator[bytes]:
    """The records of an archive, one frame in memory at a time."""
    held = src.read(8)
    if not held:
        return
    dictionary = None
    magic, size = struct.unpack("<II", held) if len(held) == 8 else (0, 0)
    if magic == SKIPPABLE:
        dictionary, held = zstandard.ZstdCompressionDict(src.read(size)), b""
    d = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    frame, parts, begun = d.decompressobj(), [], False
    while held or (held := src.read(read_bytes)):
        parts.append(frame.decompress(held))
        held, begun = b"", True
        if frame.eof:
            yield b"".join(parts)
            held = frame.unused_data
            frame, parts, begun = d.decompressobj(), [], False
    if begun:
        raise ValueError("archive cut short")


# -- Spark ----------------------------------------------------------------

def prepared(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, html, refers_to, is_response) of every page."""
    body = F.coalesce(pages["html"], F.lit(""))
    p = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), body.alias("html"))
    p = p.withColumn("sha1", F.sha1(F.col("html").cast("binary")))
    firsts = p.groupBy("sha1").agg(F.min("page_id").alias("first"))
    small = F.octet_length("html") < F.lit(min_bytes)
    return (p.join(firsts, "sha1")
            .select("page_id", "url", "html", "first",
                    (small | F.col("page_id").eqNullSafe(F.col("first"))).alias("is_response")))


def dictionary_of(pages: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES,
                  size: int = DICTIONARY_BYTES) -> bytes:
    """Trained on at most sample * sample_bytes bytes, which the driver gathers."""
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"),
                        F.coalesce(pages["html"], F.lit("")).alias("html"))
    rows = rows.where(F.octet_length("html") <= sample_bytes).withColumn("draw", F.xxhash64("page_id", "url"))
    # drawn by hashes alone, so that a task hands on numbers and only the drawn pages travel
    drawn = rows.select("draw").distinct().orderBy("draw").limit(sample)
    some = (rows.join(F.broadcast(drawn), "draw").groupBy("draw")
            .agg(F.min(F.struct("page_id", "url", "html")).alias("p")).select("p.*").orderBy("page_id", "url").collect())
    return train_dictionary([record(r.page_id, r.url, r.html.encode(), b32_sha1(r.html.encode())) for r in some], size)


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, level: int = LEVEL,
                   **dictionary_options) -> DataFrame:
    """Write the archives; the manifest (name, bytes, records) of their files."""
    dictionary = pages.sparkSession.sparkContext.broadcast(dictionary_of(pages, **dictionary_options))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        todo = (r for b in batches for i in range(0, b.num_rows, 256) for r in b.slice(i, 256).to_pylist())
        first = next(todo, None)
        if first is None:
            return
        fs, path = open_store(folder)
        fs.create_dir(path, recursive=True)
        name, n = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst", 0
        with fs.open_output_stream(f"{path}/{name}") as out:
            w = Writer(out, dictionary.value, level)
            for r in (x for some in ([first], todo) for x in some):
                payload = r["html"].encode()
                w.add(record(r["page_id"], r["url"], payload, b32_sha1(payload), r["first"], not r["is_response"]))
                n += 1
        yield pa.record_batch([pa.array([name]), pa.array([w.bytes], pa.int64()), pa.array([n], pa.int64())],
                              ["name", "bytes", "records"])

    return settled(prepared(pages, min_bytes).mapInArrow(rows, "name string, bytes long, records long"),
                   folder, "manifest")


FIELDS = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(),
          "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
_SPARK = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}


def read_archives(manifest: DataFrame, folder: str, columns: tuple[str, ...] = tuple(FIELDS)) -> DataFrame:
    """The records of the listed archives: any of ``FIELDS``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held, size = [], 0
                with fs.open_input_stream(f"{path}/{name}") as src:
                    for data in read_records(src):
                        held.append(parse(data))
                        size += len(data)
                        if len(held) >= 512 or size > 4 << 20:
                            yield batch_of(held)
                            held, size = [], 0
                if held:
                    yield batch_of(held)

    def batch_of(recs: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[c] for r in recs], FIELDS[c]) for c in columns], list(columns))

    files = max(1, manifest.count())
    return (manifest.select("name").repartition(files)
            .mapInArrow(rows, ", ".join(f"{c} {_SPARK[FIELDS[c]]}" for c in columns)))


def write_and_read(pages: DataFrame, **options) -> DataFrame:
    folder = work_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **options), folder,
                         ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
