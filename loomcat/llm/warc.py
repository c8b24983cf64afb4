"""A deterministic sharded WARC writer, and a reader.

Rows are range-sorted by id and digest, so that a payload moves once. Which row of equal payloads is the
response (that with the least id) is found over digests alone; the others come to the
writer as markers that sort in front of their rows. Each task writes gzip members, one for each record,
with regenerated headers and digests, and rolls files by compressed size.

Commit: every attempt of a task writes files with names of its own; the rows of the attempts that
Spark accepts name them. The driver then renames these to their final names and, last, writes the manifest
under a temporary name and renames it. A repeated or speculative attempt can't touch a committed file; a commit that
broke off is finished by calling `commit` again. Only files that the manifest names count.

Defined results: a null payload is an empty one. Null ids are the last among equal payloads; if
all ids are null, each is a response. Of repeated rows with the response's id and payload one
is the response and the others revisit it. Null urls leave their header out; white space
and control characters in urls are percent-encoded. Rows without an id, which may be many, are dealt over SALTS
ranges; all rows of one id and payload are written by one task, a record at a time. Columns other than id, url and payload aren't looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from loomcat.llm.common import SALTS, mapped, new_path, spread_join, written

ROLL_BYTES = 256 << 20
ATTEMPTS, NAMES = "attempts", "manifest.json"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILES = "attempt string, file string, records long, bytes long, sha256 string, first_id long, last_id long"
MANIFEST = "file string, records long, bytes long, sha256 string, first_id long, last_id long"
RECORDS = "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record_id(page: int | None, digest: bytes, number: int | str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page} {digest.hex()} {number}'.encode()).digest()[:16], version=5)}>"


def record(page: int | None, url: str | None, payload: bytes, digest: bytes, number: int | str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One record; a revisit keeps the HTTP headers, with the payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page, digest, number)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~-._' + chr(39))}")
    if page is not None:
        lines.append(f"X-Page-ID: {page}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to, digest, 0)}", f"X-Refers-To-Page-ID: {refers_to}"]
    lines += [f"WARC-Payload-Digest: sha1:{_base32(digest)}", f"WARC-Block-Digest: sha1:{_base32(hashlib.sha1(block).digest())}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class _Files:
    """Rolls files by compressed size, under names that no other attempt uses."""

    def __init__(self, folder: str, shard: int, roll: int):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.attempt, self.shard, self.roll, self.part, self.out, self.done = uuid.uuid4().hex, shard, roll, 0, None, []

    def add(self, page: int | None, data: bytes) -> None:
        if self.out is None:
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{ATTEMPTS}/{self.name}.{self.attempt}.tmp"
            self.out, self.hash, self.size, self.count, self.first = self.store.open_output_stream(f"{self.folder}/{self.temporary}", compression=None), hashlib.sha256(), 0, 0, page
        member = gzip.compress(data, 6, mtime=0)
        self.out.write(member)
        self.hash.update(member)
        self.size, self.count, self.last = self.size + len(member), self.count + 1, page
        if self.size >= self.roll:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        self.done.append((self.temporary, self.name, self.count, self.size, self.hash.hexdigest(), self.first, self.last))
        self.out, self.part = None, self.part + 1


def _writer(folder: str, roll: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files = _Files(folder, TaskContext.get().partitionId(), roll)
        here, refers, number = object(), None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                page, salt, digest, tag, other, url, payload = (batch.column(k)[i].as_py() for k in range(7))
                if (page, salt, digest) != here:
                    here, refers, number = (page, salt, digest), None, 0
                if tag == 0:
                    refers = other
                    continue
                target = refers if refers is not None else page if number and page is not None else None
                files.add(page, record(page, url, (payload or "").encode(), digest, number if page is not None else f"{salt}-{number}", target, target is not None))
                number += 1
        files.close()
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in files.done], t) for k, t in enumerate(kinds)], [x.split()[0] for x in FILES.split(", ")])

    return run


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", roll_bytes: int = ROLL_BYTES) -> None:
    """Writes an archive of all rows in a folder that all executors reach."""
    store, at = fs.FileSystem.from_uri(folder)
    store.create_dir(f"{at}/{ATTEMPTS}")
    payload, some = F.coalesce(F.col(payload_col).cast("string"), F.lit("")), F.col(id_col).isNotNull()
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.when(some, 0).otherwise(F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).cast("int").alias("salt"), F.unhex(F.sha1(payload.cast("binary"))).alias("digest"),
        F.lit(1).alias("tag"), F.lit(None).cast("long").alias("refers_to"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"),
    )
    digests = pages.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.sha1(payload.cast("binary"))).alias("digest"))
    first = digests.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 and refers_to is not null").select("digest", "refers_to")
    marks = spread_join(written(digests.distinct(), "digests"), written(first, "responses"), "digest").filter("id is null or id > refers_to")
    salts = F.when(F.col("id").isNotNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    marks = marks.select("id", F.explode(salts).alias("salt"), "digest", F.lit(0).alias("tag"), "refers_to", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("payload"))
    both = rows.unionByName(marks).repartitionByRange("id", "salt", "digest").sortWithinPartitions("id", "salt", "digest", "tag", "url")
    files = written(mapped(both, _writer(folder, roll_bytes), FILES), "files")
    commit(files, folder)


def commit(files: DataFrame, folder: str) -> None:
    """Renames the files that FILES name and writes the manifest. What an earlier call has done is passed over. The driver holds a line for each file."""
    store, at = fs.FileSystem.from_uri(folder)
    exists = lambda path: store.get_file_info(path).type != fs.FileType.NotFound

    def renamed(r: Row) -> str:
        if exists(f"{at}/{r.attempt}"):
            store.move(f"{at}/{r.attempt}", f"{at}/{r.file}")
        elif not exists(f"{at}/{r.file}"):
            raise FileNotFoundError(r.file)
        return json.dumps({k: v for k, v in r.asDict().items() if k != "attempt"})

    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(renamed, files.orderBy("file").toLocalIterator()))
    temporary = f"{at}/manifest-{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temporary, compression=None) as out:
        out.write("".join(f"{x}\n" for x in lines).encode())
    store.move(temporary, f"{at}/{NAMES}")
    store.delete_dir(f"{at}/{ATTEMPTS}")  # of attempts that were not accepted


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an unpacked archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            fields[name] = value
        block = stream.read(int(fields["Content-Length"]))
        if len(block) != int(fields["Content-Length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        yield fields, block


def read_record(fields: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(next(x for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    if _base32(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"].removeprefix("sha1:"):
        raise ValueError("a block doesn't fit its digest")
    if fields["WARC-Type"] == "response" and (len(payload) != length or _base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError("a payload doesn't fit its digest")
    number = lambda x: int(fields[x]) if x in fields else None
    return number("X-Page-ID"), fields.get("WARC-Target-URI"), length, digest, fields["WARC-Type"], number("X-Refers-To-Page-ID")


def _reader(folder: str) -> Callable:
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = fs.FileSystem.from_uri(folder)
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], [x.split()[0] for x in RECORDS.split(", ")])
        for b in batches:
            for name in b.column(0).to_pylist():
                rows = []
                with store.open_input_stream(f"{at}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for fields, block in records(stream):
                        rows.append(read_record(fields, block))
                        if len(rows) == 2000:
                            yield batch(rows)
                            rows = []
                yield batch(rows)

    return run


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of an archive: RECORDS. Files that the manifest doesn't name are left alone."""
    files = spark.read.schema(MANIFEST).json(f"{folder}/{NAMES}").select("file")
    return mapped(files.repartition(max(1, files.count()), "file"), _reader(folder), RECORDS)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", roll_bytes: int = ROLL_BYTES) -> DataFrame:
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    write(pages, folder, id_col, url_col, payload_col, roll_bytes)
    return read(spark, folder)
