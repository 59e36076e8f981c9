"""WARC archives: whole-file gzip in, one gzip member for each record and an offset index out.

Archives compressed as a single gzip stream can only be read from the start. The normaliser inflates
such a stream once, never holding more than one record, and writes each record as a gzip member of
its own. The sidecar index, a Parquet file, has offset and length of each member, so any record can
be read alone. While a record passes by, one with the payload of an earlier capture is written as a
revisit without the payload.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from textmill.llm.arrow import slices
from textmill.llm.shared import attempt_name, open_folder, reading
from textmill.sources.staging import fresh_folder, stage

GZIP = 16 + zlib.MAX_WBITS
CHUNK = 1 << 18
LEVEL = 4
# The date of every record, as captures carry none; a fixed value keeps reruns equal.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _block(headers: list[tuple[str, str]], body: bytes, first: str = "WARC/1.1") -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in headers), "", ""]).encode() + body


def record(key: str, url: str, payload: bytes, digest: str, refers_to: str | None = None, size: int | None = None) -> bytes:
    """One WARC record: a response, or with ``refers_to`` a revisit whose HTTP headers give the payload's size.

    ``key`` names the capture in its record id, ``refers_to`` that of the response.
    """
    size = len(payload) if size is None else size
    http = _block([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))], b"", "HTTP/1.1 200 OK")
    body = http + payload
    headers = [("WARC-Type", "revisit" if refers_to is not None else "response"), ("WARC-Record-ID", f"<urn:textmill:{key}>")]
    headers += [("WARC-Date", DATE), ("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]"))]
    headers += [("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:textmill:{refers_to}>")]
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return _block(headers, body) + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers and HTTP headers, names in lower case, and payload of a whole record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(_header(line) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(headers["content-length"])].partition(b"\r\n\r\n")
    return headers, dict(_header(line) for line in http.decode().split("\r\n")[1:]), payload


def _header(line: str) -> tuple[str, str]:
    name, _, value = line.partition(":")
    return name.strip().lower(), value.strip()


def records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an inflated stream, each with the blank lines that end it."""
    waiting = bytearray()
    need = None
    for piece in stream:
        waiting += piece
        while True:
            if need is None:
                stop = waiting.find(b"\r\n\r\n")
                if stop < 0:
                    break
                length = next(v for k, v in map(_header, waiting[:stop].decode().split("\r\n")) if k == "content-length")
                need = stop + 4 + int(length) + 4
            if len(waiting) < need:
                break
            yield bytes(waiting[:need])
            del waiting[:need]
            need = None
    if waiting:
        raise ValueError("the stream ends within a record")


def inflate(file) -> Iterator[bytes]:
    """Inflated pieces of a gzip file of one or more members, read once."""
    member = zlib.decompressobj(GZIP)
    while data := file.read(CHUNK):
        while data:
            piece = member.decompress(data, CHUNK)
            if piece:
                yield piece
            if member.eof:
                data, member = member.unused_data, zlib.decompressobj(GZIP)
            else:
                data = member.unconsumed_tail
    if piece := member.flush():
        yield piece


LISTED = StructType(
    [StructField("file", StringType()), StructField("place", LongType()), StructField("key", LongType())]
    + [StructField("digest", StringType()), StructField("payload_bytes", LongType())]
)


def write_monolithic(df: DataFrame, folder: str, row_id: str, url: str, html: str) -> DataFrame:
    """One gzip stream of all records for each task; returns a row for each record, in ``LISTED``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file, place = attempt_name("whole") + ".warc.gz", None, 0
        for batch in batches:
            for part in slices(batch):
                if file is None:
                    system, path = open_folder(folder)
                    file, packer = system.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                rows = []
                for key, target, page in zip(*(part.column(c).to_pylist() for c in range(3))):
                    payload = (page or "").encode()
                    digest = payload_digest(payload)
                    named = "null" if key is None else str(key)
                    file.write(packer.compress(record(named, target or "", payload, digest)))
                    rows.append((name, place, key, digest, len(payload)))
                    place += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()))],
                    names=LISTED.names,
                )
        if file is not None:
            file.write(packer.flush())
            file.close()

    columns = [F.col(row_id).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html")]
    return df.select(*columns).mapInArrow(run, LISTED)


def revisits(listed: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``listed`` with ``refers_to``: the smallest key with the same payload, null for that capture itself.

    Payloads under ``least_bytes`` bytes are never revisits. Digests are counted before the shuffle,
    and only those that occur twice are joined.
    """
    same = listed.filter(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes")
    first = same.agg(F.min("key").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = listed.join(first, ["digest", "payload_bytes"], "left")
    other = F.col("key").isNull() | (F.col("key") != F.col("first"))
    return joined.withColumn("refers_to", F.when(other, F.col("first"))).drop("first")


def normalise(decided: DataFrame, folder: str, files: int) -> DataFrame:
    """Rewrite each whole-file stream that ``decided`` names as members with an index; returns the archives.

    The rows of a file, in the order of its records, come to one task, which reads the file once. There are
    as many tasks as ``files``: the rows are small whatever the files hold, so their size must not decide.
    """
    schema = StructType([StructField("archive", StringType()), StructField("index", StringType()), StructField("n_records", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, source, out = None, None, None
        system, path = open_folder(folder)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("file", "refers_to", "payload_bytes")))
            for file, refers_to, size in rows:
                if file != current:
                    if out is not None:
                        yield out.close()
                    current, out = file, _Archive(system, path, attempt_name("members"))
                    source = records(inflate(system.open_input_stream(f"{path}/{file}", compression=None)))
                out.add(next(source), refers_to, size)
        if out is not None:
            yield out.close()

    columns = decided.select("file", "place", "refers_to", "payload_bytes")
    return columns.repartitionByRange(max(1, files), "file").sortWithinPartitions("file", "place").mapInArrow(run, schema)


class _Archive:
    """Writes members and remembers their offsets; the index goes out in row groups."""

    fields = pa.schema([("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string())])

    def __init__(self, system, path: str, name: str):
        self.name, self.at, self.count, self.rows = name, 0, 0, []
        self.file = system.open_output_stream(f"{path}/{name}.warc.gz", compression=None)
        self.index = pq.ParquetWriter(f"{path}/{name}.idx.parquet", self.fields, filesystem=system)

    def add(self, data: bytes, refers_to: int | None, size: int) -> None:
        headers, _, payload = parse(data)
        key = headers["warc-record-id"][len("<urn:textmill:") : -1]
        digest = headers["warc-payload-digest"].partition(":")[2]
        if refers_to is not None:
            data = record(key, headers["warc-target-uri"], b"", digest, str(refers_to), size)
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
        member = packer.compress(data) + packer.flush()
        self.file.write(member)
        self.rows.append((self.at, len(member), headers["warc-record-id"], "response" if refers_to is None else "revisit"))
        self.at, self.count = self.at + len(member), self.count + 1
        if len(self.rows) >= 10_000:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            self.index.write_table(pa.table([pa.array(v, f.type) for v, f in zip(zip(*self.rows), self.fields)], schema=self.fields))
            self.rows = []

    def close(self) -> pa.RecordBatch:
        self.flush()
        self.index.close()
        self.file.close()
        names = ["archive", "index", "n_records"]
        return pa.record_batch([pa.array([f"{self.name}.warc.gz"]), pa.array([f"{self.name}.idx.parquet"]), pa.array([self.count])], names=names)


READ = StructType(
    [StructField("key", LongType()), StructField("url", StringType()), StructField("payload", BinaryType())]
    + [StructField("payload_bytes", LongType()), StructField("payload_digest", StringType())]
    + [StructField("record_type", StringType()), StructField("refers_to", LongType())]
)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives, found by the index and inflated as a member of its own.

    A response's digest and size are those of the payload that was read; a revisit has no payload,
    and its size and digest are the full payload's, as its headers state them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index in zip(batch.column("archive").to_pylist(), batch.column("index").to_pylist()):
                with reading(folder, index) as index_file, reading(folder, archive) as file:
                    for part in pq.ParquetFile(index_file).iter_batches(500):
                        yield from _read(file, part)

    count = max(1, archives.count())
    return archives.repartitionByRange(count, "archive").mapInArrow(run, READ)


def _read(file, index: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    rows, waiting = [], 0
    for offset, length in zip(index.column("offset").to_pylist(), index.column("length").to_pylist()):
        file.seek(offset)
        headers, http, payload = parse(zlib.decompress(file.read(length), GZIP))
        key = headers["warc-record-id"][len("<urn:textmill:") : -1]
        refers = headers.get("warc-refers-to")
        stated = headers["warc-payload-digest"].partition(":")[2]
        if refers is None and payload_digest(payload) != stated:
            raise ValueError(f"record {key}: the payload does not have the digest that its header states")
        size = int(http["content-length"]) if refers else len(payload)
        rows.append(
            (None if key == "null" else int(key), headers["warc-target-uri"], None if refers else payload, size, stated)
            + (headers["warc-type"], int(refers[len("<urn:textmill:") : -1]) if refers else None)
        )
        waiting += len(payload)
        if waiting > 4 << 20:
            yield _rows(rows)
            rows, waiting = [], 0
    if rows:
        yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.record_batch([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=READ.names)


def archive_pages(
    df: DataFrame, folder: str | None = None, row_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0,
) -> tuple[DataFrame, str]:
    """Write ``df`` as archives of single-member records with indexes; returns them and their folder.

    ``row_id`` must be a whole number; a null one is allowed, and never the target of a revisit while
    another row has the payload. Null html is an empty payload, a null url an empty one. Equal rows
    are records of their own. Other columns are not read; an empty table writes no archive. The text
    is never shuffled: a task's stream is rewritten by one task, which needs only the small rows that
    say what is a revisit. ``folder`` is a fresh one below the cluster's shared folder by default.
    """
    folder = folder or fresh_folder(df.sparkSession, "warc")
    listed = stage(write_monolithic(df, folder, row_id, url, html), "listed")
    files = listed.select("file").distinct().count()
    return stage(normalise(stage(revisits(listed, least_bytes), "decided"), folder, files), "archives"), folder
