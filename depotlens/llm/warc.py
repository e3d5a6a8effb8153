"""WARC archives, index first.

Writing: every task writes its pages as gzip members, one WARC record each,
into archive files of its own under the shared folder and returns one index
row per record (file, offset, length, URL, digest). The index is stored by
Spark's committer, so files of lost or repeated attempts are never referenced.
Reading starts from index rows: they are dealt by (file, offset) and sorted,
neighbouring byte ranges are read in one request, and each record is cut out
of what was read.

Of records with equal payloads the one with the smallest page_id is a response
and holds the payload; the others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import mapped, new_path, stored

_INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"


@dataclass(frozen=True)
class WarcParams:
    archive_bytes: int = 1 << 30  # a task begins another file beyond this size
    gap_bytes: int = 64 << 10  # unselected bytes that are read over rather than skipped
    range_bytes: int = 8 << 20  # most bytes of one request, unless one record is longer
    task_bytes: int = 32 << 20  # archive bytes that one reading task takes, about
    least_payload: int = 0  # payloads of fewer bytes are never revisits
    date: str = "1970-01-01T00:00:00Z"
    level: int = 4


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _header_value(text: str) -> str:
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record: a response with the payload, or a revisit without it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + b"\r\n" if revisit else http + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_id(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers with lower-case names, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not the begin of a WARC record: the index does not fit the archive")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, p: WarcParams = WarcParams()) -> DataFrame:
    """Write ``pages(page_id, url, html)``; returns the stored index.

    A null html is an empty payload, a null url leaves the target out. A row
    with a null page_id is a revisit if a row with an id has its payload;
    repeated ids with the smallest one's payload are all responses.
    """
    spark = pages.sparkSession
    folder = new_path(spark, "warc")
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html")
    ).withColumn("sha", F.sha1("html"))
    long_enough = F.octet_length("html") >= p.least_payload
    firsts = stored(own.where(long_enough).groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("sha", "first_id"), "payloads")
    typed = own.join(firsts, "sha", "left").select("page_id", "url", "html", "first_id")

    def run(batches):
        files, where = fs.FileSystem.from_uri(folder)
        files.create_dir(where, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= p.archive_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{where}/{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(name, compression=None)
                    digest = digest_of(payload)
                    revisit = first is not None and first != page_id
                    pack = zlib.compressobj(p.level, zlib.DEFLATED, 31)
                    member = pack.compress(record(page_id, url, payload, digest, first, revisit, p.date)) + pack.flush()
                    out.write(member)
                    rows.append((name, at, len(member), url, digest, page_id, "revisit" if revisit else "response"))
                    at += len(member)
                types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                names = [x.split()[0] for x in _INDEX.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)
        finally:
            if out is not None:
                out.close()

    return stored(mapped(typed, run, _INDEX), "warc_index")


def read_records(index: DataFrame, p: WarcParams = WarcParams(), with_payload: bool = False) -> DataFrame:
    """(page_id, url, record_type, digest, payload_bytes, refers_to[, payload]) of the records that ``index`` selects.

    digest and payload_bytes of a response are computed from the payload that
    was read (and the digest compared with the record's); a revisit carries
    the digest of its header and null bytes.
    """
    folder = new_path(index.sparkSession, "any")
    schema = "page_id long, url string, record_type string, digest string, payload_bytes long, refers_to long" + ", payload binary" * with_payload
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // p.task_bytes))  # by archive bytes: index rows are small
    rows = index.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")

    def run(batches):
        files, _ = fs.FileSystem.from_uri(folder)
        source, opened = None, ""

        def fetched(wanted):
            """Payload rows of index rows that one request covers."""
            nonlocal source, opened
            name, begin = wanted[0][0], wanted[0][1]
            if name != opened:
                if source is not None:
                    source.close()
                source, opened = files.open_input_file(name), name
            raw = source.read_at(max(o + n for _, o, n in wanted) - begin, begin)
            out = []
            for _, offset, length in wanted:
                headers, payload = parsed(zlib.decompress(raw[offset - begin : offset - begin + length], 31))
                said = headers["warc-payload-digest"].removeprefix("sha1:")
                revisit = headers["warc-type"] == "revisit"
                if not revisit and digest_of(payload) != said:
                    raise ValueError(f"damaged record at {offset} of {name}")
                out.append((
                    _page(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], said, None if revisit else len(payload),
                    _page(headers["warc-refers-to"]) if revisit else None, payload,
                ))
            types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            names = ["page_id", "url", "record_type", "digest", "payload_bytes", "refers_to", "payload"]
            keep = 7 if with_payload else 6
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types[:keep])], names[:keep])

        try:
            wanted, end = [], 0
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if wanted and (row[0] != wanted[0][0] or row[1] - end > p.gap_bytes or row[1] + row[2] - wanted[0][1] > p.range_bytes):
                        yield fetched(wanted)
                        wanted = []
                    wanted.append(row)
                    end = row[1] + row[2]
            if wanted:
                yield fetched(wanted)
        finally:
            if source is not None:
                source.close()

    return mapped(rows, run, schema)


def archived(pages: DataFrame, p: WarcParams = WarcParams()) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, as read back from its archive.

    A revisit's size is that of the response with its digest.
    """
    got = stored(read_records(write_archives(pages, p), p), "warc_records")
    sizes = got.where("record_type = 'response'").groupBy("digest").agg(F.max("payload_bytes").alias("bytes"))
    responses = got.where("record_type = 'response'")
    revisits = got.where("record_type = 'revisit'").drop("payload_bytes").join(sizes, "digest").withColumnRenamed("bytes", "payload_bytes")
    return responses.unionByName(revisits).select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")
