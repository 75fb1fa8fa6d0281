"""WARC archives: written record by record, read back by a sequential reader.

Writing.  Every record is a gzip member of its own, so an archive can be entered at any
record.  A task appends the members of its pages to archives of about ``ARCHIVE_BYTES``
and returns one row per finished archive; these rows are the folder's manifest, written
as Parquet when all tasks are through.  An archive that a lost executor left behind is in
no manifest and is never read.  A payload that several pages share is stored once, with
the page of the smallest page_id; the others are revisit records that name it.

Reading.  Each archive is read from its start to its end by one task: members are
inflated piece by piece (``CHUNK`` bytes in, at most ``CHUNK`` out), a record's header
gives its content length, which frames the block, and the block and payload digests are
computed on the way and compared.  Memory holds a piece of a record, or one payload
where payloads are asked for.  Archives made elsewhere read alike.

Edge cases: a null html is an empty payload; payloads below ``min_bytes`` are never
revisits; rows that share a page_id and a payload are all what that page is; a null
page_id is a response of its own and is referred to by none; null urls are left out of
the record, control characters, spaces and non-ASCII characters in urls are
percent-encoded; an empty table gives a folder without archives, which reads as no rows;
other columns are ignored.  Truncated members, wrong lengths and missing headers raise
``ValueError`` with file and offset; a wrong digest does too unless ``strict`` is off.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehand.llm.common import hot_safe_lookup, open_folder, ship

ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 16
#: A header block longer than this is no WARC header.
MOST_HEADER = 1 << 20
#: Tasks that read archives, at most.
READ_TASKS = 10_000
#: Records, and bytes of their payloads, that a reading task hands on together.
BATCH_RECORDS, BATCH_BYTES = 1000, 8 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1"
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

_MANIFEST = "file string, records long, bytes long"
_RECORDS = ("file string, offset long, record_type string, record_id string, url string, date string, "
            "payload_bytes long, payload_digest string, refers_to_id string, verified boolean")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{page_id}>"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member with a whole record."""
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(b"%s\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r\n" % (VERSION, head, len(block), block)) + gz.flush()


def info_record(date: str) -> bytes:
    block = b"software: lakehand\r\nformat: WARC File Format 1.1\r\n"
    return record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", page_urn(None)), ("WARC-Date", date),
                   ("Content-Type", "application/warc-fields"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")], block)


def safe_url(url: str) -> str:
    return urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]|")


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None, first_url: str | None, date: str) -> bytes:
    """The page's response, or its revisit of the page ``first``."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", page_urn(page_id)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", safe_url(url)))
    if first is None:
        block += payload
    else:
        fields += [("WARC-Profile", IDENTICAL_PAYLOAD), ("WARC-Refers-To", page_urn(first)), ("WARC-Refers-To-Date", date)]
        if first_url is not None:
            fields.append(("WARC-Refers-To-Target-URI", safe_url(first_url)))
    fields += [("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
               ("Content-Type", HTTP_TYPE)]
    return record(fields, block)


def append_archives(folder: str, date: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        task = TaskContext.get()
        out, name, made, size, count = None, "", 0, 0, 0
        done = []
        for batch in batches:
            html = batch.column("html").cast(pa.binary())
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "first", "first_url")), html)
            for page_id, url, first, first_url, payload in rows:
                if out is None:
                    name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{made:05d}.warc.gz"
                    out, made, count = fs.open_output_stream(f"{root}/{name}", compression=None), made + 1, 0
                    size = out.write(info_record(date))
                size += out.write(page_record(page_id, url, payload.as_py() or b"", first, first_url, date))
                count += 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count, size))
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "records", "bytes"), d)) for d in done],
                                         pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))
    return write


def with_firsts(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, and for pages whose payload a smaller page_id has: that page's ``first`` and ``first_url``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.coalesce("html", F.lit("")))))
    shared = (rows.where("page_id is not null").where(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes)
              .groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("head"), F.count("*").alias("n")).where("n > 1")
              .select("digest", "n", F.col("head.page_id").alias("first"), F.col("head.url").alias("first_url")))
    found = hot_safe_lookup(rows, shared, "digest", "page_id")
    later = F.col("page_id") > F.col("first")
    return found.select("page_id", "url", "html", *[F.when(later, F.col(c)).alias(c) for c in ("first", "first_url")])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as archives under ``folder``, a folder all executors share."""
    ship(pages.sparkSession)
    fs, root = open_folder(folder)
    fs.create_dir(root, recursive=True)
    done = with_firsts(pages, min_bytes).mapInArrow(append_archives(folder, date, archive_bytes), _MANIFEST)
    done.write.parquet(f"{folder}/manifest")


class Member:
    """The inflated bytes of one gzip member, drawn from a stream piece by piece."""

    def __init__(self, stream, raw: bytes):
        self._stream, self._gz = stream, zlib.decompressobj(31)
        self._raw, self._ready, self.taken = raw, b"", 0

    def _more(self) -> bool:
        """Inflate another piece; false at the member's end."""
        while not self._gz.eof:
            raw = self._raw or self._stream.read(CHUNK)
            if not raw:
                raise ValueError("the archive ends within a record")
            piece = self._gz.decompress(raw, CHUNK)
            self._raw = self._gz.unused_data if self._gz.eof else self._gz.unconsumed_tail
            self.taken += len(raw) - len(self._raw)
            if piece:
                self._ready += piece
                return True
        return False

    def until(self, mark: bytes, most: int) -> bytes:
        """The bytes up to and with ``mark``."""
        at = self._ready.find(mark)
        while at < 0:
            if len(self._ready) > most:
                raise ValueError(f"no end of header within {most} bytes")
            if not self._more():
                raise ValueError("the record ends within its header")
            at = self._ready.find(mark)
        out, self._ready = self._ready[:at + len(mark)], self._ready[at + len(mark):]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces."""
        while n:
            if not self._ready and not self._more():
                raise ValueError(f"the record ends {n} bytes before its content length")
            piece, self._ready = self._ready[:n], self._ready[n:]
            n -= len(piece)
            yield piece

    def close(self) -> bytes:
        """Check that the record ends here; the bytes of the next member read so far."""
        end = b"".join(self.pieces(4))
        if end != b"\r\n\r\n" or self._ready or self._more():
            raise ValueError("the record is longer than its content length")
        return self._raw


class Record(NamedTuple):
    offset: int
    fields: dict[str, str]
    payload_bytes: int
    payload_digest: str
    verified: bool
    payload: bytes | None


def header(data: bytes) -> tuple[str, dict[str, str]]:
    """First line and fields (names in lower case, continued lines joined)."""
    lines = data.decode("utf-8", "replace").replace("\r\n ", " ").replace("\r\n\t", " ").split("\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return lines[0], fields


def length_of(fields: dict[str, str]) -> int:
    n = fields.get("content-length", "")
    if not n.isdigit():
        raise ValueError("the record has no content length")
    return int(n)


def same_digest(stated: str | None, found: str) -> bool:
    """False if a SHA-1 is stated and differs; other algorithms are not judged."""
    name, _, value = (stated or "").partition(":")
    return name.lower() != "sha1" or value.upper().rstrip("=") == found


def read_record(member: Member, offset: int, keep: bool) -> Record:
    first, fields = header(member.until(b"\r\n\r\n", MOST_HEADER))
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record")
    left = length_of(fields)
    block, payload, size, kept = hashlib.sha1(), hashlib.sha1(), 0, []
    stated = None
    if left and fields.get("content-type", "").lower().startswith("application/http"):
        head = member.until(b"\r\n\r\n", MOST_HEADER)
        if len(head) > left:
            raise ValueError("the HTTP header passes the content length")
        block.update(head)
        left -= len(head)
        stated = header(head)[1].get("content-length")
    for piece in member.pieces(left):
        block.update(piece)
        payload.update(piece)
        size += len(piece)
        if keep:
            kept.append(piece)
    block_sha, payload_sha = (base64.b32encode(h.digest()).decode() for h in (block, payload))
    digest = fields.get("warc-payload-digest")
    ok = same_digest(fields.get("warc-block-digest"), block_sha)
    if fields.get("warc-type") == "revisit":     # holds no payload: its header tells of the full one
        return Record(offset, fields, int(stated) if stated and stated.isdigit() else size,
                      (digest or "").partition(":")[2].upper(), ok, None)
    return Record(offset, fields, size, payload_sha, ok and same_digest(digest, payload_sha), b"".join(kept) if keep else None)


def records(stream, keep: bool = False, strict: bool = True) -> Iterator[Record]:
    """The records of an archive in order."""
    offset, raw = 0, b""
    while raw := raw or stream.read(CHUNK):
        member = Member(stream, raw)
        try:
            found = read_record(member, offset, keep)
            raw = member.close()
            if strict and not found.verified:
                raise ValueError(f"wrong digest in {found.fields.get('warc-record-id')}")
        except (ValueError, zlib.error) as e:
            raise ValueError(f"record at byte {offset}: {e}") from e
        yield found
        offset += member.taken


def read_files(folder: str, keep: bool, strict: bool):
    def bare(urn: str | None) -> str | None:
        return None if urn is None else urn.strip("<>")

    def row(file: str, r: Record) -> dict:
        f = r.fields
        return {"file": file, "offset": r.offset, "record_type": f.get("warc-type"), "record_id": bare(f.get("warc-record-id")),
                "url": f.get("warc-target-uri"), "date": f.get("warc-date"), "payload_bytes": r.payload_bytes,
                "payload_digest": r.payload_digest, "refers_to_id": bare(f.get("warc-refers-to")), "verified": r.verified,
                **({"payload": r.payload} if keep else {})}

    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in _RECORDS.split(", "))] + ([("payload", pa.binary())] if keep else []))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(f"{root}/{file}", compression=None) as stream:
                    try:
                        for r in records(stream, keep, strict):
                            rows.append(row(file, r))
                            size += len(r.payload or b"")
                            if len(rows) >= BATCH_RECORDS or size >= BATCH_BYTES:
                                yield pa.RecordBatch.from_pylist(rows, schema)
                                rows, size = [], 0
                    except ValueError as e:
                        raise ValueError(f"{file}: {e}") from e
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)
    return read


def read_archives(spark: SparkSession, folder: str, files: DataFrame | None = None, payloads: bool = False,
                  strict: bool = True) -> DataFrame:
    """Every record of the folder's archives, or of ``files`` (column ``file``) in it."""
    ship(spark)
    files = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest") if files is None else files
    tasks = max(1, min(READ_TASKS, files.count()))
    return (files.select("file").repartition(tasks)
            .mapInArrow(read_files(folder, payloads, strict), _RECORDS + (", payload binary" if payloads else "")))


def page_records(read: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and the url of the pages among ``read``."""
    page = lambda c: F.when(F.col(c).startswith("urn:page:"), F.substring_index(c, ":", -1).cast("long"))
    return (read.where(F.col("record_type").isin("response", "revisit"))
            .select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                    page("refers_to_id").alias("refers_to"), "url"))


def broken_revisits(read: DataFrame) -> DataFrame:
    """(record_id, payload_digest, revisits): records that revisits refer to, but that are missing or have another
    payload.  Revisits are counted per record first, so a page with millions of them is one row in the join."""
    asked = read.where("record_type = 'revisit'").groupBy("refers_to_id", "payload_digest", "payload_bytes").agg(F.count("*").alias("revisits"))
    there = read.where("record_type = 'response'").select("record_id", "payload_digest", "payload_bytes").distinct()
    keys = ["record_id", "payload_digest", "payload_bytes"]
    return asked.withColumnRenamed("refers_to_id", "record_id").join(there, keys, "left_anti").select("record_id", "payload_digest", "revisits")
