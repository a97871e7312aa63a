"""WARC archives: writing pages as records, and a sequential reader that verifies them.

An archive is a row of gzip members, one per record, so a reader needs no index: it inflates a
member bit by bit, takes the record's header, counts off the bytes that ``Content-Length``
announces, and must then meet the closing line ends and the end of the member.  Digests are
fed piece by piece, so neither writer nor reader holds more of a record than its payload, and
the reader not even that unless payloads are asked for.

Writing: pages are joined with the repeated payloads (digest, smallest id; aggregated first,
so a payload that a third of all pages share is one row), and every task appends to archives
of its own.  The table of archives lists only those of tasks that succeeded, so files of lost
attempts are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.scratch import hot_join, kept

#: Fixed values of the public format (WARC 1.1).
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
MAGIC = b"\x1f\x8b\x08"

ARCHIVES = "path string, records long, bytes long"
RECORDS = ("path string, offset long, size long, record_id string, record_type string, target_uri string, "
           "date string, refers_to string, payload binary, payload_bytes long, payload_digest string, error string")
PIECE = 1 << 16


def sha1_name(digest: bytes) -> str:
    """The bare name of a SHA-1 digest: upper-case base32, which needs no padding for 20 bytes."""
    return base64.b32encode(digest).decode()


def header_safe(text: str) -> str:
    """Percent signs for what may not stand in a header line: white space, controls, non-ASCII."""
    return quote(text, safe="!#$%&'()*+,-./:;<=>?@[]_~")


def urn(ident: str | None, digest: str) -> str:
    return f"<urn:x-doc:{quote(ident or '', safe='')}:{digest}>"


def id_of(record_id: str | None) -> str | None:
    """The document id in a record id made by ``urn``."""
    parts = (record_id or "").strip("<>").split(":")
    return unquote(parts[2]) or None if len(parts) == 4 and parts[1] == "x-doc" else None


def _headers(fields: list[tuple[bytes, bytes]], first: bytes) -> bytes:
    return b"\r\n".join([first, *[k + b": " + v for k, v in fields]]) + END


def record(ident: str | None, url: str | None, payload: memoryview, first: str | None, revisit: bool,
           date: str) -> list[bytes | memoryview]:
    """The parts of one uncompressed record; a revisit names its response and carries no payload."""
    digest = sha1_name(hashlib.sha1(payload).digest())
    http = _headers([(b"Content-Type", b"text/html; charset=utf-8"), (b"Content-Length", b"%d" % len(payload))],
                    b"HTTP/1.1 200 OK")
    block = hashlib.sha1(http)
    body: memoryview | bytes = b"" if revisit else payload
    block.update(body)
    name = urn(ident, digest)
    fields = [
        (b"WARC-Type", b"revisit" if revisit else b"response"),
        (b"WARC-Record-ID", name.encode()),
        (b"WARC-Date", date.encode()),
        (b"WARC-Target-URI", header_safe(url).encode() if url else name.strip("<>").encode()),
        (b"WARC-Block-Digest", b"sha1:" + sha1_name(block.digest()).encode()),
        (b"WARC-Payload-Digest", b"sha1:" + digest.encode()),
    ]
    if revisit:
        fields += [(b"WARC-Refers-To", urn(first, digest).encode()), (b"WARC-Profile", PROFILE)]
    fields += [(b"Content-Type", b"application/http; msgtype=response"),
               (b"Content-Length", b"%d" % (len(http) + len(body)))]
    return [_headers(fields, VERSION), http, body, END]


class Archive:
    """An archive that is being written: one gzip member per record."""

    def __init__(self, folder: str, level: int):
        self.level = level
        self.path = f"{folder.rstrip('/')}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        store, place = fs.FileSystem.from_uri(self.path)
        store.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out = store.open_output_stream(place, compression=None)
        self.records = self.bytes = 0

    def append(self, parts: list[bytes | memoryview]) -> None:
        member = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        for part in parts:
            for lo in range(0, len(part), PIECE):
                self._put(member.compress(part[lo:lo + PIECE]))
        self._put(member.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> pa.RecordBatch:
        self.out.close()
        return pa.RecordBatch.from_pydict(
            {"path": [self.path], "records": pa.array([self.records], pa.int64()),
             "bytes": pa.array([self.bytes], pa.int64())})


def _writer(folder: str, date: str, level: int, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            payloads = batch.column("payload").cast(pa.large_binary())
            rows = zip(batch.column("ident").to_pylist(), batch.column("url").to_pylist(),
                       batch.column("first").to_pylist(), batch.column("revisit").to_pylist(), strict=True)
            for i, (ident, url, first, revisit) in enumerate(rows):
                if archive is None:
                    archive = Archive(folder, level)
                body = payloads[i].as_buffer()
                payload = memoryview(body) if body is not None and body.size else memoryview(b"")
                archive.append(record(ident, url, payload, first, revisit, date))
                if archive.bytes >= archive_bytes:
                    yield archive.close()
                    archive = None
        if archive is not None:
            yield archive.close()

    return write


def archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             least_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", level: int = 6,
             archive_bytes: int = 1 << 30) -> DataFrame:
    """Write one record per page below ``folder``; returns the archives: path, records, bytes.

    Of pages with equal payloads of at least ``least_bytes`` bytes the one with the smallest id
    is a response and the others are revisits of it; smaller payloads are all responses.  A null
    payload is empty; a null id counts as greater than any other, and where every id of a
    payload is null, all are responses.  Repeated rows that share the smallest id are the same
    record and are each written as a response.  A null URL is replaced by the record's own name;
    bytes that a header cannot hold are percent-encoded.  Further columns are left out.  An
    empty table gives no archive.
    """
    ident = F.col(f"`{id_col}`")
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(ident.alias("doc"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    repeated = (rows.filter(F.octet_length("payload") >= least_bytes).groupBy("key")
                .agg(F.count("*").alias("n"), F.min(F.struct(F.isnull("doc").alias("none"), "doc")).alias("first"))
                .filter("n > 1").select("key", F.col("first.doc").alias("first"), F.lit(True).alias("again")))
    told = hot_join(rows, repeated, ["key"], "left").select(
        F.col("doc").cast("string").alias("ident"), "url", "payload", F.col("first").cast("string").alias("first"),
        (F.coalesce("again", F.lit(False)) & ~F.col("doc").eqNullSafe(F.col("first"))).alias("revisit"))
    return kept(told.mapInArrow(_writer(folder, date, level, archive_bytes), ARCHIVES), "warc-archives")


class Member:
    """The uncompressed bytes of one gzip member, inflated only as far as asked for."""

    def __init__(self, source, offset: int, head: bytes):
        self.source, self.offset = source, offset
        self.inflate = zlib.decompressobj(31)
        self.raw, self.plain = head, b""
        self.taken = len(head)  # compressed bytes handed to this member so far

    def _more(self) -> bool:
        """Inflate a further piece; false at the end of the member."""
        while not self.inflate.eof:
            if not self.raw:
                self.raw = self.source.read(PIECE)
                if not self.raw:
                    raise ValueError("truncated member")
                self.taken += len(self.raw)
            piece = self.inflate.decompress(self.raw, PIECE)
            self.raw = self.inflate.unconsumed_tail
            if piece:
                self.plain += piece
                return True
        return False

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        while mark not in self.plain:
            if len(self.plain) > most:
                raise ValueError("header too long")
            if not self._more():
                raise ValueError("header without end")
        head, self.plain = self.plain.split(mark, 1)
        return head

    def pieces(self, n: int) -> Iterator[bytes]:
        """Exactly ``n`` further bytes."""
        while n:
            if not self.plain and not self._more():
                raise ValueError("record shorter than its Content-Length")
            piece, self.plain = self.plain[:n], self.plain[n:]
            n -= len(piece)
            yield piece

    def rest(self) -> int:
        """Skip to the end of the member; the number of bytes skipped."""
        skipped = len(self.plain)
        while self._more():
            skipped += len(self.plain)
            self.plain = b""
        return skipped

    @property
    def after(self) -> bytes:
        return self.inflate.unused_data

    @property
    def size(self) -> int:
        return self.taken - len(self.after)


def _fields(head: bytes, first: re.Pattern) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not first.match(lines[0]):
        raise ValueError("unknown first line")
    pairs = [line.split(b":", 1) for line in lines[1:]]
    if any(len(p) != 2 for p in pairs):
        raise ValueError("header line without a colon")
    return {k.strip().decode("latin-1").lower(): v.strip().decode("latin-1") for k, v in pairs}


WARC_LINE, HTTP_LINE = re.compile(rb"WARC/1\.[01]$"), re.compile(rb"HTTP/[\d.]+ \d{3}")
LENGTH = re.compile(r"\d+$")


def _length(fields: dict[str, str]) -> int:
    if not LENGTH.match(fields.get("content-length", "")):
        raise ValueError("no Content-Length")
    return int(fields["content-length"])


def _bare(digest: str | None) -> str | None:
    return digest.split(":", 1)[1] if digest and digest.startswith("sha1:") else None


def _framed(pieces: Iterator[bytes], block) -> Iterator[bytes]:
    for piece in pieces:
        block.update(piece)
        yield piece


def read_record(member: Member, with_payload: bool) -> dict:
    """One record of a member, verified: framing, end of the member, block and payload digest."""
    out: dict = {}
    fields = _fields(member.until(END), WARC_LINE)
    out.update(record_id=fields.get("warc-record-id"), record_type=fields.get("warc-type"),
               target_uri=fields.get("warc-target-uri"), date=fields.get("warc-date"),
               refers_to=fields.get("warc-refers-to"))
    block, payload, parts, n_bytes = hashlib.sha1(), hashlib.sha1(), [], 0
    stream = _framed(member.pieces(_length(fields)), block)
    http: dict[str, str] = {}
    is_http = fields.get("content-type", "").startswith("application/http")
    head = b""
    for piece in stream:
        if is_http and not http:
            head += piece
            if END not in head:
                continue
            raw, piece = head.split(END, 1)
            http = _fields(raw, HTTP_LINE)
        payload.update(piece)
        n_bytes += len(piece)
        if with_payload:
            parts.append(piece)
    told = _bare(fields.get("warc-payload-digest"))
    if is_http and not http:
        out["error"] = "response without HTTP header"
    if out["record_type"] == "revisit":
        out.update(payload_bytes=_length(http) if http else None, payload_digest=told)
    else:
        out.update(payload=b"".join(parts) if with_payload else None, payload_bytes=n_bytes,
                   payload_digest=sha1_name(payload.digest()))
        if told not in (None, out["payload_digest"]):
            out["error"] = "payload digest differs"
    if _bare(fields.get("warc-block-digest")) not in (None, sha1_name(block.digest())):
        out["error"] = "block digest differs"
    if b"".join(member.pieces(len(END))) != END or member.rest():
        out["error"] = "record longer than its Content-Length"
    return out


def read_archive(source, with_payload: bool = True) -> Iterator[dict]:
    """All records of one open, seekable archive in order; a damaged one is a row with an error.

    After damage to a record the next member follows where this one ends; after damage to the
    compressed bytes the search goes on at the next place that looks like a member's start.
    """
    offset, head = 0, source.read(PIECE)
    while head:
        member = Member(source, offset, head)
        row: dict = {}
        try:
            try:
                row = read_record(member, with_payload)
            except ValueError as error:
                row = {"error": str(error)}
                if str(error) == "truncated member":
                    raise
                member.rest()
            after, size = member.after, member.size
        except (zlib.error, ValueError) as error:
            row = {"error": f"broken member: {error}"}
            after, size = _next_start(source, offset)
        yield {"offset": offset, "size": size, **row}
        offset += size
        head = after or source.read(PIECE)


def _next_start(source, offset: int) -> tuple[bytes, int]:
    """The bytes from the next member's magic on, and their distance; leaves the source behind them."""
    at = offset + 1
    source.seek(at)
    held = b""
    while piece := source.read(PIECE):
        held += piece
        found = held.find(MAGIC)
        if found >= 0:
            return held[found:], at + found - offset
        at += max(0, len(held) - 2)
        held = held[-2:]
    return b"", at + len(held) - offset


def _reader(with_payload: bool):
    names = [f.split()[0] for f in RECORDS.split(", ")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in RECORDS.split(", ")])

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            for path in found.column("path").to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(place) as source:
                    for row in read_archive(source, with_payload):
                        rows.append({"path": path, **row})
                        held += 512 + len(row.get("payload") or b"")
                        if held > 1 << 22:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return read


def records(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives named in column ``path``, one row each (``RECORDS``).

    ``offset`` and ``size`` place the record's member in its archive.  ``payload_bytes`` and
    ``payload_digest`` are those of the full payload: counted and hashed for responses, as
    declared for revisits.  ``error`` says what was wrong, and is null for verified records.
    Archives are spread over tasks and each is read in order, a piece at a time.
    """
    n = max(24, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.select("path").repartition(n, "path").mapInArrow(_reader(with_payload), RECORDS)


def dangling(found: DataFrame) -> DataFrame:
    """Revisits whose response is in none of the archives."""
    revisits = found.filter("record_type = 'revisit'").select("path", "offset", "record_id", "refers_to")
    present = found.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to")).distinct()
    lost = revisits.select("refers_to").distinct().join(present, "refers_to", "left_anti")
    return hot_join(revisits, lost.filter("refers_to is not null"), ["refers_to"], "left_semi")


def archived(pages: DataFrame, folder: str, id_col: str = "page_id", **options) -> DataFrame:
    """Write ``pages`` as archives and read these back: one row per page.

    Columns: the id as text, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to`` (id of the response as text, null for responses) and ``error``.  For nulls,
    ties, repeated rows and empty tables see ``archives``.
    """
    found = records(archives(pages, folder, id_col, **options), with_payload=False)

    def ident(column: str):
        raw = F.url_decode(F.regexp_extract(column, r"^<urn:x-doc:([^:]*):[A-Z2-7]{32}>$", 1))
        return F.when(raw != "", raw)

    return found.select(ident("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type",
                        ident("refers_to").alias("refers_to"), "error")
