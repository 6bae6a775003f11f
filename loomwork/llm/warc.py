"""WARC records: reading, segmenting, and reassembly of segmented records.

A record too long for its writer is split: the first segment keeps its type and has segment number 1, continuation
records name it as their origin, and the last states the total length. Reassembly groups segments by
origin, orders them by number, verifies that none is missing and the total length is right, joins the blocks, and decodes
the HTTP response within, chunked transfer framing and gzip or deflate coding included.

Unsegmented records don't move; segments meet by one shuffle on the origin's id. Status of a record: ok; incomplete (a segment is missing, or the
last states no total); length_mismatch; conflict (two different segments of one number); bad_http; bad_chunk (framing broken);
bad_coding. Only ok has a body. Segments equal in number and block count once, so repeated rows do no harm. Records with a null id (and
no origin) and with null blocks are incomplete each for itself. An empty table gives none. Other columns are dropped. Ids of pages are of any
type that a string gives back.

Files are read as a stream, record by record: a task holds one record's block (which the format's segments keep small) and a buffer, whatever
the size of the file or of its gzip members.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import zlib
from collections.abc import Iterator
from typing import IO

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.columns import col
from loomwork.workspace import opened

RECORD = "record_id string, warc_type string, target_uri string, segment_number int, origin_id string, total_length long, block binary"
_SCHEMA = pa.schema([("record_id", pa.string()), ("warc_type", pa.string()), ("target_uri", pa.string()), ("segment_number", pa.int32()), ("origin_id", pa.string()), ("total_length", pa.int64()), ("block", pa.binary())])
RESULT = "status string, http_status int, content_type string, body binary"


def chunked(body: bytes, size: int) -> bytes:
    """``body`` in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(body[i : i + size]), body[i : i + size]) for i in range(0, len(body), size)]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(data: bytes) -> bytes | None:
    """The body of chunked framing, trailers dropped; None if the framing is broken or cut short."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        size = data[at:end].split(b";", 1)[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        n, at = int(size, 16), end + 2
        if n == 0:
            rest = data[at:]
            return b"".join(out) if rest.startswith(b"\r\n") or rest.find(b"\r\n\r\n") >= 0 else None
        if data[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(data[at : at + n])
        at += n + 2


def decoded(block: bytes) -> tuple[str, int | None, str | None, bytes | None]:
    """Status, HTTP status, content type and body of an HTTP response."""
    head, gap, body = block.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    m = re.match(rb"HTTP/\d(?:\.\d)? (\d{3})", lines[0])
    if not gap or not m:
        return "bad_http", None, None, None
    headers: dict[bytes, bytes] = {}
    for x in lines[1:]:
        k, _, v = x.partition(b":")
        headers[k.strip().lower()] = v.strip()
    code = int(m[1])
    kind = headers[b"content-type"].decode("latin-1") if b"content-type" in headers else None
    if b"chunked" in headers.get(b"transfer-encoding", b"").lower():
        got = dechunked(body)
        if got is None:
            return "bad_chunk", code, kind, None
        body = got
    coding = headers.get(b"content-encoding", b"").lower()
    try:
        body = gzip.decompress(body) if coding == b"gzip" else zlib.decompress(body) if coding == b"deflate" else body
    except (OSError, EOFError, zlib.error):
        return "bad_coding", code, kind, None
    return "ok", code, kind, body


def joined(segments: list[tuple[int | None, int | None, bytes | None]]) -> tuple[str, bytes | None]:
    """Status and block of (number, total length, block) of one record; number None: not segmented."""
    blocks: dict[int, bytes] = {}
    total = None
    for number, length, block in segments:
        if block is None:
            return "incomplete", None
        n = 1 if number is None else number
        if blocks.setdefault(n, block) != block:
            return "conflict", None
        if length is not None and total not in (None, length):
            return "conflict", None
        total = length if length is not None else total
    if sorted(blocks) != list(range(1, len(blocks) + 1)):
        return "incomplete", None
    whole = b"".join(blocks[n] for n in sorted(blocks))
    if total is None and any(number is not None for number, _, _ in segments):
        return "incomplete", None
    if total is not None and total != len(whole):
        return ("incomplete" if len(whole) < total else "length_mismatch"), None
    return "ok", whole


def segments(record_id: str, uri: str | None, block: bytes, size: int) -> list[tuple]:
    """Rows of RECORD for one response, in blocks of at most ``size`` bytes."""
    parts = [block[i : i + size] for i in range(0, len(block), size)] or [b""]
    if len(parts) == 1:
        return [(record_id, "response", uri, None, None, None, block)]
    out = []
    for n, part in enumerate(parts, 1):
        own = record_id if n == 1 else f"{record_id}/{n}"
        out.append((own, "response" if n == 1 else "continuation", uri, n, None if n == 1 else record_id, len(block) if n == len(parts) else None, part))
    return out


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", segment_bytes: int = 1024, chunk_bytes: int = 512, damaged: bool = False) -> DataFrame:
    """Pages as segmented WARC records of chunked HTTP responses. Pages without html have no record;
    equal rows are one record, which gives one page back where it is segmented. With ``damaged`` every page whose number ends in 0 has a
    second record that is spoilt in a way that follows from the number (see ``spoilt``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, u, h in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if h is not None:
                    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
                    body = h.encode("utf-8", "replace")
                    # pages of one id (or none) that differ are records of their own
                    digest = hashlib.blake2b(f"{u}\0".encode("utf-8", "replace") + body, digest_size=8).hexdigest()
                    name, block = f"urn:page:{digest}:{'' if i is None else i}", head + chunked(body, chunk_bytes)
                    rows += segments(name, u, block, segment_bytes)
                    if damaged and isinstance(i, int) and i % 10 == 0:
                        rows += spoilt(i // 10 % len(SPOILT), name.replace(":page:", ":spoilt:"), u, block, segment_bytes)
            cols = list(zip(*rows)) if rows else [()] * len(_SCHEMA)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA)], schema=_SCHEMA)

    return pages.select(col(page_id).alias("page_id"), col(url).alias("url"), col(html).alias("html")).mapInArrow(run, RECORD)


#: What ``spoilt`` does, and the status that it leads to (a record too short to be split can't miss a segment and stays whole).
SPOILT = (("last segment missing", "incomplete"), ("second segment twice, unlike", "conflict"), ("total one less", "length_mismatch"), ("no total", "incomplete"), ("a chunk's size is no number", "bad_chunk"), ("no status line", "bad_http"), ("said to be gzip", "bad_coding"))


def spoilt(how: int, record_id: str, uri: str | None, block: bytes, size: int) -> list[tuple]:
    """The segments of a record spoilt in one of the ways of SPOILT."""
    if how == 4:
        head, gap, body = block.partition(b"\r\n\r\n")
        block = head + gap + b"z" + body[1:]
    elif how == 5:
        block = b"X" + block[1:]
    elif how == 6:
        block = block.replace(b"Content-Type: text/html; charset=utf-8", b"Content-Encoding: gzip", 1)
    rows = segments(record_id, uri, block, size)
    if len(rows) == 1:
        return rows
    if how == 0:
        return rows[:-1]
    if how == 1:
        return [*rows, (*rows[1][:-1], rows[1][-1][:-1] + bytes([rows[1][-1][-1] ^ 1]))]
    if how in (2, 3):
        total = rows[-1][5] - 1 if how == 2 else None
        return [*rows[:-1], (*rows[-1][:5], total, rows[-1][6])]
    return rows


def pages_sql(segment_bytes: int = 1024, chunk_bytes: int = 512) -> str:
    """DuckDB SQL for ``pages_of`` of the damaged archive of pages, by arithmetic over the lengths."""
    head = len(b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n")
    full = chunk_bytes + len(b"%x" % chunk_bytes) + 4
    case = " ".join(f"when {i} then " + ("case when parts > 1 then '%s' else 'ok' end" % s if i < 4 else f"'{s}'") for i, (_, s) in enumerate(SPOILT))
    return f"""
with p as (select page_id, url, html, strlen(html) as n, page_id // 10 % {len(SPOILT)} as how from pages where html is not null),
l as (select *, {head} + (n // {chunk_bytes}) * {full} + case when n % {chunk_bytes} > 0 then n % {chunk_bytes} + 4 + len(printf('%x', n % {chunk_bytes})) else 0 end + 5 as whole from p),
s as (select *, ceil((whole - case when how = 6 then {len(b"Content-Type: text/html; charset=utf-8") - len(b"Content-Encoding: gzip")} else 0 end) / {segment_bytes}) as parts from l),
d as (select *, case how {case} end as status from s where page_id % 10 = 0)
select page_id, url, 'ok' as status, html from p union all select page_id, url, status, case when status = 'ok' then html end from d"""


def reassembled(records: DataFrame) -> DataFrame:
    """Columns record_id, target_uri, segments, status, http_status, content_type, body: one row a record."""

    @F.pandas_udf(RESULT)
    def decode(parts: pd.Series) -> pd.DataFrame:
        rows = []
        for p in parts:
            status, block = joined([(x["segment_number"], x["total_length"], x["block"]) for x in p])
            rows.append(decoded(block) if block is not None else (status, None, None, None))
        out = pd.DataFrame(rows, columns=["status", "http_status", "content_type", "body"])
        out["http_status"] = out["http_status"].astype("Int32")
        return out

    part = F.struct("segment_number", "total_length", "block")
    useful = records.filter(F.lower("warc_type").isin("response", "continuation"))
    whole = useful.filter((F.col("segment_number").isNull() & F.col("origin_id").isNull()) | F.coalesce("origin_id", "record_id").isNull())
    alone = whole.select("record_id", "target_uri", F.array(part).alias("parts"))
    split = useful.filter((F.col("segment_number").isNotNull() | F.col("origin_id").isNotNull()) & F.coalesce("origin_id", "record_id").isNotNull())
    # the parts of one record by number; a continuation has its origin's id
    key = F.coalesce("origin_id", "record_id").alias("record_id")
    grouped = split.groupBy(key).agg(F.min("target_uri").alias("target_uri"), F.sort_array(F.collect_list(part)).alias("parts"))
    both = alone.unionByName(grouped).withColumn("d", decode("parts"))
    return both.select("record_id", "target_uri", F.size("parts").alias("segments"), "d.status", "d.http_status", "d.content_type", "d.body")


def pages_of(records: DataFrame, kind: str = "long") -> DataFrame:
    """Columns page_id (of type ``kind``), url, segments, status, html: ``archived`` undone, one row a record."""
    got = reassembled(records)
    name = F.regexp_extract("record_id", r"(?s)^urn:(?:page|spoilt):[0-9a-f]{16}:(.*)$", 1)
    return got.select(F.when(name != "", name).try_cast(kind).alias("page_id"), F.col("target_uri").alias("url"), "segments", "status", F.make_valid_utf8(F.col("body").cast("string")).alias("html"))


_FIELD = {"record_id": "WARC-Record-ID", "warc_type": "WARC-Type", "target_uri": "WARC-Target-URI", "segment_number": "WARC-Segment-Number", "origin_id": "WARC-Segment-Origin-ID", "total_length": "WARC-Segment-Total-Length"}


def serialised(rows: list[tuple], compress: bool = False) -> bytes:
    """A WARC/1.1 file of rows of RECORD; compressed, each record is a gzip member of its own."""
    out = []
    for row in rows:
        fields = dict(zip(_SCHEMA.names, row))
        block = fields.pop("block") or b""
        head = ["WARC/1.1"]
        for k, v in fields.items():
            if v is not None:
                head.append(f"{_FIELD[k]}: {f'<{v}>' if k.endswith('_id') else v}")
        head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
        one = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
        out.append(gzip.compress(one, mtime=0) if compress else one)
    return b"".join(out)


class _Stream:
    """Bytes of a WARC file in order, gzip members unpacked piece by piece; a broken member ends it."""

    STEP = 1 << 20

    def __init__(self, source: IO[bytes]):
        self.source, self.buffer, self.at, self.over = source, bytearray(), 0, False
        first = source.read(2)
        self.raw, self.member = first, zlib.decompressobj(31) if first == b"\x1f\x8b" else None

    def _more(self) -> bool:
        """Some more bytes into the buffer."""
        del self.buffer[: self.at]
        self.at = 0
        while not self.over:
            data, self.raw = self.raw or self.source.read(self.STEP), b""
            if not data:
                self.over = True
            elif self.member is None:
                self.buffer += data
                return True
            else:
                try:
                    piece = self.member.decompress(data, self.STEP)
                    self.raw = self.member.unconsumed_tail
                    if self.member.eof:
                        self.raw = self.member.unused_data.lstrip(b"\0")
                        self.member = zlib.decompressobj(31)
                except zlib.error:
                    self.over = True
                    break
                if piece:
                    self.buffer += piece
                    return True
        return False

    def find(self, mark: bytes) -> int:
        """Where ``mark`` begins from here on, read until it is there; -1: nowhere."""
        seen = 0
        while (i := self.buffer.find(mark, self.at + seen)) < 0:
            seen = max(0, len(self.buffer) - self.at - len(mark) + 1)
            if not self._more():
                return -1
        return i - self.at

    def take(self, n: int) -> bytes:
        """The next n bytes, or what is left."""
        while len(self.buffer) - self.at < n and self._more():
            pass
        out = bytes(self.buffer[self.at : self.at + n])
        self.at += len(out)
        return out

    def skip_to(self, mark: bytes) -> bool:
        while True:
            i = self.buffer.find(mark, self.at)
            if i >= 0:
                self.at = i
                return True
            self.at = max(self.at, len(self.buffer) - len(mark) + 1)
            if not self._more():
                return False


def parsed(data: bytes | IO[bytes]) -> Iterator[tuple]:
    """Rows of RECORD of a WARC file (its bytes, or an open file), compressed or not. A record cut short ends it, with a null block."""
    stream = _Stream(io.BytesIO(data) if isinstance(data, bytes) else data)
    while stream.skip_to(b"WARC/"):
        gap = stream.find(b"\r\n\r\n")
        if gap < 0:
            return
        head = re.sub(rb"\r\n[ \t]+", b" ", stream.take(gap + 4)[:gap])
        fields = {}
        for line in head.split(b"\r\n")[1:]:
            k, _, v = line.partition(b":")
            fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
        get = lambda name: fields.get(_FIELD[name].lower())
        number = lambda v: int(v) if v is not None and re.fullmatch(r"\d{1,18}", v) else None
        bare = lambda v: v[1:-1] if v and v[0] == "<" and v[-1] == ">" else v
        n = number(fields.get("content-length"))
        block = stream.take(n) if n is not None else None
        cut = block is None or len(block) < n
        yield bare(get("record_id")), get("warc_type"), bare(get("target_uri")), number(get("segment_number")), bare(get("origin_id")), number(get("total_length")), None if cut else block
        if cut:
            return


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of RECORD of all WARC files under ``path``. A file is one task's, read as a stream by its URI (local and shared folders, and the
    stores that Arrow's file systems know); only the list of files is made by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, held = [], 0
                with opened(uri) as source:
                    for row in parsed(source):
                        rows.append(row)
                        held += len(row[-1] or b"")
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    n = max(1, files.count())
    return files.repartition(min(n, 10_000), "path").mapInArrow(run, RECORD)
