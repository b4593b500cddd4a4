"""WARC archives of pages, and a reader that salvages damaged ones.

Writing: each page is one gzip member with one record. Of pages with equal payloads that with the largest id becomes the
response and the others revisits that refer to it, so a payload is stored once. Members are written by Spark's own text
writer, hence to any file system and by any number of tasks: a member ends in the high byte of its length, which is zero
below 16 MiB, and that byte is the line separator; a longer member is followed by an empty one.

Reading: archives are read as binary files. A member or plain record is taken if gzip's checksum, the version line, the
content length and the digests all hold. Where a check fails, the reader looks for the next gzip member or version line
that holds, goes on from there, and logs the bytes between as a quarantined gap. Inside a member it does the same with
the content: records before the fault of a damaged member are kept, and a damaged record doesn't cost its neighbours. An archive is one task's work; `per_file`
bounds how large the writer makes them.

Cases: a null payload counts as empty, and empty payloads are equal to each other; a page without an id keeps its record,
and is a response if no page with its payload has an id; a repeated row repeats its record; a null url has no target
field; an empty table gives no records. Only id, url and payload are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREFIX = "urn:page:"
DATE = "1970-01-01T00:00:00Z"
PER_FILE = 10_000
FILE_BYTES = 256 << 20
VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
CHUNK = 1 << 14
#: A version line and named fields; and a version line inside, which a cut header runs into.
HEADER = re.compile(rb"WARC/1\.\d(?:\r\n[A-Za-z0-9-]+:[^\x00-\x08\x0a-\x1f]*)+")
INNER = re.compile(rb".WARC/1\.\d\r\n", re.DOTALL)
#: The fields that every record has.
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
EMPTY_MEMBER = zlib.compress(b"", 6, 31)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: str | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record: a response, or a revisit if it refers to another page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{PREFIX}{page_id or ''}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{PREFIX}{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + END


def _member_batches(batches: Iterable[pa.RecordBatch], file_bytes: int) -> Iterator[pa.RecordBatch]:
    part, held = 0, 0
    for batch in batches:
        out, parts = [], []
        for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
            member = zlib.compress(record(*(x.as_py() for x in row)), 6, 31)
            if member[-1]:
                member += EMPTY_MEMBER
            if held and held + len(member) > file_bytes:
                part, held = part + 1, 0
            held += len(member)
            out.append(member[:-1])
            parts.append(part)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(parts, pa.int32())], ["member", "part"])


def planned(pages: DataFrame, *, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """page_id, url, payload (bytes) and refers_to (null for responses)."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("code", F.sha2("payload", 256))
    first = rows.groupBy("code").agg(F.max("page_id").alias("response_id"))
    is_response = F.col("page_id").eqNullSafe(F.col("response_id"))
    both = rows.join(first, "code")
    return both.select("page_id", "url", "payload", F.when(~is_response, F.col("response_id")).alias("refers_to"))


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    per_file: int = PER_FILE,
    file_bytes: int = FILE_BYTES,
) -> str:
    """Write all pages as gzipped WARC files below `path`, in folders by the part of a task's output they hold.

    A file has at most `per_file` pages and `file_bytes` bytes; a page larger than that has a file of its own.
    """
    plan = planned(pages, id_col=id_col, url_col=url_col, payload_col=payload_col)
    texts = plan.select(F.col("page_id").cast("string"), "url", "payload", F.col("refers_to").cast("string"))
    members = texts.mapInArrow(lambda batches: _member_batches(batches, file_bytes), "member binary, part int")
    values = members.select(F.col("member").cast("string").alias("value"), "part")
    values.write.option("lineSep", "\u0000").option("maxRecordsPerFile", per_file).partitionBy("part").text(path)
    return path


@dataclass
class Found:
    """A record or, with a reason, a gap; start and end are byte positions in the file."""

    start: int
    end: int
    fields: dict[str, str]
    block: bytes = b""
    reason: str | None = None


class Bad(Exception):
    """A check failed."""


def _plain(data: bytes | memoryview, at: int) -> Found:
    """The record that begins at `at`, all checks passed."""
    if bytes(data[at : at + len(VERSION)]) != VERSION:
        raise Bad("no version line")
    head_end = data.find(END, at)
    if head_end < 0:
        raise Bad("header without end")
    head = bytes(data[at:head_end])
    if not HEADER.fullmatch(head) or INNER.search(head):
        raise Bad("header is not well formed")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    if missing := [name for name in REQUIRED if not fields.get(name)]:
        raise Bad(f"no {missing[0]}")
    length = fields.get("content-length", "")
    if not length.isdecimal():
        raise Bad("no content length")
    start, end = head_end + len(END), head_end + len(END) + int(length)
    if data[end : end + len(END)] != END:
        raise Bad("content length does not fit")
    block = data[start:end]
    wanted = fields.get("warc-block-digest", "")
    if wanted.startswith("sha1:") and wanted[5:] != digest(block):
        raise Bad("block digest does not fit")
    found = Found(at, end + len(END), fields, block)
    if fields.get("warc-type") == "response" and (wanted := fields.get("warc-payload-digest", "")).startswith("sha1:"):
        if wanted[5:] != digest(payload_of(block)):
            raise Bad("payload digest does not fit")
    return found


def payload_of(block: bytes) -> bytes:
    """What follows the HTTP header."""
    return block.partition(END)[2]


def _member(data: memoryview, at: int) -> tuple[int, bytes, str | None]:
    """End and content of the gzip member that begins at `at`; with a reason, what came out before it went wrong."""
    unzip, out, fed = zlib.decompressobj(31), [], at
    while not unzip.eof:
        if fed >= len(data):
            return len(data), b"".join(out) + unzip.flush(), "member is cut off"
        # Short chunks, since a chunk that fails gives nothing of what it held before the fault.
        chunk = data[fed : fed + CHUNK]
        try:
            out.append(unzip.decompress(chunk))
        except zlib.error as error:
            return fed, b"".join(out) + _up_to_fault(data, at, fed), f"gzip: {error}"
        fed += len(chunk)
    return fed - len(unzip.unused_data), b"".join(out), None


def _up_to_fault(data: memoryview, at: int, fed: int) -> bytes:
    """What the bytes from `fed` on give, one by one, before the fault in them."""
    unzip, out = zlib.decompressobj(31), []
    for start in range(at, fed, CHUNK):
        unzip.decompress(data[start : start + CHUNK])
    try:
        for i in range(fed, min(fed + CHUNK, len(data))):
            out.append(unzip.decompress(data[i : i + 1]))
    except zlib.error:
        pass
    return b"".join(out)


def _inside(content: bytes) -> Iterator[Found]:
    """The records of a text whose checks hold, and the gaps between them, by positions in it."""
    at, gap, why = 0, None, ""
    while at < len(content):
        try:
            one = _plain(content, at)
        except Bad as bad:
            if gap is None:
                gap, why = at, str(bad)
            after = content.find(VERSION, at + 1)
            at = after if after >= 0 else len(content)
            continue
        if gap is not None:
            yield Found(gap, at, {}, reason=why)
            gap = None
        yield one
        at = one.end
    if gap is not None:
        yield Found(gap, len(content), {}, reason=why)


def _of_member(at: int, end: int, content: bytes) -> list[Found]:
    """Records and inner gaps of a sound member; all lie at its place in the file, inner gaps tell theirs in the reason."""
    found = []
    for one in _inside(content):
        why = one.reason and f"{one.reason}, bytes {one.start} to {one.end} of the member's content"
        found.append(Found(at, end, one.fields, one.block, why))
    return found


def _sound(data: bytes, view: memoryview, at: int) -> tuple[list[Found], int]:
    """What the member or plain record that begins at `at` holds, and its end; raises if a check fails."""
    if data[at : at + len(GZIP)] != GZIP:
        one = _plain(data, at)
        return [one], one.end
    end, content, fault = _member(view, at)
    if fault is not None:
        raise Bad(fault)
    return _of_member(at, end, content), end


def _gap(view: memoryview, start: int, end: int, starts: list[int], why: str) -> Iterator[Found]:
    """The gap between two sound parts, and the records that damaged members in it give before their fault.

    Taken from the last member to the first, each up to the next that gives records, so that none comes twice. A damaged
    member may give wrong bytes before the fault shows: only records whose block digest holds are taken. Digests don't
    cover headers.
    """
    rescued: list[Found] = []
    upto = end
    for at in reversed(starts):
        content = _member(view[:upto], at)[1]
        whole = [f for f in _inside(content) if f.fields.get("warc-block-digest", "").startswith("sha1:")]
        if whole:
            rescued = [Found(at, upto, f.fields, f.block) for f in whole] + rescued
            upto = at
    yield Found(start, end, {}, reason=f"{why}, {len(rescued)} records rescued" if rescued else why)
    yield from rescued


def salvage(data: bytes) -> Iterator[Found]:
    """All records whose checks hold, and the gaps between them.

    A damaged member is a gap up to the next member or version line that holds, and gives the records that came out of it
    whole before the fault. A sound member with a damaged record gives its other records and an inner gap.
    """
    view, at, gap, why = memoryview(data), 0, None, ""
    starts: list[int] = []
    while at < len(data):
        try:
            found, end = _sound(data, view, at)
        except Bad as bad:
            if gap is None:
                gap, why = at, str(bad)
            if data[at : at + len(GZIP)] == GZIP:
                starts.append(at)
            after = [p for p in (data.find(GZIP, at + 1), data.find(VERSION, at + 1)) if p >= 0]
            at = min(after, default=len(data))
            continue
        if gap is not None:
            yield from _gap(view, gap, at, starts, why)
            gap, starts = None, []
        yield from found
        at = end
    if gap is not None:
        yield from _gap(view, gap, len(data), starts, why)


ENTRY = (
    "path string, start long, end long, gap string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def _entry(path: str, found: Found) -> tuple:
    if found.reason is not None:
        return (path, found.start, found.end, found.reason, *[None] * 7)
    fields = found.fields
    kind, payload = fields.get("warc-type"), payload_of(found.block)
    size = len(payload)
    if kind == "revisit":
        payload, head = None, found.block.decode("utf-8", "replace").lower()
        declared = head.partition("content-length:")[2].partition("\r\n")[0].strip()
        size = int(declared) if declared.isdecimal() else None
    code = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    name = lambda field: (fields.get(field) or "").strip("<>") or None
    return (
        path, found.start, found.end, None, kind, name("warc-record-id"), fields.get("warc-target-uri"),
        name("warc-refers-to"), code, size, payload,
    )


def _archive_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [part.split() for part in ENTRY.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[kind] for _, kind in fields]
    names = [name for name, _ in fields]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            rows, held = [], 0
            for found in salvage(content.as_py()):
                rows.append(_entry(path.as_py(), found))
                held += len(found.block) + 1000
                if held > 4_000_000:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records and gaps of the archives below `path`; `gap` has the reason of a gap and is null for records."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_archive_batches, ENTRY)


def records(entries: DataFrame) -> DataFrame:
    return entries.where(F.col("gap").isNull()).drop("gap")


def gaps(entries: DataFrame) -> DataFrame:
    """The quarantine log: path, start, end, reason."""
    return entries.where(F.col("gap").isNotNull()).select("path", "start", "end", F.col("gap").alias("reason"))
