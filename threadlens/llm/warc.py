"""WARC archives: a writer with revisit records and a salvage reader.

Records are gzip members (or plain records) one after another.  The reader checks version line, lengths, gzip
checksum and block digest; where a check fails it searches for the next member that opens as a record, or the
next version line, goes on there, and reports the bytes in between as a gap.  A member of several records is salvaged
inside in the same way, also as far as a damaged or cut member can be unpacked: its records and gaps carry their place
in the unpacked content (``inner_offset``), and records out of a damaged member have length 0, as the gap has its bytes.  Members are unpacked in chunks and every search
remembers its last hit, so reading takes time linear in the archive.

Archives travel as (archive, content) rows of bounded size, so they can be kept in any store that Spark reads and
writes; ``read_files`` reads archive files of a folder through Spark's binary reader.

Null payloads are empty, null targets and ids are left out.  Of records with equal payloads the largest id is the
response and the others revisit it; rows that repeat that id are all responses, and so are rows without an id.
Repeated rows are written each.  A payload of any size is one record in an archive of its own size.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_BYTES = 4 << 20      # an archive is closed when it has as many bytes
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
URN = "urn:x-record:"
CHUNK, MOST_HEADERS = 1 << 16, 1 << 20
FIELDS = ["kind", "archive", "offset", "inner_offset", "length", "reason", "record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload"]
SCHEMA = ("kind string, archive string, offset long, inner_offset long, length long, reason string, record_id string, record_type string, target_uri string, "
          "refers_to string, payload_bytes long, payload_digest string, payload binary")
KINDS = [pa.string(), pa.string(), *[pa.int64()] * 3, *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(record_id: str | None, target: str | None, payload: bytes, refers_to: str | None = None) -> bytes:
    """One plain record; with ``refers_to`` a revisit, which has no payload of its own."""
    block = HTTP_HEAD if refers_to is not None else HTTP_HEAD + payload
    clean = None if target is None else "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in target)
    lines = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Date", DATE),
             ("WARC-Record-ID", f"<{URN}{record_id}>" if record_id is not None else None), ("WARC-Target-URI", clean),
             ("WARC-Refers-To", f"<{URN}{refers_to}>" if refers_to is not None else None),
             ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if refers_to is not None else None),
             ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
             ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def compress(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class Damaged(ValueError):
    pass


def number(written: str) -> bool:
    return written.isascii() and written.isdigit() and len(written) <= 18


def parse_record(data: bytes, at: int = 0) -> tuple[dict, int]:
    """(fields, end) of the plain record at ``at``; Damaged if a check fails."""
    if data[at:at + 7] != b"WARC/1.":
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", at, at + MOST_HEADERS)
    if stop < 0:
        raise Damaged("headers without an end")
    head: dict[str, str] = {}
    for line in data[at:stop].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("broken header line")
        head[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    size = head.get("content-length", "")
    if not number(size):
        raise Damaged("no content length")
    end = stop + 4 + int(size)
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("record cut short")
    block = data[stop + 4:end]
    digest = head.get("warc-block-digest", "").removeprefix("sha1:")
    if digest and digest != sha1_base32(block):
        raise Damaged("block digest differs")
    kind = head.get("warc-type", "")
    payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
    stated = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "response":
        if stated and stated != sha1_base32(payload):
            raise Damaged("payload digest differs")
        stated, length = sha1_base32(payload), len(payload)
    else:
        length = int(head["x-payload-length"]) if number(head.get("x-payload-length", "")) else None

    def bare(name: str) -> str | None:
        value = head.get(name)
        return None if value is None else value.removeprefix("<").removesuffix(">").removeprefix(URN)

    return {"record_id": bare("warc-record-id"), "record_type": kind, "target_uri": head.get("warc-target-uri"), "refers_to": bare("warc-refers-to"),
            "payload_bytes": length, "payload_digest": stated, "payload": None if kind == "revisit" else payload}, end + 4


def open_member(data: bytes, at: int) -> tuple[bytes, int, str]:
    """(content, end, what is wrong) of the gzip member at ``at``; a damaged one gives what could be unpacked."""
    unpack, parts, wrong, place = zlib.decompressobj(31), [], "gzip member cut short", at
    while place < len(data) and not unpack.eof:
        chunk, before = data[place:place + CHUNK], unpack.copy()
        try:
            parts.append(unpack.decompress(chunk))
        except zlib.error as error:
            wrong = f"gzip: {error}"
            parts.append(unpack_until_error(before, chunk))
            break
        place += len(chunk)
    return b"".join(parts), place - len(unpack.unused_data), "" if unpack.eof else wrong


def unpack_until_error(unpack, chunk: bytes) -> bytes:
    """What a chunk gives before its first error: an error takes with it all that its call unpacked, so the calls get smaller."""
    parts, at = [], 0
    for step in (512, 1):
        while at < len(chunk):
            before = unpack.copy()
            try:
                parts.append(unpack.decompress(chunk[at:at + step]))
            except zlib.error:
                unpack = before
                break
            at += step
    return b"".join(parts)


class Starts:
    """Where records may begin in an archive; asked for places in ascending order."""

    def __init__(self, data: bytes):
        self.data, self.member, self.line = data, -1, -1

    def next_member(self, at: int) -> int:
        """The next member that opens as a record; the end if there is none."""
        while self.member < at:
            self.member = self.data.find(MEMBER, max(at, self.member + 1))
            if self.member < 0:
                self.member = len(self.data)
                break
            try:
                if zlib.decompressobj(31).decompress(self.data[self.member:self.member + 4096], 7) == b"WARC/1.":
                    break
            except zlib.error:
                pass
            at = max(at, self.member + 1)
        return self.member

    def next_line(self, at: int) -> int:
        """The next version line, also behind a torn line; the end if there is none."""
        if self.line < at:
            self.line = self.data.find(b"WARC/1.", at)
            self.line = len(self.data) if self.line < 0 else self.line
        return self.line

    def after(self, at: int) -> int:
        return min(self.next_member(at), self.next_line(at))


def salvage_plain(data: bytes) -> Iterator[dict]:
    """Records and gaps of unpacked content, in order; together they cover all its bytes."""
    starts, at, broken, reason = Starts(data), 0, None, ""
    while at < len(data):
        try:
            fields, end = parse_record(data, at)
        except Damaged as error:
            if broken is None:
                broken, reason = at, str(error)
            at = starts.next_line(at + 1)
            continue
        if broken is not None:
            yield {"kind": "gap", "offset": broken, "length": at - broken, "reason": reason}
            broken = None
        yield {"kind": "record", "offset": at, "length": end - at, **fields}
        at = end
    if broken is not None:
        yield {"kind": "gap", "offset": broken, "length": len(data) - broken, "reason": reason}


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of one archive, in order of their offsets; intact members, plain records and gaps without an inner offset
    cover all its bytes.  Records out of a damaged member lie inside the gap that begins with it."""
    starts, at, broken, reason = Starts(data), 0, None, ""
    while at < len(data):
        inside: list[dict] = []
        if data[at:at + 3] == MEMBER:
            content, end, wrong = open_member(data, at)
            inside = list(salvage_plain(content))
            records = [x for x in inside if x["kind"] == "record"]
            if not wrong and not records and content:
                wrong = inside[0]["reason"]
        else:
            try:
                fields, end = parse_record(data, at)
                inside, wrong = [{"kind": "record", "offset": 0, "length": end - at, **fields}], ""
            except Damaged as error:
                wrong = str(error)
        whole = not wrong
        if broken is not None and whole:
            yield {"kind": "gap", "offset": broken, "length": at - broken, "reason": reason}
            broken = None
        if wrong and broken is None:
            broken, reason = at, wrong
        several = len(inside) > 1
        for x in inside:
            if x["kind"] == "record":
                yield {**x, "offset": at, "length": end - at if whole else 0, "inner_offset": x["offset"] if several or not whole else None}
            elif whole:  # a gap inside an intact member
                yield {**x, "offset": at, "inner_offset": x["offset"]}
        at = end if whole else starts.after(at + 1)
    if broken is not None:
        yield {"kind": "gap", "offset": broken, "length": len(data) - broken, "reason": reason}


def write_archives(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES, gzip: bool = True, torn_every: int = 0) -> DataFrame:
    """(archive, content): every row of ``pages`` as a record, equal payloads stored once.

    With ``torn_every`` n, every n-th record of a task is preceded by half of itself, as a writer leaves it that was
    interrupted and wrote the record again.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload")).withColumn("key", F.sha1(F.col("payload").cast("binary")))
    latest = rows.groupBy("key").agg(F.max("id").alias("latest"))
    rows = rows.join(latest, "key").select(
        F.col("id").cast("string").alias("id"), "url", "payload", F.when(F.col("id") < F.col("latest"), F.col("latest").cast("string")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def archive(members: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([b"".join(members)], pa.binary())], names=["archive", "content"])

        members, size, written = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for record_id, url, payload, refers in zip(*(c.slice(at, 64).to_pylist() for c in batch.columns)):
                    data = record(record_id, url, payload.encode(), refers)
                    data = compress(data) if gzip else data
                    if torn_every and written % torn_every == 0:
                        members.append(data[:len(data) // 2])
                        size += len(members[-1])
                    members.append(data)
                    size += len(data)
                    written += 1
                    if size >= archive_bytes:
                        yield archive(members)
                        members, size = [], 0
        if members:
            yield archive(members)

    return rows.mapInArrow(run, "archive string, content binary")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Records (kind 'record') and quarantined gaps (kind 'gap') of (archive, content) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, data = batch.column(0)[k].as_py(), batch.column(1)[k].as_py() or b""
                rows, size = [], 0
                for found in salvage(data):
                    if not payloads:
                        found.pop("payload", None)
                    rows.append({"archive": name, **found})
                    size += len(found.get("payload") or b"") + 200
                    if size > ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in rows], kind) for f, kind in zip(FIELDS, KINDS)], names=FIELDS)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in rows], kind) for f, kind in zip(FIELDS, KINDS)], names=FIELDS)

    return archives.select("archive", "content").mapInArrow(run, SCHEMA)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(archive, content) rows of archive files; a file is one value, so keep files below 1 GB as the format advises."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), "content")
