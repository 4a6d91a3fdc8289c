"""WARC archives: writer with revisit records, and a reader that salvages what damaged archives still hold.

The writer makes one gzip member per record; files are rolled at ``roll_bytes`` and named by task attempt, and the
manifest lists only those of attempts that succeeded, so that a lost executor leaves no half archive behind. Equal
payloads of ``MIN_REVISIT`` bytes or more are stored once: the record with the smallest page_id is the response, the
others revisit it.

The reader checks each member (gzip checksum, WARC header, block digest). Where a check fails it searches for the next
place at which a valid record begins -- a gzip member or, in plain archives, a version line -- goes on from there and
logs the bytes between as a quarantined gap. A member may hold several records: they are read one after another, each with the
stretch of the file that was inflated for it. Of such a member that is cut off, those records stay whose block digest is right;
of one whose bytes are wrong, none. One record at a time is held in memory, its header of any length.

The shared folder is opened by ``pyarrow.fs`` in the tasks (file, hdfs, s3, gs and abfs paths).

Defined cases: a null html is an empty payload; a null url an empty target; a null page_id makes a response; rows
that share the smallest page_id of a payload are all responses; repeated rows are records of their own; an empty
table makes no archive and reads back as an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path, staged

MIN_REVISIT, ROLL_BYTES = 100, 64 << 20
DATE = "1970-01-01T00:00:00Z"
PAGE = "urn:page:"
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
RECORD_SCHEMA = ("kind string, archive string, offset long, length long, reason string, record_id string, record_type string, "
                 "target_uri string, refers_to string, declared_digest string, http_length long, payload binary")


class Damaged(Exception):
    """Why the bytes at a place are no valid record."""


class Cut(Damaged):
    """The bytes end too early."""


class Unsound(Damaged):
    """A member of several records that is cut off or whose bytes are wrong."""


def _name(page_id: int | None) -> str:
    return f"<{PAGE}{'' if page_id is None else page_id}>"


def _uri(url: str | None) -> str:
    """The url on one line: control characters percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}" if m[0] != "%" else "%", url or "")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """A response record, or a revisit of page ``first`` where that is given; compressed as one member."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if first is None:
        block += payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(url)}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if first is not None:
        head += [f"WARC-Refers-To: {_name(first)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def _open_fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def write_archives(pages: DataFrame, folder: str | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html); the staged manifest (archive, records, bytes)."""
    spark = pages.sparkSession
    folder = folder or shared_path(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    digest = F.sha2(F.col("html").cast("binary"), 256)
    # first: only of payloads that occur again, counted per task before they are shuffled
    again = rows.where(F.octet_length("html") >= MIN_REVISIT).groupBy(digest.alias("digest")).agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    again = staged(again, "warc-again")  # so that adaptive execution may broadcast it, or split a hot payload
    marked = rows.withColumn("digest", digest).join(again, "digest", "left").select("page_id", "url", "html", "digest", "first")

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        system, root = _open_fs(folder)
        system.create_dir(root, recursive=True)
        out, made = None, []

        def close():
            nonlocal out
            if out is not None:
                out.close()
                out = None

        for batch in batches:
            cols = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page, url, html, digest, first = (c[i].as_py() for c in cols)
                data = record_bytes(page, url, html.encode(), digest, None if page is None or first is None or first == page else first)
                if out is None or made[-1][2] + len(data) > roll_bytes:
                    close()
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(made):04d}.warc.gz"
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    made.append([f"{folder}/{name}", 0, 0])
                out.write(data)
                made[-1][1] += 1
                made[-1][2] += len(data)
        close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())], ["archive", "records", "bytes"])

    return staged(marked.mapInArrow(write, "archive string, records long, bytes long"), "warc-manifest")


def _digest_ok(declared: str, block: bytes) -> bool:
    kind, _, value = declared.partition(":")
    if kind.lower() not in ("sha1", "sha256"):
        return True
    found = hashlib.new(kind.lower(), block)
    return value.lower() in (found.hexdigest(), base64.b32encode(found.digest()).decode().lower())


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise Damaged("no version line")
    return {k.strip().lower(): v.strip() for k, sep, v in (line.partition(":") for line in lines[1:]) if sep}


def _length(head: dict[str, str]) -> int:
    value = head.get("content-length", "")
    if not value.isdigit():
        raise Damaged("no content length")
    return int(value)


def _checked(head: dict[str, str], block: bytes) -> tuple[dict[str, str], bytes]:
    if "warc-block-digest" in head and not _digest_ok(head["warc-block-digest"], block):
        raise Damaged("block digest differs")
    return head, block


class _Inflated:
    """The contents of the gzip member at ``at``, read forwards, but nothing from ``stop`` on."""

    def __init__(self, stream, at: int, stop: int | None = None):
        self.stream, self.read, self.stop, self.inflate, self.tail, self.held = stream, at, stop, zlib.decompressobj(31), b"", bytearray()

    def more(self, size: int = 1 << 16) -> bool:
        """Up to ``size`` further bytes of contents; false where the member ends."""
        if self.inflate.eof:
            return False
        if not self.tail:
            self.stream.seek(self.read)
            self.tail = self.stream.read(1 << 16 if self.stop is None else min(1 << 16, self.stop - self.read))
            self.read += len(self.tail)
        whole = bool(self.tail)
        try:
            data = self.inflate.decompress(self.tail, size)
        except zlib.error as e:
            raise Damaged(f"gzip: {str(e)[:60]}") from None
        self.tail = self.inflate.unconsumed_tail
        if not (whole or data or self.inflate.eof):
            raise Cut("member cut off")
        self.held += data
        return True

    @property
    def place(self) -> int:
        """Where the bytes end that were inflated so far."""
        return self.read - len(self.inflate.unused_data if self.inflate.eof else self.tail)

    def until(self, mark: bytes) -> bytes:
        """A header up to ``mark``, of any length."""
        seen = 0
        while (at := self.held.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.held)
            if seen >= 7 and not self.held.startswith(b"WARC/1."):
                raise Damaged("no version line")
            if not self.more():
                raise Damaged("header cut off")
        return self.take(at + len(mark))[:at]

    def take(self, size: int) -> bytes:
        while len(self.held) < size and self.more(max(1 << 16, size - len(self.held))):
            pass
        out = bytes(self.held[:size])
        del self.held[:size]
        return out

    def ended(self) -> bool:
        while not self.held and self.more():
            pass
        return not self.held


def _sound(stream, at: int, stop: int | None = None) -> bool:
    """Whether the member at ``at`` is there to its end; Damaged where its bytes are wrong."""
    inner = _Inflated(stream, at, stop)
    try:
        while inner.more():
            inner.held.clear()
    except Cut:
        return False
    return True


def _member_records(stream, at: int, stop: int | None = None) -> Iterator[tuple]:
    """The records of the member at ``at``; where ``stop`` is given, of one known to be cut off there."""
    inner, begin, first = _Inflated(stream, at, stop), at, True
    if stop is not None:
        _sound(stream, at, stop)
    while True:
        head = _headers(inner.until(b"\r\n\r\n"))
        length = _length(head)
        block = inner.take(length)
        if len(block) < length or inner.take(4) != b"\r\n\r\n":
            raise Damaged("record length differs")
        _checked(head, block)
        if stop is None:
            last = inner.ended()
            if first and not last:
                try:
                    whole = _sound(stream, at)
                except Damaged as e:
                    raise Unsound(str(e)) from None
                if not whole:
                    raise Unsound("member cut off")
        elif "warc-block-digest" not in head:
            raise Cut("member cut off")
        else:
            last = False
        yield head, block, begin, inner.place
        if last:
            return
        begin, first = inner.place, False


def _records_at(stream, at: int) -> Iterator[tuple]:
    """(headers, block, where it begins, where it ends) of the record at ``at``, or of all records of the member there."""
    stream.seek(at)
    begin = stream.read(5)
    if begin.startswith(b"\x1f\x8b\x08"):
        yield from _member_records(stream, at)
        return
    if begin != b"WARC/":
        raise Damaged("no record here")
    stream.seek(at)
    raw = bytearray()
    while (found := raw.find(b"\r\n\r\n", max(0, len(raw) - 4096 - 3))) < 0:
        data = stream.read(4096)
        if not data:
            raise Damaged("header cut off")
        raw += data
    head = _headers(bytes(raw[:found]))
    length = _length(head)
    stream.seek(at + found + 4)
    block = stream.read(length)
    if len(block) < length or stream.read(4) != b"\r\n\r\n":
        raise Damaged("record length differs")
    yield *_checked(head, block), at, at + found + 8 + length


def _next_start(stream, at: int, size: int, chunk: int = 1 << 20) -> int:
    """Where the next record may begin, from ``at`` on."""
    while at < size:
        stream.seek(at)
        data = stream.read(chunk + 16)
        if m := _START.search(data):
            return at + m.start()
        at += chunk
    return size


def _next_valid(stream, at: int, size: int) -> int:
    """Where the next valid record begins, from ``at`` on."""
    while (at := _next_start(stream, at, size)) < size:
        try:
            next(_records_at(stream, at))
            return at
        except Damaged:
            at += 1
    return size


def _at(stream, at: int, size: int) -> Iterator[tuple]:
    """The records at ``at``; then, if need be, ("gap", why, where the next may begin)."""
    try:
        yield from _records_at(stream, at)
    except Unsound as e:
        stop = _next_valid(stream, at + 1, size)
        try:
            yield from _member_records(stream, at, stop)
        except Damaged:
            yield "gap", str(e), stop
    except Damaged as e:
        yield "gap", str(e), _next_start(stream, at + 1, size)


def salvage(stream, size: int) -> Iterator[tuple]:
    """("record", offset, length, headers, block) and ("gap", offset, length, reason) in the order of the file."""
    at, gap, reason = 0, None, ""
    while at < size:
        for found in _at(stream, at, size):
            if found[0] == "gap":
                if gap is None:
                    gap, reason = at, found[1]
                at = found[2]
                continue
            head, block, begin, end = found
            if gap is not None:
                yield "gap", gap, begin - gap, reason
                gap = None
            yield "record", begin, end - begin, head, block
            at = end
    if gap is not None:
        yield "gap", gap, size - gap, reason


def read_archives(archives: DataFrame) -> DataFrame:
    """Records and gaps of the archives named in column ``archive``: one row each, see RECORD_SCHEMA."""
    spark: SparkSession = archives.sparkSession
    names = archives.select("archive").where("archive IS NOT NULL").distinct()
    names = names.repartition(max(1, spark.sparkContext.defaultParallelism * 4))

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64() if n in ("offset", "length", "http_length") else pa.binary() if n == "payload" else pa.string()
                 for n in (c.split()[0] for c in RECORD_SCHEMA.split(", "))]
        titles = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

        def made(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * len(types), types, strict=True)], titles)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, path = _open_fs(name)
                rows, held = [], 0
                with system.open_input_file(path) as raw:
                    stream = io.BufferedReader(raw) if isinstance(raw, io.RawIOBase) else raw
                    for found in salvage(stream, raw.size()):
                        if found[0] == "gap":
                            rows.append(("gap", name, found[1], found[2], found[3], *[None] * 7))
                            continue
                        _, at, length, head, block = found
                        http, _, payload = block.partition(b"\r\n\r\n")
                        said = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", http)
                        rows.append(("record", name, at, length, None, head.get("warc-record-id"), head.get("warc-type"), head.get("warc-target-uri"),
                                     head.get("warc-refers-to"), head.get("warc-payload-digest"), int(said[1]) if said else None, payload))
                        held += len(payload)
                        if held > 8 << 20:
                            yield made(rows)
                            rows, held = [], 0
                yield made(rows)

    return names.mapInArrow(read, RECORD_SCHEMA)


def page_report(pages: DataFrame) -> DataFrame:
    """Write ``pages``, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    records = read_archives(write_archives(pages)).where("kind = 'record'")
    page = F.regexp_extract("record_id", rf"^<{PAGE}(-?\d*)>$", 1)
    target = F.regexp_extract("refers_to", rf"^<{PAGE}(-?\d*)>$", 1)
    full = F.col("record_type") == "response"
    return records.select(
        F.when(page != "", page).cast("long").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.regexp_replace("declared_digest", "^sha256:", "")).alias("payload_digest"),
        "record_type", F.when(target != "", target).cast("long").alias("refers_to"))
