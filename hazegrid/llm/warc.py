"""WARC archives: a writer with deduplicated payloads and a reader that salvages what it can from damaged files.

Records are gzip members of archives of bounded size, written by Spark. The reader checks each member (gzip checksum),
each record (version line, length, digest) and, after a failed check, looks for the next member or version line that
starts a valid record, inside a member too; the bytes between are quarantined and logged.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazegrid.llm.common import keep

# Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = b"\x1f\x8b\x08"
#: An empty gzip member; Spark's text writer ends every archive with it, as with a line break.
_EMPTY = zlib.compress(b"", 9, 31)[:4] + bytes(4) + b"\x02\xff" + zlib.compress(b"", 9, -15) + bytes(8)
_LINE = re.compile(rb"WARC/1\.[01]\r\n")
#: Bytes of an archive, about: an archive ends with the record that reaches them.
ARCHIVE_BYTES = 16 << 20
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column: five bytes make eight digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def deduplicated(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                 min_bytes: int = 0) -> DataFrame:
    """Columns id, url, payload, digest, record_type and refers_to.

    Of records with equal payloads of ``min_bytes`` or more, the one with the largest id is the response and the
    others revisit it; smaller payloads are all responses. A null payload is an empty one. A null id is smaller than
    any other; rows that repeat the largest id with the same payload are responses too.
    """
    rows = pages.select(pages[id_col].alias("id"), pages[url_col].cast("string").alias("url"),
                        F.coalesce(pages[payload_col].cast("binary"), F.lit("").cast("binary")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    many = rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.max("id").alias("newest"), F.count(F.lit(1)).alias("n"))
    many = keep(many.where("n > 1").select(F.col("digest").alias("same"), "newest"), "payloads")
    found = rows.join(many, (F.col("digest") == F.col("same")) & (F.octet_length("payload") >= min_bytes), "left")
    again = F.col("same").isNotNull() & ~F.col("id").eqNullSafe(F.col("newest"))
    return found.select("id", "url", "payload", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
                        F.when(again, F.col("newest")).alias("refers_to"))


def _block_digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def _header_value(text: str) -> str:
    return re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", text) if re.search(r"[\x00-\x1f\x7f]", text) else text


def record(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to, date: str) -> bytes:
    """One record, not compressed."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if kind == "response":
        block += payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", date),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Payload-Length", len(payload)), ("WARC-Block-Digest", _block_digest(block)),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", _header_value(url)))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>")]
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES,
                   compress: bool = True) -> None:
    """Writes the rows of ``deduplicated`` as archives of about ``archive_bytes`` at most, below ``path``.

    Every record is a gzip member; without ``compress``, records stand one after another as they are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def full():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], ["archive"])

        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                part = record(r["id"], r["url"], r["payload"], r["digest"], r["record_type"], r["refers_to"], date)
                if compress:
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
                    part = squeeze.compress(part) + squeeze.flush()
                parts.append(part)
                size += len(part)
                if size >= archive_bytes:
                    yield full()
                    parts, size = [], 0
        if parts:
            yield full()

    archives = records.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    (archives.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
     .option("lineSep", _EMPTY.decode("latin-1") if compress else "\r\n").text(path))


def _member(data: memoryview, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at``, and where it ends. Raises zlib.error if it fails its checks."""
    inflate, out, end = zlib.decompressobj(31), [], at
    while not inflate.eof:
        part = data[end:end + (1 << 16)]
        if not len(part):
            raise zlib.error("the member is cut off")
        out.append(inflate.decompress(part))
        end += len(part)
    return b"".join(out), end - len(inflate.unused_data)


def _inflated(data: memoryview, at: int) -> bytes:
    """What a damaged gzip member at ``at`` gives before its first error."""
    def feed(end: int, step: int) -> int:
        while end < len(data) and not inflate.eof:
            try:
                out.append(inflate.decompress(data[end:end + step]))
            except zlib.error:
                break
            end += step
        return end

    inflate, out = zlib.decompressobj(31), []
    failed = feed(at, 1 << 16)                       # the part with the error gives nothing in one go
    inflate, out = zlib.decompressobj(31), []
    view, data = data, data[:failed]
    feed(at, 1 << 16)
    data = view[:failed + (1 << 16)]
    feed(failed, 1)
    return b"".join(out)


def _records(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes | None, str | None]]:
    """Records and gaps of the content of a member, as ``salvage`` has them, found by version lines only."""
    at, bad, why = 0, -1, ""
    while at < len(data):
        try:
            fields, block, end = _plain(data, at)
        except ValueError as e:
            if bad < 0:
                bad, why = at, str(e)
            line = _LINE.search(data, at + 1)
            at = line.start() if line else len(data)
            continue
        if bad >= 0:
            yield bad, at - bad, None, None, why
            bad = -1
        yield at, end - at, fields, block, None
        at = end
    if bad >= 0:
        yield bad, len(data) - bad, None, None, why


def _plain(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields and block of the record at ``at``, and where it ends. Raises ValueError if a check fails."""
    if not _LINE.match(data, at):
        raise ValueError("no version line")
    head = data.find(b"\r\n\r\n", at)
    if head < 0:
        raise ValueError("the header is cut off")
    fields: dict[str, str] = {}
    for line in data[at:head].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError("a header line without a colon")
        fields[name.strip().lower()] = value.strip()
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")):
        raise ValueError("no valid length")
    start, end = head + 4, head + 4 + int(fields["content-length"])
    if data[end:end + 4] != b"\r\n\r\n":
        raise ValueError("no record end where the length says")
    block = data[start:end]
    if fields.get("warc-block-digest", "").startswith("sha1:") and fields["warc-block-digest"] != _block_digest(block):
        raise ValueError("the block does not match its digest")
    return fields, block, end + 4


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes | None, str | None]]:
    """Records and gaps of an archive: (offset, length, fields, block, None) or (offset, length, None, None, reason).

    Gaps run from the first byte that fails a check to the next valid member or version line, or to the end. Records
    and gaps cover the archive; empty members and line breaks between records count to neither.

    Records and gaps inside a whole member have its offset and length; the reason of a gap names the bytes of the
    content. A member with a wrong checksum or without its end is a gap; what it gives before the error is searched
    too, and records from there have its offset and length 0. A member that holds nothing but one record is not
    whole without its checksum, so that record stays in the gap.
    """
    view, at, bad, why = memoryview(data), 0, -1, ""

    def next_start(after: int) -> int:
        found = [data.find(GZIP, after)]
        line = _LINE.search(data, after)
        found.append(line.start() if line else -1)
        return min((f for f in found if f >= 0), default=len(data))

    while at < len(data):
        try:
            if data.startswith(GZIP, at):
                try:
                    content, end = _member(view, at)
                except zlib.error as e:
                    found = list(_records(_inflated(view, at)))
                    rows = [r for r in found if r[2] is not None]
                    if not rows or len(found) == 1:
                        raise
                    if bad >= 0:
                        yield bad, at - bad, None, None, why
                    for _, _, fields, block, _ in rows:
                        yield at, 0, fields, block, None
                    for start, length, fields, _, reason in found:
                        if fields is None:
                            yield at, 0, None, None, f"{reason} (bytes {start} to {start + length} of the member's content)"
                    bad, why = at, str(e)
                    at = next_start(at + 1)
                    continue
                rows = list(_records(content))
                failed = [r for r in rows if r[2] is None]
                if len(failed) == len(rows) > 0:
                    raise ValueError(failed[0][4])
                rows = [(fields, block, reason and f"{reason} (bytes {start} to {start + length} of the member's content)")
                        for start, length, fields, block, reason in rows]
            elif data.startswith(b"\r\n", at):
                end, rows = at + 2, []
            else:
                fields, block, end = _plain(data, at)
                rows = [(fields, block, None)]
        except (zlib.error, ValueError) as e:
            if bad < 0:
                bad, why = at, str(e)
            at = next_start(at + 1)
            continue
        if bad >= 0 and rows:  # only a record ends a gap
            yield bad, at - bad, None, None, why
            bad = -1
        for fields, block, reason in rows:
            yield at, end - at, fields, block, reason
        at = end
    if bad >= 0:
        yield bad, len(data) - bad, None, None, why


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record or gap of the archives below ``path``: path, offset, length, kind (``record`` or ``gap``),
    fields, payload (the block after its HTTP header), reason (of a gap). A task holds one archive at a time."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "offset", "length", "kind", "fields", "payload", "reason"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.string()]
        for batch in batches:
            for i in range(batch.num_rows):
                name, rows, held = batch.column(0)[i].as_py(), [], 0
                for offset, length, fields, block, reason in salvage(batch.column(1)[i].as_py()):
                    payload = None if block is None else block[block.find(b"\r\n\r\n") + 4:] if block.startswith(b"HTTP/") else block
                    rows.append((name, offset, length, "gap" if fields is None else "record",
                                 None if fields is None else list(fields.items()), payload, reason))
                    held += len(payload or b"")
                    if held > 8 << 20 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return files.mapInArrow(run, "path string, offset long, length long, kind string, fields map<string,string>, "
                                 "payload binary, reason string")


def page_records(read: DataFrame, id_type: str = "long") -> DataFrame:
    """Per page record: page_id, payload_bytes, payload_digest (of responses, computed from the payload read), record_type, refers_to."""
    def page(field: str) -> Column:
        return F.regexp_extract(F.col("fields")[field], r"^<urn:page:(.*)>$", 1)

    def number(field: str) -> Column:
        return F.when(page(field) != "", page(field).cast(id_type))

    is_response = F.col("fields")["warc-type"] == "response"
    return read.where("kind = 'record'").select(
        number("warc-record-id").alias("page_id"),
        F.when(is_response, F.octet_length("payload").cast("long")).otherwise(F.col("fields")["warc-payload-length"].cast("long")).alias("payload_bytes"),
        F.when(is_response, base32_sha1(F.col("payload"))).otherwise(F.expr("substring(fields['warc-payload-digest'], 6)")).alias("payload_digest"),
        F.col("fields")["warc-type"].alias("record_type"), number("warc-refers-to").alias("refers_to"))
