"""WARC archives: written record by record, read back by a reader that survives damage.

Each record is a gzip member of its own. Spark's text sink writes the members, so archives go to
any file system Spark can write; its line separator is an empty gzip member, which decompresses to
nothing. The reader checks every member, header, length and payload digest. After a failed check it
looks for the next valid member or version line, goes on there, and logs the bytes between as
quarantined. It does the same inside a member that holds several records, and reads what a member
gives before its stream breaks.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.common import bounded_batches, columns_of, utf8

VERSION = b"WARC/1.1\r\n"
MIN_REVISIT_BYTES = 100
RECORDS_A_FILE = 2000
# Crawl times are not part of the pages; a record must name one.
DATE = "1970-01-01T00:00:00Z"
LEVEL = 1
_CHUNK = 1 << 16
_NOTHING = gzip.compress(b"", mtime=0)
_MAGIC = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"

_RECORDS = (
    "path string, start long, end long, fault string, page_id long, url string, record_type string, "
    "payload_bytes long, payload_digest string, refers_to long, payload binary")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit, which `refers_to` makes it, leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id} {digest}'.encode()).digest())}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else " ".join(url.split()),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Page-Id": page_id,
        "X-Payload-Length": len(payload),
        "X-Refers-To-Page-Id": refers_to,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if refers_to is not None:
        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return VERSION + head.encode() + b"\r\n" + block + _END


class Damaged(Exception):
    """A record or member that fails a check."""


def _parse(data: bytes, start: int) -> tuple[dict, int]:
    """The record that begins at `start`, checked, and where it ends."""
    if not data.startswith(b"WARC/1.", start):
        raise Damaged("no version line")
    head = data.find(_END, start)
    if head < 0:
        raise Damaged("header does not end")
    fields = {}
    for line in data[start:head].split(b"\r\n")[1:]:
        name, found, value = line.partition(b":")
        name = name.strip().lower().decode("latin-1")
        if not found:
            raise Damaged("header line without a name")
        if name in fields:
            raise Damaged("header field repeated")  # one record's header runs into the next
        fields[name] = value.strip().decode("utf-8", "replace")
    try:
        body = head + len(_END)
        end = body + int(fields["content-length"])
        page, refers = (fields.get(f) for f in ("x-page-id", "x-refers-to-page-id"))
        page, refers = None if page is None else int(page), None if refers is None else int(refers)
        length = int(fields.get("x-payload-length", -1))
    except (KeyError, ValueError) as error:
        raise Damaged("header field missing or not a number") from error
    if end < body or data[end : end + len(_END)] != _END:
        raise Damaged("record does not end where its length says")
    kind = fields.get("warc-type", "")
    payload = data[body:end].partition(_END)[2] if fields.get("content-type", "").startswith("application/http") else data[body:end]
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "revisit":
        payload = None
    else:
        if digest and hashlib.sha256(payload).hexdigest() != digest:
            raise Damaged("payload does not match its digest")
        length = len(payload)
    return {
        "page_id": page, "url": fields.get("warc-target-uri"), "record_type": kind, "payload_bytes": length,
        "payload_digest": digest, "refers_to": refers, "payload": payload,
    }, end + len(_END)


def _member(data: memoryview, start: int) -> tuple[bytes, int]:
    """What the gzip member at `start` holds, and where it ends."""
    inflate, out, at = zlib.decompressobj(31), [], start
    try:
        while not inflate.eof:
            if at >= len(data):
                raise Damaged("member does not end")
            out.append(inflate.decompress(data[at : at + _CHUNK]))
            at = min(at + _CHUNK, len(data))
    except zlib.error as error:
        raise Damaged("member does not inflate") from error
    return b"".join(out), at - len(inflate.unused_data)


def _before_break(data: memoryview, start: int, size: int | None = None) -> tuple[bytes, int]:
    """What a broken member gives before its stream fails, or its first `size` bytes, and where that ends."""
    inflate, out, held, at, step = zlib.decompressobj(31), [], 0, start, _CHUNK
    while at < len(data) and not inflate.eof and (size is None or held < size):
        before = inflate.copy() if step > 1 else None
        try:
            piece = inflate.decompress(data[at : at + step])
        except zlib.error:
            if before is None:
                break
            piece = None
        if before is not None and (piece is None or size is not None and held + len(piece) >= size):
            inflate, step = before, 1  # the place lies in this chunk: byte by byte
            continue
        out.append(piece)
        held += len(piece)
        at = min(at + step, len(data))
    return b"".join(out), at


def _inside(data: bytes) -> Iterator[tuple[int, int, str | None, dict | None]]:
    """(start, end, fault, record) of what a member holds; see `salvage`."""
    at, lost, fault = 0, None, None
    while at < len(data):
        try:
            one, end = _parse(data, at)
        except Damaged as error:
            if lost is None:
                lost, fault = at, str(error)
            at = data.find(b"WARC/1.", at + 1)
            at = len(data) if at < 0 else at
            continue
        if lost is not None:
            yield lost, at, fault, None
            lost = None
        yield at, end, None, one
        at = end
    if lost is not None:
        yield lost, len(data), fault, None


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict | None]]:
    """(start, end, fault, record) of all that is in an archive, in order.

    Valid records have no fault. Byte ranges that had to be given up have a fault and no record;
    what follows them is read on from the next member or version line that passes all checks. A
    range given up inside a member has the member's range, and its fault names the bytes of the
    member's content. Where a member's stream breaks, the records before the break are kept, and
    the range given up begins where the last of them ends.
    """
    view, at = memoryview(data), 0
    lost, fault = None, None
    while at < len(data):
        problem = None
        try:
            if data.startswith(_MAGIC, at):
                try:
                    inside, end = _member(view, at)
                except Damaged as error:
                    problem, (inside, _) = error, _before_break(view, at)
                found = list(_inside(inside))
                last = max((e for _, e, _, one in found if one), default=0)
                if inside and not last:
                    raise problem or Damaged(found[0][2])
                if problem:
                    if not last:
                        raise problem
                    found = [x for x in found if x[1] <= last]
                    end = _before_break(view, at, last)[1]
            else:
                one, end = _parse(data, at)
                found = [(at, end, None, one)]
        except Damaged as error:
            if lost is None:
                lost, fault = at, str(error)
            later = [p for p in (data.find(_MAGIC, at + 1), data.find(b"WARC/1.", at + 1)) if p >= 0]
            at = min(later, default=len(data))
            continue
        if lost is not None:
            yield lost, at, fault, None
            lost = None
        for s, e, gap, one in found:
            yield at, end, gap and f"{gap}: bytes {s} to {e} of the member's content", one
        at = end
        if problem and at < len(data):
            lost, fault = at, str(problem)
            later = [p for p in (data.find(_MAGIC, at), data.find(b"WARC/1.", at)) if p >= 0]
            at = min(later, default=len(data))
            if at == lost:
                lost = None
    if lost is not None:
        yield lost, len(data), fault, None


def _writer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("page_id", "url", "payload", "payload_digest", "refers_to")
    for batch in batches:
        members = []
        for row in zip(*columns_of(batch, *names)):
            members.append(gzip.compress(record(*row), LEVEL, mtime=0))
        yield pa.RecordBatch.from_pydict({"member": pa.array(members, pa.binary())})


def _reader(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"start": pa.int64(), "end": pa.int64(), "page_id": pa.int64(), "payload_bytes": pa.int64(),
                 "refers_to": pa.int64(), "payload": pa.binary()}
        names = [c.split()[0] for c in _RECORDS.split(", ")]
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, held = [], 0
                for start, end, fault, found in salvage(content.as_py()):
                    row = {"path": path, "start": start, "end": end, "fault": fault, **(found or {})}
                    if not with_payload:
                        row["payload"] = None
                    held += len(row.get("payload") or b"") + 500
                    rows.append(row)
                    if held > 1 << 22:
                        yield _batch(rows, names, kinds)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names, kinds)

    return read


def _batch(rows: list[dict], names: list[str], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        n: pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names})


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one record for each row of `pages` (page_id, url, html) to archives below `path`.

    Of rows with equal payloads of at least `min_revisit_bytes`, the smallest page_id is a response
    and the others revisit it. A null html is an empty payload. Rows that repeat the smallest
    page_id are all responses, and so are rows without a page_id if no row of the payload has one.
    Other columns are not read. No rows write no records.
    """
    bounded_batches(pages.sparkSession)
    payload = utf8("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    first = rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    referred = rows.join(first, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_digest",
        F.when(F.coalesce(F.col("page_id") != F.col("first_id"), F.lit(True)), F.col("first_id")).alias("refers_to"))
    members = referred.mapInArrow(_writer, "member binary").select(F.col("member").cast("string"))
    members.write.option("lineSep", _NOTHING.decode("latin-1")).option("encoding", "ISO-8859-1").option(
        "compression", "none").option("maxRecordsPerFile", RECORDS_A_FILE).text(path)


def read_archive(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives below `path`, and the byte ranges in quarantine.

    Rows with a `fault` are ranges [start, end) of a file that hold no valid record; the others are
    records. An empty file has no rows. `payload` is null for revisits, and for all rows if
    `payloads` is false. An archive is one task's work, so archives should stay below some 100 MB.
    """
    bounded_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_reader(payloads), _RECORDS)


def archived_pages(pages: DataFrame, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of `pages`, by way of archives."""
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path, payloads=False).where(F.col("fault").isNull()).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
