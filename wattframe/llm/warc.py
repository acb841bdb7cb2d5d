"""Web archives: pages written as WARC records in segments, and read back whole."""

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import own_folder, shuffle_partitions, written
from .token_files import open_file

#: Bytes of a record's block beyond which it goes on in continuation records.
SEGMENT_BYTES = 16_384
#: Bytes after which a task begins another file.
FILE_BYTES = 256_000_000
_CHUNK_BYTES = 4096
#: Tasks that the pages of one payload are dealt to.
_SALTS = 16
#: Fixed values of the formats.
_VERSION = b"WARC/1.1\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"

_RECORD = (
    "page_id long, url string, record_id string, record_type string, refers_to long, payload_digest string,"
    " payload_bytes long, payload binary, origin string, segment int, total long, complete boolean"
)
_FIELDS = [f.split()[0] for f in _RECORD.split(", ")]


def chunked(payload: bytes, size: int = _CHUNK_BYTES) -> bytes:
    """The payload in chunked transfer framing."""
    chunks = (payload[at : at + size] for at in range(0, len(payload), size))
    return b"".join(b"%x\r\n%s\r\n" % (len(chunk), chunk) for chunk in chunks) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        if body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("a chunk is cut short")
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """The payload of a whole HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head) else body


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, record_id: str, block: bytes, **fields: str | int | None) -> bytes:
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": _DATE}
    named |= {k.replace("_", "-"): v for k, v in fields.items() if v is not None}
    named["Content-Length"] = len(block)
    head = "".join(f"{k}: {v}\r\n" for k, v in named.items()).encode()
    squeeze = zlib.compressobj(1, wbits=31)
    return squeeze.compress(_VERSION + head + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


def _printable(url: str | None) -> str | None:
    return None if url is None else "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def _records(page, segment_bytes: int) -> tuple[bytes, list[bytes]]:
    """The record of a page, and its continuation records."""
    page_id, url, html, first, nth = page
    payload = (html or "").encode()
    digest = digest_of(payload)
    name = lambda page_id, nth=0: f"urn:page:{'' if page_id is None else page_id}:{digest}" + (f":{nth}" if nth else "")
    record_id = name(page_id, nth)
    fields = {"WARC_Target_URI": _printable(url), "WARC_Payload_Digest": f"sha1:{digest}", "X_Payload_Length": len(payload)}
    fields["X_Page_ID"] = page_id
    if first is not None and first != page_id:
        fields |= {"WARC_Profile": _REVISIT, "WARC_Refers_To": f"<{name(first)}>", "X_Refers_To_Page_ID": first}
        return _record("revisit", record_id, _HTTP, Content_Type="application/http; msgtype=response", **fields), []
    fields["Content_Type"] = "application/http; msgtype=response"
    block = _HTTP + chunked(payload)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        return _record("response", record_id, block, **fields), []
    more = []
    for number, part in enumerate(parts[1:], 2):
        total = len(block) if number == len(parts) else None
        own = {"WARC_Segment_Origin_ID": f"<{record_id}>", "WARC_Segment_Number": number, "WARC_Segment_Total_Length": total}
        more.append(_record("continuation", f"{record_id}/{number}", part, **own))
    return _record("response", record_id, parts[0], WARC_Segment_Number=1, **fields), more


def write_archives(
    pages: DataFrame, folder: str | None = None, revisit_from: int = 0, segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """Writes a record per row of ``pages`` (page_id, url, html); returns the files: path and records.

    The payload is the html in UTF-8, NULL as empty, in a chunked HTTP response.
    Of the rows with equal payloads of ``revisit_from`` bytes or more those with
    the smallest page_id are responses, the others revisit them; so rows that
    repeat a page_id and payload are of one kind, and told apart by their record
    ids. A row without page_id revisits one that has a page_id, and is a response
    if there is none. A block of more than ``segment_bytes`` goes on in
    continuation records, which go to other files than the record they belong to.
    Other columns are ignored. An empty table gives no files.

    The pages of one payload are dealt over several tasks. Each record is a gzip
    member of its own. A task writes to names that no other attempt uses; the
    returned table has those of the attempts that counted.
    """
    spark = pages.sparkSession
    folder = folder or own_folder(spark, "archives")
    rows = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html"))
    copies = rows.select("sha1", "page_id", F.octet_length("html").alias("size")).where(F.col("size") >= revisit_from)
    copies = copies.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    copies = copies.select("sha1", "first", salts.alias("salt"))
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("page_id"), F.lit(_SALTS)), F.lit(0)).cast("int"))
    same = Window.partitionBy("sha1", "salt", "page_id").orderBy(F.asc_nulls_first("url"))
    # joined first: the window then finds the pages dealt out as it needs them, so they are shuffled once
    rows = rows.join(copies, ["sha1", "salt"], "left").withColumn("nth", F.row_number().over(same) - 1)
    rows = rows.select("page_id", "url", "html", "first", "nth")
    files = rows.mapInArrow(_writer(folder, segment_bytes), "path string, records long")
    return written(files, "archive-manifest")


def _writer(folder: str, segment_bytes: int):
    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        open_: dict[str, tuple] = {}
        done: list[tuple[str, int]] = []

        def put(kind: str, record: bytes) -> None:
            stream, name, n, size = open_.get(kind) or (None, "", 0, 0)
            if stream is None:
                name = f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}-{len(done)}-{kind}.warc.gz"
                system, place = open_file(name)
                system.create_dir(place.rpartition("/")[0], recursive=True)
                stream = system.open_output_stream(place, compression=None)
            stream.write(record)
            open_[kind] = (stream, name, n + 1, size + len(record))
            if size + len(record) > FILE_BYTES:
                shut(kind)

        def shut(kind: str) -> None:
            stream, name, n, _ = open_.pop(kind)
            stream.close()
            done.append((name, n))

        for frame in frames:
            for page in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                record, more = _records(page, segment_bytes)
                put("first", record)
                for part in more:
                    put("more", part)
        for kind in list(open_):
            shut(kind)
        if done:
            arrays = [pa.array([n for n, _ in done]), pa.array([n for _, n in done], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["path", "records"])

    return write


def records_in(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case names, and blocks of an archive's records, one after the other."""
    system, name = open_file(path)
    with system.open_input_stream(name, compression=None) as file:
        unzip, data = zlib.decompressobj(wbits=31), bytearray()
        raw = b""
        ended = False

        def more() -> bool:
            nonlocal raw, unzip, ended
            if unzip.eof:
                raw = unzip.unused_data or raw
                unzip = zlib.decompressobj(wbits=31)
            if not raw:
                raw = file.read(1 << 20)
                if not raw:
                    ended = True
                    return False
            data.extend(unzip.decompress(raw))
            raw = unzip.unused_data if unzip.eof else b""
            return True

        while True:
            while (end := data.find(b"\r\n\r\n")) < 0:
                if not more():
                    if data.strip():
                        raise ValueError(f"{path} ends within a record")
                    return
            lines = bytes(data[:end]).decode().split("\r\n")
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"{path} has a record without version")
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
            size = end + 4 + int(fields["content-length"])
            while len(data) < size + 4:
                if not more():
                    raise ValueError(f"{path} ends within a record")
            block = bytes(data[end + 4 : size])
            del data[: size + 4]
            yield fields, block


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """The pages of archives that ``files`` (path) names, one row per response or revisit.

    Continuation records are grouped by the record they continue, ordered by
    segment number, and put together; only records in segments are shuffled, and
    a group is one record. ``complete`` says whether all segments are there,
    their length is the stated total, the chunked framing decodes and the
    payload has the stated digest. Length and digest of a response are those of
    the decoded payload, of a revisit those that it states. A group that can't be
    put together is kept, with NULL for what it lacks. ``payloads=False`` leaves
    out the payload itself.

    Returns page_id, url, record_id, record_type, refers_to, payload_digest,
    payload_bytes, payload and complete.
    """
    spread = files.select("path").repartition(shuffle_partitions(files.sparkSession))
    records = written(spread.mapInArrow(_reader(payloads), _RECORD), "records")
    out = [f for f in _FIELDS if f not in ("origin", "segment", "total")]
    whole = records.where("segment IS NULL").select(*out)
    segments = records.where("segment IS NOT NULL").groupBy("origin").applyInArrow(_joined(payloads), _RECORD)
    return whole.unionByName(segments.select(*out))


def _reader(payloads: bool):
    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for frame in frames:
            for path in frame.column(0).to_pylist():
                for fields, block in records_in(path):
                    if row := _row(fields, block, payloads):
                        rows.append(row)
                        size += 200 + len(row["payload"] or b"")
                    if size > 8_000_000:
                        yield _batch(rows)
                        rows, size = [], 0
        yield _batch(rows)

    return read


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in _RECORD.split(", "))])
    return pa.RecordBatch.from_pylist(rows, schema)


def _row(fields: dict[str, str], block: bytes, payloads: bool) -> dict | None:
    kind = fields["warc-type"]
    if kind not in ("response", "revisit", "continuation"):
        return None
    row = dict.fromkeys(_FIELDS)
    row["record_id"] = fields["warc-record-id"].strip("<>")
    row["record_type"] = kind
    row["segment"] = _number(fields.get("warc-segment-number"))
    row["total"] = _number(fields.get("warc-segment-total-length"))
    row["origin"] = fields.get("warc-segment-origin-id", fields["warc-record-id"]).strip("<>")
    row["url"] = fields.get("warc-target-uri")
    row["page_id"] = _number(fields.get("x-page-id"))
    row["refers_to"] = _number(fields.get("x-refers-to-page-id"))
    row["payload_digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "revisit":
        row["payload_bytes"], row["complete"] = _number(fields.get("x-payload-length")), True
    elif row["segment"] is None:
        _decode(row, block, payloads)
    else:
        row["payload"] = block
    return row


def _decode(row: dict, block: bytes, payloads: bool) -> None:
    """Fills in what a response's whole block says."""
    stated = row["payload_digest"]
    try:
        payload = payload_of(block)
    except ValueError:
        row.update(payload=None, payload_bytes=None, complete=False)
        return
    row.update(payload_bytes=len(payload), payload_digest=digest_of(payload), payload=payload if payloads else None)
    row["complete"] = stated in (None, row["payload_digest"])


def _joined(payloads: bool):
    def join(group: pa.Table) -> pa.Table:
        segments = sorted(group.to_pylist(), key=lambda row: row["segment"])
        row = next((s for s in segments if s["record_type"] == "response"), None)
        total = next((s["total"] for s in segments if s["total"] is not None), None)
        numbers = [s["segment"] for s in segments]
        block = b"".join(s["payload"] for s in segments)
        row = row or dict.fromkeys(_FIELDS) | {"record_id": segments[0]["origin"], "record_type": "response"}
        if numbers == list(range(1, len(numbers) + 1)) and len(block) == total:
            _decode(row, block, payloads)
        else:
            row.update(payload=None, payload_bytes=None, complete=False)
        return pa.Table.from_batches([_batch([row])])

    return join
