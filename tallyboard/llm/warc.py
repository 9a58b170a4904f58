"""WARC archives: records of pages, each equal payload stored once, and a reader that salvages damaged files.

Files are written by Spark's text writer, so its commit protocol holds and any store that Spark reaches will do. Plain
records end with a line end, which is the writer's separator. A gzip member ends with the high byte of its
length, zero below 16 MiB; that zero is the separator there. So the files hold nothing but records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyboard.llm.common import attach_groups, stored

VERSION = "WARC/1.1"
CRLF = b"\r\n"
#: Date of the records, where pages have none of their own.
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 5_000
#: A record that claims to be longer is taken as damaged.
MOST_RECORD_BYTES = 1 << 30
#: Bytes of payload that the reader hands on at once.
BYTES_AT_ONCE = 8 << 20

RESPONSE, REVISIT = "response", "revisit"


# ---- One record --------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    """SHA-1 in base 32, as the digest fields of archives have it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(
    kind: str, record_id: str, url: str | None, digest: str, size: int, payload: bytes | None, refers_to: str | None, date: str
) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone, which still tells the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if payload is None else head + payload
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{record_id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url) if url else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("WARC-Refers-To", f"<{refers_to}>" if refers_to is not None else None),
        ("WARC-Profile", REVISIT_PROFILE if kind == REVISIT else None),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"{VERSION}\r\n{lines}\r\n".encode() + block + CRLF + CRLF


def gzip_member(record: bytes) -> bytes:
    """A record as a member of its own. Past 16 MiB an empty member follows, so that the last byte is a zero all the same."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    member = packer.compress(record) + packer.flush()
    if member[-1]:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member += packer.compress(b"") + packer.flush()
    return member


# ---- Writing -----------------------------------------------------------------------


OWN = ("page_id", "url", "digest256")
WRITTEN = (*OWN, "sha1", "bytes", "copy", "first_id", "first_url", "payload")


def archive_rows(pages: DataFrame, page_id: str, url: str, payload: str, least_bytes: int) -> DataFrame:
    """What to write, a row per page: a response with its payload, or the page that it revisits and no payload."""
    full = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    keyed = full.select(
        "page_id",
        "url",
        F.sha2("payload", 256).alias("digest256"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("bytes"),
        "payload",
    )
    copies = stored(keyed.groupBy(*OWN, "sha1", "bytes").agg(F.count(F.lit(1)).alias("n")), "copies")
    groups = (
        copies.where(F.col("bytes") >= least_bytes)
        .groupBy("digest256")
        .agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("pages"), F.max(F.struct("page_id", "url")).alias("first"))
        .where("pages > 1")
    )
    # A crowded payload has a key for each of its pages here; what occurs once goes no further.
    placed = attach_groups(copies, groups, "digest256", "members", copies.count(), "page_id").where("pages > 1")
    leads = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    first = [F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url")]
    decided = stored(placed.select(*OWN, "sha1", "bytes", "n", leads.alias("leads"), *first), "decided")

    times = F.sequence(F.col("leads").cast("long"), F.col("n") - 1)
    revisits = decided.where("NOT leads OR n > 1").select(
        *OWN, "sha1", "bytes", F.explode(times).alias("copy"), "first_id", "first_url", F.lit(None).cast("binary").alias("payload")
    )

    def among(rows: DataFrame, condition: str, how: str) -> DataFrame:
        named = decided.where(condition).select(*[F.col(name).alias(f"_{name}") for name in OWN])
        return rows.join(named, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in OWN], how)

    kept = among(keyed, "NOT leads", "left_anti")
    if not decided.where("leads AND n > 1").isEmpty():  # rows repeated in full: one of them is the response
        once = among(kept, "leads AND n > 1", "left_semi").dropDuplicates(list(OWN))
        kept = among(kept, "leads AND n > 1", "left_anti").unionByName(once)
    responses = kept.withColumns(
        {"copy": F.lit(0).cast("long"), "first_id": F.lit(None).cast("long"), "first_url": F.lit(None).cast("string")}
    )
    return responses.select(*WRITTEN).unionByName(revisits.select(*WRITTEN))


def record_name(page_id: int | None, url: str | None, digest256: str, copy: int) -> str:
    """A record's id: the page's, and a digest that tells records of one page apart."""
    rest = hashlib.sha256(f"{url}\n{digest256}\n{copy}".encode()).hexdigest()[:16]
    return f"urn:pages:{'' if page_id is None else page_id}:{rest}"


def write_warc(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    compressed: bool = True,
    date: str = DATE,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write a record per page to WARC files under ``path``: gzip members, or plain.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the largest id (then URL) is a response, the others
    are revisits that refer to it and hold no payload. Payloads are equal if their lengths and SHA-256 digests are.

    A null payload is empty; a null id is the smallest, a null URL writes none. Rows repeated in full are
    a response and revisits of it. No row: files without records. Extra columns are ignored. Payloads are
    not shuffled while the revisits are few; none is gathered.
    """
    rows = archive_rows(pages, page_id, url, payload, least_bytes)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                members = [one(row) for row in batch.slice(at, 64).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["record"])

    def one(row: dict) -> bytes:
        key, again = row["digest256"], row["payload"] is None
        name = record_name(row["page_id"], row["url"], key, row["copy"])
        refers_to = record_name(row["first_id"], row["first_url"], key, 0) if again else None
        digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
        kind = REVISIT if again else RESPONSE
        record = record_bytes(kind, name, row["url"], digest, row["bytes"], row["payload"], refers_to, date)
        return gzip_member(record)[:-1] if compressed else record[:-2]

    ready = rows.mapInArrow(records, "record binary").select(F.col("record").cast("string").alias("value"))
    separator = "\u0000" if compressed else "\r\n"
    ready.write.option("lineSep", separator).option("maxRecordsPerFile", records_per_file).text(path)


# ---- Reading -----------------------------------------------------------------------

READ = (
    "file string, start long, length long, gap string, record_type string, record_id string, target_uri string, "
    "date string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)
_READ_ARROW = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("length", pa.int64())]
    + [(name, pa.string()) for name in ("gap", "record_type", "record_id", "target_uri", "date", "refers_to", "payload_digest")]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
)

#: Bytes of a member that are unpacked at once.
PIECE_BYTES = 16 << 10

MEMBER, LINE = b"\x1f\x8b\x08", b"WARC/1."


class Damaged(Exception):
    """What is wrong with a record; ``end`` tells where it ends, if its frame is sound."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.reason, self.end = reason, end


def parse_record(data: bytes, start: int) -> tuple[dict, int]:
    """The plain record at ``start`` and where it ends, after all checks."""
    if not re.compile(rb"WARC/1\.[01]\r\n").match(data, start):
        raise Damaged("version line")
    head_end = data.find(b"\r\n\r\n", start)
    if head_end < 0:
        raise Damaged("no end of header")
    fields = _fields(data[start:head_end])
    size = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size) or int(size) > MOST_RECORD_BYTES:
        raise Damaged("content length")
    block_start = head_end + 4
    end = block_start + int(size) + 4
    if data[end - 4 : end] != CRLF + CRLF:
        raise Damaged("cut off" if end > len(data) else "content length")
    if "warc-type" not in fields or "warc-record-id" not in fields:
        raise Damaged("header fields", end)
    block = data[block_start : end - 4]
    _check(fields.get("warc-block-digest"), block, "block digest", end)
    payload, told = block, None
    if fields.get("content-type", "").startswith("application/http"):
        http_head, _, payload = block.partition(b"\r\n\r\n")
        told = _fields(http_head).get("content-length")
    revisit = fields["warc-type"] == REVISIT
    if not revisit:
        _check(fields.get("warc-payload-digest"), payload, "payload digest", end)
    digest = fields.get("warc-payload-digest")
    told = int(told) if told is not None and re.fullmatch("[0-9]{1,18}", told) else None
    record = {
        "record_type": fields["warc-type"],
        "record_id": fields["warc-record-id"].strip("<>"),
        "target_uri": fields.get("warc-target-uri"),
        "date": fields.get("warc-date"),
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        "payload_digest": digest.partition(":")[2] if digest else None,
        "payload_bytes": told if revisit else len(payload),
        "payload": None if revisit else payload,
    }
    return record, end


def _fields(head: bytes) -> dict[str, str]:
    lines = re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", "replace")).split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _check(digest: str | None, data: bytes, what: str, end: int) -> None:
    kind, _, value = (digest or "").partition(":")
    if kind.lower() == "sha1" and value.upper() != payload_digest(data):
        raise Damaged(what, end)


def parse_member(data: bytes, start: int) -> tuple[dict | None, int]:
    """The record in the gzip member at ``start`` and where the member ends; None for an empty member."""
    unpacker, parts, at = zlib.decompressobj(31), [], start
    try:
        while not unpacker.eof and at < len(data):  # in pieces, as the unpacker copies what follows the member
            parts.append(unpacker.decompress(data[at : at + PIECE_BYTES]))
            at += PIECE_BYTES
            if sum(map(len, parts)) > MOST_RECORD_BYTES:
                raise Damaged("content length")
    except zlib.error:
        raise Damaged("gzip member") from None
    if not unpacker.eof:
        raise Damaged("cut off")
    plain, end = b"".join(parts), min(at, len(data)) - len(unpacker.unused_data)
    if not plain:
        return None, end
    try:
        record, used = parse_record(plain, 0)
    except Damaged as damage:
        raise Damaged(damage.reason, end) from None  # the member itself passed its checks
    if used != len(plain):
        raise Damaged("content length", end)
    return record, end


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | str]]:
    """(start, end, record) for each sound record of a file in order, (start, end, reason) for each gap between them.

    After a failed check the search goes on at the next gzip magic or version line, whichever comes first, until
    a record passes. If the frame was sound and only its content was not, that is at its end. Every byte is in one
    record or one gap, but for empty members and zeros between members.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            if data.startswith(MEMBER, at):
                found, end = parse_member(data, at)
            elif data.startswith(LINE, at):
                found, end = parse_record(data, at)
            elif gap is None and data[at] == 0:
                found, end = None, at + len(data[at:]) - len(data[at:].lstrip(b"\0"))
            else:
                raise Damaged("no record")
        except Damaged as damage:
            if gap is None:
                gap, reason = at, damage.reason
            if damage.end is not None:
                at = damage.end
            else:
                nexts = [i for i in (data.find(MEMBER, at + 1), data.find(LINE, at + 1)) if i >= 0]
                at = min(nexts, default=len(data))
            if damage.end is not None or at == len(data):
                yield gap, at, reason
                gap = None
            continue
        if gap is not None:
            yield gap, at, reason
            gap = None
        if found is not None:
            yield at, end, found
        at = end
    if gap is not None:
        yield gap, len(data), reason


def read_warc(spark: SparkSession, path: str, files: str | None = None) -> DataFrame:
    """Records and quarantined gaps of all WARC files under ``path``, gzip or plain.

    file, start, length (place in the file); gap: the first failed check, or null for a record; record_type, record_id,
    target_uri, date, refers_to; payload_digest (without its scheme), payload_bytes, payload (null for a
    revisit, whose bytes are those its HTTP head tells). Fields that a record lacks are null.

    A file is read in one task and held there, as Spark's binary source has it, below 2 GiB; files of ``write_warc`` are small.
    Empty files give no row. A record repeated in the files is given as often. ``files`` is a glob of file names.
    """
    reader = spark.read.format("binaryFile")
    if files:
        reader = reader.option("pathGlobFilter", files)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name = file.as_py()
                for start, end, found in salvage(content.as_py()):
                    place = {"file": name, "start": start, "length": end - start}
                    held.append(place | (found if isinstance(found, dict) else {"gap": found}))
                    size += len(held[-1].get("payload") or b"")
                    if size > BYTES_AT_ONCE or len(held) >= 5_000:
                        yield _read_batch(held)
                        held, size = [], 0
        yield _read_batch(held)

    return reader.load(path).select("path", "content").mapInArrow(read, READ)


def _read_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _READ_ARROW)


def records(found: DataFrame) -> DataFrame:
    return found.where("gap IS NULL").drop("gap")


def gaps(found: DataFrame) -> DataFrame:
    """The log of what was not readable: file, start, length, gap (the reason)."""
    return found.where("gap IS NOT NULL").select("file", "start", "length", "gap")
