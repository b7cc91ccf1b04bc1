"""WARC archives: written by tasks, read back by byte ranges.

Archives are sequences of gzip members, one per record. They have no index, so
a reading task that gets a byte range scans it for the gzip magic, takes a
place for a member only if it inflates to a WARC header, and from there walks
from member to member. It owns the records that start inside its range and
reads past the range's end to finish the last one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import file_system, fresh_path, qualified, slices, stage

# Fixed values of the archive format.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

_CHUNK = 1 << 18
_RESULT = (
    "archive string, position bigint, record_type string, record_id string, refers_to string, "
    "url string, payload_bytes bigint, payload_digest string, payload binary"
)


def _field(text: str) -> str:
    """A header value without line ends or characters that are not visible ASCII."""
    return quote(text, safe="!#$&'()*+,/:;=?@[]~-._|^`{}<>\"\\")


def record(kind: str, record_id: str, refers_to: str | None, url: str | None, payload: bytes,
           digest: bytes) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if kind == "response" else b"")
    head = [
        VERSION.decode(), f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_field(url)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    plain = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(plain) + packer.flush()


def _heads(text: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in text.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


def parse(plain: bytes) -> dict:
    """The fields of an inflated record."""
    head, _, rest = plain.partition(b"\r\n\r\n")
    heads = _heads(head)
    block = rest[:int(heads.get("content-length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = heads.get("warc-type")
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:  # the payload lies elsewhere; its size and digest are on record here
        size = int(_heads(http).get("content-length", 0))
        digest = base64.b32decode(heads.get("warc-payload-digest", "").removeprefix("sha1:")).hex()
    url = heads.get("warc-target-uri")
    return {
        "record_type": kind, "record_id": heads.get("warc-record-id", "").strip("<>"),
        "refers_to": heads["warc-refers-to"].strip("<>") if "warc-refers-to" in heads else None,
        "url": None if url is None else unquote(url), "payload_bytes": size,
        "payload_digest": digest, "payload": payload if kind == "response" else None,
    }


class Members:
    """The gzip members of an archive that is open for reading at any place."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size

    def _read(self, at: int, count: int) -> bytes:
        self.source.seek(at)
        return self.source.read(min(count, self.size - at))

    def inflate(self, at: int) -> tuple[bytes, int] | None:
        """The record that starts at a place and the place behind it; None if none does."""
        unpacker, parts, place, checked = zlib.decompressobj(31), [], at, False
        while not unpacker.eof and place < self.size:
            chunk = self._read(place, _CHUNK)
            place += len(chunk)
            try:
                # The first bytes decide before the whole chunk is inflated.
                start = unpacker.decompress(chunk, 0 if checked else len(VERSION) + 2)
                if not checked:
                    if not start.startswith(b"WARC/1."):
                        return None
                    checked = True
                    start += unpacker.decompress(unpacker.unconsumed_tail)
            except zlib.error:
                return None
            parts.append(start)
        return (b"".join(parts), place - len(unpacker.unused_data)) if unpacker.eof else None

    def search(self, begin: int, end: int) -> Iterator[int]:
        """Places of the magic that begin in a range, in order."""
        at = begin
        while at < end:
            chunk = self._read(at, min(_CHUNK, end - at) + len(MAGIC) - 1)
            found = chunk.find(MAGIC)
            while 0 <= found < min(_CHUNK, end - at):
                yield at + found
                found = chunk.find(MAGIC, found + 1)
            at += _CHUNK

    def owned(self, begin: int, end: int, strict: bool = False) -> Iterator[tuple[int, bytes]]:
        """The records that start in a range.

        What cannot be inflated is passed over, or an error if ``strict``: members
        follow each other without gaps, so whoever owns a record also looks whether the next one
        can be read, and the first one must begin the archive.
        """
        place = begin
        while place < end:
            for candidate in self.search(place, end):
                if member := self.inflate(candidate):
                    break
            else:
                candidate = None
            if strict and place == 0 and candidate != 0:
                raise ValueError("damaged member at byte 0")
            if candidate is None:
                return
            while member:
                yield candidate, member[0]
                candidate = place = member[1]
                member = self.inflate(place) if place < min(end, self.size) else None
            if strict and place < self.size and (place < end or not self.inflate(place)):
                raise ValueError(f"damaged member at byte {place}")


def mark_revisits(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
    least_bytes: int = 1000,
) -> DataFrame:
    """id, url, payload (UTF-8, null as empty) and ``head``: the id of the response that has it.

    Of rows with equal payloads of ``least_bytes`` or more, the largest id is
    the head; null ids are below all others. ``head`` is null for what is
    written whole: shorter payloads, single ones, and every row with the
    largest id, should it repeat.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"),
        F.encode(F.coalesce(payload_col, F.lit("")), "UTF-8").alias("payload"),
    )
    digest, size = F.sha1("payload"), F.octet_length("payload")
    heads = (
        rows.where(size >= least_bytes)
        .select("id", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("size"))
        .groupBy("digest", "size")
        .agg(F.max("id").alias("head"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND head IS NOT NULL").drop("n")
    )
    keyed = rows.withColumns({"digest": digest, "size": size})
    head = F.when(~F.col("id").eqNullSafe(F.col("head")), F.col("head"))
    return keyed.join(heads, ["digest", "size"], "left").select(
        "id", "url", "payload", head.alias("head")
    )


def write_archives(
    records: DataFrame, target: str, *, archive_bytes: int = 1 << 30
) -> DataFrame:
    """Write rows of ``mark_revisits`` as archives below ``target``; one row per file.

    Each task writes its own files and starts a new one beyond
    ``archive_bytes``. Names are never used twice and only files of tasks that
    ended well are listed, so a task that is run again leaves no doubled record.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(target)
        stream, name, size, count = None, "", 0, 0

        def listed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"archive": [f"{target}/{name}"], "bytes": [size], "records": [count]}
            )

        for batch in slices(batches):
            columns = [batch.column(c).to_pylist() for c in ("id", "url", "payload", "head")]
            for page, url, payload, head in zip(*columns):
                if stream is None:
                    system.create_dir(folder, recursive=True)
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    stream = system.open_output_stream(f"{folder}/{name}", compression=None)
                kind = "response" if head is None else "revisit"
                ids = [f"urn:page:{'null' if n is None else n}" for n in (page, head)]
                member = record(kind, ids[0], ids[1], url, payload, hashlib.sha1(payload).digest())
                stream.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    stream.close()
                    stream = None
                    yield listed()
        if stream is not None:
            stream.close()
            yield listed()

    return stage(records.mapInArrow(write, "archive string, bytes bigint, records bigint"), "warc-list")


def read_archives(
    spark: SparkSession, archives: DataFrame, *, range_bytes: int = 32 << 20, strict: bool = False
) -> DataFrame:
    """All records of the archives listed in ``archives`` (archive, bytes).

    Files are read by ranges of ``range_bytes``, each by one task at a time.
    Columns: archive, position, record_type, record_id, refers_to, url,
    payload_bytes, payload_digest (bare lower-case hex SHA-1; of the payload
    itself for a response, as recorded for other types) and payload (null unless
    a response). A damaged member is passed over; with ``strict`` it is an error that names its
    archive and place, so that no record is lost unseen. No archives give no rows; a
    member that is itself a whole archive stored uncompressed inside a record
    cannot be told from a record where a range starts within it.
    """
    ranges = archives.where("bytes > 0").select(
        "archive", "bytes", F.explode(F.sequence(
            F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint")
        )).alias("begin"),
    )
    count = archives.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["archive", "position", "record_type", "record_id", "refers_to", "url",
                 "payload_bytes", "payload_digest", "payload"]
        schema = pa.schema(list(zip(names, [
            pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(),
            pa.int64(), pa.string(), pa.binary()])))
        for batch in batches:
            for row in batch.to_pylist():
                system, path = file_system(row["archive"])
                with system.open_input_file(path) as source:
                    rows, held = [], 0
                    end = min(row["begin"] + range_bytes, row["bytes"])
                    members = Members(source, row["bytes"])
                    for position, plain in members.owned(row["begin"], end, strict):
                        rows.append({"archive": row["archive"], "position": position} | parse(plain))
                        held += len(plain)
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    # A number of partitions given here is kept; small rows would else end up in one task.
    spread = ranges.repartition(min(int(count), 20_000), "archive", "begin")
    return spread.mapInArrow(read, _RESULT)


def archive_round_trip(pages: DataFrame, *, least_bytes: int = 1000, range_bytes: int = 32 << 20,
                       **columns) -> DataFrame:
    """Write every page as a WARC record and read all archives back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to (the
    page_id of the response, for revisits), url and payload. One row per page;
    null ids and repeated rows are written like others (see ``mark_revisits``),
    null payloads as empty ones, null URLs without the header. Ids are whole
    numbers. Extra columns are not looked at. No pages give no rows. A record is
    built and read as a whole: a task needs room for a few copies of the longest payload. An archive
    that cannot be read from end to end is an error.
    """
    spark = pages.sparkSession
    target = qualified(spark, fresh_path(spark, "warc"))
    archives = write_archives(mark_revisits(pages, least_bytes=least_bytes, **columns), target)
    records = read_archives(spark, archives, range_bytes=range_bytes, strict=True)

    def number(column: str) -> F.Column:
        text = F.regexp_extract(column, "^urn:page:(-?[0-9]+)$", 1)
        return F.when(text != "", text.cast("bigint"))

    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"), "url", "payload",
    )
