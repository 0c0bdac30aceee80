"""Legacy archive converter: ARC files to WARC files, and the readers of both.

An ARC file begins with a filedesc record whose second line names the version; each further record is one
header line with as many fields as that version has, and as many bytes as the line's last field declares.
Every record becomes a WARC record: its identifier is derived from what identifies the ARC record, its
timestamp from the 14 digits of the header line, its type from the scheme and the payload, and digests are
computed. Records whose payload another record already has become revisits of that record.

Archives are written by the text sink (one record a row, the separator of records as line separator, files by
the bytes of their records), so they go to any file system that Spark writes to; they are read as binary files.
Bytes are never decoded.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

#: The header lines of both versions of the format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
FILEDESC = re.compile(rb"[0-9]+ [0-9]+ [^\n]*\nURL IP-address Archive-date")
#: Payloads of fewer bytes are never revisits; bytes of records that a batch holds; compressed bytes inflated at once;
#: bytes of a file before it is compressed (a record that is larger alone has a file of its own).
LEAST_BYTES, BATCH_BYTES, PIECE_BYTES, FILE_BYTES = 100, 8_000_000, 262_144, 64_000_000
PAGE_HEADER = b"X-Page-Id"
ROLLED = "file string, number long, value binary"


class Rolled:
    """Records of a task dealt out to files by their bytes, in batches for the sink."""

    def __init__(self, limit: int):
        self.limit, self.task, self.files, self.used, self.rows, self.size, self.number = limit, TaskContext.get().partitionId(), 0, 0, [], 0, 0

    def begins(self, size: int) -> bool:
        """Whether a record of so many bytes is the first of a new file."""
        if self.files and self.used + size <= self.limit:
            return False
        self.files, self.used = self.files + 1, 0
        return True

    @property
    def file(self) -> str:
        return f"{self.task:06d}-{self.files:06d}"

    def add(self, record: bytes) -> None:
        self.rows.append((self.file, self.number, record))
        self.number += 1
        self.used += len(record) + 4
        self.size += len(record)

    def full(self):
        if self.size > BATCH_BYTES:
            yield from self.rest()

    def rest(self):
        if self.rows:
            yield as_batch(self.rows, ROLLED)
        self.rows, self.size = [], 0


def write_rolled(rows: DataFrame, path: str, separator: str) -> None:
    """Rows of ROLLED as gzipped files, one for each name in "file", records in order of their number."""
    rows = rows.select("file", "number", F.col("value").cast("string").alias("value")).sortWithinPartitions("file", "number")
    rows.select("file", "value").write.partitionBy("file").option("lineSep", separator).option("compression", "gzip").text(path)


# -- ARC -------------------------------------------------------------------------------------------


def arc_head(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n".encode()
    fields = f"filedesc://{name} 0.0.0.0 {date} text/plain"
    if version == 2:
        fields += f" 200 - - 0 {name}"
    return f"{fields} {len(body)}\n".encode() + body


def arc_record(version: int, url: str, date: str, body: bytes, offset: int, name: str) -> bytes:
    fields = f"{url} 0.0.0.0 {date} text/html"
    if version == 2:
        fields += f" 200 {zlib.crc32(body):08x} - {offset} {name}"
    return f"{fields} {len(body)}\n".encode() + body


def http_body(page_id: int | None, payload: bytes) -> bytes:
    own = b"" if page_id is None else PAGE_HEADER + b": %d\r\n" % page_id
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + own + b"Content-Length: %d\r\n\r\n" % len(payload) + payload


def write_arc(pages: DataFrame, path: str, date: str = "20240131000000", limit: int = FILE_BYTES) -> None:
    """pages (page_id, url, html) as gzipped ARC files of so many bytes at most (before they are compressed; a larger page
    has a file of its own), of version 1 and 2 by turns. A null url is written as '-'; other columns are ignored."""

    def written(batches):
        out = Rolled(limit)
        for batch in batches:
            for page_id, url, html in zip(batch["page_id"].to_pylist(), batch["url"].to_pylist(), batch["html"], strict=True):
                body = http_body(page_id, html.as_buffer().to_pybytes() if html.is_valid else b"")
                url = quote(url or "-", safe=":/?#[]@!$&'()*+,;=%~")
                if out.begins(len(body) + len(url) + 200):
                    version, name = (out.task + out.files) % 2 + 1, f"part-{out.file}.arc"
                    out.add(arc_head(version, name, date))
                    offset = len(out.rows[-1][2]) + 1
                out.add(arc_record(version, url, date, body, offset, name))
                offset += len(out.rows[-1][2]) + 1
                yield from out.full()
        yield from out.rest()

    write_rolled(pages.select(F.col("page_id").cast("long"), "url", F.col("html").cast("binary").alias("html")).mapInArrow(written, ROLLED), path, "\n")


class Stream:
    """The content of a file, plain or of any number of gzip members, inflated piece by piece as it is read."""

    def __init__(self, data: bytes | memoryview):
        self.pieces, self.have, self.at = self.inflated(memoryview(data).cast("B")), b"", 0

    @staticmethod
    def inflated(data: memoryview):
        at = 0
        if data[:2] != b"\x1f\x8b":
            for at in range(0, len(data), PIECE_BYTES):
                yield bytes(data[at : at + PIECE_BYTES])
            return
        while data[at : at + 2] == b"\x1f\x8b":
            member = zlib.decompressobj(31)
            while not member.eof:
                if at >= len(data):
                    raise ValueError("a gzip member is cut short")
                piece = data[at : at + PIECE_BYTES]
                at += len(piece)
                yield member.decompress(piece)
            at -= len(member.unused_data)
        if any(bytes(data[k : k + PIECE_BYTES]).strip(b"\0") for k in range(at, len(data), PIECE_BYTES)):
            raise ValueError(f"byte {at} of the file begins no gzip member")

    def more(self) -> bool:
        """Whether there is a byte left."""
        while self.at >= len(self.have):
            piece = next(self.pieces, None)
            if piece is None:
                return False
            self.have, self.at = piece, 0
        return True

    def take(self, n: int) -> bytes:
        parts, left = [], n
        while left and self.more():
            parts.append(self.have[self.at : self.at + left])
            self.at += len(parts[-1])
            left -= len(parts[-1])
        if left:
            raise ValueError(f"the file ends {left} bytes before a record of {n} does")
        return parts[0] if len(parts) == 1 else b"".join(parts)

    def until(self, mark: bytes) -> bytes:
        """What is before the mark, which is passed."""
        while (end := self.have.find(mark, self.at)) < 0:
            piece = next(self.pieces, None)
            if piece is None:
                raise ValueError(f"the file ends within a header: {self.have[self.at :][:200]!r}")
            self.have, self.at = self.have[self.at :] + piece, 0
        found, self.at = self.have[self.at : end], end + len(mark)
        return found


def arc_records(file: Stream):
    """(fields by name, body) of each record but the filedesc ones; raises at a header line that can't be read and at a
    body shorter than declared, as nothing after it could be told apart."""
    names, first = ARC_FIELDS[1].split(), True
    while file.more():
        if file.have[file.at] in b"\r\n":
            file.at += 1
            continue
        line = file.until(b"\n")
        fields = line.decode("utf-8", "replace").rstrip("\r").split(" ")
        if not (fields[-1].isascii() and fields[-1].isdigit()):
            raise ValueError(f"no length in the header line {line[:200]!r}")
        body = file.take(int(fields[-1]))
        # A page may have such a URL too, but not such a body.
        if fields[0].startswith("filedesc://") and (first or FILEDESC.match(body)):
            lines, first = body.split(b"\n"), False
            names = lines[1].decode().split() if len(lines) > 1 and lines[1].strip() else ARC_FIELDS[int(body[:1] or b"1")].split()
            continue
        first = False
        if len(fields) > len(names):  # blanks inside the location or type
            fields = [*fields[: len(names) - 2], " ".join(fields[len(names) - 2 : -1]), fields[-1]]
        if len(fields) != len(names):
            raise ValueError(f"{len(fields)} fields, not {len(names)}, in the header line {line[:200]!r}")
        yield dict(zip(names, fields, strict=True)), body


def header(head: bytes, name: bytes) -> bytes | None:
    m = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*(.*?)\r?$", head)
    return m[1] if m else None


def timestamp(date: str) -> str:
    d = (re.sub(r"\D", "", date) + "00000101000000"[len(re.sub(r"\D", "", date)) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


#: The parts that are moved when records are compared, and what else a record has.
NARROW = "file string, place long, page_id long, record_id string, payload_bytes long, payload_digest string"
PARSED = NARROW + ", url string, date string, mime string, kind string, head binary, payload binary"


def parsed_records(file: Stream):
    """(page_id, record_id, url, date, mime, kind, head, payload) of each record of an ARC file."""
    for fields, body in arc_records(file):
        cut = body.find(b"\r\n\r\n") + 4 if body.startswith(b"HTTP/") else 0
        head, payload = body[: max(cut, 0)], body[max(cut, 0) :]
        page = header(head, PAGE_HEADER)
        own = hashlib.md5("|".join((fields["URL"], fields["Archive-date"])).encode() + hashlib.sha256(body).digest()).hexdigest()
        kind = "response" if cut else "resource"
        yield int(page) if page else None, f"<urn:uuid:{own[:8]}-{own[8:12]}-{own[12:16]}-{own[16:20]}-{own[20:]}>", fields["URL"], timestamp(fields["Archive-date"]), fields["Content-type"], kind, head, payload


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """path and content of the files of a folder and its folders, a row each."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of ARC files: what WARC needs of each, its file and place there; without payloads only what is narrow.
    A record's identifier is a hash of its header and body. A task holds one file as it lies on disk, and one batch of
    records; files are inflated piece by piece."""

    def parsed(batches):
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows, size = [], 0
                for place, (page, own, url, date, mime, kind, head, payload) in enumerate(parsed_records(Stream(content.as_buffer()))):
                    row = (name, place, page, own, len(payload), hashlib.sha256(payload).hexdigest())
                    rows.append((*row, url, date, mime, kind, head, payload) if payloads else row)
                    size += len(payload) if payloads else 500
                    if size > BATCH_BYTES:
                        yield as_batch(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield as_batch(rows, schema)

    schema = PARSED if payloads else NARROW
    return files_of(spark, path).mapInArrow(parsed, schema)


ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def as_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields])


# -- WARC ------------------------------------------------------------------------------------------


def warc_record(record: tuple, first_id: str | None) -> bytes:
    """The bytes of a record (of parsed_records) but for the two line ends after it. A revisit of first_id keeps the HTTP
    head, not the payload."""
    _, own, url, date, mime, kind, head, payload = record
    block = head + payload if first_id is None else head
    refers = "" if first_id is None else f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: {first_id}\r\n"
    lines = (
        f"WARC/1.1\r\nWARC-Type: {kind if first_id is None else 'revisit'}\r\nWARC-Record-ID: {own}\r\nWARC-Date: {date}\r\nWARC-Target-URI: {url}\r\n"
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}\r\nWARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}\r\n{refers}"
        f"Content-Type: {'application/http; msgtype=response' if kind == 'response' else mime}\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return lines.encode() + block


def revisits(narrow: DataFrame, scratch: Scratch, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """file, places, first_ids of the records that repeat an earlier one's payload of least_bytes or more: those of the
    smallest page id (and of these the smallest identifier) are what the others refer to. Payloads are not moved."""
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id")
    firsts = narrow.filter(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.min(key).alias("first"), F.count("*").alias("n")).filter("n > 1")
    # Kept as a table, so that its size is known: Spark sends it to all tasks if it is small and shuffles if not.
    firsts = scratch.keep(firsts.select("payload_digest", F.col("first.page_id").alias("first_page"), F.col("first.record_id").alias("first_id")), "firsts")
    again = narrow.join(firsts, "payload_digest").filter(~F.col("page_id").eqNullSafe(F.col("first_page")))
    of_file = again.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("place", "first_id"))).alias("r"))  # as many as a file has records
    return of_file.select("file", F.col("r.place").alias("places"), F.col("r.first_id").alias("first_ids"))


def convert(spark: SparkSession, arc: str, path: str, scratch: Scratch, least_bytes: int = LEAST_BYTES, limit: int = FILE_BYTES) -> None:
    """Writes the records of the ARC files in a folder as gzipped WARC files of so many bytes at most before they are
    compressed. Each archive meets the list of its own revisits, so that what is moved, if anything, are archives as they
    lie on disk, by their names: pages that many records share make no task larger."""
    again = revisits(scratch.keep(read_arc(spark, arc, payloads=False), "digests"), scratch, least_bytes)

    def written(batches):
        out = Rolled(limit)
        for batch in batches:
            for content, places, first_ids in zip(batch["content"], batch["places"].to_pylist(), batch["first_ids"].to_pylist(), strict=True):
                first = dict(zip(places or (), first_ids or (), strict=True))
                for place, record in enumerate(parsed_records(Stream(content.as_buffer()))):
                    data = warc_record(record, first.get(place))
                    out.begins(len(data) + 4)
                    out.add(data)
                    yield from out.full()
        yield from out.rest()

    archives = files_of(spark, arc).withColumnRenamed("path", "file").join(again, "file", "left").select("content", "places", "first_ids")
    write_rolled(archives.mapInArrow(written, ROLLED), path, "\r\n\r\n")


def warc_records(file: Stream):
    """(header lines, block) of each record, by the declared lengths; raises where there is no record, or part of one."""
    while file.more():
        head = file.until(b"\r\n\r\n") + b"\r\n"
        length = header(head, b"Content-Length")
        if not head.startswith(b"WARC/") or length is None or not length.isdigit():
            raise ValueError(f"no record begins with {head[:200]!r}")
        block = file.take(int(length))
        if file.take(4) != b"\r\n\r\n":
            raise ValueError(f"the block of {header(head, b'WARC-Record-ID')} is longer than declared")
        yield head, block


READ = "page_id long, url string, date string, record_id string, record_type string, refers_to_id string, payload_bytes long, payload_digest string"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files without their payloads. A revisit's payload length is what its HTTP head declares."""

    def parsed(batches):
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for lines, block in warc_records(Stream(content.as_buffer())):
                    get = lambda name, lines=lines: (header(lines, name) or b"").decode() or None
                    cut = block.find(b"\r\n\r\n") + 4 if block.startswith(b"HTTP/") else 0
                    head, payload = block[:cut], block[cut:]
                    page, kind = header(head, PAGE_HEADER), get(b"WARC-Type")
                    digest = get(b"WARC-Payload-Digest").removeprefix("sha256:")
                    if kind == "revisit":
                        size = int(header(head, b"Content-Length"))
                    else:
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{get(b'WARC-Record-ID')}: payload and digest differ")
                    rows.append((int(page) if page else None, get(b"WARC-Target-URI"), get(b"WARC-Date"), get(b"WARC-Record-ID"), kind, get(b"WARC-Refers-To"), size, digest))
                if rows:
                    yield as_batch(rows, READ)

    return files_of(spark, path).select("content").mapInArrow(parsed, READ)


def archived(pages: DataFrame) -> DataFrame:
    """pages through ARC and WARC files and back: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload. Rows repeated with the smallest id of a group are all responses; null ids come
    after all others (a group of them alone has only responses); other columns are ignored.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "warc")
    write_arc(pages, f"{scratch.root}/arc")
    convert(spark, f"{scratch.root}/arc", f"{scratch.root}/warc", scratch)
    back = scratch.keep(read_warc(spark, f"{scratch.root}/warc"), "back")
    for step in ("arc", "warc", "digests", "firsts"):
        scratch.drop(step)
    responses = back.filter("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")).groupBy("refers_to_id").agg(F.min("refers_to").alias("refers_to"))
    again = back.filter("refers_to_id is not null").join(responses, "refers_to_id", "left")
    others = back.filter("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    return again.unionByName(others).select("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_warc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM f
"""
