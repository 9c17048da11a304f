"""Web archives: writing WARC records with revisits, and reading archives that may be damaged.

Writing is Spark's own: a record is a row of the text writer, so archives land wherever Spark can write. By default each
record is a gzip member of its own, so that damage to a file costs the records it touches. In a plain archive the two line
ends that close a record are the writer's line separator; between members it is the zero byte that each ends with. Of
records with equal payloads one is the response and the others revisit it.

The reader takes archives as they are, plain or with gzip members of one or more records. A record counts once its version
line, its length, the closing line ends and its digests hold. After a failed check it searches for the next version line or
member whose record passes, goes on from there, and gives back the bytes between as a gap with the reason. The other
records of a member with such a gap are kept, and of a member that does not decompress to its checksum those that came out
whole; of these, a record without a SHA-1 block digest to confirm it has the header ``salvaged`` with the value
``unverified``.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.shared import shared_folder, table

_END = b"\r\n\r\n"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_MEMBER = b"\x1f\x8b\x08"
_NO_RECORD = zlib.compress(b"", wbits=31)
#: Bytes given to zlib at once.
_STEP = 4096
#: Records in an archive file at most.
FILE_RECORDS = 2_000
_READ = "file string, offset long, length long, problem string, headers map<string,string>, block binary"


def base32(hex_digest: Column) -> Column:
    """40 hexadecimal digits in base 32 with the letters of RFC 4648."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _sha1(text: Column) -> Column:
    return base32(F.sha1(text.cast("binary")))


def as_records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z", least_bytes: int = 0) -> DataFrame:
    """A column ``record`` with a WARC record for each row of ``pages`` (page_id, url, html; others are ignored).

    Null html is an empty payload; a null url is left out, line ends in urls too. Of rows with equal payloads of at least
    ``least_bytes`` bytes, those with the largest page_id are responses (repeated rows all are) and the others revisit it;
    null ids are below all others, and all are responses if no row has an id.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", _sha1(F.col("html")))
    largest = rows.groupBy(F.col("digest").alias("of")).agg(F.max("page_id").alias("largest"))
    joined = rows.join(largest, F.col("digest") == F.col("of"))
    size = F.octet_length("html")
    revisit = (size >= least_bytes) & F.col("largest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("largest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    blocks = (
        joined.withColumn("revisit", revisit)
        .withColumn("block", F.when(F.col("revisit"), http).otherwise(F.concat(http, "html")))
        .withColumn("block_digest", _sha1(F.col("block")))
    )
    identity = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", identity(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", "")),
        line("WARC-Refers-To", F.when(F.col("revisit"), identity(F.col("largest")))),
        line("WARC-Profile", F.when(F.col("revisit"), "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), "block_digest")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    return blocks.select(F.concat(head, "block").alias("record"))


def _as_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member without its last byte, which is zero.

    The byte is the highest of the length. A record of 16 MiB or more is followed by a member of nothing, which ends in zero.
    """
    for batch in batches:
        members: list[bytes] = []
        held = 0
        for record in batch.column("record"):
            member = zlib.compress(record.as_py().encode() + _END, wbits=31)
            members.append((member if member[-1] == 0 else member + _NO_RECORD)[:-1])
            held += len(members[-1])
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["record"])
                members, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["record"])


def write_archives(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Archive files of up to ``FILE_RECORDS`` records in the folder ``path``: a member for each, or plain (``none``)."""
    end = _END.decode()
    if compression == "gzip":
        records = records.mapInArrow(_as_members, "record binary").select(F.col("record").cast("string"))
        compression, end = "none", "\0"
    writer = records.write.option("lineSep", end).option("maxRecordsPerFile", FILE_RECORDS)
    writer.option("compression", compression).text(path)


@dataclass
class Piece:
    """A record, or a gap (then with a problem and nothing else)."""

    offset: int
    length: int
    problem: str | None = None
    headers: dict[str, str] | None = None
    block: bytes | None = None


class Damaged(Exception):
    pass


def _digest_holds(headers: dict[str, str], name: str, data: bytes) -> bool:
    kind, _, value = headers.get(name, "").partition(":")
    if kind.lower() != "sha1":
        return True
    own = hashlib.sha1(data)
    return value.upper() == base64.b32encode(own.digest()).decode() or value.lower() == own.hexdigest()


def parse_record(data: bytes, at: int) -> Piece:
    """The record that begins at a byte, if it is whole; else :class:`Damaged`."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    body = data.find(_END, version.end() - 2)
    if body < 0:
        raise Damaged("header without an end")
    headers: dict[str, str] = {}
    for row in data[version.end() : body].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if row and not colon:
            raise Damaged("header line without a colon")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise Damaged("no length")
    begin = body + len(_END)
    end = begin + int(size)
    if end > len(data):
        raise Damaged("cut off")
    if data[end : end + len(_END)] != _END:
        raise Damaged("length does not fit")
    block = data[begin:end]
    if not _digest_holds(headers, "warc-block-digest", block):
        raise Damaged("block digest differs")
    if headers.get("warc-type") == "response" and not _digest_holds(headers, "warc-payload-digest", payload_of(block)[1]):
        raise Damaged("payload digest differs")
    return Piece(at, end + len(_END) - at, None, headers, block)


def payload_of(block: bytes) -> tuple[dict[str, str], bytes]:
    """The HTTP headers of a block, and what follows them."""
    head, found, rest = block.partition(_END)
    if not found:
        return {}, block
    rows = (row.partition(b":") for row in head.split(b"\r\n")[1:])
    return {k.decode("utf-8", "replace").strip().lower(): v.decode("utf-8", "replace").strip() for k, _, v in rows}, rest


def _plain(data: bytes) -> Iterator[Piece]:
    at = gap = 0
    problem: str | None = None
    while at < len(data):
        try:
            piece = parse_record(data, at)
        except Damaged as why:
            problem = problem or str(why)
            found = _VERSION.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if problem:
            yield Piece(gap, at - gap, problem)
            problem = None
        yield piece
        at = gap = at + piece.length
    if problem:
        yield Piece(gap, len(data) - gap, problem)


def _inflated(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What the gzip member at a byte gives, where it ends, and what is wrong with it."""
    reader, parts, i = zlib.decompressobj(wbits=31), [], at
    while i < len(data) and not reader.eof:
        before = reader.copy()
        try:
            parts.append(reader.decompress(data[i : i + _STEP]))
        except zlib.error as why:
            parts.append(_until_fault(before, data[i : i + _STEP]))
            return b"".join(parts), len(data), f"member does not decompress: {why}"
        i += _STEP
    end = min(i, len(data)) - len(reader.unused_data)
    return b"".join(parts), end, None if reader.eof else "member is cut off"


def _until_fault(reader, data: bytes) -> bytes:
    """What bytes that do not decompress give before the fault: by input bytes, the last one by output bytes."""
    parts = []
    for i in range(len(data)):
        before = reader.copy()
        try:
            parts.append(reader.decompress(data[i : i + 1]))
        except zlib.error:
            rest, out = data[i : i + 1], b""
            with contextlib.suppress(zlib.error):
                while rest or out:
                    out = before.decompress(rest, 1)
                    rest = before.unconsumed_tail
                    parts.append(out)
            break
    return b"".join(parts)


def _unverified(headers: dict[str, str]) -> dict[str, str]:
    """The headers of a record of a damaged member, marked unless a digest of the block was compared."""
    verified = headers.get("warc-block-digest", "").lower().startswith("sha1:")
    return headers if verified else headers | {"salvaged": "unverified"}


def _members(data: bytes) -> Iterator[Piece]:
    at = gap = 0
    problem: str | None = None
    while at < len(data):
        if not data.startswith(_MEMBER, at):
            problem = problem or "no member"
            found = data.find(_MEMBER, at + 1)
            at = found if found >= 0 else len(data)
            continue
        inside, end, fault = _inflated(data, at)
        pieces = list(_plain(inside))
        whole = [p for p in pieces if not p.problem]
        if fault:
            problem = problem or fault
            yield from (Piece(at, 0, None, _unverified(p.headers), p.block) for p in whole)
            found = data.find(_MEMBER, at + 1)
            at = found if found >= 0 else len(data)
            continue
        while data.startswith(_NO_RECORD, end):
            end += len(_NO_RECORD)
        if not pieces or len(whole) < len(pieces):
            # The member's bytes are the gap's; the records in it are as sound as in a plain archive.
            problem = problem or next((p.problem for p in pieces if p.problem), "empty member")
            yield from (Piece(at, 0, None, p.headers, p.block) for p in whole)
            at = end
            continue
        if problem:
            yield Piece(gap, at - gap, problem)
            problem = None
        yield from (Piece(at, end - at, None, p.headers, p.block) for p in pieces)
        at = gap = end
    if problem:
        yield Piece(gap, len(data) - gap, problem)


def salvage(data: bytes) -> Iterator[Piece]:
    """The records of an archive in order, and the gaps between them; together they cover all its bytes.

    An archive is taken as compressed if it begins with a member, or has one but no version line that a record follows.
    """
    plain = data.startswith(b"WARC/") or not data.startswith(_MEMBER) and (_MEMBER not in data or bool(_VERSION.search(data)))
    return _plain(data) if plain else _members(data)


def _salvaged(blocks: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
        names = ["file", "offset", "length", "problem", "headers", "block"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows: list[tuple] = []
                held = 0
                for p in salvage(content.as_py() or b""):
                    block = p.block if blocks or p.block is None else p.block.partition(_END)[0] + _END
                    if p.headers is not None and not blocks:
                        p.headers["payload-bytes"] = str(len(payload_of(p.block)[1]))
                    rows.append((file, p.offset, p.length, p.problem, list(p.headers.items()) if p.headers else None, block))
                    held += len(block or b"")
                    if held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    return read


def read_archives(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """A row for each record and each gap of the archives in a folder: file, offset, length, ``problem`` (of a gap),
    ``headers`` (names in lower case) and ``block``.

    Without ``blocks``, only the HTTP head of a block is given back, and the bytes of the payload as the header
    ``payload-bytes``. Offsets are those in the file; the records of a compressed archive have their members'. Empty files
    give no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_salvaged(blocks), _READ)


def pages_of(records: DataFrame) -> DataFrame:
    """What the records written by :func:`as_records` tell about their pages; gaps are left out.

    A revisit's payload is that of its response: the length is in its HTTP head, the digest in its headers.
    """
    header = lambda name: F.element_at("headers", name)
    page = lambda c: F.nullif(F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1), F.lit("")).cast("long")
    revisit = header("warc-type") == "revisit"
    told = F.regexp_extract(F.col("block").cast("string"), "(?i)\r\nContent-Length: *([0-9]+)\r\n", 1)
    return records.filter(F.col("problem").isNull()).select(
        page(header("warc-record-id")).alias("page_id"),
        F.when(revisit, told).otherwise(header("payload-bytes")).cast("long").alias("payload_bytes"),
        F.regexp_replace(header("warc-payload-digest"), "^sha1:", "").alias("payload_digest"),
        header("warc-type").alias("record_type"),
        F.when(revisit, page(header("warc-refers-to"))).alias("refers_to"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as archives in the shared folder, and read back."""
    path = f"{shared_folder(spark)}/gridspark-llm/warc-{uuid.uuid4().hex}"
    write_archives(as_records(table(spark, sf_dir, "pages")), path)
    return pages_of(read_archives(spark, path, blocks=False))


OP7_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(encode(coalesce(html, ''))) AS h FROM pages
),
coded AS (
  SELECT page_id, payload_bytes, h, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(h, (5 * (i // 4) + 1)::BIGINT, 5))::BIGINT >> (5 * (3 - i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest
  FROM hashed
),
largest AS (SELECT h, max(page_id) AS largest FROM hashed GROUP BY h)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN largest IS NULL OR page_id IS NOT DISTINCT FROM largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN largest IS NULL OR page_id IS NOT DISTINCT FROM largest THEN NULL ELSE largest END AS refers_to
FROM coded JOIN largest USING (h)
"""
