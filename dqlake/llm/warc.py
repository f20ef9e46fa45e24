"""WARC archives by a chunked record table: oversized payloads travel as rows of record id and chunk number.

A payload above the chunk size becomes a first segment and ``continuation`` records, as the format defines them, so neither
the writer's rows, nor a record in the archive, nor the reader's rows ever hold more than one chunk of it. Digests are carried
from chunk to chunk. Spark's text writer writes the files (records end with CRLF CRLF, its line separator here), so commits,
retries and the file system are Spark's; archives hold a bounded number of records and are gzip-compressed whole.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqlake.llm.common import _written, free, shared_folder, stage, table

CHUNK = 64 * 1024
RECORDS_PER_FILE = 1024  # with CHUNK, a bound on an archive's size: 64 MB before compression
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = b"\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
RECORDS = "record_id string, page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
CHUNKS = RECORDS + ", chunk int, part int, data binary"


def base32_sha1(payload: Column) -> Column:
    digest = F.sha1(payload)
    letters = []
    for five in range(8):
        value = F.conv(F.substring(digest, five * 5 + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def with_types(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """Adds payload digest and the id that the record revisits (null: it is a response)."""
    digest, keeper, of = free(pages, "_digest", "_keeper", "_of")
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    keyed = pages.withColumn(digest, base32_sha1(payload))
    groups = keyed.filter(F.octet_length(payload) >= min_bytes).groupBy(F.col(digest).alias(of))
    repeated = groups.agg(F.max(id_col).alias(keeper), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    repeated = stage(repeated, "repeated-payloads")
    met = keyed.join(repeated, (F.col(digest) == F.col(of)) & (F.octet_length(payload) >= min_bytes), "left")
    other = F.when(~F.col(id_col).eqNullSafe(F.col(keeper)), F.col(keeper))
    return met.withColumn("_refers", other).withColumnRenamed(digest, "_payload_digest")


def record(head: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*head, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def cut(payload: memoryview, size: int) -> Iterator[memoryview]:
    """Pieces of at most ``size`` bytes that do not split a character (text rows hold whole characters)."""
    at = 0
    while True:
        end = min(at + size, len(payload))
        while end < len(payload) and end > at + 4 and payload[end] & 0xC0 == 0x80:
            end -= 1
        yield payload[at:end]
        at = end
        if at >= len(payload):
            return


def line_safe(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def records(date: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of pages to rows that are one archive record each, without the final separator."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, digests, others, numbers = (batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "refers", "number"))
            payloads, out, held = batch.column("payload"), [], 0
            for i, (page_id, url, digest, other, number) in enumerate(zip(ids, urls, digests, others, numbers, strict=True)):
                buffer = payloads[i].as_buffer()
                payload = memoryview(buffer or b"")
                target = line_safe(url) if url else f"urn:x-page:{page_id}"
                name = f"{'' if page_id is None else page_id}:{digest}:{number}"
                base = [("WARC-Record-ID", f"<urn:x-page:{name}>"), ("WARC-Date", date), ("WARC-Target-URI", target),
                        ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
                if url is None:
                    base.append(("X-No-Target", "1"))
                if other is not None:
                    out.append(record([("WARC-Type", "revisit"), *base, ("WARC-Refers-To", f"<urn:x-page:{other}:{digest}>"),
                                       ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")], b""))
                    continue
                for k, piece in enumerate(cut(payload, size)):
                    segment = [("WARC-Segment-Number", str(k + 1))] if len(payload) > size else []
                    if k:
                        head = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:x-page:{name}:{k + 1}>"), *base[1:],
                                ("WARC-Segment-Origin-ID", f"<urn:x-page:{name}>")]
                        out.append(record(head + segment, bytes(piece)))
                    else:
                        head = [("WARC-Type", "response"), *base, ("Content-Type", "application/http; msgtype=response")]
                        out.append(record(head + segment, HTTP + bytes(piece)))
                    held += len(out[-1])
                    if held > 16 * size:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                        out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
    return run


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0,
    chunk: int = CHUNK, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write one record per page below ``path``.

    Of pages with equal payloads of at least ``min_bytes`` bytes, that with the largest id is a response and the others are
    revisits of it; smaller payloads are all responses. A null payload is an empty one, a null url becomes a name made from the
    id, a page without id is never the largest. Every row is a record with a name of its own, also when rows repeat; the rows of the
    largest id are all responses. Other columns of ``pages`` are ignored. An empty table gives a folder without records.

    Payloads are not shuffled unless the table of repeated digests is too large to broadcast; then they move once, and a payload
    that a third of all pages share is split as a skewed join.
    """
    spark = pages.sparkSession
    typed = with_types(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(payload_col).cast("binary").alias("payload")), "page_id", "payload", min_bytes)
    rows = typed.select("page_id", "url", F.col("_payload_digest").alias("digest"), F.col("_refers").alias("refers"), "payload", F.monotonically_increasing_id().alias("number"))
    out = rows.mapInArrow(records(date, chunk), "record binary")
    (out.select(F.col("record").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))
    _written[path] = spark


class Archive:
    """Bytes of one compressed archive, read forward; never more than a chunk is held unpacked."""

    def __init__(self, content: pa.Buffer, size: int) -> None:
        self.view, self.at, self.size = memoryview(content), 0, size
        self.unpack, self.held = zlib.decompressobj(31), bytearray()

    def fill(self) -> bool:
        while True:
            if self.unpack.eof:
                rest = self.unpack.unused_data
                self.at -= len(rest)
                if self.at >= len(self.view):
                    return False
                self.unpack = zlib.decompressobj(31)
            source = self.unpack.unconsumed_tail
            if not source:
                source = self.view[self.at:self.at + 65536]
                self.at += len(source)
                if not source:
                    if not self.unpack.eof:
                        raise ValueError("archive ends within its compressed data")
                    return False
            got = self.unpack.decompress(source, self.size)
            if got:
                self.held += got
                return True

    def head(self) -> dict[str, str] | None:
        """Fields of the next record, null at the end; names in lower case."""
        while (end := self.held.find(END)) < 0:
            if not self.fill():
                if self.held.strip():
                    raise ValueError("archive ends within a record's head")
                return None
        lines = bytes(self.held[:end]).decode().split("\r\n")
        del self.held[:end + 4]
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}

    def block(self, length: int) -> Iterator[bytes]:
        """The block in pieces, then past the record's end."""
        while length:
            if not self.held and not self.fill():
                raise ValueError("archive ends within a block")
            piece = bytes(self.held[:min(length, self.size)])
            del self.held[:len(piece)]
            length -= len(piece)
            yield piece
        while len(self.held) < 4 and self.fill():
            pass
        if bytes(self.held[:4]) != END:
            raise ValueError("record without its end")
        del self.held[:4]


def name_of(uri: str) -> tuple[str, int | None]:
    name = uri.strip("<>")
    key = name.removeprefix("urn:x-page:").split(":")[0]
    return name, int(key) if key else None


def without_http(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """A response's block without its protocol head."""
    held = b""
    for piece in pieces:
        if held is None:
            yield piece
            continue
        held += piece
        if (end := held.find(END)) >= 0:
            if rest := held[end + 4:]:
                yield rest
            held = None


def parse(size: int, payloads: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Archives to chunk rows; without ``payloads``, records of one segment come as one row with their digest instead."""
    names = [c.split()[0] for c in CHUNKS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.binary()]

    def rows_of(content: pa.Buffer) -> Iterator[tuple]:
        archive = Archive(content, size)
        while (head := archive.head()) is not None:
            segment = int(head.get("warc-segment-number", "0"))
            name, page_id = name_of(head.get("warc-segment-origin-id") or head["warc-record-id"])
            kind = head["warc-type"]
            other = name_of(head["warc-refers-to"])[1] if "warc-refers-to" in head else None
            url = None if "x-no-target" in head else head["warc-target-uri"]
            stated = int(head["x-payload-length"]), head["warc-payload-digest"].removeprefix("sha1:")
            fixed = (name, page_id, url, "response" if kind == "continuation" else kind, other)
            pieces = archive.block(int(head["content-length"]))
            pieces = without_http(pieces) if kind == "response" else pieces
            if kind == "revisit":
                for _ in pieces:
                    pass
                yield *fixed, *stated, 0, 0, None
            elif segment or payloads:
                part = -1
                for part, piece in enumerate(pieces):
                    yield *fixed, *stated, segment, part, piece
                if part < 0:
                    yield *fixed, *stated, segment, 0, b""
            else:
                digest, length = hashlib.sha1(), 0
                for piece in pieces:
                    digest.update(piece)
                    length += len(piece)
                found = length, base64.b32encode(digest.digest()).decode()
                if found != stated:
                    raise ValueError(f"{name}: {found} is not the stated {stated}")
                yield *fixed, *found, 0, 0, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch_of = lambda out: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
        out, held = [], 0
        for batch in batches:
            for content in batch.column("content"):
                for row in rows_of(content.as_buffer()):
                    out.append(row)
                    held += 200 + len(row[-1] or b"")
                    if held > 16 * CHUNK:
                        yield batch_of(out)
                        out, held = [], 0
        if out:
            yield batch_of(out)
    return run


def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows in order of record, segment and part to one row a record, its digest carried along; repeated chunks count once."""
    fields = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    current, digest, length, last, stated, done = None, hashlib.sha1(), 0, None, None, []

    def close() -> None:
        found = length, base64.b32encode(digest.digest()).decode()
        if found != stated:
            raise ValueError(f"{current[0]}: {found} is not the stated {stated}")
        done.append((*current, *found))

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in [*fields, "chunk", "part"]), strict=True)
        for i, (*head, chunk, part) in enumerate(rows):
            if current is None or head[0] != current[0]:
                if current is not None:
                    close()
                current, digest, length, last = tuple(head[:5]), hashlib.sha1(), 0, None
                stated = tuple(head[5:])
            if (chunk, part) != last:
                data = batch.column("data")[i].as_buffer()
                digest.update(data)
                length += data.size
                last = chunk, part
        if len(done) > 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], fields)
            done = []
    if current is not None:
        close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], fields)


def archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")


def read_chunks(spark: SparkSession, path: str, size: int = CHUNK) -> DataFrame:
    """The chunked record table: payloads of all records as rows of record id, chunk number, part and at most ``size`` bytes."""
    return archives(spark, path).mapInArrow(parse(size, True), CHUNKS)


def read_records(spark: SparkSession, path: str, size: int = CHUNK) -> DataFrame:
    """One row a record, lengths and digests recomputed from the archive (a revisit has those its head states).

    Only chunks of payloads in several segments are shuffled, by record, and streamed through in order. An archive that is cut
    short or malformed, or a payload that does not match its stated digest, stops the job: no record is dropped silently.
    """
    rows = archives(spark, path).mapInArrow(parse(size, False), CHUNKS)
    names = [c.split()[0] for c in RECORDS.split(", ")]
    whole = rows.filter("data IS NULL").select(*names)
    parts = rows.filter("data IS NOT NULL").repartition("record_id").sortWithinPartitions("record_id", "chunk", "part")
    return whole.unionByName(parts.mapInArrow(carried, RECORDS))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, max(page_id) AS keeper FROM p GROUP BY d)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('{BASE32}', CAST((CAST('0x' || substr(p.d, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - i % 4 * 5 AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
       CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p JOIN g USING (d)"""
