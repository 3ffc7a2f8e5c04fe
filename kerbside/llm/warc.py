"""WARC archives: written by Spark into a shared folder, and read back by a reader that salvages.

Every record is a gzip member of its own. Spark's text writer puts the members into files,
with an empty member between them as its line end, so any gzip reader can read the files.
Of payloads that are equal and at least ``REVISIT_BYTES`` long, the record with the largest
id is a response and the others revisit it without a payload.

The reader takes one file's bytes and never stops at damage: where a member fails its check
sum, or a version line or length does not fit, it looks for the next valid member or
version line, goes on there, and reports the bytes it skipped as a gap. Plain archives,
archives of one member a record and files that mix both are read.

Defined cases: a null payload counts as empty; payloads shorter than the limit, and empty
ones, are all responses; rows that repeat the id of the response are responses too; an
empty table gives no records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

REVISIT_BYTES = 1000
#: An empty gzip member; bytes as characters of the same number.
EMPTY_MEMBER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
#: Records in a file, so that a file can be read whole.
FILE_RECORDS = 5000
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
MAX_HEADER = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_bytes(page_id: int, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as plain WARC/1.1."""
    kind = "response" if refers_to is None else "revisit"
    block = payload if refers_to is None else b""
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", "WARC-Date: 2024-01-01T00:00:00Z",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', '%20', url)}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}", f"WARC-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(record: bytes, level: int = 4) -> bytes:
    packer = zlib.compressobj(level, wbits=31)
    return packer.compress(record) + packer.flush()


@dataclass(frozen=True)
class Gap:
    """Bytes of a file that belong to no sound record."""

    start: int
    stop: int
    reason: str


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    block: bytes
    start: int
    stop: int


def _parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """Headers, block and end of the plain record at ``at``, or what is wrong."""
    if not (version := VERSION.match(data, at)):
        return "no version line"
    end = data.find(b"\r\n\r\n", at, at + MAX_HEADER)
    if end < 0:
        return "header without end"
    headers = {}
    for line in data[version.end():end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return "header line without colon"
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not size.isascii() or not size.isdigit():
        return "no length"
    stop = end + 4 + int(size)
    if data[stop:stop + 4] != b"\r\n\r\n":
        return "length does not fit"
    block = data[end + 4:stop]
    stated = headers.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:].lower() != hashlib.sha1(block).hexdigest():
        return "block digest differs"
    return headers, block, stop + 4


def _unpack(data: bytes, at: int) -> tuple[bytes, int] | str:
    """Contents and end of the gzip member at ``at``, or what is wrong."""
    unpacker = zlib.decompressobj(wbits=31)
    out, view, size = [], memoryview(data), 1 << 16
    try:
        while not unpacker.eof:
            piece = view[at:at + size]
            if not len(piece):
                return "member without end"
            out.append(unpacker.decompress(piece))
            at += len(piece)
    except zlib.error as error:
        return str(error)
    return b"".join(out), at - len(unpacker.unused_data)


def salvage(data: bytes) -> Iterator[Record | Gap]:
    """Every sound record of a file, and the gaps between them, in order."""
    at, bad_from, reason = 0, None, ""

    def gap(stop: int) -> Iterator[Gap]:
        if bad_from is not None and stop > bad_from:
            yield Gap(bad_from, stop, reason)

    while at < len(data):
        found, wrong, stop = [], "", at
        if data.startswith(MEMBER, at):
            got = _unpack(data, at)
            if isinstance(got, str):
                wrong = got
            else:
                content, stop = got
                inner = 0
                while inner < len(content):
                    record = _parse(content, inner)
                    if isinstance(record, str):
                        wrong = record
                        break
                    found.append(Record(record[0], record[1], at, stop))
                    inner = record[2]
        else:
            record = _parse(data, at)
            if isinstance(record, str):
                wrong = record
            else:
                stop = record[2]
                found.append(Record(record[0], record[1], at, stop))
        if found or not wrong:
            yield from gap(at)
            bad_from = None
            yield from found
            if wrong:  # a member that is sound, with a damaged record behind a good one
                yield Gap(at, stop, wrong)
            at = stop
            continue
        if bad_from is None:
            bad_from, reason = at, wrong
        nexts = [i for i in (data.find(MEMBER, at + 1), (VERSION.search(data, at + 1) or _NONE).start()) if i >= 0]
        at = min(nexts, default=len(data))
    yield from gap(len(data))


class _NoMatch:
    def start(self) -> int:
        return -1


_NONE = _NoMatch()


def with_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Pages as (page_id, url, payload, digest, refers_to); equal long payloads refer to the largest id."""
    rows = pages.select(
        F.col(key).alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    long = F.length("payload") >= REVISIT_BYTES
    # Only digests that occur again are joined; short payloads carry no key, so they are spread freely.
    again = rows.where(long).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("copies")).where(
        "copies > 1"
    ).select(F.col("digest").alias("again"), "keeper")
    link = F.when(long, F.col("digest")).otherwise(F.concat(F.lit("short "), F.coalesce(F.col("page_id").cast("string"), F.lit(""))))
    joined = rows.join(again, link == F.col("again"), "left")
    return joined.select(
        "page_id", "url", "payload", "digest", F.when(F.col("keeper") != F.col("page_id"), F.col("keeper")).alias("refers_to")
    )


def write_archives(records: DataFrame, path: str) -> None:
    """Files of gzip members below ``path``; a lost task writes its files anew."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pylist()
                packed = [member(record_bytes(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"])) for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary())], names=["member"])

    members = records.mapInArrow(run, "member binary").select(F.expr("cast(member AS string)").alias("value"))
    members.write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER).option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(path)


def read_archives(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Records and gaps of all files below ``path``."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    found = files.mapInArrow(_read_files, READ)
    records = found.where("reason is null").drop("reason")
    gaps = found.where("reason is not null").select("path", "start", "stop", "reason")
    return records, gaps


READ = (
    "path string, start long, stop long, record_type string, record_id string, target_uri string, payload_digest string, "
    "payload_bytes long, refers_to string, block binary, reason string"
)


def _read_files(batches):
    import pyarrow as pa

    names = [part.split()[0] for part in READ.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in READ.split(", ")])
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows, size = [], 0
            for item in salvage(content.as_py()):
                row = dict.fromkeys(names) | {"path": path.as_py(), "start": item.start, "stop": item.stop}
                if isinstance(item, Gap):
                    row["reason"] = item.reason
                else:
                    h = item.headers
                    length = h.get("warc-payload-length", str(len(item.block)))
                    row |= {
                        "record_type": h.get("warc-type"), "record_id": h.get("warc-record-id"),
                        "target_uri": h.get("warc-target-uri"), "block": item.block,
                        "payload_digest": h.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                        "payload_bytes": int(length) if length.isdigit() else None, "refers_to": h.get("warc-refers-to"),
                    }
                rows.append(row)
                size += len(item.block) if isinstance(item, Record) else 0
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def page_number(column: str) -> F.Column:
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def digest(spark: SparkSession, pages: DataFrame, path: str) -> DataFrame:
    """Writes the archives to ``path`` and returns what is read back from them."""
    write_archives(with_revisits(pages), path)
    records, _ = read_archives(spark, path)
    return records.select(
        page_number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_number("refers_to").alias("refers_to"), F.length("block").cast("long").alias("block_bytes"),
    )
