"""WARC archives: records with revisits, and a reader that splits files.

Every record is a gzip member of its own. Payloads that come more than once are written once; the other records are
revisits that name the one with the payload. Writers put each file under a name of its own and report it in a stored
manifest, so what a lost task wrote is never read.

The reader cuts files into byte ranges. A task scans its range for the bytes that begin a gzip member, takes a place
for a member only if the bytes there decode to a WARC header, and owns the records that begin inside its range, to
their ends beyond it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.common import bounded_batches, stored
from stationflow.session import fresh_path

#: Smaller payloads are always written, as a revisit would hardly be shorter.
LEAST_REVISIT = 1000
FILE_BYTES, SPLIT_BYTES, READ_BYTES = 64 << 20, 8 << 20, 1 << 18

#: Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"

RECORDS = "file string, offset long, headers map<string,string>, payload binary"


def record_id(page_id: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def member(headers: dict[str, str | None], block: bytes) -> bytes:
    """One record as a gzip member. Headers without a value are left out; control characters in values are escaped."""
    safe = {k: "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in v) for k, v in headers.items() if v is not None}
    lines = "".join(f"{k}: {v}\r\n" for k, v in (safe | {"Content-Length": str(len(block))}).items())
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(VERSION + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    headers = {
        "WARC-Type": "response" if payload is not None else "revisit",
        "WARC-Record-ID": record_id(page_id) if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http;msgtype=response",
        "X-Page-Id": None if page_id is None else str(page_id),
    }
    if payload is None:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to), "X-Refers-To-Page": str(refers_to), "X-Payload-Bytes": str(size)}
    return member(headers, HTTP + (payload or b""))


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """pages as page_id, url, html (null for revisits), size, digest and refers_to.

    Of equal payloads the rows with the largest page_id hold it; rows without page_id refer to that one too, and
    hold their own where no row of the group has an id. A null html is an empty payload.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    rows = rows.withColumns({"size": F.octet_length("html").cast("long"), "digest": F.sha1("html")})
    groups = rows.select("page_id", "size", "digest").where(F.col("size") >= least).groupBy("digest", "size").agg(F.count("*").alias("n"), F.max("page_id").alias("target"))
    shared = stored(groups.where("n > 1 and target is not null").select("digest", "size", "target"), "payloads")
    revisit = F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    joined = rows.join(shared, ["digest", "size"], "left")
    return joined.select("page_id", "url", F.when(~revisit, F.col("html")).alias("html"), "size", "digest", F.when(revisit, F.col("target")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record for each row of with_revisits(); returns the stored manifest: file, bytes, records."""
    bounded_batches(rows.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = fs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        out, name, at, n, done = None, "", 0, 0, []
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    name, at, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{root}/{name}", compression=None)
                data = page_record(r["page_id"], r["url"], r["html"], r["size"], r["digest"], r["refers_to"])
                out.write(data)
                at, n = at + len(data), n + 1
                if at >= file_bytes:
                    out.close()
                    out = None
                    done.append((name, at, n))
        if out is not None:
            out.close()
            done.append((name, at, n))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{d[0]}" for d in done]), pa.array([d[1] for d in done]), pa.array([d[2] for d in done])], ["file", "bytes", "records"])

    return stored(rows.mapInArrow(write, "file string, bytes long, records long"), "manifest")


def inflate(source, at: int, size: int, most: int | None = None) -> tuple[bytes, int] | None:
    """What the gzip member at `at` holds (its first `most` bytes, if given) and where it ends; None if it isn't one."""
    unpacker, out = zlib.decompressobj(31), []
    got = 0
    try:
        while not unpacker.eof:
            data = source.read_at(min(READ_BYTES if most is None else 4096, size - at), at) if at < size else b""
            if not data:
                return None
            at += len(data)
            while data and not unpacker.eof:
                part = unpacker.decompress(data, 0 if most is None else most - got)
                out.append(part)
                got += len(part)
                if most is not None and got >= most:
                    return b"".join(out), -1
                data = unpacker.unconsumed_tail
    except zlib.error:
        return None
    return b"".join(out), at - len(unpacker.unused_data)


def parsed(record: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers and block of a record."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"WARC/"):
        return None
    headers = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    if not headers.get("Content-Length", "").isdigit():
        return None
    return headers, rest[: int(headers["Content-Length"])]


def members(source, start: int, end: int, size: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Records that begin in [start, end)."""
    at = start
    while at < end:
        window = source.read_at(min(READ_BYTES + len(MAGIC) - 1, size - at), at)
        found = window.find(MAGIC)
        if found < 0 or at + found >= end:
            at += max(len(window) - len(MAGIC) + 1, 1)
            continue
        at += found
        head = inflate(source, at, size, len(VERSION))
        whole = inflate(source, at, size) if head and head[0].startswith(b"WARC/") else None
        record = parsed(whole[0]) if whole else None
        if record is None:
            at += 1
            continue
        yield at, *record
        at = whole[1]


def read_archives(spark: SparkSession, manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Every record of the manifest's files: file, offset, headers, payload (of HTTP responses without their headers)."""
    bounded_batches(spark)
    splits = manifest.where("bytes > 0").select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    n = manifest.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(0))).first()[0]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
        for batch in batches:
            for r in batch.to_pylist():
                files, path = fs.FileSystem.from_uri(r["file"])
                rows, held = [], 0
                with files.open_input_file(path) as source:
                    for at, headers, block in members(source, r["start"], min(r["start"] + split_bytes, r["bytes"]), r["bytes"]):
                        payload = block.partition(b"\r\n\r\n")[2] if headers.get("Content-Type", "").startswith("application/http") else block
                        rows.append((r["file"], at, list(headers.items()), payload))
                        held += len(payload)
                        if held >= 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "offset", "headers", "payload"])
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["file", "offset", "headers", "payload"])

    return splits.repartition(max(1, int(n)), "file", "start").mapInArrow(read, RECORDS)


def archive_roundtrip(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder and tell what reading them back gives, one row for each page."""
    spark = pages.sparkSession
    manifest = write_archives(with_revisits(pages), fresh_path(spark, "warc"))
    header = lambda name: F.col("headers")[name]
    is_revisit = header("WARC-Type") == "revisit"
    return read_archives(spark, manifest).select(
        header("X-Page-Id").cast("long").alias("page_id"),
        F.when(is_revisit, header("X-Payload-Bytes").cast("long")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
        F.when(is_revisit, F.substring(header("WARC-Payload-Digest"), 6, 40)).otherwise(F.sha1("payload")).alias("payload_digest"),
        header("WARC-Type").alias("record_type"),
        header("X-Refers-To-Page").cast("long").alias("refers_to"),
    )
