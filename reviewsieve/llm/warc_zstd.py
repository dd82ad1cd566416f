"""WARC records in Zstandard archives with a shared dictionary, written and read by Spark tasks.

An archive begins with a skippable frame that holds the dictionary; each record is one frame. The
reader decodes frame by frame, so a task holds one record at a time, and checks headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewsieve.session import write_once

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 32 << 20  # an archive is closed beyond this size, and the next begins
# The dictionary is trained on the first bytes of the pages with the smallest digests.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 8192, 32768
CHUNK = 1 << 18


def open_path(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system of a path and its name there."""
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") else pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", path))


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(record_id: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """A response record, or a revisit that keeps the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{record_id}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest32(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class BadArchive(ValueError):
    """An archive or a record that breaks the format."""


def _header(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise BadArchive(f"bad header line {line[:80]!r}")
        out[name.decode("utf-8").lower()] = value.strip().decode("utf-8")
    return out


def parse_record(data: bytes) -> dict:
    """Check one record, which must fill its frame, and return its parts."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", first):
        raise BadArchive(f"no WARC header: {data[:40]!r}")
    fields = _header(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise BadArchive(f"header {name} is missing")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise BadArchive("Content-Length does not fit the record")
    block, kind = rest[:-4], fields["warc-type"]
    payload, length = None, None
    if kind in ("response", "revisit"):
        http, gap, payload = block.partition(b"\r\n\r\n")
        status, *lines = http.split(b"\r\n")
        if not gap or not status.startswith(b"HTTP/"):
            raise BadArchive("no HTTP header")
        length = _header(lines).get("content-length", "")
        if not length.isdigit() or kind == "response" and int(length) != len(payload):
            raise BadArchive("HTTP Content-Length does not fit the payload")
        length = int(length)
    digest = fields.get("warc-payload-digest", "")
    if kind == "response" and digest != f"sha1:{digest32(payload)}":
        raise BadArchive("payload digest does not fit the payload")
    if kind == "revisit":
        payload = None
        if "warc-refers-to" not in fields:
            raise BadArchive("revisit without WARC-Refers-To")
    return {
        "record_id": fields["warc-record-id"],
        "record_type": kind,
        "url": fields.get("warc-target-uri"),
        "refers_to": fields.get("warc-refers-to"),
        "payload_digest": digest.removeprefix("sha1:") or None,
        "payload_bytes": length,
        "payload": payload,
    }


def _exactly(stream, n: int) -> bytes:
    data = stream.read(n)
    if len(data) != n:
        raise BadArchive("the archive ends within a frame")
    return data


def frames(stream) -> Iterator[bytes]:
    """Content of each frame; the dictionary of a leading skippable frame is loaded first."""
    dictionary, ahead, first = None, b"", True
    while True:
        if len(ahead) < 8:
            ahead += stream.read(8 - len(ahead))
        if not ahead:
            return
        magic = struct.unpack("<I", ahead[:4])[0] if len(ahead) >= 4 else 0
        if magic in SKIPPABLE:
            if len(ahead) < 8:
                raise BadArchive("the archive ends within a frame")
            size = struct.unpack("<I", ahead[4:8])[0]
            body = ahead[8 : 8 + size]
            ahead = ahead[8 + size :]
            body += _exactly(stream, size - len(body))
            if first and magic == DICTIONARY_FRAME:
                if body[:4] == struct.pack("<I", ZSTD_MAGIC):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                dictionary = zstandard.ZstdCompressionDict(body)
        elif magic == ZSTD_MAGIC:
            decoder = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
            parts = []
            while True:
                try:
                    parts.append(decoder.decompress(ahead))
                except zstandard.ZstdError as error:
                    raise BadArchive(f"bad frame: {error}") from error
                if decoder.eof:
                    ahead = decoder.unused_data
                    break
                ahead = stream.read(CHUNK)
                if not ahead:
                    raise BadArchive("the archive ends within a frame")
            yield b"".join(parts)
        else:
            raise BadArchive(f"not a Zstandard frame: {ahead[:4]!r}")
        first = False


def train_dictionary(pages: DataFrame, html_col: str = "html") -> bytes | None:
    """A dictionary from a sample of SAMPLE_PAGES pages, SAMPLE_BYTES of each; none if there are too few."""
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    # Every task offers its smallest digests; texts are fetched for those that are the smallest of all.
    last = pages.select(F.sha1(html).alias("key")).distinct().orderBy("key").limit(SAMPLE_PAGES).agg(F.max("key")).first()[0]
    sample = pages.select(F.sha1(html).alias("key"), F.substring(html, 1, SAMPLE_BYTES).alias("head")).where(F.col("key") <= last)
    # Copies of a page are one of the sample.
    heads = [bytes(r["head"]) for r in sample.groupBy("key").agg(F.min("head").alias("head")).orderBy("key").collect() if len(r["head"]) >= 64]
    if len(heads) < 8:
        return None
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, heads).as_bytes()
    except zstandard.ZstdError:
        return None


def revisits(pages: DataFrame, id_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """Pages as (page_id, url, html, refers_to): of equal payloads, all but those of the largest id refer to it.

    Only digests of which there are several are joined back, by broadcast if they are few; else the join is
    one that Spark may split by its heavy keys.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col("url"), F.col(html_col).alias("html")).withColumn("key", F.unhex(F.sha1(html)))
    several = rows.where(F.octet_length(html) >= least_bytes).groupBy("key").agg(F.max("page_id").alias("leader"), F.count("*").alias("n")).where("n > 1 AND leader IS NOT NULL")
    several = write_once(several.select("key", "leader"), "payloads")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("leader")), F.col("leader"))
    return rows.join(several.sized_for_join(), "key", "left").select("page_id", "url", "html", F.when(F.col("leader").isNotNull(), refers).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", html_col: str = "html", least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each page (id, url, html) into archives below `folder`, a path that executors share.

    Returns the archives (path, n_records), only those of tasks that ended well; what a lost task left behind has another
    name. Of pages with equal payloads of at least `least_bytes`, those with the largest id become responses
    and the others revisits. A null html is an empty payload; a null id is below all others and written empty; a null
    url has no target header; repeated rows are records of their own. An empty table gives no archives.
    """
    spark = pages.sparkSession
    dictionary = spark.sparkContext.broadcast(train_dictionary(pages, html_col))
    rows = revisits(pages, id_col, html_col, least_bytes).select(F.col("page_id").cast("string"), F.col("url").cast("string"), "html", F.col("refers_to").cast("string"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body = dictionary.value
        shared = zstandard.ZstdCompressionDict(body) if body else None
        encoder = zstandard.ZstdCompressor(level=3, dict_data=shared, write_content_size=True, write_checksum=True)
        system, root = open_path(folder)
        system.create_dir(root, recursive=True)
        done, out, held = [], None, 0
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():05d}-{len(done)}-{uuid.uuid4().hex}.warc.zst"
                    out, held = system.open_output_stream(f"{root}/{name}", compression=None), 0
                    done.append([f"{folder}/{name}", 0])
                    if body:
                        out.write(struct.pack("<II", DICTIONARY_FRAME, len(body)) + body)
                frame = encoder.compress(record_bytes(page_id or "", url, (html or "").encode(), refers_to))
                out.write(frame)
                done[-1][1] += 1
                held += len(frame)
                if held >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["path", "n_records"])

    return write_once(rows.mapInArrow(work, "path string, n_records long"), "archives").data


RECORD = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)
_TYPES = [pa.string()] * 6 + [pa.int64(), pa.binary(), pa.string()]


def read_archives(archives: DataFrame, strict: bool = True, batch_bytes: int = 16 << 20) -> DataFrame:
    """All records of the archives in column `path`, an archive for each task.

    A broken record or archive ends the job, or, if not `strict`, gives a row with the error; reading goes on with the next
    frame where there is one. Payloads of revisits are null; their length and digest are those of the full payload.
    """
    paths = archives.select("path")
    count = max(1, archives.count())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for row in _records(path, strict):
                    rows.append(row)
                    held += len(row.get("payload") or b"") + 500
                    if held > batch_bytes:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return paths.repartition(count).mapInArrow(work, RECORD)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f) for r in rows], kind) for f, kind in zip(RECORD.names, _TYPES)], names=RECORD.names)


def _records(path: str, strict: bool) -> Iterator[dict]:
    system, name = open_path(path)
    try:
        with system.open_input_stream(name, compression=None) as stream:
            for frame in frames(stream):
                try:
                    yield {"path": path, **parse_record(frame)}
                except (BadArchive, UnicodeDecodeError) as error:
                    if strict:
                        raise
                    yield {"path": path, "error": str(error)}
    except (BadArchive, UnicodeDecodeError) as error:
        if strict:
            raise BadArchive(f"{path}: {error}") from error
        yield {"path": path, "error": str(error)}


def page_ids(column: str, kind: T.DataType) -> Column:
    """Id of a page from the URN of its record."""
    inner = F.regexp_extract(column, "^<urn:page:(.*)>$", 1)
    return F.when(inner != "", inner).cast(kind)


def round_trip(pages: DataFrame, folder: str, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Write the pages into archives and read them back: page_id, url, payload and what the records say of it."""
    kind = pages.schema[id_col].dataType
    records = read_archives(write_archives(pages, folder, id_col, html_col))
    return records.withColumn("page_id", page_ids("record_id", kind)).withColumn("refers_to", page_ids("refers_to", kind))
