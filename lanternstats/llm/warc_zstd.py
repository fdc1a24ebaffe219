"""WARC archives in Zstandard: writer and reader.

An archive begins with a skippable frame holding the dictionary; after it every record is one frame.  The
reader loads the dictionary from that frame, decodes frame by frame, and checks headers, lengths and digests.
Archives are rows of a table (name, content) which Spark writes and reads, so that a lost task is simply run
again; ``export`` turns them into files and Spark's ``binaryFile`` source reads such files.
"""

import hashlib
import os
import struct
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from lanternstats.llm.common import ship, slices, stored, workspace

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGICS = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")

#: Payloads of fewer bytes are never revisits.
LEAST_PAYLOAD = 100
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 2 << 20
#: The dictionary: its size, and the sample it is trained on (rows, first characters of each).
DICTIONARY_BYTES = 32_768
SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000
LEVEL = 3
DATE = "2026-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
URN = "urn:page:"
_STEP = 1 << 16


class BadArchive(ValueError):
    """An archive breaks the format."""


def train_dictionary(samples, size=DICTIONARY_BYTES):
    """A dictionary for texts like ``samples``; empty if they are too few to learn from."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary):
    """The leading frame of an archive; nothing without a dictionary."""
    if not dictionary:
        return b""
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
    return struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed


def record(page_id, url, payload, digest, size, refers_to):
    """One WARC record: a response, or a revisit of the record ``refers_to``."""
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{URN}{'' if page_id is None else quote(str(page_id), safe='-')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or 'urn:unknown', safe=_URL_SAFE)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{URN}{quote(str(refers_to), safe='-')}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "%/:=&?~#+!$,;'@()*[]|"


def frames(content):
    """Decoded frames of an archive, each with its offset."""
    view, at, dictionary = memoryview(content), 0, None
    while at < len(view):
        if len(view) - at < 8:
            raise BadArchive(f"{len(view) - at} bytes after the last frame, at {at}")
        magic, size = struct.unpack_from("<II", view, at)
        if magic in SKIPPABLE_MAGICS:
            body = bytes(view[at + 8 : at + 8 + size])
            if len(body) < size:
                raise BadArchive(f"skippable frame at {at} is cut short")
            if magic == DICTIONARY_MAGIC and at == 0:
                raw = zstandard.ZstdDecompressor().decompress(body) if body[:4] == FRAME_MAGIC else body
                dictionary = zstandard.ZstdCompressionDict(raw)
            at += 8 + size
            continue
        if bytes(view[at : at + 4]) != FRAME_MAGIC:
            raise BadArchive(f"no frame at {at}")
        # The decoder gets the archive in small steps: what it leaves over is copied.
        decoder = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        parts, end = [], at
        try:
            while not decoder.eof and end < len(view):
                parts.append(decoder.decompress(view[end : end + _STEP]))
                end = min(end + _STEP, len(view))
        except zstandard.ZstdError as e:
            raise BadArchive(f"frame at {at}: {e}") from e
        if not decoder.eof:
            raise BadArchive(f"frame at {at} is cut short")
        yield at, b"".join(parts)
        at = end - len(decoder.unused_data)


def parse_record(raw):
    """Headers, by lower-case name, and block of the one record in ``raw``."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        raise BadArchive(f"no record header: {raw[:40]!r}")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise BadArchive(f"bad header line {line[:80]!r}")
        headers[name.strip().lower()] = value.strip()
    if missing := [x for x in NEEDED if x not in headers]:
        raise BadArchive(f"no {', '.join(missing)}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4:
        raise BadArchive(f"{len(rest) - 4} bytes where {headers['content-length']} are announced")
    if not rest.endswith(b"\r\n\r\n"):
        raise BadArchive("no end of record")
    return headers, rest[:-4]


def read_archive(content):
    """(id, type, payload, digest, payload bytes, id referred to) of every record of an archive."""
    from urllib.parse import unquote

    name = lambda uri: unquote(uri.strip("<>").removeprefix(URN)) or None
    for at, raw in frames(content):
        try:
            headers, block = parse_record(raw)
            kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha256:")
            size = int(headers.get("warc-x-payload-length", -1))
            payload, refers_to = None, None
            if kind == "response":
                _, mark, payload = block.partition(b"\r\n\r\n")
                if not mark or hashlib.sha256(payload).hexdigest() != digest or len(payload) != size:
                    raise BadArchive("the payload is not what its digest or length says")
            elif kind == "revisit":
                if headers.get("warc-profile") != REVISIT_PROFILE or "warc-refers-to" not in headers:
                    raise BadArchive("a revisit of nothing")
                refers_to = name(headers["warc-refers-to"])
            else:
                continue  # other kinds of records hold no page
        except BadArchive as e:
            raise BadArchive(f"record at {at}: {e}") from e
        yield name(headers["warc-record-id"]), kind, payload, digest, size, refers_to


def mark_revisits(pages, id_col="page_id", text_col="html", url_col="url", least=LEAST_PAYLOAD):
    """Rows with digest, bytes and, for all but the smallest id of equal payloads, the id they refer to.

    Digests with one row need no partner; the others are a small table with one row each, to which the pages
    are joined.  A digest with a third of all rows is summed on the way and split by the adaptive join.
    """
    payload = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    url = F.col(url_col).cast("string") if url_col else F.lit(None).cast("string")
    rows = pages.select(
        F.col(id_col).alias("id"), url.alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest")
    )
    shared = (
        rows.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "first")
    )
    same = F.col("first").isNull() | F.col("id").eqNullSafe(F.col("first"))
    return rows.join(shared, "digest", "left").select(
        "id", "url", "payload", "digest", F.when(~same, F.col("first")).alias("refers_to")
    )


def write_archives(marked, dictionary, archive_bytes=ARCHIVE_BYTES):
    """Archives (name, content) of the rows of ``mark_revisits``; each holds rows of one task."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        head, parts, size = dictionary_frame(dictionary), [], 0
        row = lambda: pa.RecordBatch.from_arrays(
            [pa.array([f"{task:05d}-{number:05d}.warc.zst"]), pa.array([head + b"".join(parts)], pa.binary())], names=["name", "content"]
        )
        for batch in slices(batches, 64):
            for page_id, url, payload, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                parts.append(compressor.compress(record(page_id, url, payload, digest, len(payload), refers_to)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield row()
                    number, parts, size = number + 1, [], 0
        if parts:
            yield row()

    return marked.select("id", "url", "payload", "digest", "refers_to").mapInArrow(run, "name string, content binary")


def read_archives(archives, with_payload=False):
    """Records of a table with a column ``content``; ids are text.  A broken archive fails the job."""
    names = ["page_id", "record_type", "payload", "payload_digest", "payload_bytes", "refers_to"]
    types = [pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.string()]
    keep = [i for i in range(6) if with_payload or i != 2]

    def run(batches):
        for batch in slices(batches, 1):
            rows = [[] for _ in keep]
            for found in read_archive(batch.column(0)[0].as_py() or b""):
                for column, i in zip(rows, keep):
                    column.append(found[i])
                if len(rows[0]) == 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, types[i]) for c, i in zip(rows, keep)], names=[names[i] for i in keep])
                    rows = [[] for _ in keep]
            yield pa.RecordBatch.from_arrays([pa.array(c, types[i]) for c, i in zip(rows, keep)], names=[names[i] for i in keep])

    spark_types = ["string", "string", "binary", "string", "long", "string"]
    return archives.select("content").mapInArrow(run, ", ".join(f"{names[i]} {spark_types[i]}" for i in keep))


def export(archives, folder):
    """Write archives as files to a mounted folder that all executors share; returns name and bytes of each.

    A file appears under its name when it is whole, so a task that runs twice does no harm.
    """

    def run(batches):
        for batch in slices(batches, 1):
            name, content = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            part = f"{folder}/.{name}-{os.getpid()}"
            with open(part, "wb") as f:
                f.write(content)
            os.replace(part, f"{folder}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(content)], pa.int64())], names=["name", "bytes"])

    return archives.select("name", "content").mapInArrow(run, "name string, bytes long")


def sample_payloads(pages, id_col, text_col, rows=SAMPLE_ROWS, chars=SAMPLE_CHARS):
    """Texts for the dictionary: of so many rows with the smallest hashes of ids, the first characters."""
    lowest = pages.where(F.col(id_col).isNotNull()).select(id_col).orderBy(F.xxhash64(id_col), id_col).limit(rows).collect()
    ids = [r[0] for r in lowest]
    texts = pages.where(F.col(id_col).isin(ids)).select(id_col, F.substring(text_col, 1, chars)).limit(2 * rows).collect() if ids else []
    return [t.encode() for _, t in sorted((r for r in texts if r[1]), key=lambda r: (str(r[0]), r[1]))]


def round_trip(pages, id_col="page_id", text_col="html", url_col="url"):
    """Write every row as a WARC record and read the archives back; one row per record.

    Null payloads are empty.  Rows without an id are last among equal payloads; rows that repeat an id and its
    payload are all responses.  Null URLs are written as ``urn:unknown``.  No rows make no archive.  Extra
    columns are left out.
    """
    dictionary = train_dictionary(sample_payloads(pages, id_col, text_col))
    archives = write_archives(mark_revisits(pages, id_col, text_col, url_col), dictionary)
    archives = stored(archives, workspace(pages.sparkSession), "archives")
    id_type = pages.schema[id_col].dataType
    return read_archives(archives).select(
        F.col("page_id").cast(id_type).alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )


ORACLE = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

ship(__name__)
