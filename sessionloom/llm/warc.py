"""WARC archives with dictionary compression: a writer and a reader.

An archive is a leading skippable frame (magic 0x184D2A5D) that holds a Zstandard dictionary
built from the archive's own records, and then one Zstandard frame per record, so that each
record can be read alone. Too few or too small records to build a dictionary from make an
archive without that frame, which readers treat as "no dictionary". A trailing skippable frame
(magic 0x184D2A5E) has the numbers of records and of their bytes, an empty one ends the file.

Records with equal payloads of at least ``min_bytes`` are stored once: the smallest page_id
is a ``response``, the others are ``revisit`` records that refer to it. Digests are compared
in a narrow staged table (salted, so that one payload with a third of all rows is spread);
the pages themselves move at most once, by (digest, page).

Tasks make archives of about ``archive_bytes`` and Spark writes and reads them, each a file of its
own: they lie in any store that the staged tables can lie in, under Spark's commit, so that files of a
lost or repeated attempt are never read. The manifest is a staged table of one row per archive. Where
the folder does not hold every archive that the tasks made, as one that is not shared, ``write`` raises an
error, and so does ``read`` where it lacks one of the manifest. A task holds one archive's records at a time, a record
whole, and Spark an archive as one value: what bounds a single payload is the memory of a task.

Defined results: a null html is the empty payload; equal rows (same page_id, same payload)
get equal records; a null page_id is never the smallest, and payloads that only rows without
page_id have are all responses; a null url gives a record without a target; line breaks and
other control characters in a url are percent-encoded. An empty table makes no archive.
Columns other than page_id, url and html do not matter.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from sessionloom.llm.common import col
from sessionloom.operators.skew import salted_left_join
from sessionloom.session import PUT_SETTINGS, Staging, settings

# Fixed values of the format.
DICTIONARY_MAGIC, COUNTS_MAGIC = 0x184D2A5D, 0x184D2A5E
#: An empty skippable frame: what Spark writes after every row of text, in place of a line break.
END = "P*M\x18\0\0\0\0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:x-page:"

ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL = 16 << 20, 32 << 10, 2 << 20, 3
READ_BYTES = 1 << 20
#: Tasks that read archives, at most.
READERS = 10_000
DATE = "1970-01-01T00:00:00Z"

RECORD = (
    "page_id long, record_type string, target_uri string, payload_digest string, payload_bytes long, "
    "refers_to long, payload binary"
)
RECORD_ARROW = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC 1.1 record; a revisit keeps digest and length of the payload but not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{PAGE_URN}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    kind = fields["WARC-Type"]
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    digest, length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
    if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "record_type": kind, "target_uri": fields.get("WARC-Target-URI"),
        "payload_digest": digest, "payload_bytes": length, "refers_to": _page(fields.get("WARC-Refers-To", "")), "payload": payload,
    }


def _page(urn: str) -> int | None:
    number = urn.strip("<>").removeprefix(PAGE_URN)
    return int(number) if number else None


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES, sample: int = SAMPLE_BYTES):
    """A dictionary built from an even selection of the records, or None if that cannot be done."""
    total = sum(map(len, records))
    every = max(1, -(-total // sample))
    samples = [r[:sample] for r in records[::every]]
    if sum(map(len, samples)) < 8 * 1024 or len(samples) < 8:
        return None
    try:
        return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 8), samples, k=512, d=8)
    except zstandard.ZstdError:  # the samples have too little in common
        return None


def compress(records: list[bytes], level: int = LEVEL) -> Iterator[bytes]:
    """The parts of an archive: the dictionary's frame, then one frame per record."""
    shared = dictionary(records)
    if shared is not None:
        data = shared.as_bytes()
        shared.precompute_compress(level=level)
        yield struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data
    writer = zstandard.ZstdCompressor(level=level, dict_data=shared, write_checksum=True, write_content_size=True)
    yield from map(writer.compress, records)


def decompress(source) -> Iterator[bytes]:
    """The records of an open archive, read in pieces."""
    data, shared = source.read(8), None
    if len(data) == 8 and struct.unpack("<II", data)[0] == DICTIONARY_MAGIC:
        shared = zstandard.ZstdCompressionDict(source.read(struct.unpack("<II", data)[1]))
        data = b""
    reader = zstandard.ZstdDecompressor(dict_data=shared)
    frame, out, inside = reader.decompressobj(), [], False
    while data or (data := source.read(READ_BYTES)):
        out.append(frame.decompress(data))
        inside = not frame.eof
        data = frame.unused_data if frame.eof else b""
        if frame.eof:
            if found := b"".join(out):  # nothing of a skippable frame
                yield found
            frame, out = reader.decompressobj(), []
    if inside:
        raise ValueError("the archive ends inside a record")


def _located(pages: DataFrame, stage: Staging, min_bytes: int) -> DataFrame:
    """``page_id, url, payload, first``: first is the response's page of a revisit, else null."""
    page_id, payload = col("page_id").cast("long"), F.coalesce(col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(page_id.alias("page_id"), col("url").cast("string").alias("url"), payload.alias("payload"))
    digest = F.unhex(F.sha1("payload")).alias("digest")
    narrow = stage.put("digests", rows.select("page_id", digest, F.octet_length("payload").alias("bytes")))
    several = (
        narrow.filter(F.col("bytes") >= min_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").drop("n")
    )
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("page")
    later = salted_left_join(narrow, several, ["digest"], ["page_id"])
    later = later.filter(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")))
    revisits = stage.put("revisits", later.select("digest", page, "first").distinct())
    return rows.select("*", digest, page).join(revisits, ["digest", "page"], "left").select("page_id", "url", "payload", "first")


def write(pages: DataFrame, stage: Staging, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, date: str = DATE) -> DataFrame:
    """Write ``page_id, url, html`` to archives; the committed manifest ``path, records, raw_bytes, stored_bytes``."""
    spark, folder, seen = pages.sparkSession, stage.folder("warc"), Observation()

    def archive(records: list[bytes]) -> pa.RecordBatch:
        counts = struct.pack("<II", COUNTS_MAGIC, 16) + struct.pack(">QQ", len(records), sum(map(len, records)))
        return pa.RecordBatch.from_pydict({"archive": [b"".join([*compress(records), counts])]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                columns = (c.to_pylist() for c in batch.slice(start, 256).columns)
                for page_id, url, payload, first in zip(*columns):
                    held.append(record(page_id, url, payload, first, date))
                    size += len(held[-1])
                    if size >= archive_bytes:
                        yield archive(held)
                        held, size = [], 0
        if held:
            yield archive(held)

    made = _located(pages, stage, min_bytes).mapInArrow(run, "archive binary").observe(seen, F.count(F.lit(1)).alias("archives"))
    files = made.select(F.col("archive").cast("string")).write.mode("overwrite")
    with settings(spark, PUT_SETTINGS):  # a row is written as it is, bytes that are no UTF-8 as well
        files.options(maxRecordsPerFile=1, lineSep=END, compression="none").text(folder)
    found = _files(spark, [folder]).filter("length > 0")  # of no rows Spark may make an empty file
    manifest = stage.put("manifest", found.select(
        "path", _count(-24).alias("records"), _count(-16).alias("raw_bytes"), F.col("length").alias("stored_bytes")))
    if (there := manifest.count()) != seen.get["archives"]:
        raise ValueError(f"{folder} holds {there} of {seen.get['archives']} archives: set spark.checkpoint.dir to a folder that all executors share")
    return manifest


def _files(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(folders)


def _count(at: int) -> Column:
    """One of an archive's counts, so many bytes before the file's end."""
    return F.conv(F.hex(F.substring("content", at, 8)), 16, 10).cast("long")


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of a manifest's archives, in up to ``READERS`` tasks; payloads are checked against their digests."""
    spark, wanted = manifest.sparkSession, manifest.select("path")
    folders = [r["folder"] for r in wanted.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().collect()]
    if not folders:
        return spark.createDataFrame([], RECORD)
    files = _files(spark, folders).join(F.broadcast(wanted), "path", "left_semi")
    if (there := files.select("path").count()) != (archives := wanted.distinct().count()):
        raise FileNotFoundError(f"{there} of {archives} archives are in {', '.join(folders)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for data in decompress(pa.BufferReader(content.as_buffer())):
                    found = parse(data)
                    if not payloads:
                        found["payload"] = None
                    held.append(found)
                    size += len(found["payload"] or b"") + 256
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, RECORD_ARROW)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, RECORD_ARROW)

    return files.select("content").coalesce(READERS).mapInArrow(run, RECORD)


# Names of places, for callers that open an archive without Spark.

def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and authority that Spark itself would take for it."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return checked(full, sc.master)


def checked(folder: str, master: str) -> str:
    """The folder, unless it is on one machine and the master is not."""
    if folder.startswith("file:") and not master.startswith("local"):
        raise ValueError(f"{folder} is local: set spark.checkpoint.dir to a folder that all executors share")
    return folder


# Hadoop's names of file systems and Arrow's.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(path: str) -> str:
    """The path as Arrow names it: ``file:/x`` is a plain path, ``s3a`` is ``s3``."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    scheme, mark, rest = path.partition("://")
    return ARROW_SCHEMES.get(scheme, scheme) + mark + rest
