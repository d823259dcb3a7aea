"""WARC archives in Zstandard: one frame per record, dictionary in front.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary; every record is a frame of its own, compressed with it.  Writing
makes one archive, or several of bounded size, from each partition; reading
loads archives through Spark's binary file source, walks the frames by their
block headers, decodes one record at a time and checks headers and lengths.

Archives are written by the tasks under names that no other attempt uses, and
a job's manifest lists those of its successful tasks: files that a lost or
repeated attempt leaves behind are not in it and are never read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from socialpages.llm.common import as_bytes
from socialpages.plans.lineage import materialize, scratch_path

# Fixed values of the formats.
VERSION = b"WARC/1.1"
SKIPPABLE_DICTIONARY = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # the pages table has no dates
REQUIRED = ("WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length")

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 16 << 10
SAMPLE_RECORDS = 200
SAMPLE_BYTES = 1 << 20
LEVEL = 3


class BadArchive(ValueError):
    """A frame, record header or length that is not as it should be."""


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in headers] + [b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise BadArchive("not a WARC/1.1 record")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name:
            raise BadArchive("a header line without a name")
        headers[name.decode()] = value.strip().decode()
    missing = [h for h in REQUIRED if h not in headers]
    if missing:
        raise BadArchive(f"without {', '.join(missing)}")
    if not headers["Content-Length"].isdigit() or len(rest) != int(headers["Content-Length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadArchive("the block is not as long as Content-Length says")
    return headers, rest[:-4]


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on a bounded sample of records; too few or too
    uniform samples make a raw one of their first bytes."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL, threads=0).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


class Writer:
    """Frames of one archive, in memory up to its bounded size."""

    def __init__(self, samples: list[bytes]):
        data = dictionary(samples)
        self.frames = [struct.pack("<II", SKIPPABLE_DICTIONARY, len(data)), data]
        held = zstandard.ZstdCompressionDict(data) if data else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True, write_content_size=True)
        self.size = 8 + len(data)
        self.records = 0

    def add(self, data: bytes) -> None:
        frame = self.compressor.compress(data)
        self.frames.append(frame)
        self.size += len(frame)
        self.records += 1


def frames(data: bytes) -> Iterator[tuple[int, memoryview]]:
    """(magic, frame) of every frame; a skippable frame without its header."""
    view, at = memoryview(data), 0
    while at < len(view):
        if at + 8 > len(view):
            raise BadArchive("a frame is cut short")
        magic, size = struct.unpack_from("<II", view, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            start, end = at + 8, at + 8 + size
        elif magic == ZSTD_MAGIC:
            start, flags = at, view[at + 4]
            end = at + zstandard.frame_header_size(view[at : at + 18])
            last = 0
            while not last:
                if end + 3 > len(view):
                    raise BadArchive("a frame is cut short")
                block = int.from_bytes(view[end : end + 3], "little")
                last, kind, length = block & 1, block >> 1 & 3, block >> 3
                end += 3 + (1 if kind == 1 else length)
            end += 4 if flags & 4 else 0
        else:
            raise BadArchive(f"no frame starts with {magic:#x}")
        if end > len(view):
            raise BadArchive("a frame is cut short")
        yield magic, view[start:end]
        at = end


def read_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of one archive, one at a time."""
    held = None
    for i, (magic, frame) in enumerate(frames(data)):
        if magic != ZSTD_MAGIC:
            if i == 0 and magic == SKIPPABLE_DICTIONARY and len(frame):
                raw = bytes(frame)
                if raw[:4] == struct.pack("<I", ZSTD_MAGIC):  # may be compressed itself
                    raw = zstandard.ZstdDecompressor().decompress(raw)
                held = zstandard.ZstdCompressionDict(raw)
            continue
        size = zstandard.frame_content_size(frame)
        try:
            body = zstandard.ZstdDecompressor(dict_data=held) if held else zstandard.ZstdDecompressor()
            # a frame that does not say its size is read as a stream, whatever it holds
            record_bytes = body.decompress(frame) if size >= 0 else body.decompressobj().decompress(frame)
        except zstandard.ZstdError as e:
            raise BadArchive(str(e)) from e
        if size >= 0 and len(record_bytes) != size:
            raise BadArchive("a frame holds less than it says")
        yield parse(record_bytes)


# -- pages as records ---------------------------------------------------------


def _record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str | None):
    if record_id is None:
        return None
    found = re.fullmatch(r"<urn:page:(-?\d*)>", record_id)
    if not found:
        raise BadArchive(f"not a page's record id: {record_id}")
    return int(found[1]) if found[1] else None


def page_record(page_id, url, payload: bytes, refers_to, revisit: bool) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"\s", "%20", url or "")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to))]
    return record(headers, block)


PAGE_COLUMNS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)
PAGE_ARROW = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def read_page(headers: dict[str, str], block: bytes) -> tuple:
    """A page's row from its record; digests and lengths are checked."""
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        raise BadArchive(f"unexpected record type {kind}")
    if headers.get("WARC-Block-Digest") != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise BadArchive("the block does not have its digest")
    http, gap, payload = block.partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^Content-Length: (\d+)\r?$", http)
    name, _, digest = headers.get("WARC-Payload-Digest", "").partition(":")
    if not gap or not length or name != "sha256":
        raise BadArchive("no HTTP header, length or payload digest")
    if kind == "response":
        if int(length[1]) != len(payload) or hashlib.sha256(payload).hexdigest() != digest:
            raise BadArchive("the payload does not have its length and digest")
    elif payload or headers.get("WARC-Profile") != REVISIT_PROFILE or "WARC-Refers-To" not in headers:
        raise BadArchive("not a revisit of an identical payload")
    refers_to = _page_id(headers["WARC-Refers-To"]) if kind == "revisit" else None
    return (
        _page_id(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), int(length[1]), digest, kind, refers_to,
        payload if kind == "response" else None,
    )


def _filesystem(uri: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri if re.match(r"[a-z][a-z0-9+.-]*:", uri) else f"file://{uri}")
    return system, path


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: one without is in the cluster's default store, not
    on each executor's disk."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """Writes the rows of one partition; yields (file, n_records, n_bytes)."""
    system, base = _filesystem(folder)
    writer, waiting, waiting_bytes, done = None, [], 0, []

    def start():
        nonlocal writer, waiting, waiting_bytes
        writer = Writer(waiting)
        for data in waiting:
            writer.add(data)
        waiting, waiting_bytes = [], 0

    def finish():
        nonlocal writer
        name = f"{uuid.uuid4().hex}.warc.zst"
        with system.open_output_stream(f"{base}/{name}", compression=None) as out:
            for frame in writer.frames:
                out.write(frame)
        done.append((name, writer.records, writer.size))
        writer = None

    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "refers_to", "revisit")]
        for (page_id, url, refers_to, revisit), payload in zip(zip(*(c.to_pylist() for c in columns)), as_bytes(batch.column("html"))):
            data = page_record(page_id, url, payload, refers_to, revisit)
            if writer is None:  # the first records of an archive train its dictionary
                waiting.append(data)
                waiting_bytes += len(data)
                if len(waiting) >= SAMPLE_RECORDS or waiting_bytes >= SAMPLE_BYTES:
                    start()
            else:
                writer.add(data)
            if writer is not None and writer.size >= archive_bytes:
                finish()
    if waiting:
        start()
    if writer is not None:
        finish()
    names, records, sizes = zip(*done) if done else ((), (), ())
    yield pa.record_batch([pa.array(names, pa.string()), pa.array(records, pa.int64()), pa.array(sizes, pa.int64())],
                          ["file", "n_records", "n_bytes"])


def write_pages(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every row of ``pages`` (page_id, url, html) into new
    archives in ``folder`` (a path or URI that executors share); returns the
    manifest (file, n_records, n_bytes), kept in the checkpoint folder.

    Of the rows with equal payloads of at least ``MIN_REVISIT_BYTES`` bytes the
    one with the least page_id is a response and the others are revisits of
    it; of those that share that page_id all are responses.  A null html is the
    empty payload; a null page_id is greater than any other, so that it is a
    response only where no row of its payload has an id.  Repeated rows give a
    record each; no rows give no archive; other columns are ignored.
    """
    folder = _qualified(pages.sparkSession, folder)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html")
    )
    # a small payload is never repeated: it gets a key that no digest equals,
    # of its own page, so that small payloads spread over the tasks
    large = F.octet_length("html") >= MIN_REVISIT_BYTES
    rows = rows.withColumn("large", large)
    rows = rows.withColumn("digest", F.when(large, F.unhex(F.sha2("html", 256))).otherwise(F.unhex(F.hex(F.xxhash64("page_id", "url")))))
    # one row for each repeated payload
    first = rows.where("large").groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = materialize(first.where("n > 1").select("digest", "first"))
    rows = rows.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", "html", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))
    _filesystem(folder)[0].create_dir(_filesystem(folder)[1], recursive=True)
    return materialize(rows.mapInArrow(lambda b: _write(b, folder, archive_bytes), "file string, n_records long, n_bytes long"))


def _read(archives, with_payload: bool) -> Iterator[pa.RecordBatch]:
    """Rows of the records of ``archives``: pairs of a path and its bytes."""
    rows = []
    for path, content in archives:
        try:
            for headers, block in read_records(content):
                row = read_page(headers, block)
                rows.append(row if with_payload else (*row[:-1], None))
                if len(rows) >= 64:
                    yield _rows(rows)
                    rows = []
        except BadArchive as e:
            raise BadArchive(f"{path}: {e}") from e
    if rows:
        yield _rows(rows)


def read_pages(spark: SparkSession, paths, with_payload: bool = True) -> DataFrame:
    """Rows (page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload) of archives (a path, a folder or a list of them).  Any
    frame, header, length or digest that is wrong fails the read."""

    def records(batches):
        for batch in batches:
            yield from _read(((p, c.as_buffer()) for p, c in zip(batch.column("path").to_pylist(), batch.column("content"))), with_payload)

    # a row of the file source holds an archive, so a batch is one archive
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(records, PAGE_COLUMNS)


def read_manifest(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """Rows as ``read_pages`` of the archives that a manifest names, which tasks open
    themselves: archives that a lost attempt left in the folder are not read, and
    no list of names passes the driver."""
    folder = _qualified(manifest.sparkSession, folder)

    def records(batches):
        system, base = _filesystem(folder)

        def opened():
            for batch in batches:
                for name in batch.column("file").to_pylist():
                    with system.open_input_file(f"{base}/{name}") as file:
                        yield name, file.read_buffer()

        yield from _read(opened(), with_payload)

    return manifest.select("file").mapInArrow(records, PAGE_COLUMNS)


def _rows(rows) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), PAGE_ARROW.types)], schema=PAGE_ARROW)


def archived(pages: DataFrame, with_payload: bool = True, **options) -> DataFrame:
    """``pages`` written to archives in a new folder under the checkpoint folder
    and read back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    return read_manifest(write_pages(pages, folder, **options), folder, with_payload)
