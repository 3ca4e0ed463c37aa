"""WARC archives of Zstandard frames with a shared dictionary.

An archive begins with a skippable frame that holds the dictionary; each record follows as a frame of its own,
so that a record can be read alone. The dictionary is built from a bounded sample of the pages and is the same
in all archives of a run. Tasks write archives as files into a shared folder, through the file systems that pyarrow
knows, and Spark reads them back as binary files. Equal payloads are stored once, the others become revisit records.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatlake.llm.common import lowest, new_path, saved

DICTIONARY_MAGIC = 0x184D2A5D  # a skippable frame's, the one that holds a dictionary
DICTIONARY_BYTES = 64 << 10
SAMPLE_PAGES = 1_000
SAMPLE_PAGE_BYTES = 64 << 10
ARCHIVE_BYTES = 4 << 20
MIN_REVISIT_BYTES = 100
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
UNSAFE = re.compile(rb"[\x00-\x20\x7f]")


@dataclass(frozen=True)
class Record:
    """One capture; ``payload`` is None in a revisit, which names the page that has it."""

    page_id: int | None
    url: str | None
    payload: bytes | None
    payload_bytes: int
    digest: str
    refers_to: int | None = None

    @property
    def kind(self) -> str:
        return "response" if self.payload is not None else "revisit"


def _uri(url: str) -> bytes:
    """The address on one line: control characters and spaces are percent-encoded."""
    return UNSAFE.sub(lambda match: b"%%%02X" % match[0][0], url.encode())


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record_bytes(record: Record) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {record.payload_bytes}\r\n\r\n".encode()
    block = http + (record.payload or b"")
    lines = ["WARC/1.1", f"WARC-Type: {record.kind}", f"WARC-Record-ID: {_name(record.page_id)}", f"WARC-Date: {DATE}"]
    head = "\r\n".join(lines).encode()
    if record.url is not None:
        head += b"\r\nWARC-Target-URI: " + _uri(record.url)
    if record.payload is None:
        head += f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: {_name(record.refers_to)}".encode()
    head += (
        f"\r\nWARC-Payload-Digest: sha256:{record.digest}\r\nContent-Type: application/http; msgtype=response"
        f"\r\nContent-Length: {len(block)}\r\n\r\n"
    ).encode()
    return head + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}


def parse_record(data: bytes) -> Record:
    """The record; raises ValueError if a length or the digest of its payload is wrong."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block, end = rest[: int(fields["content-length"])], rest[int(fields["content-length"]) :]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest = int(_fields(http)["content-length"]), fields["warc-payload-digest"].removeprefix("sha256:")
    response = fields["warc-type"] == "response"
    if end != b"\r\n\r\n" or response and (len(payload) != size or sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['warc-record-id']}")

    def page(name: str) -> int | None:
        found = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(found) if found else None

    return Record(
        page("warc-record-id"), fields.get("warc-target-uri"), payload if response else None, size, digest, page("warc-refers-to")
    )


def dictionary(numbered: DataFrame, size: int = DICTIONARY_BYTES, sample: int = SAMPLE_PAGES) -> bytes:
    """A dictionary of at most ``size`` bytes from at most ``sample`` records; empty where there are too few.

    ``numbered`` has row, page_id, url and html as bytes.
    """
    turns = F.xxhash64("row")
    small = (F.octet_length("html") > 0) & (F.octet_length("html") <= SAMPLE_PAGE_BYTES)
    chosen = [(row.row,) for row in lowest(numbered.where(small).select("row", turns.alias("turn")), sample, "row")]
    if not chosen:
        return b""
    ids = F.broadcast(numbered.sparkSession.createDataFrame(chosen, "row long"))
    rows = numbered.join(ids, "row").select("row", "page_id", "url", "html").orderBy("row").collect()
    records = [
        record_bytes(Record(row.page_id, row.url, bytes(row.html), len(row.html), sha256(row.html).hexdigest())) for row in rows
    ]
    try:
        return zstandard.train_dictionary(size, records).as_bytes() if records else b""
    except zstandard.ZstdError:  # too few or too short records
        return b""


def _shared(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def archive_head(data: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data


def frame_end(data: memoryview, begin: int) -> int:
    """Where the frame at ``begin`` ends, by the sizes of its blocks."""
    parameters = zstandard.get_frame_parameters(data[begin : begin + 18])
    at = begin + zstandard.frame_header_size(data[begin : begin + 18])
    while True:
        head = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            return at + 4 * parameters.has_checksum


def read_archive(content: bytes) -> Iterator[Record]:
    """The records of an archive, one frame at a time, with the dictionary that it brings along."""
    magic, size = struct.unpack_from("<II", content)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    shared = _shared(content[8 : 8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
    view, at = memoryview(content), 8 + size
    while at < len(content):
        end = frame_end(view, at)
        yield parse_record(reader.decompress(view[at:end]))
        at = end


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the folder's path on it."""
    return fs.FileSystem.from_uri(folder)


def _writer(shared: bytes, archive_bytes: int, folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes a task's archives as files and returns their names, which no other attempt of the task uses."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _shared(shared)
        options = {"level": LEVEL, "write_checksum": True, "write_content_size": True}
        packer = zstandard.ZstdCompressor(dict_data=words, **options) if words else zstandard.ZstdCompressor(**options)
        task, attempt, count, size = TaskContext.get().partitionId(), uuid4().hex, 0, 0
        system, path = _opened(folder)
        parts: list[bytes] = []

        def full() -> pa.RecordBatch:
            name = f"{task:06d}-{count:06d}-{attempt}.warc.zst"
            with system.open_output_stream(f"{path}/{name}", compression=None) as out:  # by its name it would be packed again
                out.write(archive_head(shared))
                for part in parts:
                    out.write(part)
            return pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

        for batch in batches:
            for page_id, url, payload, digest, refers, revisit in zip(*(batch.column(at) for at in range(6))):
                data = payload.as_py()
                body = None if revisit.as_py() else data
                record = Record(page_id.as_py(), url.as_py(), body, len(data), digest.as_py(), refers.as_py())
                parts.append(packer.compress(record_bytes(record)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield full()
                    parts, count, size = [], count + 1, 0
        if parts:
            yield full()

    return write


def _published(work: str, folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Moves files out of the work folder; one that an attempt before this has moved stays where it is."""

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (system, above), (_, path) = _opened(work), _opened(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                if system.get_file_info(f"{path}/{name}").type == fs.FileType.NotFound:
                    system.move(f"{above}/{name}", f"{path}/{name}")
            yield batch

    return move


def write_archives(
    pages: DataFrame, shared: bytes | None = None, min_revisit: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES,
    folder: str | None = None,
) -> DataFrame:
    """(name, content) of archives that hold a record a page, read from the files written.

    Tasks write the files into the shared ``folder`` (a new one by default): first under ``_work``, where files of
    failed attempts stay behind, and those of the attempts that counted are moved out of it. Of pages with equal payloads of ``min_revisit`` bytes or more the one with the least id (NULL last, of equal
    ids the first row) is a response, the others are revisits of it.
    """
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    numbered = saved(
        pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html")).select(
            "*", F.sha2("html", 256).alias("digest"), F.monotonically_increasing_id().alias("row")
        ),
        "warc-pages",
    )
    if shared is None:
        shared = dictionary(numbered)
    prints = numbered.where(F.octet_length("html") >= min_revisit).select("row", "page_id", "digest")
    firsts = saved(
        prints.groupBy("digest")
        .agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "row")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("refers_to")),
        "warc-firsts",
    )
    again = saved(
        prints.select("row", "digest").join(firsts, "digest").where("row <> first_row").select("row", "refers_to"), "warc-revisits"
    )
    told = numbered.join(again.withColumn("revisit", F.lit(True)), "row", "left").select(
        "page_id", "url", "html", "digest", "refers_to", F.coalesce("revisit", F.lit(False)).alias("revisit")
    )
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc-files")
    work = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_work")
    work.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(work)
    names = saved(told.mapInArrow(_writer(shared, archive_bytes, f"{folder}/_work"), "name string"), "warc-names")
    saved(names.mapInArrow(_published(f"{folder}/_work", folder), "name string"), "warc-published")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


READ = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row a record of the archives; lengths and digests of all payloads are checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [part.split()[0] for part in READ.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                rows = [
                    (x.page_id, x.url, x.payload if payloads else None, x.payload_bytes, x.digest, x.kind, x.refers_to)
                    for x in read_archive(content.as_py())
                ]
                yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names)

    return archives.select("content").mapInArrow(read, READ)


def archived(pages: DataFrame) -> DataFrame:
    """A row a page, read back from its archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    NULL and empty html are responses with an empty payload. Repeated rows and ids are records of their own; a
    revisit of a page without an id has a NULL refers_to. No rows give no rows; further columns don't matter.
    """
    read = read_archives(write_archives(pages), payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first_id FROM payloads GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM payloads JOIN firsts USING (payload_digest)
"""
