"""WARC archives of zstd records with an embedded dictionary.

Every archive begins with a skippable frame that holds a zstd dictionary
built from the archive's own first records; then every record is a zstd
frame of its own, compressed with that dictionary, so that small records
compress well and each can be read alone. A payload that several pages
share is stored once, as the response with the smallest page id; the
other pages get revisit records that name it and hold no payload.

Archives are files (``*.warc.zst``) in a folder that all executors reach.
A task gives its files names of its own attempt, and a manifest written
by Spark lists the files of the attempts that succeeded, so a lost
executor or a repeated task leaves stray files at most, never a wrong or
doubled record.

Defined cases: a null html is an empty payload, a null url leaves out the
target header; rows that repeat a page id are each archived, and where the
smallest id of a payload is repeated, each of its rows is a response; a
null page id is larger than any other (a payload whose ids are all null is
a response in every row); very long payloads are records like others, whole
in memory one at a time; other columns are ignored; an empty table makes
no archive.
"""

from __future__ import annotations

import hashlib
import io
import struct

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import share_code

MIN_REVISIT = 100               # payload bytes from which copies become revisits
ARCHIVE_BYTES = 256 << 20       # record bytes after which a new archive begins
SAMPLE_BYTES = 2 << 20          # records the dictionary is built from
DICT_BYTES = 64 << 10
LEVEL = 3
RECORD_DATE = "2024-01-01T00:00:00Z"    # the pages carry no crawl time

# --- Fixed values of the formats.
DICT_FRAME = 0x184D2A5D         # skippable frame with a dictionary
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_OUT = ("page_id {kind}, url string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to {kind}, payload binary")


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record. A revisit keeps the HTTP head but no payload."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Date: {RECORD_DATE}", f"WARC-Payload-Digest: sha256:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:x-page:{page_id}>")
    if url is not None:
        # A line break or a % in an address must not end or alter the header.
        safe = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on records; where they are too few to train
    on, their plain bytes."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICT_BYTES:],
                                             dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes one archive; the first records are held back until there are
    enough for the dictionary."""

    def __init__(self, sink):
        self.sink, self.held, self.held_bytes = sink, [], 0
        self.compressor, self.records, self.raw_bytes = None, 0, 0

    def add(self, record: bytes) -> None:
        self.records += 1
        self.raw_bytes += len(record)
        if self.compressor is not None:
            self.sink.write(self.compressor.compress(record))
            return
        self.held.append(record)
        self.held_bytes += len(record)
        if self.held_bytes >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        dictionary = build_dictionary(self.held)
        raw = dictionary.as_bytes()
        self.sink.write(struct.pack("<II", DICT_FRAME, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        for record in self.held:
            self.sink.write(self.compressor.compress(record))
        self.held = []

    def close(self) -> None:
        if self.compressor is None:
            self._begin()
        self.sink.close()


def read_records(stream):
    """``(headers, block)`` of every record of an archive, one at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICT_FRAME:
        raise ValueError("the archive does not begin with a dictionary frame")
    raw = stream.read(size)
    trained = raw[:4] == b"\x37\xa4\x30\xec"
    dictionary = zstandard.ZstdCompressionDict(
        raw, dict_type=zstandard.DICT_TYPE_FULLDICT if trained
        else zstandard.DICT_TYPE_RAWCONTENT)
    plain = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(
        stream, read_across_frames=True), 1 << 16)
    while line := plain.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a record: {line[:40]!r}")
        headers = {}
        while (line := plain.readline()) != b"\r\n":
            name, _, value = line[:-2].decode().partition(": ")
            headers[name] = value
        block = plain.read(int(headers["Content-Length"]))
        if plain.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield headers, block


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html", min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Rows ``page_id, url, payload, digest, refers_to`` (null for a
    response). The smallest id of every payload is a partial aggregate over
    digests; only digests that repeat are joined back."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    firsts = (pages.select(F.col(id_col).alias("page_id"), F.sha2(payload, 256).alias("digest"),
                           F.octet_length(payload).alias("size")).where(F.col("size") >= min_bytes)
              .groupBy("digest").agg(F.min("page_id").alias("first"),
                                     F.count(F.lit(1)).alias("copies"))
              .where("copies > 1").select("digest", "first"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "payload", "digest",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes the rows of :func:`with_revisits` as archives under
    ``folder`` and returns the manifest ``path, records``, stored beside."""
    share_code(rows.sparkSession)

    def run(batches):
        task = TaskContext.get()
        fs, root = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(f"{root}/archives", recursive=True)
        done, writer, name = [], None, None

        def finish():
            writer.close()
            done.append((f"{folder}/archives/{name}", writer.records))

        for batch in batches:
            for i in range(batch.num_rows):
                if writer is None:
                    name = (f"part-{task.partitionId():06d}-{len(done):03d}-"
                            f"{task.taskAttemptId()}.warc.zst")
                    writer = ArchiveWriter(fs.open_output_stream(f"{root}/archives/{name}"))
                page_id, url, payload, digest, refers_to = (
                    batch.column(k)[i].as_py() for k in range(5))
                writer.add(_record(page_id, url, payload, digest, refers_to))
                if writer.raw_bytes >= ARCHIVE_BYTES:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in done], pa.string()),
             pa.array([n for _, n in done], pa.int64())], ["path", "records"])

    rows.select("page_id", "url", "payload", "digest", "refers_to") \
        .mapInArrow(run, "path string, records bigint").write.parquet(f"{folder}/manifest")
    return rows.sparkSession.read.parquet(f"{folder}/manifest")


def read_archives(manifest: DataFrame, id_type: str = "bigint",
                  with_payload: bool = True) -> DataFrame:
    """Every record of the archives of a manifest: ``page_id, url,
    payload_bytes, payload_digest, record_type, refers_to, payload`` (null
    for a revisit, or without ``with_payload``). The digest of a stored
    payload is computed anew and must match its header. One task reads some
    archives, one record at a time."""
    archives = manifest.count()         # one small row per archive
    spread = manifest.repartition(max(1, archives)).select("path")
    as_id = int if id_type in ("bigint", "int", "smallint", "tinyint") else str

    def page(value: str | None):
        return None if value is None else as_id(value[len("<urn:x-page:"):-1])

    def run(batches):
        schema = spread_schema
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, inside = pa.fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with fs.open_input_stream(inside) as stream:
                    for headers, block in read_records(stream):
                        kind = headers["WARC-Type"]
                        size = int(headers["X-Payload-Length"])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        payload = None
                        if kind == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4:]
                            if len(payload) != size or \
                                    hashlib.sha256(payload).hexdigest() != digest:
                                raise ValueError(f"damaged payload in {path}")
                        url = headers.get("WARC-Target-URI")
                        if url is not None:
                            url = url.replace("%0A", "\n").replace("%0D", "\r") \
                                .replace("%25", "%")
                        payload = payload if with_payload else None
                        rows.append((page(headers.get("WARC-Record-ID")), url, size, digest, kind,
                                     page(headers.get("WARC-Refers-To")), payload))
                        held += len(payload or b"")
                        if held >= 4 << 20 or len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    id_arrow = {"int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8(),
                "string": pa.string()}.get(id_type, pa.int64())
    spread_schema = pa.schema([
        ("page_id", id_arrow), ("url", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", id_arrow),
        ("payload", pa.binary())])
    return spread.mapInArrow(run, _OUT.format(kind=id_type))


def archive_pages(pages: DataFrame, folder: str | None = None, id_col: str = "page_id",
                  url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the archives and returns their manifest. Without ``folder``
    they go to a new one under the shared checkpoint folder."""
    spark: SparkSession = pages.sparkSession
    return write_archives(with_revisits(pages, id_col, url_col, html_col),
                          folder or _as_uri(scratch_path(spark, "warc")))


def _as_uri(path: str) -> str:
    return path if ":" in path.split("/", 1)[0] else f"file://{path}"
