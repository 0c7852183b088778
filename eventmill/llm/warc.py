"""WARC: a dictionary-compressed writer and its reader.

Every task writes archives of its own (``.warc.zst``): a leading skippable frame
holds a Zstandard dictionary trained on the first records of that archive, each
record follows as a frame of its own, so any record can be read alone. Payloads
that occur twice or more are written once; the others become revisit records.

A task's archives count only once its manifest row is committed, so lost or
repeated attempts leave files that nothing refers to.

Nulls: a null payload is empty, a null id or address leaves its header out (and is
read back as null). Payloads below ``dedup_bytes`` are never revisits. Rows that
repeat both id and payload of the smallest id are all responses. An empty table
gives no archives and no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
import zstandard as zstd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import pages, stored
from eventmill.session import work_dir

DICTIONARY_MAGIC = 0x184D2A5D  # skippable frame that holds a dictionary
TRAINED_MAGIC = b"\x37\xa4\x30\xec"
READ_BYTES = 1 << 20


# -- records ---------------------------------------------------------------------


def record_bytes(kind, page_id, url, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    body = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest}')}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(body)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        # A line break would end the header: such an address is escaped, and marked.
        plain = "\r" not in url and "\n" not in url
        head.append("WARC-Target-URI: " + (url if plain else quote(url)))
        if not plain:
            head.append("X-Target-URI-Escaped: percent")
    if kind == "revisit":
        source = uuid.uuid5(uuid.NAMESPACE_URL, f"{refers_to} {digest}")
        head += [
            "WARC-Profile: "
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{source}>",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def header_fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (x.partition(": ") for x in lines)}


def parse_record(data: bytes) -> dict:
    """Fields of one record; the digest of a response is computed from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = header_fields(head)
    body = rest[: int(fields["content-length"])]
    if rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    http, _, payload = body.partition(b"\r\n\r\n")
    stated = fields["warc-payload-digest"].removeprefix("sha256:")
    size = int(header_fields(http)["content-length"])
    kind = fields["warc-type"]
    if kind == "response" and (
        len(payload) != size or hashlib.sha256(payload).hexdigest() != stated
    ):
        raise ValueError("payload differs from its digest")
    url = fields.get("warc-target-uri")
    if "x-target-uri-escaped" in fields:
        url = unquote(url)
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("x-page-id"),
        "url": url,
        "payload_bytes": size,
        "payload_digest": stated,
        "record_type": kind,
        "refers_to": number("x-refers-to-page-id"),
        "payload": payload if kind == "response" else None,
    }


# -- archives --------------------------------------------------------------------


def train_dictionary(records: list[bytes], size: int) -> zstd.ZstdCompressionDict:
    """A trained dictionary, or the records' start as raw content if they are too few."""
    try:
        return zstd.train_dictionary(size, records)
    except zstd.ZstdError:
        return zstd.ZstdCompressionDict(
            b"".join(records)[:size], dict_type=zstd.DICT_TYPE_RAWCONTENT
        )


def load_dictionary(data: bytes) -> zstd.ZstdCompressionDict:
    kind = zstd.DICT_TYPE_FULLDICT if data[:4] == TRAINED_MAGIC else zstd.DICT_TYPE_RAWCONTENT
    return zstd.ZstdCompressionDict(data, dict_type=kind)


class ArchiveWriter:
    """One archive: holds back the first records until the dictionary is trained."""

    def __init__(self, out, dictionary_bytes: int, sample_bytes: int, level: int):
        self.out, self.level = out, level
        self.dictionary_bytes, self.sample_bytes = dictionary_bytes, sample_bytes
        self.waiting: list[bytes] = []
        self.waiting_bytes = self.written = self.records = 0
        self.compressor = None

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.compressor is not None:
            self._emit(self.compressor.compress(record))
            return
        self.waiting.append(record)
        self.waiting_bytes += len(record)
        if self.waiting_bytes >= self.sample_bytes:
            self._start()

    def close(self) -> None:
        if self.compressor is None:
            self._start()
        self.out.close()

    def _start(self) -> None:
        dictionary = train_dictionary(self.waiting, self.dictionary_bytes)
        content = dictionary.as_bytes()
        self._emit(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
        self.compressor = zstd.ZstdCompressor(
            level=self.level, dict_data=dictionary, write_checksum=True, write_content_size=True
        )
        for record in self.waiting:
            self._emit(self.compressor.compress(record))
        self.waiting = []

    def _emit(self, data: bytes) -> None:
        self.out.write(data)
        self.written += len(data)


def read_archive(stream) -> Iterator[bytes]:
    """Records of an archive, one after the other, in constant memory."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("archive does not start with a dictionary")
    decompressor = zstd.ZstdDecompressor(dict_data=load_dictionary(stream.read(size)))
    data = stream.read(READ_BYTES)
    while data:
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not data:
                raise ValueError("archive is cut short")
            parts.append(frame.decompress(data))
            data = frame.unused_data or stream.read(READ_BYTES)
        yield b"".join(parts)


# -- Spark -----------------------------------------------------------------------


def write_archives(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    dedup_bytes: int = 100,
    archive_bytes: int = 256 << 20,
    dictionary_bytes: int = 112_640,
    sample_bytes: int = 4 << 20,
    level: int = 3,
) -> DataFrame:
    """Write the rows as archives; return the manifest (path, records, bytes).

    The first record of equal payloads comes from a count per digest, of which only
    repeated digests are stored. That small table is joined from storage, so Spark
    broadcasts it by its known size or splits a hot digest.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = df.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        payload.alias("payload"),
        F.sha2(F.encode(payload, "UTF-8"), 256).alias("digest"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    first = stored(
        rows.filter(F.col("size") >= dedup_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", "first_id"),
        "warc-first",
    )
    refers = F.when(~F.col("first_id").eqNullSafe(F.col("page_id")), F.col("first_id"))
    rows = rows.join(first, "digest", "left").withColumn("refers_to", refers)
    # A revisit carries no payload; it need not leave the JVM.
    rows = rows.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload"))).select(
        "page_id", "url", "payload", "digest", "size", "refers_to"
    )
    folder = work_dir(df.sparkSession, "warc")

    def write(batches):
        filesystem, root = pafs.FileSystem.from_uri(folder)
        filesystem.create_dir(root, recursive=True)
        writer, path, done = None, None, []
        for batch in batches:
            for page_id, url, payload, digest, size, refers_to in zip(
                *(batch.column(i).to_pylist() for i in range(6)), strict=True
            ):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    path = f"{folder}/{name}"
                    out = filesystem.open_output_stream(f"{root}/{name}", buffer_size=1 << 20)
                    writer = ArchiveWriter(out, dictionary_bytes, sample_bytes, level)
                kind = "response" if refers_to is None else "revisit"
                data = (payload or "").encode()
                writer.add(record_bytes(kind, page_id, url, data, size, digest, refers_to))
                if writer.written >= archive_bytes:
                    writer.close()
                    done.append((path, writer.records, writer.written))
                    writer = None
        if writer is not None:
            writer.close()
            done.append((path, writer.records, writer.written))
        if done:
            yield from to_batches(pd.DataFrame(done, columns=["path", "records", "bytes"]))

    manifest = rows.mapInArrow(write, "path string, records long, bytes long")
    return stored(manifest, "warc-manifest")


def to_batches(frame: pd.DataFrame):
    import pyarrow as pa

    return pa.Table.from_pandas(frame, preserve_index=False).to_batches()


RECORD_COLUMNS = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def read_archives(manifest: DataFrame, payloads: bool = False, batch_rows: int = 256) -> DataFrame:
    """Records of the archives a manifest lists; each archive is read by one task."""
    schema = RECORD_COLUMNS + (", payload binary" if payloads else "")
    columns = [c.split()[0] for c in schema.split(", ")]

    def read(batches):
        import pyarrow as pa

        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[dict] = []
                filesystem, inside = pafs.FileSystem.from_uri(path)
                with filesystem.open_input_stream(inside) as stream:
                    for data in read_archive(stream):
                        record = parse_record(data)
                        rows.append({c: record[c] for c in columns})
                        if len(rows) >= batch_rows:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    parallel = manifest.sparkSession.sparkContext.defaultParallelism * 4
    return manifest.select("path").repartition(parallel).mapInArrow(read, schema)


def in_memory_archive(records: list[bytes], **options) -> bytes:
    """The bytes of one archive, for small sets of records."""
    out = io.BytesIO()
    out.close, close = (lambda: None), out.close
    writer = ArchiveWriter(
        out, options.get("dictionary_bytes", 112_640), options.get("sample_bytes", 4 << 20),
        options.get("level", 3),
    )
    for record in records:
        writer.add(record)
    writer.close()
    data = out.getvalue()
    close()
    return data


def op1_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(pages(spark, sf_dir))
    return read_archives(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP1_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit'
    ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""
