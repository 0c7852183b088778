"""Fill-in-the-middle over texts kept as seekable compressed frames.

A text is stored as independent zstandard frames of ``frame_bytes`` bytes, led by a
skippable frame with an index: for every frame its compressed size, its bytes, the
units that start in it and its code points. A unit is a run of blanks with the word
after it, or the blanks at the end; one starts at the beginning and wherever a blank
follows a non-blank, so a frame needs only the byte before it to count them.

A cut after k units is found in the running unit counts, and only the frame that
holds it is decompressed. The transformed text is spliced: frames between cuts are
taken over as they are, only the parts of cut frames are compressed anew. Digests
stream the frames in order, so no step holds more than a frame beside the archive.

Nulls: a null text is empty, a null id draws like the empty id. An empty or marked
text (it contains ``<P>``, ``<S>`` or ``<M>``) stays plain. Rows that repeat an id are
transformed each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from eventmill.llm.common import SPACE_CHARS, documents, map_arrow

FRAME_BYTES = 1 << 16
LEVEL = 1
SEED = 42
FIM_PERCENT = 50
SPM_PERCENT = 80
BATCH_BYTES = 4 << 20

INDEX_MAGIC = 0x184D2A50  # a skippable frame
ENTRY = "<IIII"  # compressed size, bytes, units, code points
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
# The order in which a form writes prefix, suffix and middle.
ORDERS = {"psm": "PSM", "spm": "SPM"}

TRANSFORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"
DIGESTED = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "output_sha256 string, restored_sha256 string"
)

_BLANK = np.zeros(256, bool)
_BLANK[list(SPACE_CHARS.encode())] = True


def unit_starts(chunk: bytes) -> np.ndarray:
    """Which bytes of a chunk start a unit, but for the first, which its neighbour decides."""
    blank = _BLANK[np.frombuffer(chunk, np.uint8)]
    starts = np.zeros(len(chunk), bool)
    starts[1:] = blank[1:] & ~blank[:-1]
    return starts


def code_points(chunk: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(chunk, np.uint8) & 0xC0) != 0x80))


class Codec:
    """Compressor and decompressor, made once per task."""

    def __init__(self):
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.decompress = zstandard.ZstdDecompressor().decompress
        self.marks = {k: (self.compress(m), (len(m), 0, len(m))) for k, m in MARKS.items()}


class Frames:
    """Independent frames with running counts of bytes, units and code points."""

    def __init__(self, codec: Codec, frames: list[bytes], entries: list[tuple[int, int, int]]):
        self.codec, self.frames, self.entries = codec, frames, entries
        columns = zip(*entries, strict=True) if entries else ((), (), ())
        self.bytes, self.units, self.chars = (
            list(accumulate(column, initial=0)) for column in columns
        )
        self._last = (-1, b"")

    @classmethod
    def of_text(cls, codec: Codec, data: bytes, frame_bytes: int = FRAME_BYTES) -> Frames:
        frames, entries = [], []
        for at in range(0, len(data), frame_bytes):
            chunk = data[at : at + frame_bytes]
            first = at == 0 or (_BLANK[chunk[0]] and not _BLANK[data[at - 1]])
            units = int(np.count_nonzero(unit_starts(chunk))) + int(first)
            frames.append(codec.compress(chunk))
            entries.append((len(chunk), units, code_points(chunk)))
        return cls(codec, frames, entries)

    def pack(self) -> bytes:
        """A valid zstandard stream: the index in a skippable frame, then the frames."""
        index = b"".join(
            struct.pack(ENTRY, len(f), *e) for f, e in zip(self.frames, self.entries, strict=True)
        )
        return b"".join((struct.pack("<II", INDEX_MAGIC, len(index)), index, *self.frames))

    @classmethod
    def unpack(cls, codec: Codec, archive: bytes) -> Frames:
        magic, size = struct.unpack_from("<II", archive)
        if magic != INDEX_MAGIC:
            raise ValueError("the archive has no index in front")
        rows = list(struct.iter_unpack(ENTRY, archive[8 : 8 + size]))
        ends = list(accumulate((r[0] for r in rows), initial=8 + size))
        frames = [archive[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return cls(codec, frames, [r[1:] for r in rows])

    def read(self, i: int) -> bytes:
        """One frame's bytes; the last one read is kept."""
        if self._last[0] != i:
            self._last = (i, self.codec.decompress(self.frames[i]))
        return self._last[1]

    def starts(self, i: int) -> np.ndarray:
        """Which bytes of frame i start a unit; the count in the index tells of the first."""
        starts = unit_starts(self.read(i))
        starts[0] = self.entries[i][1] > np.count_nonzero(starts)
        return starts

    def cut(self, k: int) -> tuple[int, int]:
        """Bytes and code points in front of unit k (all of them from the last unit on)."""
        if k >= self.units[-1]:
            return self.bytes[-1], self.chars[-1]
        i = bisect_right(self.units, k) - 1
        at = int(np.flatnonzero(self.starts(i))[k - self.units[i]])
        return self.bytes[i] + at, self.chars[i] + code_points(self.read(i)[:at])

    def _span(self, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """Frames that hold bytes [start, end), and which of their bytes."""
        i = bisect_right(self.bytes, start) - 1
        while start < end:
            stop = min(end, self.bytes[i + 1])
            yield i, start - self.bytes[i], stop - self.bytes[i]
            start, i = stop, i + 1

    def stream(self, start: int = 0, end: int | None = None) -> Iterator[bytes]:
        """Bytes [start, end) in order, a frame at a time."""
        for i, a, b in self._span(start, self.bytes[-1] if end is None else end):
            yield self.read(i)[a:b]

    def splice(self, start: int, end: int) -> Iterator[tuple[bytes, tuple[int, int, int]]]:
        """Frames for bytes [start, end): whole ones as they are, parts compressed anew."""
        for i, a, b in self._span(start, end):
            if b - a == self.entries[i][0]:
                yield self.frames[i], self.entries[i]
            else:
                part = self.read(i)[a:b]
                units = int(np.count_nonzero(self.starts(i)[a:b]))
                yield self.codec.compress(part), (len(part), units, code_points(part))


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers below 2^32 from the seed and the id."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    digest = hashlib.sha256(text.encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transform(
    codec: Codec, doc_id, data: bytes, seed: int, fim_percent: int, spm_percent: int, frame_bytes: int
) -> tuple[int, str, int | None, int | None, Frames]:
    """Units, form, code points of prefix and middle, and the output of one text."""
    text = Frames.of_text(codec, data, frame_bytes)
    n = text.units[-1]
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not data or h3 % 100 >= fim_percent or any(m in data for m in MARKS.values()):
        return n, "plain", None, None, text
    form = "spm" if h4 % 100 < spm_percent else "psm"
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_chars), (b, b_chars) = text.cut(first), text.cut(second)
    parts = {"P": (0, a), "M": (a, b), "S": (b, len(data))}
    out = [x for name in ORDERS[form] for x in (codec.marks[name], *text.splice(*parts[name]))]
    frames, entries = zip(*out, strict=True)
    return n, form, a_chars, b_chars - a_chars, Frames(codec, list(frames), list(entries))


def find_marks(output: Frames) -> dict[str, int]:
    """Where each mark first stands; marks may run across frames."""
    found: dict[str, int] = {}
    at, tail = 0, b""
    for chunk in output.stream():
        window = tail + chunk
        for name, mark in MARKS.items():
            if name not in found and (i := window.find(mark)) >= 0:
                found[name] = at - len(tail) + i
        at += len(chunk)
        tail = window[-2:]
    return found


def restore(output: Frames, form: str) -> Iterator[bytes]:
    """The text, rebuilt from the output and its form alone."""
    if form == "plain":
        yield from output.stream()
        return
    marks = find_marks(output)
    order = ORDERS[form]
    ends = [marks[name] for name in order[1:]] + [output.bytes[-1]]
    parts = {name: (marks[name] + 3, end) for name, end in zip(order, ends, strict=True)}
    for name in "PMS":
        yield from output.stream(*parts[name])


def digest(chunks: Iterator[bytes]) -> str:
    sha = hashlib.sha256()
    for chunk in chunks:
        sha.update(chunk)
    return sha.hexdigest()


# -- Spark -----------------------------------------------------------------------


def _slices(batches) -> Iterator[pa.RecordBatch]:
    """Batches of a few megabytes, whatever their rows hold."""
    for batch in batches:
        rows = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(", "))])


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    frame_bytes: int = FRAME_BYTES,
) -> DataFrame:
    """Transformed texts as archives in ``output``; any zstandard reader unpacks them."""
    schema = _schema(TRANSFORMED)

    def run(batches):
        codec = Codec()
        for part in _slices(batches):
            texts = part.column(1).cast(pa.binary()).to_pylist()
            rows = []
            for doc_id, data in zip(part.column(0).to_pylist(), texts, strict=True):
                n, form, prefix, middle, out = transform(
                    codec, doc_id, data or b"", seed, fim_percent, spm_percent, frame_bytes
                )
                rows.append((doc_id, n, form, prefix, middle, out.pack()))
            yield _batch(rows, schema)

    return map_arrow(df.select(id_col, text_col), run, TRANSFORMED)


def output_digests(transformed: DataFrame) -> DataFrame:
    """SHA-256 of every output and of the text rebuilt from it."""
    schema = _schema(DIGESTED)

    def run(batches):
        codec = Codec()
        for part in _slices(batches):
            rows = []
            for *head, archive in zip(*(c.to_pylist() for c in part.columns), strict=True):
                out = Frames.unpack(codec, archive)
                rows.append((*head, digest(out.stream()), digest(restore(out, head[2]))))
            if rows:
                yield _batch(rows, schema)

    return map_arrow(transformed, run, DIGESTED)


def op11_seekable_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return output_digests(fill_in_middle(documents(spark, sf_dir)))


OP11_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
    sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''),
      '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM docs),
cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
      OR contains(text, '<M>') OR h3 % 100 >= {FIM_PERCENT} THEN 'plain'
      WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p,
    coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(units[b + 1:], ''), '') AS s FROM cuts)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
