"""Packing: order-preserving cuts of the token stream into windows, by dynamic programming.

Documents keep their order inside a task; their ids form one stream. Cuts may fall
after a document (free), after a sentence (small penalty) or, where a sentence is
long, after every ``step`` ids (larger penalty). A window from cut i to cut j costs
the padding up to ``limit`` - nothing if its length is a power of two - plus the
penalty of cut j. With p the position of a cut,

    f[j] = penalty[j] + limit - p[j] + min(f[i] + p[i]),  p[j] - p[i] <= limit,

so the minimum slides with the window: a monotone queue gives it in constant time
per cut. The smaller powers of two are looked up by position.

Work is done per input partition and in stretches of ``stretch`` ids, whose last
window is carried into the next stretch, so memory is bounded by a stretch and the
longest document. There is no shuffle.

Nulls: a null text is empty and yields its end id alone; other columns are ignored;
rows that repeat an id are packed each. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import sys
import types
import unicodedata
import zlib
from array import array
from collections import deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from eventmill.llm.common import documents, map_arrow

LIMIT = 2048
END_ID = 1
SENTENCE_PENALTY = 8.0
STEP_PENALTY = 48.0
STEP = 128
STRETCH = 1 << 18
CACHE_BYTES = 24 << 20  # of each of two generations of known words
WORD_COST = 200  # bytes of a cache entry beside its word and ranks
BATCH_BYTES = 2 << 20
# Fixed: the split of the word tokenizer, after lower-casing.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


# -- tokens ----------------------------------------------------------------------


class WordIds:
    """Ids of texts by a lower-casing BPE that drops white space and marks word ends.

    Words between blanks are encoded on their own, each distinct one once per batch;
    two generations of known words, bounded by their bytes, are kept. A word of letters runs through
    the same merges, ranked by their order, over its bytes and an end mark; anything
    else goes to the tokenizer. Equal to encoding the whole text (tested).
    """

    END = b"\xff"  # occurs in no UTF-8 text

    def __init__(self, path: str):
        import tiktoken

        self.path, self._tokenizer = path, None
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        if model.get("end_of_word_suffix") != "</w>":
            raise ValueError("the tokenizer must mark the end of words by </w>")
        vocabulary = model["vocab"]
        added = [t["id"] for t in whole.get("added_tokens", [])]
        size = max([*vocabulary.values(), *added]) + 1
        self.ends_sentence = np.zeros(size, bool)
        for piece, i in vocabulary.items():
            self.ends_sentence[i] = bool(re.search(r"[.!?]</w>$", piece))
        # Byte-level vocabularies write bytes without a glyph as characters from 256 on.
        seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
        glyphs = {b: chr(b) for b in seen}
        for n, b in enumerate(sorted(set(range(256)) - set(seen))):
            glyphs[b] = chr(256 + n)
        byte_of = {c: b for b, c in glyphs.items()}
        ranks: dict[bytes, int] = {}
        ids: list[int] = []

        def rank(piece: str) -> None:
            stem = piece.removesuffix("</w>")
            data = bytes(byte_of[c] for c in stem) + (self.END if stem != piece else b"")
            if data not in ranks:
                ranks[data] = len(ids)
                ids.append(vocabulary[piece])

        for suffix in ("", "</w>"):
            for b in range(256):
                rank(glyphs[b] + suffix)
        for merge in model["merges"]:
            rank("".join(merge if isinstance(merge, list) else merge.split(" ")))
        ids += sorted(set(range(size)) - set(ids))
        self.ids = np.asarray(ids, "<u4")
        self.rank_of = np.argsort(self.ids).astype("<u4")
        self.merges = tiktoken.Encoding(
            "words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_single_piece
        self.parts = regex.compile(PARTS).findall
        self.held = 0  # bytes of the new generation
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @property
    def tokenizer(self):
        """The whole tokenizer; few words need it, so it is loaded with the first."""
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def _ranks(self, word: str) -> bytes:
        """Ranks of a word's pieces, as bytes."""
        lower = word.lower()
        if lower.isascii() and lower.isalpha():
            return array("I", self.merges(lower.encode() + self.END)).tobytes()
        # The whole tokenizer where a capital sigma is lowered by its neighbours, where
        # marks may combine, and where its special tokens or other blanks may occur.
        if "Σ" in word or "<|" in word or not unicodedata.is_normalized("NFC", lower) or (
            len(lower.split()) != 1
        ):
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return self.rank_of[ids].tobytes() if ids else b""
        out: list[int] = []
        for part in self.parts(lower):
            out += self.merges(part.encode() + self.END)
        return array("I", out).tobytes()

    def _learn(self, words: list[str]) -> list[bytes]:
        new, old, ranks, out = self.new, self.old, self._ranks, []
        for word in words:
            known = new.get(word)
            if known is None:
                known = old.get(word)
                if known is None:
                    known = ranks(word)
                new[word] = known
                self.held += len(word) + len(known) + WORD_COST
            out.append(known)
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text; null texts have none."""
        if self.held > CACHE_BYTES:
            self.old, self.new, self.held = self.new, {}, 0
        blank = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        split = pc.split_pattern(blank, " ")
        coded = split.flatten().dictionary_encode()
        words = self._learn(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, words), np.int64, len(words)) >> 2
        flat = self.ids[np.frombuffer(b"".join(words), "<u4")]
        firsts = np.cumsum(lengths) - lengths
        index = coded.indices.to_numpy()
        each = lengths[index]
        ends = np.concatenate(([0], np.cumsum(each)))
        gather = np.repeat(firsts[index] - ends[:-1], each)
        gather += np.arange(ends[-1])
        ids = flat[gather]
        at = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def word_ids(path: str) -> WordIds:
    """The worker's tokenizer; a reused worker keeps its words from task to task."""
    kept = sys.modules.setdefault("eventmill_word_ids", types.ModuleType("eventmill_word_ids"))
    if path not in kept.__dict__:
        kept.__dict__[path] = WordIds(path)
    return kept.__dict__[path]


# -- cuts ------------------------------------------------------------------------


def cut_points(ids: np.ndarray, ends_sentence: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a document where it may be cut, and what kind: 1 sentence, 2 step."""
    inner = np.flatnonzero(ends_sentence[ids[:-1]]) + 1
    inner = inner[inner < len(ids) - 1]
    edges = np.concatenate(([0], inner, [len(ids)]))
    gaps = np.diff(edges)
    extra = (gaps - 1) // step
    if not extra.any():
        return inner, np.ones(len(inner), np.int8)
    starts = np.repeat(edges[:-1], extra)
    nth = np.arange(len(starts)) - np.repeat(np.cumsum(extra) - extra, extra) + 1
    at = np.concatenate((inner, starts + nth * step))
    kind = np.concatenate((np.ones(len(inner), np.int8), np.full(len(starts), 2, np.int8)))
    order = np.argsort(at, kind="stable")
    return at[order], kind[order]


def exact_windows(positions: np.ndarray, limit: int) -> dict[int, list[int]]:
    """For a cut, the earlier ones a power of two below ``limit`` away, the furthest first."""
    index = np.full(positions[-1] - positions[0] + 1, -1)
    index[positions - positions[0]] = np.arange(len(positions))
    found: dict[int, list[int]] = {}
    for k in range((limit - 1).bit_length() - 1, -1, -1):
        first = np.searchsorted(positions, positions[0] + (1 << k))
        before = index[positions[first:] - positions[0] - (1 << k)]
        for j in np.flatnonzero(before >= 0).tolist():
            found.setdefault(first + j, []).append(int(before[j]))
    return found


def best_cuts(positions: list[int], penalties: list[float], limit: int) -> list[int]:
    """Cuts (as indexes of ``positions``, the first and last included) of least cost.

    ``positions`` rise strictly and no two neighbours lie further apart than ``limit``.
    Equal costs fall to the longer last window, then to the power of two.
    """
    n = len(positions)
    cost, back = [0.0] * n, [0] * n
    full = exact_windows(np.asarray(positions), limit)
    queue: deque[tuple[float, int]] = deque([(positions[0] + 0.0, 0)])
    for j in range(1, n):
        p = positions[j]
        while positions[queue[0][1]] < p - limit:
            queue.popleft()
        low, i = queue[0]
        best = low + limit - p
        for k in full.get(j, ()):
            if cost[k] < best:
                best, i = cost[k], k
        best += penalties[j]
        cost[j], back[j] = best, i
        key = best + p
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, j))
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def padding(length: int, limit: int) -> int:
    return 0 if length & (length - 1) == 0 else limit - length


class Packer:
    """Pieces of a stream of documents, a stretch of ids at a time."""

    def __init__(self, limit: int, stretch: int, step: int, ends_sentence: np.ndarray, first: int):
        self.limit, self.stretch, self.step = limit, stretch, step
        self.ends_sentence, self.sequence = ends_sentence, first
        self.held: list[tuple] = []  # (doc_id, ids, start, end, doc_tokens) not yet placed
        self.held_ids = 0

    def add(self, doc_id, ids: np.ndarray) -> list[tuple]:
        """Take a document; the pieces placed meanwhile."""
        out, at = [], 0
        while at < len(ids):
            end = min(len(ids), at + max(1, self.stretch - self.held_ids))
            self.held.append((doc_id, ids, at, end, len(ids)))
            self.held_ids += end - at
            at = end
            if self.held_ids >= self.stretch:
                out += self.place(last=False)
        return out

    def place(self, last: bool) -> list[tuple]:
        if not self.held:
            return []
        points, kinds, base = [np.zeros(1, np.int64)], [np.zeros(1, np.int8)], 0
        for _, ids, start, end, size in self.held:
            at, kind = cut_points(ids[start:end], self.ends_sentence, self.step)
            points += [base + at, np.asarray([base + end - start])]
            kinds += [kind, np.asarray([0 if end == size else 2], np.int8)]
            base += end - start
        position = np.concatenate(points).tolist()
        penalty = np.asarray([0.0, SENTENCE_PENALTY, STEP_PENALTY])[np.concatenate(kinds)].tolist()
        cuts = [position[i] for i in best_cuts(position, penalty, self.limit)]
        if not last and len(cuts) > 2:
            cuts.pop()  # the last window goes on in the next stretch
        return self._emit(cuts)

    def _emit(self, cuts: list[int]) -> list[tuple]:
        out, base, w = [], 0, 1
        rest = []
        for doc_id, ids, start, end, size in self.held:
            at = start
            while at < end and w < len(cuts):
                stop = min(end, start + cuts[w] - base)
                if stop > at:
                    crc = zlib.crc32(memoryview(ids[at:stop]).cast("B"))
                    offset = base + at - start - cuts[w - 1]
                    out.append((doc_id, at, stop - at, crc, size, self.sequence, offset))
                at = stop
                if base + at - start == cuts[w]:
                    w += 1
                    self.sequence += 1
            if at < end:
                rest.append((doc_id, ids, at, end, size))
            base += end - start
        self.held, self.held_ids = rest, sum(x[3] - x[2] for x in rest)
        return out


# -- Spark -----------------------------------------------------------------------


def pack(
    df: DataFrame,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    end_id: int = END_ID,
    step: int = STEP,
    stretch: int = STRETCH,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``limit`` ids.

    ``sequence_id`` is the partition's number times 2^32 plus a running number.
    """
    import public_tokenizers

    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    schema = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])

    def run(batches):
        from pyspark import TaskContext

        encoder = word_ids(path)
        first = TaskContext.get().partitionId() << 32
        packer = Packer(limit, stretch, step, encoder.ends_sentence, first)
        end = np.asarray([end_id], "<u4")

        def rows(pieces):
            if pieces:
                columns = [pa.array(c, pa.int64()) for c in zip(*pieces, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            rows_each = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
            for part in (
                batch.slice(i, rows_each) for i in range(0, batch.num_rows, rows_each)
            ):
                pieces = []
                for doc_id, ids in zip(
                    part.column(0).to_pylist(), encoder.encode(part.column(1)), strict=True
                ):
                    pieces += packer.add(doc_id, np.concatenate((ids, end)))
                yield from rows(pieces)
        yield from rows(packer.place(last=True))

    return map_arrow(df.select(id_col, text_col), run, PIECES)


def op7_dp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
