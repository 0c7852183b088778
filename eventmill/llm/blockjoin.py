"""Nearest neighbours by a block matrix join with int8 products and error bounds.

Vectors are packed into blocks: a matrix of the block's distinct vectors, their codes
of one byte per component (one scale per vector), and the norms of what the codes
lose. A product of two codes is a whole number, so a tile of them is exact in float32
for up to 1,040 components (longer ones are added in slabs). With x = x' + e the true
inner product differs from the product of the codes by at most

    |x'| |f| + |e| |y|        (y = y' + f),

so a candidate whose upper bound lies below the k-th best lower bound cannot be among
the k nearest. Only the other pairs are computed again from the original vectors, in
double precision and component by component, and go through one heap per query. Equal
vectors of a block are computed once.

The grid: blocks of queries and of candidates are dealt to groups, and each cell (a
group of each) is one task's work. Its size is bounded by rows on both sides; a query
travels once per group of candidates and back with k rows. There is no cross join.

Vectors that are null, zero or hold null or non-finite components take no part;
vectors of different length are not compared. Rows that repeat an id are rows of their
own: each is answered, and is a candidate for the others. A null id is never a query,
but a candidate (ties: before all others). Other columns are ignored. An empty table,
or one without queries, gives no rows.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmill.llm.common import stored
from eventmill.sources.tables import table

NEAREST = 20
QUERY_STEP = 20
BLOCK_ROWS = 1_024
CANDIDATES_PER_CELL = 1 << 18
QUERIES_PER_CELL = 1 << 16
TILE_QUERIES = 512
TILE_CANDIDATES = 4_096
EXACT_PRODUCTS = 1_040  # 127 * 127 * 1,040 < 2^24
ROUNDING = 1e-9  # relative slack for sums of doubles

NO_ID = -(1 << 63)  # stands for a null id inside a block

BLOCK = "block long, dim int, n int, ids binary, which binary, vectors binary"
QUERY = "block long, dim int, n int, ids binary, rows binary, vectors binary"
FOUND = "row long, query_id long, vec_id long, score double, no_id boolean"


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (float32 holding -127..127), scales, and norms of the coded and the lost part."""
    scale = np.abs(x).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1.0)  # a subnormal vector may scale to nothing
    code = np.clip(np.rint(x / scale[:, None]), -127, 127)
    coded = code * scale[:, None]
    lost = x - coded
    return code.astype(np.int8), scale, _norm(coded), _norm(lost)


def _norm(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1)) * (1 + ROUNDING)


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows, as doubles."""
    total = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], EXACT_PRODUCTS):
        part = slice(i, i + EXACT_PRODUCTS)
        total += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return total


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed component by component."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


class Coded:
    """Vectors of one side of a tile with their codes."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.code, self.scale, self.coded, self.lost = quantise(x)
        self.norm = _norm(x)

    def part(self, rows: slice) -> Coded:
        out = Coded.__new__(Coded)
        for name, values in vars(self).items():
            setattr(out, name, values[rows])
        return out


def survivors(q: Coded, c: Coded, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that may be among the k nearest; ``least`` (a bound per query) is raised.

    A query counts itself among the lower bounds, hence the k + 1.
    """
    near = code_products(q.code, c.code) * q.scale[:, None] * c.scale
    slack = q.coded[:, None] * c.lost + q.lost[:, None] * c.norm
    slack += ROUNDING * q.norm[:, None] * c.norm
    if near.shape[1] > k:
        low = np.partition(near - slack, near.shape[1] - k - 1, axis=1)[:, -k - 1]
        np.maximum(least, low, out=least)
    return np.nonzero(near + slack >= least[:, None])


def join_cell(queries: list[dict], candidates: list[dict], k: int) -> list[tuple]:
    """The k nearest candidates of every query of a cell: (row, query, candidate, score)."""
    vectors = [np.frombuffer(b["vectors"], "<f8").reshape(-1, b["dim"]) for b in candidates]
    ids, rows = [], []  # of every distinct vector: ids and row numbers, ids rising
    for b in candidates:
        of = np.frombuffer(b["which"], "<i4")
        own = np.frombuffer(b["ids"], "<i8")
        order = np.lexsort((own, of))
        first = np.flatnonzero(np.diff(of[order], prepend=-1))
        ids += np.split(own[order], first[1:])
        rows += np.split((b["block"] << 32) + order, first[1:])
    c = Coded(np.concatenate(vectors))
    out = []
    for b in queries:
        mine = Coded(np.frombuffer(b["vectors"], "<f8").reshape(-1, b["dim"]))
        query_ids, query_rows = np.frombuffer(b["ids"], "<i8"), np.frombuffer(b["rows"], "<i8")
        for at in range(0, len(query_ids), TILE_QUERIES):
            part = slice(at, at + TILE_QUERIES)
            found = _join_queries(mine.part(part), query_rows[part].tolist(), c, ids, rows, k)
            for row, query, heap in zip(
                query_rows[part].tolist(), query_ids[part].tolist(), found, strict=True
            ):
                out += [(row, query, -other, score) for score, other in heap]
    return out


def _join_queries(q: Coded, own: list[int], c: Coded, ids: list, rows: list, k: int) -> list[list]:
    """A heap per query of (score, minus id); the smallest is the one to go."""
    heaps: list[list] = [[] for _ in own]
    least = np.full(len(own), -np.inf)
    for at in range(0, len(c.x), TILE_CANDIDATES):
        i, j = survivors(q, c.part(slice(at, at + TILE_CANDIDATES)), k, least)
        for a in range(0, len(i), 1 << 16):  # bounds the vectors gathered at a time
            some = slice(a, a + (1 << 16))
            scores = exact_products(q.x[i[some]], c.x[at + j[some]])
            for query, other, score in zip(
                i[some].tolist(), (at + j[some]).tolist(), scores.tolist(), strict=True
            ):
                heap = heaps[query]
                if len(heap) == k and score < heap[0][0]:
                    continue
                # Of equal vectors the smallest ids come first; one may be the query itself.
                for vec_id, row in zip(ids[other][: k + 1].tolist(), rows[other][: k + 1], strict=True):
                    if row == own[query]:
                        continue
                    entry = (score, -vec_id)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    else:
                        break
        for query, heap in enumerate(heaps):
            if len(heap) == k:
                least[query] = max(least[query], heap[0][0] - ROUNDING * abs(heap[0][0]))
    return heaps


# -- Spark -----------------------------------------------------------------------


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, ddl.split(", "))])


def pack_blocks(df: DataFrame, id_col: str, vector_col: str, block_rows: int) -> DataFrame:
    """One row per block of up to ``block_rows`` rows of a partition and of one length."""
    schema = _schema(BLOCK)

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 20
        held: dict[int, list[tuple]] = {}

        def packed(dim: int, rows: list[tuple]) -> pa.RecordBatch:
            nonlocal block
            x = np.asarray([r[1] for r in rows], "<f8").reshape(-1, dim)
            distinct, which = np.unique(x, axis=0, return_inverse=True)
            ids = np.asarray([NO_ID if r[0] is None else r[0] for r in rows], "<i8")
            values = (
                block, dim, len(rows), ids.tobytes(),
                which.reshape(-1).astype("<i4").tobytes(), distinct.astype("<f8").tobytes(),
            )
            block += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema
            )

        for batch in batches:
            for vec_id, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = held.setdefault(len(vector), [])
                rows.append((vec_id, vector))
                if len(rows) == block_rows:
                    yield packed(len(vector), held.pop(len(vector)))
        for dim, rows in held.items():
            yield packed(dim, rows)

    vector = F.col(vector_col).cast("array<double>")
    taking_part = df.select(F.col(id_col).cast("long").alias("id"), vector.alias("x")).filter(
        F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists("x", lambda v: v != 0)
    )
    return taking_part.mapInArrow(run, BLOCK)


def query_blocks(blocks: DataFrame, step: int) -> DataFrame:
    """The queries of every block: rows whose id is divisible by ``step``."""
    schema = _schema(QUERY)

    def run(batches):
        for batch in batches:
            for b in batch.to_pylist():
                ids = np.frombuffer(b["ids"], "<i8")
                rows = np.flatnonzero((ids != NO_ID) & (ids % step == 0))
                if not len(rows):
                    continue
                x = np.frombuffer(b["vectors"], "<f8").reshape(-1, b["dim"])
                x = x[np.frombuffer(b["which"], "<i4")[rows]]
                values = (
                    b["block"], b["dim"], len(rows), ids[rows].tobytes(),
                    ((b["block"] << 32) + rows).tobytes(), x.tobytes(),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(values, schema, strict=True)],
                    schema=schema,
                )

    return blocks.mapInArrow(run, QUERY)


def _counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    seen = Observation()
    kept = stored(df.observe(seen, F.sum("n").alias("n")), label)
    return kept, seen.get["n"] or 0


def nearest(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEAREST,
    query_step: int = QUERY_STEP,
    block_rows: int = BLOCK_ROWS,
    candidates_per_cell: int = CANDIDATES_PER_CELL,
    queries_per_cell: int = QUERIES_PER_CELL,
) -> DataFrame:
    """The ``k`` rows of largest inner product for every row whose id ``query_step`` divides."""
    spark = df.sparkSession
    blocks, rows = _counted(pack_blocks(df, id_col, vector_col, block_rows), "vector-blocks")
    queries, asked = _counted(query_blocks(blocks, query_step), "query-blocks")
    # Few groups mean few copies; cells are bounded, and enough of them for all cores.
    across = max(1, math.ceil(asked / queries_per_cell))
    cores = 2 * spark.sparkContext.defaultParallelism
    down = max(1, math.ceil(rows / candidates_per_cell), math.ceil(cores / across))

    def dealt(of: DataFrame, groups: int, others: int, own: str, other: str) -> DataFrame:
        """Every block with its own group, once for each group of the other side."""
        mine = F.pmod(F.xxhash64(F.lit(own), "block"), F.lit(groups)).cast("int")
        return of.withColumn(own, mine).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        )

    schema = pa.schema([
        ("row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
        ("score", pa.float64()), ("no_id", pa.bool_()),
    ])

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        asked, held = left.to_pylist(), right.to_pylist()
        found = join_cell(asked, held, k) if asked and held else []
        columns = [list(c) for c in zip(*found, strict=True)] or [[], [], [], []]
        columns.append([v == NO_ID for v in columns[2]])
        return pa.table(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    keys = ["dim", "across", "down"]
    parts = (
        dealt(queries, across, down, "across", "down").groupBy(*keys)
        .cogroup(dealt(blocks, down, across, "down", "across").groupBy(*keys))
        .applyInArrow(cell, FOUND)
    )
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        parts.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select(
            "query_id", "rank",
            F.when(~F.col("no_id"), F.col("vec_id")).alias("vec_id"), "score",
        )
    )


def op12_block_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


# Rows have distinct ids here.
OP12_SQL = f"""
WITH vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
  WHERE q.vec_id % {QUERY_STEP} = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {NEAREST}
"""
