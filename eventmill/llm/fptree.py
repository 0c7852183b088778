"""Ranked lexical search by a document FP-tree with branch and bound.

Items are the stated query set. They come in blocks of bounded size (terms of a block
travel with the tasks); each block is one pass over the documents:

1. Every whole text becomes its vector restricted to the block's terms, stored.
   Counts over all documents (N, L, df) give the weights.
2. A task inserts its vectors, terms ordered by falling df, into trees of bounded size.
   Documents that share a beginning share a path; a node with at least ``least_docs``
   documents below it keeps, per term, the largest tf of its subtree, and the smallest m.
3. The score of a term rises with tf and falls with m, so these two bound every
   document of a subtree. For each item the nodes are walked depth first, best bound
   first; a subtree whose bound is below the item's k-th best score is left out, all
   other documents are scored. The k best per item and task meet in a last ranking.

Documents with equal vectors and m are one leaf with their ids in order, so copies are
scored once. Nothing is cut off: the bounds are exact integers.

Nulls: a null text has no terms, and such a document is in no count. A null doc_id
ranks before all others of its score. Rows that repeat a doc_id are ranked each; rows
that repeat an item_id are items of their own, with ranks of their own. Other columns
are ignored. Without items or documents there are no rows.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmill.llm.common import documents, map_arrow, stored
from eventmill.sources.tables import table

TOP = 50
BLOCK_TERMS = 200_000  # distinct terms of the items of one pass
TREE_ENTRIES = 1_000_000  # terms of the vectors of one tree
LEAST_DOCS = 4
SCALE = 1_000_000_000

VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id long, score long"

# Bytes of terms, A-Z lower-cased; every other byte separates.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def share_of(tf, m):
    """What a term's weight is multiplied by; numbers or arrays of 64-bit integers."""
    return (SCALE * tf) // (1_000 * tf + 20 * m)


class Tree:
    """An FP-tree over restricted vectors, kept as arrays.

    ``vectors``: (terms in order of falling df, tfs, m, doc_id). Nodes are numbered from
    the root (0) so that a parent comes before its children.
    """

    def __init__(self, vectors: list[tuple], least_docs: int):
        same: dict[tuple, list] = {}
        for terms, tfs, m, doc_id in vectors:
            same.setdefault((terms, tfs, m), []).append(doc_id)
        # The order of the trie: documents below a node stand side by side.
        keys = sorted(same)
        self.leaves = []
        for terms, tfs, m in keys:
            tf, ids = np.asarray(tfs, np.int64), sorted(same[terms, tfs, m], key=lambda i: (i is not None, i))
            share = share_of(tf, m).tolist()
            self.leaves.append((dict(zip(terms, share, strict=True)), ids))
        self._nodes([k[0] for k in keys], least_docs)
        self._bounds(keys)

    def _nodes(self, paths: list[tuple], least_docs: int) -> None:
        """Branching nodes of the paths; each leaf hangs on the lowest one kept."""
        found = []  # (first leaf, end, depth) of branching nodes
        stack: list[tuple[int, int]] = [(0, 0)]  # (depth, first leaf) of the open path
        for at in range(1, len(paths) + 1):
            shared = -1
            if at < len(paths):
                a, b = paths[at - 1], paths[at]
                shared, most = 0, min(len(a), len(b))
                while shared < most and a[shared] == b[shared]:
                    shared += 1
            first = at - 1
            while stack and stack[-1][0] > shared:
                depth, first = stack.pop()
                if at - first >= least_docs:
                    found.append((first, at, depth))
            if shared >= 0 and (not stack or stack[-1][0] < shared):
                stack.append((shared, first))
        if not any(x[0] == 0 and x[1] == len(paths) for x in found):
            found.append((0, len(paths), 0))
        found.sort(key=lambda x: (x[0], -x[1], x[2]))
        self.parent, self.children = [-1], [[]]
        self.own: list[list[int]] = [[]]  # leaves that hang on the node itself
        open_nodes = [(0, found[0][1])]
        end_of = {0: found[0][1]}
        starts = {}
        for first, end, _ in found[1:]:
            if end == end_of[open_nodes[-1][0]] and first == starts.get(open_nodes[-1][0], 0):
                continue  # the same documents as the node above
            while open_nodes[-1][1] <= first:
                open_nodes.pop()
            above, node = open_nodes[-1][0], len(self.parent)
            self.parent.append(above)
            self.children.append([])
            self.own.append([])
            self.children[above].append(node)
            starts[node], end_of[node] = first, end
            open_nodes.append((node, end))
        starts[0] = 0
        holder = np.zeros(len(paths), np.int64)
        for node in range(len(self.parent)):  # parents first, so the lowest stays
            holder[starts[node] : end_of[node]] = node
        self.holder = holder
        for leaf, node in enumerate(holder.tolist()):
            self.own[node].append(leaf)

    def _bounds(self, keys: list[tuple]) -> None:
        """Per term: the nodes that hold it below them, with the largest tf; per node the least m."""
        nodes = len(self.parent)
        depth = [0] * nodes
        for node in range(1, nodes):
            depth[node] = depth[self.parent[node]] + 1
        levels: list[list[int]] = [[] for _ in range(max(depth) + 1)]
        for node, d in enumerate(depth):
            levels[d].append(node)
        self.least_m = np.full(nodes, np.iinfo(np.int64).max)
        np.minimum.at(self.least_m, self.holder, np.asarray([k[2] for k in keys], np.int64))
        for node in range(nodes - 1, 0, -1):
            above = self.parent[node]
            self.least_m[above] = min(self.least_m[above], self.least_m[node])
        sizes = [len(k[0]) for k in keys]
        term = np.fromiter((t for k in keys for t in k[0]), np.int64, sum(sizes))
        tf = np.fromiter((t for k in keys for t in k[1]), np.int64, sum(sizes))
        at = np.repeat(self.holder, sizes)
        parent, level = np.asarray(self.parent), np.asarray(depth)[at]
        order = np.argsort(level, kind="stable")
        term, tf, at, level = term[order], tf[order], at[order], level[order]
        edges = np.searchsorted(level, np.arange(len(levels) + 1))
        carried = (term[:0], tf[:0], at[:0])
        kept = []
        for d in range(len(levels) - 1, -1, -1):
            here = slice(edges[d], edges[d + 1])
            t, f, n = (np.concatenate(x) for x in zip(
                (term[here], tf[here], at[here]), carried, strict=True
            ))
            order = np.lexsort((n, t))
            t, f, n = t[order], f[order], n[order]
            first = np.flatnonzero((np.diff(t, prepend=-1) != 0) | (np.diff(n, prepend=-1) != 0))
            if len(first):
                t, f, n = t[first], np.maximum.reduceat(f, first), n[first]
                kept.append((t, f, n))
            carried = (t, f, parent[n]) if d else carried
        t, f, n = (np.concatenate(x) for x in zip(*kept, strict=True)) if kept else carried
        order = np.argsort(t, kind="stable")
        t, self.tf, self.node = t[order], f[order], n[order]
        first = np.flatnonzero(np.diff(t, prepend=-1))
        ends = [*first[1:].tolist(), len(t)]
        self.span = dict(zip(t[first].tolist(), zip(first.tolist(), ends, strict=True), strict=True))

    def bounds(self, item: list[tuple[int, int]]) -> np.ndarray:
        """No document below a node scores more than this."""
        total = np.zeros(len(self.parent), np.int64)
        for term, weight in item:
            if term in self.span:
                a, b = self.span[term]
                at = self.node[a:b]  # a node occurs once in a term's span
                total[at] += weight * share_of(self.tf[a:b], self.least_m[at])
        return total

    def search(self, item: list[tuple[int, int]], heap: list, k: int) -> None:
        """Push the documents that belong to the k best of the item on its heap.

        Entries are (score, minus doc_id), a null id above all of its score.
        """
        bound = self.bounds(item).tolist()
        todo = [0]
        while todo:
            node = todo.pop()
            if bound[node] <= 0 or (len(heap) == k and bound[node] < heap[0][0]):
                continue
            for leaf in self.own[node]:
                share, ids = self.leaves[leaf]
                score = 0
                for term, weight in item:
                    if term in share:
                        score += weight * share[term]
                if score <= 0 or (len(heap) == k and score < heap[0][0]):
                    continue
                for doc_id in ids:
                    entry = (score, math.inf if doc_id is None else -doc_id)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    else:
                        break
            todo += sorted(self.children[node], key=bound.__getitem__)


# -- Spark -----------------------------------------------------------------------


def item_blocks(items: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    """(item_id, terms) in blocks of about ``most`` terms, streamed through the driver."""
    block, held = [], 0
    for row in items.select(id_col, text_col).toLocalIterator():
        terms = sorted(set(terms_of(row[1].encode() if row[1] else None)))
        if block and held + len(terms) > most:
            yield block
            block, held = [], 0
        block.append((row[0], terms))
        held += len(terms)
    if block:
        yield block


def restricted_vectors(df: DataFrame, id_col: str, text_col: str, number: dict[bytes, int]) -> DataFrame:
    """Number of terms of every document, and the counts of the terms in ``number``."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()),
        ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int32())),
    ])
    known = number.keys()

    def run(batches):
        for batch in batches:
            ns, terms, tfs = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = terms_of(text.as_py())
                counts = Counter(words)
                found = counts.keys() & known
                ns.append(len(words))
                terms.append([number[t] for t in found])
                tfs.append([counts[t] for t in found])
            columns = (batch.column(0), ns, terms, tfs)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                 for c, f in zip(columns, schema, strict=True)],
                schema=schema,
            )

    return map_arrow(df.select(F.col(id_col).cast("long"), text_col), run, VECTORS)


def _search_block(
    df: DataFrame, block: list[tuple], id_col: str, text_col: str, k: int,
    tree_entries: int, least_docs: int,
) -> DataFrame:
    number = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
    vectors = stored(
        restricted_vectors(df, id_col, text_col, number).filter("n > 0"), "restricted-vectors"
    )
    whole = vectors.agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    docs, length = whole["N"], whole["L"] or 1
    df_of = dict(
        vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect()
    )  # at most one row per term of the block
    # Numbers of the tree: the most frequent term is 0.
    order = sorted(number.values(), key=lambda t: (-df_of.get(t, 0), t))
    rank = np.empty(len(number), np.int64)
    rank[order] = np.arange(len(number))
    weight = {
        t: math.floor(1_000 * math.log((2 * docs + 2) / (2 * df_of.get(t, 0) + 1)))
        for t in number.values()
    }
    asked = [
        [(int(rank[number[t]]), weight[number[t]]) for t in terms if number[t] in df_of]
        for _, terms in block
    ]
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches):
        heaps: list[list] = [[] for _ in asked]
        held: list[tuple] = []
        entries = 0

        def search():
            tree = Tree(held, least_docs)
            for item, heap in zip(asked, heaps, strict=True):
                if item:
                    tree.search(item, heap, k)
            held.clear()

        for batch in batches:
            ids, m = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ends = np.cumsum([0, *(len(v) for v in batch.column(2))])
            ranks = rank[batch.column(2).flatten().to_numpy()]
            doc = np.repeat(np.arange(len(ids)), np.diff(ends))
            by = np.lexsort((ranks, doc))
            ranks = ranks[by].tolist()
            tfs = batch.column(3).flatten().to_numpy()[by].tolist()
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                if a < b:
                    held.append((tuple(ranks[a:b]), tuple(tfs[a:b]), m[i], ids[i]))
                    entries += b - a
                if entries >= tree_entries:
                    search()
                    entries = 0
        if held:
            search()
        found = [
            (i, None if minus == math.inf else -minus, score)
            for i, heap in enumerate(heaps) for score, minus in heap
        ]
        if found:
            columns = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

    m = F.expr(f"100 - 50 + ((50 * n * {docs}L) div {length}L)").alias("m")
    found = map_arrow(vectors.select("doc_id", m, "terms", "tfs"), run, FOUND)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ids = df.sparkSession.createDataFrame(
        [(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id long"
    )
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .join(F.broadcast(ids), "item")  # no more rows than the block has items
        .select("item_id", "rank", "doc_id", "score")
    )


def ranked_search(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = TOP,
    block_terms: int = BLOCK_TERMS,
    tree_entries: int = TREE_ENTRIES,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """The ``k`` best documents with a score above 0 for every item."""
    parts = [
        _search_block(df, block, id_col, text_col, k, tree_entries, least_docs)
        for block in item_blocks(items, item_col, item_text_col, block_terms)
    ]
    if not parts:
        return df.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op13_fp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP13_SQL = f"""
WITH docs AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
whole AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms
  FROM docs WHERE len(terms) > 0),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tfs AS (SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (SELECT term,
    floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, whole GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf)
    // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM items JOIN tfs USING (term) JOIN weights USING (term), whole GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
