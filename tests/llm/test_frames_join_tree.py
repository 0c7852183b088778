"""Fill-in-the-middle, nearest neighbours and ranked search against brute force."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventmill.llm import blockjoin, fptree, frames

LONG = " ".join(f"word{i % 700}  and{i % 31}." for i in range(9_000))
TEXTS = [
    None, "", " \t\n", "one", "one two ", "  The same text.", "  The same text.", "a\n\nb\na\n b",
    "é ñ ü ß Straße naïve 日本 語", LONG, LONG + " tail", "x" * 5_000, "has <P> mark", "<S", "P> <M",
]
SCHEMA = "doc_id long, text string, form string, n long, rank int, score double"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, 2, 3.0) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "no id at all", "x", 1, 2, 3.0), (3, "id again", "x", 1, 2, 3.0)]
    return spark.createDataFrame(rows, SCHEMA)


# -- fill in the middle ------------------------------------------------------------

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_way(doc_id, text, fim=50):
    text = text or ""
    units = UNITS.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize(("frame_bytes", "fim"), [(frames.FRAME_BYTES, 50), (7, 100)])
def test_outputs_and_digests_equal_the_plain_way(docs, frame_bytes, fim):
    out = frames.fill_in_middle(docs, frame_bytes=frame_bytes, fim_percent=fim)
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    want = collections.Counter()
    for r in docs.collect():
        *head, text = plain_way(r.doc_id, r.text, fim)
        want[(r.doc_id, *head, sha(text), sha(r.text or ""))] += 1
    assert collections.Counter(map(tuple, frames.output_digests(out).collect())) == want
    for r in out.collect():
        unpacked = zstandard.ZstdDecompressor().stream_reader(r.output, read_across_frames=True).read()
        assert sha(unpacked.decode()) in {w[5] for w in want if w[0] == r.doc_id}


def test_no_documents_no_outputs(docs):
    out = frames.fill_in_middle(docs.limit(0))
    assert frames.output_digests(out).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \t\né<P>SM", max_size=60), st.integers(1, 9), st.integers(0, 10**6))
def test_cuts_and_restored_text(text, frame_bytes, doc_id):
    data, codec = text.encode(), frames.Codec()
    seekable = frames.Frames.of_text(codec, data, frame_bytes)
    units = UNITS.findall(text)
    assert seekable.units[-1] == len(units)
    for k in range(len(units) + 1):
        front = "".join(units[:k])
        assert seekable.cut(k) == (len(front.encode()), len(front))
    *_, form, _, _, out = frames.transform(codec, doc_id, data, 42, 100, 50, frame_bytes)
    again = frames.Frames.unpack(codec, out.pack())
    assert b"".join(frames.restore(again, form)) == data


def test_only_cut_frames_are_read():
    codec = frames.Codec()
    seekable = frames.Frames.of_text(codec, LONG.encode(), 1_000)
    read = []
    seekable.codec.decompress = lambda f, inner=codec.decompress: read.append(f) or inner(f)
    seekable.cut(7_000)
    assert len(read) == 1


# -- nearest neighbours ------------------------------------------------------------


def near_brute(rows, k, step):
    ok = [(i, v_id, v) for i, (v_id, v) in enumerate(rows)
          if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for i, q_id, q in ok:
        if q_id is None or q_id % step:
            continue
        found = sorted(
            ((-sum(np.float64(a) * np.float64(b) for a, b in zip(q, v, strict=True)),
              (c_id is not None, c_id or 0))
             for j, c_id, v in ok if j != i and len(v) == len(q))
        )[:k]
        out += [(q_id, n + 1, c[1] if c[0] else None, -s) for n, (s, c) in enumerate(found)]
    return collections.Counter(out)


def vector_rows(dim=6, n=150, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim)).astype(np.float32)
    base[40:90] = base[40]  # a hot vector
    rows = [(i, x.tolist()) for i, x in enumerate(base)]
    rows += [(0, rows[3][1]), (10, rows[10][1]), (10, rows[10][1]), (None, rows[40][1])]
    rows += [(200, None), (210, [0.0] * dim), (220, [1.0, None] * (dim // 2)), (230, []),
             (240, [float("nan")] * dim), (250, [float("inf")] + [1.0] * (dim - 1)),
             (260, [1.0, 2.0]), (261, [2.0, 1.0]), (262, [1e-40, 0.0])]
    return rows


@pytest.mark.parametrize("limits", [{}, {"block_rows": 7, "candidates_per_cell": 20, "queries_per_cell": 3}])
def test_nearest_equals_brute_force(spark, monkeypatch, limits):
    if limits:
        monkeypatch.setattr(blockjoin, "TILE_QUERIES", 2)
        monkeypatch.setattr(blockjoin, "TILE_CANDIDATES", 30)
    rows = vector_rows()
    df = spark.createDataFrame(
        [(i, v, 9, 8.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double"
    )
    got = blockjoin.nearest(df, k=5, query_step=10, **limits)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    want = near_brute([(r.vec_id, r.embedding) for r in df.collect()], 5, 10)
    assert collections.Counter(map(tuple, got.collect())) == want


def test_nearest_of_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    assert blockjoin.nearest(spark.createDataFrame([], schema)).count() == 0
    assert blockjoin.nearest(spark.createDataFrame([(1, [1.0]), (2, [1.0])], schema)).count() == 0
    assert blockjoin.nearest(spark.createDataFrame([(20, [1.0])], schema)).count() == 0


@pytest.mark.parametrize("dim", [3, 64, 2_500])
def test_bounds_hold_and_prune(dim):
    rng = np.random.default_rng(dim)
    x = rng.normal(size=(400, dim)) * rng.choice([1e-3, 1, 50], size=(400, 1))
    q, c = blockjoin.Coded(x[:20]), blockjoin.Coded(x)
    near = blockjoin.code_products(q.code, c.code)
    assert (near == q.code.astype(np.int64) @ c.code.astype(np.int64).T).all()
    slack = q.coded[:, None] * c.lost + q.lost[:, None] * c.norm
    assert (abs(near * q.scale[:, None] * c.scale - x[:20] @ x.T) <= slack * (1 + 1e-9) + 1e-12).all()
    i, j = blockjoin.survivors(q, c, 5, np.full(20, -np.inf))
    best = np.argsort(-(x[:20] @ x.T), axis=1)[:, :6]
    assert {(a, b) for a in range(20) for b in best[a].tolist()} <= set(zip(i.tolist(), j.tolist(), strict=True))
    assert len(i) < 20 * 400 / 2


# -- ranked search -----------------------------------------------------------------

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERMS.findall((text or "").translate(LOWER))


def search_brute(docs, items, k):
    all_terms = [(d, terms(t)) for d, t in docs]
    all_terms = [(d, t) for d, t in all_terms if t]
    n_docs, length = len(all_terms), sum(len(t) for _, t in all_terms)
    df = collections.Counter(x for _, t in all_terms for x in set(t))
    out = []
    for item_id, text in items:
        found = []
        for d, t in all_terms:
            tf, m = collections.Counter(t), 100 - 50 + 50 * len(t) * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1)))
                * (1_000_000_000 * tf[x] // (1000 * tf[x] + 20 * m))
                for x in set(terms(text)) if tf[x]
            )
            if score > 0:
                found.append((-score, (d is not None, d or 0)))
        out += [(item_id, i + 1, d[1] if d[0] else None, -s) for i, (s, d) in enumerate(sorted(found)[:k])]
    return collections.Counter(out)


def lexical_tables(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "ÉTÉ", "x_y", "don't", "日本"]
    weight = 1 / np.arange(1, len(vocabulary) + 1)

    def text(n):
        return " ".join(rng.choice(vocabulary, size=n, p=weight / weight.sum()))

    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(300)]
    docs += [(1_000 + i, docs[7][1]) for i in range(60)]  # copies: ties by id
    docs += [(2_000, None), (2_001, ""), (2_002, "...!"), (None, docs[7][1]), (5, docs[5][1]),
             (2_003, LONG + " w1 w2 w50")]
    items = [(i, text(12)) for i in range(12)]
    items += [(20, None), (21, " . "), (22, "absent words only"), (3, text(5)), (None, text(5)), (23, "W1 w1 w1")]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"block_terms": 15, "tree_entries": 300, "least_docs": 2}])
def test_search_equals_brute_force(spark, limits):
    docs, items = lexical_tables(spark)
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, rank int, n int")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = fptree.ranked_search(df.repartition(3), asked.coalesce(1), k=20, **limits)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collections.Counter(map(tuple, got.collect())) == search_brute(docs, items, 20)


def test_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "two")], "item_id long, text string")
    assert fptree.ranked_search(docs, items).count() == 1
    assert fptree.ranked_search(docs.limit(0), items).count() == 0
    assert fptree.ranked_search(docs, items.limit(0)).count() == 0
    assert fptree.ranked_search(docs, items.withColumn("text", F.lit("three"))).count() == 0


def test_bounds_cover_every_document_below_and_prune():
    rng = np.random.default_rng(9)
    vectors = []
    for d in range(800):
        topic = rng.integers(8)
        held = {int(t) for t in rng.integers(0, 6, 4)} | {int(t) for t in 6 + topic * 10 + rng.integers(0, 10, 5)}
        ordered = tuple(sorted(held))
        vectors.append((ordered, tuple(int(x) for x in rng.integers(1, 4, len(ordered))), int(rng.integers(60, 200)), d))
    tree = fptree.Tree(vectors, 8)
    assert len(tree.parent) > 20
    item = [(t, 10 + t) for t in (0, 1, 2, 36, 37, 38, 39)]

    def score(leaf):
        return sum(w * inner[leaf][0][t] for t, w in item if t in inner[leaf][0])

    inner = tree.leaves
    bound = tree.bounds(item)
    for leaf in range(len(inner)):
        node = tree.holder[leaf]
        while node >= 0:
            assert bound[node] >= score(leaf)
            node = tree.parent[node]
    seen = []

    class Counted(list):
        def __getitem__(self, i):
            seen.append(i)
            return inner[i]

    tree.leaves = Counted(inner)
    heap = []
    tree.search(item, heap, 5)
    best = sorted((-score(i), min(inner[i][1])) for i in range(len(inner)))[:5]
    assert sorted((-s, -d) for s, d in heap) == best
    assert len(seen) < 0.8 * len(inner)
