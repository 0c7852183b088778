"""Each operator against brute force, a round trip or labels, on small awkward tables."""

import collections
import hashlib
import math
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from eventmill.llm import (
    blocks, extract, langid, mixing, neardup, packing, quality, rendezvous, syncmers, toxicity, warc,
)
from eventmill.llm.labeller import BlockLabeller

LONG = " ".join(f"word{i % 700} and{i % 31}." for i in range(9_000))
TEXTS = [
    None, "", " \t\n", "one", "one two", "The same text twice, over and over again.",
    "The same text twice, over and over again.", "a\n\nb\na\n b", "é ñ ü ß Straße naïve", LONG,
    LONG + " tail", "x" * 5_000, "1234 5678", "line one\nline one\nline two #$%&|<>*",
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept int, shard int"


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, repeated rows and ids, empty and very long texts, clashing extra columns."""
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, 0, 7, 7)
            for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, "no id at all", "en", "s1", 1, 7, 7), (3, "id again", "de", "s2", 1, 7, 7)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_shards_are_gapless_and_grow_by_moves_into_the_new_one(docs, nothing):
    weights = [1.0, 2.0, 1.0]
    placed = rendezvous.with_shard(docs.select("doc_id", "text"), "doc_id", weights)
    placed = rendezvous.with_shard(placed, "doc_id", [*weights, 1.0], "grown")
    rows = rendezvous.with_slots(placed, "doc_id", ["text"]).collect()
    assert len(rows) == docs.count()
    slots = collections.defaultdict(list)
    for r in rows:
        assert r.grown in (r.shard, 3)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in rows if r.doc_id == 3}) == 1
    empty = rendezvous.with_shard(nothing.select("doc_id", "text"), "doc_id", weights)
    assert rendezvous.with_slots(empty, "doc_id").count() == 0


def test_shard_weights_hold(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "k")
    n = dict(rendezvous.with_shard(ids, "k", [1.0, 3.0]).groupBy("shard").count().collect())
    assert 0.23 < n[0] / 20_000 < 0.27


def test_archives_round_trip(spark):
    pages = [(1, "u1", "<p>" + "x" * 200), (2, None, "<p>" + "x" * 200), (3, "u3", None),
             (4, "u4", "short"), (5, "u5", "short"), (None, "u6", "<p>" + "x" * 200),
             (7, "u7", LONG), (7, "u7", LONG), (8, "é", "ÿ" * 99)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    manifest = warc.write_archives(df, archive_bytes=4_000)
    rows = warc.read_archives(manifest, payloads=True).collect()
    assert len(rows) == len(pages)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.page_id].append(r)
    for page_id, url, html in pages:
        data = (html or "").encode()
        for r in by[page_id]:
            assert r.payload_bytes == len(data)
            assert r.payload_digest == hashlib.sha256(data).hexdigest()
            assert r.url == url
            assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data
    assert by[2][0].refers_to == 1 and by[None][0].refers_to == 1 and by[1][0].refers_to is None
    assert {r.record_type for r in by[7]} == {"response"}
    assert by[4][0].record_type == by[5][0].record_type == "response"
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0


def test_archive_begins_with_a_dictionary_and_frames_stand_alone():
    records = [warc.record_bytes("response", i, "u", b"<p>text %d</p>" % (i % 9) * 40, 560, "d", None)
               for i in range(300)]
    data = warc.in_memory_archive(records, sample_bytes=1 << 16, dictionary_bytes=4_096)
    magic, size = np.frombuffer(data[:8], "<u4").tolist()
    assert magic == 0x184D2A5D and data[8:12] == warc.TRAINED_MAGIC and size <= 4_096
    import io

    assert list(warc.read_archive(io.BytesIO(data))) == records


def base_figures(text):
    w = words(text)
    windows = list(zip(w, w[1:], w[2:]))
    count = collections.Counter(windows)
    covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered), failed)


def test_base_figures_and_verdicts(spark, docs, nothing):
    marks = spark.createDataFrame([(9, 1), (9, 0), (10, 1), (5, 0), (None, 1), (4, None)],
                                  "doc_id long, quality int")
    for labelled in (marks, marks.limit(0)):
        got = quality.quality_verdicts(docs, labelled).collect()
        want = sorted(repr((r.doc_id, *base_figures(r.text))) for r in docs.collect())
        figures = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                    r.base_failed) for r in got]
        assert sorted(map(repr, figures)) == want
        assert not any(r.kept for r in got if r.base_failed)
    assert quality.quality_verdicts(nothing, marks).count() == 0


def hashed(*parts):
    """Spark's xxhash64 of some columns: each seeds the next."""
    seed = 42
    for part in parts:
        raw = part.encode() if isinstance(part, str) else part.to_bytes(8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return seed


def gram_buckets(text, buckets):
    w = words(text)
    return [hashed(x) % buckets for x in w] + [hashed(*x) % buckets for x in zip(w, w[1:])]


def brute_verdicts(rows, good, buckets, smoothing, quantile, margin):
    """(doc_id, text) rows -> {doc_id: (ratio, kept)} straight from the definition."""
    fold = {i: hashed("fold", i) % 2 for i in good}
    corpus, target = collections.Counter(), collections.Counter()
    for i, text in rows:
        corpus.update(gram_buckets(text, buckets))
        if fold.get(i) == 0:
            target.update(gram_buckets(text, buckets))
    c = [1.0 + corpus[k] for k in range(buckets)]
    held, all_c, all_t = smoothing * sum(target.values()), sum(c), sum(target.values())
    log = [math.log((target[k] + held * c[k] / all_c) / (all_t + held) / (c[k] / all_c)) for k in range(buckets)]
    ratio = {}
    for i, text in rows:
        grams = gram_buckets(text, buckets)
        ratio[i] = sum(log[g] for g in grams) / len(grams) if grams else 0.0
    unseen = sorted(ratio[i] for i, text in rows if fold.get(i) == 1 and len(words(text)) >= 50)
    low = unseen[max(0, math.ceil(quantile * len(unseen)) - 1)] - margin
    return {i: (ratio[i], not base_figures(text)[-1] and ratio[i] >= low) for i, text in rows}


def test_ratio_threshold_and_verdict_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    fair, poor = [f"fair{i}" for i in range(400)], [f"poor{i}" for i in range(400)]
    rows = [
        (i, " ".join([*rng.choice(fair, n * share // 10), *rng.choice(poor, n - n * share // 10)]))
        for i, (n, share) in enumerate((int(rng.integers(0, 120)), int(rng.integers(0, 11))) for _ in range(300))
    ]
    good = [i for i, text in rows if text.count("fair") > 40 and text.count("poor") < 30][:60]
    settings = {"buckets": 256, "smoothing": 0.2, "quantile": 0.2, "margin": 0.01}
    want = brute_verdicts(rows, good, *settings.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, 1) for i in good], "doc_id long, quality int")
    # A shuffled input gives no row the same number twice.
    got = quality.quality_verdicts(docs.repartition(5), marks, **settings).collect()
    assert len(got) == len(rows)
    for r in got:
        assert math.isclose(r.log_ratio, want[r.doc_id][0], abs_tol=1e-7)
        assert r.kept == want[r.doc_id][1]
    kept = [r.kept for r in got if not r.base_failed]
    assert any(kept) and not all(kept)


def test_every_trusted_document_counts(spark):
    marks = spark.range(50_000).selectExpr("id AS doc_id", "1 AS quality")
    folds = dict(quality.trusted_ids(marks).groupBy("fold").count().collect())
    assert set(folds) == {0, 1} and sum(folds.values()) == 50_000


def test_ordinal_gradient_and_order():
    rng = np.random.default_rng(3)
    eta, t = rng.normal(size=20), np.array([-1.0, 0.2, 1.5])
    y, w = rng.integers(0, 4, 20), np.full(20, 0.05)
    _, by_eta, by_t = toxicity.ordinal_loss(eta, t, y, w)
    for i in range(3):
        step = np.eye(3)[i] * 1e-6
        slope = (toxicity.ordinal_loss(eta, t + step, y, w)[0]
                 - toxicity.ordinal_loss(eta, t - step, y, w)[0]) / 2e-6
        assert abs(slope - by_t[i]) < 1e-5
    step = np.eye(20)[4] * 1e-6
    slope = (toxicity.ordinal_loss(eta + step, t, y, w)[0]
             - toxicity.ordinal_loss(eta - step, t, y, w)[0]) / 2e-6
    assert abs(slope - by_eta[4]) < 1e-5


def test_toxic_words_are_learned_and_severity_follows_their_number(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(400):
        text = list(rng.choice(vocabulary, 40))
        toxic = i % 4 == 0
        if toxic:
            text[: 1 + i // 4 % 6] = ["nastyword"] * (1 + i // 4 % 6)
        rows.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    rows += [(400, None), (401, ""), (402, "Nastyword!"), (402, "Nastyword!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("severity", F.lit("x"))
    labels = spark.createDataFrame([*marks, (3, None), (None, 1), (0, 0)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.score_toxicity(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id < 400:
            assert r.toxic_pred == (r.doc_id % 4 == 0)
        else:
            assert r.toxic_pred == (r.doc_id == 402)
        assert 0 <= r.severity <= toxicity.GRADES
    by = {r.doc_id: r.severity for r in got}
    assert by[20] > by[0]
    none = toxicity.fit_toxicity(docs, labels.limit(0))
    assert not any(r.toxic_pred for r in toxicity.score_toxicity(docs, none).collect())


PAGE = """<html><head><title>T</title></head><body><header><h2>Site</h2><nav><a href=/>Home</a>
<a href=/b>News</a></nav></header><div class="cookie-notice"><p>We use cookies.</p></div><main>
<article><h1>Heading of it</h1><p>First paragraph of the text, with &amp; sign.</p><div class="advert">
Buy this now.</div><p>Second   paragraph<br>goes on <a href=x>here</a>.</p><script>var a="<p>";</script>
<p>Third.</p></article></main><aside><h4>Related</h4></aside><footer>&copy; 2020 Site</footer>"""


@pytest.fixture(scope="module")
def labeller(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").orderBy("page_id").collect()
    return extract.train([r.html for r in rows])


def test_extraction_of_whole_pages(spark, sf_dir, labeller):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    odd = spark.createDataFrame(
        [(9_001, None, PAGE), (9_002, "u", None), (9_003, "u", ""), (9_003, "u", "<p")],
        "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract.extract(pages.unionByName(odd), labeller=labeller).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [blocks.entities.unescape(re.sub("<[^>]+>", " ", p)) for p in re.split("</?(?:h1|p)>", inside)]
        assert got[r.page_id] == "\n".join(" ".join(p.split()) for p in parts if p.strip())
    assert got[9_001] == ("Heading of it\nFirst paragraph of the text, with & sign.\n"
                          "Second paragraph goes on here.\nThird.")
    assert got[9_002] == got[9_003] == ""


def test_made_pages_are_labelled_well(labeller, spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(20).collect()
    texts = [b.text for r in rows for b in blocks.leaf_blocks(r.html)]
    maker = extract.Maker(texts, ["Read more", "Accept all", "Subscribe to our letter"], seed=1_234)
    right = total = 0
    for _ in range(100):
        found, want = maker.page()
        got = labeller.predict([blocks.vectors(found)])[0] >= extract.CUT
        right += int((got == (np.array(want) == 1)).sum())
        total += len(want)
    assert right / total > 0.93


@pytest.mark.parametrize("page, want", [
    ('<p class="x>lost</p>', ["lost"]),
    ("<p><a title=it's>hi</a></p>", ["hi"]),
    ("<p title='it's'>q</p>", ["q"]),
    ('<p title="a>b" x=\'c>d\'>text</p>', ["text"]),
    ('<script a="x>y">var a="<p>"</script >after', ["after"]),
    ("<title-bar>shown</title-bar>", ["shown"]),
    ("a < b <!bogus", ["a < b"]),
    ('<p>one</p foo="x>y">two', ["one", "two"]),
    ("<p>x<br/>y</p>end<p", ["x y", "end"]),
])
def test_tags_end_as_in_browsers(page, want):
    assert [b.text for b in blocks.leaf_blocks(page)] == want


@pytest.mark.parametrize("part", ["<a ", "<!", "<script ", '<p class="x>', "<p t='\">", "</p>", "<p a=", " "])
def test_broken_pages_are_read_in_linear_time(part):
    began = time.monotonic()
    blocks.leaf_blocks("<div>" * 20_000 + "x<p" + part * 100_000 + " a " + part * 100_000)
    assert time.monotonic() - began < 10


def test_elements_far_out_are_seen():
    deep = "<section class=comments>" + "<div>" * 30 + "<p>text" + "</div>" * 30 + "</section><p>after"
    inside, after = blocks.leaf_blocks(deep)
    assert blocks.bucket(".comments") in blocks.path_buckets(inside.path)
    assert inside.path.marks == {".comments"} and not after.path.marks


def test_gradients_of_the_network_are_the_slopes_of_its_loss():
    rng = np.random.default_rng(4)
    net = BlockLabeller(5, dense=4, hidden=3, seed=1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = rng.normal(size=(2, 4, 5)), np.array([[1.0, 1, 1, 1], [1, 1, 0, 0]])
    y = rng.integers(0, 2, (2, 4)).astype(float)

    def loss():
        p, _ = net.forward(x, mask)
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    for name, slope in net.gradients(x, mask, y).items():
        flat = net.p[name].reshape(-1)
        for i in range(0, flat.size, max(1, flat.size // 5)):
            was, values = flat[i], []
            for move in (1e-3, -1e-3):
                flat[i] = was + move
                values.append(loss())
            flat[i] = was
            assert math.isclose((values[0] - values[1]) / 2e-3, slope.reshape(-1)[i], rel_tol=0.02, abs_tol=1e-4)


def test_training_reads_whole_pages(monkeypatch):
    seen = []
    monkeypatch.setattr(BlockLabeller, "fit", lambda self, s, t: seen.extend(zip(s, t, strict=True)) or self)
    page = "<body><nav>m</nav><article>" + "<p>text of it</p>" * 500 + "</article><footer>end</footer>"
    extract.train([page], made=0)
    assert sum(len(s) for s, _ in seen) == sum(len(t) for _, t in seen) == 502
    assert max(len(s) for s, _ in seen) <= extract.STRETCH
    assert sum(t.sum() for _, t in seen) == 500


def test_sampled_pages_are_bounded_in_all(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(extract, "train", lambda pages: taken.extend(pages))
    rows = [(i, "x" * (i + 1)) for i in range(30)] + [(None, None), (77, ""), (5, "x" * 6)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    extract.fit_labeller(pages, "page_id", "html", sample=1_000, chars=10_000)
    assert sorted(map(len, taken)) == list(range(1, 31))
    taken.clear()
    extract.fit_labeller(pages, "page_id", "html", sample=1_000, chars=40)
    assert 0 < sum(map(len, taken)) <= 40
    extract.fit_labeller(pages.limit(0), "page_id", "html")


def test_extraction_of_nothing_and_of_clashing_columns(spark, labeller):
    pages = spark.createDataFrame([(1, "u", PAGE, "mine", 5), (1, "u", PAGE, "mine", 5)],
                                  "page_id long, url string, html string, text string, n_chars int")
    got = extract.extract(pages, labeller=labeller)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert [len(r.text) for r in got.collect()] == [r.n_chars for r in got.collect()]
    assert all(r.text.startswith("Heading") for r in got.collect())
    assert extract.extract(pages.limit(0)).count() == 0


def brute_components(rows, width):
    sets = {i: set(neardup.shingles(t, width).tolist()) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def copies():
    rng = np.random.default_rng(8)
    vocabulary = np.array([f"w{i}" for i in range(400)])
    shared = " ".join(vocabulary[:30])
    rows = []
    for _ in range(4):
        text = rng.choice(vocabulary, 120)
        for n in range(25):
            edited = text.copy()
            edited[rng.integers(0, 120, n % 9)] = rng.choice(vocabulary, n % 9)
            rows.append(" ".join(edited))
    rows += [shared + " " + " ".join(rng.choice(vocabulary, k % 12)) for k in range(60)]
    rows += [rows[0]] * 30 + [None, "", "lone", "lone", "LONE", "two words"]
    return list(enumerate(rows))


@pytest.mark.parametrize("small", [64, 3])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(neardup, "SMALL", small)
    rows = copies()
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    want, size = brute_components(rows, 2)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == size
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def passage_copies():
    """85 of 100 shingles are everyone's; four others make two texts of a group alike."""
    passage = [f"p{i}" for i in range(86)]
    rows = []
    for group in range(100):
        for n in range(2):
            tail = [f"g{group}x{i}" for i in range(4)] + [f"o{group}n{n}x{i}" for i in range(11)]
            rows.append(" ".join(passage + tail))
    return list(enumerate(rows))


def test_texts_that_consist_of_a_shared_passage_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 3)
    monkeypatch.setattr(neardup, "BLOCK", 20_000, raising=False)
    rows = passage_copies()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame, width=2).collect()}
    want, size = brute_components(rows, 2)
    assert set(size.values()) == {100} and len(set(want.values())) == 100
    assert got == want


def test_near_duplicates_of_awkward_rows(docs, nothing):
    got = neardup.near_duplicates(docs, width=5).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[6].component_id == 5 and by[10].component_id == 9
    assert by[None].component_id is None and by[None].kept
    assert by[0].n_shingles == by[1].n_shingles == by[2].n_shingles == 0
    assert neardup.near_duplicates(nothing).count() == 0


def test_estimate_from_packed_bits(spark):
    a, b = neardup.hash_family()
    rows = []
    for share in (0.5, 0.8, 0.95):
        n = 4_000
        common = int(2 * n * share / (1 + share))
        base = np.random.default_rng(5).integers(0, 1 << 63, 2 * n, np.uint64)
        x, y = base[:n], base[n - common : 2 * n - common]
        pack = lambda h: neardup.packed_bits(neardup.minima(h, a, b)).tolist()
        rows.append((share, pack(x), pack(y)))
    df = spark.createDataFrame(rows, "share double, x array<long>, y array<long>")
    for r in df.withColumn("e", neardup.estimate(F.col("x"), F.col("y"))).collect():
        assert abs(r.e - r.share) < 0.15


def test_anchors_are_closed_and_free_of_context(spark):
    text = " ".join(f"t{i * i % 97}" for i in range(80))
    df = spark.createDataFrame([("a", text), ("b", "other words go first here " + text)], "k string, t string")
    rows = {r.k: r.a for r in syncmers.with_anchors(df, "t", "a").collect()}
    shifted = {(x["pos"] + 5, x["hash"]) for x in rows["a"]}
    assert shifted <= {(x["pos"], x["hash"]) for x in rows["b"]}
    assert 0.4 < len(rows["a"]) / 77 < 0.9


def test_likeness_uses_all_anchors_and_positions(spark):
    long = [f"t{i * i % 9_973}x{i % 89}" for i in range(20_000)]
    edited = [*long[:9_000], "edited", *long[9_001:]]
    passage = [f"o{i}" for i in range(30_000, 39_000)] + long[500:560]
    run = "".join(chr(0x4E00 + i * i % 7_919) for i in range(600))
    rows = [("edit", " ".join(long), " ".join(edited)), ("passage", " ".join(long), " ".join(passage)),
            ("run", run, run[:5] + "x" + run[5:]), ("same", "a b", "a b"), ("none", "", None)]
    df = spark.createDataFrame(rows, "k string, t string, o string")
    got = {r.k: r for r in syncmers.compared(df, "t", ["o"]).collect()}
    sets = {k: [{x.hash for x in r[f"_{c}"]} for c in "to"] for k, r in got.items()}
    for k, (a, b) in sets.items():
        assert got[k].near_o == (len(a & b) / len(a | b) if a | b else 1.0)
    assert 0.999 < got["edit"].near_o < 1.0 and got["edit"]["_t"] != got["edit"]["_o"]
    assert got["passage"].near_o > 0 and 20 < got["passage"].aligned_o < 60
    assert got["run"].near_o > 0.95 and got["same"].near_o == got["none"].near_o == 1.0


def test_next_document_and_edit(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "ROWS_PER_RANGE", 3)
    rows = [(i * 7 % 23, f"text number {i} " * (i % 5)) for i in range(20)] + [(None, "last"), (2, "2 again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = syncmers.with_next(df, "doc_id", ["text"], "text").collect()
    ring = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted(repr((*r, ring[(i + 1) % len(ring)][1])) for i, r in enumerate(ring))
    assert sorted(repr((r.doc_id, r.text, r.next_text)) for r in got) == want
    one = syncmers.with_next(df.limit(1), "doc_id", ["text"], "text").collect()
    assert one[0].next_text == one[0].text


def test_word_ids_equal_the_tokenizer(spark, sf_dir):
    import public_tokenizers

    encoder = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += ["İstanbul ΣΑΣ. don't  stop\t\x85x​foo\x1cbar", "été <|endoftext|> y",
              "a.b,c! ÑÓ,!! $$$ 12ab", "日本語 текст ½ ²", None, *(t for t in TEXTS)]
    want = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    got = encoder.encode(pa.array(texts, pa.string()))
    assert [g.tolist() for g in got] == [w.ids for w in want]


def test_cuts_cost_as_little_as_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(30):
        positions = np.cumsum(np.concatenate(([0], rng.integers(1, 9, 25)))).tolist()
        penalties = [0.0, *rng.integers(0, 6, 25).astype(float)]
        limit = 16
        short = [8, 4, 2, 1]
        price = lambda n: 0 if n in short else limit - n
        best = [0.0] + [np.inf] * 25
        for j in range(1, 26):
            best[j] = penalties[j] + min(
                best[i] + price(positions[j] - positions[i]) for i in range(j)
                if positions[j] - positions[i] <= limit)
        cuts = packing.best_cuts(positions, penalties, limit)
        cost = sum(price(positions[b] - positions[a]) + penalties[b] for a, b in zip(cuts, cuts[1:]))
        assert cost == best[-1] and cuts[0] == 0 and cuts[-1] == 25


def test_pieces_cover_every_id_once(docs, nothing):
    import public_tokenizers

    encoder = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.pack(docs.repartition(2), stretch=6_000).collect()
    fill = collections.Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == fill[p.sequence_id]
        fill[p.sequence_id] += p.length
    assert max(fill.values()) <= packing.LIMIT
    found = collections.defaultdict(collections.Counter)
    for p in pieces:
        found[p.doc_id][(p.start, p.length, p.ids_crc32, p.doc_tokens)] += 1
    for r in docs.dropDuplicates(["doc_id"]).filter("doc_id <> 3 AND doc_id <> 5").collect():
        ids = np.append(encoder.encode(pa.array([r.text], pa.string()))[0], np.uint32(1)).astype("<u4")
        at = 0
        for start, length, crc, size in sorted(found[r.doc_id]):
            assert (start, size) == (at, len(ids))
            assert crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    assert packing.pack(nothing).count() == 0


def test_mixing_holds_weights_and_loses_nothing(spark, docs, nothing):
    rows = [(i, "a" if i < 3_000 else "b" if i < 3_600 else "c", "w " * (5 + i % 7)) for i in range(4_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(df, entropy=0.9, repetitions=3.0).toPandas()
    assert set(got.doc_id) == set(range(4_000))
    assert got.groupby("doc_id").size().max() <= 3
    share = got.groupby("source").mix_tokens.sum() / got.mix_tokens.sum()
    for source, weight in got.groupby("source").weight.first().items():
        assert abs(share[source] - weight) < 0.01
        half = got[got.mix_order < 0.5]
        assert abs(half[half.source == source].mix_tokens.sum() / half.mix_tokens.sum() - weight) < 0.05
    own = np.array([3_000, 600, 400]) / 4_000
    assert -(share * np.log(share)).sum() > -(own * np.log(own)).sum()
    awkward = mixing.mix(docs).collect()
    assert len({(r.doc_id, r.text) for r in awkward}) == len({(r.doc_id, r.text) for r in docs.collect()})
    assert mixing.mix(nothing).count() == 0


def test_temperature_is_the_bisected_one(spark):
    sources = spark.createDataFrame([(f"s{i}", t) for i, t in enumerate((1_000, 300, 40, 5))], "_key string, tokens long")
    found = mixing.find_temperature(sources, 0.9, 1e9)
    p = np.array([1_000, 300, 40, 5]) / 1_345
    w = p**found.exponent / (p**found.exponent).sum()
    assert abs(-(w * np.log(w)).sum() / np.log(4) - 0.9) < 1e-5
    limited = mixing.find_temperature(sources, 0.9, 2.0)
    assert abs((p.max() / p.min()) ** (1 - limited.exponent) - 2.0) < 1e-4


def test_languages_on_held_out_rows(spark, sf_dir, nothing):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = [(9_000, None, None), (9_001, "", "en"), (9_002, "12 34 !!", "en"), (9_003, LONG, None)]
    odd = spark.createDataFrame(odd, "doc_id long, text string, lang string")
    rows = docs.select("doc_id", "text", "lang").unionByName(odd).withColumn("score", F.lit("clash"))
    model = langid.fit_languages(rows.filter(~langid.held_out()))
    got = langid.predict_languages(rows.withColumn("held", langid.held_out()), model).collect()
    held = [r for r in got if r.held and r.doc_id < 9_000]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert {r.lang_pred for r in got if r.doc_id in (9_000, 9_001, 9_002)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got)
    blank = langid.fit_languages(nothing)
    assert {r.lang_pred for r in langid.predict_languages(rows.limit(3), blank).collect()} == {"und"}


def test_collapsed_product_equals_the_kernel_expansion():
    rng = np.random.default_rng(4)
    rows = rng.random((60, 128)) < 0.3
    names = ["x" if r[:40].sum() > 12 else "y" for r in rows]
    model = langid.fit_kernel_ridge(rows, names, 16, 1e-2, 3)
    scores = model.scores(rows)
    assert np.mean([model.languages[i] == n for i, n in zip(scores.argmax(1), names)]) > 0.8
    assert np.allclose(model.scores(rows[:5]), scores[:5], atol=1e-5)


def test_syncmers_follow_the_selection_rule(spark):
    """Anchors by hand: the smallest inner s-mer, by hash, is the first or the last."""
    import xxhash

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def chain(values):
        h = 42
        for v in values:
            h = xxhash.xxh64_intdigest((v & (1 << 64) - 1).to_bytes(8, "little"), seed=h)
        return signed(h)

    def units(text):
        out = []
        for word in words(text):
            out += [word] if len(word) <= 12 else list(word)
        return [signed(xxhash.xxh64_intdigest(u.encode(), seed=42)) for u in out]

    texts = [*TEXTS, " ".join(f"t{i * i % 97}" for i in range(500)), "same " * 40, "日本語の文 and words " * 9]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r for r in syncmers.with_anchors(df, "t", "a")
           .withColumn("written", syncmers.written(F.col("a"))).collect()}
    for i, text in enumerate(texts):
        u = units(text)
        if len(u) < syncmers.K:
            want = [(0, chain(u))] if u else []
        else:
            s = [chain(u[j : j + syncmers.S]) for j in range(len(u) - syncmers.S + 1)]
            want = [(j, chain(s[j : j + 3])) for j in range(len(u) - syncmers.K + 1)
                    if min(s[j], s[j + 2]) <= s[j + 1]]
        assert [(a["pos"], a["hash"]) for a in got[i].a] == want
        assert got[i].written == "[" + ", ".join(f"{{{p}, {h}}}" for p, h in want) + "]"


def test_syncmer_query_on_awkward_rows(spark, docs, nothing, monkeypatch):
    def query(df):
        monkeypatch.setattr(syncmers, "documents", lambda *_: df)
        return syncmers.op6_closed_syncmers(spark, "")

    clashing = docs.withColumn("text_", F.lit(1)).withColumn("fingerprint", F.lit(2)).withColumn(
        "next", F.lit(3)).withColumn("edited", F.lit(4))
    found = query(clashing)
    assert dict(found.dtypes)["fingerprint"] == dict(found.dtypes)["edited_fingerprint"] == "string"
    rows = found.collect()
    assert len(rows) == docs.count() == len(TEXTS) + 3
    ring = sorted(((r.doc_id, r.text or "") for r in docs.collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = collections.Counter()
    for i, (doc_id, text) in enumerate(ring):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + ring[(i + 1) % len(ring)][1][:cut]
        want[(doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == want
    by = collections.defaultdict(set)
    for r in rows:
        assert 0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0
        by[r.doc_id].add(r.fingerprint)
    assert by[5] == by[6] and by[0] == by[1] == by[2] == {"[]"}
    assert query(nothing).count() == 0


def test_null_ids_revisit_and_addresses_round_trip(spark):
    page = "<p>" + "x" * 200
    urls = ["a\x0bb\nc", "a%0Ab", "", None, "é ü\r\nWARC-Type: revisit", "http://x/?q=1&b=%20 "]
    rows = [(-1, "first", page), (None, "second", page)] + [(i, u, "short") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "payload", F.lit(1)).withColumn("digest", F.lit(2)).withColumn("first_id", F.lit(3))
    got = {r.page_id: r for r in warc.read_archives(warc.write_archives(df)).collect()}
    assert (got[-1].record_type, got[-1].refers_to) == ("response", None)
    assert (got[None].record_type, got[None].refers_to) == ("revisit", -1)
    assert [got[i].url for i in range(len(urls))] == urls
    assert warc.read_archives(warc.write_archives(df.limit(0))).count() == 0
