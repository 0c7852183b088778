"""MinHash near-dedup: b-bit signatures, band candidates, exact confirmation, components.

1. A document is its set of word shingles, hashed to 64 bits. 160 minima are taken;
   32 bands of 5 give bucket keys, the low 4 bits of all minima are packed into ten
   numbers. Equal sets form a class, represented by its smallest id.
2. Buckets with two or more classes are searched by stars: everyone against one centre
   (the class with most copies). That is linear in the bucket and joins a group of
   near copies round its original.
3. A candidate pair is kept if the similarity estimated from the packed bits, corrected
   for chance collisions (1/16), is within five standard errors of the threshold. Each
   class is then confirmed against its best partner on full sets, afterwards whatever
   still joins two components.
4. Buckets that still hold more than one component are finished. Small ones give rows
   of their remaining pairs. Large ones are dealt into blocks, and every two blocks are
   compared in one task on full sets: pairs of unlike components and near sizes, with a
   sufficient estimate and no earlier band in common, linked where they are alike.
   Only links leave the task. That is quadratic in the classes of a mixed bucket, in
   array operations and spread over tasks. Nothing is capped or left out.

So every pair that shares a bucket is compared, unless it is joined already. A pair at
the threshold shares none of 32 buckets with a chance of 3e-6; the estimate misses
fewer. Copies are never expanded into pairs.

Nulls: without words or text a document is linked with nothing. A null id is linked
with nothing, has a null component and is kept. Rows that repeat an id are one
document. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmill.llm.common import documents, map_arrow, stored
from eventmill.llm.components import components
from eventmill.session import broadcast_if_small

BANDS, ROWS, BITS = 32, 5, 4
MINIMA = BANDS * ROWS
PER_LONG = 64 // BITS
LONGS = MINIMA // PER_LONG
PERCENT = 80
ERRORS = 5.0
SMALL = 64  # a bucket up to this size is finished by its remaining pairs
BLOCK = 1 << 18  # shingles of a block of a large bucket, with CLASS_COST for each class
CLASS_COST = 256
CHUNK = 2_048
SEED = 20_240_601


# -- sets and signatures ---------------------------------------------------------


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; A-Z are lower-cased, blanks are ASCII."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(h))
    rolled = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        rolled ^= h[i : len(h) - width + 1 + i]
        rolled *= np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(32)
    return np.unique(rolled)


def hash_family() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    a = random.integers(0, 1 << 63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], random.integers(0, 1 << 63, MINIMA, np.uint64)[:, None]


def minima(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), CHUNK):
        values = hashes[None, i : i + CHUNK] * a
        values += b
        np.minimum(low, values.min(1), out=low)
    return low >> np.uint64(32)


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for i in range(ROWS):
        key = (key ^ rows[:, i]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def packed_bits(low: np.ndarray) -> np.ndarray:
    nibbles = (low & np.uint64((1 << BITS) - 1)).reshape(LONGS, PER_LONG)
    shifts = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(nibbles << shifts, axis=1).view(np.int64)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from packed low bits: equal groups of bits, corrected for chance."""
    differ = F.lit(0)
    for i in range(LONGS):
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 1.0 / (1 << BITS)
    return ((MINIMA - differ) / F.lit(float(MINIMA)) - chance) / (1.0 - chance)


def least_estimate(percent: int) -> float:
    j, chance = percent / 100.0, 1.0 / (1 << BITS)
    p = chance + (1 - chance) * j
    return j - ERRORS * (p * (1 - p) / MINIMA) ** 0.5 / (1 - chance)


def signatures(df: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    schema = "doc_id long, n int, class binary, bits array<long>, bands array<long>"
    arrow = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int32()), ("class", pa.binary()),
        ("bits", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64())),
    ])

    def run(batches):
        import hashlib

        a, b = hash_family()
        for batch in batches:
            for start in range(0, batch.num_rows, 1_000):
                part = batch.slice(start, 1_000)
                n, name, bits, bands = [], [], [], []
                for text in part.column(1).to_pylist():
                    found = shingles(text, width)
                    n.append(len(found))
                    if len(found):
                        low = minima(found, a, b)
                        name.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                        bits.append(packed_bits(low))
                        bands.append(band_keys(low))
                    else:
                        name.append(None)
                        bits.append(None)
                        bands.append(None)
                columns = [part.column(0), pa.array(n, pa.int32()), name, bits, bands]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type)
                     for c, f in zip(columns, arrow, strict=True)], schema=arrow,
                )

    return map_arrow(df.select(F.col(id_col).cast("long").alias("doc_id"), text_col), run, schema)


# -- confirmation ----------------------------------------------------------------


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("_ta"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("_tb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "_ta", "_tb")

    def run(batches):
        last, kept = object(), np.empty(0, np.uint64)
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x = x.as_py()
                if x != last:
                    last, kept = x, shingles(x, width)
                other = shingles(y.as_py(), width)
                common = len(np.intersect1d(kept, other, assume_unique=True))
                linked.append(100 * common >= percent * (len(kept) + len(other) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], names=["a", "b"]
            ).filter(pa.array(linked, pa.bool_()))

    return map_arrow(both, run, "a long, b long")


def block_links(block, width: int, percent: int):
    """Links (a, b) that join components within a block, or between its sides 0 and 1.

    ``block``: cid, label, n, band, bits, bands, text, side; one side only if it is
    compared with itself. Every pair of two labels is linked, refuted or joined by others.
    """
    sets = [shingles(t, width) for t in block["text"]]
    sizes = np.array([len(x) for x in sets], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    known, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    cids, sides = block["cid"].to_numpy(), block["side"].to_numpy()
    labels = block["label"].to_numpy().copy()
    bits = np.array(block["bits"].tolist(), np.int64).view(np.uint64)
    earlier = np.array(block["bands"].tolist(), np.int64)[:, : int(block["band"].iloc[0])]
    two_sided = len(np.unique(sides)) > 1
    low_bits, chance = np.uint64(0x1111111111111111), 1.0 / (1 << BITS)
    marked = np.zeros(len(known), bool)
    rows = np.flatnonzero(sides == 0) if two_sided else np.arange(len(cids))
    others = np.flatnonzero(sides == 1) if two_sided else rows
    a, b = [], []
    for k, x in enumerate(rows):
        left = others if two_sided else others[k + 1 :]
        n = sizes[x]
        if not n:  # a blank text of a repeated id
            continue
        left = left[
            (labels[left] != labels[x])
            & (100 * np.minimum(sizes[left], n) >= percent * np.maximum(sizes[left], n))
        ]
        differ = bits[left] ^ bits[x]
        differ |= differ >> np.uint64(1)
        differ |= differ >> np.uint64(2)
        unlike = np.bitwise_count(differ & low_bits).sum(1, dtype=np.int64)
        guess = ((MINIMA - unlike) / MINIMA - chance) / (1.0 - chance)
        left = left[guess >= least_estimate(percent)]
        left = left[~(earlier[left] == earlier[x]).any(1)]
        if not len(left):
            continue
        own = tokens[starts[x] : starts[x] + n]
        marked[own] = True
        length = sizes[left]
        ends = np.cumsum(length)
        at = np.arange(ends[-1]) + np.repeat(starts[left] - (ends - length), length)
        common = np.add.reduceat(marked[tokens[at]].astype(np.int64), ends - length)
        marked[own] = False
        for y in left[100 * common >= percent * (n + length - common)]:
            if labels[y] != labels[x]:
                labels[labels == labels[y]] = labels[x]
                a.append(min(cids[x], cids[y]))
                b.append(max(cids[x], cids[y]))
    return a, b


def ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


class Search:
    """The steps of one near-duplicate search; tables live in the shared folder."""

    def __init__(self, classes: DataFrame, df: DataFrame, width: int, percent: int):
        self.classes, self.df, self.width, self.percent = classes, df, width, percent
        self.labels: DataFrame | None = None  # (cid, label) where they differ
        self.tested: DataFrame | None = None  # pairs confirmed or refuted

    def labelled(self, rows: DataFrame, cid: str, name: str) -> DataFrame:
        if self.labels is None:
            return rows.withColumn(name, F.col(cid))
        named = self.labels.select(F.col("cid").alias(cid), F.col("label").alias("_label"))
        return rows.join(named, cid, "left").withColumn(
            name, F.coalesce("_label", cid)
        ).drop("_label")

    def between_components(self, pairs: DataFrame) -> DataFrame:
        rows = self.labelled(self.labelled(pairs, "a", "_la"), "b", "_lb")
        return rows.filter("_la <> _lb").drop("_la", "_lb")

    def join_components(self, links: DataFrame) -> None:
        edges = self.labelled(self.labelled(links, "a", "u"), "b", "v").select("u", "v")
        joined = components(edges)
        if self.labels is None:
            self.labels = joined.select(F.col("u").alias("cid"), F.col("v").alias("label"))
            return
        moved = joined.select(F.col("u").alias("label"), F.col("v").alias("_to"))
        old = self.labels.join(moved, "label", "left").select(
            "cid", F.coalesce("_to", "label").alias("label")
        )
        fresh = joined.join(self.labels.select(F.col("cid").alias("u")), "u", "left_anti")
        self.labels = stored(
            old.unionByName(fresh.select(F.col("u").alias("cid"), F.col("v").alias("label"))),
            "labels",
        )

    def alike(self, pairs: DataFrame) -> DataFrame:
        """Untested pairs of near sizes with a sufficient estimate, as (a, b, estimate)."""
        pairs = pairs.distinct()
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        sides = [
            self.classes.select(
                F.col("cid").alias(s), F.col("n").alias(f"_n{s}"), F.col("bits").alias(f"_bits{s}")
            )
            for s in "ab"
        ]
        low, high = F.least("_na", "_nb"), F.greatest("_na", "_nb")
        rows = pairs.join(sides[0], "a").join(sides[1], "b").filter(100 * low >= self.percent * high)
        rows = rows.withColumn("estimate", estimate(F.col("_bitsa"), F.col("_bitsb")))
        return rows.filter(F.col("estimate") >= least_estimate(self.percent)).select(
            "a", "b", "estimate"
        )

    def confirm(self, pairs: DataFrame) -> None:
        """Confirm what joins components: first the best pair of each class, then the rest."""
        todo = stored(self.between_components(self.alike(pairs)), "alike")
        if todo.isEmpty():
            return
        ids = todo.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        texts = stored(
            self.df.join(broadcast_if_small(stored(ids, "ids")), "doc_id", "left_semi"), "texts"
        )
        partner = F.struct("estimate", -F.col("b"), -F.col("a"))
        both = todo.select("a", "b", "estimate", F.explode(F.array("a", "b")).alias("x"))
        best = both.groupBy("x").agg(F.max(partner).alias("m")).select(
            (-F.col("m.col3")).alias("a"), (-F.col("m.col2")).alias("b")
        ).distinct()
        for chosen in (best, None):
            if chosen is None:
                chosen = self.between_components(todo.join(self.tested, ["a", "b"], "left_anti"))
            chosen = stored(chosen.select("a", "b"), "chosen")
            if chosen.isEmpty():
                return
            self.tested = chosen if self.tested is None else self.tested.unionByName(chosen)
            links = stored(confirmed(chosen, texts, self.width, self.percent), "links")
            if not links.isEmpty():
                self.join_components(links)

    def compare_blocks(self, large: DataFrame) -> None:
        """Finish large buckets: all pairs of two components, block by block."""
        rest = stored(self.mixed(large), "open")
        if rest.isEmpty():
            return
        ids = rest.select(F.col("cid").alias("doc_id")).distinct()
        texts = self.df.join(broadcast_if_small(stored(ids, "ids")), "doc_id", "left_semi")
        texts = texts.filter("text IS NOT NULL").distinct()
        sets = stored(
            self.classes.select("cid", "n", "bits", "bands").join(
                texts.withColumnRenamed("doc_id", "cid"), "cid"
            ),
            "sets",
        )
        rows = rest.select("key", "band", "cid", "label").join(sets, "cid")
        cost = F.sum(F.col("n") + CLASS_COST)
        blocks = stored(
            rows.groupBy("key").agg(F.ceil(cost / F.lit(BLOCK)).cast("int").alias("blocks")),
            "blocks",
        )
        own, other = F.col("_own"), F.col("_other")
        dealt = (
            rows.join(broadcast_if_small(blocks), "key")
            .withColumn("_own", F.pmod(F.xxhash64("cid", "key"), F.col("blocks")).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select(
                "key", "band", "cid", "label", "n", "bits", "bands", "text",
                F.least(own, other).alias("i"), F.greatest(own, other).alias("j"),
                (own > other).cast("int").alias("side"),
            )
        )
        width, percent = self.width, self.percent

        def compare(block):
            import pandas as pd

            # Two blocks of which one is empty have nothing to compare here.
            if block["i"].iloc[0] != block["j"].iloc[0] and block["side"].nunique() < 2:
                return pd.DataFrame({"a": [], "b": []}, dtype="int64")
            a, b = block_links(block, width, percent)
            return pd.DataFrame({"a": a, "b": b}, dtype="int64")

        links = stored(dealt.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long"), "links")
        if not links.isEmpty():
            self.join_components(links)

    def run(self) -> DataFrame | None:
        """(cid, label) of the classes that are not the smallest of their component."""
        keys = self.classes.select("cid", "copies", F.posexplode("bands").alias("band", "key"))
        members = self.shared(keys)
        if members.isEmpty():
            return self.labels
        centres = stored(
            members.groupBy("key").agg(
                F.min(F.struct(-F.col("copies"), F.xxhash64("cid", "key"), "cid")).alias("m")
            ).select("key", F.col("m.cid").alias("centre")),
            "centres",
        )
        starred = members.join(centres, "key")
        self.confirm(
            starred.filter("cid <> centre").select(*ordered(F.col("cid"), F.col("centre")))
        )
        mixed = stored(
            self.mixed(members.filter((F.col("size") > 2) & (F.col("size") <= SMALL))), "mixed"
        ).select("key", "cid", "label")
        other = mixed.select("key", F.col("cid").alias("_cid"), F.col("label").alias("_label"))
        self.confirm(
            mixed.join(other, "key").filter("cid < _cid AND label <> _label")
            .select(F.col("cid").alias("a"), F.col("_cid").alias("b"))
        )
        self.compare_blocks(members.filter(F.col("size") > SMALL))
        return self.labels

    def shared(self, keys: DataFrame) -> DataFrame:
        """Rows of buckets with two or more classes, with the bucket's ``size``."""
        many = stored(
            keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "buckets"
        )
        return stored(keys.join(many, "key"), "members")

    def mixed(self, rows: DataFrame) -> DataFrame:
        """Rows (with ``label``) of buckets that hold more than one component."""
        rows = self.labelled(rows, "cid", "label")
        several = (
            rows.groupBy("key").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"))
            .filter("_lo <> _hi").select("key")
        )
        return rows.join(several, "key", "left_semi")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 5,
    percent: int = PERCENT,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    df = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = stored(signatures(df, "doc_id", "text", width), "signatures")
    classes = stored(
        known.filter("class IS NOT NULL AND doc_id IS NOT NULL").groupBy("class").agg(
            F.min("doc_id").alias("cid"), F.count("*").alias("copies"), F.first("n").alias("n"),
            F.first("bits").alias("bits"), F.first("bands").alias("bands"),
        ),
        "classes",
    )
    search = Search(classes.drop("class"), df, width, percent)
    search.run()
    named = stored(
        search.labelled(classes.select("class", "cid"), "cid", "_component").drop("cid"), "named"
    )
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(
        F.coalesce("_component", "doc_id")
    )
    return (
        known.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "class")
        .join(named, "class", "left")
        .withColumn("component_id", component.cast("long"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "n_shingles", "component_id", "kept")
    )


def op5_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=2)
