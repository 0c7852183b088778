"""Document fingerprints: closed syncmers over word units.

A text is a sequence of units: words of up to 12 characters, and each character of a
longer run without blanks, so an insertion moves no other cut. A k-mer of units is an
anchor if the smallest of its inner s-mers, by hash, is the first or the last: a
property of the k-mer alone, so the same passage has the same anchors in any text. A
text with fewer than k units is one anchor. The fingerprint is the array of all anchors
(position, hash) in order; the query writes it out as a string. Likeness is the exact Jaccard similarity of the sets of
anchor hashes. Aligned are the links that two texts share: an anchor, the next one and
the distance between their positions, wherever in the text they stand.

All of it is column expressions. The next document by descending id comes from one
shuffle into id ranges of even counts; each range also gets the head of the range
below it, so no task sees all ids.

Nulls: a null text is empty, an empty text has no anchors (like only to another empty
one); a null id comes last. Rows that repeat an id are ordered by text. With one
row, the next document is the row itself. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventmill.llm.common import documents

K, S = 4, 2
WORD = r"[^\x20\x09-\x0D]"
UNIT = rf"(?<!{WORD}){WORD}{{1,12}}(?!{WORD})|{WORD}"
ROWS_PER_RANGE = 2_000
MOST_RANGES = 1 << 13


def with_anchors(df: DataFrame, text_col: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """``df`` with ``name``: array of (pos, hash) of the anchors of a text, in order."""
    inner = k - s + 1
    if inner < 3:
        raise ValueError("a k-mer needs an s-mer between its edges")
    u, g, m = F.col("_units"), F.col("_smers"), F.col("_n") - k + 1
    step1 = df.withColumn(
        "_units",
        F.transform(
            F.regexp_extract_all(F.coalesce(text_col, F.lit("")), F.lit(UNIT), F.lit(0)),
            lambda x: F.xxhash64(x),
        ),
    ).withColumn("_n", F.size("_units"))
    parts = F.arrays_zip(*(
        F.slice(u, i + 1, F.greatest(F.col("_n") - s + 1, F.lit(0))).alias(f"u{i}")
        for i in range(s)
    ))
    step2 = step1.withColumn(
        "_smers", F.transform(parts, lambda x: F.xxhash64(*(x[f"u{i}"] for i in range(s))))
    )
    windows = F.arrays_zip(
        *(F.slice(g, i + 1, F.greatest(m, F.lit(0))).alias(f"s{i}") for i in range(inner)),
        F.sequence(F.lit(0), F.greatest(m, F.lit(1)) - 1).alias("pos"),
    )
    def closed(x):
        middle = [x[f"s{i}"] for i in range(1, inner - 1)]
        edge = F.least(x["s0"], x[f"s{inner - 1}"])
        return edge <= (F.least(*middle) if len(middle) > 1 else middle[0])

    anchor = lambda x: F.struct(
        x["pos"].alias("pos"), F.xxhash64(*(x[f"s{i}"] for i in range(inner))).alias("hash")
    )
    short = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(u).alias("hash")))
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return step2.withColumn(
        name,
        F.when(F.col("_n") == 0, none).when(F.col("_n") < k, short)
        .otherwise(F.transform(F.filter(windows, closed), anchor)),
    ).drop("_units", "_smers", "_n")


def written(anchors: Column) -> Column:
    """All anchors as text, ``[{position, hash}, ...]``: equal texts, equal strings."""
    return anchors.cast("string")


def hashes(anchors: Column) -> Column:
    return F.array_distinct(anchors["hash"])


def links(anchors: Column) -> Column:
    """Distinct hashes of neighbouring anchors with the distance of their positions."""
    following = F.slice(anchors, 2, F.greatest(F.size(anchors) - 1, F.lit(0)))
    first = F.slice(anchors, 1, F.greatest(F.size(anchors) - 1, F.lit(0)))
    pairs = F.arrays_zip(first.alias("x"), following.alias("y"))
    return F.array_distinct(F.transform(pairs, lambda p: F.xxhash64(
        p["x"]["hash"], p["y"]["pos"] - p["x"]["pos"], p["y"]["hash"]
    )))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; two empty ones are alike."""
    common = F.size(F.array_intersect(a, b))
    whole = F.size(a) + F.size(b) - common
    return F.when(whole == 0, 1.0).otherwise(common / whole).cast("double")


def aligned(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)).cast("long")


def compared(df: DataFrame, base: str, others: list[str]) -> DataFrame:
    """``df`` with ``near_<o>`` and ``aligned_<o>`` for each text column of ``others``.

    The anchors of each column are kept as ``_<column>``.
    """
    for name in (base, *others):
        df = with_anchors(df, name, f"_{name}")
    for name in (base, *others):
        df = df.withColumn(f"_h_{name}", hashes(F.col(f"_{name}"))).withColumn(
            f"_l_{name}", links(F.col(f"_{name}"))
        )
    return df.withColumns({
        f"{made}_{o}": rule(F.col(f"_{part}_{base}"), F.col(f"_{part}_{o}"))
        for o in others for made, rule, part in (("near", likeness, "h"), ("aligned", aligned, "l"))
    })


def range_number(value: Column, bounds: list) -> list[Column]:
    """Steps of a binary search for the count of ``bounds`` at or below ``value``.

    Each step is a column over ``_at``, to be applied one after the other.
    """
    width = 1
    while width <= len(bounds):
        width *= 2
    padded = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = []
    while width > 1:
        width //= 2
        probe = F.try_element_at(padded, F.col("_at") + F.lit(width))
        steps.append(F.col("_at") + F.when(probe <= value, F.lit(width)).otherwise(F.lit(0)))
    return steps


def with_next(df: DataFrame, id_col: str, carried: list[str], order: str) -> DataFrame:
    """``df`` with ``next_<c>`` of the next row by descending id, in a ring."""
    ids = df.select(id_col)
    total = ids.count()
    pieces = min(MOST_RANGES, max(1, total // ROWS_PER_RANGE))
    bounds: list[int] = []
    if pieces > 1:
        shares = [i / pieces for i in range(1, pieces)]
        found = ids.agg(F.percentile_approx(id_col, shares, 10 * pieces)).first()[0]
        bounds = sorted(set(found or []))

    def ranged(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("_at", F.lit(0))
        for step in range_number(F.col(id_col), bounds) if bounds else []:
            rows = rows.withColumn("_at", step)
        return rows.withColumn("_at", F.when(F.col(id_col).isNull(), -1).otherwise(F.col("_at")))

    heads = ranged(ids).groupBy("_at").agg(F.max(id_col).alias("head")).orderBy(F.desc("_at")).collect()
    if not heads:
        return df.select("*", *(F.col(c).alias(f"next_{c}") for c in carried))
    # The head of each range also follows the last row of the range above; the first, of the last.
    spark = df.sparkSession
    above = [(heads[i - 1]["_at"], h["head"]) for i, h in enumerate(heads)]
    ghosts = df.join(
        F.broadcast(spark.createDataFrame(above, "_at int, _head long")),
        F.col(id_col).eqNullSafe(F.col("_head")),
    ).drop("_head")
    rows = ranged(df).withColumn("_ghost", F.lit(0)).unionByName(
        ghosts.withColumn("_ghost", F.lit(1))
    )
    along = Window.partitionBy("_at").orderBy("_ghost", F.desc_nulls_last(id_col), order)
    following = F.lead(F.struct(*carried)).over(along)
    return (
        rows.withColumn("_next", following).filter("_ghost = 0")
        .select(*df.columns, *(F.col(f"_next.{c}").alias(f"next_{c}") for c in carried))
    )


def op6_closed_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    # Only texts travel: anchors are longer than the text they are made of.
    paired = with_next(docs, "doc_id", ["text"], "text")
    n, cut = F.col("n_chars"), F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", 1, n - cut), F.substring("next_text", 1, cut))
    rows = paired.withColumn("n_chars", F.length("text")).select(
        "doc_id", "n_chars", "text", edited.alias("edited"), F.col("next_text").alias("next")
    )
    return compared(rows, "text", ["edited", "next"]).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        written(F.col("_text")).alias("fingerprint"),
        written(F.col("_edited")).alias("edited_fingerprint"),
        "near_edited", "near_next", "aligned_edited", "aligned_next",
    )
