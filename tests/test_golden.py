"""Known answers on the small sample files."""

import os

import pytest
from conftest import FIXTURES, rows
from pyspark.sql import functions as F

from eventmill.ml import patterns as fpm
from eventmill.operators import aggregates, joins, topk, windows
from eventmill.operators import patterns as pat
from eventmill.sources import readers


def read(spark, name, schema):
    df = readers.csv_rows(spark, os.path.join(FIXTURES, name), schema)
    return df.withColumn("ts", F.timestamp_seconds("t"))


@pytest.fixture(scope="module")
def logins(spark):
    return read(spark, "logins.csv", "user_id bigint, ip string, kind string, t bigint")


@pytest.fixture(scope="module")
def orders(spark):
    return read(spark, "orders.csv", "order_id bigint, kind string, tx string, t bigint")


@pytest.fixture(scope="module")
def receipts(spark):
    return read(spark, "receipts.csv", "tx string, channel string, t bigint")


@pytest.fixture(scope="module")
def clicks(spark):
    return read(
        spark, "ad_clicks.csv",
        "user_id bigint, ad_id bigint, province string, city string, t bigint",
    )


def test_strict_next(logins):
    pairs = pat.strict_next(logins, "user_id", ["ts"], "kind", "fail", 2)
    assert [r[0] for r in rows(pairs)] == [1035, 1035]


def test_fail_pairs_agree_with_strict_next(logins):
    args = ("user_id", ["ts"], "kind", "fail")
    assert rows(pat.fail_pairs(logins, *args, "success", 2)) == rows(
        pat.strict_next(logins, *args, 2)
    )


def test_fail_burst(logins):
    bursts = pat.fail_bursts(logins, "user_id", ["ts"], "kind", "fail", "success", 3, 2)
    found = bursts.select(
        "user_id", F.unix_timestamp("first_ts"), F.unix_timestamp("last_ts")
    )
    assert rows(found) == [(1035, 1558430842, 1558430844)]


def test_order_outcomes(orders):
    judged = pat.order_outcomes(orders, "order_id", "ts", "kind", "create", "pay", 900)
    counts = dict(rows(judged.groupBy("outcome").count()))
    assert counts == {"paid": 37, "paid_late": 2, "paid_without_create": 1}
    late = judged.filter("outcome = 'paid_late'").select("order_id")
    assert rows(late) == [(34756,), (34767,)]
    assert rows(judged.filter("outcome = 'paid_without_create'").select("order_id")) == [(34768,)]


def test_order_timeout_forms_agree(orders):
    """Followed-by, deadline and outcome forms give one verdict per created order."""
    args = ("kind", "create", "pay", 900)
    # One order is created and paid in the same second: "create" sorts first.
    followed = pat.followed_by(orders, "order_id", ["ts", "kind"], *args)
    deadline = pat.timeout_at_deadline(orders, "order_id", "ts", *args)
    paid = rows(followed.filter("status = 'paid'").select("order_id"))
    assert len(paid) == 37
    assert paid == rows(deadline.filter("result = 'paid'").select("order_id"))


def pays_of(orders):
    return orders.filter((F.col("kind") == "pay") & (F.col("tx") != "")).select(
        "tx", "order_id", F.col("ts").alias("pay_ts")
    )


def test_interval_join(orders, receipts):
    right = receipts.select("tx", F.col("ts").alias("receipt_ts"))
    pairs = joins.interval_join(pays_of(orders), right, "tx", "pay_ts", "receipt_ts", -5, 5)
    assert rows(pairs.select("order_id")) == [
        (34729,), (34730,), (34734,), (34746,), (34747,)
    ]


def test_match_streams(orders, receipts):
    right = receipts.select("tx", F.col("ts").alias("receipt_ts"))
    matched = joins.match_streams(pays_of(orders), right, "tx", "pay_ts", "receipt_ts", -5, 5)
    assert dict(rows(matched.groupBy("status").count())) == {
        "matched": 5, "left_only": 35, "right_only": 35
    }
    assert pays_of(orders).join(right, "tx").count() == 38


def test_blacklist(clicks):
    kept = pat.rate_limit(clicks, ["user_id", "ad_id"], "ts", 100)
    warned = kept.filter("outcome = 'warn'").select("user_id", "ad_id", "t")
    assert rows(warned) == [(937166, 1715, 1511661701)]
    passed = kept.filter("outcome = 'pass'")
    assert clicks.count() - passed.count() == 21
    assert passed.filter("province = 'beijing'").count() == 102


def test_province_windows(clicks):
    counts = dict(rows(aggregates.counts_by(clicks, "province")))
    assert counts == {
        "beijing": 123, "guangdong": 5, "zhejiang": 5, "jiangsu": 4, "henan": 3,
        "shanghai": 2, "hebei": 1,
    }
    windowed = windows.sliding_aggregate(clicks, "ts", 3600, 300, ["province"])
    assert windowed.count() == 99
    assert windowed.agg(F.sum("cnt")).first()[0] == 1716 == clicks.count() * 12


SCORES = (
    "aa 78, bb 69, cc 50, aa 68, bb 59, cc 40, aa 58, bb 49, cc 30, aa 48, bb 39, cc 20, aa 38, "
    "bb 29, cc 10, aa 78, bb 69, cc 50, aa 78, bb 69, cc 50"
)


def test_top_three_per_group_plain_and_salted(spark):
    scores = spark.createDataFrame(
        [(i, *pair.split()) for i, pair in enumerate(SCORES.split(", "))],
        "id int, name string, score string",
    ).withColumn("score", F.col("score").cast("int"))
    plain = topk.top_per_group(scores, ["name"], "score", 3, ["id"])
    best = {}
    for name, score in sorted(plain.select("name", "score").collect()):
        best.setdefault(name, []).append(score)
    assert best == {"aa": [78] * 3, "bb": [69] * 3, "cc": [50] * 3}
    salted = topk.top_per_group_salted(scores, ["name"], "score", 3, ["id"], salts=2)
    assert rows(plain) == rows(salted)


def test_word_count(spark):
    lines = readers.text_lines(spark, os.path.join(FIXTURES, "words.txt"))
    counts = dict(rows(aggregates.word_counts(lines, "value")))
    with open(os.path.join(FIXTURES, "words.txt")) as f:
        words = f.read().split()
    assert counts == {w: words.count(w) for w in words}
    assert aggregates.token_total(lines, "value").first()[0] == len(words)


def test_frequent_itemsets(spark):
    lines = readers.text_lines(spark, os.path.join(FIXTURES, "baskets.txt"))
    baskets = lines.select(F.split(F.trim("value"), " ").alias("items"))
    model = fpm.mine(baskets, 0.5, 0.8)
    assert fpm.itemsets(model).count() == 18
    strongest = fpm.rules(model).agg(F.min("confidence")).first()[0]
    assert strongest >= 0.8


def test_prefix_span(spark):
    sequences = [
        [[1], [1, 2, 3], [1, 3], [4], [3, 6]],
        [[1, 4], [3], [2, 3], [1, 5]],
        [[5, 6], [1, 2], [4, 6], [3], [2]],
        [[5], [7], [1, 6], [3], [2], [3]],
    ]
    df = spark.createDataFrame([(s,) for s in sequences], "sequence array<array<int>>")
    patterns = fpm.prefix_span(df, 0.5, 5)
    assert fpm.recommended_sequences(patterns, 3, 2).count() == 6
