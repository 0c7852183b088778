"""Parsing, enrichment and scalar functions on hand-written values."""

import binascii
import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from eventmill.functions import enrich, parse, scalar
from eventmill.operators import joins
from eventmill.session import broadcast_if_small, prepare
from eventmill.sinks import tables as sink


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column("v")).first()[0]


def test_row_key_checksum(spark):
    df = spark.createDataFrame([("u1", "m1", "e_pv"), ("u1", " ", "e_l"), (None, None, "ab")],
                               "u string, m string, a string")
    keys = df.select(scalar.row_key(F.lit(5), F.col("u"), F.col("m"), F.col("a"))).collect()
    want = [b"u1m1u1e_pv", b"u1u1e_l", b"ab"]
    assert [r[0] for r in keys] == [f"5_{binascii.crc32(w)}" for w in want]
    assert keys[2][0] == "5_2659403885"


def test_week_numbers_start_on_sunday(spark):
    """Week 1 holds the first of January; the last days of December may belong to it."""
    days = [dt.date(2015, 1, 1) + dt.timedelta(n) for n in range(0, 3000)]
    df = spark.createDataFrame([(d,) for d in days], "d date")

    def week(d):
        saturday = d + dt.timedelta((5 - d.weekday()) % 7)
        first = dt.date(saturday.year, 1, 1)
        first_sunday = first - dt.timedelta((first.weekday() + 1) % 7)
        return (d - first_sunday).days // 7 + 1

    got = df.select("d", scalar.week_of_year("d")).collect()
    assert [(r[0], r[1]) for r in got] == [(d, week(d)) for d in days]


def test_version_dimension(spark):
    df = spark.createDataFrame(
        [("web", "1"), ("web", ""), ("web", None), (" ", "1"), (None, None)], "n string, v string"
    )
    got = [r[0] for r in df.select(scalar.version_dim("n", "v")).collect()]
    assert got == ["web:1", "web:unknow", "web:unknow", "unknown:unknown", "unknown:unknown"]


def test_zip_lists_cut_to_shortest(spark):
    assert one(spark, "1,2,3-9,8", lambda v: scalar.zip_packed(v, 2)) == "1,9->2,8"
    assert one(spark, "1,2-9,8-x", lambda v: scalar.zip_packed(v, 3)) == "1,9,x"


def test_epoch_and_dates(spark):
    assert one(spark, " 1449410796.976 ", scalar.epoch_millis) == 1449410796976
    assert one(spark, "abc", scalar.epoch_millis) == -1
    assert one(spark, "2019-08-03", scalar.is_running_date) is True
    assert one(spark, "2019-8-3", scalar.is_running_date) is False
    assert one(spark, None, scalar.is_running_date) is False
    assert one(spark, "2019-13-45", scalar.parse_running_date) is None


def test_query_params(spark):
    prepare(spark)
    get = lambda text: one(spark, text, lambda v: parse.query_params(parse.query_text(F.col(v))))
    assert get("/a?k=1&k=2&e=&flag&t=x%20y&bad=%zz") == {
        "k": "2", "e": None, "flag": None, "t": "x y", "bad": None
    }
    assert get("/a") == {}
    assert get("/a?b=1?c=2") == {} == get("/a?")
    assert get("/a?b=1&&c=2&?") == {"b": "1", "c": "2"}


def test_access_log_rejects_bad_lines(spark):
    good = '1.1.1.1 - - [21/Jul/2014:10:00:00 -0800] "GET /x/y HTTP/1.1" 200 1234'
    lines = [(good,), (good.replace(" 1234", " -"),), ("",), (good + " extra",)]
    parsed = parse.parse_access_log(spark.createDataFrame(lines, "value string"), "value")
    assert rows(parsed) == [
        ("1.1.1.1", "-", "-", "21/Jul/2014:10:00:00 -0800", "GET", "/x/y", "HTTP/1.1", 200, 1234)
    ]


def test_tracking_log_needs_four_parts(spark):
    lines = [("1.2.3.4^A1449410796.976^Ahost^A/l.gif?en=e_pv&u_ud=u",), ("a^Ab",), (" ",), ("a^Ab^Ac^A",), (None,)]
    lines += [("a^Ab^Ac^A^Ad",), ("a^Ab^Ac^Ad^Ae",)]
    parsed = parse.parse_tracking_log(spark.createDataFrame(lines, "value string"), "value")
    assert parsed.count() == 1
    keyed = parse.tracking_row_keys(parsed).first()
    assert keyed["row_key"] == f"1449410796976_{binascii.crc32(b'uue_pv')}"
    assert parse.keep_known_events(parsed, F.col("params")["en"]).count() == 1


def test_order_lines(spark):
    lines = [("1,5,2.5",), ("bad 1,5,2.5",), ("  ",), (None,)]
    parsed = parse.parse_order_line(spark.createDataFrame(lines, "value string"), "value")
    assert rows(parsed) == [(0, 0.0), (5, 2.5)]


def test_regions(spark):
    cases = {
        "广西柳州市": ("中国", "广西", "柳州市"),
        "内蒙古": ("中国", "内蒙古自治区", "unknown"),
        "湖北省武汉市": ("中国", "湖北省", "武汉市"),
        "上海": ("中国", "上海市", "unknown"),
        "天津市蓟县": ("中国", "天津市", "蓟县"),
        "澳门": ("中国", "澳门特别行政区", "unknown"),
        " CZ88.NET": ("中国", "上海市", "unknown"),
        "日本": ("日本", "unknown", "unknown"),
        "x": ("unknown", "unknown", "unknown"),
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = df.withColumns(enrich.region_of("t")).collect()
    assert {r["t"]: (r["country"], r["province"], r["city"]) for r in got} == cases


def test_user_agents(spark):
    cases = {
        "Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko":
            ("IE", "11.0", "Windows", "Windows 7"),
        "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_14_6) AppleWebKit/605.1.15 (KHTML, like Gecko) "
        "Version/12.1.2 Safari/605.1.15": ("Safari", "12.1.2", "OS X", "OS X 10.14.6"),
        "Mozilla/5.0 (X11; Linux x86_64; rv:60.0) Gecko/20100101 Firefox/60.0":
            ("Firefox", "60.0", "Linux", "Linux"),
        "curl": ("unknown", "unknown", "unknown", "unknown"),
        " ": (None, None, None, None),
    }
    df = spark.createDataFrame([(k,) for k in cases], "ua string")
    got = enrich.with_user_agent(df, "ua").collect()
    fields = ("browser", "browser_v", "os", "os_v")
    assert {r["ua"]: tuple(r[f] for f in fields) for r in got} == cases


def test_ip_numbers(spark):
    assert one(spark, "10.0.0.1", enrich.ipv4_to_long) == 167772161
    assert one(spark, "10.0.0.256", enrich.ipv4_to_long) is None
    assert one(spark, "10.0.0", enrich.ipv4_to_long) is None


def test_quarantine(spark):
    raw = spark.createDataFrame([("1", "2.5"), ("x", "1"), (None, "3")], "a string, b string")
    got = rows(parse.quarantine(raw, {"a": "int", "b": "double"}).filter("NOT is_bad").select("b"))
    assert got == [(2.5,), (3.0,)]


def test_upsert_keeps_newest(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1)],
                                    "k int, v string, at int")
    assert rows(sink.upserted(current, updates, ["k"], ["at"])) == [
        (1, "a"), (2, "new"), (3, "c")
    ]


def test_upsert_leaves_one_row_per_key_for_equal_updates(spark):
    current = spark.createDataFrame([(1, "a")], "k int, v string")
    updates = spark.createDataFrame([(1, "x", 5), (1, "y", 5), (1, "y", 5)], "k int, v string, at int")
    assert rows(sink.upserted(current, updates, ["k"], ["at"])) == [(1, "y")]


def test_broadcast_is_size_checked(spark, sf_dir):
    small = spark.range(10).withColumnRenamed("id", "k")
    assert "broadcast" in broadcast_if_small(small)._jdf.queryExecution().logical().toString()
    plain = broadcast_if_small(small, limit=8)
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString()
    mapping = spark.createDataFrame([(1, 100)], "bad bigint, good bigint")
    named = joins.lookup_with_default(small, "k", mapping, "bad", "good", "final")
    assert dict(rows(named))[1] == 100 and dict(rows(named))[2] == 2
