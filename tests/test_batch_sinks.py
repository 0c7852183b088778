"""Sinks of micro-batches: repeated batches change nothing, untouched files stay."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from eventmill.session import work_dir
from eventmill.sinks.batches import KeyedTable, RollingReport, routes, start_outputs
from eventmill.sources.readers import stream_source

SCHEMA = "k bigint, at bigint, v double"


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def feed(spark, parts, schema=SCHEMA):
    inbox = work_dir(spark, "batches-in")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(inbox)
    return stream_source(spark, "parquet", inbox, schema, maxFilesPerTrigger=1)


def test_only_touched_buckets_are_written(spark):
    path = work_dir(spark, "keyed-test")
    kept = KeyedTable(spark, path, SCHEMA, ["k"], ["at"], 64)
    first = spark.createDataFrame([(k, 1, float(k)) for k in range(40)] + [(None, 1, 0.5)], SCHEMA)
    kept.upsert(first, 0)
    before = files(path)
    # One key twice, an older row, a new key; equal order falls to the larger value.
    batch = spark.createDataFrame([(3, 5, 1.0), (3, 4, 2.0), (7, 0, 9.0), (99, 1, 1.0), (8, 1, 9.5)], SCHEMA)
    kept.upsert(batch, 1)
    after = files(path)
    assert {f: t for f, t in after.items() if f in before} == before
    new = {f.split("bucket=")[1].split("/")[0] for f in set(after) - set(before)}
    assert 1 <= len(new) <= 4
    want = {k: (1, float(k)) for k in range(40)} | {None: (1, 0.5), 3: (5, 1.0), 99: (1, 1.0), 8: (1, 9.5)}
    assert {r.k: (r["at"], r.v) for r in kept.read().collect()} == want
    kept.upsert(batch, 1)  # repeated: the same table
    assert {r.k: (r["at"], r.v) for r in kept.read().collect()} == want
    assert kept.read().count() == len(want)
    kept.upsert(batch.limit(0), 2)
    assert kept.read().count() == len(want)


def test_keyed_table_survives_a_restart(spark):
    path = work_dir(spark, "keyed-restart")
    kept = KeyedTable(spark, path, SCHEMA, ["k"], ["at"], 8)
    stream = feed(spark, [[(k, i, float(i)) for k in range(i, 20 + i)] for i in range(3)])
    failed = []

    def failing(batch, batch_id):
        kept.upsert(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(1)
            raise RuntimeError("lost after the write")

    start = lambda: (stream.writeStream.foreachBatch(failing)
                     .option("checkpointLocation", path + "-checkpoint").trigger(availableNow=True).start())
    with pytest.raises(Exception, match="lost after the write"):
        start().awaitTermination()
    start().awaitTermination()
    want = {k: float(i) for i in range(3) for k in range(i, 20 + i)}
    assert {r.k: r.v for r in kept.read().collect()} == want


def test_outputs_of_a_repeated_batch_are_replaced(spark):
    path = work_dir(spark, "outputs-test")
    schema = "id bigint, kind string"
    stream = feed(spark, [[(1, "a"), (2, "b"), (3, None)], [(4, "a"), (5, "z")]], schema)
    outputs, failed = routes("kind", ["a", "b"]), []
    rest = outputs["other"]

    def once(batch):
        if not failed:
            failed.append(1)
            raise RuntimeError("lost between two outputs")
        return rest(batch)

    outputs["other"] = once
    with pytest.raises(Exception, match="lost between"):
        start_outputs(stream, outputs, path, path + "-checkpoint").awaitTermination()
    start_outputs(stream, outputs, path, path + "-checkpoint").awaitTermination()
    got = {n: rows(spark.read.parquet(f"{path}/{n}").select("id")) for n in outputs}
    assert got == {"a": [(1,), (4,)], "b": [(2,)], "other": [(3,), (5,)]}


def test_report_covers_the_last_batches(spark):
    path = work_dir(spark, "report-test")
    report = RollingReport(spark, path, "k", "v", batches=2, top=2)
    parts = [[(1, 0, 5.0), (2, 0, 1.0)], [(2, 1, 1.5), (3, 1, 9.0)], [(1, 2, 0.25)]]
    report.start(feed(spark, parts), path + "-checkpoint").awaitTermination()
    got = rows(report.reports().select("batch_id", "k", F.col("total").cast("double"), "cnt"))
    assert got == [(0, 1, 5.0, 1), (0, 2, 1.0, 1), (1, 1, 5.0, 1), (1, 3, 9.0, 1), (2, 2, 1.5, 1), (2, 3, 9.0, 1)]
    report.save(spark.createDataFrame(parts[1], SCHEMA), 1)  # repeated
    assert rows(report.reports().select("batch_id", "k", F.col("total").cast("double"), "cnt")) == got
