"""Positions in written files, dense numbers, and model outputs that keep their names."""

import pytest

import __spark_entry__ as entry_module
from eventmill.ml import features, models, recommend
from eventmill.plans import models as plans
from eventmill.sources.order import dense_numbers, with_position

QUERIES = entry_module.queries()


def test_positions_follow_parts_and_pieces(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.range(1_000).repartitionByRange(12, "id").sortWithinPartitions("id")
    rows.write.option("maxRecordsPerFile", 7).parquet(path)
    got = with_position(spark, path, "id long").collect()
    assert sorted((r.id, r.position) for r in got) == [(i, i + 1) for i in range(1_000)]


def test_positions_whatever_the_name_of_the_write(spark, tmp_path):
    for piece, first in enumerate((0, 7)):
        written = tmp_path / f"w{piece}"
        spark.range(first, first + 7).coalesce(1).write.parquet(str(written))
        (part,) = written.glob("part-*.parquet")
        target = tmp_path / "rows" / f"part-00000-0a1b2c3d-c4e5-4a6b-c789-0123456789ab-c00{piece}.zstd.parquet"
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(part.read_bytes())
    got = with_position(spark, str(tmp_path / "rows"), "id long").collect()
    assert sorted((r.id, r.position) for r in got) == [(i, i + 1) for i in range(14)]


def test_dense_numbers_of_long_ids(spark):
    ids = [-(2**62), -1, 0, 5, 2**31, 2**40, 2**62]
    df = spark.createDataFrame([(i,) for i in [*ids, None, 5, 2**62]], "user long")
    got = {r.user: r.no for r in dense_numbers(df, "user", "no").collect()}
    assert got == {i: n for n, i in enumerate(ids)}
    assert dense_numbers(df.limit(0), "user", "no").count() == 0


def test_factors_of_ids_above_32_bits(spark):
    base = 2**40
    rows = [(base + u, f"item{i}", float((u * i) % 5 + 1)) for u in range(8) for i in range(6)]
    known = recommend.coded(
        spark.createDataFrame([*rows, (None, "item1", 1.0)], "user long, item string, rating float")
    )
    assert known.rows.count() == len(rows)
    model = recommend.als(rank=3).fit(known.rows)
    best = recommend.top_items(model, known, known.users.select("user").limit(2), 4).collect()
    assert len(best) == 8 and all(r.user >= base and r.item.startswith("item") for r in best)
    users = recommend.top_users(model, known, known.items.select("item").limit(1), 3).collect()
    assert len(users) == 3 and all(r.user >= base for r in users)


def test_factors_of_every_user_and_item_predict(spark, sf_dir):
    known = recommend.coded(plans.ratings(spark, sf_dir))
    model = recommend.als().fit(known.rows)
    own = QUERIES["rec_als_factors"](spark, sf_dir).collect()
    assert {len(r.factors) for r in own} == {10}
    kinds = [(r.kind, r.id) for r in own]
    assert len(kinds) == len(set(kinds)) == known.users.count() + known.items.count()
    by = {(r.kind, r.id): r.factors for r in recommend.factors(model, known).collect()}
    for r in model.transform(known.rows).limit(20).collect():
        product = sum(a * b for a, b in zip(by["user", r.user], by["item", r.item], strict=True))
        assert product == pytest.approx(r.prediction, abs=1e-3)


def test_probabilities_are_whole(spark, sf_dir):
    got = QUERIES["clf_probability"](spark, sf_dir).collect()
    assert got
    for r in got:
        assert sum(r.probability) == pytest.approx(1.0)
        assert r.probability[int(r.prediction)] == max(r.probability)


def test_importances_keep_their_names(spark, sf_dir):
    got = {r.feature: r.importance for r in QUERIES["clf_importances"](spark, sf_dir).collect()}
    assert set(got) == {*plans.LINE_FEATURES, "l_extendedprice"}
    assert sum(got.values()) == pytest.approx(1.0) and min(got.values()) >= 0
    rows = features.assemble(spark.createDataFrame([(1.0, 2.0)], "b double, a double"), ["b", "a"])
    assert models.feature_names(rows) == ["b", "a"]


def test_importances_find_the_deciding_column(spark):
    df = spark.range(400).selectExpr(
        "id % 7 * 1.0D AS noise", "id % 2 * 1.0D AS flag", "id % 2 * 1.0D AS label")
    rows = features.assemble(df, ["noise", "flag"])
    got = {r.feature: r.importance for r in models.importances(
        models.Forest(numTrees=3, featureSubsetStrategy="all", seed=1).fit(rows), rows).collect()}
    assert got["flag"] > 0.99


def test_centres_count_every_row(spark, sf_dir):
    got = {r.cluster: r for r in QUERIES["clu_kmeans_centres"](spark, sf_dir).collect()}
    assert set(got) == set(range(10))
    assert sum(r["size"] for r in got.values()) == spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
    assert len({len(r.centre) for r in got.values()}) == 1
