"""Every registered query with a SQL check equals DuckDB's answer on the same tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module
from eventmill.sources.tables import SCHEMAS

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in SCHEMAS:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(pdf: pd.DataFrame):
    columns = sorted(pdf.columns)
    return columns, sorted(
        tuple("null" if pd.isna(v) else repr(v) for v in row)
        for row in pdf[columns].astype(object).itertuples(index=False)
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    got, want = df.toPandas(), duck.execute(ORACLES[name]).df()
    # Pandas makes doubles of Spark's integers where some are null; both sides are integers.
    for column, kind in df.dtypes:
        if kind in ("int", "bigint") and column in want and str(want[column].dtype) == "Int64":
            got[column] = got[column].astype("Int64")
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(name, spark, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns
    assert df.limit(1).count() == 1


def test_entry_has_rows(spark):
    assert entry_module.entry(spark).columns == ["window_end", "item_id", "cnt", "rank_no"]
