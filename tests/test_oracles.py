"""Every registered query with an oracle must equal its DuckDB SQL on the smallest scale (row count, columns and an
order-insensitive value digest); rows-only queries must run."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import digest

#: The model fits are tested in test_ml_and_state.py, the training-data operators in llm/.
SLOW = {"gbt_metrics", "kmeans_profile", "ridge_premiums", "model_artifact"}


@pytest.fixture(scope="module")
def duck(sf):
    import duckdb

    from postlens.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def _own(names):
    return sorted(n for n in names if not n.startswith("op") and n != "pipeline")


@pytest.mark.parametrize("name", _own(E.oracle_sql()))
def test_query_matches_oracle(spark, sf, duck, name):
    sdf = E.queries()[name](spark, sf)
    scols, srows = sdf.columns, [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(scols, srows)[0] == digest(dcols, drows)[0]


@pytest.mark.parametrize("name", _own(n for n in E.queries() if n not in E.oracle_sql() and n not in SLOW))
def test_rows_only_query_runs(spark, sf, name):
    assert E.queries()[name](spark, sf).count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["term", "n", "share"]
    assert df.count() > 0
