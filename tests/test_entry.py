"""Driver contract and a few registered queries against DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E

SQL_CHECKED = ["normalize_target", "plateau_flags", "impute_target", "lag_features", "model_matrix",
               "time_folds", "knn_regression", "portfolio_metrics", "features_toggled_off", "result_files"]


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 1 and {"group", "mae", "rmse", "nrmse"} <= set(df.columns)


@pytest.mark.parametrize("name", SQL_CHECKED)
def test_query_matches_oracle(spark, sf001, name):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("events", "lineitem", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{sf001}/{t}.parquet')")
    got = E.queries()[name](spark, sf001).toPandas()
    exp = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    cols = sorted(got.columns)
    key = lambda df: sorted(map(repr, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))
    assert key(got) == key(exp)
