"""The driver contract: entry(), queries(), oracle_sql()."""

import glob
import os

import duckdb

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs_on_smoke_scale(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["id", "estabelecimento_id", "mes", "pos", "parte", "n_parts"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 50


def _views(con):
    for p in glob.glob(f"{SMOKE}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")


def test_oracle_matches_on_smoke_scale(spark):
    con = duckdb.connect()
    _views(con)
    qs, sql = E.queries(), E.oracle_sql()
    for name in ["payables", "conform_contacts", "error_summary", "est_month_parts_small_limit", "row_parts",
                 "adaptive_granularity", "fk_orphans", "resplit_parts", "csv_roundtrip", "verify_columns", "date_split_contacts",
                 "date_split_fits", "est_month_parts_receivables", "verify_damaged", "verify_id_listing", "impute_blank_accounts"]:
        s = qs[name](spark, SMOKE).toPandas()
        o = con.execute(sql[name]).df()
        assert sorted(s.columns) == sorted(o.columns), name
        key = sorted(s.columns)
        norm = lambda d: sorted(tuple("" if v is None or v != v else str(v) for v in r)
                                for r in d[key].itertuples(index=False))
        assert norm(s) == norm(o), name


def test_every_oracle_sql_runs():
    con = duckdb.connect()
    _views(con)
    for name, sql in E.oracle_sql().items():
        cols = [d[0] for d in con.execute(sql).description]
        assert len(cols) == len(set(cols)), name          # unique, comparable column names
