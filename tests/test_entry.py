import duckdb

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["Month", "n_loans", "n_default", "default_rate"]
    assert len(rows) > 0 and all(0 <= r.default_rate <= 1 and r.n_default <= r.n_loans for r in rows)


def test_registry_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = set(E._QUERIES)
    assert own <= set(o) and own <= set(q)


def _duck():
    con = duckdb.connect()
    for t in ["part", "lineitem", "orders"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_flagship_matches_oracle_small(spark):
    got = sorted(tuple(r) for r in E.queries()["default_rate_by_month"](spark, SF).collect())
    exp = sorted(tuple(r) for r in _duck().execute(E.oracle_sql()["default_rate_by_month"]).fetchall())
    assert got == exp


def test_sample_matches_oracle_small(spark):
    got = sorted(tuple(r) for r in E.queries()["stratified_sample"](spark, SF).collect())
    exp = sorted(tuple(r) for r in _duck().execute(E.oracle_sql()["stratified_sample"]).fetchall())
    assert got == exp
