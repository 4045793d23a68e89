"""The driver contract: every query runs, and matches its oracle at sf0.001."""


import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "recommendation_list"]
    assert df.count() > 0


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return round(v, 9)
        if hasattr(v, "isoformat"):
            return v.isoformat()
        return v
    return sorted((tuple(n(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    res = duck.sql(E.oracle_sql()[name])
    assert sorted(cols) == sorted(res.columns)
    o_rows = res.fetchall()
    idx = [res.columns.index(c) for c in cols]
    o_rows = [tuple(r[i] for i in idx) for r in o_rows]
    assert _norm(df.collect()) == _norm(o_rows)


LOADED = sorted(n for n in E.oracle_sql() if not n.startswith("op"))


def test_loaded_tables_give_the_same_rows(spark, duck):
    """What the bench reads (tables written once) against the same oracle."""
    from meeple.plans import fixtures
    fixtures.load_tables(spark, SF_SMALL)
    try:
        for name in LOADED:
            df, res = E.queries()[name](spark, SF_SMALL), duck.sql(E.oracle_sql()[name])
            idx = [res.columns.index(c) for c in df.columns]
            assert _norm(df.collect()) == _norm(tuple(r[i] for i in idx) for r in res.fetchall()), name
    finally:
        fixtures.unload_tables(spark, SF_SMALL)


def test_entry_module_loads_by_path(spark):
    import importlib.util
    import pathlib
    path = pathlib.Path(__file__).resolve().parent.parent / "__spark_entry__.py"
    spec = importlib.util.spec_from_file_location("entry_by_path", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    assert set(mod.oracle_sql()) <= set(mod.queries())
    assert mod.queries()["page_info"](spark, SF_SMALL).count() == 1
