"""Every registered query against its DuckDB twin (the driver's correctness gate), at sf0.001."""

import os

import duckdb
import pytest

from scripts.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _names():
    from __spark_entry__ import queries
    return sorted(set(queries()) - set(optional()))


def optional():
    """Queries of the training-data subpackage, which has tests of its own."""
    import importlib.util
    if importlib.util.find_spec("meterlake.llm") is None:
        return []
    from meterlake.llm.queries import QUERIES
    return [*QUERIES, "pipeline"]


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.columns, name
        return
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    hs, ks, cs = digest(df.columns, rows)
    hd, kd, cd = digest(dcols, res.fetchall())
    assert cs == cd
    assert len(ks) == len(kd)
    assert hs == hd, (set(ks) - set(kd), set(kd) - set(ks))


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "avg_consumption" in df.columns
