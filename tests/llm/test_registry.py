import math

import duckdb
import pytest

import __spark_entry__ as E
from tessera.llm import registry as R
from tests.conftest import SF_SMALL


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return v


@pytest.mark.parametrize("name", sorted(R.oracle_sql()))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = R.queries()[name](spark, SF_SMALL)
    cur = con.execute(R.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*cols).collect()), key=str)
    assert got == sorted((tuple(plain(v) for v in r) for r in cur.fetchall()), key=str)


def test_all_are_registered():
    names = set(E.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op")}
    assert "pipeline" in names and set(R.oracle_sql()) <= names
