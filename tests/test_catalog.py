"""Every catalog query against its SQL."""

import os

import duckdb
import pytest

from changelake import catalog
from tests.conftest import SF


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in os.listdir(SF):
        path = f"{SF}/{t}" + ("/*.parquet" if os.path.isdir(f"{SF}/{t}") else "")
        con.sql(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def rows(names, values):
    return sorted((tuple(sorted(zip(names, r, strict=True))) for r in values), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_matches_sql(spark, db, name):
    got = catalog.QUERIES[name](spark, SF)
    want = db.sql(catalog.ORACLE_SQL[name])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_ddl_audit(spark):
    got = {r["ddl_id"]: r for r in catalog.ddl_audit(spark, SF).collect()}
    assert got[1]["primary_key"] == ["a", "b"] and got[1]["columns"] == ["a int", "b decimal(20,0)", "key_name string", "index_no int"]
    assert got[2]["operations"] == ["ADD  c decimal(10,2)", "DROP name"] and got[2]["is_destructive"]
    assert got[4]["operations"] == ["RENAME a>b"] and len(got[4]["warnings"]) == 2
    assert not got[5]["operations"] and not got[5]["is_destructive"]
    assert got[6]["kind"] == "DROP" and {got[k]["kind"] for k in (7, 8, 9)} == {"UNSUPPORTED"}


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pushdown_and_one_exchange(spark):
    plan = catalog.current_state(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan
    assert "props" not in plan.split("ReadSchema")[1]
