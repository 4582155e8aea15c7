"""Every query with SQL against DuckDB at the smallest size."""

import duckdb
import pytest

from fieldglass.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(rows):
    rounded = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(([rounded(v) for v in r] for r in rows), key=str)


@pytest.mark.parametrize("name", catalogue.ORACLE_SQL)
def test_same_as_sql(spark, small, con, name):
    df = catalogue.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {catalogue.ORACLE_SQL[name]}").fetchall()}
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({catalogue.ORACLE_SQL[name]})").fetchall()
    assert plain(tuple(r) for r in df.select(*columns).collect()) == plain(want)


@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n not in catalogue.ORACLE_SQL])
def test_runs(spark, small, name):
    assert catalogue.QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_large_scans_read_only_what_they_need(spark, small):
    plan = catalogue.QUERIES["flow_counts"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in plan and "Cartesian" not in plan
