"""Every registered query equals its oracle SQL run by DuckDB (sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from support import SF_ORACLE, core_queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "documents", "labels"]


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if hasattr(v, "isoformat"):
        return (2, v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat())
    return (3, str(v))


def canon(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_ORACLE, t)}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(core_queries()) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(core_queries()) >= 78


@pytest.mark.parametrize("name", sorted(core_queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert got, "no rows: nothing is compared"
    assert sorted(df.columns) == sorted(ocols)
    assert canon(got, df.columns) == canon(want, ocols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["basis_year", "n_name", "zone"]
    assert df.count() > 0


def test_ordered_results_come_back_in_order(spark):
    df = E.queries()["report_status"](spark, SF_ORACLE)
    got = [(r["basis_year"], r["n_orders"]) for r in df.collect()]
    assert all(a[0] > b[0] or (a[0] == b[0] and a[1] >= b[1]) for a, b in zip(got, got[1:]))


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}


def test_column_types_match_oracle(spark, con):
    for name, fn in core_queries().items():
        ours = {f.name: SPARK_TO_DUCKDB.get(f.dataType.simpleString(), f.dataType.simpleString())
                for f in fn(spark, SF_ORACLE).schema}
        rel = con.sql(E.oracle_sql()[name])
        assert ours == {c: str(t) for c, t in zip(rel.columns, rel.types)}, name


def test_no_query_emits_raw_timestamps(spark):
    for name, fn in core_queries().items():
        types = [f.dataType.simpleString() for f in fn(spark, SF_ORACLE).schema]
        assert not any(t.startswith("timestamp") for t in types), name
