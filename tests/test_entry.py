"""Driver contract: entry, queries and oracle agree on sf0.001."""

import hashlib
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["index", "pipeline", "records"]
    assert df.count() > 0


def test_keys():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(round(r[i], 6)) if isinstance(r[i], float) else repr(r[i]) for i in order)
                  for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "orders", "conversations", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    types = {"LongType()": "BIGINT", "IntegerType()": "INTEGER", "StringType()": "VARCHAR",
             "BooleanType()": "BOOLEAN", "TimestampNTZType()": "TIMESTAMP", "DateType()": "DATE"}
    assert {f.name: types.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields} == \
        {c: str(t) for c, t in zip(rel.columns, rel.types)}
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm(rows, df.columns) == _norm(res.fetchall(), ocols)
