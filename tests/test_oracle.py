"""Every registered key against its DuckDB SQL on the smallest driver tables."""
import datetime as dt
import decimal
import math

import duckdb
import pytest

from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _keys():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


def test_every_query_has_sql():
    from __spark_entry__ import oracle_sql, queries
    from alertflow.oracle import all_sql
    from alertflow.registry import all_queries
    assert set(all_queries()) == set(all_sql())
    assert set(oracle_sql()) <= set(queries())


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


@pytest.mark.parametrize("key", _keys())
def test_matches_sql(spark, con, key):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[key](spark, SF_SMALL)
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {oracle_sql()[key]}").fetchall()}
    assert {c: _TYPES.get(t, t) for c, t in df.dtypes} == duck_types  # same schema, not just values
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    res = con.execute(oracle_sql()[key])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    idx = [names.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert got == want


def test_entry(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert rows and {r["label"] for r in rows} <= {"AGN", "QSO", "VS", "YSO", "Other"}
