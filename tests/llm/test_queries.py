"""Registered queries against their SQL twins, where there is one."""

from __future__ import annotations

import math

import pytest

from storecast.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL

TABLES = "documents embeddings benchmark pages labels conversations".split()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        return f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types)))
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    assert {c: names[t] for c, t in got.dtypes} == kinds
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(want.columns, want.fetchall())
