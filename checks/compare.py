"""Run queries and their SQL twins side by side: python -m checks.compare [folder] [name ...]"""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

from checks.oracles import BODIES, oracle
from checks.queries import REGISTRY
from storecast.session import build_session

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return con


def _cell(value) -> str:
    if isinstance(value, float):
        return f"{value:.9g}" if value == value else "NULL"
    if value is None:
        return "NULL"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return str(value)


def canonical(columns: list[str], rows) -> list[tuple[str, ...]]:
    """Rows as text with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, folder: str, name: str) -> str:
    """Empty if equal, else what differs."""
    df = REGISTRY[name](spark, folder)
    left = canonical(df.columns, df.collect())
    if name not in BODIES:
        return "" if left else "no rows"
    relation = con.sql(oracle(name))
    right = canonical(relation.columns, relation.fetchall())
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} / {sorted(relation.columns)}"
    if left != right:
        only_left = [r for r in left if r not in set(right)][:3]
        only_right = [r for r in right if r not in set(left)][:3]
        return f"{len(left)} / {len(right)} rows; {only_left} / {only_right}"
    kinds = []
    for column, kind in zip(relation.columns, relation.types):
        kinds.append((column, dict(df.dtypes)[column], str(kind)))
    odd = [k for k in kinds if k[1:] not in EQUAL_TYPES]
    return f"types {odd}" if odd else ""


EQUAL_TYPES = {
    ("bigint", "BIGINT"),
    ("int", "INTEGER"),
    ("double", "DOUBLE"),
    ("string", "VARCHAR"),
    ("boolean", "BOOLEAN"),
}


def main(argv: list[str]) -> int:
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(REGISTRY)
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failures = 0
    for name in names:
        started = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failures += bool(problem)
        kind = "sql" if name in BODIES else "rows"
        print(f"{name:36s} {kind:4s} {time.time() - started:6.1f}s {problem or 'ok'}", flush=True)
    spark.stop()
    return failures


if __name__ == "__main__":
    assert Path("storecast").is_dir(), "run from the repository root"
    sys.exit(1 if main(sys.argv[1:]) else 0)
