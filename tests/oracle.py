"""Run a registered query and its SQL and compare the rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _sorted(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(r[i] for i in order) for r in rows),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN",
    "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "date": "DATE",
}


def differences(spark, con, case, sf_dir: str) -> list[str]:
    df = case.query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    cursor = con.execute(case.sql)
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    found = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            found.append(f"type of {name}: {kind} != {kinds[name]}")
    if len(got) != len(want):
        found.append(f"rows {len(got)} != {len(want)}")
    a, b = _sorted(df.columns, got), _sorted(columns, want)
    for x, y in zip(a, b):
        if x != y:
            found.append(f"{x!r} != {y!r}"[:600])
            break
    return found
