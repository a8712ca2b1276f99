"""Run registered queries against their SQL in DuckDB and report differences."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(name, run, sql, spark, con, folder) -> str | None:
    frame = run(spark, folder)
    got = [tuple(r) for r in frame.collect()]
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    types = {c[0]: str(c[1]) for c in result.description}
    for field in frame.schema.fields:
        if SQL_TYPES.get(field.dataType.simpleString()) != types[field.name]:
            return f"type of {field.name}: {field.dataType.simpleString()} != {types[field.name]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    left, right = rows_of(frame.columns, got), rows_of(columns, want)
    for a, b in zip(left, right, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(columns)}\n   spark {a}\n   sql   {b}"
    return None


def main(folder: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from riskweave.session import local_session

    spark, con = local_session(8), connect(folder)
    failed, sqls = 0, oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            if name in sqls:
                problem = difference(name, run, sqls[name], spark, con, folder)
            else:
                problem, n = None, run(spark, folder).count()
                print(f"{name}: {n} rows, no sql")
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
