"""Run queries on both engines and report where they differ."""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

from tallybook.session import local_session
from testbed.oracle import build
from testbed.queries import QUERIES
from testbed.tables import RAW


_SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
_SLOW_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def type_of(spark_type: str) -> str:
    return _SQL_TYPES.get(spark_type, spark_type.upper())


def plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize() + 0) if value else "0"
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return repr(round(value, 9))
    return str(value)


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in RAW:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark, con, key: str, sf_dir: str, sql: str) -> tuple[bool, str]:
    started = time.time()
    frame = QUERIES[key](spark, sf_dir)
    ours = rows_by_name(frame.columns, [tuple(r) for r in frame.collect()])
    spark_time = time.time() - started
    started = time.time()
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    theirs = rows_by_name(columns, answer.fetchall())
    note = f"{len(ours)} rows, spark {spark_time:.2f}s, duckdb {time.time() - started:.2f}s"
    if sorted(frame.columns) != sorted(columns):
        return False, f"columns {sorted(set(frame.columns) ^ set(columns))}"
    types = dict(zip(columns, (str(d[1]) for d in answer.description)))
    odd = {c: (types[c], k) for c, k in frame.dtypes if types[c] != type_of(k)}
    if odd:
        note += f" types {odd}"
    plan = frame._jdf.queryExecution().executedPlan().toString()
    slow = [node for node in _SLOW_NODES if node in plan]
    if slow:
        note += f" plan {slow}"
    if ours == theirs:
        return True, note
    missing, extra = [r for r in theirs if r not in set(ours)][:2], [r for r in ours if r not in set(theirs)][:2]
    names = sorted(columns)
    return False, f"{note}, theirs {len(theirs)}\n   {names}\n   only sql   {missing}\n   only spark {extra}"


def main(sf_dir: str, keys: list[str]) -> int:
    spark, con, statements = local_session(8), connect(sf_dir), build()
    bad = 0
    for key in keys or QUERIES:
        if key not in statements:
            print(f"{key:30s} no sql")
            continue
        try:
            same, note = compare(spark, con, key, sf_dir, statements[key])
        except Exception as error:  # keep going: one broken statement should not hide the others
            same, note = False, f"{type(error).__name__} {str(error)[:600]}"
        bad += not same
        print(f"{key:30s} {'ok  ' if same else 'DIFF'} {note}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
