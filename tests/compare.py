"""Run registered queries next to their reference SQL and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from lodegate.plans import load_queries
from lodegate.plans.registry import TABLES


def reference(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def normalized(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(spark, folder: str, name: str, connection) -> str:
    """'' when the query equals its reference SQL, else what differs."""
    query = load_queries()[name]
    frame = query.run(spark, folder)
    mine = normalized(frame.columns, frame.collect())
    if query.oracle is None:
        return "no reference SQL"
    cursor = connection.execute(query.oracle)
    names = [column[0] for column in cursor.description]
    theirs = normalized(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}; extra {list(set(mine) - set(theirs))[:3]}; missing {list(set(theirs) - set(mine))[:3]}"
    if mine == theirs:
        return ""
    extra, missing = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
    return f"{len(extra)} rows differ: {extra[:2]} instead of {missing[:2]}"


if __name__ == "__main__":
    from lodegate import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    session = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    connection = reference(folder)
    for name, query in load_queries().items():
        if wanted and not any(part in name for part in wanted):
            continue
        start = time.time()
        try:
            problem = compare(session, folder, name, connection)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "ok" if not problem else "BAD"
        print(f"{kind} {name} {time.time() - start:.1f}s {'rows only' if query.oracle is None else ''} {problem}", flush=True)
