"""Compare registered queries with their SQL: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return ("f", "nan") if math.isnan(value) else ("f", repr(value + 0.0))
    if isinstance(value, bool):
        return ("b", str(value))
    return (type(value).__name__, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark, con, sf_dir: str, name: str, function, sql: str) -> tuple[str, int]:
    """Empty text if equal, else what differs; and the number of rows."""
    df = function(spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    theirs = _rows(names, answer.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}", len(ours)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}", len(ours)
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        a, b = unequal[0]
        cells = [(c, x, y) for c, x, y in zip(sorted(names), a, b) if x != y]
        return f"{len(unequal)} rows differ, first: {cells}", len(ours)
    return "", len(ours)


def main(arguments: list[str]) -> int:
    import __spark_entry__ as entry
    from lanewatch.session import build_session

    scale, wanted = (arguments[0] if arguments else "0.01"), arguments[1:]
    sf_dir = f"/root/testdata/sf{scale}"
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        if name not in oracle:
            print(f"{name}: {function(spark, sf_dir).count()} rows, no SQL")
            continue
        try:
            text, rows = differences(spark, con, sf_dir, name, function, oracle[name])
        except Exception as error:  # report and go on with the next query
            text, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += bool(text)
        print(f"{name}: {'ok' if not text else 'DIFFERS ' + text} ({rows} rows,"
              f" {time.time() - start:.1f} s)", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
