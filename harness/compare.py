"""Run every query and its SQL side by side: ``python -m harness.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from harness.registry import ORACLE, QUERIES
from wattline.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(cells, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    began = time.time()
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    took = f"{time.time() - began:.2f}s"
    if name not in ORACLE:
        return False, f"{len(ours[1])} rows, no SQL, {took}"
    cursor = con.execute(ORACLE[name])
    theirs = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return False, f"columns {ours[0]} != {theirs[0]}"
    if ours[1] != theirs[1]:
        odd = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b][:2]
        return False, f"{len(ours[1])} rows != {len(theirs[1])} rows, first differences {odd}"
    return True, f"{len(ours[1])} rows, {took}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("compare", "local[8]", 8, {"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        try:
            good, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on to the next query
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not good
        print("ok  " if good else "BAD ", name, note, flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
