"""Run every query against its SQL counterpart in DuckDB: ``python tests/check_oracle.py [sf_dir]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from sessionloom.session import build_session  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    return con


def compared(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    """Whether both engines give the same columns and the same rows, in any order."""
    got = entry.queries()[name](spark, sf_dir)
    columns = sorted(got.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    want = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    if sorted(names) != columns:
        return False, f"columns {columns} != {sorted(names)}"
    at = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
    if rows != expected:
        odd = next(((a, b) for a, b in zip(rows, expected) if a != b), None)
        return False, f"{len(rows)} rows, expected {len(expected)}; first difference {odd}"
    return True, f"{len(rows)} rows"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    cores = os.environ.get("CORES", "8")
    spark = build_session(
        f"local[{cores}]",
        spark__sql__shuffle__partitions="8",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="sessionloom-oracle-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    for name in wanted or entry.oracle_sql():
        start = time.time()
        try:
            same, note = compared(spark, con, name, sf_dir)
        except Exception as error:  # one broken query must not hide the others
            same, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        bad += not same
        print(f"{'ok ' if same else 'BAD'} {name:50s} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
