"""Run registered queries and their SQL side by side: ``python -m checks.compare [names…]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.queries import QUERIES
from tidemark.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of plain text, columns in name order."""
    def show(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "∅"
        if hasattr(v, "item"):
            v = v.item()
        return repr(float(v) + 0.0) if isinstance(v, float) else str(v)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(show(v) for v in row) for row in frame.itertuples(index=False, name=None))


def check(name: str, spark, con, folder: str) -> tuple[bool, str]:
    start = time.time()
    got = QUERIES[name](spark, folder).toPandas()
    spent = time.time() - start
    if name not in ORACLES:
        return True, f"{len(got)} rows, no SQL ({spent:.1f}s)"
    start = time.time()
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = pd.DataFrame(cursor.fetchall(), columns=names, dtype=object)
    sql = time.time() - start
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return True, f"{len(a)} rows ({spent:.1f}s, sql {sql:.1f}s)"
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return False, f"rows {len(a)} vs {len(b)}; only spark {len(only_a)} {only_a[:2]}; only sql {len(only_b)} {only_b[:2]} cols {sorted(got.columns)}"


def main() -> int:
    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(), connect(folder)
    bad = 0
    for name in sys.argv[1:] or list(QUERIES):
        try:
            ok, note = check(name, spark, con, folder)
        except Exception as error:  # noqa: BLE001
            ok, note = False, f"{type(error).__name__}: {str(error)[:400]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
