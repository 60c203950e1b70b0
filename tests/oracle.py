"""Run registered queries next to their SQL in DuckDB.

    python tests/oracle.py [sf folder] [name prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    out = frame[sorted(frame.columns)].copy()
    for c in out.columns:
        kind = out[c].dtype.kind
        if kind in "iu":
            out[c] = out[c].astype("int64")
        elif kind == "O" and out[c].map(lambda v: hasattr(v, "year") and not isinstance(v, pd.Timestamp)).any():
            out[c] = pd.to_datetime(out[c]).astype("datetime64[us]")
        elif kind == "M":
            out[c] = out[c].astype("datetime64[us]")
        elif kind == "f":
            out[c] = out[c] + 0.0
    return out.sort_values(list(out.columns), kind="stable", na_position="first").reset_index(drop=True)


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(sql_rows.columns)}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} != {len(sql_rows)}"
    a, b = normal(spark_rows), normal(sql_rows)
    for c in a.columns:
        ka, kb = a[c].dtype.kind, b[c].dtype.kind
        if ka != kb and len(a):
            return f"{c}: type {a[c].dtype} != {b[c].dtype}"
        left, right = a[c].to_numpy(), b[c].to_numpy()
        same = (left == right) | (pd.isna(left) & pd.isna(right))
        if not np.all(same):
            i = int(np.argmin(same))
            return f"{c}: {int((~same).sum())} differ, first {left[i]!r} != {right[i]!r}"
    return None


def main(argv) -> int:
    from tests.conftest import make_session
    import __spark_entry__ as entry

    folder = argv[0] if argv else "/root/testdata/sf0.01"
    spark = make_session()
    con = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            rows = fn(spark, folder).toPandas()
            note = f"{len(rows)} rows" if name not in sql else differences(rows, con.execute(sql[name]).df())
        except Exception as e:  # report and go on
            note = "ERROR " + str(e)[:1500]
        took = time.time() - start
        failed = note is not None and (name in sql or note.startswith("ERROR"))
        bad += failed
        print(f"{'FAIL' if failed else 'ok  '} {name:32s} {took:6.2f}s {note or ''}", flush=True)
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
