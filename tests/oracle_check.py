"""Differential check: every registered query against its DuckDB SQL twin.

Usage: ``python tests/oracle_check.py [sf_dir] [name ...]``. Compares row count, column names
and order-insensitive values (floats to 6 decimals), the way the driver's check does.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def normalise(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind == "f":
            df[c] = df[c].round(6).map(lambda x: 0.0 if x == 0 else x)
        elif df[c].dtype == object:
            df[c] = df[c].map(lambda x: tuple(np.round(np.asarray(x, dtype=float), 6)) if isinstance(x, (list, np.ndarray)) else x)
    df = df.astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(oracle_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(oracle_pdf.columns)}"
    if len(spark_pdf) != len(oracle_pdf):
        return False, f"row count {len(spark_pdf)} vs {len(oracle_pdf)}"
    a, b = normalise(spark_pdf), normalise(oracle_pdf)
    diff = (a != b).any(axis=1)
    if diff.any():
        i = int(np.argmax(diff.to_numpy()))
        return False, f"{int(diff.sum())} rows differ, first: {a.iloc[i].to_dict()} vs {b.iloc[i].to_dict()}"
    return True, f"{len(a)} rows"


def run(sf_dir: str, names: list[str] | None = None) -> dict:
    from __spark_entry__ import oracle_sql, queries

    from sparkrank.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sp = qs[name](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            out[name] = (False, f"spark error: {type(e).__name__}: {str(e)[:300]}")
            print(name, out[name], flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            out[name] = (True, f"rows-only: {len(sp)} rows")
        else:
            try:
                orc = con.sql(sqls[name]).df()
                out[name] = compare(sp, orc)
            except Exception as e:  # noqa: BLE001
                out[name] = (False, f"oracle error: {type(e).__name__}: {str(e)[:300]}")
        print(f"{name:24s} {'OK ' if out[name][0] else 'BAD'} spark {t1 - t0:6.1f}s  {out[name][1]}", flush=True)
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v[0]]
    print("FAILED:", bad if bad else "none")
