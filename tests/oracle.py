"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else float(v))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[str, float, float]:
    from riffle.queries import ORACLES, QUERIES

    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    t1 = time.time()
    if name not in ORACLES:
        return f"rows-only {len(got)} {df.columns}", t1 - t0, 0.0
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    want = rows_of(cols, res.fetchall())
    t2 = time.time()
    if sorted(cols) != sorted(df.columns):
        return f"BAD columns {sorted(df.columns)} vs {sorted(cols)}", t1 - t0, t2 - t1
    if got != want:
        diff = [(a, b) for a, b in zip(got, want) if a != b]
        return f"BAD rows {len(got)} vs {len(want)}; first {str(diff[:2])[:1500]}", t1 - t0, t2 - t1
    return f"ok {len(got)}", t1 - t0, t2 - t1


if __name__ == "__main__":
    from riffle.queries import QUERIES
    from riffle.session import local_session

    sf = sys.argv[1]
    spark = local_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for n in sys.argv[2:] or list(QUERIES):
        try:
            msg, s, d = compare(spark, con, n, sf)
        except Exception as e:  # noqa: BLE001
            msg, s, d = f"ERROR {type(e).__name__}: {str(e)[:900]}", 0, 0
        print(f"{n:28s} spark {s:6.2f}s duck {d:6.2f}s  {msg}", flush=True)
