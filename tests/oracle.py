"""Runs registered queries next to their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{root}/{t}.parquet')")
    return con


def canonical(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else round(value, 6))
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if hasattr(value, "item"):
        return canonical(value.item())
    return value if isinstance(value, str) else float(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when both sides hold the same columns and rows, else what differs."""
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    columns = sorted(names)
    for a, b in zip(got, want, strict=True):
        if a != b:
            return str([(c, x, y) for c, x, y in zip(columns, a, b, strict=True) if x != y][:6] + [a[:3], b[:3]])
    return None


def main(root: str, only: list[str]) -> int:
    from lanemart.session import build_session

    conf = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g"}
    spark = build_session(master="local[4]", conf=conf)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(root), 0
    import __spark_entry__  # noqa: F401  registers the queries
    from lanemart.queries import ORACLES as sqls
    from lanemart.queries import QUERIES

    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            problem = difference(fn(spark, root), con, sqls[name]) if name in sqls else f"no oracle, rows {fn(spark, root).count()}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - t:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
