"""Run registered queries against their DuckDB twins.

    python tests/compare.py [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "~"
        return repr(value + 0.0) if value != int(value) or abs(value) > 1e15 else str(int(value))
    if hasattr(value, "item"):
        return _plain(value.item())
    return str(value)


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(_plain(v) for v in row) for row in frame.itertuples(index=False, name=None))


def compare(spark, con, query, sf_dir: str) -> tuple[str, str]:
    """('ok' | 'rows' | 'FAIL', detail)"""
    got = query.run(spark, sf_dir).toPandas()
    if query.sql is None:
        return ("rows" if len(got) else "FAIL"), f"{len(got)} rows, no SQL"
    want = con.execute(query.sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return "FAIL", f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    a, b = rows_of(got), rows_of(want)
    if a == b:
        return ("ok" if a else "FAIL"), f"{len(a)} rows"
    only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return "FAIL", f"{len(a)}/{len(b)} rows\n   cols  {sorted(got.columns)}\n   spark {only_a}\n   sql   {only_b}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--conf", action="append", default=[], help="key=value")
    parser.add_argument("--plain", action="store_true", help="a session without the library defaults")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()

    import headwater.plans  # noqa: F401
    from headwater import build_session
    from headwater.plans.registry import REGISTRY

    sf_dir = f"{DATA}/sf{args.sf}"
    if args.plain:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    else:
        spark = build_session("compare", "local[8]", 8, spark__driver__memory="8g", **dict(c.split("=") for c in args.conf))
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    names = [n for n in REGISTRY if not args.names or any(n == a or (a[-1] == "*" and n.startswith(a[:-1])) for a in args.names)]
    bad = 0
    for name in names:
        start = time.time()
        try:
            status, detail = compare(spark, con, REGISTRY[name], sf_dir)
        except Exception as exc:  # noqa: BLE001
            status, detail = "FAIL", f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += status == "FAIL"
        print(f"{status:5} {name:28} {time.time() - start:6.2f}s  {detail}", flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
