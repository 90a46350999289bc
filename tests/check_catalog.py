"""Compare registered queries with their SQL: ``python tests/check_catalog.py [sf_dir] [name...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            files = path / "*.parquet" if path.is_dir() else path
            con.sql(f"create view {table} as select * from '{files}'")
    return con


def rows(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted((tuple(_plain(v) for v in row) for row in frame.itertuples(index=False)),
                  key=repr)


def _plain(value):
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return int(value) if value == int(value) else round(value, 9)
    if hasattr(value, "item"):
        return _plain(value.item())
    return value


def compare(spark: SparkSession, con, sf_dir: str, build, sql: str | None):
    """(number of rows, None or what differs)"""
    frame = build(spark, sf_dir)
    got = rows(frame.toPandas())
    if sql is None:
        return len(got), None
    expected_frame = con.sql(sql).df()
    if sorted(frame.columns) != sorted(expected_frame.columns):
        return len(got), f"columns {frame.columns} / {list(expected_frame.columns)}"
    expected = rows(expected_frame)
    if got == expected:
        return len(got), None
    return len(got), (f"{len(got)} / {len(expected)} rows; only here "
                      f"{[r for r in got if r not in set(expected)][:2]}; only there "
                      f"{[r for r in expected if r not in set(got)][:2]}")


def main() -> int:
    import __spark_entry__ as entry
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            n, problem = compare(spark, con, sf_dir, build, oracle.get(name))
        except Exception as error:  # report and go on with the next query
            n, problem = -1, f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        mark = "ok " if problem is None and name in oracle else "run" if problem is None else "BAD"
        print(f"{mark} {name} rows={n} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(queries)} registered, {bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(1 if main() else 0)
