"""Run every registered query against its oracle SQL: `python -m checks.compare [sf_dir] [name...]`."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame

from checks.oracle import ORACLES
from checks.queries import QUERIES
from fabpulse.session import build_session


def oracle_frame(sf_dir: str, statement: str) -> pd.DataFrame:
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf_dir}/events.parquet')")
    return con.execute(statement).df()


def rows_of(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    """Rows as sorted tuples of text, columns in order of their names."""
    def text(value: object) -> str:
        if pd.isna(value):
            return "NULL"
        if isinstance(value, float):
            # Integer columns with NULLs come as floats.
            return str(int(value)) if value.is_integer() else repr(round(value, 6))
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        return str(value)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(map(text, row)) for row in ordered.itertuples(index=False, name=None))


def differences(df: DataFrame, expected: pd.DataFrame) -> str | None:
    """What differs between a result and its oracle, None when nothing does."""
    actual = df.toPandas()
    if sorted(actual.columns) != sorted(expected.columns):
        return f"columns {sorted(actual.columns)} != {sorted(expected.columns)}"
    left, right = rows_of(actual), rows_of(expected)
    if left == right:
        return None
    only_left = sorted(set(left) - set(right))[:3]
    only_right = sorted(set(right) - set(left))[:3]
    return f"{len(left)} rows vs {len(right)}; only ours {only_left}; only oracle {only_right}"


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or ORACLES:
        start = time.time()
        problem = differences(QUERIES[name](spark, sf_dir), oracle_frame(sf_dir, ORACLES[name]))
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name}"
              + (f": {problem}" if problem else ""), flush=True)
    return failed


if __name__ == "__main__":
    folder, *wanted = sys.argv[1:] or ["/root/testdata/sf0.01"]
    sys.exit(main(folder, wanted))
