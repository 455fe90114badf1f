"""Run queries against their SQL and report differences.

    python -m verification.check /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from linkloom.session import build_session

from .oracle import ORACLE
from .queries import QUERIES


def _cell(value):
    if isinstance(value, float) and not math.isnan(value):
        return float(repr(value))
    return value


def spark_rows(spark: SparkSession, name: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    return columns, [tuple(_cell(r[c]) for c in columns) for r in df.collect()]


def oracle_rows(name: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(_cell(r[i]) for i in order) for r in result.fetchall()]
    return sorted(names), rows


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def compare(spark: SparkSession, name: str, sf_dir: str) -> str | None:
    """NULL when the query and its SQL agree, else what differs."""
    columns, got = spark_rows(spark, name, sf_dir)
    expected_columns, expected = oracle_rows(name, sf_dir)
    if columns != expected_columns:
        return f"columns {columns} instead of {expected_columns}"
    got, expected = _sorted(got), _sorted(expected)
    if got == expected:
        return None
    wrong = [(a, b) for a, b in zip(got, expected) if a != b][:2]
    return f"{len(got)} rows, expected {len(expected)}; first differences {wrong}"


def main() -> None:
    sf_dir, *names = sys.argv[1:]
    spark = build_session(
        "check", "local[8]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or QUERIES:
        started = time.time()
        try:
            problem = compare(spark, name, sf_dir) if name in ORACLE else (
                f"no SQL; {len(spark_rows(spark, name, sf_dir)[1])} rows"
            )
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None and name in ORACLE
        print(f"{name:28s} {time.time() - started:6.1f}s {problem or 'ok'}"[:900], flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
