"""Compare every query with its SQL counterpart: python tests/compare.py SF_DIR [names]."""

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6g}"
    return "" if value is None else f"{type(value).__name__}:{value}"


def table_rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def connect(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def differences(spark, connection, sf_dir, name, run, sql):
    df = run(spark, sf_dir)
    ours = table_rows(df.columns, df.collect())
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = table_rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}", len(ours)
    if ours != theirs:
        extra = sorted(set(ours) - set(theirs))[:2]
        lacking = sorted(set(theirs) - set(ours))[:2]
        return f"{len(ours)} and {len(theirs)} rows; ours {extra}; theirs {lacking}", len(ours)
    return None, len(ours)


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from shelftrace.session import build_session

    sf_dir, *chosen = sys.argv[1:]
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            wrong, size = differences(spark, connection, sf_dir, name, run, oracle_sql()[name])
        except Exception as error:
            wrong, size = f"{type(error).__name__}: {str(error)[:1500]}", 0
        print(f"{'FAIL' if wrong else 'ok':5}{name:22}{size:8} rows {time.time() - start:6.1f}s {wrong or ''}", flush=True)
    spark.stop()
