"""Run registered queries against their SQL and report differences."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


def sql_frame(sql: str, folder: str) -> pd.DataFrame:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    cursor = connection.execute(sql)
    return pd.DataFrame(cursor.fetchall(), columns=[c[0] for c in cursor.description], dtype=object)


def normal(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples, columns by name, cells exact and typed."""
    columns = sorted(frame.columns)
    rows = (tuple(map(_cell, row)) for row in frame[columns].itertuples(index=False, name=None))
    return sorted(rows, key=repr)


def _cell(value):
    if value is None or value is pd.NaT:
        return ("null",)
    return (type(value).__name__, value)


def spark_frame(df) -> pd.DataFrame:
    return pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    a, b = normal(ours), normal(theirs)
    if len(a) != len(b):
        return f"row counts {len(a)} / {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""


def main(folder: str, names: list[str]) -> int:
    import __spark_entry__ as entry
    from tripflow.session import build_session

    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = build_session("compare", "local[8]", settings)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracle = entry.queries(), entry.oracle_sql()
    failures = 0
    for name in names or queries:
        start = time.time()
        try:
            ours = spark_frame(queries[name](spark, folder))
            seconds = time.time() - start
            if name in oracle:
                problem = difference(ours, sql_frame(oracle[name], folder))
            else:
                problem = "" if len(ours) else "no rows"
        except Exception as error:
            problem, seconds, ours = repr(error)[:900], time.time() - start, []
        failures += bool(problem)
        kind = "sql " if name in oracle else "rows"
        state = "FAIL" if problem else "ok  "
        print(f"{state} {kind} {name} {len(ours)} rows {seconds:.1f}s {problem}", flush=True)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
