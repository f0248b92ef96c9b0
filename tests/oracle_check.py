"""Compare registered queries with their SQL: column names, row counts, values.

``python tests/oracle_check.py FOLDER [name ...]`` prints one line per query.
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        value = round(value, 6) + 0.0
        return int(value) if value.is_integer() else value
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(cell(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(table, key=repr)


def compare(spark, con, build, sql, folder):
    df = build(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns differ: {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"row counts differ: {len(mine[1])} / {len(theirs[1])}"
    different = [(a, b) for a, b in zip(mine[1], theirs[1], strict=True) if a != b]
    return f"{len(different)} of {len(mine[1])} rows differ, first: {different[0]}" if different else None


def main() -> None:
    import __spark_entry__ as contract

    from txnlens.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, texts = connect(folder), contract.oracle_sql()
    for name, build in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in texts:
                problem = compare(spark, con, build, texts[name], folder)
                print(f"{name}: {problem or 'ok'} ({time.time() - start:.1f}s)", flush=True)
            else:
                print(f"{name}: {len(build(spark, folder).collect())} rows, no SQL ({time.time() - start:.1f}s)", flush=True)
        except Exception as error:  # noqa: BLE001
            print(f"{name}: FAILED {type(error).__name__}: {str(error)[:600]} ({time.time() - start:.1f}s)", flush=True)
    missing = set(texts) - set(contract.queries())
    if missing:
        print("SQL without a query:", sorted(missing))


if __name__ == "__main__":
    main()
