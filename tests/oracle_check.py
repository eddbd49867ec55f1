"""Run every registered query beside its SQL and compare schema, row count and values.

    python tests/oracle_check.py [folder] [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_points  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda row: tuple((v is not None, str(type(v)), v) for v in row))


def difference(spark_frame, sql_table) -> str | None:
    """None where both results agree, else what differs first."""
    sql_schema = {f.name: str(f.type) for f in sql_table.schema}
    ours = spark_frame.toArrow()
    schema = {f.name: str(f.type) for f in ours.schema}
    if schema != sql_schema:
        return f"schema {schema} / {sql_schema}"
    left, right = normal(ours.to_pandas()), normal(sql_table.to_pandas())
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if a != b:
            return f"{a} / {b}"
    return None


def main() -> None:
    from tokenloom.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session("oracle-check", 8)
    con = connect(folder)
    wanted = sys.argv[2:]
    sql = entry_points.oracle_sql()
    bad = 0
    for name, query in entry_points.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = query(spark, folder)
            if name not in sql:
                print(f"{name:24s} no SQL, {frame.count()} rows, {time.time() - start:.1f} s", flush=True)
                continue
            table = frame.toArrow()
            middle = time.time()
            right = con.execute(sql[name]).to_arrow_table()
            end = time.time()
            frame.toArrow = lambda table=table: table
            found = difference(frame, right)
        except Exception as error:  # noqa: BLE001
            found, middle, end = f"{type(error).__name__}: {str(error)[:700]}", time.time(), time.time()
        bad += found is not None
        print(f"{name:24s} {'ok' if found is None else found}  {middle - start:.1f} s / {end - middle:.1f} s", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
