"""Compare every named query with its SQL on one folder of tables.

    python -m tests.sql_compare [folder] [query ...]
"""

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

from __spark_entry__ import oracle_sql, queries
from starmart.session import local_session


def norm(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def connect(folder: str):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def difference(con, sql: str, df) -> str | None:
    """None if equal, otherwise what differs first."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    want, have = rows_of(result.fetchall(), names), rows_of(df.collect(), df.columns)
    if len(have) != len(want):
        return f"rows {len(have)} / {len(want)}"
    return next((f"{a}\n{b}" for a, b in zip(have, want) if a != b), None)


def main(folder: str, wanted: list[str]) -> int:
    con, spark, bad = connect(folder), local_session("compare"), 0
    for name, run in queries().items():
        if name not in oracle_sql() or (wanted and name not in wanted):
            continue
        start = time.time()
        try:
            found = difference(con, oracle_sql()[name], run(spark, folder))
        except Exception as error:  # report it and go on with the next query
            found = str(error)[:1500]
        bad += found is not None
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s", flush=True)
        if found:
            print(found, flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]) > 0)
