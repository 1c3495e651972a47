"""Runs queries and their SQL side by side; usable as a script: compare.py SF_DIR [name ...]."""

import datetime as dt
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(x):
    if isinstance(x, Decimal | float):
        return repr(float(x) + 0.0)
    if isinstance(x, dt.datetime):
        return str(x.date())
    return str(x)


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides hold the same rows, otherwise what differs."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want, got = _bag(names, expected.fetchall()), _bag(df.columns, df.collect())
    if want == got:
        return None
    only_got, only_want = got - want, want - got
    return (
        f"rows {got.total()} != {want.total()}" if got.total() != want.total() else "values differ"
    ) + f"; spark only {list(only_got.items())[:3]}; sql only {list(only_want.items())[:3]} of {only_want.total()}"


if __name__ == "__main__":
    from shelfline.oracle import ORACLE
    from shelfline.registry import QUERIES
    from shelfline.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        began = time.perf_counter()
        try:
            problem = differences(QUERIES[name](session, sf_dir), con, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24s} {time.perf_counter() - began:6.2f}s {problem or 'ok'}", flush=True)
