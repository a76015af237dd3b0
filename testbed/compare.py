"""Compare registered queries with their oracles: ``python -m testbed.compare <sf_dir> [query ...]``."""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from supplyscope.session import local_session

from . import bindings, oracles
from .views import BASE_TABLES


def _plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat(" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], Counter]:
    con = duckdb.connect()
    for base in BASE_TABLES:
        con.execute(f"CREATE VIEW {base} AS SELECT * FROM '{sf_dir}/{base}.parquet'")
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def difference(df: DataFrame, sf_dir: str, name: str) -> str | None:
    """None if the query's result and its oracle agree, else what differs."""
    columns, expected = oracle_rows(sf_dir, oracles.oracle_sql()[name])
    got_columns, got = rows_of(df.columns, df.collect())
    if columns != got_columns:
        return f"columns {got_columns} instead of {columns}"
    if expected != got:
        extra, lacking = got - expected, expected - got
        return (
            f"{sum(got.values())} rows instead of {sum(expected.values())}; "
            f"extra {list(extra)[:2]}, lacking {list(lacking)[:2]}"
        )
    return None


def main() -> None:
    sf_dir, *only = sys.argv[1:]
    spark = local_session()
    wrong = 0
    for name, query in bindings.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        problem = difference(query(spark, sf_dir), sf_dir, name)
        wrong += problem is not None
        print(f"{name:32s} {time.time() - start:6.1f}s  {problem or 'same'}", flush=True)
    print(f"{wrong} different")


if __name__ == "__main__":
    main()
