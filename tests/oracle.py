"""Runs a query next to its SQL in DuckDB and lists what differs."""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# Type names of DuckDB and the Spark type each has to come with.
KINDS = {
    "BIGINT": {"bigint"},
    "INTEGER": {"int"},
    "DOUBLE": {"double"},
    "VARCHAR": {"string"},
    "BOOLEAN": {"boolean"},
    "TIMESTAMP": {"timestamp_ntz"},
    "DATE": {"date"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value) if isinstance(value, float) else str(value)


def compare(spark, name: str, query, sql: str, folder: str) -> list[str]:
    """Differences in columns, types, row count and exact values; empty if there is none."""
    con = connect(folder)
    relation = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in relation.description}
    theirs = relation.fetchall()
    columns = sorted(kinds)
    df = query(spark, folder)
    found = []
    if sorted(df.columns) != columns:
        return [f"columns {sorted(df.columns)} against {columns}"]
    types = dict(df.dtypes)
    for column in columns:
        if types[column] not in KINDS.get(kinds[column], {kinds[column].lower()}):
            found.append(f"type of {column}: {types[column]} against {kinds[column]}")
    order = [list(kinds).index(c) for c in columns]
    want = sorted(tuple(_plain(row[i]) for i in order) for row in theirs)
    have = sorted(tuple(_plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    if len(want) != len(have):
        found.append(f"{len(have)} rows against {len(want)}")
    if want != have:
        only_have, only_want = sorted(set(have) - set(want)), sorted(set(want) - set(have))
        found.append(f"{len(only_have)} rows differ, e.g. {only_have[:2]} against {only_want[:2]}")
    return found


def main(names: list[str], folder: str) -> None:
    import __spark_entry__ as contract
    from ridelake.session import local_session

    spark = local_session("8")
    queries, oracles = contract.queries(), contract.oracle_sql()
    bad = 0
    for name in names or list(queries):
        started = time.time()
        try:
            if name in oracles:
                found = compare(spark, name, queries[name], oracles[name], folder)
            else:
                found = [] if queries[name](spark, folder).count() else ["no rows"]
        except Exception as error:  # noqa: BLE001 - reported and counted
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - started:.1f}s {'; '.join(found)}", flush=True)
    print(f"{bad} of {len(names or queries)} differ")


if __name__ == "__main__":
    main(sys.argv[2:], sys.argv[1])
