"""Run a registered query and its SQL and compare the results as row multisets."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

KIND = {bool: "bool", int: "int", str: "str", float: "float", date: "date", datetime: "datetime"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}") + 0.0
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def _types(columns, types) -> dict[str, str]:
    return dict(zip(columns, types))


SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(df, sql: str, con) -> list[str]:
    """Differences between a Spark result and a SQL result; empty if they are the same."""
    relation = con.sql(sql)
    problems = []
    mine = {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    if mine != theirs:
        odd = {c: (mine.get(c), theirs.get(c)) for c in mine.keys() | theirs.keys() if mine.get(c) != theirs.get(c)}
        problems.append(f"schema (spark, sql): {odd}")
    if mine.keys() != theirs.keys():
        return problems
    a, b = _rows(df.columns, df.collect()), _rows(relation.columns, relation.fetchall())
    if a != b:
        problems.append(f"rows: spark {a.total()}, sql {b.total()}; only spark {list((a - b).items())[:2]}; only sql {list((b - a).items())[:2]}")
    elif not a:
        problems.append("both results are empty")
    return problems


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from gridcast.session import local_session

    spark, con = local_session(8), duck(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            problems = compare(df, oracles[name], con) if name in oracles else [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        note = "ok" if name in oracles else "ok (rows only)"
        print(f"{name:28s} {time.time() - start:6.2f}s {note if not problems else problems}", flush=True)
    print(f"{bad} of {len(names or queries)} differ; oracles without query: {set(oracles) - set(queries)}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
