"""Run registered queries and their SQL twins and compare the results."""

from __future__ import annotations

import datetime
import math
import sys

try:
    import duckdb
except ImportError:  # the container keeps it apart from site-packages
    sys.path.append("/opt/oracle")
    import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(rows, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    return _rows([c[0] for c in cursor.description], cursor.fetchall())


def difference(mine, theirs) -> str:
    """Empty when equal, else a short account."""
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    if mine[1] == theirs[1]:
        return ""
    a, b = set(map(repr, mine[1])), set(map(repr, theirs[1]))
    return (
        f"rows {len(mine[1])} vs {len(theirs[1])}; only spark {sorted(a - b)[:3]}; "
        f"only sql {sorted(b - a)[:3]}"
    )


def main(argv):
    import time

    from pressmill.plans.catalog import ORACLES, QUERIES
    from pressmill.session import local_session

    folder = argv[0]
    names = argv[1:] or list(QUERIES)
    spark = local_session()
    con = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            mine = spark_rows(QUERIES[name](spark, folder))
            took = time.time() - start
            note = difference(mine, sql_rows(con, ORACLES[name])) if name in ORACLES else "no sql"
        except Exception as error:
            took, mine, note = time.time() - start, ([], []), f"ERROR {str(error)[:700]}"
        bad += note not in ("", "no sql")
        print(f"{name:26s} {took:6.2f}s rows={len(mine[1]):6d} {note or 'ok'}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
