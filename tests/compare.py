"""Run a registered query and its SQL side by side and compare the rows."""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float)):
        return float(v)
    return str(v)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(spark, con, sf_dir, query, sql) -> str | None:
    """None if equal, else a short account of what differs."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    rel = con.sql(sql)
    theirs = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    if mine == theirs:
        return None if mine else "no rows"
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} rows, SQL {sum(theirs.values())}; "
        f"only here {list(only_mine)[:3]}, only SQL {list(only_theirs)[:3]}"
    )


def types_differ(df, rel) -> list[str]:
    """Columns whose kinds (whole, real, text, ...) differ between the engines."""
    kinds = {
        "bigint": "int", "int": "int", "double": "real", "string": "text",
        "boolean": "bool", "date": "date", "timestamp": "time", "timestamp_ntz": "time",
        "BIGINT": "int", "INTEGER": "int", "HUGEINT": "huge", "DOUBLE": "real",
        "VARCHAR": "text", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "time",
    }
    theirs = dict(zip(rel.columns, map(str, rel.types), strict=True))
    return [
        f"{c}: {t} / {theirs[c]}"
        for c, t in df.dtypes
        if kinds.get(t, t) != kinds.get(theirs.get(c), theirs.get(c))
    ]


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from courtflow.plans.queries import registry
    from courtflow.session import local_session

    sf, names = sys.argv[1], sys.argv[2:]
    spark, con = local_session("8"), connect(sf)
    spark.sparkContext.setLogLevel("ERROR")
    for name, (query, sql) in registry().items():
        if names and not any(n in name for n in names):
            continue
        begin = time.time()
        try:
            if sql is None:
                result = f"{query(spark, sf).count()} rows, no SQL"
            else:
                result = difference(spark, con, sf, query, sql) or "equal"
                result += " " + str(types_differ(query(spark, sf), con.sql(sql)) or "")
        except Exception as e:  # noqa: BLE001
            result = f"ERROR {type(e).__name__} {str(e)[:600]}"
        print(f"{name:28} {time.time() - begin:6.2f}s {result}", flush=True)
