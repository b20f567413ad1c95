"""Row-for-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _value(x):
    if x is None:
        return "null"
    if isinstance(x, bool):
        return f"bool:{x}"
    if isinstance(x, (int, decimal.Decimal)):
        return repr(float(x)) if isinstance(x, decimal.Decimal) else repr(int(x))
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"f{x:.12g}"
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in data)


def differences(df, con, sql, limit=5):
    """Empty list when equal."""
    left_cols, left = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    right_cols, right = [d[0] for d in cur.description], cur.fetchall()
    problems = []
    if sorted(left_cols) != sorted(right_cols):
        return [f"columns {sorted(set(left_cols) ^ set(right_cols))}"]
    a, b = rows(left_cols, left), rows(right_cols, right)
    if len(a) != len(b):
        problems.append(f"row count {len(a)} vs {len(b)}")
    if a != b:
        names = sorted(left_cols)
        for x, y in zip(a, b):
            if x != y:
                problems.append(str([(n, p, q) for n, p, q in zip(names, x, y) if p != q][:6]))
                if len(problems) >= limit:
                    break
    types = {n: t for n, t in zip(df.columns, [f.dataType.simpleString() for f in df.schema])}
    duck_types = {d[0]: str(d[1]) for d in cur.description}
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    for n, t in types.items():
        if same.get(t, t) != duck_types[n]:
            problems.append(f"type of {n}: {t} vs {duck_types[n]}")
    return problems
