"""Run a registered query in Spark and its SQL twin in DuckDB and compare them."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(x):
    if x is None:
        return ("", 0)
    if isinstance(x, float):
        return ("", 0) if math.isnan(x) else ("n", round(x, 6) + 0.0)
    if isinstance(x, bool):
        return ("b", x)
    if isinstance(x, int):
        return ("n", float(x))
    return ("t", str(x))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark, con, name, run, sql, folder, limit=5):
    """Empty list when both sides agree on columns, types and values."""
    df = run(spark, folder)
    ours = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    theirs_columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    problems = []
    if sorted(df.columns) != sorted(theirs_columns):
        return [f"columns {sorted(df.columns)} vs {sorted(theirs_columns)}"]
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} vs {len(theirs)}")
    a, b = _rows(df.columns, ours), _rows(theirs_columns, theirs)
    if a != b:
        seen_a, seen_b = set(a), set(b)
        problems.append(f"only spark {list(seen_a - seen_b)[:limit]}")
        problems.append(f"only sql {list(seen_b - seen_a)[:limit]}")
        problems.append(f"differing {len(seen_a - seen_b)} / {len(seen_b - seen_a)} columns {sorted(df.columns)}")
    return problems
