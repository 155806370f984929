"""Run a query and its SQL over the same tables and compare them without regard to order."""

import math
from pathlib import Path

import duckdb


def canon(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(canon, v)) + "]"
    if isinstance(v, dict):
        return canon(list(v.values()))
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def oracle(sf_dir, sql):
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def differences(df, sf_dir, sql):
    names, rows = oracle(sf_dir, sql)
    got = df.collect()
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    a, b = rows_of(df.columns, got), rows_of(names, rows)
    if a != b:
        sa, sb = set(a), set(b)
        return f"{len(a)} rows against {len(b)}; only ours {list(sa - sb)[:3]}; only SQL {list(sb - sa)[:3]}"
    return ""
