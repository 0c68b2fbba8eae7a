"""Runs a registered query on both engines and compares rows as multisets."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def difference(spark, con, sf_dir, query, sql) -> str:
    df = query(spark, sf_dir)
    mine = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if mine != theirs:
        return f"{sum(mine.values())} and {sum(theirs.values())} rows; only here {list((mine - theirs).items())[:3]}; only there {list((theirs - mine).items())[:3]}"
    return "" if mine else "no rows"
