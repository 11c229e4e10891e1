"""Run a Spark query and its DuckDB oracle on the same tables; compare row multisets."""

from __future__ import annotations

from collections import Counter

import duckdb

from movrec.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = cur.fetchall()
    return [names[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark-only {sorted(set(sc) - set(dc))} duck-only {sorted(set(dc) - set(sc))}")
    elif sr != dr:
        only_s = sr - dr
        only_d = dr - sr
        problems.append(
            f"rows differ: spark {sum(sr.values())} duck {sum(dr.values())}; "
            f"spark-only {list(only_s.items())[:3]} duck-only {list(only_d.items())[:3]}"
        )
    return problems, sum(sr.values()), sum(dr.values())
