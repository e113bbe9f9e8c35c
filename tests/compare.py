"""Runs registered queries and their SQL counterparts and compares the results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str):
    """None if equal, else a short text about the first difference."""
    got_cols, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cur = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{dict(zip(got_cols, a))} != {dict(zip(want_cols, b))}"
    return None


def main(names: list[str], sf_dir: str = "/root/testdata/sf0.01") -> int:
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry

    from tidecall.session import build_session

    spark = build_session(
        "compare",
        "local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                what = "ok" if problem is None else f"DIFF {problem}"
            else:
                problem = None
                what = f"rows {df.count()}"
        except Exception as e:  # report and go on with the next query
            problem = e
            what = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:24s} {time.time() - start:6.2f}s  {what}", flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
