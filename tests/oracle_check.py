"""Compare a query's rows with its SQL counterpart: ``python tests/oracle_check.py [sf_dir] [query ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 9)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, sf_dir, run, sql) -> str:
    """Empty when both sides agree, else what differs."""
    df = run(spark, sf_dir)
    got_names, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    result = con.execute(sql)
    want_names, want = _sorted_rows([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {str(wrong[0])[:400]}" if wrong else ""


if __name__ == "__main__":
    import __spark_entry__ as entry
    from corpusmill.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            if name in oracle:
                outcome = compare(spark, sf, queries[name], oracle[name]) or "ok"
            else:
                outcome = f"rows only: {len(queries[name](spark, sf).collect())}"
        except Exception as error:
            outcome = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:6.2f}s  {outcome}", flush=True)
