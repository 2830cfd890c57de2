"""Compare queries with their oracles: ``python tests/check_oracles.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402
from matchwright.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else value


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None if the query and its oracle agree, else what differs."""
    df = entry_module.queries()[name](spark, sf_dir)
    got = multiset(df.columns, df.collect())
    cur = con.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = multiset(columns, cur.fetchall())
    if got != want:
        more, less = got - want, want - got
        return (
            f"{got.total()} rows, oracle {want.total()};"
            f" only here {str(list(more.items())[:2])[:300]}, only oracle {str(list(less.items())[:2])[:300]}"
        )
    return None


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    names = sys.argv[2:] or list(entry_module.queries())
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
