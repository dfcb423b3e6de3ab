"""Run registered queries beside their SQL and compare the rows as multisets."""

from __future__ import annotations

import collections
import decimal
import glob
import os
import sys
import time

import duckdb

import __spark_entry__ as contract


def connect(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{f}')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return collections.Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, sf_dir):
    """Empty text if both sides agree, else what differs."""
    frame = contract.queries()[name](spark, sf_dir)
    got = rows_of(frame.columns, frame.collect())
    cursor = con.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if got != want:
        here, there = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"rows {sum(got.values())} vs {sum(want.values())}; only here {here}; only there {there}"
    return "" if got else "no rows"


if __name__ == "__main__":
    from tablesync.session import local_session

    sf = sys.argv[1]
    chosen = sys.argv[2:] or list(contract.oracle_sql())
    session = local_session(8)
    con = connect(sf)
    failed = []
    for q in chosen:
        start = time.time()
        try:
            result = compare(session, con, q, sf)
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok  ' if not result else 'FAIL'} {q} {time.time() - start:.2f}s {result}", flush=True)
        failed += [q] if result else []
    print("failed:", failed)
