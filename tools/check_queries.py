"""Run registered queries next to their SQL in DuckDB: `python tools/check_queries.py [names] [--sf DIR]`."""

from __future__ import annotations

import argparse
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from riskspark.catalog import QUERIES, SQL  # noqa: E402
from riskspark.catalog.inputs import GIVEN  # noqa: E402
from riskspark.session import local_session  # noqa: E402

# Spark's type names by DuckDB's.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean",
         "TIMESTAMP": "timestamp_ntz"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in GIVEN:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: only spark {set(df.columns) - set(names)}, only sql {set(names) - set(df.columns)}"
    spark_types = dict(df.dtypes)
    bad = {c: (spark_types[c], types[c]) for c in names
           if spark_types[c] != TYPES.get(types[c], types[c].lower().replace(" ", ""))}
    cols = sorted(names)
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    index = [names.index(c) for c in cols]
    want = [tuple(r[i] for i in index) for r in want]
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}; types {bad}"
    try:
        a, b = _sorted(got), _sorted(want)
    except TypeError as e:
        return f"cannot sort: {e}; types {bad}"
    diff = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if diff:
        x, y = diff[0]
        return f"{len(diff)} rows differ, first: { {c: (p, q) for c, p, q in zip(cols, x, y, strict=True) if p != q} }; types {bad}"
    return f"types differ {bad}" if bad else None


def main() -> int:
    p = argparse.ArgumentParser()
    p.add_argument("names", nargs="*")
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    args = p.parse_args()
    spark, con, failed = local_session(), connect(args.sf), 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            if name in SQL:
                problem, n = compare(df, con, SQL[name]), None
            else:
                problem, n = None, df.count()
        except Exception:
            problem, n = traceback.format_exc(limit=-3)[-1500:], None
        failed += problem is not None
        size = con.execute(f"select count(*) from ({SQL[name]})").fetchone()[0] if name in SQL and not problem else n
        print(f"{'ok  ' if not problem else 'FAIL'} {name} {time.time() - start:.2f}s rows={size} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
