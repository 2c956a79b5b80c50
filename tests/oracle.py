"""Spark-vs-DuckDB comparison of the registered queries (the correctness gate).

Usable from pytest and standalone: ``python -m tests.oracle [sf_dir] [names...]``.
"""

from __future__ import annotations

import math
import re
import sys

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def core(names) -> list[str]:
    """The queries of this library's own job: the optional training-data
    operators (opN_..., pipeline) have their tests beside them."""
    return sorted(n for n in names if not re.match(r"op\d+_|pipeline$", n))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return v.item()
        except Exception:
            return v
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_pdf = pd.DataFrame(s_rows, columns=sdf.columns)
    d_pdf = con.execute(sql).df()
    if sorted(s_pdf.columns) != sorted(d_pdf.columns):
        return False, f"columns differ: {sorted(s_pdf.columns)} vs {sorted(d_pdf.columns)}"
    if len(s_pdf) != len(d_pdf):
        return False, f"row count {len(s_pdf)} vs {len(d_pdf)}"
    a, b = rows_of(s_pdf), rows_of(d_pdf)
    for ra, rb in zip(a, b):
        if ra != rb:
            return False, f"first differing row:\n spark {ra}\n duck  {rb}"
    return True, f"{len(a)} rows equal"


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from fleetreports.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(e.queries())
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            print(f"{n:28s} (no oracle)")
            continue
        ok, msg = compare(spark, n, qs[n], sqls[n], sf_dir, con)
        bad += not ok
        print(f"{n:28s} {'OK ' if ok else 'BAD'} {msg}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
