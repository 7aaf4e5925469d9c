"""Compare a catalogue query with its DuckDB oracle (tests and local checks).

Results here are small aggregates or test-scale tables, so both sides are
brought to the driver for the comparison; this module is not used by any
query.
"""

from __future__ import annotations

import math
import os

import duckdb

from urbanlens.plans.catalog import QUERIES
from urbanlens.plans.oracle import ORACLE_SQL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def oracle_frame(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con.execute(sql).fetch_df()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        # A nullable whole-number column comes as floats on one side.
        return (1, str(int(v)) if v.is_integer() else repr(float(v)))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (1, str(v))


def _rows(pdf):
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(None if (v is not None and not isinstance(v, str) and _isnull(v)) else v)
                          for v in rec))
    return cols, sorted(rows)


def _isnull(v) -> bool:
    try:
        import pandas as pd
        return bool(pd.isna(v))
    except (TypeError, ValueError):
        return False


def compare(spark, name: str, sf_dir: str) -> dict:
    """Row count, column names and exact value multiset of both sides."""
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = oracle_frame(ORACLE_SQL[name], sf_dir)
    gcols, grows = _rows(got)
    wcols, wrows = _rows(want)
    return {
        "name": name,
        "rows": (len(grows), len(wrows)),
        "columns_match": gcols == wcols,
        "values_match": gcols == wcols and grows == wrows,
        "spark_dtypes": {c: str(t) for c, t in got.dtypes.items()},
        "oracle_dtypes": {c: str(t) for c, t in want.dtypes.items()},
        "first_diff": next(((a, b) for a, b in zip(grows, wrows) if a != b), None),
    }


def main(argv: list[str]) -> int:
    """``python -m urbanlens.plans.verify [sf_dir] [query ...]``: print one line per query."""
    from urbanlens.session import get_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = get_session(master="local[*]", shuffle_partitions=8)
    failed = 0
    for name in names:
        r = compare(spark, name, sf_dir)
        ok = r["values_match"]
        failed += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name} rows={r['rows']}" + ("" if ok else f" diff={r['first_diff']}"))
    return 1 if failed else 0


if __name__ == "__main__":
    import sys

    raise SystemExit(main(sys.argv[1:]))
