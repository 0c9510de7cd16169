"""Run queries beside their SQL and compare names, types, row counts and values.

    python tests/check_queries.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(df):
    """Columns by name, rows by value; integers of any width count as equal."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind in "iu":
            df[c] = df[c].astype("int64")
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(got, want) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    kinds = [(c, got[c].dtype, want[c].dtype) for c in got.columns
             if got[c].dtype != want[c].dtype]
    if kinds:
        return f"types {kinds}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)} rows"
    a, b = normal(got), normal(want)
    unequal = ~((a == b) | (a.isna() & b.isna())).all(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows differ: {a[unequal].head(2).to_dict('records')} != {b[unequal].head(2).to_dict('records')}"
    return None


def main(argv: list[str]) -> int:
    from tonemill.queries import ORACLES, QUERIES
    from tonemill.session import local_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con, bad = local_session("check", 8), duck(sf), 0
    for name in names:
        try:
            t0 = time.time()
            got = QUERIES[name](spark, sf).toPandas()
            t1 = time.time()
            result = "rows only" if name not in ORACLES else (
                difference(got, con.execute(ORACLES[name]).df()) or "ok")
        except Exception as e:  # noqa: BLE001
            result, t1, got = f"ERROR {str(e)[:600]}", time.time(), []
        bad += result not in ("ok", "rows only")
        print(f"{name:24} {len(got):8} rows  spark {t1 - t0:6.2f}s  sql {time.time() - t1:6.2f}s  {result}", flush=True)
    print(f"{bad} of {len(names)} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
