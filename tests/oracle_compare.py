"""Run registered Spark queries and their DuckDB oracles side by side and compare
row count, column names and an order-insensitive value hash.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pagemart.sources.testdata import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v):
            return str(int(v))
        return repr(round(v, 6))
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if isinstance(v, (bool,)) or type(v).__name__ == "bool_":
        return str(bool(v))
    try:
        if pd.isna(v):
            return "NULL"
    except (TypeError, ValueError):
        pass
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and v == int(v):
        return str(int(v))
    return str(v)


def table_digest(df: pd.DataFrame) -> tuple[int, list[str], str, list[str]]:
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(rows), cols, h, rows


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as E
    qs, ora = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        spdf = sdf.toPandas()
        t1 = time.time()
        res = {"spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
        if name in ora:
            odf = con.execute(ora[name]).df()
            n1, c1, h1, r1 = table_digest(spdf)
            n2, c2, h2, r2 = table_digest(odf)
            res.update(oracle_rows=n2, cols_match=c1 == c2, hash_match=h1 == h2)
            if verbose and not (c1 == c2 and h1 == h2):
                res["cols"] = (c1, c2)
                d1, d2 = set(r1) - set(r2), set(r2) - set(r1)
                res["spark_only"] = sorted(d1)[:5]
                res["oracle_only"] = sorted(d2)[:5]
        out[name] = res
        if verbose:
            print(name, res, flush=True)
    return out


if __name__ == "__main__":
    from pagemart.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session()
    r = compare(spark, sf, names)
    bad = [k for k, v in r.items() if "hash_match" in v and not (v["hash_match"] and v["cols_match"])]
    print("MISMATCH:", bad)
