"""Run registered queries in Spark and their SQL oracles in DuckDB, and compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


_SPARK_TYPES = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                "BooleanType": "BOOLEAN", "ShortType": "SMALLINT", "ByteType": "TINYINT", "FloatType": "FLOAT",
                "TimestampType": "TIMESTAMP", "DateType": "DATE"}


def spark_types(schema) -> dict[str, str]:
    out = {}
    for f in schema.fields:
        t = type(f.dataType).__name__
        out[f.name] = _SPARK_TYPES.get(t, t)
    return out


def duck_types(rel) -> dict[str, str]:
    return {name: str(t) for name, t in zip(rel.columns, rel.types)}


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = _rows(spark_pdf), _rows(duck_pdf)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row: {x} vs {y}"
    return True, f"{len(a)} rows"


def run(sf_dir: str, names: list[str] | None = None, spark=None) -> dict:
    import __spark_entry__ as entry
    from strandline.session import get_session

    if spark is None:
        spark = get_session("local[8]", 8, driver_memory="16g")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            st = spark_types(sdf.schema)
            sp = sdf.toPandas()
        except Exception as e:  # noqa: BLE001
            out[name] = (False, f"spark error: {str(e)[:400]}")
            print(name, out[name], flush=True)
            continue
        t1 = time.time()
        if name not in sqls:
            out[name] = (True, f"no oracle, {len(sp)} rows")
        else:
            try:
                rel = con.sql(sqls[name])
                dt = duck_types(rel)
                dk = rel.df()
                out[name] = compare(sp, dk)
                if out[name][0] and st != dt:
                    diff = {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}
                    out[name] = (False, f"types differ: {diff}")
            except Exception as e:  # noqa: BLE001
                out[name] = (False, f"duckdb error: {str(e)[:400]}")
        print(f"{name}: {'OK ' if out[name][0] else 'BAD'} {out[name][1]}  ({t1 - t0:.1f}s)", flush=True)
    return out


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if not v[0]]
    print(f"{len(res) - len(bad)}/{len(res)} ok; bad: {bad}")
