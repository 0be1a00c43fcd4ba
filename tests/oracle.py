"""Comparison of a query's rows with those of its SQL, whatever their order."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
from collections import Counter


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    return str(v) if isinstance(v, datetime.datetime) else v


def rows_of_sql(sql: str, folder: str, columns: list[str]) -> Counter:
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    found = con.execute(f"SELECT {', '.join(columns)} FROM ({sql})")
    return Counter(tuple(map(plain, r)) for r in found.fetchall())


def rows_of_query(df, columns: list[str]) -> Counter:
    return Counter(tuple(map(plain, r)) for r in df.select(*columns).collect())
