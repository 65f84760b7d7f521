"""Deterministic pseudo-randomness shared with the DuckDB oracle.

Never ``rand()``: a seed and a row key go through md5, and the first 15 hex
digits give a 60-bit integer (ordering by it equals ordering by the md5 text
for all practical purposes; ties are broken by the row key).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    seps = []
    for i, c in enumerate(cols):
        if i:
            seps.append(F.lit(":"))
        seps.append(c.cast("string"))
    return F.concat(*seps)


def h60(key: Column) -> Column:
    """60-bit integer from md5(key)."""
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def unit(key: Column) -> Column:
    """u in [0, 1) from md5(key)."""
    return h60(key) / F.lit(float(1 << 60))


def h60_sql(key_sql: str) -> str:
    return f"('0x' || substr(md5({key_sql}), 1, 15))::BIGINT"


def unit_sql(key_sql: str) -> str:
    return f"({h60_sql(key_sql)} / {float(1 << 60)})"
