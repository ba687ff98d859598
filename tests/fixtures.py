"""Hand-built operational tables for edge-case tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from pyspark.sql.types import StructField, StructType

from greenlane.sources.io import Tables, conform
from greenlane.sources.schemas import SCHEMAS, TABLES


def tables(spark, **rows) -> Tables:
    """Tables from lists of dicts; unspecified tables are empty (but typed)."""
    out = {}
    for t in TABLES:
        data = rows.get(t, [])
        names = SCHEMAS[t].fieldNames()
        loose = StructType([StructField(f.name, f.dataType, True) for f in SCHEMAS[t].fields])  # raw rows may break NOT NULL
        df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in data], loose)
        out[t] = (lambda df=df, t=t: conform(df, t))
    return Tables(out)


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


__all__ = ["tables", "d", "ts", "D"]
