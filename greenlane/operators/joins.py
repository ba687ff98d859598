"""Joins of a large fact with a dimension whose size is measured, not estimated.

The static size of a Parquet scan is its compressed file size, no bound on the rows
in memory. ``measured_bytes`` counts rows and string bytes in one aggregation over the
dimension's needed columns; at or below the limit the dimension is broadcast and
the fact is not shuffled at all. Beyond it the join is shuffled on (key, salt):
the fact's rows of one key, also of the NULL key, are spread over ``SALTS`` partitions
and the dimension is repeated that often, so a hot key is split whatever the session's settings.
That join carries a merge hint: Spark's estimate of the repeated dimension is the compressed size of
the file, without the copies, so it would broadcast all copies through the driver.

``table_join`` is for two tables that both grow with the facts, such as orders and sums of their lines. Spark's
estimate of a pruned scan is a share of its compressed file, so tables eight times as large in memory lie below
its broadcast threshold; the merge hint keeps their rows out of the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 << 20
SALTS = 16
#: Rows of one key that one task may join.
HOT_ROWS = 1_000_000


def broadcast_limit(spark: SparkSession) -> int:
    """``greenlane.broadcastBytes`` of the session, else ``BROADCAST_BYTES``."""
    return int(spark.conf.get("greenlane.broadcastBytes", str(BROADCAST_BYTES)))


def _fields(kind: T.StructType, at: str = "") -> list[tuple[str, T.DataType]]:
    """Path and type of each field, those inside structs included."""
    out = []
    for f in kind.fields:
        path = f"{at}`{f.name}`"
        out += [(path, f.dataType), *(_fields(f.dataType, f"{path}.") if isinstance(f.dataType, T.StructType) else [])]
    return out


def measured_bytes(dim: DataFrame) -> int:
    """Bytes of the rows of ``dim``: 16 a field (also inside structs) and row, plus the bytes of strings."""
    fields = _fields(dim.schema)
    strings = [path for path, kind in fields if isinstance(kind, (T.StringType, T.BinaryType))]
    row = dim.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.octet_length(c)).alias(f"s{i}") for i, c in enumerate(strings)]).first()
    return row["n"] * 16 * len(fields) + sum(row[f"s{i}"] or 0 for i in range(len(strings)))


def fits(dim: DataFrame) -> bool:
    return measured_bytes(dim) <= broadcast_limit(dim.sparkSession)


def table_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``key``, both of any size: shuffled and merged, nothing is broadcast."""
    return left.join(right.hint("merge"), key, how)


def salts_for(fact: DataFrame, key: str) -> int:
    """Copies of a large dimension that ``fact`` needs: one while no value of ``key``, NULL included, has over ``HOT_ROWS`` rows (counted)."""
    counts = fact.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return SALTS if (counts.agg(F.max("_n")).first()[0] or 0) > HOT_ROWS else 1


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "inner", small: bool | None = None, salts: int = SALTS) -> DataFrame:
    """``fact`` joined with ``dim`` on ``key`` (``how``: inner, left or left_semi); ``small``: what ``fits`` said, if known;
    ``salts``: what ``salts_for`` said, where a pass over the fact's keys costs less than the copies."""
    if fits(dim) if small is None else small:
        return fact.join(F.broadcast(dim), key, how)
    if salts == 1:
        return table_join(fact, dim, key, how)
    salt = F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int")
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return fact.withColumn("_salt", salt).join(copies.hint("merge"), [key, "_salt"], how).drop("_salt")
