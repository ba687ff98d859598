"""Distinct customers per week that merge over weeks and markets, without expanding the orders.

An id's bit is set in the bitmap of its (week, market, bucket of 32,768 ids); the bitmaps aggregate partially, so what is shuffled
is one bitmap per group and task, and any union (all markets, four weeks) is an OR of bitmaps and a count of bits: exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import _materialize
from .core import Warehouse


def bitmaps(rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """(keys, bucket, bits): the ids of each group; ids must not be negative, NULL ids count nowhere."""
    return rows.where(F.col(id_col) >= 0).groupBy(*keys, F.bitmap_bucket_number(id_col).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias("bits"))


def distinct_of(maps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct ids per group of ``keys``: the bitmaps of each bucket merged, their bits summed."""
    merged = maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def weekly_customers(w: Warehouse, weeks: int = 4) -> DataFrame:
    """Per order week and market ('all' beside them): distinct customers of the week, and of the ``weeks`` calendar weeks up to it."""
    maps, _ = _materialize(bitmaps(w.order_facts.select("order_week", "market_type", "customer_id"), ["order_week", "market_type"], "customer_id"))
    both = maps.unionByName(maps.withColumn("market_type", F.lit("all")))
    later = F.explode(F.transform(F.sequence(F.lit(0), F.lit(weeks - 1)), lambda k: F.date_add("order_week", (7 * k).cast("int")))).alias("up_to")
    rolling = distinct_of(both.select("market_type", "bucket", "bits", later), ["up_to", "market_type"], "customers_rolling").withColumnRenamed("up_to", "order_week")
    single = distinct_of(both, ["order_week", "market_type"], "customers")
    return single.join(rolling, ["order_week", "market_type"]).select(F.col("order_week").alias("week_start"), "market_type", "customers", "customers_rolling")
