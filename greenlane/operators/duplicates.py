"""Orders entered twice: same customer, same date, the same lines in any order.

Lines are counted per order and kind (all columns that make two lines equal). Two hashes of each kind and its count, summed, and
the numbers of kinds and lines are a fingerprint that does not depend on the order of the lines; the sums aggregate
partially and nothing is sorted. Orders of one (customer, date, fingerprint) are candidates, and each is compared kind by kind
with the smallest order id of its group, so no order's lines are collected into one task. Whatever differs there (the
fingerprints collided) is grouped once more without the orders that were confirmed, until no group is left.

Joins with the groups and with the kinds of the smallest order go through ``lookup_join``: broadcast while measured small, else
salted, so an order entered again and again does not pile up in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .joins import lookup_join

LINE = ("product_id", "requested_quantity", "unit_price")
_GROUP = ("customer_id", "order_date", "kinds", "lines", "sum1", "sum2")


def line_hash(seed: int) -> Column:
    """A hash of one kind of line and its count."""
    return F.xxhash64(F.lit(seed), F.col("line"), F.col("copies"))


def duplicate_orders(orders: DataFrame, lines: DataFrame, line_columns: tuple[str, ...] = LINE) -> DataFrame:
    """order_id, duplicate_of (the smallest equal order), customer_id, order_date, line_count of every order entered again.

    Orders without a customer, a date or lines are not compared; NULLs in lines are equal to each other.
    """
    ensure_checkpoint_dir(orders.sparkSession)
    kinds = lines.where(F.col("order_id").isNotNull()).groupBy(
        "order_id", F.to_json(F.struct(*line_columns), {"ignoreNullFields": "false"}).alias("line")).agg(F.count(F.lit(1)).alias("copies"))
    total = lambda seed: F.sum(line_hash(seed).cast("decimal(20,0)")).alias(f"sum{seed}")
    prints = kinds.groupBy("order_id").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("lines"), total(1), total(2))
    heads = orders.where("customer_id IS NOT NULL AND order_date IS NOT NULL").select("order_id", "customer_id", "order_date").distinct()
    todo = heads.join(prints, "order_id").withColumn("group", F.struct(*_GROUP)).checkpoint()
    found = []
    while True:
        groups = todo.groupBy("group").agg(F.min("order_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        members = lookup_join(todo, groups, "group").checkpoint()
        if members.isEmpty():
            break
        of_members = kinds.join(members.select("order_id", "first", "group").distinct(), "order_id").withColumn("kind", F.struct("first", "line", "copies"))
        of_first = kinds.join(members.select(F.col("first").alias("order_id")).distinct(), "order_id").select(F.struct(F.col("order_id").alias("first"), "line", "copies").alias("kind"))
        equal = lookup_join(of_members, of_first, "kind").groupBy("order_id", "first", "group").agg(F.count(F.lit(1)).alias("same")).where(
            F.col("same") == F.col("group.kinds")).select("order_id", "first", "group").checkpoint()
        found.append(equal)
        todo = members.drop("first").join(equal.select("order_id", "group"), ["order_id", "group"], "left_anti").checkpoint()
    if not found:
        found = [todo.select("order_id", F.col("order_id").alias("first"), "group").limit(0)]
    return reduce(DataFrame.unionByName, found).where("order_id <> first").select(
        "order_id", F.col("first").alias("duplicate_of"), "group.customer_id", "group.order_date", F.col("group.lines").alias("line_count"))
