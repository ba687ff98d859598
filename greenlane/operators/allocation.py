"""Stock allocation (X3): first come, first served.

The stock of a product on a day (the total over warehouses of that day's snapshots) is
handed to the product's order lines of that day in order of (received time, order id, line id):
allocated = clamp(stock - demand of all earlier lines of the day, 0, requested). Orders
whose time of receipt is not known come last.
A product without a snapshot on the day has no stock to give.

The running demand is an ordered scan *within* a (product, day). A product that carries
a third of all lines would be a few tasks with a plain ``Window.partitionBy``; the
scan in ``operators.ranking`` counts the lines of each (product, day), range-partitions those of the
hot ones on (product, day, order key) and stitches the partitions together with per-partition
prefix sums; lines of all others are not copied. The stock joins as a measured dimension or
salted, so the hot product stays split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import lookup_join, table_join
from .ranking import DEFAULT, RankConfig, ordered_scan

GROUP = ("product_id", "order_date")
ORDER_KEY = ("order_id", "order_item_id", "requested_quantity")


def with_received_time(lines: DataFrame, orders: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """Lines with ``received_at`` of their order's raw order (the earliest where a raw order repeats); NULL without one."""
    received = raw_orders.where("raw_order_id IS NOT NULL").groupBy("raw_order_id").agg(F.min("received_at").alias("received_at"))
    per_order = table_join(orders.where("raw_order_id IS NOT NULL"), received, "raw_order_id").groupBy("order_id").agg(F.min("received_at").alias("received_at"))
    return table_join(lines, per_order, "order_id", "left")


def daily_stock(inventory: DataFrame) -> DataFrame:
    """(product_id, order_date) -> stock, summed over that day's snapshots."""
    return inventory.groupBy("product_id", F.col("inventory_date").alias("order_date")).agg(F.sum("available_quantity").alias("stock"))


def allocate_stock(lines: DataFrame, inventory: DataFrame, strategy: str = "auto",
                   cfg: RankConfig = DEFAULT, keys: DataFrame | None = None, coarse: DataFrame | None = None) -> DataFrame:
    """lines: order_item_id, order_id, product_id, order_date, requested_quantity, received_at.

    ``keys``: a frame with ``GROUP`` of the same lines to count from, such as the lines before ``received_at`` was joined;
    ``coarse``: one with ``product_id`` of at least these lines, such as the raw lines.
    """
    base = lines.select(*GROUP, "received_at", *ORDER_KEY)
    scanned = ordered_scan(base, None, list(GROUP), [F.col("received_at").asc_nulls_last(), *[F.col(c).asc() for c in ORDER_KEY]],
                           {"_demand_through": "requested_quantity"}, cfg, force_distributed=strategy == "distributed", keys=keys, coarse=coarse)
    stock = daily_stock(inventory).select(F.struct(*GROUP).alias("_slot"), "stock")
    scanned = lookup_join(scanned.withColumn("_slot", F.struct(*GROUP)), stock, "_slot", "left")
    s = F.coalesce(F.col("stock"), F.lit(0).cast("decimal(10,2)"))
    prior = F.col("_demand_through") - F.col("requested_quantity")
    left = F.greatest(s - prior, F.lit(0).cast("decimal(10,2)"))
    allocated = F.least(left, F.col("requested_quantity")).cast("decimal(38,2)")
    status = (F.when(allocated == F.col("requested_quantity"), F.lit("full"))
              .when(allocated > 0, F.lit("partial")).otherwise(F.lit("short")))
    return scanned.select(
        *ORDER_KEY, *GROUP, "received_at", s.alias("stock"), allocated.alias("allocated_quantity"), status.alias("allocation_status"))
