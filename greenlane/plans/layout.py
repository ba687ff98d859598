"""File layouts for joins and look-ups: bucketed core tables, and tables sorted by a key with Bloom filters.

``write_bucketed`` writes the orders, lines and deliveries hashed and sorted by order id into equally many buckets, so every join and
aggregation on the order id reads bucket by bucket and moves nothing. ``write_lookup`` range-partitions and sorts by the key and
writes Bloom filters for the key columns, so a read for given keys skips the files and row groups that cannot hold them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .core import Warehouse

#: Keys that a look-up passes down as a list; more keys are joined.
LISTED_KEYS = 1000


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as table ``name`` at ``path``: one task and file per bucket, sorted by ``key``.

    A bucket holds all rows of its keys, so this is for keys whose rows fit a task, as the lines of an order do.
    """
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """The table written before, in a session whose catalog does not know it."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def write_bucketed_core(w: Warehouse, root: str, prefix: str, buckets: int) -> dict[str, DataFrame]:
    """Orders, lines and deliveries by order id."""
    return {model: write_bucketed(getattr(w, model), f"{prefix}_{model}", f"{root.rstrip('/')}/{model}", "order_id", buckets)
            for model in ("stg_orders", "stg_order_items", "stg_deliveries")}


def order_fulfilment(tables: dict[str, DataFrame]) -> DataFrame:
    """Per order: its lines' sums and its deliveries (J1, J6), from orders that have lines."""
    lines = tables["stg_order_items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("requested_quantity").alias("requested_quantity"),
        F.sum(F.coalesce("confirmed_quantity", F.lit(0).cast("decimal(10,2)"))).alias("confirmed_quantity"))
    sent = tables["stg_deliveries"].groupBy("order_id").agg(F.count(F.lit(1)).alias("deliveries"), F.max("delivered_at").alias("last_delivered_at"))
    return tables["stg_orders"].select("order_id", "order_status", "order_date").join(lines, "order_id").join(sent, "order_id", "left").select(
        "order_id", "order_status", "order_date", "line_count", "requested_quantity", "confirmed_quantity",
        F.coalesce("deliveries", F.lit(0).cast("long")).alias("deliveries"), "last_delivered_at")


def orders_without_delivery(tables: dict[str, DataFrame]) -> DataFrame:
    """J7 on the buckets: orders with lines and no delivery."""
    return tables["stg_orders"].join(tables["stg_order_items"], "order_id", "left_semi").join(tables["stg_deliveries"], "order_id", "left_anti").select("order_id", "order_status")


def write_lookup(df: DataFrame, path: str, key: str, also: tuple[str, ...] = (), row_group_bytes: int = 8 << 20, distinct: int = 1 << 20) -> None:
    """Write ``df`` for reads by ``key`` (and by the columns of ``also``): sorted in ranges, small row groups, Bloom filters.

    A hot key may span files: the ranges go on with the other columns.
    """
    order = [key, *also]
    writer = df.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.size", row_group_bytes)
    for column in order:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(path)


def read_keys(spark: SparkSession, path: str, key: str, keys: DataFrame) -> DataFrame:
    """The rows of the given keys: as a pushed-down list up to ``LISTED_KEYS``, beyond it by a join."""
    table = spark.read.parquet(path)
    listed = [r[0] for r in keys.select(key).where(F.col(key).isNotNull()).distinct().limit(LISTED_KEYS + 1).collect()]
    if len(listed) > LISTED_KEYS:
        return table.join(keys.select(key).distinct(), key, "left_semi")
    return table.where(F.col(key).isin(listed))
