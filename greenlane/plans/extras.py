"""Operational analyses described for the business (X5-X8), over the core facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import safe_pct, week_start
from ..operators.duplicates import duplicate_orders
from ..operators.intervals import open_intervals, runs_of_days
from .core import Warehouse


def prep_list(w: Warehouse) -> DataFrame:
    """One prep task per confirmed line (confirmed > 0), to prepare on the order date."""
    return w.fct_order_items.where(F.col("confirmed_quantity") > 0).select(
        "order_item_id", "order_id", "product_id", "product_name",
        F.col("confirmed_quantity").alias("quantity_to_prepare"),
        F.lit("pending").alias("prep_status"), F.col("order_date").alias("prep_date"))


def labor_by_worker_week(w: Warehouse) -> DataFrame:
    """Hours, shifts and labour cost per worker, week and task."""
    return w.fct_worker_shifts.groupBy(
        "worker_id", "worker_name", week_start("shift_date").alias("week_start"), "task_type"
    ).agg(
        F.count(F.lit(1)).alias("shifts"),
        F.sum("hours_worked").alias("hours"),
        F.sum("labor_cost").alias("labor_cost"),
    )


def labor_by_order(w: Warehouse) -> DataFrame:
    """Labour spent per related order."""
    return w.fct_worker_shifts.where(F.col("related_order_id").isNotNull()).groupBy("related_order_id").agg(
        F.count_distinct("worker_id").alias("workers"), F.sum("hours_worked").alias("hours"),
        F.sum("labor_cost").alias("labor_cost"))


def stockout_frequency(w: Warehouse) -> DataFrame:
    """How often a product's lines were not fully confirmed."""
    short = F.col("confirmed_quantity") < F.col("requested_quantity")
    return w.fct_order_items.groupBy("product_id", "product_name").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(short).alias("short_lines"),
        F.count_if(F.col("confirmed_quantity") == 0).alias("zero_lines"),
    ).withColumn("stockout_rate_pct", safe_pct("short_lines", "lines", 1))


def delivery_bottlenecks(w: Warehouse) -> DataFrame:
    """Delivery volume and reliability by weekday and scheduled hour."""
    d = w.fct_deliveries
    return d.groupBy(
        F.dayofweek("scheduled_date").alias("weekday"), F.hour("scheduled_at").alias("hour")
    ).agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.sum("is_on_time").alias("on_time"),
        F.count_if(F.col("delivery_status").isin("failed", "cancelled")).alias("failed_or_cancelled"),
    ).withColumn("on_time_pct", safe_pct("on_time", "deliveries", 1))


def orders_missing_items(w: Warehouse) -> DataFrame:
    """Cleaned orders with no line at all."""
    return w.fct_orders.where(F.col("line_count") == 0).select(
        "order_id", "customer_id", "order_date", "cleaning_status", "header_total_items")


def overdue_deliveries(w: Warehouse, strategy: str = "auto") -> DataFrame:
    """Per driver, how many late deliveries there were, and the most that were overdue (due, not yet there) at once, first when."""
    late = w.fct_deliveries.where("driver_worker_id IS NOT NULL AND scheduled_at < delivered_at")
    spans = late.select("driver_worker_id", F.col("scheduled_at").alias("begins_at"), F.col("delivered_at").alias("ends_at"))
    peak = open_intervals(spans, "driver_worker_id", strategy).groupBy("driver_worker_id").agg(F.min(F.struct((-F.col("open")).alias("open"), "at")).alias("p"))
    counts = late.groupBy("driver_worker_id", "driver_name").agg(F.count(F.lit(1)).alias("late_deliveries"))
    return counts.join(peak, "driver_worker_id").select(
        "driver_worker_id", "driver_name", "late_deliveries", (-F.col("p.open")).alias("peak_overdue"), F.col("p.at").alias("peak_at"))


def stockout_runs(w: Warehouse, strategy: str = "auto") -> DataFrame:
    """Runs of a product's ordered days on which less was confirmed than requested: first and last day, days, shortage."""
    days = w.fct_order_items.groupBy("product_id", "product_name", "order_date").agg(
        F.sum("requested_quantity").alias("requested"), F.sum("confirmed_quantity").alias("confirmed"))
    days = days.withColumn("short", F.col("confirmed") < F.col("requested"))
    return runs_of_days(days, "product_id", "order_date", "short", strategy).groupBy("product_id", "product_name", "run").agg(
        F.min("order_date").alias("run_start"), F.max("order_date").alias("run_end"), F.count(F.lit(1)).alias("days"),
        F.sum(F.col("requested") - F.col("confirmed")).alias("shortage_quantity")).drop("run")


def orders_entered_twice(w: Warehouse) -> DataFrame:
    """Orders that repeat another order of the customer and day line by line."""
    return duplicate_orders(w.stg_orders, w.stg_order_items)
