"""Staging conformers (P1-P11): rename, cast and normalise one raw table each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import norm


def stg_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        F.trim("customer_name").alias("customer_name"),
        norm("market_type").alias("market_type"),
        "region",
        F.col("signup_date").cast("date").alias("signup_date"),
        "is_active",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
    )


def stg_suppliers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "supplier_id",
        F.trim("supplier_name").alias("supplier_name"),
        "supplier_region",
        norm("supplier_type").alias("supplier_type"),
        "is_local",
        "is_active",
    )


def stg_workers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "worker_id",
        F.trim("worker_name").alias("worker_name"),
        norm("role").alias("worker_role"),
        F.col("hire_date").cast("date").alias("hire_date"),
        "is_active",
    )


def stg_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        F.trim("product_name").alias("product_name"),
        "category",
        "unit",
        F.col("standard_price").cast("decimal(10,2)").alias("standard_price"),
        norm("source_type").alias("source_type"),
        "supplier_id",
        "is_active",
    )


def stg_inventory(raw: DataFrame) -> DataFrame:
    return raw.select(
        "inventory_id",
        "product_id",
        F.col("inventory_date").cast("date").alias("inventory_date"),
        F.col("available_quantity").cast("decimal(10,2)").alias("available_quantity"),
        "warehouse_location",
    )


def stg_incoming_orders_raw(raw: DataFrame) -> DataFrame:
    return raw.select(
        "raw_order_id",
        "customer_name_raw",
        "order_text",
        F.col("received_timestamp").cast("timestamp_ntz").alias("received_at"),
        norm("source_channel").alias("source_channel"),
        "entered_by",
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "raw_order_id",
        "customer_id",
        F.col("order_date").cast("date").alias("order_date"),
        F.col("requested_delivery_date").cast("date").alias("requested_delivery_date"),
        norm("order_status").alias("order_status"),
        norm("cleaning_status").alias("cleaning_status"),
        "total_items",
        F.col("total_value").cast("decimal(10,2)").alias("total_value"),
        "notes",
    )


def stg_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_item_id",
        "order_id",
        "product_id",
        F.col("requested_quantity").cast("decimal(10,2)").alias("requested_quantity"),
        # NULL = not yet confirmed; it stays NULL here and counts as 0 only downstream.
        F.col("confirmed_quantity").cast("decimal(10,2)").alias("confirmed_quantity"),
        F.col("unit_price").cast("decimal(10,2)").alias("unit_price"),
        norm("item_status").alias("item_status"),
    )


def stg_prep_lists(raw: DataFrame) -> DataFrame:
    return raw.select(
        "prep_id",
        "order_id",
        "product_id",
        F.col("quantity_to_prepare").cast("decimal(10,2)").alias("quantity_to_prepare"),
        norm("prep_status").alias("prep_status"),
        "assigned_worker_id",
        F.col("prep_date").cast("date").alias("prep_date"),
    )


def stg_deliveries(raw: DataFrame) -> DataFrame:
    return raw.select(
        "delivery_id",
        "order_id",
        F.col("scheduled_delivery_time").cast("timestamp_ntz").alias("scheduled_at"),
        F.col("actual_delivery_time").cast("timestamp_ntz").alias("delivered_at"),
        norm("delivery_status").alias("delivery_status"),
        "driver_worker_id",
        "delivery_address",
    )


def stg_worker_shifts(raw: DataFrame) -> DataFrame:
    return raw.select(
        "shift_id",
        "worker_id",
        F.col("shift_date").cast("date").alias("shift_date"),
        norm("task_type").alias("task_type"),
        F.col("hours_worked").cast("decimal(5,2)").alias("hours_worked"),
        F.col("hourly_rate").cast("decimal(10,2)").alias("hourly_rate"),
        "related_order_id",
        "notes",
    )


STAGING = {
    "stg_customers": ("customers", stg_customers),
    "stg_suppliers": ("suppliers", stg_suppliers),
    "stg_workers": ("workers", stg_workers),
    "stg_products": ("products", stg_products),
    "stg_inventory": ("inventory", stg_inventory),
    "stg_incoming_orders_raw": ("incoming_orders_raw", stg_incoming_orders_raw),
    "stg_orders": ("orders_cleaned", stg_orders),
    "stg_order_items": ("order_items", stg_order_items),
    "stg_prep_lists": ("prep_lists", stg_prep_lists),
    "stg_deliveries": ("deliveries", stg_deliveries),
    "stg_worker_shifts": ("worker_shifts", stg_worker_shifts),
}
