"""Explicit schemas of the eleven operational tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

_L, _S, _D, _B = T.LongType(), T.StringType(), T.DateType(), T.BooleanType()
_TS = T.TimestampNTZType()  # TIMESTAMP without time zone
_I = T.IntegerType()


def _dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_AUDIT = (("created_at", _TS, True), ("updated_at", _TS, True))

SCHEMAS: dict[str, T.StructType] = {
    "customers": _schema(
        ("customer_id", _L, False), ("customer_name", _S, False), ("market_type", _S, False),
        ("region", _S, True), ("signup_date", _D, True), ("is_active", _B, True), *_AUDIT),
    "suppliers": _schema(
        ("supplier_id", _L, False), ("supplier_name", _S, False), ("supplier_region", _S, True),
        ("supplier_type", _S, False), ("is_local", _B, True), ("is_active", _B, True), *_AUDIT),
    "workers": _schema(
        ("worker_id", _L, False), ("worker_name", _S, False), ("role", _S, False),
        ("hire_date", _D, True), ("is_active", _B, True), *_AUDIT),
    "products": _schema(
        ("product_id", _L, False), ("product_name", _S, False), ("category", _S, True),
        ("unit", _S, True), ("standard_price", _dec(10, 2), True), ("source_type", _S, False),
        ("supplier_id", _L, True), ("is_active", _B, True), *_AUDIT),
    "inventory": _schema(
        ("inventory_id", _L, False), ("product_id", _L, False), ("inventory_date", _D, False),
        ("available_quantity", _dec(10, 2), False), ("warehouse_location", _S, False), *_AUDIT),
    "incoming_orders_raw": _schema(
        ("raw_order_id", _L, False), ("customer_name_raw", _S, True), ("order_text", _S, False),
        ("received_timestamp", _TS, False), ("source_channel", _S, False), ("entered_by", _S, True), *_AUDIT),
    "orders_cleaned": _schema(
        ("order_id", _L, False), ("raw_order_id", _L, True), ("customer_id", _L, False),
        ("order_date", _D, False), ("requested_delivery_date", _D, True), ("order_status", _S, False),
        ("cleaning_status", _S, False), ("total_items", _I, True), ("total_value", _dec(10, 2), True),
        ("notes", _S, True), *_AUDIT),
    "order_items": _schema(
        ("order_item_id", _L, False), ("order_id", _L, False), ("product_id", _L, False),
        ("requested_quantity", _dec(10, 2), False), ("confirmed_quantity", _dec(10, 2), True),
        ("unit_price", _dec(10, 2), False), ("item_status", _S, False), *_AUDIT),
    "prep_lists": _schema(
        ("prep_id", _L, False), ("order_id", _L, False), ("product_id", _L, False),
        ("quantity_to_prepare", _dec(10, 2), False), ("prep_status", _S, False),
        ("assigned_worker_id", _L, True), ("prep_date", _D, True), *_AUDIT),
    "deliveries": _schema(
        ("delivery_id", _L, False), ("order_id", _L, False), ("scheduled_delivery_time", _TS, False),
        ("actual_delivery_time", _TS, True), ("delivery_status", _S, False), ("driver_worker_id", _L, True),
        ("delivery_address", _S, True), *_AUDIT),
    "worker_shifts": _schema(
        ("shift_id", _L, False), ("worker_id", _L, False), ("shift_date", _D, False), ("task_type", _S, False),
        ("hours_worked", _dec(5, 2), False), ("hourly_rate", _dec(10, 2), False), ("related_order_id", _L, True),
        ("notes", _S, True), *_AUDIT),
}

TABLES: tuple[str, ...] = tuple(SCHEMAS)

# Natural keys (grain) of each table, used by upserts and uniqueness checks.
KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "suppliers": ("supplier_id",),
    "workers": ("worker_id",),
    "products": ("product_id",),
    "inventory": ("product_id", "inventory_date", "warehouse_location"),
    "incoming_orders_raw": ("raw_order_id",),
    "orders_cleaned": ("order_id",),
    "order_items": ("order_id", "product_id"),
    "prep_lists": ("prep_id",),
    "deliveries": ("order_id",),
    "worker_shifts": ("shift_id",),
}
