"""Intermediate and core models: enriched lines/deliveries, facts and dimensions.

``Warehouse`` plays the role of ``ref()``: every model is a lazily built DataFrame
that is created once per instance, so a job that derives several marts shares one
plan object per model (and can ``persist`` or write it once, see ``plans.build``).
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import on_time_flag, safe_pct, week_start, zero_if_null
from ..operators.joins import fits, lookup_join, salts_for, table_join
from ..sources.io import Tables
from . import staging as stg


class Warehouse:
    #: Whether the rows of a key are counted before a large dimension is copied for hot keys (a job at once, not when the plan runs).
    count_keys = False

    def __init__(self, src: Tables):
        self.src = src
        self._fits: dict[tuple[str, ...], bool] = {}

    def with_dim(self, fact: DataFrame, model: str, columns: dict[str, str], key: str, how: str = "inner") -> DataFrame:
        """``fact`` joined with columns (name -> new name) of a dimension model, measured once per instance."""
        dim = getattr(self, model).select(*[F.col(c).alias(a) for c, a in columns.items()])
        seen = (model, *columns)
        if seen not in self._fits:
            self._fits[seen] = fits(dim)
        if self._fits[seen] or not self.count_keys:
            return lookup_join(fact, dim, key, how, small=self._fits[seen])
        return lookup_join(fact, dim, key, how, small=False, salts=salts_for(fact, key))

    # -- staging -----------------------------------------------------------
    @cached_property
    def stg_customers(self) -> DataFrame:
        return stg.stg_customers(self.src.customers)

    @cached_property
    def stg_suppliers(self) -> DataFrame:
        return stg.stg_suppliers(self.src.suppliers)

    @cached_property
    def stg_workers(self) -> DataFrame:
        return stg.stg_workers(self.src.workers)

    @cached_property
    def stg_products(self) -> DataFrame:
        return stg.stg_products(self.src.products)

    @cached_property
    def stg_inventory(self) -> DataFrame:
        return stg.stg_inventory(self.src.inventory)

    @cached_property
    def stg_incoming_orders_raw(self) -> DataFrame:
        return stg.stg_incoming_orders_raw(self.src.incoming_orders_raw)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return stg.stg_orders(self.src.orders_cleaned)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return stg.stg_order_items(self.src.order_items)

    @cached_property
    def stg_prep_lists(self) -> DataFrame:
        return stg.stg_prep_lists(self.src.prep_lists)

    @cached_property
    def stg_deliveries(self) -> DataFrame:
        return stg.stg_deliveries(self.src.deliveries)

    @cached_property
    def stg_worker_shifts(self) -> DataFrame:
        return stg.stg_worker_shifts(self.src.worker_shifts)

    # -- intermediate ------------------------------------------------------
    @cached_property
    def int_order_items_enriched(self) -> DataFrame:
        """Line grain joined to order, customer and product (inner joins: orphans drop out).

        Customers meet the orders and products meet the lines as measured dimensions (no
        shuffle while they fit); the lines then cross the network once, on order_id.
        """
        orders = self.with_dim(self.stg_orders.select("order_id", "order_date", "order_status", "customer_id"), "stg_customers",
                               {c: c for c in ("customer_id", "customer_name", "market_type")}, "customer_id")
        lines = self.with_dim(self.stg_order_items, "stg_products",
                              {c: c for c in ("product_id", "product_name", "category", "source_type")}, "product_id")
        confirmed = zero_if_null("confirmed_quantity")
        return (
            table_join(lines, orders, "order_id")
            .select(
                "order_item_id", "order_id", "order_date",
                week_start("order_date").alias("order_week"),
                "order_status", "customer_id", "customer_name", "market_type",
                "product_id", "product_name", "category", "source_type", "item_status",
                "requested_quantity",
                confirmed.alias("confirmed_quantity"),
                (F.col("requested_quantity") - confirmed).alias("shortage_quantity"),
                "unit_price",
                (confirmed * F.col("unit_price")).alias("confirmed_revenue"),
                (F.col("requested_quantity") * F.col("unit_price")).alias("requested_value"),
            )
        )

    @cached_property
    def int_deliveries_enriched(self) -> DataFrame:
        """Delivery grain with the driver (left join: unassigned deliveries stay) and is_on_time."""
        d = self.with_dim(self.stg_deliveries, "stg_workers", {
            "worker_id": "driver_worker_id", "worker_name": "driver_name", "worker_role": "driver_role"}, "driver_worker_id", "left")
        return d.select(
            "delivery_id", "order_id",
            F.col("scheduled_at").cast("date").alias("scheduled_date"),
            "scheduled_at", "delivered_at", "delivery_status", "driver_worker_id", "driver_name", "driver_role",
            on_time_flag("delivery_status", "delivered_at", "scheduled_at").alias("is_on_time"),
        )

    @cached_property
    def order_line_totals(self) -> DataFrame:
        """Per-order sums of the lines whose product exists.

        Product keys are a measured dimension and the aggregation is partial before its
        shuffle, so what crosses the network is about one row per order and map task.
        """
        lines = self.with_dim(self.stg_order_items, "stg_products", {"product_id": "product_id"}, "product_id")
        confirmed = zero_if_null("confirmed_quantity")
        return lines.groupBy("order_id").agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum(F.col("requested_quantity") * F.col("unit_price")).alias("line_requested_value"),
            F.sum(confirmed * F.col("unit_price")).alias("line_confirmed_revenue"),
            F.sum("requested_quantity").alias("line_requested_quantity"),
            F.sum(confirmed).alias("line_confirmed_quantity"),
        )

    @cached_property
    def order_totals(self) -> DataFrame:
        """Line totals with their order's date and customer id (orders without lines drop out)."""
        # totals arrive hash-partitioned by order_id, so joining orders adds no shuffle on that side
        orders = self.stg_orders.select("order_id", "order_date", "customer_id")
        return table_join(self.order_line_totals, orders, "order_id")

    @cached_property
    def order_facts(self) -> DataFrame:
        """One row per order header that has lines, with its customer: the order-grain view of
        ``int_order_items_enriched`` (same lines, same inner-join semantics). Nothing enforces unique
        headers, so whoever counts orders counts distinct ids."""
        totals = self.with_dim(self.order_totals, "stg_customers", {c: c for c in ("customer_id", "customer_name", "market_type")}, "customer_id")
        return totals.withColumn("order_week", week_start("order_date"))

    # -- core facts --------------------------------------------------------
    @property
    def fct_order_items(self) -> DataFrame:
        return self.int_order_items_enriched

    @property
    def fct_deliveries(self) -> DataFrame:
        return self.int_deliveries_enriched

    @cached_property
    def fct_orders(self) -> DataFrame:
        """Header totals vs totals rebuilt from the lines (order grain)."""
        totals = ("line_count", "line_requested_value", "line_confirmed_revenue", "line_requested_quantity", "line_confirmed_quantity")
        lines = self.order_facts.groupBy("order_id").agg(*[F.sum(c).alias(c) for c in totals])
        line_count = F.coalesce(F.col("line_count"), F.lit(0))
        requested_value = F.coalesce(F.col("line_requested_value"), F.lit(0))
        status = (
            F.when(F.col("total_items").isNull(), F.lit("no_header_total"))
            .when(F.col("total_items") != line_count, F.lit("item_count_mismatch"))
            .when(F.abs(F.col("total_value") - requested_value) > F.lit(Decimal("0.01")), F.lit("value_mismatch"))
            .otherwise(F.lit("reconciled"))
        )
        return table_join(self.stg_orders, lines, "order_id", "left").select(
            "order_id", "raw_order_id", "customer_id", "order_date", "requested_delivery_date",
            "order_status", "cleaning_status",
            F.col("total_items").alias("header_total_items"),
            F.col("total_value").alias("header_total_value"),
            line_count.alias("line_count"),
            requested_value.alias("line_requested_value"),
            F.coalesce(F.col("line_confirmed_revenue"), F.lit(0)).alias("confirmed_revenue"),
            # not coalesced: NULL for an order without lines
            safe_pct("line_confirmed_quantity", "line_requested_quantity").alias("fill_rate_pct"),
            (F.col("total_value") - requested_value).alias("header_value_variance"),
            status.alias("reconciliation_status"),
        )

    @cached_property
    def fct_worker_shifts(self) -> DataFrame:
        shifts = self.with_dim(self.stg_worker_shifts, "stg_workers", {c: c for c in ("worker_id", "worker_name", "worker_role")}, "worker_id")
        return shifts.select(
            "shift_id", "worker_id", "worker_name", "worker_role", "shift_date", "task_type",
            "hours_worked", "hourly_rate",
            (F.col("hours_worked") * F.col("hourly_rate")).alias("labor_cost"),
            "related_order_id",
        )

    # -- dimensions --------------------------------------------------------
    @cached_property
    def dim_customers(self) -> DataFrame:
        # the LEFT JOIN from customers below drops unknown customers, so no customer join is needed here
        per_customer = self.order_totals.groupBy("customer_id").agg(
            F.count_distinct("order_id").alias("lifetime_orders"),
            F.sum("line_confirmed_revenue").alias("lifetime_revenue"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        return table_join(self.stg_customers, per_customer, "customer_id", "left").select(
            "customer_id", "customer_name", "market_type", "region", "signup_date", "is_active",
            F.coalesce("lifetime_orders", F.lit(0)).alias("lifetime_orders"),
            F.coalesce("lifetime_revenue", F.lit(0)).alias("lifetime_revenue"),
            "first_order_date", "last_order_date",
        )

    @cached_property
    def dim_products(self) -> DataFrame:
        s = self.stg_suppliers.select("supplier_id", "supplier_name", "supplier_type",
                                      F.col("is_local").alias("is_local_supplier"))
        return self.stg_products.join(s, "supplier_id", "left").select(
            "product_id", "product_name", "category", "unit", "standard_price", "source_type",
            "supplier_id", "supplier_name", "supplier_type", "is_local_supplier", "is_active",
        )

    @cached_property
    def dim_workers(self) -> DataFrame:
        return self.stg_workers.select("worker_id", "worker_name", "worker_role", "hire_date", "is_active")
