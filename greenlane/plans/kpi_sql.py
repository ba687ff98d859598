"""The thirteen stand-alone KPI queries (the variants that differ from the marts).

They read the conformed (staged) operational tables directly — orders, lines,
deliveries, workers, customers, products, inventory — exactly as the original
queries read the constrained operational tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import on_time_flag, safe_pct, week_start, zero_if_null
from ..operators.joins import table_join
from ..operators.ranking import DEFAULT, RankConfig, rank_and_order
from .core import Warehouse
from .kpi import QUERY_SEGMENTS, inventory_by_category, product_stats, segment_label, weekly_fill_rate


def q01_total_orders(w: Warehouse) -> DataFrame:
    return w.stg_orders.agg(F.count(F.lit(1)).alias("total_orders"))


def _line_revenue() -> F.Column:
    return zero_if_null("confirmed_quantity") * F.col("unit_price")


def q02_confirmed_revenue(w: Warehouse) -> DataFrame:
    return w.stg_order_items.agg(F.sum(_line_revenue()).alias("total_revenue"))


def q03_weekly_order_trend(w: Warehouse) -> DataFrame:
    return (
        w.stg_orders.groupBy(week_start("order_date").alias("week_start"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum(F.coalesce("total_value", F.lit(0))).alias("weekly_revenue"))
        .orderBy("week_start")
    )


def q04_overall_fill_rate(w: Warehouse) -> DataFrame:
    i = w.stg_order_items
    return i.agg(safe_pct(F.sum(zero_if_null("confirmed_quantity")), F.sum("requested_quantity"))
                 .alias("overall_fill_rate_pct"))


def q05_weekly_fill_rate(w: Warehouse) -> DataFrame:
    # lines reduced to order grain first (partial aggregation), then joined to their orders
    per_order = w.stg_order_items.groupBy("order_id").agg(
        F.sum("requested_quantity").alias("requested_quantity"), F.sum(zero_if_null("confirmed_quantity")).alias("confirmed_quantity"))
    weekly = (
        table_join(w.stg_orders.select("order_id", "order_date"), per_order, "order_id")
        .groupBy(week_start("order_date").alias("week_start"))
        .agg(F.sum("requested_quantity").alias("requested_quantity"), F.sum("confirmed_quantity").alias("confirmed_quantity"))
    )
    return weekly_fill_rate(weekly).select(
        "week_start", F.col("weekly_fill_rate_pct").alias("weekly_fill_rate"),
        F.col("rolling_4wk_avg_pct").alias("rolling_4wk_avg")).orderBy("week_start")


def q06_daily_on_time(w: Warehouse) -> DataFrame:
    d = w.stg_deliveries
    daily = d.groupBy(F.col("scheduled_at").cast("date").alias("delivery_date")).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(on_time_flag("delivery_status", "delivered_at", "scheduled_at")).alias("on_time"),
    )
    last7 = Window.orderBy("delivery_date").rowsBetween(-6, Window.currentRow)
    return daily.select(
        "delivery_date", "total", "on_time",
        safe_pct("on_time", "total", 1).alias("on_time_pct"),
        safe_pct(F.sum("on_time").over(last7), F.sum("total").over(last7), 1).alias("rolling_7day_on_time_pct"),
    ).orderBy("delivery_date")


def q07_driver_productivity(w: Warehouse, strategy: str = "auto", cfg: RankConfig = DEFAULT) -> DataFrame:
    # one row per driver meets the workers; unassigned deliveries and unknown drivers drop out
    per_driver = w.stg_deliveries.where(F.col("driver_worker_id").isNotNull()).groupBy(F.col("driver_worker_id").alias("worker_id")).agg(
        F.count(F.lit(1)).alias("total_deliveries"), F.sum(on_time_flag("delivery_status", "delivered_at", "scheduled_at")).alias("on_time"))
    stats = w.with_dim(per_driver, "stg_workers", {"worker_id": "worker_id", "worker_name": "worker_name", "worker_role": "role"}, "worker_id")
    ranked = rank_and_order(stats, "total_deliveries", "worker_id", ranks={"volume_rank": []}, strategy=strategy, cfg=cfg)
    return ranked.select(
        "worker_name", "role", "total_deliveries",
        safe_pct("on_time", "total_deliveries", 1).alias("on_time_pct"),
        "volume_rank",
    ).orderBy(F.col("total_deliveries").desc(), "worker_name")


def _customer_revenue(w: Warehouse) -> DataFrame:
    # lines -> orders -> customers, reduced before each join
    per_order = w.stg_order_items.groupBy("order_id").agg(F.sum(_line_revenue()).alias("revenue"))
    per_customer = table_join(w.stg_orders.select("order_id", "customer_id"), per_order, "order_id").groupBy("customer_id").agg(
        F.sum("revenue").alias("revenue"), F.count_distinct("order_id").alias("order_count"))
    return w.with_dim(per_customer, "stg_customers", {x: x for x in ("customer_id", "customer_name", "market_type")}, "customer_id")


def q08_top_customers(w: Warehouse, strategy: str = "auto", cfg: RankConfig = DEFAULT) -> DataFrame:
    ranked = rank_and_order(_customer_revenue(w), "revenue", "customer_id",
                            ranks={"overall_rank": [], "rank_within_market": ["market_type"]},
                            strategy=strategy, cfg=cfg)
    # ranks are computed over every customer before the top-15 cut (TakeOrderedAndProject)
    return ranked.orderBy(F.col("revenue").desc(), "customer_id").limit(15).select(
        "customer_name", "market_type", "order_count",
        F.round("revenue", 2).alias("total_revenue"), "overall_rank", "rank_within_market")


def q09_customer_quartiles(w: Warehouse, strategy: str = "auto", cfg: RankConfig = DEFAULT) -> DataFrame:
    base = _customer_revenue(w).drop("order_count")
    ranked = rank_and_order(base, "revenue", "customer_id", ntiles={"revenue_quartile": 4}, strategy=strategy, cfg=cfg)
    segment = segment_label("revenue_quartile", QUERY_SEGMENTS, with_else=False)  # NTILE(4) only yields 1..4
    return ranked.orderBy(F.col("revenue").desc(), "customer_id").select(
        "customer_name", "market_type", F.round("revenue", 2).alias("revenue"), "revenue_quartile",
        segment.alias("segment"))


def q10_revenue_by_market(w: Warehouse) -> DataFrame:
    from .kpi import revenue_by_market

    o = w.stg_orders.select("order_id", "customer_id")
    i = w.stg_order_items.select("order_id", "confirmed_quantity", "unit_price")
    # lines reduced to order grain first (partial aggregation), then joined to orders and customers
    per_order = i.groupBy("order_id").agg(F.sum(_line_revenue()).alias("revenue"))
    orders = w.with_dim(o, "stg_customers", {"customer_id": "customer_id", "market_type": "market_type"}, "customer_id")
    lines = table_join(orders, per_order, "order_id").select("market_type", "customer_id", "order_id", "revenue")
    # denominator: every order line, joined or not (uncorrelated scalar subquery, evaluated once)
    all_revenue = w.stg_order_items.agg(F.sum(_line_revenue())).scalar()
    by_market = revenue_by_market(lines)
    return by_market.orderBy(F.col("revenue").desc()).select(
        "market_type", "customer_count", "order_count",
        F.round("revenue", 2).alias("revenue"),
        safe_pct("revenue", all_revenue, 1).alias("pct_of_total_revenue"),
    )


def _product_totals(w: Warehouse) -> DataFrame:
    """One row per product id of the lines: requested, confirmed, shortage."""
    lines = w.stg_order_items.select("product_id", "requested_quantity", zero_if_null("confirmed_quantity").alias("confirmed_quantity"))
    return product_stats(lines.withColumn("shortage_quantity", F.col("requested_quantity") - F.col("confirmed_quantity")), ["product_id"])


def q11_top_products(w: Warehouse, strategy: str = "auto", cfg: RankConfig = DEFAULT) -> DataFrame:
    stats = w.with_dim(_product_totals(w), "stg_products", {x: x for x in ("product_id", "product_name", "category")}, "product_id")
    ranked = rank_and_order(stats, "total_requested", "product_id",
                            ranks={"demand_rank": [], "shortage_rank": ("shortage", [])}, strategy=strategy, cfg=cfg)
    return ranked.orderBy(F.col("total_requested").desc(), "product_id").limit(15).select(
        "product_name", "category", "total_requested", "total_confirmed", "shortage",
        safe_pct("shortage", "total_requested", 1).alias("shortage_rate_pct"), "demand_rank", "shortage_rank")


def q12_source_type(w: Warehouse) -> DataFrame:
    per_product = w.with_dim(_product_totals(w), "stg_products", {x: x for x in ("product_id", "source_type")}, "product_id")
    return per_product.groupBy("source_type").agg(
        F.count_distinct("product_id").alias("product_count"),
        F.sum("total_requested").alias("total_requested"),
        F.sum("total_confirmed").alias("total_confirmed"),
        safe_pct(F.sum("total_confirmed"), F.sum("total_requested")).alias("fill_rate_pct"),
    ).orderBy(F.col("total_requested").desc())


def q13_inventory_trend(w: Warehouse) -> DataFrame:
    # the average is not rounded: one division of the exact sums
    average = F.col("total_on_hand").cast("double") / F.col("snapshots")
    return inventory_by_category(w).select(
        "week_start", "category", "total_on_hand", F.when(F.col("snapshots") > 0, average).alias("avg_per_snapshot")).orderBy("week_start", "category")


KPI_QUERIES = {
    "q01_total_orders": q01_total_orders,
    "q02_confirmed_revenue": q02_confirmed_revenue,
    "q03_weekly_order_trend": q03_weekly_order_trend,
    "q04_overall_fill_rate": q04_overall_fill_rate,
    "q05_weekly_fill_rate": q05_weekly_fill_rate,
    "q06_daily_on_time": q06_daily_on_time,
    "q07_driver_productivity": q07_driver_productivity,
    "q08_top_customers": q08_top_customers,
    "q09_customer_quartiles": q09_customer_quartiles,
    "q10_revenue_by_market": q10_revenue_by_market,
    "q11_top_products": q11_top_products,
    "q12_source_type": q12_source_type,
    "q13_inventory_trend": q13_inventory_trend,
}
