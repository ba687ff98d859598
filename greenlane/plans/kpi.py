"""KPI marts: one small table per dashboard view, derived from the core facts.

Rolling windows (weekly / daily) run after aggregation to one row per period, so
their single-partition window is bounded by the number of periods, not by data
volume. Entity rankings (customers, products, drivers) go through
``operators.ranking`` and never put an unbounded entity set into one task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import nullif_zero, on_time_flag, pct_unrounded, round_ratio, safe_pct, week_start
from ..operators.ranking import DEFAULT, RankConfig, _materialize, rank_and_order
from .core import Warehouse

# Customer segment labels of the revenue quartiles 1..4 (the mart has an ELSE branch).
MART_SEGMENTS = ("Top 25%", "Upper mid", "Lower mid", "Bottom 25%")
# Segment labels of the stand-alone quartile query (no ELSE branch).
QUERY_SEGMENTS = ("Top 25% (Whales)", "Upper mid", "Lower mid", "Bottom 25% (Long tail)")


def segment_label(quartile: str, labels: tuple[str, ...], with_else: bool):
    """CASE quartile WHEN 1 THEN labels[0] ... [ELSE last label]."""
    q = F.col(quartile)
    out = F.when(q == 1, F.lit(labels[0]))
    for i, label in enumerate(labels[1:-1], start=2):
        out = out.when(q == i, F.lit(label))
    return out.otherwise(F.lit(labels[-1])) if with_else else out.when(q == len(labels), F.lit(labels[-1]))


def kpi_overview(w: Warehouse) -> DataFrame:
    return w.order_facts.agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.round(F.sum("line_confirmed_revenue"), 2).alias("total_confirmed_revenue"),
        safe_pct(F.sum("line_confirmed_quantity"), F.sum("line_requested_quantity")).alias("overall_fill_rate_pct"),
    )


def kpi_weekly_orders(w: Warehouse) -> DataFrame:
    return w.fct_orders.groupBy(week_start("order_date").alias("week_start")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.round(F.sum("confirmed_revenue"), 2).alias("weekly_revenue"),
    )


def weekly_fill_rate(weekly: DataFrame) -> DataFrame:
    """Shared by the mart and the SQL-file query: weekly rate, 4-row mean of rates, 4-row weighted rate."""
    last4 = Window.orderBy("week_start").rowsBetween(-3, Window.currentRow)
    rate = pct_unrounded("confirmed_quantity", "requested_quantity")
    return weekly.select(
        "week_start", "requested_quantity", "confirmed_quantity",
        safe_pct("confirmed_quantity", "requested_quantity").alias("weekly_fill_rate_pct"),
        # mean of the unrounded weekly rates (AVG skips weeks whose rate is NULL)
        F.round(F.avg(rate).over(last4), 2).alias("rolling_4wk_avg_pct"),
        # volume-weighted: ratio of the 4-week sums
        safe_pct(F.sum("confirmed_quantity").over(last4), F.sum("requested_quantity").over(last4))
        .alias("rolling_4wk_fill_rate_pct"),
    )


def kpi_weekly_fill_rate(w: Warehouse) -> DataFrame:
    weekly = w.order_facts.groupBy(F.col("order_week").alias("week_start")).agg(
        F.sum("line_requested_quantity").alias("requested_quantity"),
        F.sum("line_confirmed_quantity").alias("confirmed_quantity"),
    )
    return weekly_fill_rate(weekly)


def kpi_daily_on_time_delivery(w: Warehouse) -> DataFrame:
    # no driver column is needed, so the staged deliveries are enough
    daily = w.stg_deliveries.groupBy(F.col("scheduled_at").cast("date").alias("delivery_date")).agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.sum(on_time_flag("delivery_status", "delivered_at", "scheduled_at")).alias("on_time_deliveries"),
    )
    last7 = Window.orderBy("delivery_date").rowsBetween(-6, Window.currentRow)
    return daily.select(
        "delivery_date", "deliveries", "on_time_deliveries",
        safe_pct("on_time_deliveries", "deliveries", 1).alias("on_time_pct"),
        safe_pct(F.sum("on_time_deliveries").over(last7), F.sum("deliveries").over(last7), 1)
        .alias("rolling_7day_on_time_pct"),
    )


def kpi_driver_productivity(w: Warehouse, strategy: str = "auto", cfg: RankConfig = DEFAULT) -> DataFrame:
    stats = (
        w.fct_deliveries.where(F.col("driver_worker_id").isNotNull())
        .groupBy("driver_worker_id", "driver_name", "driver_role")
        .agg(F.count(F.lit(1)).alias("total_deliveries"), F.sum("is_on_time").alias("on_time_deliveries"))
        .withColumn("_reliability", F.col("on_time_deliveries") * F.lit(Decimal("1.0")) / nullif_zero("total_deliveries"))
    )
    ranked = rank_and_order(stats, "total_deliveries", "driver_worker_id",
                            ranks={"volume_rank": [], "reliability_rank": ("_reliability", [])},
                            strategy=strategy, cfg=cfg)
    return ranked.select(
        "driver_worker_id", "driver_name", "driver_role", "total_deliveries", "on_time_deliveries",
        safe_pct("on_time_deliveries", "total_deliveries", 1).alias("on_time_pct"),
        "volume_rank", "reliability_rank",
    )


def customer_revenue(order_facts: DataFrame) -> DataFrame:
    """Per customer: distinct orders and confirmed revenue."""
    return order_facts.groupBy("customer_id", "customer_name", "market_type").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.sum("line_confirmed_revenue").alias("revenue"),
    )


def kpi_customer_revenue(w: Warehouse, strategy: str = "auto", cfg: RankConfig = DEFAULT) -> DataFrame:
    # one row per customer, written once: ranked and totalled from there, so the facts are read once
    revenue, n = _materialize(customer_revenue(w.order_facts))
    ranked = rank_and_order(
        revenue, "revenue", "customer_id",
        ranks={"overall_rank": [], "rank_within_market": ["market_type"]},
        ntiles={"revenue_quartile": 4},
        running_sums={"_running_revenue": "revenue"},
        strategy=strategy, cfg=cfg, rows=n,
    )
    # SUM(revenue) OVER () as one scalar: no single-partition window, no second ranking
    total = revenue.agg(F.sum("revenue")).scalar()
    segment = segment_label("revenue_quartile", MART_SEGMENTS, with_else=True)
    return ranked.select(
        "customer_id", "customer_name", "market_type", "order_count",
        F.round("revenue", 2).alias("revenue"),
        "overall_rank", "rank_within_market", "revenue_quartile",
        segment.alias("revenue_segment"),
        safe_pct("_running_revenue", total, 1).alias("cumulative_revenue_pct"),
    )


def revenue_by_market(per_order: DataFrame) -> DataFrame:
    """customers, distinct orders and revenue per market.

    ``per_order`` has one row per (market, customer, order header) with its revenue, so the
    rows that the two distinct counts expand are at order grain, not line grain.
    """
    return per_order.groupBy("market_type").agg(
        F.count_distinct("customer_id").alias("customer_count"),
        F.count_distinct("order_id").alias("order_count"),
        F.sum("revenue").alias("revenue"),
    )


def kpi_revenue_by_market(w: Warehouse) -> DataFrame:
    by_market = revenue_by_market(w.order_facts.select(
        "market_type", "customer_id", "order_id", F.col("line_confirmed_revenue").alias("revenue")))
    everything = Window.partitionBy()  # one row per market type: a handful of rows
    return by_market.select(
        "market_type", "customer_count", "order_count",
        F.round("revenue", 2).alias("revenue"),
        safe_pct("revenue", F.sum("revenue").over(everything), 1).alias("pct_of_total_revenue"),
    )


def product_stats(lines: DataFrame, keys: list[str]) -> DataFrame:
    return lines.groupBy(*keys).agg(
        F.sum("requested_quantity").alias("total_requested"),
        F.sum("confirmed_quantity").alias("total_confirmed"),
        F.sum("shortage_quantity").alias("shortage"),
    )


def kpi_product_demand(w: Warehouse, strategy: str = "auto", cfg: RankConfig = DEFAULT) -> DataFrame:
    stats = product_stats(w.fct_order_items, ["product_id", "product_name", "category", "source_type"])
    ranked = rank_and_order(stats, "total_requested", "product_id",
                            ranks={"demand_rank": [], "shortage_rank": ("shortage", [])}, strategy=strategy, cfg=cfg)
    return ranked.select(
        "product_id", "product_name", "category", "source_type", "total_requested", "total_confirmed", "shortage",
        safe_pct("shortage", "total_requested", 1).alias("shortage_rate_pct"),
        "demand_rank", "shortage_rank",
    )


def kpi_source_type_fill_rate(w: Warehouse) -> DataFrame:
    return w.fct_order_items.groupBy("source_type").agg(
        F.count_distinct("product_id").alias("product_count"),
        F.sum("requested_quantity").alias("total_requested"),
        F.sum("confirmed_quantity").alias("total_confirmed"),
        safe_pct(F.sum("confirmed_quantity"), F.sum("requested_quantity")).alias("fill_rate_pct"),
    )


def kpi_weekly_inventory(w: Warehouse) -> DataFrame:
    return inventory_by_category(w).select(
        "week_start", "category", "total_on_hand", round_ratio("total_on_hand", "snapshots", 2).alias("avg_per_snapshot"))


def inventory_by_category(w: Warehouse) -> DataFrame:
    """Weekly stock per category; the fact is reduced to one row per product and week before it meets the products."""
    per_product = w.stg_inventory.groupBy("product_id", week_start("inventory_date").alias("week_start")).agg(
        F.sum("available_quantity").alias("q"), F.count("available_quantity").alias("n"))
    return w.with_dim(per_product, "stg_products", {"product_id": "product_id", "category": "category"}, "product_id").groupBy(
        "week_start", "category").agg(F.sum("q").alias("total_on_hand"), F.sum("n").alias("snapshots"))


KPI_MARTS = {
    "kpi_overview": kpi_overview,
    "kpi_weekly_orders": kpi_weekly_orders,
    "kpi_weekly_fill_rate": kpi_weekly_fill_rate,
    "kpi_daily_on_time_delivery": kpi_daily_on_time_delivery,
    "kpi_driver_productivity": kpi_driver_productivity,
    "kpi_customer_revenue": kpi_customer_revenue,
    "kpi_revenue_by_market": kpi_revenue_by_market,
    "kpi_product_demand": kpi_product_demand,
    "kpi_source_type_fill_rate": kpi_source_type_fill_rate,
    "kpi_weekly_inventory": kpi_weekly_inventory,
}
