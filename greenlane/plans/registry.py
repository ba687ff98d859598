"""Further registered queries (data-quality, write-path, extensions), each ``Warehouse -> DataFrame``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as dq
from ..operators import writes
from ..operators.allocation import allocate_stock, with_received_time
from ..operators.fuzzy import resolve_customers_fuzzy
from ..operators.joins import table_join
from ..operators.partitioned import PartitionedTable
from ..operators.ranking import ordered_scan
from . import extras, kpi, layout
from .core import Warehouse
from .distinct import weekly_customers

# Fixed replay time of the inventory upsert example, so that the run is deterministic.
UPSERT_NOW = "2024-02-01 00:00:00"


def _check(label: str):
    def run(w: Warehouse) -> DataFrame:
        spec = next(c for c in dq.STAGING_CHECKS + dq.CORE_CHECKS + dq.KPI_CHECKS if c.name == label)
        return dq.violations(spec, w)
    return run


def inventory_upsert(w: Warehouse) -> DataFrame:
    """U1 on the inventory grain: days 1-20 are the table, days 15-31 (re-measured) the batch."""
    inv = w.stg_inventory.withColumn("updated_at", F.col("inventory_date").cast("timestamp_ntz"))
    key = ["product_id", "inventory_date", "warehouse_location"]
    target = writes.latest_per_key(inv.where(F.dayofmonth("inventory_date") <= 20), key, "inventory_id")
    batch = inv.where(F.dayofmonth("inventory_date") >= 15).select(
        "inventory_id", *key, (F.col("available_quantity") + 1).cast("decimal(10,2)").alias("available_quantity"))
    # an existing row keeps its id; only the quantity and the time change
    merged = writes.upsert(target, batch, key, ["available_quantity"], order_col="inventory_id",
                           now=F.lit(UPSERT_NOW).cast("timestamp_ntz"))
    return merged.withColumnRenamed("_action", "action")


def inventory_upsert_outcomes(w: Warehouse) -> DataFrame:
    return writes.upsert_outcome_counts(inventory_upsert(w).withColumnRenamed("action", "_action")).withColumnRenamed(
        "_action", "action")


def inventory_merged_months(w: Warehouse) -> DataFrame:
    """U1 on files: days 1-20 stored by month, days 15-31 merged into the months that they touch; the table read back."""
    import uuid

    from ..session import ensure_checkpoint_dir

    spark = w.stg_inventory.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/greenlane-merge-{uuid.uuid4().hex}"
    inv = w.stg_inventory.withColumn("month", F.date_format("inventory_date", "yyyy-MM"))
    key = ["product_id", "inventory_date", "warehouse_location", "month"]
    for part, quantity in ((F.dayofmonth("inventory_date") <= 20, F.col("available_quantity")),
                           (F.dayofmonth("inventory_date") >= 15, (F.col("available_quantity") + 1).cast("decimal(10,2)"))):
        batch = inv.where(part).select("inventory_id", *key, quantity.alias("available_quantity"))
        writes.merge_partitions(spark, path, batch, key, ["month"], ["available_quantity"], order_col="inventory_id")
    return PartitionedTable(spark, path).read().select("inventory_id", *key, "available_quantity")


def customers_loaded_once(w: Warehouse) -> DataFrame:
    """The first load fills the empty table, the second (another batch) finds it filled and writes nothing."""
    import uuid

    from ..session import ensure_checkpoint_dir

    customers = w.stg_customers.select("customer_id", "customer_name", "is_active")
    spark = customers.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/greenlane-load-{uuid.uuid4().hex}"
    writes.load_if_empty(customers.limit(0), customers.where("is_active"), path)
    writes.load_if_empty(spark.read.parquet(path), customers, path)
    return spark.read.parquet(path)


def catalog_suppliers(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """U8 on a catalog that names its suppliers by the numbered form of their id."""
    name = F.concat(F.lit("Supplier#"), F.lpad(F.col("supplier_id").cast("string"), 9, "0"))
    catalog = w.stg_products.where(F.col("supplier_id").isNotNull()).select("product_id", "product_name", name.alias("supplier_name"))
    return writes.resolve_suppliers(catalog, w.stg_suppliers)


def corrected_headers(w: Warehouse) -> Warehouse:
    """The warehouse with headers of every fifth order taken from its lines, so that they reconcile."""
    per_order = w.order_facts.groupBy("order_id").agg(F.sum("line_count").alias("_n"), F.sum("line_requested_value").alias("_v"))
    orders = table_join(w.src.orders_cleaned, per_order, "order_id", "left")
    fix = (F.col("order_id") % 5 == 0) & F.col("_n").isNotNull()
    for column, value, kind in (("total_items", "_n", "int"), ("total_value", "_v", "decimal(10,2)")):
        orders = orders.withColumn(column, F.when(fix, F.col(value).cast(kind)).otherwise(F.col(column)))
    return Warehouse(w.src.with_table("orders_cleaned", orders.drop("_n", "_v")))


def overconfirmed_lines(w: Warehouse) -> DataFrame:
    """D7 on lines of which every 50th order's are confirmed above the request."""
    more = F.when((F.col("order_id") % 50 == 0), F.col("requested_quantity") + 1).otherwise(F.col("confirmed_quantity"))
    items = w.src.order_items.withColumn("confirmed_quantity", more.cast("decimal(10,2)"))
    return dq.confirmed_not_above_requested(Warehouse(w.src.with_table("order_items", items)).fct_order_items)


def customer_order_history(w: Warehouse, distributed: bool = False) -> DataFrame:
    """Each customer's orders, newest first, numbered (hot customers are range-split, the rest is not copied)."""
    o = w.stg_orders.select("customer_id", "order_id", "order_date", "order_status", "total_value")
    scanned = ordered_scan(o, None, ["customer_id"], [F.col("order_date").desc(), F.col("order_id").desc()], {},
                           force_distributed=distributed)
    return scanned.withColumn("order_seq", (F.col("_pos") + 1).cast("bigint")).drop("_pos")


def stock_allocation(w: Warehouse, strategy: str = "auto") -> DataFrame:
    lines = w.fct_order_items.select("order_item_id", "order_id", "product_id", "order_date", "requested_quantity")
    return allocate_stock(with_received_time(lines, w.stg_orders, w.stg_incoming_orders_raw), w.stg_inventory, strategy, keys=lines, coarse=w.stg_order_items)


def reentered_orders(w: Warehouse) -> Warehouse:
    """The warehouse with orders entered again under a negative id: every 50th as it was, others with a price or the date changed."""
    def again(df: DataFrame) -> DataFrame:
        return df.where("order_id % 50 IN (0, 10, 25)").withColumn("order_id", -F.col("order_id"))

    orders = again(w.src.orders_cleaned).withColumn("order_date", F.expr("CASE WHEN order_id % 50 = -10 THEN date_add(order_date, 1) ELSE order_date END"))
    items = again(w.src.order_items).withColumn("unit_price", F.expr("CAST(CASE WHEN order_id % 50 = -25 THEN unit_price + 1 ELSE unit_price END AS decimal(10,2))"))
    return Warehouse(w.src.with_table("orders_cleaned", w.src.orders_cleaned.unionByName(orders)).with_table("order_items", w.src.order_items.unionByName(items)))


def misspelt_raw_orders(w: Warehouse) -> DataFrame:
    """Staged raw orders of which some names lost a letter, a digit or its case, got a wrong letter, or are of no customer."""
    name = F.expr("""CASE raw_order_id % 45 WHEN 1 THEN concat(substr(customer_name_raw, 1, 2), substr(customer_name_raw, 4))
        WHEN 2 THEN upper(customer_name_raw) WHEN 3 THEN concat('K', substr(customer_name_raw, 2, 2), 'x', substr(customer_name_raw, 5))
        WHEN 4 THEN substr(customer_name_raw, 1, length(customer_name_raw) - 1) WHEN 5 THEN concat('Walk-in ', raw_order_id) ELSE customer_name_raw END""")
    return w.stg_incoming_orders_raw.withColumn("customer_name_raw", name)


def stale_market_split(w: Warehouse) -> DataFrame:
    """D9 / J10 on marts of different builds: the market split lacks the orders of the last days, so the totals differ."""
    old = Warehouse(w.src.with_table("orders_cleaned", w.src.orders_cleaned.where(F.col("order_date") < F.lit(STALE_FROM).cast("date"))))
    return dq.revenue_ties_out(kpi.kpi_revenue_by_market(old), kpi.kpi_overview(w))


def _scratch(w: Warehouse, name: str) -> str:
    import uuid

    from ..session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(w.stg_orders.sparkSession).rstrip('/')}/greenlane-{name}-{uuid.uuid4().hex}"


def bucketed_order_fulfilment(w: Warehouse) -> DataFrame:
    """J1, J6 on the bucketed core."""
    root = _scratch(w, "bucketed")
    buckets = int(w.stg_orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return layout.order_fulfilment(layout.write_bucketed_core(w, root, f"core_{root[-12:]}", buckets))


def customer_history_lookup(w: Warehouse) -> DataFrame:
    """The orders of given customers (those whose id is divisible by 100), read from the table sorted by customer."""
    path = _scratch(w, "lookup")
    layout.write_lookup(w.stg_orders.select("customer_id", "order_id", "order_date", "order_status", "total_value"), path, "customer_id", ("order_id",))
    given = w.stg_customers.where("customer_id % 100 = 0").select("customer_id")
    return layout.read_keys(w.stg_orders.sparkSession, path, "customer_id", given)


def loaded_tables(w: Warehouse) -> DataFrame:
    """All tables loaded in upper case into an empty folder, with the rows reported and those read back."""
    from ..sources.io import load_tables

    spark, root = w.stg_orders.sparkSession, _scratch(w, "landing")
    report = load_tables(w.src, root, upper_case=True)
    parts = [spark.read.parquet(f"{root}/{t}").agg(F.lit(t).alias("table_name"), F.lit(n).cast("long").alias("rows_reported"), F.count(F.lit(1)).alias("rows_read"))
             for t, n in report.items()]
    return reduce(DataFrame.unionByName, parts)


def exported_customers(w: Warehouse) -> DataFrame:
    """The customer dimension exported as CSV with a header, read back with the landing schema's types."""
    from ..sources.io import export_csv, read_table

    path = _scratch(w, "csv")
    export_csv(w.src.customers, path)
    return read_table(w.stg_orders.sparkSession, path, "customers", "csv").select("customer_id", "customer_name", "market_type", "region", "signup_date", "is_active")


def built_marts(w: Warehouse) -> DataFrame:
    """Core and marts written as tables, then the checks on what was written that would stop the build, and those that only warn."""
    from .build import build

    spark, root = w.stg_orders.sparkSession, _scratch(w, "build")
    build(spark, w.src, root)
    return spark.read.parquet(f"{root}/checks").where("status <> 'pass'").select("check_name", "severity", "status", "violations")


# First day that the stale market split lacks.
STALE_FROM = "2001-07-01"
# Fixed split point of the incremental example: rows updated before it form the initial load.
INCREMENTAL_CUTOFF = "1998-06-01 00:00:00"


def incremental_weekly_fill_rate(w: Warehouse) -> DataFrame:
    """Initial load up to the cutoff, then one refresh that picks up everything newer."""
    import uuid

    from ..functions import week_start, zero_if_null
    from ..session import ensure_checkpoint_dir
    from ..streaming.incremental import refresh_weekly_fill

    spark = w.stg_orders.sparkSession
    items = w.src.order_items.select("order_id", "requested_quantity", "confirmed_quantity", "updated_at")
    lines = table_join(w.stg_orders.select("order_id", "order_date"), items, "order_id").select(
        week_start("order_date").alias("order_week"), F.col("requested_quantity").cast("decimal(10,2)").alias("requested_quantity"),
        zero_if_null(F.col("confirmed_quantity").cast("decimal(10,2)")).alias("confirmed_quantity"), "updated_at")
    state = f"{ensure_checkpoint_dir(spark).rstrip('/')}/greenlane-incremental-{uuid.uuid4().hex}"
    cutoff = F.lit(INCREMENTAL_CUTOFF).cast("timestamp_ntz")
    refresh_weekly_fill(spark, lines.where(F.col("updated_at") < cutoff), state)
    return refresh_weekly_fill(spark, lines, state)


def streaming_daily_on_time(w: Warehouse) -> DataFrame:
    from ..streaming.delivery_stream import streaming_daily_on_time as run

    return run(w.stg_orders.sparkSession, w.src.sf_dir)


def streaming_corrected_on_time(w: Warehouse) -> DataFrame:
    from ..streaming.delivery_stream import streaming_corrected_on_time as run

    return run(w.stg_orders.sparkSession, w.src.sf_dir)


EXTRA_QUERIES = {
    # data quality
    "dq_staging_summary": lambda w: dq.run_checks(w, dq.STAGING_CHECKS),
    "dq_core_summary": lambda w: dq.run_checks(w, dq.CORE_CHECKS),
    "dq_kpi_summary": lambda w: dq.run_checks(w, dq.KPI_CHECKS),
    "dq_confirmed_not_above_requested": _check("assert_confirmed_not_above_requested"),
    "dq_delivered_has_timestamp": _check("assert_delivered_rows_have_timestamp"),
    "dq_order_header_mismatch": _check("warn_order_header_mismatch"),
    "dq_revenue_ties_out": _check("assert_kpi_revenue_ties_out"),
    "dq_duplicate_order_lines": _check("unique_combination__stg_order_items__order_id_product_id"),
    "dq_orphan_product_suppliers": _check("relationships__stg_products__supplier_id__stg_suppliers"),
    "dq_invalid_source_channel": lambda w: dq.violations(
        dq.Check("stg_incoming_orders_raw", "accepted_values", "source_channel", dq.SOURCE_CHANNELS), w
    ).select("raw_order_id", "source_channel"),
    "dq_shift_hours_out_of_range": lambda w: dq.violations(
        next(c for c in dq.STAGING_CHECKS if c.name == "check__stg_worker_shifts__hours"), w
    ).select("shift_id", "worker_id", "hours_worked"),
    # write path
    "unprocessed_raw_orders": lambda w: writes.unprocessed_raw_orders(w.stg_incoming_orders_raw, w.stg_orders),
    "orders_needing_items": lambda w: writes.orders_needing_items(w.stg_orders, w.stg_order_items),
    "deliverable_orders": lambda w: writes.deliverable_orders(w.stg_orders, w.stg_customers, w.stg_deliveries),
    "active_drivers": lambda w: writes.active_drivers(w.stg_workers),
    "resolved_raw_orders": lambda w: writes.resolve_customers(w.stg_incoming_orders_raw, w.stg_customers)[0],
    "rejected_raw_orders": lambda w: writes.resolve_customers(w.stg_incoming_orders_raw, w.stg_customers)[1],
    "upsert_inventory": inventory_upsert,
    "upsert_inventory_outcomes": inventory_upsert_outcomes,
    "status_breakdown_cleaning": lambda w: writes.status_breakdown(w.stg_orders, "cleaning_status"),
    "status_breakdown_items": lambda w: writes.status_breakdown(w.stg_order_items, "item_status"),
    "status_breakdown_deliveries": lambda w: writes.status_breakdown(w.stg_deliveries, "delivery_status"),
    "driver_assignment_counts": lambda w: writes.driver_assignment_counts(w.stg_deliveries, w.stg_workers),
    "customer_order_history": customer_order_history,
    "merged_inventory_months": inventory_merged_months,
    "customers_loaded_once": customers_loaded_once,
    "resolved_catalog_suppliers": lambda w: catalog_suppliers(w)[0],
    "unresolved_catalog_suppliers": lambda w: catalog_suppliers(w)[1],
    # branches that the plain test tables never take
    "fct_orders_corrected_headers": lambda w: corrected_headers(w).fct_orders,
    "dq_overconfirmed_lines": overconfirmed_lines,
    "dq_stale_market_split": stale_market_split,
    # the range-partitioned ranking path, whatever the frame's size
    "kpi_customer_revenue_distributed": lambda w: kpi.kpi_customer_revenue(w, strategy="distributed"),
    "kpi_product_demand_distributed": lambda w: kpi.kpi_product_demand(w, strategy="distributed"),
    "kpi_driver_productivity_distributed": lambda w: kpi.kpi_driver_productivity(w, strategy="distributed"),
    "customer_order_history_distributed": lambda w: customer_order_history(w, distributed=True),
    "x3_stock_allocation_distributed": lambda w: stock_allocation(w, "distributed"),
    # extensions
    "x3_stock_allocation": stock_allocation,
    "x5_prep_list": extras.prep_list,
    "x6_labor_by_worker_week": extras.labor_by_worker_week,
    "x6_labor_by_order": extras.labor_by_order,
    "x7_stockout_frequency": extras.stockout_frequency,
    "x7_delivery_bottlenecks": extras.delivery_bottlenecks,
    "x7_overdue_deliveries": extras.overdue_deliveries,
    "x7_overdue_deliveries_distributed": lambda w: extras.overdue_deliveries(w, "distributed"),
    "x7_stockout_runs": extras.stockout_runs,
    "x7_stockout_runs_distributed": lambda w: extras.stockout_runs(w, "distributed"),
    "x8_orders_missing_items": extras.orders_missing_items,
    "x8_duplicate_orders": lambda w: extras.orders_entered_twice(reentered_orders(w)),
    "resolved_raw_orders_fuzzy": lambda w: resolve_customers_fuzzy(misspelt_raw_orders(w), w.stg_customers),
    "weekly_customers": weekly_customers,
    # layouts, loads, builds
    "bucketed_order_fulfilment": bucketed_order_fulfilment,
    "customer_history_lookup": customer_history_lookup,
    "loaded_tables": loaded_tables,
    "exported_customers": exported_customers,
    "built_marts": built_marts,
    # incremental and streaming
    "x1_incremental_weekly_fill_rate": incremental_weekly_fill_rate,
    "x2_streaming_daily_on_time": streaming_daily_on_time,
    "x2_corrected_deliveries": streaming_corrected_on_time,
}
