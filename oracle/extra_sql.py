"""Oracle SQL for the data-quality, write-path and extension queries."""

from __future__ import annotations

from . import checks
from .duckdb_sql import ON_TIME, dbl, pct, query

SINGULAR = {
    "assert_confirmed_not_above_requested": "SELECT order_item_id, requested_quantity, confirmed_quantity FROM fct_order_items "
                                            "WHERE confirmed_quantity > requested_quantity OR confirmed_quantity < 0",
    "assert_delivered_rows_have_timestamp": "SELECT delivery_id, delivery_status, delivered_at FROM fct_deliveries "
                                            "WHERE delivery_status = 'delivered' AND delivered_at IS NULL",
    "warn_order_header_mismatch": "SELECT order_id, reconciliation_status, header_total_items, line_count, header_value_variance "
                                  "FROM fct_orders WHERE reconciliation_status IN ('item_count_mismatch', 'value_mismatch')",
    "assert_kpi_revenue_ties_out": "SELECT by_market, overview FROM (SELECT "
                                   "(SELECT sum(round(rev, 2)) FROM (SELECT market_type, sum(confirmed_revenue) AS rev "
                                   "FROM fct_order_items GROUP BY 1)) AS by_market, "
                                   "(SELECT round(sum(confirmed_revenue), 2) FROM fct_order_items) AS overview) "
                                   "WHERE abs(coalesce(by_market, 0) - coalesce(overview, 0)) > 0.05",
}


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _source(model: str) -> str:
    """A model as a FROM item: shared CTEs by name, KPI marts as their own oracle query."""
    if model.startswith("kpi_"):
        from .duckdb_sql import KPI

        return f"({KPI[model]}) AS {model}"
    return model


def violations_sql(model: str, kind: str, arg) -> str:
    m = _source(model)
    if kind == "not_null":
        return f"SELECT * FROM {m} WHERE {arg} IS NULL"
    if kind == "accepted_values":
        return f"SELECT * FROM {m} WHERE {arg[0]} IS NOT NULL AND {arg[0]} NOT IN ({', '.join(map(_lit, arg[1:]))})"
    if kind == "expression":
        return f"SELECT * FROM {m} WHERE NOT ({arg})"
    if kind == "unique":
        return f"SELECT {arg}, count(*) AS n_records FROM {m} WHERE {arg} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    if kind == "unique_combination":
        cols = ", ".join(arg)
        return f"SELECT {cols}, count(*) AS row_count FROM {m} GROUP BY {cols} HAVING count(*) > 1"
    if kind == "relationships":
        column, pm, pc = arg
        return (f"SELECT ch.{column} FROM {m} ch WHERE ch.{column} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {pm} p WHERE p.{pc} = ch.{column})")
    if kind == "singular":
        return SINGULAR[arg]
    raise ValueError(kind)


def summary_sql(declared: list[tuple]) -> str:
    parts = []
    for name, model, kind, arg, severity in declared:
        parts.append(
            f"SELECT '{name}' AS check_name, '{model}' AS model, '{kind}' AS kind, '{severity}' AS severity, v AS violations, "
            f"CASE WHEN v = 0 THEN 'pass' WHEN '{severity}' = 'warn' THEN 'warn' ELSE 'fail' END AS status "
            f"FROM (SELECT CAST(count(*) AS BIGINT) AS v FROM ({violations_sql(model, kind, arg)}))")
    return query("\nUNION ALL\n".join(parts))


SOURCE_CHANNELS = ("text", "email", "phone", "spreadsheet", "in_person", "other")
INV_KEY = "product_id, inventory_date, warehouse_location"
UPSERT_CTES = dict(
    inv="SELECT *, CAST(inventory_date AS TIMESTAMP) AS updated_at FROM stg_inventory",
    t=f"SELECT * FROM inv WHERE day(inventory_date) <= 20 "
      f"QUALIFY row_number() OVER (PARTITION BY {INV_KEY} ORDER BY inventory_id DESC) = 1",
    b=f"SELECT inventory_id, {INV_KEY}, CAST(available_quantity + 1 AS DECIMAL(10,2)) AS available_quantity FROM inv "
      f"WHERE day(inventory_date) >= 15 QUALIFY row_number() OVER (PARTITION BY {INV_KEY} ORDER BY inventory_id DESC) = 1",
    merged="""SELECT coalesce(t.product_id, b.product_id) AS product_id, coalesce(t.inventory_date, b.inventory_date) AS inventory_date,
  coalesce(t.warehouse_location, b.warehouse_location) AS warehouse_location,
  coalesce(t.inventory_id, b.inventory_id) AS inventory_id,
  CASE WHEN b.product_id IS NOT NULL THEN b.available_quantity ELSE t.available_quantity END AS available_quantity,
  CASE WHEN b.product_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE t.updated_at END AS updated_at,
  CASE WHEN b.product_id IS NOT NULL AND t.product_id IS NOT NULL THEN 'updated' WHEN b.product_id IS NOT NULL THEN 'inserted'
    ELSE 'unchanged' END AS action
FROM t FULL OUTER JOIN b ON t.product_id = b.product_id AND t.inventory_date = b.inventory_date
  AND t.warehouse_location = b.warehouse_location""",
)

ALLOC_CTES = dict(
    stock="SELECT product_id, inventory_date AS order_date, sum(available_quantity) AS stock FROM stg_inventory GROUP BY 1, 2",
    sc="""SELECT product_id, order_date, order_id, order_item_id, requested_quantity,
  received_at, sum(requested_quantity) OVER (PARTITION BY product_id, order_date ORDER BY received_at NULLS LAST, order_id, order_item_id, requested_quantity
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS thru
FROM fct_order_items LEFT JOIN (SELECT order_id, received_at FROM stg_orders JOIN stg_incoming_orders_raw USING (raw_order_id)) USING (order_id)""",
    al="""SELECT sc.*, coalesce(s.stock, 0) AS stk,
  least(greatest(coalesce(s.stock, 0) - (thru - requested_quantity), 0), requested_quantity) AS alloc
FROM sc LEFT JOIN stock s USING (product_id, order_date)""",
)

from .duckdb_sql import KPI  # noqa: E402

EXTRA = {
    "x1_incremental_weekly_fill_rate": KPI["kpi_weekly_fill_rate"].replace(
        "SELECT order_week AS week_start, sum(requested_quantity) AS rq, sum(confirmed_quantity) AS cq FROM fct_order_items GROUP BY 1",
        "SELECT CAST(date_trunc('week', o.order_date) AS DATE) AS week_start, sum(i.requested_quantity) AS rq, "
        "sum(coalesce(i.confirmed_quantity, 0)) AS cq FROM stg_orders o JOIN stg_order_items i ON o.order_id = i.order_id GROUP BY 1"),
    "x2_streaming_daily_on_time": query(
        f"SELECT CAST(scheduled_at AS DATE) AS delivery_date, CAST(count(*) AS BIGINT) AS deliveries, "
        f"CAST(sum({ON_TIME}) AS BIGINT) AS on_time_deliveries FROM stg_deliveries GROUP BY 1"),
    "x2_corrected_deliveries": query(
        f"""SELECT CAST(scheduled_at AS DATE) AS delivery_date, CAST(count(*) AS BIGINT) AS deliveries, CAST(sum({ON_TIME}) AS BIGINT) AS on_time_deliveries
FROM (SELECT * REPLACE (if(delivery_id % 11 = 0, scheduled_at + INTERVAL 1 DAY, scheduled_at) AS scheduled_at,
  if(delivery_id % 7 = 0, 'failed', delivery_status) AS delivery_status) FROM stg_deliveries) GROUP BY 1"""),
    "dq_staging_summary": summary_sql(checks.STAGING_CHECKS),
    "dq_core_summary": summary_sql(checks.CORE_CHECKS),
    "dq_kpi_summary": summary_sql(checks.KPI_CHECKS),
    "dq_confirmed_not_above_requested": query(
        f"SELECT order_item_id, {dbl('requested_quantity')} AS requested_quantity, {dbl('confirmed_quantity')} AS confirmed_quantity "
        f"FROM ({SINGULAR['assert_confirmed_not_above_requested']})"),
    "dq_delivered_has_timestamp": query(SINGULAR["assert_delivered_rows_have_timestamp"]),
    "dq_order_header_mismatch": query(
        f"SELECT order_id, reconciliation_status, CAST(header_total_items AS BIGINT) AS header_total_items, line_count, "
        f"{dbl('header_value_variance')} AS header_value_variance FROM ({SINGULAR['warn_order_header_mismatch']})"),
    "dq_revenue_ties_out": query(
        f"SELECT {dbl('by_market')} AS by_market, {dbl('overview')} AS overview FROM ({SINGULAR['assert_kpi_revenue_ties_out']})"),
    "dq_duplicate_order_lines": query(violations_sql("stg_order_items", "unique_combination", ("order_id", "product_id"))),
    "dq_orphan_product_suppliers": query(violations_sql("stg_products", "relationships", ("supplier_id", "stg_suppliers", "supplier_id"))),
    "dq_invalid_source_channel": query(
        f"SELECT raw_order_id, source_channel FROM stg_incoming_orders_raw WHERE source_channel IS NOT NULL AND source_channel "
        f"NOT IN ({', '.join(_lit(v) for v in SOURCE_CHANNELS)})"),
    "dq_shift_hours_out_of_range": query(
        f"SELECT shift_id, worker_id, {dbl('hours_worked')} AS hours_worked FROM stg_worker_shifts "
        f"WHERE NOT (hours_worked > 0 AND hours_worked <= 24)"),
    "unprocessed_raw_orders": query(
        "SELECT r.raw_order_id, r.customer_name_raw, r.received_at, r.source_channel FROM stg_incoming_orders_raw r "
        "WHERE r.raw_order_id NOT IN (SELECT raw_order_id FROM stg_orders WHERE raw_order_id IS NOT NULL)"),
    "orders_needing_items": query(
        "SELECT o.order_id, o.cleaning_status, o.order_status, CAST(o.total_items AS BIGINT) AS total_items FROM stg_orders o "
        "WHERE o.cleaning_status IN ('clean', 'needs_review') AND o.total_items IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM stg_order_items i WHERE i.order_id = o.order_id)"),
    "deliverable_orders": query(
        "SELECT o.order_id, o.order_status, o.requested_delivery_date, c.customer_name, c.region FROM stg_orders o "
        "JOIN stg_customers c ON o.customer_id = c.customer_id WHERE o.order_status IN ('fulfilled', 'partial', 'shorted') "
        "AND o.requested_delivery_date IS NOT NULL AND NOT EXISTS (SELECT 1 FROM stg_deliveries d WHERE d.order_id = o.order_id)"),
    "active_drivers": query(
        "SELECT worker_id, worker_name, worker_role FROM stg_workers WHERE is_active AND worker_role IN ('driver', 'multi_role')"),
    "resolved_raw_orders": query(
        "SELECT r.raw_order_id, r.customer_name_raw, c.customer_id, r.received_at, r.source_channel, "
        "CAST(r.received_at AS DATE) AS order_date FROM stg_incoming_orders_raw r "
        "JOIN (SELECT customer_name, customer_id FROM stg_customers WHERE is_active) c ON r.customer_name_raw = c.customer_name"),
    "rejected_raw_orders": query(
        "SELECT r.raw_order_id, r.customer_name_raw, r.received_at, r.source_channel, CAST(r.received_at AS DATE) AS order_date "
        "FROM stg_incoming_orders_raw r WHERE NOT EXISTS (SELECT 1 FROM stg_customers c "
        "WHERE c.is_active AND c.customer_name = r.customer_name_raw)"),
    "upsert_inventory": query(
        f"SELECT * REPLACE ({dbl('available_quantity')} AS available_quantity) FROM merged", **UPSERT_CTES),
    "upsert_inventory_outcomes": query(
        "SELECT action, CAST(count(*) AS BIGINT) AS rows FROM merged WHERE action <> 'unchanged' GROUP BY 1", **UPSERT_CTES),
    "status_breakdown_cleaning": query(
        "SELECT lower(trim(cleaning_status)) AS value, CAST(count(*) AS BIGINT) AS rows FROM stg_orders GROUP BY 1"),
    "status_breakdown_items": query(
        "SELECT lower(trim(item_status)) AS value, CAST(count(*) AS BIGINT) AS rows FROM stg_order_items GROUP BY 1"),
    "status_breakdown_deliveries": query(
        "SELECT lower(trim(delivery_status)) AS value, CAST(count(*) AS BIGINT) AS rows FROM stg_deliveries GROUP BY 1"),
    "driver_assignment_counts": query(
        "SELECT w.worker_name, CAST(count(*) AS BIGINT) AS deliveries FROM stg_deliveries d "
        "JOIN stg_workers w ON d.driver_worker_id = w.worker_id GROUP BY 1"),
    "customer_order_history": query(
        f"SELECT customer_id, order_id, order_date, order_status, {dbl('total_value')} AS total_value, "
        "CAST(row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) AS BIGINT) AS order_seq "
        "FROM stg_orders"),
    "x3_stock_allocation": query(
        f"""SELECT order_date, order_id, order_item_id, {dbl('requested_quantity')} AS requested_quantity, product_id, received_at,
  {dbl('stk')} AS stock, {dbl('alloc')} AS allocated_quantity,
  CASE WHEN alloc = requested_quantity THEN 'full' WHEN alloc > 0 THEN 'partial' ELSE 'short' END AS allocation_status FROM al""",
        **ALLOC_CTES),
    "x5_prep_list": query(
        f"SELECT order_item_id, order_id, product_id, product_name, {dbl('confirmed_quantity')} AS quantity_to_prepare, "
        "'pending' AS prep_status, order_date AS prep_date FROM fct_order_items WHERE confirmed_quantity > 0"),
    "x6_labor_by_worker_week": query(
        f"SELECT worker_id, worker_name, CAST(date_trunc('week', shift_date) AS DATE) AS week_start, task_type, "
        f"CAST(count(*) AS BIGINT) AS shifts, {dbl('sum(hours_worked)')} AS hours, {dbl('sum(labor_cost)')} AS labor_cost "
        "FROM fct_worker_shifts GROUP BY 1, 2, 3, 4"),
    "x6_labor_by_order": query(
        f"SELECT related_order_id, CAST(count(DISTINCT worker_id) AS BIGINT) AS workers, {dbl('sum(hours_worked)')} AS hours, "
        f"{dbl('sum(labor_cost)')} AS labor_cost FROM fct_worker_shifts WHERE related_order_id IS NOT NULL GROUP BY 1"),
    "x7_stockout_frequency": query(
        f"""SELECT product_id, product_name, CAST(count(*) AS BIGINT) AS lines, CAST(s AS BIGINT) AS short_lines,
  CAST(z AS BIGINT) AS zero_lines, {pct('s', 'count(*)', 1)} AS stockout_rate_pct
FROM (SELECT *, count(*) FILTER (WHERE confirmed_quantity < requested_quantity) OVER (PARTITION BY product_id, product_name) AS s,
  count(*) FILTER (WHERE confirmed_quantity = 0) OVER (PARTITION BY product_id, product_name) AS z FROM fct_order_items)
GROUP BY product_id, product_name, s, z"""),
    "x7_delivery_bottlenecks": query(
        f"""SELECT weekday, hour, CAST(n AS BIGINT) AS deliveries, CAST(ot AS BIGINT) AS on_time,
  CAST(fc AS BIGINT) AS failed_or_cancelled, {pct('ot', 'n', 1)} AS on_time_pct
FROM (SELECT CAST(dayofweek(scheduled_date) + 1 AS BIGINT) AS weekday, CAST(hour(scheduled_at) AS BIGINT) AS hour,
  count(*) AS n, sum(is_on_time) AS ot, count(*) FILTER (WHERE delivery_status IN ('failed', 'cancelled')) AS fc
  FROM fct_deliveries GROUP BY 1, 2)"""),
    "x8_orders_missing_items": query(
        "SELECT order_id, customer_id, order_date, cleaning_status, CAST(header_total_items AS BIGINT) AS header_total_items "
        "FROM fct_orders WHERE line_count = 0"),
    "merged_inventory_months": query(
        f"SELECT inventory_id, product_id, inventory_date, warehouse_location, strftime(inventory_date, '%Y-%m') AS month, "
        f"{dbl('available_quantity')} AS available_quantity FROM merged", **UPSERT_CTES),
    "customers_loaded_once": query("SELECT customer_id, customer_name, is_active FROM stg_customers WHERE is_active"),
    "resolved_catalog_suppliers": query(
        "SELECT p.product_id, p.product_name, s.supplier_name, s.supplier_id FROM stg_products p JOIN stg_suppliers s ON s.supplier_id = p.supplier_id"),
    "unresolved_catalog_suppliers": query(
        "SELECT product_id, product_name, 'Supplier#' || lpad(CAST(supplier_id AS VARCHAR), 9, '0') AS supplier_name FROM stg_products "
        "WHERE supplier_id IS NOT NULL AND supplier_id NOT IN (SELECT supplier_id FROM stg_suppliers)"),
    "dq_overconfirmed_lines": query(
        f"SELECT order_item_id, {dbl('requested_quantity')} AS requested_quantity, {dbl('requested_quantity + 1')} AS confirmed_quantity "
        "FROM fct_order_items WHERE order_id % 50 = 0"),
    "fct_orders_corrected_headers": query(
        f"""SELECT order_id, raw_order_id, customer_id, order_date, requested_delivery_date, order_status, cleaning_status,
  CAST(if(fix, line_count, header_total_items) AS BIGINT) AS header_total_items,
  {dbl('if(fix, line_requested_value, header_total_value)')} AS header_total_value, line_count,
  {dbl('line_requested_value')} AS line_requested_value, {dbl('confirmed_revenue')} AS confirmed_revenue, fill_rate_pct,
  {dbl('if(fix, 0, header_value_variance)')} AS header_value_variance, if(fix, 'reconciled', reconciliation_status) AS reconciliation_status
FROM (SELECT *, order_id % 5 = 0 AND line_count > 0 AS fix FROM fct_orders)"""),
}
EXTRA |= {
    "x7_overdue_deliveries": query(
        """SELECT driver_worker_id, driver_name, CAST(n_late AS BIGINT) AS late_deliveries, CAST(peak AS BIGINT) AS peak_overdue, peak_at FROM
  (SELECT driver_worker_id, driver_name, count(*) AS n_late FROM late GROUP BY 1, 2) JOIN
  (SELECT driver_worker_id, max(n_open) AS peak, min(moment) FILTER (WHERE n_open = top) AS peak_at
   FROM (SELECT *, max(n_open) OVER (PARTITION BY driver_worker_id) AS top FROM swept) GROUP BY 1) USING (driver_worker_id)""",
        late="SELECT * FROM fct_deliveries WHERE driver_worker_id IS NOT NULL AND delivered_at > scheduled_at",
        steps="SELECT driver_worker_id, scheduled_at AS moment, 1 AS step FROM late UNION ALL SELECT driver_worker_id, delivered_at, -1 FROM late",
        swept="SELECT driver_worker_id, moment, sum(sum(step)) OVER (PARTITION BY driver_worker_id ORDER BY moment) AS n_open FROM steps GROUP BY 1, 2"),
    "x7_stockout_runs": query(
        f"""SELECT product_id, product_name, min(order_date) AS run_start, max(order_date) AS run_end, CAST(count(*) AS BIGINT) AS days,
  {dbl('sum(rq - cq)')} AS shortage_quantity FROM
  (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY order_date) - row_number() OVER (PARTITION BY product_id, cq < rq ORDER BY order_date) AS island FROM d)
WHERE cq < rq GROUP BY product_id, product_name, island""",
        d="""SELECT product_id, product_name, order_date, sum(requested_quantity) AS rq, sum(confirmed_quantity) AS cq
FROM fct_order_items GROUP BY 1, 2, 3"""),
    "x8_duplicate_orders": query(
        """SELECT * FROM (SELECT order_id, min(order_id) OVER (PARTITION BY customer_id, order_date, lines) AS duplicate_of, customer_id, order_date,
  CAST(len(lines) AS BIGINT) AS line_count FROM heads JOIN sorted_lines USING (order_id)) WHERE order_id <> duplicate_of""",
        heads="""SELECT DISTINCT order_id, customer_id, order_date FROM stg_orders UNION ALL
SELECT DISTINCT -order_id, customer_id, if(order_id % 50 = 10, order_date + 1, order_date) FROM stg_orders WHERE order_id % 50 IN (0, 10, 25)""",
        every_line="""SELECT order_id, product_id, requested_quantity, unit_price FROM stg_order_items UNION ALL
SELECT -order_id, product_id, requested_quantity, if(order_id % 50 = 25, unit_price + 1, unit_price) FROM stg_order_items WHERE order_id % 50 IN (0, 10, 25)""",
        sorted_lines="""SELECT order_id, list_sort(list(CAST(product_id AS VARCHAR) || '/' || CAST(requested_quantity AS VARCHAR) || '/' || CAST(CAST(unit_price AS DECIMAL(12,2)) AS VARCHAR))) AS lines
FROM every_line GROUP BY 1"""),
    "resolved_raw_orders_fuzzy": query(
        """SELECT raw_order_id, customer_name_raw, CAST(received_at AS DATE) AS order_date,
  CASE WHEN e.customer_id IS NOT NULL THEN e.customer_id WHEN b.near = 1 THEN b.customer_id END AS customer_id,
  CASE WHEN e.customer_id IS NOT NULL THEN lower(trim(customer_name_raw)) ELSE b.target END AS matched_name,
  CAST(CASE WHEN e.customer_id IS NOT NULL THEN 0 ELSE b.distance END AS BIGINT) AS distance,
  CASE WHEN e.customer_id IS NOT NULL THEN 'exact' WHEN b.near = 1 THEN 'fuzzy' WHEN b.near > 1 THEN 'review' ELSE 'unknown' END AS resolution
FROM raw_names LEFT JOIN (SELECT customer_name, min(customer_id) AS customer_id FROM stg_customers WHERE is_active GROUP BY 1) e ON e.customer_name = customer_name_raw
LEFT JOIN best b ON b.name = lower(trim(customer_name_raw))""",
        raw_names="""SELECT * REPLACE (CASE raw_order_id % 45 WHEN 1 THEN substr(customer_name_raw, 1, 2) || substr(customer_name_raw, 4)
  WHEN 2 THEN upper(customer_name_raw) WHEN 3 THEN 'K' || substr(customer_name_raw, 2, 2) || 'x' || substr(customer_name_raw, 5)
  WHEN 4 THEN substr(customer_name_raw, 1, length(customer_name_raw) - 1) WHEN 5 THEN 'Walk-in ' || raw_order_id ELSE customer_name_raw END AS customer_name_raw)
FROM stg_incoming_orders_raw""",
        masters="SELECT lower(trim(customer_name)) AS target, min(customer_id) AS customer_id FROM stg_customers WHERE is_active GROUP BY 1",
        strange="""SELECT DISTINCT lower(trim(customer_name_raw)) AS name FROM raw_names
WHERE customer_name_raw NOT IN (SELECT customer_name FROM stg_customers WHERE is_active) AND trim(customer_name_raw) <> ''""",
        pairs="""SELECT * FROM (SELECT name, target, customer_id, levenshtein(name, target) AS distance FROM strange JOIN masters
  ON abs(length(name) - length(target)) <= 2) WHERE distance <= CASE WHEN length(name) < 4 THEN 0 WHEN length(name) < 8 THEN 1 ELSE 2 END""",
        best="""SELECT name, distance, min(target) AS target, min_by(customer_id, target) AS customer_id, count(*) AS near FROM pairs
WHERE distance = (SELECT min(distance) FROM pairs p WHERE p.name = pairs.name) GROUP BY 1, 2"""),
    "weekly_customers": query(
        """SELECT order_week AS week_start, market_type, CAST(count(DISTINCT customer_id) FILTER (WHERE of_week = order_week) AS BIGINT) AS customers,
  CAST(count(DISTINCT customer_id) AS BIGINT) AS customers_rolling
FROM (SELECT DISTINCT order_week, market_type FROM f) JOIN (SELECT order_week AS of_week, market_type, customer_id FROM f) USING (market_type)
WHERE of_week BETWEEN order_week - 21 AND order_week GROUP BY 1, 2""",
        f="""SELECT DISTINCT order_week, market_type, customer_id FROM fct_order_items UNION ALL
SELECT DISTINCT order_week, 'all', customer_id FROM fct_order_items"""),
    "bucketed_order_fulfilment": query(
        f"""SELECT order_id, order_status, order_date, CAST(n AS BIGINT) AS line_count, {dbl('rq')} AS requested_quantity, {dbl('cq')} AS confirmed_quantity,
  CAST(coalesce(m, 0) AS BIGINT) AS deliveries, last_delivered_at FROM stg_orders
JOIN (SELECT order_id, count(*) AS n, sum(requested_quantity) AS rq, sum(coalesce(confirmed_quantity, 0)) AS cq FROM stg_order_items GROUP BY 1) USING (order_id)
LEFT JOIN (SELECT order_id, count(*) AS m, max(delivered_at) AS last_delivered_at FROM stg_deliveries GROUP BY 1) USING (order_id)"""),
    "customer_history_lookup": query(
        f"""SELECT customer_id, order_id, order_date, order_status, {dbl('total_value')} AS total_value FROM stg_orders
WHERE customer_id IN (SELECT customer_id FROM stg_customers WHERE customer_id % 100 = 0)"""),
    "loaded_tables": query(" UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS rows_reported, CAST(count(*) AS BIGINT) AS rows_read FROM {model}"
        for name, model in (("customers", "raw_customers"), ("suppliers", "raw_suppliers"), ("workers", "raw_workers"), ("products", "raw_products"),
                            ("inventory", "raw_inventory"), ("incoming_orders_raw", "raw_incoming_orders"), ("orders_cleaned", "raw_orders"),
                            ("order_items", "raw_order_items"), ("prep_lists", "raw_prep_lists"), ("deliveries", "raw_deliveries"), ("worker_shifts", "raw_worker_shifts")))),
    "exported_customers": query("SELECT customer_id, customer_name, market_type, region, signup_date, is_active FROM raw_customers"),
    "built_marts": query(f"""SELECT check_name, severity, status, violations FROM (
{summary_sql([*checks.STAGING_CHECKS, *checks.CORE_CHECKS, *checks.KPI_CHECKS])}) WHERE status <> 'pass'"""),
    "dq_stale_market_split": query(
        f"""SELECT {dbl('by_market')} AS by_market, {dbl('overview')} AS overview FROM (SELECT
  (SELECT sum(round(rev, 2)) FROM (SELECT sum(confirmed_revenue) AS rev FROM fct_order_items WHERE order_date < DATE '2001-07-01' GROUP BY market_type)) AS by_market,
  (SELECT round(sum(confirmed_revenue), 2) FROM fct_order_items) AS overview)"""),
}
for _same in ("x7_overdue_deliveries", "x7_stockout_runs"):
    EXTRA[f"{_same}_distributed"] = EXTRA[_same]
for _same in ("kpi_customer_revenue", "kpi_product_demand", "kpi_driver_productivity"):
    EXTRA[f"{_same}_distributed"] = KPI[_same]
for _same in ("customer_order_history", "x3_stock_allocation"):
    EXTRA[f"{_same}_distributed"] = EXTRA[_same]

