"""Oracle SQL (DuckDB dialect) for every registered query.

The harness registers the TPC-H-like tables as views; the CTEs below re-derive the
operational tables with the same expressions as ``greenlane.sources.adapters``,
then the staging and core models, and each query selects from them. Results are
cast to the exchange types used by ``__spark_entry__``: counts/ranks BIGINT,
decimals DOUBLE, dates DATE.

Rounding: percentages and rounded averages are computed with integer arithmetic
(HUGEINT) so that half-up ties are decided exactly, as the Spark side does with
decimals; DuckDB's DOUBLE division would misplace some ties.
"""

from __future__ import annotations


def u(x: str) -> str:
    """Exact integer in units of 1e-4 (every decimal here has scale <= 4)."""
    return f"CAST(({x}) * 10000 AS HUGEINT)"


def dbl(x: str) -> str:
    """Decimal -> correctly rounded DOUBLE (exact integer / power of ten)."""
    return f"(CAST({u(x)} AS DOUBLE) / 10000)"


def rdiv(n: str, d: str, k: int, mult: int = 1) -> str:
    """ROUND(n * mult / d, k) half away from zero, exactly; n and d are HUGEINT in the same units."""
    return (f"(CASE WHEN ({d}) IS NULL OR ({d}) = 0 OR ({n}) IS NULL THEN NULL ELSE "
            f"CAST(sign({n}) * sign({d}) * ((2 * abs({n}) * {mult * 10**k} + abs({d})) // (2 * abs({d}))) AS DOUBLE)"
            f" / {10**k} END)")


def pct(num: str, den: str, k: int = 2) -> str:
    return rdiv(u(num), u(den), k, 100)


def rnd(x: str, k: int = 2) -> str:
    return rdiv(u(x), "10000", k)


def rate14(num: str, den: str) -> str:
    """num*100.0/den as Spark's DECIMAL(38,14) (half-up at 14 decimals), as an integer in 1e-14 units."""
    n, d = u(num), u(den)
    return (f"(CASE WHEN ({d}) IS NULL OR ({d}) = 0 THEN NULL ELSE "
            f"sign({n}) * sign({d}) * ((2 * abs({n}) * {100 * 10**14} + abs({d})) // (2 * abs({d}))) END)")


NR = "(SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"
NSUPP = "(SELECT count(*) FROM supplier)"

QTY = "CAST(l_quantity AS INTEGER)"
CONFIRMED = (f"CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL "
             f"WHEN l_returnflag = 'R' THEN CAST({QTY} - ({QTY} * CAST(round(l_discount * 100) AS INTEGER)) // 10 AS DECIMAL(10,2)) "
             f"ELSE CAST(l_quantity AS DECIMAL(10,2)) END")
UNIT_PRICE = (f"CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // {QTY} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2))")
SCHED = "(o_orderdate + to_days(CAST(o_orderkey % 3 + 1 AS INTEGER)) + to_hours(CAST(o_orderkey % 10 + 8 AS BIGINT)))"
DELIVERED = "(o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 4 = 3))"

ADAPTERS = {
    "raw_customers": f"""
SELECT c_custkey AS customer_id, c_name AS customer_name,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Restaurant' WHEN 'BUILDING' THEN ' grocery' WHEN 'FURNITURE' THEN 'WHOLESALE'
    WHEN 'HOUSEHOLD' THEN 'Individual ' WHEN 'MACHINERY' THEN 'distributor' ELSE 'other' END AS market_type,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE nr.r_name END AS region,
  DATE '2020-01-01' + CAST(c_custkey % 1461 AS INTEGER) AS signup_date,
  c_custkey % 13 <> 0 AS is_active,
  CAST(DATE '2020-01-01' + CAST(c_custkey % 1461 AS INTEGER) AS TIMESTAMP) AS created_at,
  CAST(DATE '2020-01-01' + CAST(c_custkey % 1461 AS INTEGER) AS TIMESTAMP) AS updated_at
FROM customer LEFT JOIN {NR} nr ON c_nationkey = nr.n_nationkey""",
    "raw_suppliers": f"""
SELECT s_suppkey AS supplier_id, s_name AS supplier_name, nr.r_name AS supplier_region,
  CASE s_nationkey % 4 WHEN 0 THEN 'Own_Farm' WHEN 1 THEN 'external_farm' WHEN 2 THEN 'Distributor' ELSE 'wholesale_market' END AS supplier_type,
  s_nationkey % 2 = 0 AS is_local, s_suppkey % 17 <> 0 AS is_active
FROM supplier LEFT JOIN {NR} nr ON s_nationkey = nr.n_nationkey""",
    "raw_workers": """
SELECT s_suppkey AS worker_id, 'Worker#' || substr(s_name, 10, 64) AS worker_name,
  CASE s_suppkey % 4 WHEN 0 THEN 'Driver' WHEN 1 THEN 'prep' WHEN 2 THEN 'multi_role' ELSE 'Supervisor' END AS role,
  DATE '2015-01-01' + CAST(s_suppkey % 2000 AS INTEGER) AS hire_date, s_suppkey % 19 <> 0 AS is_active
FROM supplier""",
    "raw_products": f"""
SELECT p_partkey AS product_id, p_name AS product_name, lower(p_type) AS category,
  CASE p_size % 3 WHEN 0 THEN 'lb' WHEN 1 THEN 'case' ELSE 'bunch' END AS unit,
  CAST(p_retailprice AS DECIMAL(10,2)) AS standard_price,
  CASE p_size % 3 WHEN 0 THEN 'Own_Farm' WHEN 1 THEN 'outsourced' ELSE ' Mixed' END AS source_type,
  CASE WHEN p_size % 3 = 2 THEN NULL ELSE p_partkey % ({NSUPP} + 1) END AS supplier_id,
  p_partkey % 11 <> 0 AS is_active
FROM part""",
    "raw_inventory": """
SELECT event_id AS inventory_id, user_id AS product_id, CAST(ts AS DATE) AS inventory_date,
  CAST(value AS DECIMAL(10,2)) AS available_quantity, event_type AS warehouse_location
FROM events""",
    "raw_orders": """
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderkey END AS raw_order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 + 1 AS INTEGER) END AS requested_delivery_date,
  CASE WHEN o_orderkey % 50 = 7 THEN 'Cancelled' WHEN o_orderstatus = 'F' THEN 'Fulfilled'
    WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'partial' ELSE 'SHORTED' END
    ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'pending' ELSE 'Confirmed ' END END AS order_status,
  CASE o_orderkey % 10 WHEN 0 THEN 'needs_review' WHEN 1 THEN 'Incomplete' WHEN 2 THEN 'rejected' ELSE 'clean' END AS cleaning_status,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE CAST(o_orderkey % 7 + 1 AS INTEGER) END AS total_items,
  CAST(o_totalprice AS DECIMAL(10,2)) AS total_value, CAST(NULL AS VARCHAR) AS notes
FROM orders""",
    "raw_order_items": f"""
SELECT l_orderkey * 100 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
  CAST(l_quantity AS DECIMAL(10,2)) AS requested_quantity, {CONFIRMED} AS confirmed_quantity, {UNIT_PRICE} AS unit_price,
  CASE WHEN ({CONFIRMED}) IS NULL THEN 'Pending' WHEN ({CONFIRMED}) = 0 THEN 'shorted'
    WHEN ({CONFIRMED}) < CAST(l_quantity AS DECIMAL(10,2)) THEN 'Partial' ELSE 'fulfilled ' END AS item_status
FROM lineitem""",
    "raw_prep_lists": f"""
SELECT l_orderkey * 100 + l_linenumber AS prep_id, l_orderkey AS order_id, l_partkey AS product_id,
  {CONFIRMED} AS quantity_to_prepare,
  CASE l_linenumber % 5 WHEN 0 THEN 'Pending' WHEN 1 THEN 'assigned' WHEN 2 THEN 'In_Progress' WHEN 3 THEN 'completed' ELSE 'cancelled' END AS prep_status,
  CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE l_suppkey END AS assigned_worker_id,
  CAST(l_shipdate AS DATE) - 1 AS prep_date
FROM lineitem WHERE ({CONFIRMED}) > 0""",
    "raw_deliveries": f"""
SELECT o_orderkey AS delivery_id, o_orderkey AS order_id, {SCHED} AS scheduled_delivery_time,
  CASE WHEN NOT {DELIVERED} OR o_orderkey % 97 = 0 THEN NULL
    WHEN o_orderkey % 5 = 0 THEN {SCHED} + to_days(1)
    WHEN o_orderkey % 5 = 1 THEN {SCHED} - to_hours(CAST(20 AS BIGINT))
    ELSE {SCHED} + to_hours(CAST(o_orderkey % 3 AS BIGINT)) END AS actual_delivery_time,
  CASE WHEN o_orderstatus = 'F' THEN 'Delivered'
    WHEN o_orderstatus = 'P' THEN CASE o_orderkey % 4 WHEN 0 THEN 'failed' WHEN 1 THEN 'Cancelled' WHEN 2 THEN 'in_transit' ELSE 'delivered' END
    ELSE 'scheduled' END AS delivery_status,
  CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_custkey % {NSUPP} END AS driver_worker_id,
  'Address ' || CAST(o_custkey AS VARCHAR) AS delivery_address
FROM orders WHERE (o_orderstatus <> 'O' OR o_orderkey % 3 = 0) AND o_orderkey % 13 <> 0""",
    "raw_worker_shifts": """
SELECT l_orderkey * 100 + l_linenumber AS shift_id, l_suppkey AS worker_id, CAST(l_shipdate AS DATE) AS shift_date,
  CASE l_linenumber % 6 WHEN 0 THEN 'Prep' WHEN 1 THEN 'delivery' WHEN 2 THEN 'Cleaning ' WHEN 3 THEN 'inventory' WHEN 4 THEN 'ADMIN' ELSE 'other' END AS task_type,
  CAST(l_quantity / 2 AS DECIMAL(5,2)) AS hours_worked, CAST(l_linenumber + 15 AS DECIMAL(10,2)) AS hourly_rate,
  l_orderkey AS related_order_id, CAST(NULL AS VARCHAR) AS notes
FROM lineitem""",
}

ADAPTERS["raw_incoming_orders"] = """
SELECT o.o_orderkey AS raw_order_id,
  CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN o.o_orderkey % 17 = 0 THEN c.c_name || ' ' ELSE c.c_name END AS customer_name_raw,
  o.o_orderpriority AS order_text,
  o.o_orderdate + to_hours(CAST(o.o_orderkey % 12 + 6 AS BIGINT)) AS received_timestamp,
  CASE WHEN o.o_orderkey % 37 = 0 THEN 'SMS' ELSE CASE o.o_orderkey % 5 WHEN 0 THEN 'text' WHEN 1 THEN 'Email'
    WHEN 2 THEN 'spreadsheet' WHEN 3 THEN 'phone' ELSE 'in_person' END END AS source_channel,
  CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE 'intake desk' END AS entered_by
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey"""

STAGING = {
    "stg_incoming_orders_raw": """SELECT raw_order_id, customer_name_raw, order_text, received_timestamp AS received_at,
  lower(trim(source_channel)) AS source_channel, entered_by FROM raw_incoming_orders""",
    "stg_customers": """SELECT customer_id, trim(customer_name) AS customer_name, lower(trim(market_type)) AS market_type, region,
  signup_date, is_active, created_at, updated_at FROM raw_customers""",
    "stg_suppliers": """SELECT supplier_id, trim(supplier_name) AS supplier_name, supplier_region,
  lower(trim(supplier_type)) AS supplier_type, is_local, is_active FROM raw_suppliers""",
    "stg_workers": """SELECT worker_id, trim(worker_name) AS worker_name, lower(trim(role)) AS worker_role, hire_date, is_active
  FROM raw_workers""",
    "stg_products": """SELECT product_id, trim(product_name) AS product_name, category, unit, standard_price,
  lower(trim(source_type)) AS source_type, supplier_id, is_active FROM raw_products""",
    "stg_inventory": "SELECT inventory_id, product_id, inventory_date, available_quantity, warehouse_location FROM raw_inventory",
    "stg_orders": """SELECT order_id, raw_order_id, customer_id, order_date, requested_delivery_date,
  lower(trim(order_status)) AS order_status, lower(trim(cleaning_status)) AS cleaning_status, total_items, total_value, notes
  FROM raw_orders""",
    "stg_order_items": """SELECT order_item_id, order_id, product_id, requested_quantity, confirmed_quantity, unit_price,
  lower(trim(item_status)) AS item_status FROM raw_order_items""",
    "stg_prep_lists": """SELECT prep_id, order_id, product_id, quantity_to_prepare, lower(trim(prep_status)) AS prep_status,
  assigned_worker_id, prep_date FROM raw_prep_lists""",
    "stg_deliveries": """SELECT delivery_id, order_id, scheduled_delivery_time AS scheduled_at, actual_delivery_time AS delivered_at,
  lower(trim(delivery_status)) AS delivery_status, driver_worker_id, delivery_address FROM raw_deliveries""",
    "stg_worker_shifts": """SELECT shift_id, worker_id, shift_date, lower(trim(task_type)) AS task_type, hours_worked, hourly_rate,
  related_order_id, notes FROM raw_worker_shifts""",
}

ON_TIME = ("CASE WHEN delivery_status = 'delivered' AND CAST(delivered_at AS DATE) = CAST(scheduled_at AS DATE) "
           "THEN 1 ELSE 0 END")

CORE = {
    # a line counts where its product, its order and the order's customer exist; undecided means 0
    "fct_order_items": """
SELECT order_item_id, order_id, order_date, order_date - CAST(isodow(order_date) - 1 AS INTEGER) AS order_week, order_status,
  customer_id, customer_name, market_type, product_id, product_name, category, source_type, item_status, requested_quantity,
  kept AS confirmed_quantity, requested_quantity - kept AS shortage_quantity, unit_price,
  unit_price * kept AS confirmed_revenue, unit_price * requested_quantity AS requested_value
FROM (SELECT *, if(confirmed_quantity IS NULL, 0, confirmed_quantity) AS kept FROM stg_order_items)
JOIN (SELECT product_id, product_name, category, source_type FROM stg_products) USING (product_id)
JOIN (SELECT order_id, order_date, order_status, customer_id, customer_name, market_type
  FROM stg_orders JOIN stg_customers USING (customer_id)) USING (order_id)""",
    "fct_deliveries": f"""
SELECT d.delivery_id, d.order_id, CAST(d.scheduled_at AS DATE) AS scheduled_date, d.scheduled_at, d.delivered_at,
  d.delivery_status, d.driver_worker_id, w.worker_name AS driver_name, w.worker_role AS driver_role, {ON_TIME} AS is_on_time
FROM stg_deliveries d LEFT JOIN stg_workers w ON d.driver_worker_id = w.worker_id""",
    # the first test that a header fails names its status
    "fct_orders": f"""
SELECT order_id, raw_order_id, customer_id, order_date, requested_delivery_date, order_status, cleaning_status,
  total_items AS header_total_items, total_value AS header_total_value, n AS line_count, rv AS line_requested_value,
  cr AS confirmed_revenue, {pct('cq', 'rq')} AS fill_rate_pct, total_value - rv AS header_value_variance,
  coalesce(if(total_items IS NULL, 'no_header_total', NULL), if(total_items <> n, 'item_count_mismatch', NULL),
    if(abs(total_value - rv) > 0.01, 'value_mismatch', NULL), 'reconciled') AS reconciliation_status
FROM (SELECT o.*, count(f.order_id) AS n, coalesce(sum(f.requested_value), 0) AS rv, coalesce(sum(f.confirmed_revenue), 0) AS cr,
    sum(f.confirmed_quantity) AS cq, sum(f.requested_quantity) AS rq
  FROM stg_orders o LEFT JOIN fct_order_items f ON f.order_id = o.order_id GROUP BY ALL)""",
    "fct_worker_shifts": """
SELECT s.shift_id, s.worker_id, w.worker_name, w.worker_role, s.shift_date, s.task_type, s.hours_worked, s.hourly_rate,
  s.hours_worked * s.hourly_rate AS labor_cost, s.related_order_id
FROM stg_worker_shifts s JOIN stg_workers w ON s.worker_id = w.worker_id""",
    "dim_products": """
SELECT p.product_id, p.product_name, p.category, p.unit, p.standard_price, p.source_type, p.supplier_id, s.supplier_name,
  s.supplier_type, s.is_local AS is_local_supplier, p.is_active
FROM stg_products p LEFT JOIN stg_suppliers s ON p.supplier_id = s.supplier_id""",
}

CORE["dim_workers"] = "SELECT worker_id, worker_name, worker_role, hire_date, is_active FROM stg_workers"
CORE["dim_customers"] = """SELECT c.customer_id, c.customer_name, c.market_type, c.region, c.signup_date, c.is_active,
  count(DISTINCT f.order_id) AS lifetime_orders, coalesce(sum(f.confirmed_revenue), 0) AS lifetime_revenue,
  min(f.order_date) AS first_order_date, max(f.order_date) AS last_order_date
FROM stg_customers c LEFT JOIN fct_order_items f ON f.customer_id = c.customer_id GROUP BY ALL"""

CTES = {**ADAPTERS, **STAGING, **CORE}


def with_ctes(body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    return f"WITH {ctes}\n{body}"


def exchange(src: str, decimals: tuple[str, ...] = (), ints: tuple[str, ...] = ()) -> str:
    repl = [f"{dbl(c)} AS {c}" for c in decimals] + [f"CAST({c} AS BIGINT) AS {c}" for c in ints]
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM {src}" if repl else f"SELECT * FROM {src}"


def query(body: str, **extra: str) -> str:
    """Full oracle statement: shared CTEs + query-local CTEs + body."""
    ctes = {**CTES, **extra}
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes.items()) + "\n" + body


W4 = "(ORDER BY week_start ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"
W7 = "(ORDER BY delivery_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"


def _avg_rate(col: str, window: str) -> str:
    return rdiv(f"sum({col}) OVER {window}", f"CAST(count({col}) OVER {window} AS HUGEINT) * {10**14}", 2)


def _weekly_fill(src: str, rq: str, cq: str, names: tuple[str, str, str, str, str]) -> str:
    wk, rqn, cqn, rate, avg = names[0], names[1], names[2], names[3], names[4]
    return f"""SELECT week_start{', ' + dbl(rq) + ' AS ' + rqn if rqn else ''}{', ' + dbl(cq) + ' AS ' + cqn if cqn else ''},
  {pct(cq, rq)} AS {rate}, {_avg_rate('r14', W4)} AS {avg}
  {', ' + pct(f'sum({cq}) OVER {W4}', f'sum({rq}) OVER {W4}') + ' AS rolling_4wk_fill_rate_pct' if wk else ''}
FROM (SELECT *, {rate14(cq, rq)} AS r14 FROM {src})"""


KPI = {
    "kpi_overview": query(f"""SELECT CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
  {rnd('sum(confirmed_revenue)')} AS total_confirmed_revenue,
  {pct('sum(confirmed_quantity)', 'sum(requested_quantity)')} AS overall_fill_rate_pct FROM fct_order_items"""),
    "kpi_weekly_orders": query(f"""SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start,
  CAST(count(*) AS BIGINT) AS orders, {rnd('sum(confirmed_revenue)')} AS weekly_revenue FROM fct_orders GROUP BY 1"""),
    "kpi_weekly_fill_rate": query(
        _weekly_fill("weekly", "rq", "cq", ("wk", "requested_quantity", "confirmed_quantity", "weekly_fill_rate_pct",
                                              "rolling_4wk_avg_pct")),
        weekly="SELECT order_week AS week_start, sum(requested_quantity) AS rq, sum(confirmed_quantity) AS cq "
               "FROM fct_order_items GROUP BY 1"),
    "kpi_daily_on_time_delivery": query(
        f"""SELECT delivery_date, CAST(n AS BIGINT) AS deliveries, CAST(ot AS BIGINT) AS on_time_deliveries,
  {pct('ot', 'n', 1)} AS on_time_pct, {pct(f'sum(ot) OVER {W7}', f'sum(n) OVER {W7}', 1)} AS rolling_7day_on_time_pct FROM daily""",
        daily="SELECT scheduled_date AS delivery_date, count(*) AS n, sum(is_on_time) AS ot FROM fct_deliveries GROUP BY 1"),
    "kpi_driver_productivity": query(
        f"""SELECT driver_worker_id, driver_name, driver_role, CAST(total AS BIGINT) AS total_deliveries,
  CAST(ot AS BIGINT) AS on_time_deliveries, {pct('ot', 'total', 1)} AS on_time_pct,
  CAST(rank() OVER (ORDER BY total DESC) AS BIGINT) AS volume_rank,
  CAST(rank() OVER (ORDER BY CAST(ot AS DOUBLE) / total DESC) AS BIGINT) AS reliability_rank FROM stats""",
        stats="SELECT driver_worker_id, driver_name, driver_role, count(*) AS total, sum(is_on_time) AS ot "
              "FROM fct_deliveries WHERE driver_worker_id IS NOT NULL GROUP BY 1, 2, 3"),
    "kpi_customer_revenue": query(
        f"""SELECT customer_id, customer_name, market_type, CAST(order_count AS BIGINT) AS order_count,
  {rnd('revenue')} AS revenue, CAST(overall_rank AS BIGINT) AS overall_rank, CAST(rwm AS BIGINT) AS rank_within_market,
  CAST(q AS BIGINT) AS revenue_quartile,
  CASE q WHEN 1 THEN 'Top 25%' WHEN 2 THEN 'Upper mid' WHEN 3 THEN 'Lower mid' ELSE 'Bottom 25%' END AS revenue_segment,
  {pct('running', 'total', 1)} AS cumulative_revenue_pct FROM rk""",
        cr="SELECT customer_id, customer_name, market_type, count(DISTINCT order_id) AS order_count, "
           "sum(confirmed_revenue) AS revenue FROM fct_order_items GROUP BY 1, 2, 3",
        rk="SELECT *, rank() OVER (ORDER BY revenue DESC) AS overall_rank, "
           "rank() OVER (PARTITION BY market_type ORDER BY revenue DESC) AS rwm, "
           "ntile(4) OVER (ORDER BY revenue DESC, customer_id) AS q, "
           "sum(revenue) OVER (ORDER BY revenue DESC, customer_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running, "
           "sum(revenue) OVER () AS total FROM cr"),
    "kpi_revenue_by_market": query(
        f"""SELECT market_type, CAST(cc AS BIGINT) AS customer_count, CAST(oc AS BIGINT) AS order_count,
  {rnd('rev')} AS revenue, {pct('rev', 'sum(rev) OVER ()', 1)} AS pct_of_total_revenue FROM bm""",
        bm="SELECT market_type, count(DISTINCT customer_id) AS cc, count(DISTINCT order_id) AS oc, "
           "sum(confirmed_revenue) AS rev FROM fct_order_items GROUP BY 1"),
    "kpi_product_demand": query(
        f"""SELECT product_id, product_name, category, source_type, {dbl('tr')} AS total_requested,
  {dbl('tc')} AS total_confirmed, {dbl('sh')} AS shortage, {pct('sh', 'tr', 1)} AS shortage_rate_pct,
  CAST(rank() OVER (ORDER BY tr DESC) AS BIGINT) AS demand_rank, CAST(rank() OVER (ORDER BY sh DESC) AS BIGINT) AS shortage_rank
FROM ps""",
        ps="SELECT product_id, product_name, category, source_type, sum(requested_quantity) AS tr, "
           "sum(confirmed_quantity) AS tc, sum(shortage_quantity) AS sh FROM fct_order_items GROUP BY 1, 2, 3, 4"),
    "kpi_source_type_fill_rate": query(
        f"""SELECT source_type, CAST(count(DISTINCT product_id) AS BIGINT) AS product_count,
  {dbl('sum(requested_quantity)')} AS total_requested, {dbl('sum(confirmed_quantity)')} AS total_confirmed,
  {pct('sum(confirmed_quantity)', 'sum(requested_quantity)')} AS fill_rate_pct FROM fct_order_items GROUP BY 1"""),
    "kpi_weekly_inventory": query(
        f"""SELECT CAST(date_trunc('week', i.inventory_date) AS DATE) AS week_start, p.category,
  {dbl('sum(i.available_quantity)')} AS total_on_hand,
  {rdiv(u('sum(i.available_quantity)'), 'CAST(count(i.available_quantity) AS HUGEINT) * 10000', 2)} AS avg_per_snapshot
FROM stg_inventory i JOIN dim_products p ON i.product_id = p.product_id GROUP BY 1, 2"""),
}

LINE_REV = "coalesce(confirmed_quantity, 0) * unit_price"
CUST_REV = ("SELECT c.customer_id, c.customer_name, c.market_type, sum(coalesce(i.confirmed_quantity, 0) * i.unit_price) AS revenue, "
            "count(DISTINCT o.order_id) AS order_count FROM stg_orders o JOIN stg_order_items i ON o.order_id = i.order_id "
            "JOIN stg_customers c ON o.customer_id = c.customer_id GROUP BY 1, 2, 3")
ON_TIME_STG = ON_TIME

SQL_FILE = {
    "q01_total_orders": query("SELECT CAST(count(*) AS BIGINT) AS total_orders FROM stg_orders"),
    "q02_confirmed_revenue": query(f"SELECT {dbl(f'sum({LINE_REV})')} AS total_revenue FROM stg_order_items"),
    "q03_weekly_order_trend": query(f"""SELECT CAST(date_trunc('week', order_date) AS DATE) AS week_start,
  CAST(count(*) AS BIGINT) AS orders, {dbl('sum(coalesce(total_value, 0))')} AS weekly_revenue FROM stg_orders GROUP BY 1"""),
    "q04_overall_fill_rate": query(
        f"SELECT {pct('sum(coalesce(confirmed_quantity, 0))', 'sum(requested_quantity)')} AS overall_fill_rate_pct FROM stg_order_items"),
    "q05_weekly_fill_rate": query(
        _weekly_fill("weekly", "rq", "cq", ("", "", "", "weekly_fill_rate", "rolling_4wk_avg")),
        weekly="SELECT CAST(date_trunc('week', o.order_date) AS DATE) AS week_start, sum(i.requested_quantity) AS rq, "
               "sum(coalesce(i.confirmed_quantity, 0)) AS cq FROM stg_orders o JOIN stg_order_items i ON o.order_id = i.order_id GROUP BY 1"),
    "q06_daily_on_time": query(
        f"""SELECT delivery_date, CAST(n AS BIGINT) AS total, CAST(ot AS BIGINT) AS on_time, {pct('ot', 'n', 1)} AS on_time_pct,
  {pct(f'sum(ot) OVER {W7}', f'sum(n) OVER {W7}', 1)} AS rolling_7day_on_time_pct FROM daily""",
        daily=f"SELECT CAST(scheduled_at AS DATE) AS delivery_date, count(*) AS n, sum({ON_TIME_STG}) AS ot FROM stg_deliveries GROUP BY 1"),
    "q07_driver_productivity": query(
        f"""SELECT worker_name, role, CAST(total AS BIGINT) AS total_deliveries, {pct('ot', 'total', 1)} AS on_time_pct,
  CAST(rank() OVER (ORDER BY total DESC) AS BIGINT) AS volume_rank FROM ds""",
        ds=f"SELECT w.worker_id, w.worker_name, w.worker_role AS role, count(*) AS total, sum({ON_TIME_STG}) AS ot "
           "FROM stg_deliveries d JOIN stg_workers w ON d.driver_worker_id = w.worker_id GROUP BY 1, 2, 3"),
    "q08_top_customers": query(
        f"""SELECT customer_name, market_type, CAST(order_count AS BIGINT) AS order_count, {rnd('revenue')} AS total_revenue,
  CAST(overall_rank AS BIGINT) AS overall_rank, CAST(rwm AS BIGINT) AS rank_within_market
FROM rk ORDER BY revenue DESC, customer_id LIMIT 15""",
        cr=CUST_REV,
        rk="SELECT *, rank() OVER (ORDER BY revenue DESC) AS overall_rank, "
           "rank() OVER (PARTITION BY market_type ORDER BY revenue DESC) AS rwm FROM cr"),
    "q09_customer_quartiles": query(
        f"""SELECT customer_name, market_type, {rnd('revenue')} AS revenue, CAST(q AS BIGINT) AS revenue_quartile,
  CASE q WHEN 1 THEN 'Top 25% (Whales)' WHEN 2 THEN 'Upper mid' WHEN 3 THEN 'Lower mid' WHEN 4 THEN 'Bottom 25% (Long tail)' END AS segment
FROM (SELECT *, ntile(4) OVER (ORDER BY revenue DESC, customer_id) AS q FROM cr)""",
        cr=CUST_REV),
    "q10_revenue_by_market": query(
        f"""SELECT market_type, CAST(count(DISTINCT customer_id) AS BIGINT) AS customer_count,
  CAST(count(DISTINCT order_id) AS BIGINT) AS order_count, {rnd('sum(rev)')} AS revenue,
  {pct('sum(rev)', f'(SELECT sum({LINE_REV}) FROM stg_order_items)', 1)} AS pct_of_total_revenue
FROM (SELECT c.market_type, c.customer_id, o.order_id, coalesce(i.confirmed_quantity, 0) * i.unit_price AS rev
      FROM stg_customers c JOIN stg_orders o ON c.customer_id = o.customer_id JOIN stg_order_items i ON o.order_id = i.order_id)
GROUP BY 1"""),
    "q11_top_products": query(
        f"""SELECT product_name, category, {dbl('tr')} AS total_requested, {dbl('tc')} AS total_confirmed, {dbl('sh')} AS shortage,
  {pct('sh', 'tr', 1)} AS shortage_rate_pct, CAST(dr AS BIGINT) AS demand_rank, CAST(sr AS BIGINT) AS shortage_rank
FROM (SELECT *, rank() OVER (ORDER BY tr DESC) AS dr, rank() OVER (ORDER BY sh DESC) AS sr FROM ps)
ORDER BY tr DESC, product_id LIMIT 15""",
        ps="SELECT p.product_id, p.product_name, p.category, sum(i.requested_quantity) AS tr, "
           "sum(coalesce(i.confirmed_quantity, 0)) AS tc, sum(i.requested_quantity - coalesce(i.confirmed_quantity, 0)) AS sh "
           "FROM stg_order_items i JOIN stg_products p ON i.product_id = p.product_id GROUP BY 1, 2, 3"),
    "q12_source_type": query(
        f"""SELECT p.source_type, CAST(count(DISTINCT p.product_id) AS BIGINT) AS product_count,
  {dbl('sum(i.requested_quantity)')} AS total_requested, {dbl('sum(coalesce(i.confirmed_quantity, 0))')} AS total_confirmed,
  {pct('sum(coalesce(i.confirmed_quantity, 0))', 'sum(i.requested_quantity)')} AS fill_rate_pct
FROM stg_order_items i JOIN stg_products p ON i.product_id = p.product_id GROUP BY 1"""),
    "q13_inventory_trend": query(
        f"""SELECT CAST(date_trunc('week', i.inventory_date) AS DATE) AS week_start, p.category,
  {dbl('sum(i.available_quantity)')} AS total_on_hand,
  CAST(sum(i.available_quantity) AS DOUBLE) / nullif(count(i.available_quantity), 0) AS avg_per_snapshot
FROM stg_inventory i JOIN stg_products p ON i.product_id = p.product_id GROUP BY 1, 2"""),
}

MODELS = {
    "stg_customers": query(exchange("stg_customers")),
    "stg_suppliers": query(exchange("stg_suppliers")),
    "stg_workers": query(exchange("stg_workers")),
    "stg_products": query(exchange("stg_products", ("standard_price",))),
    "stg_inventory": query(exchange("stg_inventory", ("available_quantity",))),
    "stg_orders": query(exchange("stg_orders", ("total_value",), ("total_items",))),
    "stg_order_items": query(exchange("stg_order_items", ("requested_quantity", "confirmed_quantity", "unit_price"))),
    "stg_prep_lists": query(exchange("stg_prep_lists", ("quantity_to_prepare",))),
    "stg_deliveries": query(exchange("stg_deliveries")),
    "stg_worker_shifts": query(exchange("stg_worker_shifts", ("hours_worked", "hourly_rate"))),
    "fct_order_items": query(exchange("fct_order_items", (
        "requested_quantity", "confirmed_quantity", "shortage_quantity", "unit_price", "confirmed_revenue", "requested_value"))),
    "fct_deliveries": query(exchange("fct_deliveries", (), ("is_on_time",))),
    "fct_orders": query(exchange("fct_orders", (
        "header_total_value", "line_requested_value", "confirmed_revenue", "header_value_variance"), ("header_total_items",))),
    "fct_worker_shifts": query(exchange("fct_worker_shifts", ("hours_worked", "hourly_rate", "labor_cost"))),
    "dim_customers": query(exchange("dim_customers", ("lifetime_revenue",), ("lifetime_orders",))),
    "stg_incoming_orders_raw": query(exchange("stg_incoming_orders_raw")),
    "dim_products": query(exchange("dim_products", ("standard_price",))),
    "dim_workers": query("SELECT worker_id, worker_name, worker_role, hire_date, is_active FROM stg_workers"),
}

from .extra_sql import EXTRA  # noqa: E402

ORACLE: dict[str, str] = {**MODELS, **KPI, **SQL_FILE, **EXTRA}
