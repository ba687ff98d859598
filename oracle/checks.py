"""The declared checks, written out: (name, model, kind, argument, severity).

The argument is the column (not_null, unique), the column and its accepted values, the column with
its parent model and column (relationships), the grain (unique_combination), the predicate that must
not be false (expression) or the name of a statement in ``extra_sql.SINGULAR``. This list is kept apart
from the library on purpose: a check that is missing or wrong there shows as a difference.
"""

# Check names, accepted values and severities.
STAGING_CHECKS = [
    ('unique__stg_customers__customer_id', 'stg_customers', 'unique', 'customer_id', 'error'),
    ('not_null__stg_customers__customer_id', 'stg_customers', 'not_null', 'customer_id', 'error'),
    ('unique__stg_customers__customer_name', 'stg_customers', 'unique', 'customer_name', 'error'),
    ('not_null__stg_customers__customer_name', 'stg_customers', 'not_null', 'customer_name', 'error'),
    ('accepted_values__stg_customers__market_type', 'stg_customers', 'accepted_values', ('market_type', 'restaurant', 'grocery', 'wholesale', 'distributor', 'individual', 'other'), 'error'),
    ('unique__stg_suppliers__supplier_id', 'stg_suppliers', 'unique', 'supplier_id', 'error'),
    ('not_null__stg_suppliers__supplier_id', 'stg_suppliers', 'not_null', 'supplier_id', 'error'),
    ('accepted_values__stg_suppliers__supplier_type', 'stg_suppliers', 'accepted_values', ('supplier_type', 'own_farm', 'external_farm', 'distributor', 'wholesale_market'), 'error'),
    ('unique__stg_workers__worker_id', 'stg_workers', 'unique', 'worker_id', 'error'),
    ('not_null__stg_workers__worker_id', 'stg_workers', 'not_null', 'worker_id', 'error'),
    ('accepted_values__stg_workers__worker_role', 'stg_workers', 'accepted_values', ('worker_role', 'prep', 'driver', 'multi_role', 'supervisor'), 'error'),
    ('unique__stg_products__product_id', 'stg_products', 'unique', 'product_id', 'error'),
    ('not_null__stg_products__product_id', 'stg_products', 'not_null', 'product_id', 'error'),
    ('accepted_values__stg_products__source_type', 'stg_products', 'accepted_values', ('source_type', 'own_farm', 'outsourced', 'mixed'), 'error'),
    ('relationships__stg_products__supplier_id__stg_suppliers', 'stg_products', 'relationships', ('supplier_id', 'stg_suppliers', 'supplier_id'), 'error'),
    ('unique_combination__stg_inventory__product_id_inventory_date_warehouse_location', 'stg_inventory', 'unique_combination', ('product_id', 'inventory_date', 'warehouse_location'), 'error'),
    ('unique__stg_inventory__inventory_id', 'stg_inventory', 'unique', 'inventory_id', 'error'),
    ('not_null__stg_inventory__inventory_id', 'stg_inventory', 'not_null', 'inventory_id', 'error'),
    ('not_null__stg_inventory__product_id', 'stg_inventory', 'not_null', 'product_id', 'error'),
    ('relationships__stg_inventory__product_id__stg_products', 'stg_inventory', 'relationships', ('product_id', 'stg_products', 'product_id'), 'error'),
    ('unique__stg_incoming_orders_raw__raw_order_id', 'stg_incoming_orders_raw', 'unique', 'raw_order_id', 'error'),
    ('not_null__stg_incoming_orders_raw__raw_order_id', 'stg_incoming_orders_raw', 'not_null', 'raw_order_id', 'error'),
    ('accepted_values__stg_incoming_orders_raw__source_channel', 'stg_incoming_orders_raw', 'accepted_values', ('source_channel', 'text', 'email', 'phone', 'spreadsheet', 'in_person', 'other'), 'error'),
    ('unique__stg_orders__order_id', 'stg_orders', 'unique', 'order_id', 'error'),
    ('not_null__stg_orders__order_id', 'stg_orders', 'not_null', 'order_id', 'error'),
    ('relationships__stg_orders__raw_order_id__stg_incoming_orders_raw', 'stg_orders', 'relationships', ('raw_order_id', 'stg_incoming_orders_raw', 'raw_order_id'), 'error'),
    ('not_null__stg_orders__customer_id', 'stg_orders', 'not_null', 'customer_id', 'error'),
    ('relationships__stg_orders__customer_id__stg_customers', 'stg_orders', 'relationships', ('customer_id', 'stg_customers', 'customer_id'), 'error'),
    ('accepted_values__stg_orders__order_status', 'stg_orders', 'accepted_values', ('order_status', 'pending', 'confirmed', 'fulfilled', 'partial', 'shorted', 'cancelled'), 'error'),
    ('accepted_values__stg_orders__cleaning_status', 'stg_orders', 'accepted_values', ('cleaning_status', 'clean', 'needs_review', 'incomplete', 'rejected'), 'error'),
    ('unique_combination__stg_order_items__order_id_product_id', 'stg_order_items', 'unique_combination', ('order_id', 'product_id'), 'error'),
    ('unique__stg_order_items__order_item_id', 'stg_order_items', 'unique', 'order_item_id', 'error'),
    ('not_null__stg_order_items__order_item_id', 'stg_order_items', 'not_null', 'order_item_id', 'error'),
    ('not_null__stg_order_items__order_id', 'stg_order_items', 'not_null', 'order_id', 'error'),
    ('relationships__stg_order_items__order_id__stg_orders', 'stg_order_items', 'relationships', ('order_id', 'stg_orders', 'order_id'), 'error'),
    ('not_null__stg_order_items__product_id', 'stg_order_items', 'not_null', 'product_id', 'error'),
    ('relationships__stg_order_items__product_id__stg_products', 'stg_order_items', 'relationships', ('product_id', 'stg_products', 'product_id'), 'error'),
    ('accepted_values__stg_order_items__item_status', 'stg_order_items', 'accepted_values', ('item_status', 'pending', 'confirmed', 'fulfilled', 'partial', 'shorted', 'cancelled'), 'error'),
    ('unique__stg_prep_lists__prep_id', 'stg_prep_lists', 'unique', 'prep_id', 'error'),
    ('not_null__stg_prep_lists__prep_id', 'stg_prep_lists', 'not_null', 'prep_id', 'error'),
    ('relationships__stg_prep_lists__order_id__stg_orders', 'stg_prep_lists', 'relationships', ('order_id', 'stg_orders', 'order_id'), 'error'),
    ('relationships__stg_prep_lists__assigned_worker_id__stg_workers', 'stg_prep_lists', 'relationships', ('assigned_worker_id', 'stg_workers', 'worker_id'), 'error'),
    ('accepted_values__stg_prep_lists__prep_status', 'stg_prep_lists', 'accepted_values', ('prep_status', 'pending', 'assigned', 'in_progress', 'completed', 'cancelled'), 'error'),
    ('unique__stg_deliveries__delivery_id', 'stg_deliveries', 'unique', 'delivery_id', 'error'),
    ('not_null__stg_deliveries__delivery_id', 'stg_deliveries', 'not_null', 'delivery_id', 'error'),
    ('unique__stg_deliveries__order_id', 'stg_deliveries', 'unique', 'order_id', 'error'),
    ('not_null__stg_deliveries__order_id', 'stg_deliveries', 'not_null', 'order_id', 'error'),
    ('relationships__stg_deliveries__order_id__stg_orders', 'stg_deliveries', 'relationships', ('order_id', 'stg_orders', 'order_id'), 'error'),
    ('relationships__stg_deliveries__driver_worker_id__stg_workers', 'stg_deliveries', 'relationships', ('driver_worker_id', 'stg_workers', 'worker_id'), 'error'),
    ('accepted_values__stg_deliveries__delivery_status', 'stg_deliveries', 'accepted_values', ('delivery_status', 'scheduled', 'in_transit', 'delivered', 'failed', 'cancelled'), 'error'),
    ('unique__stg_worker_shifts__shift_id', 'stg_worker_shifts', 'unique', 'shift_id', 'error'),
    ('not_null__stg_worker_shifts__shift_id', 'stg_worker_shifts', 'not_null', 'shift_id', 'error'),
    ('not_null__stg_worker_shifts__worker_id', 'stg_worker_shifts', 'not_null', 'worker_id', 'error'),
    ('relationships__stg_worker_shifts__worker_id__stg_workers', 'stg_worker_shifts', 'relationships', ('worker_id', 'stg_workers', 'worker_id'), 'error'),
    ('accepted_values__stg_worker_shifts__task_type', 'stg_worker_shifts', 'accepted_values', ('task_type', 'prep', 'delivery', 'cleaning', 'inventory', 'admin', 'other'), 'error'),
    ('relationships__stg_prep_lists__product_id__stg_products', 'stg_prep_lists', 'relationships', ('product_id', 'stg_products', 'product_id'), 'error'),
    ('relationships__stg_worker_shifts__related_order_id__stg_orders', 'stg_worker_shifts', 'relationships', ('related_order_id', 'stg_orders', 'order_id'), 'error'),
    ('check__stg_products__price_non_negative', 'stg_products', 'expression', 'standard_price >= 0', 'error'),
    ('check__stg_inventory__stock_non_negative', 'stg_inventory', 'expression', 'available_quantity >= 0', 'error'),
    ('check__stg_order_items__quantities', 'stg_order_items', 'expression', 'requested_quantity > 0 AND (confirmed_quantity IS NULL OR (confirmed_quantity >= 0 AND confirmed_quantity <= requested_quantity))', 'error'),
    ('check__stg_order_items__price_non_negative', 'stg_order_items', 'expression', 'unit_price >= 0', 'error'),
    ('check__stg_prep_lists__quantity_positive', 'stg_prep_lists', 'expression', 'quantity_to_prepare > 0', 'error'),
    ('check__stg_worker_shifts__hours', 'stg_worker_shifts', 'expression', 'hours_worked > 0 AND hours_worked <= 24', 'error'),
    ('check__stg_worker_shifts__rate_non_negative', 'stg_worker_shifts', 'expression', 'hourly_rate >= 0', 'error'),
]

CORE_CHECKS = [
    ('unique__dim_customers__customer_id', 'dim_customers', 'unique', 'customer_id', 'error'),
    ('not_null__dim_customers__customer_id', 'dim_customers', 'not_null', 'customer_id', 'error'),
    ('unique__dim_products__product_id', 'dim_products', 'unique', 'product_id', 'error'),
    ('not_null__dim_products__product_id', 'dim_products', 'not_null', 'product_id', 'error'),
    ('unique__dim_workers__worker_id', 'dim_workers', 'unique', 'worker_id', 'error'),
    ('not_null__dim_workers__worker_id', 'dim_workers', 'not_null', 'worker_id', 'error'),
    ('unique__fct_order_items__order_item_id', 'fct_order_items', 'unique', 'order_item_id', 'error'),
    ('not_null__fct_order_items__order_item_id', 'fct_order_items', 'not_null', 'order_item_id', 'error'),
    ('unique__fct_orders__order_id', 'fct_orders', 'unique', 'order_id', 'error'),
    ('not_null__fct_orders__order_id', 'fct_orders', 'not_null', 'order_id', 'error'),
    ('accepted_values__fct_orders__reconciliation_status', 'fct_orders', 'accepted_values', ('reconciliation_status', 'reconciled', 'no_header_total', 'item_count_mismatch', 'value_mismatch'), 'error'),
    ('unique__fct_deliveries__delivery_id', 'fct_deliveries', 'unique', 'delivery_id', 'error'),
    ('not_null__fct_deliveries__delivery_id', 'fct_deliveries', 'not_null', 'delivery_id', 'error'),
    ('accepted_values__fct_deliveries__is_on_time', 'fct_deliveries', 'accepted_values', ('is_on_time', 0, 1), 'error'),
    ('unique__fct_worker_shifts__shift_id', 'fct_worker_shifts', 'unique', 'shift_id', 'error'),
    ('not_null__fct_worker_shifts__shift_id', 'fct_worker_shifts', 'not_null', 'shift_id', 'error'),
    ('assert_confirmed_not_above_requested', 'fct_order_items', 'singular', 'assert_confirmed_not_above_requested', 'error'),
    ('assert_delivered_rows_have_timestamp', 'fct_deliveries', 'singular', 'assert_delivered_rows_have_timestamp', 'error'),
    ('warn_order_header_mismatch', 'fct_orders', 'singular', 'warn_order_header_mismatch', 'warn'),
]

KPI_CHECKS = [
    ('unique__kpi_weekly_orders__week_start', 'kpi_weekly_orders', 'unique', 'week_start', 'error'),
    ('not_null__kpi_weekly_orders__week_start', 'kpi_weekly_orders', 'not_null', 'week_start', 'error'),
    ('unique__kpi_weekly_fill_rate__week_start', 'kpi_weekly_fill_rate', 'unique', 'week_start', 'error'),
    ('not_null__kpi_weekly_fill_rate__week_start', 'kpi_weekly_fill_rate', 'not_null', 'week_start', 'error'),
    ('unique__kpi_daily_on_time_delivery__delivery_date', 'kpi_daily_on_time_delivery', 'unique', 'delivery_date', 'error'),
    ('not_null__kpi_daily_on_time_delivery__delivery_date', 'kpi_daily_on_time_delivery', 'not_null', 'delivery_date', 'error'),
    ('unique__kpi_driver_productivity__driver_worker_id', 'kpi_driver_productivity', 'unique', 'driver_worker_id', 'error'),
    ('not_null__kpi_driver_productivity__driver_worker_id', 'kpi_driver_productivity', 'not_null', 'driver_worker_id', 'error'),
    ('unique__kpi_customer_revenue__customer_id', 'kpi_customer_revenue', 'unique', 'customer_id', 'error'),
    ('not_null__kpi_customer_revenue__customer_id', 'kpi_customer_revenue', 'not_null', 'customer_id', 'error'),
    ('unique__kpi_revenue_by_market__market_type', 'kpi_revenue_by_market', 'unique', 'market_type', 'error'),
    ('not_null__kpi_revenue_by_market__market_type', 'kpi_revenue_by_market', 'not_null', 'market_type', 'error'),
    ('unique__kpi_product_demand__product_id', 'kpi_product_demand', 'unique', 'product_id', 'error'),
    ('not_null__kpi_product_demand__product_id', 'kpi_product_demand', 'not_null', 'product_id', 'error'),
    ('unique__kpi_source_type_fill_rate__source_type', 'kpi_source_type_fill_rate', 'unique', 'source_type', 'error'),
    ('not_null__kpi_source_type_fill_rate__source_type', 'kpi_source_type_fill_rate', 'not_null', 'source_type', 'error'),
    ('unique_combination__kpi_weekly_inventory__week_start_category', 'kpi_weekly_inventory', 'unique_combination', ('week_start', 'category'), 'error'),
    ('assert_kpi_revenue_ties_out', 'kpi_revenue_by_market', 'singular', 'assert_kpi_revenue_ties_out', 'error'),
]
