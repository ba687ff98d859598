"""Data-quality checks (D1-D13): each returns the violating rows; a summary counts them.

A check is declared as data (model, kind, arguments, severity), like a schema test.
``violations`` gives the offending rows of one check (empty = pass). ``run_checks``
evaluates many checks at once: checks that look at one row at a time (not_null,
accepted_values, CHECK expressions) are fused into a single aggregation pass per
model with one ``count_if`` per check; only unique / relationships / grain checks
need a shuffle on their key. The summary has one row per check:
(check_name, model, kind, severity, violations, status).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    model: str
    kind: str  # not_null | unique | accepted_values | relationships | unique_combination | expression | singular
    column: str | None = None
    values: tuple = ()
    to: tuple[str, str] | None = None          # (parent model, parent column) for relationships
    columns: tuple[str, ...] = ()              # unique_combination
    expr: str | None = None                    # expression: SQL predicate that must not be FALSE
    severity: str = "error"
    label: str | None = None

    @property
    def name(self) -> str:
        if self.label:
            return self.label
        arg = self.column or "_".join(self.columns)
        if self.kind == "relationships":
            arg = f"{self.column}__{self.to[0]}"
        return f"{self.kind}__{self.model}__{arg}"


ROW_LOCAL = {"not_null", "accepted_values", "expression"}

# Accepted enum values of the operational model.
MARKET_TYPES = ("restaurant", "grocery", "wholesale", "distributor", "individual", "other")
SUPPLIER_TYPES = ("own_farm", "external_farm", "distributor", "wholesale_market")
WORKER_ROLES = ("prep", "driver", "multi_role", "supervisor")
SOURCE_TYPES = ("own_farm", "outsourced", "mixed")
SOURCE_CHANNELS = ("text", "email", "phone", "spreadsheet", "in_person", "other")
ORDER_STATUSES = ("pending", "confirmed", "fulfilled", "partial", "shorted", "cancelled")
CLEANING_STATUSES = ("clean", "needs_review", "incomplete", "rejected")
ITEM_STATUSES = ORDER_STATUSES
PREP_STATUSES = ("pending", "assigned", "in_progress", "completed", "cancelled")
DELIVERY_STATUSES = ("scheduled", "in_transit", "delivered", "failed", "cancelled")
TASK_TYPES = ("prep", "delivery", "cleaning", "inventory", "admin", "other")
RECONCILIATION_STATUSES = ("reconciled", "no_header_total", "item_count_mismatch", "value_mismatch")


def _keys(model: str, *cols: str) -> list[Check]:
    out = []
    for c in cols:
        out += [Check(model, "unique", c), Check(model, "not_null", c)]
    return out


# Declared tests of the staging and core models (plus the CHECK constraints that had none).
STAGING_CHECKS: list[Check] = [
    *_keys("stg_customers", "customer_id", "customer_name"),
    Check("stg_customers", "accepted_values", "market_type", MARKET_TYPES),
    *_keys("stg_suppliers", "supplier_id"),
    Check("stg_suppliers", "accepted_values", "supplier_type", SUPPLIER_TYPES),
    *_keys("stg_workers", "worker_id"),
    Check("stg_workers", "accepted_values", "worker_role", WORKER_ROLES),
    *_keys("stg_products", "product_id"),
    Check("stg_products", "accepted_values", "source_type", SOURCE_TYPES),
    Check("stg_products", "relationships", "supplier_id", to=("stg_suppliers", "supplier_id")),
    Check("stg_inventory", "unique_combination", columns=("product_id", "inventory_date", "warehouse_location")),
    *_keys("stg_inventory", "inventory_id"),
    Check("stg_inventory", "not_null", "product_id"),
    Check("stg_inventory", "relationships", "product_id", to=("stg_products", "product_id")),
    *_keys("stg_incoming_orders_raw", "raw_order_id"),
    Check("stg_incoming_orders_raw", "accepted_values", "source_channel", SOURCE_CHANNELS),
    *_keys("stg_orders", "order_id"),
    Check("stg_orders", "relationships", "raw_order_id", to=("stg_incoming_orders_raw", "raw_order_id")),
    Check("stg_orders", "not_null", "customer_id"),
    Check("stg_orders", "relationships", "customer_id", to=("stg_customers", "customer_id")),
    Check("stg_orders", "accepted_values", "order_status", ORDER_STATUSES),
    Check("stg_orders", "accepted_values", "cleaning_status", CLEANING_STATUSES),
    Check("stg_order_items", "unique_combination", columns=("order_id", "product_id")),
    *_keys("stg_order_items", "order_item_id"),
    Check("stg_order_items", "not_null", "order_id"),
    Check("stg_order_items", "relationships", "order_id", to=("stg_orders", "order_id")),
    Check("stg_order_items", "not_null", "product_id"),
    Check("stg_order_items", "relationships", "product_id", to=("stg_products", "product_id")),
    Check("stg_order_items", "accepted_values", "item_status", ITEM_STATUSES),
    *_keys("stg_prep_lists", "prep_id"),
    Check("stg_prep_lists", "relationships", "order_id", to=("stg_orders", "order_id")),
    Check("stg_prep_lists", "relationships", "assigned_worker_id", to=("stg_workers", "worker_id")),
    Check("stg_prep_lists", "accepted_values", "prep_status", PREP_STATUSES),
    *_keys("stg_deliveries", "delivery_id"),
    Check("stg_deliveries", "unique", "order_id"),
    Check("stg_deliveries", "not_null", "order_id"),
    Check("stg_deliveries", "relationships", "order_id", to=("stg_orders", "order_id")),
    Check("stg_deliveries", "relationships", "driver_worker_id", to=("stg_workers", "worker_id")),
    Check("stg_deliveries", "accepted_values", "delivery_status", DELIVERY_STATUSES),
    *_keys("stg_worker_shifts", "shift_id"),
    Check("stg_worker_shifts", "not_null", "worker_id"),
    Check("stg_worker_shifts", "relationships", "worker_id", to=("stg_workers", "worker_id")),
    Check("stg_worker_shifts", "accepted_values", "task_type", TASK_TYPES),
    # foreign keys enforced by the database only
    Check("stg_prep_lists", "relationships", "product_id", to=("stg_products", "product_id")),
    Check("stg_worker_shifts", "relationships", "related_order_id", to=("stg_orders", "order_id")),
    # numeric CHECK constraints (D11); a NULL operand passes, as in SQL
    Check("stg_products", "expression", expr="standard_price >= 0", label="check__stg_products__price_non_negative"),
    Check("stg_inventory", "expression", expr="available_quantity >= 0", label="check__stg_inventory__stock_non_negative"),
    Check("stg_order_items", "expression",
          expr="requested_quantity > 0 AND (confirmed_quantity IS NULL OR (confirmed_quantity >= 0 AND confirmed_quantity <= requested_quantity))",
          label="check__stg_order_items__quantities"),
    Check("stg_order_items", "expression", expr="unit_price >= 0", label="check__stg_order_items__price_non_negative"),
    Check("stg_prep_lists", "expression", expr="quantity_to_prepare > 0", label="check__stg_prep_lists__quantity_positive"),
    Check("stg_worker_shifts", "expression", expr="hours_worked > 0 AND hours_worked <= 24", label="check__stg_worker_shifts__hours"),
    Check("stg_worker_shifts", "expression", expr="hourly_rate >= 0", label="check__stg_worker_shifts__rate_non_negative"),
]

CORE_CHECKS: list[Check] = [
    *_keys("dim_customers", "customer_id"),
    *_keys("dim_products", "product_id"),
    *_keys("dim_workers", "worker_id"),
    *_keys("fct_order_items", "order_item_id"),
    *_keys("fct_orders", "order_id"),
    Check("fct_orders", "accepted_values", "reconciliation_status", RECONCILIATION_STATUSES),
    *_keys("fct_deliveries", "delivery_id"),
    Check("fct_deliveries", "accepted_values", "is_on_time", (0, 1)),
    *_keys("fct_worker_shifts", "shift_id"),
    Check("fct_order_items", "singular", label="assert_confirmed_not_above_requested"),
    Check("fct_deliveries", "singular", label="assert_delivered_rows_have_timestamp"),
    Check("fct_orders", "singular", label="warn_order_header_mismatch", severity="warn"),
]

KPI_CHECKS: list[Check] = [
    *_keys("kpi_weekly_orders", "week_start"),
    *_keys("kpi_weekly_fill_rate", "week_start"),
    *_keys("kpi_daily_on_time_delivery", "delivery_date"),
    *_keys("kpi_driver_productivity", "driver_worker_id"),
    *_keys("kpi_customer_revenue", "customer_id"),
    *_keys("kpi_revenue_by_market", "market_type"),
    *_keys("kpi_product_demand", "product_id"),
    *_keys("kpi_source_type_fill_rate", "source_type"),
    Check("kpi_weekly_inventory", "unique_combination", columns=("week_start", "category")),
    Check("kpi_revenue_by_market", "singular", label="assert_kpi_revenue_ties_out"),
]


# -- singular checks (D7-D10) ------------------------------------------------
def confirmed_not_above_requested(fct_order_items: DataFrame) -> DataFrame:
    return fct_order_items.where(ROW_LOCAL_SINGULAR["assert_confirmed_not_above_requested"]()).select(
        "order_item_id", "requested_quantity", "confirmed_quantity")


def delivered_rows_have_timestamp(fct_deliveries: DataFrame) -> DataFrame:
    return fct_deliveries.where(ROW_LOCAL_SINGULAR["assert_delivered_rows_have_timestamp"]()).select(
        "delivery_id", "delivery_status", "delivered_at")


def order_header_mismatch(fct_orders: DataFrame) -> DataFrame:
    return fct_orders.where(ROW_LOCAL_SINGULAR["warn_order_header_mismatch"]()).select(
        "order_id", "reconciliation_status", "header_total_items", "line_count", "header_value_variance")


def revenue_ties_out(kpi_revenue_by_market: DataFrame, kpi_overview: DataFrame) -> DataFrame:
    """Market split vs overview total; two one-row aggregates side by side (no cross join needed)."""
    a = kpi_revenue_by_market.agg(F.sum("revenue").alias("by_market"))
    b = kpi_overview.agg(F.first("total_confirmed_revenue").alias("overview"))
    both = a.select("by_market", b.scalar().alias("overview"))
    return both.where(F.abs(F.coalesce("by_market", F.lit(0)) - F.coalesce("overview", F.lit(0))) > F.lit(Decimal("0.05")))


# Singular checks that test one row at a time: fused into the per-model pass of run_checks.
ROW_LOCAL_SINGULAR = {
    "assert_confirmed_not_above_requested":
        lambda: (F.col("confirmed_quantity") > F.col("requested_quantity")) | (F.col("confirmed_quantity") < 0),
    "assert_delivered_rows_have_timestamp":
        lambda: (F.col("delivery_status") == "delivered") & F.col("delivered_at").isNull(),
    "warn_order_header_mismatch":
        lambda: F.col("reconciliation_status").isin("item_count_mismatch", "value_mismatch"),
}


def _is_row_local(check: Check) -> bool:
    return check.kind in ROW_LOCAL or (check.kind == "singular" and check.label in ROW_LOCAL_SINGULAR)


# -- generic checks ------------------------------------------------------------
def _row_predicate(check: Check) -> Column:
    """TRUE for a violating row of a row-local check."""
    if check.kind == "singular":
        return F.coalesce(ROW_LOCAL_SINGULAR[check.label](), F.lit(False))
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "accepted_values":
        return F.col(check.column).isNotNull() & ~F.col(check.column).isin(*check.values)
    if check.kind == "expression":
        return F.coalesce(~F.expr(check.expr), F.lit(False))
    raise ValueError(check.kind)


def violations(check: Check, models) -> DataFrame:
    """Rows that violate ``check``; ``models`` resolves model names (e.g. a ``Warehouse``)."""
    df = _model(models, check.model)
    if check.kind in ROW_LOCAL:
        return df.where(_row_predicate(check))
    if check.kind == "unique":
        c = check.column
        return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")
    if check.kind == "unique_combination":
        return df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
    if check.kind == "relationships":
        parent_model, parent_col = check.to
        parent = _model(models, parent_model).select(F.col(parent_col).alias("_parent_key")).where("_parent_key IS NOT NULL")
        child = df.where(F.col(check.column).isNotNull())
        return child.join(parent, child[check.column] == parent["_parent_key"], "left_anti").select(check.column)
    if check.kind == "singular":
        return _singular(check.label, models)
    raise ValueError(check.kind)


def _singular(label: str, models) -> DataFrame:
    if label == "assert_confirmed_not_above_requested":
        return confirmed_not_above_requested(_model(models, "fct_order_items"))
    if label == "assert_delivered_rows_have_timestamp":
        return delivered_rows_have_timestamp(_model(models, "fct_deliveries"))
    if label == "warn_order_header_mismatch":
        return order_header_mismatch(_model(models, "fct_orders"))
    if label == "assert_kpi_revenue_ties_out":
        return revenue_ties_out(_model(models, "kpi_revenue_by_market"), _model(models, "kpi_overview"))
    raise ValueError(label)


def _model(models, name: str) -> DataFrame:
    if name.startswith("kpi_"):
        from ..plans.kpi import KPI_MARTS

        cache = models.__dict__.setdefault("_kpi_cache", {})
        if name not in cache:  # a build hands out the marts that it wrote
            cache[name] = models.mart(name) if hasattr(models, "mart") else KPI_MARTS[name](models)
        return cache[name]
    return getattr(models, name)


def _sql_str(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _summary_row(check: Check, count: str) -> str:
    """SQL struct of one summary row; ``count`` is the SQL expression of the violation count.

    Written as one SQL expression (parsed once by the JVM) rather than a tree of Column
    calls: a summary over dozens of checks would otherwise cost thousands of driver calls.
    """
    n = f"CAST({count} AS BIGINT)"
    fail = "'warn'" if check.severity == "warn" else "'fail'"
    return (f"named_struct('check_name', {_sql_str(check.name)}, 'model', {_sql_str(check.model)}, "
            f"'kind', {_sql_str(check.kind)}, 'severity', {_sql_str(check.severity)}, 'violations', {n}, "
            f"'status', CASE WHEN {n} = 0 THEN 'pass' ELSE {fail} END)")


def _union_all(parts: list[DataFrame]) -> DataFrame:
    """Balanced union: each step analyses two halves, not an ever longer chain."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def _key_counts(models, model: str, column: str, cache: dict) -> DataFrame:
    """(_k, _rows): non-NULL values of ``model.column`` with their row counts, built once per run.

    A unique check on a key and every relationship that names it as parent or child
    read the same grouped frame, so the key is shuffled once; the counts are combined
    map-side, so a value held by a third of the rows is one row in the shuffle.
    """
    if (model, column) not in cache:
        cache[(model, column)] = (_model(models, model).where(F.col(column).isNotNull())
                                  .groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_rows")))
    return cache[(model, column)]


def _partial_counts(i: int, check: Check, models, cache: dict) -> DataFrame:
    """(_check, n) rows whose sum per ``_check`` is the violation count of a keyed check."""
    if check.kind == "unique":
        v = _key_counts(models, check.model, check.column, cache).where("_rows > 1")
    elif check.kind == "relationships":
        # the filter keeps the count referenced: a parent side pruned to its keys would be a
        # different aggregate and could not reuse the shuffle of the parent's unique check
        parent = _key_counts(models, *check.to, cache).where("_rows > 0").select("_k")
        child = _key_counts(models, check.model, check.column, cache)
        # both sides are already hash-partitioned on _k: the anti join adds no shuffle
        return child.join(parent, "_k", "left_anti").select(F.lit(i).alias("_check"), F.col("_rows").alias("n"))
    else:
        v = violations(check, models)
    return v.select(F.lit(i).alias("_check"), F.lit(1).cast("bigint").alias("n"))


def run_checks(models, checks: list[Check]) -> DataFrame:
    """Summary with one row per check, computed as one job.

    Row-local checks of a model share one aggregation pass; keyed checks share one grouped
    frame per (model, column). Every part yields (check index, partial count) rows, and a
    single aggregation over their union gives the counts: one final shuffle for the whole
    suite instead of one per check. A zero row per check keeps passing checks in the result.
    """
    spark = _model(models, checks[0].model).sparkSession
    parts: list[DataFrame] = [spark.range(len(checks)).select(F.col("id").cast("int").alias("_check"),
                                                                F.lit(0).cast("bigint").alias("n"))]
    by_model: dict[str, list[int]] = {}
    for i, c in enumerate(checks):
        if _is_row_local(c):
            by_model.setdefault(c.model, []).append(i)
    for model, idx in by_model.items():
        agg = _model(models, model).agg(*[F.count_if(_row_predicate(checks[i])).alias(f"c{i}") for i in idx])
        rows = ", ".join(f"named_struct('_check', {i}, 'n', CAST(c{i} AS BIGINT))" for i in idx)
        parts.append(agg.selectExpr(f"inline(array({rows}))"))
    cache: dict = {}
    for i, c in enumerate(checks):
        if not _is_row_local(c):
            parts.append(_partial_counts(i, c, models, cache))
    counts = _union_all(parts).groupBy("_check").agg(F.sum("n").alias("n"))
    meta = ", ".join(_summary_row(c, "n") for c in checks)
    # one row per declared check (a bound set by the code, not the data): a single sorted partition
    return (counts.coalesce(1).sortWithinPartitions("_check")
            .selectExpr(f"inline(array(element_at(array({meta}), _check + 1)))"))


def check_groups(checks: list[Check]) -> list[list[Check]]:
    """``checks`` in groups that share no shuffle: the row-local ones, then each set of keyed ones that key columns link."""
    local, groups = [c for c in checks if _is_row_local(c)], []
    for check in (c for c in checks if not _is_row_local(c)):
        keys = {(check.model, check.column or check.columns or check.label), *([check.to] if check.to else [])}
        linked = [g for g in groups if g[0] & keys]
        groups = [g for g in groups if not g[0] & keys]
        groups.append((keys.union(*[g[0] for g in linked]), [c for g in linked for c in g[1]] + [check]))
    return [g for g in (local, *[g[1] for g in groups]) if g]


def raise_on_error(summary: DataFrame) -> DataFrame:
    """Error-severity failures stop the job; warnings are only reported."""
    failed = [r.check_name for r in summary.where("status = 'fail'").select("check_name").collect()]
    if failed:
        raise AssertionError(f"data-quality checks failed: {', '.join(sorted(failed))}")
    return summary
