"""Business rules that are easy to get wrong (NULLs, CASE order, frames, rounding)."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from greenlane.functions import round_ratio, safe_pct
from greenlane.plans import kpi, kpi_sql
from greenlane.plans.core import Warehouse
from tests.fixtures import d, tables, ts

CUSTOMERS = [dict(customer_id=1, customer_name=" Acme ", market_type=" Restaurant", is_active=True),
             dict(customer_id=2, customer_name="Bo", market_type="GROCERY", is_active=True)]
PRODUCTS = [dict(product_id=10, product_name="bok choy", category="greens", source_type="Own_Farm"),
            dict(product_id=11, product_name="napa cabbage", category="greens", source_type="outsourced")]


def _order(oid, items, value, date="2025-04-01", cust=1):
    return dict(order_id=oid, raw_order_id=oid, customer_id=cust, order_date=d(date), order_status="Fulfilled",
                cleaning_status="clean", total_items=items, total_value=value)


def _line(iid, oid, pid, req, conf, price):
    return dict(order_item_id=iid, order_id=oid, product_id=pid, requested_quantity=D(req),
                confirmed_quantity=None if conf is None else D(conf), unit_price=D(price), item_status="confirmed")


def test_exact_half_up_rounding(spark):
    df = spark.createDataFrame([(D("66.835"), D("100")), (D("-0.125"), D("1")), (D("1"), D("0")), (D("2"), D("3"))],
                               "n decimal(10,3), m decimal(10,0)")
    got = [r.r for r in df.select(round_ratio("n", "m", 2).alias("r")).collect()]
    assert got == [D("0.67"), D("-0.13"), None, D("0.67")]
    got = [r.p for r in df.select(safe_pct("n", "m", 1).alias("p")).collect()]
    assert got == [D("66.8"), D("-12.5"), None, D("66.7")]


def test_reconciliation_case_order_and_nulls(spark):
    orders = [
        _order(1, None, D("10.00")),          # no header count
        _order(2, 2, D("10.00")),             # one line only
        _order(3, 1, D("10.00")),             # 0.02 off
        _order(4, 1, D("10.00")),             # exactly 0.01 off -> reconciled
        _order(5, 1, None),                   # NULL value with matching count falls through
        _order(6, 0, D("0.00")),              # no lines at all
    ]
    lines = [_line(1, 1, 10, "1", "1", "10.00"), _line(2, 2, 10, "1", None, "10.00"),
             _line(3, 3, 10, "1", "1", "10.02"), _line(4, 4, 10, "1", "0", "10.01"),
             _line(5, 5, 11, "2", "1", "3.00")]
    w = Warehouse(tables(spark, customers=CUSTOMERS, products=PRODUCTS, orders_cleaned=orders, order_items=lines))
    got = {r.order_id: (r.reconciliation_status, r.fill_rate_pct, r.line_count) for r in w.fct_orders.collect()}
    assert got == {1: ("no_header_total", D("100.00"), 1), 2: ("item_count_mismatch", D("0.00"), 1),
                   3: ("value_mismatch", D("100.00"), 1), 4: ("reconciled", D("0.00"), 1),
                   5: ("reconciled", D("50.00"), 1), 6: ("reconciled", None, 0)}
    # NULL confirmed stays NULL in staging but counts as 0 downstream
    assert w.stg_order_items.where("order_item_id = 2").first().confirmed_quantity is None
    assert w.fct_order_items.where("order_item_id = 2").first().confirmed_revenue == D("0.0000")
    # staging normalises enums and names
    c = {r.customer_id: (r.customer_name, r.market_type) for r in w.stg_customers.collect()}
    assert c == {1: ("Acme", "restaurant"), 2: ("Bo", "grocery")}


def test_on_time_rule_and_rolling_rows_frame(spark):
    sched = "2025-04-0{}T10:00:00"
    dels = [
        dict(delivery_id=1, order_id=1, scheduled_delivery_time=ts(sched.format(1)), actual_delivery_time=ts("2025-04-01T18:00:00"),
             delivery_status="Delivered", driver_worker_id=7),
        dict(delivery_id=2, order_id=2, scheduled_delivery_time=ts(sched.format(1)), actual_delivery_time=ts("2025-03-31T18:00:00"),
             delivery_status="delivered", driver_worker_id=7),  # a day early: not on time
        dict(delivery_id=3, order_id=3, scheduled_delivery_time=ts(sched.format(3)), actual_delivery_time=None,
             delivery_status="failed", driver_worker_id=None),   # counts in the denominator
        dict(delivery_id=4, order_id=4, scheduled_delivery_time=ts(sched.format(9)), actual_delivery_time=ts("2025-04-09T11:00:00"),
             delivery_status="delivered", driver_worker_id=8),
    ]
    workers = [dict(worker_id=7, worker_name="Ana", role="Driver"), dict(worker_id=8, worker_name="Ben", role="multi_role")]
    w = Warehouse(tables(spark, deliveries=dels, workers=workers))
    daily = {r.delivery_date.day: (r.deliveries, r.on_time_deliveries, r.on_time_pct, r.rolling_7day_on_time_pct)
             for r in kpi.kpi_daily_on_time_delivery(w).collect()}
    # ROWS frame: the 9th sees the 1st and 3rd (observed days), not a 7-calendar-day range
    assert daily == {1: (2, 1, D("50.0"), D("50.0")), 3: (1, 0, D("0.0"), D("33.3")), 9: (1, 1, D("100.0"), D("50.0"))}
    drivers = {r.driver_name: (r.total_deliveries, r.volume_rank, r.reliability_rank)
               for r in kpi.kpi_driver_productivity(w).collect()}
    assert drivers == {"Ana": (2, 1, 2), "Ben": (1, 2, 1)}
    q7 = {r.worker_name: r.volume_rank for r in kpi_sql.q07_driver_productivity(w).collect()}
    assert q7 == {"Ana": 1, "Ben": 2}


def test_weekly_mean_half_up_tie(spark):
    weekly = spark.createDataFrame(
        [(d("2025-03-31"), D("100.00"), D("80.50")), (d("2025-04-07"), D("100.00"), D("80.51")),
         (d("2025-04-14"), D("100.00"), D("80.50")), (d("2025-04-21"), D("100.00"), D("80.51")),
         (d("2025-04-28"), D("0.00"), D("0.00"))],
        "week_start date, requested_quantity decimal(20,2), confirmed_quantity decimal(20,2)")
    got = {r.week_start.isoformat(): (r.weekly_fill_rate_pct, r.rolling_4wk_avg_pct, r.rolling_4wk_fill_rate_pct)
           for r in kpi.weekly_fill_rate(weekly).collect()}
    assert got["2025-04-21"] == (D("80.51"), D("80.51"), D("80.51"))  # mean 80.505 rounds up
    # a zero-volume week has a NULL rate, which AVG skips; the weighted rate ignores it by volume
    assert got["2025-04-28"] == (None, D("80.51"), D("80.51"))


def test_customer_ranks_ntile_and_cumulative(spark):
    cust = [dict(customer_id=i, customer_name=f"c{i}", market_type=m, is_active=True)
            for i, m in [(1, "restaurant"), (2, "restaurant"), (3, "grocery"), (4, "grocery"), (5, "grocery")]]
    orders = [_order(100 + i, 1, D("1"), cust=i) for i in range(1, 6)]
    rev = {1: "50", 2: "30", 3: "30", 4: "10", 5: "0"}
    lines = [_line(i, 100 + i, 10, rev[i], rev[i], "1.00") for i in range(1, 6)]
    w = Warehouse(tables(spark, customers=cust, products=PRODUCTS, orders_cleaned=orders, order_items=lines))
    got = {r.customer_id: (r.overall_rank, r.rank_within_market, r.revenue_quartile, r.revenue_segment,
                           r.cumulative_revenue_pct) for r in kpi.kpi_customer_revenue(w).collect()}
    assert got == {1: (1, 1, 1, "Top 25%", D("41.7")), 2: (2, 2, 1, "Top 25%", D("66.7")),
                   3: (2, 1, 2, "Upper mid", D("91.7")), 4: (4, 2, 3, "Lower mid", D("100.0")),
                   5: (5, 3, 4, "Bottom 25%", D("100.0"))}


def test_empty_inputs_keep_schema(spark):
    w = Warehouse(tables(spark))
    assert kpi.kpi_overview(w).collect()[0].total_orders == 0
    assert kpi.kpi_weekly_fill_rate(w).count() == 0
    assert kpi_sql.q01_total_orders(w).first().total_orders == 0
    assert "overall_rank" in kpi.kpi_customer_revenue(w).columns


def test_zero_denominator_is_null_not_error(spark):
    lines = [_line(1, 1, 10, "0", "0", "1.00")]
    w = Warehouse(tables(spark, customers=CUSTOMERS, products=PRODUCTS, orders_cleaned=[_order(1, 1, D("0"))], order_items=lines))
    assert kpi.kpi_overview(w).first().overall_fill_rate_pct is None
    assert kpi_sql.q04_overall_fill_rate(w).first().overall_fill_rate_pct is None
    assert w.fct_order_items.select(F.sum("confirmed_revenue")).first()[0] == D("0.0000")
