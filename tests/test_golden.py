"""Golden values of the surveyed project's published results, replayed through our jobs.

The constants are fixed values: each block holds inputs and the outputs published with them.
"""

from decimal import Decimal as D

from pyspark.sql import functions as F

from greenlane.functions import safe_pct
from greenlane.operators import quality as dq
from greenlane.plans import kpi
from greenlane.plans.core import Warehouse
from tests.fixtures import d, tables, ts

# Week, rate, mean of the last four rates
WEEKLY = """2025-03-31 70.00 70.00
2025-04-07 78.70 74.35
2025-04-14 78.98 75.89
2025-04-21 81.51 77.30
2025-04-28 82.83 80.51
2025-05-05 81.00 81.08
2025-05-12 74.21 79.89
2025-05-19 77.79 78.96
2025-05-26 88.47 80.37"""
# Day, deliveries, on time, percent, percent over the last seven observed days
ON_TIME = """2025-04-02 2 2 100.0 100.0
2025-04-03 2 2 100.0 100.0
2025-04-04 5 3 60.0 77.8
2025-04-05 5 3 60.0 71.4
2025-04-06 4 3 75.0 72.2
2025-04-07 6 4 66.7 70.8
2025-04-08 4 3 75.0 71.4
2025-04-09 6 5 83.3 71.9
2025-04-10 5 2 40.0 65.7
2025-04-11 5 3 60.0 65.7
2025-04-12 5 3 60.0 65.7
2025-04-13 9 8 88.9 70.0
2025-04-14 4 2 50.0 68.4
2025-04-15 6 6 100.0 72.5
2025-04-16 8 8 100.0 76.2
2025-04-17 5 4 80.0 81.0
2025-04-18 2 1 50.0 82.1"""
# Market, customers, orders, revenue, share
MARKETS = """restaurant 8 249 64227.36 51.9
grocery 6 144 37946.38 30.7
wholesale 3 59 16293.49 13.2
distributor 1 14 3308.22 2.7
individual 1 7 1870.37 1.5"""
# Requested, confirmed, shortage, percent, demand rank
PRODUCTS = """1806.48 1478.75 327.73 18.1 1
1674.29 1283.16 391.13 23.4 2
1638.86 1260.45 378.41 23.1 3
1608.69 1214.16 394.53 24.5 4
1592.46 1190.96 401.50 25.2 5
1592.41 1313.44 278.97 17.5 6
1592.15 1256.51 335.64 21.1 7
1553.80 1241.77 312.03 20.1 8
1521.08 1229.96 291.12 19.1 9
1512.36 1058.58 453.78 30.0 10
1503.20 1093.64 409.56 27.2 11
1442.44 964.20 478.24 33.2 12
1429.21 1164.09 265.12 18.6 13
1427.54 1134.08 293.46 20.6 14
1418.66 1171.77 246.89 17.4 15"""
# Order, header items, header value
HEADERS = """1001 3 500.00
1002 3 628.00
1003 2 440.00
1004 3 472.00
1005 3 600.00
1006 2 104.00
1007 3 48.00
1008 3 158.00"""
# Line, order, product, requested, confirmed, price
LINES = """1 1001 1 14 14 18
2 1001 2 10 8 22
3 1001 8 6 6 12
4 1002 3 12 12 20
5 1002 4 8 8 24
6 1002 10 10 7 28
7 1003 5 20 18 16
8 1003 7 12 8 19
9 1004 2 10 10 22
10 1004 12 8 8 19
11 1004 9 10 10 10
12 1005 1 15 15 18
13 1005 6 10 10 21
14 1005 11 6 4 30
15 1006 10 3 3 28
16 1006 9 2 2 10
17 1007 1 2 2 18
18 1007 2 2 0 22
19 1007 8 1 1 12
20 1008 5 4 4 16
21 1008 10 2 2 28
22 1008 12 2 2 19"""
# Order, lines, requested value, confirmed revenue, fill percent, variance, status
RECONCILED = """1001 3 544.00 500.00 93.33 -44.00 value_mismatch
1002 3 712.00 628.00 90.00 -84.00 value_mismatch
1003 2 548.00 440.00 81.25 -108.00 value_mismatch
1004 3 472.00 472.00 100.00 0.00 reconciled
1005 3 660.00 600.00 93.55 -60.00 value_mismatch
1006 2 104.00 104.00 100.00 0.00 reconciled
1007 3 92.00 48.00 60.00 -44.00 value_mismatch
1008 3 158.00 158.00 100.00 0.00 reconciled"""


def rows(text):
    return [line.split() for line in text.split("\n")]


def test_weekly_fill_rate_and_rolling_mean(spark):
    weekly = spark.createDataFrame([(d(w), D("10000.00"), D(rate) * 100) for w, rate, _ in rows(WEEKLY)],
                                   "week_start date, requested_quantity decimal(12,2), confirmed_quantity decimal(12,2)")
    got = [(r.week_start.isoformat(), r.weekly_fill_rate_pct, r.rolling_4wk_avg_pct) for r in kpi.weekly_fill_rate(weekly).orderBy("week_start").collect()]
    assert got == [(w, D(a), D(b)) for w, a, b in rows(WEEKLY)]


def test_daily_on_time_and_seven_row_rate(spark):
    deliveries = []
    for day, total, on_time, _, _ in rows(ON_TIME):
        for i in range(int(total)):
            late = i >= int(on_time)
            deliveries.append(dict(delivery_id=len(deliveries), order_id=len(deliveries), scheduled_delivery_time=ts(f"{day}T09:00:00"),
                                   actual_delivery_time=None if late else ts(f"{day}T10:00:00"), delivery_status="failed" if late else "Delivered "))
    got = kpi.kpi_daily_on_time_delivery(Warehouse(tables(spark, deliveries=deliveries))).orderBy("delivery_date").collect()
    assert [tuple(map(str, r)) for r in got] == [tuple(r) for r in rows(ON_TIME)]


def test_revenue_by_market(spark):
    customers, orders, items = [], [], []
    for market, n_customers, n_orders, revenue, _ in rows(MARKETS):
        ids = [len(customers) + k for k in range(int(n_customers))]
        customers += [dict(customer_id=c, customer_name=f"c{c}", market_type=market) for c in ids]
        for k in range(int(n_orders)):
            order = len(orders)
            orders.append(dict(order_id=order, customer_id=ids[k % len(ids)], order_date=d("2025-04-01")))
            items.append(dict(order_item_id=order, order_id=order, product_id=1, requested_quantity=D(1), confirmed_quantity=D(1),
                              unit_price=D(revenue) if k == 0 else D(0)))
    w = Warehouse(tables(spark, customers=customers, orders_cleaned=orders, order_items=items, products=[dict(product_id=1, product_name="p", source_type="mixed")]))
    got = {r.market_type: (r.customer_count, r.order_count, r.revenue, r.pct_of_total_revenue) for r in kpi.kpi_revenue_by_market(w).collect()}
    assert got == {m: (int(c), int(o), D(v), D(p)) for m, c, o, v, p in rows(MARKETS)}


def test_product_demand_and_shortage_rate(spark):
    products = [dict(product_id=i, product_name=f"p{i}", category="c", source_type="mixed") for i in range(15)]
    items = [dict(order_item_id=i, order_id=1, product_id=i, requested_quantity=D(r[0]), confirmed_quantity=D(r[1]), unit_price=D(1)) for i, r in enumerate(rows(PRODUCTS))]
    w = Warehouse(tables(spark, products=products, order_items=items, orders_cleaned=[dict(order_id=1, customer_id=1, order_date=d("2025-04-01"))],
                         customers=[dict(customer_id=1, customer_name="c", market_type="other")]))
    got = sorted((r.product_id, str(r.total_requested), str(r.total_confirmed), str(r.shortage), str(r.shortage_rate_pct), str(r.demand_rank))
                 for r in kpi.kpi_product_demand(w).collect())
    assert got == [(i, *r) for i, r in enumerate(rows(PRODUCTS))]


def fixture(spark):
    orders = [dict(order_id=int(o), customer_id=1, order_date=d("2026-03-31"), total_items=int(n), total_value=D(v),
                   order_status="Partial Fulfilled" if o in ("1001", "1002", "1003", "1005", "1007") else "Confirmed", cleaning_status="Cleaned") for o, n, v in rows(HEADERS)]
    items = [dict(order_item_id=int(i), order_id=int(o), product_id=int(p), requested_quantity=D(q), confirmed_quantity=D(c), unit_price=D(u),
                  item_status="Fulfilled" if q == c else "Unavailable" if c == "0" else "Partial") for i, o, p, q, c, u in rows(LINES)]
    products = [dict(product_id=i, product_name=f"p{i}", source_type="OwnFarm" if i < 8 else "Outsourced") for i in range(1, 13)]
    return Warehouse(tables(spark, orders_cleaned=orders, order_items=items, products=products, customers=[dict(customer_id=1, customer_name="c", market_type="Wholesale Market")]))


def test_order_reconciliation(spark):
    w = fixture(spark)
    got = [(str(r.order_id), str(r.line_count), *(str(r[c].quantize(D("0.01"))) for c in ("line_requested_value", "confirmed_revenue", "fill_rate_pct", "header_value_variance")), r.reconciliation_status)
           for r in w.fct_orders.orderBy("order_id").collect()]
    assert got == [tuple(r) for r in rows(RECONCILED)]
    total = w.fct_order_items.agg(F.sum("confirmed_quantity").alias("c"), F.sum("requested_quantity").alias("r"), F.sum("confirmed_revenue").alias("v")).first()
    assert (total.c, total.r, total.v) == (154, 169, 2950)
    pct = spark.range(1).select(safe_pct(F.lit(D("154.00")), F.lit(D("169.00"))).alias("p")).first().p
    assert pct == kpi.kpi_overview(w).first().overall_fill_rate_pct == D("91.12")


def test_accepted_values_of_the_older_schema(spark):
    w = fixture(spark)
    count = lambda name: dq.violations(next(c for c in dq.STAGING_CHECKS if c.name == name), w).count()
    assert count("accepted_values__stg_orders__order_status") == 5
    assert count("accepted_values__stg_orders__cleaning_status") == 8
    assert count("accepted_values__stg_order_items__item_status") == 1
    assert count("accepted_values__stg_products__source_type") == 7
    assert count("accepted_values__stg_customers__market_type") == 1
