"""Duplicate orders, sweep lines, runs of days, fuzzy names, mergeable distinct counts, layouts: against brute force and by plan."""

import datetime as dt
import itertools
import random
import re
import tempfile
import uuid
from collections import Counter
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from greenlane.operators import duplicates, fuzzy, intervals
from greenlane.operators.allocation import allocate_stock, with_received_time
from greenlane.operators.ranking import RankConfig
from greenlane.plans import distinct, layout
from tests.fixtures import d, ts

TINY = RankConfig(small_rows=4, rows_per_partition=5, max_partitions=16, broadcast_rows=1000)
ORDER, LINE = "order_id long, customer_id long, order_date date", "order_id long, product_id long, requested_quantity decimal(10,2), unit_price decimal(10,2)"


# -- X8 ----------------------------------------------------------------------------------------
def _orders(seed, n):
    r = random.Random(seed)
    kinds = [[], [(1, 1, 1)], [(1, 1, 1)] * 2, [(1, 1, 1), (2, 1, 1)], [(2, 1, 1), (1, 1, 1)], [(1, 1, 1), (2, 1, None)], [(None, 2, 3)], [(1, 2, 1)]]
    orders, lines = [], []
    for k in range(n):
        orders.append((k, r.choice([7, 7, 8, None]), r.choice([d("2025-04-01"), d("2025-04-01"), d("2025-04-02"), None])))
        chosen = list(r.choice(kinds))
        r.shuffle(chosen)
        lines += [(k, p, D(q), None if u is None else D(u)) for p, q, u in chosen]
    return orders, lines


def _plain_duplicates(orders, lines):
    by = {}
    for o, c, day in orders:
        mine = Counter(x[1:] for x in lines if x[0] == o)
        if c is not None and day is not None and mine:
            by.setdefault((c, day, frozenset(mine.items())), []).append((o, sum(mine.values())))
    return sorted((o, min(os)[0], c, day, n) for (c, day, _), os in by.items() for o, n in os if o != min(os)[0])


@pytest.mark.parametrize("collide", [False, True])
def test_duplicate_orders_by_brute_force(spark, monkeypatch, collide):
    """Also where every fingerprint of equal counts collides, and beyond the broadcast limit."""
    orders, lines = _orders(1, 120)
    if collide:
        monkeypatch.setattr(duplicates, "line_hash", lambda seed: F.lit(seed).cast("long"))
        spark.conf.set("greenlane.broadcastBytes", "0")
    try:
        got = duplicates.duplicate_orders(spark.createDataFrame(orders, ORDER), spark.createDataFrame(lines, LINE).withColumn("lines", F.lit(1)))
        rows = sorted(map(tuple, got.collect()))
    finally:
        spark.conf.unset("greenlane.broadcastBytes")
    assert rows == _plain_duplicates(orders, lines) and len(rows) > 20


def test_no_duplicate_orders(spark):
    out = duplicates.duplicate_orders(spark.createDataFrame([(1, 7, d("2025-04-01"))], ORDER), spark.createDataFrame([], LINE))
    assert out.collect() == [] and out.columns == ["order_id", "duplicate_of", "customer_id", "order_date", "line_count"]


# -- X7 ----------------------------------------------------------------------------------------
SPAN = "driver long, begins_at timestamp_ntz, ends_at timestamp_ntz"


def test_a_busy_driver_is_swept_over_many_tasks(spark):
    r = random.Random(2)
    at = lambda k: dt.datetime(2025, 4, 1) + dt.timedelta(minutes=k)
    spans = [(1 if k % 10 else 2, at(a := r.randrange(60)), r.choice([at(a + r.randrange(-3, 20)), at(a), None])) for k in range(400)]
    want = {}
    for key in (1, 2):
        mine = [(a, b) for w, a, b in spans if w == key and b is not None and a < b]
        for t in sorted({x for s in mine for x in s}):
            change = sum((a == t) - (b == t) for a, b in mine)
            if change:
                want[key, t] = sum(a <= t < b for a, b in mine)
    df = spark.createDataFrame(spans, SPAN)
    for strategy in ("auto", "distributed"):
        out = intervals.open_intervals(df, "driver", strategy, TINY)
        assert {(x.driver, x.at): x.open for x in out.collect()} == want
    assert out.select("driver", F.spark_partition_id().alias("p")).where("driver = 1").distinct().count() > 1


def test_runs_that_cross_partition_borders(spark):
    r = random.Random(3)
    days = [(p, d("2025-01-01") + dt.timedelta(days=k), r.random() < 0.9) for p in (1, 2, 3) for k in range(60) if r.random() < 0.8]
    want = set()
    for p in (1, 2, 3):
        mine = sorted(x[1:] for x in days if x[0] == p)
        for flag, group in itertools.groupby(mine, key=lambda x: x[1]):
            found = [x[0] for x in group]
            if flag:
                want.add((p, found[0], found[-1], len(found)))
    df = spark.createDataFrame(days, "product long, day date, short boolean")
    for strategy in ("auto", "distributed"):
        rows = intervals.runs_of_days(df, "product", "day", "short", strategy, TINY)
        out = rows.groupBy("product", "run").agg(F.min("day"), F.max("day"), F.count("*")).drop("run")
        assert set(map(tuple, out.collect())) == want
    assert max(w[3] for w in want) > 2 * TINY.rows_per_partition


# -- J11 / J12 -----------------------------------------------------------------------------------
def _edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, last = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(row[j] + 1, last[j + 1] + 1, last[j] + (x != y)))
    return row[-1]


def test_near_names_by_brute_force(spark):
    r = random.Random(4)
    targets = {"".join(r.choice("abc ") for _ in range(r.randrange(1, 16))).strip() or "x" for _ in range(120)} | {"farm shop", "farm shops", "é漢 market"}
    names = set()
    for t in [*targets][:90]:
        chars = list(t)
        for _ in range(r.randrange(4)):
            k = r.randrange(len(chars) + 1)
            chars[k:k + r.randrange(2)] = r.choice(["", "a", "z"])
        names.add("".join(chars).strip() or "y")
    names |= {"aaaaaaaaaa", "é漢 markt"}
    limit = lambda s: 0 if len(s) < 4 else 1 if len(s) < 8 else 2
    want = {(n, t, _edit_distance(n, t)) for n in names for t in targets if _edit_distance(n, t) <= limit(n)}
    frame = lambda rows: spark.createDataFrame([(x,) for x in rows], "name string")
    assert set(map(tuple, fuzzy.near_names(frame(names), frame(targets)).collect())) == want
    assert sum(x[2] == 2 for x in want) > 10


def test_resolution_needs_a_margin(spark):
    customers = spark.createDataFrame([(1, "Green Grocer", True), (2, "Green Grocery", True), (3, "Noodle House", True), (4, "Noodle House", True), (5, "Old Mill", False)],
                                      "customer_id long, customer_name string, is_active boolean")
    names = ["Green Grocer", "green grocer ", "Green Grocet", "Green Grocerz", "Nodle House", "Old Mill", None, " ", "Noodle House", "Green Grocerry"]
    raw = spark.createDataFrame([(k, n, ts("2025-04-01T08:00:00")) for k, n in enumerate(names)], "raw_order_id long, customer_name_raw string, received_at timestamp_ntz")
    got = {r.raw_order_id: (r.resolution, r.customer_id, r.distance) for r in fuzzy.resolve_customers_fuzzy(raw, customers).collect()}
    assert got == {0: ("exact", 1, 0), 1: ("fuzzy", 1, 0), 2: ("fuzzy", 1, 1), 3: ("review", None, 1), 4: ("fuzzy", 3, 1), 5: ("unknown", None, None),
                   6: ("unknown", None, None), 7: ("unknown", None, None), 8: ("exact", 3, 0), 9: ("fuzzy", 2, 1)}
    wide = {r.raw_order_id: r.resolution for r in fuzzy.resolve_customers_fuzzy(raw, customers, margin=2).collect()}
    assert wide[2] == wide[9] == "review" and wide[4] == "fuzzy"


def test_deletions_and_grams_find_the_same_pairs(spark):
    r = random.Random(6)
    names = {"".join(r.choice("ab1é") for _ in range(r.randrange(0, 13))) for _ in range(150)} | {"aaaaaaaaaa", "aaaaaaaa", "x" * 70, "x" * 63 + "y", "x" * 66}
    limit = lambda s: 0 if len(s) < 4 else 1 if len(s) < 8 else 2
    every = {(n, t, _edit_distance(n, t)) for n in names for t in names if abs(len(n) - len(t)) <= 2}
    frame = spark.createDataFrame([(x,) for x in names], "name string")
    got = lambda df: sorted(map(tuple, df.collect()))
    for edits in range(3):
        assert got(fuzzy.by_deletions(frame, frame, edits)) == sorted(x for x in every if x[2] <= min(edits, limit(x[0])))
    want = sorted(x for x in every if x[2] <= limit(x[0]))
    assert got(fuzzy.by_grams(frame.where("name <> ''"), frame.where("name <> ''"))) == [x for x in want if x[0]]
    # names of more than 64 characters take the grams only
    assert got(fuzzy.near_names(frame, frame)) == want
    for margin in (1, 2):
        pairs = fuzzy.near_names(frame, frame, margin).localCheckpoint()
        assert got(fuzzy.best_by_margin(pairs, margin)) == got(fuzzy.best_by_margin(spark.createDataFrame(want, pairs.schema), margin))
        nearest = {n: min(x[2] for x in want if x[0] == n) for n, _, _ in want}
        assert set(x for x in want if x[2] < nearest[x[0]] + margin) <= set(map(tuple, pairs.collect())) <= set(want)


def test_numbered_names_meet_few_others(spark, monkeypatch):
    """Numbers share their grams with a hundredth of all others: the pairs that are measured must not grow with that."""
    n, of = 8000, "lpad(id * 35, 9, '0')) AS name FROM range(1600)"
    targets = spark.sql(f"SELECT concat('customer#', lpad(id * 7, 9, '0')) AS name FROM range({n})")
    names = spark.sql(f"SELECT concat('kusxomer#', {of} UNION ALL SELECT concat('custmer#', {of} UNION ALL SELECT concat('customer#', {of}")
    met = []
    monkeypatch.setattr(fuzzy, "_measured", lambda pairs, edits, f=fuzzy._measured: met.append(pairs.count()) or f(pairs, edits))
    best = fuzzy.best_by_margin(fuzzy.near_names(names, targets, 1)).groupBy("distance", "clear").count()
    assert sorted(map(tuple, best.collect())) == [(0, True, 1600), (1, True, 1600), (2, True, 1600)]
    assert sum(met) < 10 * n


# -- A6 ----------------------------------------------------------------------------------------
def test_bitmaps_merge_exactly(spark):
    r = random.Random(5)
    rows = [(r.choice("ab"), r.randrange(3), r.choice([0, 1, 32767, 32768, 32769, 10**12, None, r.randrange(10**5)])) for _ in range(500)]
    maps = distinct.bitmaps(spark.createDataFrame(rows, "k string, week int, id long"), ["k", "week"], "id")
    for keys, of in ((["k"], 0), (["week"], 1)):
        want = {x: len({i for row in rows for i in [row[2]] if row[of] == x and i is not None}) for x in {row[of] for row in rows}}
        assert {row[0]: row[1] for row in distinct.distinct_of(maps, keys, "n").collect()} == want


# -- layouts --------------------------------------------------------------------------------------
def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return re.findall(r"(?<!Broadcast)Exchange ", plan)


def test_joins_of_the_bucketed_core_move_nothing(spark, wh_small):
    prefix, root = f"t{uuid.uuid4().hex[:8]}", tempfile.mkdtemp(prefix="greenlane-bucketed-")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = layout.write_bucketed_core(wh_small, root, prefix, 4)
        joined, open_ = layout.order_fulfilment(tables), layout.orders_without_delivery(tables)
        assert _exchanges(joined) == [] and _exchanges(open_) == []
        plain = {m: getattr(wh_small, m) for m in tables}
        assert _exchanges(layout.order_fulfilment(plain))
        for a, b in ((joined, layout.order_fulfilment(plain)), (open_, layout.orders_without_delivery(plain))):
            assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
        again = {m: layout.open_bucketed(spark, f"{prefix}_again_{m}", f"{root}/{m}", t.schema.toDDL(), "order_id", 4) for m, t in tables.items()}
        assert _exchanges(layout.order_fulfilment(again)) == []
        assert layout.order_fulfilment(again).count() == joined.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_reads_few_row_groups(spark, monkeypatch):
    rows = spark.range(60_000).select((F.col("id") * 7919 % 5000 * 2).alias("customer_id"), F.col("id").alias("order_id"), F.repeat(F.lit("x"), 20).alias("note")).repartition(6)
    path = tempfile.mkdtemp(prefix="greenlane-lookup-") + "/t"
    layout.write_lookup(rows, path, "customer_id", ("order_id",), row_group_bytes=32 << 10, distinct=5000)
    given = spark.createDataFrame([(4000,), (20,), (None,)], "customer_id long")
    found = layout.read_keys(spark, path, "customer_id", given)
    want = sorted(map(tuple, rows.where("customer_id IN (20, 4000)").collect()))
    assert _scanned_rows(found) < 6000 and sorted(map(tuple, found.collect())) == want and len(want) == 24
    absent = layout.read_keys(spark, path, "customer_id", spark.createDataFrame([(4001,)], "customer_id long"))
    assert _scanned_rows(absent) == 0  # within the ranges, but in no Bloom filter
    by_order = spark.read.parquet(path).where("order_id = 31")
    assert _scanned_rows(by_order) < 6000 and by_order.count() == 1
    monkeypatch.setattr(layout, "LISTED_KEYS", 1)
    joined = layout.read_keys(spark, path, "customer_id", given)
    assert sorted(map(tuple, joined.collect())) == want


# -- X3, S9 -----------------------------------------------------------------------------------------
def test_stock_goes_out_in_order_of_receipt(spark):
    lines = spark.createDataFrame([(o * 10, o, 1, d("2025-04-01"), D("4")) for o in (1, 2, 3)],
                                  "order_item_id long, order_id long, product_id long, order_date date, requested_quantity decimal(10,2)")
    orders = spark.createDataFrame([(1, None), (2, 20), (3, 30)], "order_id long, raw_order_id long")
    raw = spark.createDataFrame([(20, ts("2025-04-01T09:00:00")), (30, ts("2025-04-01T08:00:00")), (30, ts("2025-04-01T11:00:00"))], "raw_order_id long, received_at timestamp_ntz")
    stock = spark.createDataFrame([(1, d("2025-04-01"), D("6"))], "product_id long, inventory_date date, available_quantity decimal(10,2)")
    for strategy in ("auto", "distributed"):
        out = allocate_stock(with_received_time(lines, orders, raw), stock, strategy)
        assert {r.order_id: (r.allocated_quantity, r.allocation_status) for r in out.collect()} == {3: (D("4"), "full"), 2: (D("2"), "partial"), 1: (D("0"), "short")}


def test_exported_csv_keeps_blanks(spark):
    from greenlane.sources.io import export_csv

    path = tempfile.mkdtemp(prefix="greenlane-csv-") + "/c"
    export_csv(spark.createDataFrame([(1, " a ", None), (2, "b,\"c\"", " ")], "k int, s string, t string"), path)
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert sorted(map(tuple, back.collect())) == [("1", " a ", None), ("2", 'b,"c"', " ")]
