"""Data-quality checks, upserts, guarded/atomic writes and order-text extraction."""

import tempfile
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from greenlane.operators import quality as dq
from greenlane.operators import writes
from greenlane.operators.partitioned import ConcurrentCommit, PartitionedTable
from greenlane.operators.order_text import extract_order_lines, messages_needing_review
from greenlane.plans.core import Warehouse
from tests.fixtures import d, tables, ts


def _wh(spark):
    products = [dict(product_id=1, product_name="bok choy", source_type="OwnFarm", supplier_id=None, standard_price=D("2.00")),
                dict(product_id=2, product_name="napa cabbage", source_type="outsourced", supplier_id=9, standard_price=D("-1.00")),
                dict(product_id=3, product_name="gai lan", source_type=" Mixed ", supplier_id=5, standard_price=None)]
    suppliers = [dict(supplier_id=5, supplier_name="Farm", supplier_type="own_farm")]
    shifts = [dict(shift_id=1, worker_id=1, shift_date=d("2025-04-01"), task_type="Prep", hours_worked=D("25.00"), hourly_rate=D("20")),
              dict(shift_id=1, worker_id=1, shift_date=d("2025-04-01"), task_type="x", hours_worked=D("8.00"), hourly_rate=D("20")),
              dict(shift_id=None, worker_id=2, shift_date=d("2025-04-01"), task_type="admin", hours_worked=D("8.00"), hourly_rate=D("20"))]
    workers = [dict(worker_id=1, worker_name="Ana", role="prep")]
    return Warehouse(tables(spark, products=products, suppliers=suppliers, worker_shifts=shifts, workers=workers))


def test_generic_checks_semantics(spark):
    w = _wh(spark)
    summary = {r.check_name: (r.violations, r.status) for r in dq.run_checks(w, [
        dq.Check("stg_products", "accepted_values", "source_type", dq.SOURCE_TYPES),
        dq.Check("stg_products", "relationships", "supplier_id", to=("stg_suppliers", "supplier_id")),
        dq.Check("stg_products", "expression", expr="standard_price >= 0", label="price"),
        dq.Check("stg_worker_shifts", "unique", "shift_id"),
        dq.Check("stg_worker_shifts", "not_null", "shift_id"),
        dq.Check("stg_worker_shifts", "accepted_values", "task_type", dq.TASK_TYPES),
        dq.Check("stg_worker_shifts", "expression", expr="hours_worked > 0 AND hours_worked <= 24", label="hours"),
        dq.Check("stg_worker_shifts", "relationships", "worker_id", to=("stg_workers", "worker_id"), severity="warn"),
    ]).collect()}
    assert summary == {
        "accepted_values__stg_products__source_type": (1, "fail"),   # 'ownfarm'; NULLs would pass
        "relationships__stg_products__supplier_id__stg_suppliers": (1, "fail"),  # 9 orphan; NULL passes
        "price": (1, "fail"),                                         # NULL price passes, -1 fails
        "unique__stg_worker_shifts__shift_id": (1, "fail"),           # duplicated 1; NULL ignored
        "not_null__stg_worker_shifts__shift_id": (1, "fail"),
        "accepted_values__stg_worker_shifts__task_type": (1, "fail"),
        "hours": (1, "fail"),
        "relationships__stg_worker_shifts__worker_id__stg_workers": (1, "warn"),
    }
    with pytest.raises(AssertionError):
        dq.raise_on_error(dq.run_checks(w, [dq.Check("stg_worker_shifts", "not_null", "shift_id")]))
    dq.raise_on_error(dq.run_checks(w, [dq.Check("stg_workers", "not_null", "worker_id")]))


def test_upsert_later_row_wins_and_counts(spark):
    target = spark.createDataFrame([(1, "a", 10, None), (2, "b", 20, None)],
                                   "k int, v string, n int, updated_at timestamp_ntz")
    batch = spark.createDataFrame([(2, "B1", 21, 1), (2, "B2", None, 2), (3, "c", 30, 1)], "k int, v string, n int, seq int")
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    merged = writes.upsert(target, batch, ["k"], ["v", "n"], order_col="seq", now=now)
    got = {r.k: (r.v, r.n, r._action, r.updated_at is not None) for r in merged.collect()}
    assert got == {1: ("a", 10, "unchanged", False), 2: ("B2", None, "updated", True), 3: ("c", 30, "inserted", True)}
    counts = {r._action: r.rows for r in writes.upsert_outcome_counts(merged).collect()}
    assert counts == {"updated": 1, "inserted": 1}


def test_atomic_version_and_load_if_empty(spark):
    base = tempfile.mkdtemp(prefix="greenlane-test-")
    v1 = writes.write_version(spark.range(3), base)
    v2 = writes.write_version(spark.range(5), base)
    assert v1 != v2 and writes.read_latest(spark, base).count() == 5
    target = spark.range(0)
    assert writes.load_if_empty(target, spark.range(2), f"{base}/t")
    assert not writes.load_if_empty(spark.read.parquet(f"{base}/t"), spark.range(2), f"{base}/t")


def test_resolve_customers_keeps_rejects(spark):
    raw = spark.createDataFrame([(1, "Acme", ts("2025-04-01T09:30:00"), "text"), (2, "acme ", ts("2025-04-02T09:00:00"), "text"),
                                 (3, None, ts("2025-04-02T10:00:00"), "phone")],
                                "raw_order_id long, customer_name_raw string, received_at timestamp_ntz, source_channel string")
    cust = spark.createDataFrame([(7, "Acme", True), (8, "Gone", False)], "customer_id long, customer_name string, is_active boolean")
    ok, rejected = writes.resolve_customers(raw, cust)
    assert [(r.raw_order_id, r.customer_id, r.order_date) for r in ok.collect()] == [(1, 7, d("2025-04-01"))]
    assert sorted(r.raw_order_id for r in rejected.collect()) == [2, 3]


def test_order_text_layouts_and_review(spark):
    two = [(1, 5, 10, "parsed"), (2, 12, 11, "parsed")]
    messages = [  # (channel, text, lines, goes to review)
        ("text", "hi acme here need 5lb bok choy, 12lb napa for tmr", two, False),
        ("text", "5lb bok choy, 12lb napa pls, delivery this week", two, False),
        ("text", "hey can u send 5lb bok choy, 12lb napa thanks", two, False),
        ("text", "acme kitchen: 5lb bok choy, 12lb napa", two, False),
        ("sms", "need 5lb bok choy, 12lb napa asap", two, False),
        ("email", "Hi team,\n\nPlease deliver the following to Acme, Inc:\n\n- bok choy: 5 lbs\n- napa: 12 lbs\n\nThanks,\nAcme, Inc Purchasing", two, False),
        ("spreadsheet", "Acme, Inc,bok choy,5,lbs\nAcme, Inc,napa,12,lbs", two, False),
        ("phone", "Phone order from Acme:\n* 5 lb bok choy\n* 12 lb napa", two, False),
        ("in_person", "Walk-in: Acme - 5lb bok choy; 12lb napa", two, False),
        ("text", "need 3lb dragon fruit asap", [(1, 3, None, "unknown_product")], True),
        ("text", "need 3lb gai lan asap", [(1, 3, 20, "ambiguous")], True),
        ("text", "need 99999999999lb napa asap", [(1, None, 11, "bad_quantity")], True),
        ("text", "need 5lb bok choy and also 3 napa", None, True),  # one of two quantities is recognised at best
        ("sms", "Need 14 bx bok choy, 10 crates napa, 6 green onion for Wed AM", [], True),
        ("other", "send 12 choy sum 8 chinese broc", [], True),
        ("text", None, [], True),
    ]
    raw = spark.createDataFrame([(i, t, c) for i, (c, t, _, _) in enumerate(messages)], "raw_order_id long, order_text string, source_channel string")
    products = spark.createDataFrame([(10, "Bok Choy"), (11, "Napa Cabbage"), (20, "gai lan"), (21, "Gai Lan")], "product_id long, product_name string")
    aliases = spark.createDataFrame([("napa", "napa cabbage")], "alias string, product_name string")
    parsed = extract_order_lines(raw, products, aliases)
    got = {}
    for r in parsed.collect():
        got.setdefault(r.raw_order_id, []).append((r.item_no, r.quantity, r.product_id, r.parse_status))
    review = {r.raw_order_id for r in messages_needing_review(raw, parsed).collect()}
    for i, (_, text, lines, bad) in enumerate(messages):
        if lines is not None:
            assert sorted(got.get(i, [])) == lines, text
        assert (i in review) == bad, text


def test_shared_names_resolve_to_one_id(spark):
    raw = spark.createDataFrame([(1, "Acme", ts("2025-04-01T09:30:00"), "text")], "raw_order_id long, customer_name_raw string, received_at timestamp_ntz, source_channel string")
    cust = spark.createDataFrame([(7, "Acme", True), (5, "Acme", True), (3, "Acme", False)], "customer_id long, customer_name string, is_active boolean")
    ok, rejected = writes.resolve_customers(raw, cust)
    assert [(r.raw_order_id, r.customer_id) for r in ok.collect()] == [(1, 5)] and rejected.count() == 0
    assert [tuple(r) for r in writes.ambiguous_names(cust.where("is_active"), "customer_name", "customer_id").collect()] == [("Acme", 5, 2)]


def test_merge_with_a_new_column_keeps_the_other_rows(spark):
    path = tempfile.mkdtemp(prefix="greenlane-merge-") + "/t"
    writes.merge_partitions(spark, path, spark.createDataFrame([(1, "2025-01", 10), (2, "2025-01", 20)], "k int, month string, v int"), ["k", "month"], ["month"])
    acts = writes.merge_partitions(spark, path, spark.createDataFrame([(2, "2025-01", 21, "x")], "k int, month string, v int, note string"), ["k", "month"], ["month"])
    assert sorted((r.k, r._action) for r in acts.collect()) == [(1, "unchanged"), (2, "updated")]
    got = sorted((r.k, r.v, r.note) for r in PartitionedTable(spark, path).read().collect())
    assert got == [(1, 10, None), (2, 21, "x")]


def test_a_failing_read_of_the_target_is_raised(spark):
    import os

    path = tempfile.mkdtemp(prefix="greenlane-merge-") + "/t"
    batch = spark.createDataFrame([(1, "2025-01", 10)], "k int, month string, v int")
    writes.merge_partitions(spark, path, batch, ["k", "month"], ["month"])
    [folder] = PartitionedTable(spark, path).snapshot().folders.values()
    [part] = [f for f in os.listdir(f"{path}/{folder}") if f.endswith(".parquet")]
    with open(f"{path}/{folder}/{part}", "wb") as f:
        f.write(b"not parquet")
    os.remove(f"{path}/{folder}/.{part}.crc")
    with pytest.raises(Exception):  # noqa: B017
        writes.merge_partitions(spark, path, spark.createDataFrame([(2, "2025-01", 20)], "k int, month string, v int"), ["k", "month"], ["month"])
    assert open(f"{path}/{folder}/{part}", "rb").read() == b"not parquet"  # nothing was replaced
    assert PartitionedTable(spark, path).snapshot().number == 1


def test_crash_between_write_and_publication_keeps_the_last_version(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="greenlane-version-")
    writes.write_version(spark.range(3), base)

    def crash(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(writes, "_replace", crash)
    with pytest.raises(RuntimeError):
        writes.write_version(spark.range(5), base)
    monkeypatch.undo()
    assert writes.read_latest(spark, base).count() == 3
    for n in (6, 7, 8):
        writes.write_version(spark.range(n), base, keep=2)
    assert writes.read_latest(spark, base).count() == 8
    assert sum(x.startswith("v=") for x in __import__("os").listdir(base)) == 2
    assert writes.latest_or_none(spark, base + "/none") is None


def test_merge_partitions_rewrites_only_touched(spark):
    path = tempfile.mkdtemp(prefix="greenlane-merge-") + "/t"
    cols = "k int, month string, v int"
    writes.merge_partitions(spark, path, spark.createDataFrame([(1, "2025-01", 10), (2, "2025-02", 20)], cols),
                            ["k", "month"], ["month"])
    before = PartitionedTable(spark, path).snapshot().folders
    acts = writes.merge_partitions(spark, path, spark.createDataFrame([(2, "2025-02", 21), (3, "2025-02", 30)], cols),
                                   ["k", "month"], ["month"])
    assert sorted((r.k, r._action) for r in acts.collect()) == [(2, "updated"), (3, "inserted")]
    after = PartitionedTable(spark, path).snapshot().folders
    assert after["2025-01",] == before["2025-01",] and after["2025-02",] != before["2025-02",]  # untouched partition kept as is
    got = sorted((r.k, r.month, r.v) for r in PartitionedTable(spark, path).read().collect())
    assert got == [(1, "2025-01", 10), (2, "2025-02", 21), (3, "2025-02", 30)]


KMV = "k int, month string, v int"


def test_merge_is_published_in_one_step(spark, monkeypatch):
    """A crash before the rename, and a reader that holds the commit before, see the old rows of all partitions."""
    path = tempfile.mkdtemp(prefix="greenlane-merge-") + "/t"
    merge = lambda rows: writes.merge_partitions(spark, path, spark.createDataFrame(rows, KMV), ["k", "month"], ["month"])
    read = lambda at=None: sorted(map(tuple, PartitionedTable(spark, path).read(at=at).select("k", "month", "v").collect()), key=repr)
    merge([(1, "a", 1), (2, "b", 2), (3, None, 3)])
    old, first = read(), PartitionedTable(spark, path).snapshot()
    monkeypatch.setattr(PartitionedTable, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        merge([(1, "a", 10), (2, "b", 20)])
    monkeypatch.undo()
    assert read() == old
    merge([(1, "a", 10), (3, None, 30)])
    # a NULL in the key conflicts with nothing, so both rows of the NULL partition stay
    assert read() == [(1, "a", 10), (2, "b", 2), (3, None, 3), (3, None, 30)] and read(first) == old
    for v in (11, 12, 13):
        merge([(1, "a", v)])
    assert read() == [(1, "a", 13), (2, "b", 2), (3, None, 3), (3, None, 30)]
    import os

    kept = {f.split("/")[1] for n in (4, 5) for f in PartitionedTable(spark, path)._load(n).folders.values()}
    assert sorted(f for f in os.listdir(f"{path}/_commits") if f.endswith(".json")) == ["000000000004.json", "000000000005.json"]
    assert all(os.path.isdir(f"{path}/data/{f}") for f in kept)


def test_the_second_of_two_writers_is_refused(spark):
    path = tempfile.mkdtemp(prefix="greenlane-merge-") + "/t"
    table = PartitionedTable(spark, path)
    rows = lambda v: spark.createDataFrame([(1, "a", v)], KMV)
    base = table.snapshot()
    table.commit(rows(1), ["month"], base)
    with pytest.raises(ConcurrentCommit):
        table.commit(rows(2), ["month"], base)
    assert [r.v for r in table.read().collect()] == [1]
    table.commit(rows(2), ["month"], table.snapshot())
    assert [r.v for r in table.read().collect()] == [2] and table.read([("nowhere",)]) is None


def test_check_suite_shares_key_shuffles_and_keeps_passing_checks(spark):
    products = [dict(product_id=1, product_name="a", source_type="own_farm", supplier_id=5, standard_price=D("1")),
                dict(product_id=2, product_name="b", source_type="own_farm", supplier_id=9, standard_price=D("1"))]
    suppliers = [dict(supplier_id=5, supplier_name="F", supplier_type="own_farm")]
    w = Warehouse(tables(spark, products=products, suppliers=suppliers))
    summary = dq.run_checks(w, [dq.Check("stg_suppliers", "unique", "supplier_id"),
                                dq.Check("stg_products", "relationships", "supplier_id", to=("stg_suppliers", "supplier_id")),
                                dq.Check("stg_suppliers", "not_null", "supplier_id")])
    rows = [(r.check_name, r.violations, r.status) for r in summary.collect()]
    assert rows == [("unique__stg_suppliers__supplier_id", 0, "pass"),
                    ("relationships__stg_products__supplier_id__stg_suppliers", 1, "fail"),
                    ("not_null__stg_suppliers__supplier_id", 0, "pass")]
    # the supplier key is shuffled once for its uniqueness and for the relationship
    assert "ReusedExchange" in summary._jdf.queryExecution().executedPlan().toString()
