"""Distributed RANK / NTILE / running sum must equal the built-in windows, ties included."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from greenlane.operators.ranking import RankConfig, _materialize, ordered_scan, rank_and_order

TINY = RankConfig(small_rows=10, rows_per_partition=37, max_partitions=64, broadcast_rows=5)


def _frame(spark, n, distinct):
    rows = [(i, Decimal(((i * 7919) % distinct)) / 4, ["a", "b", "c"][i % 3], i % 7) for i in range(n)]
    return spark.createDataFrame(rows, "id long, m decimal(12,2), g string, m2 int")


def _run(df, strategy):
    out = rank_and_order(df, "m", "id", ranks={"r_all": [], "r_g": ["g"], "r_m2": ("m2", [])}, ntiles={"q4": 4, "q7": 7},
                         running_sums={"run": "m"}, strategy=strategy, cfg=TINY)
    return sorted(tuple(r) for r in out.select("id", "m", "g", "r_all", "r_g", "r_m2", "q4", "q7", "run").collect())


@pytest.mark.parametrize("n,distinct", [(500, 3), (500, 1), (400, 400), (3, 2), (1, 1), (257, 50)])
def test_distributed_equals_builtin(spark, n, distinct):
    df = _frame(spark, n, distinct)
    assert _run(df, "distributed") == _run(df, "builtin")


def test_hot_value_is_spread_over_partitions(spark):
    # one measure value holds a third of the rows: the (measure, id) range split must not keep it in one task
    rows = [(i, Decimal(0) if i % 3 == 0 else Decimal(i), "a") for i in range(900)]
    df = spark.createDataFrame(rows, "id long, m decimal(12,2), g string")
    base, n = _materialize(df)
    cfg = RankConfig(small_rows=10, rows_per_partition=100, max_partitions=64)
    ranged = base.repartitionByRange(9, F.col("m").desc(), F.col("id")).withColumn("pid", F.spark_partition_id())
    sizes = [r["count"] for r in ranged.where("m = 0").groupBy("pid").count().collect()]
    assert len(sizes) >= 3
    scanned = ordered_scan(base, n, [], [F.col("m").desc(), F.col("id").asc()], {"run": "m"}, cfg, True)
    got = sorted((r.id, r._pos) for r in scanned.collect())
    expect = sorted((i, p) for p, i in enumerate(sorted(range(900), key=lambda i: (-(0 if i % 3 == 0 else i), i))))
    assert got == expect


def test_grouped_scan_matches_window(spark):
    rows = [(i, i % 2, Decimal(i % 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, g int, v decimal(10,2)")
    base, n = _materialize(df)
    order = [F.col("v").asc(), F.col("id").asc()]
    a = ordered_scan(base, n, ["g"], order, {"s": "v"}, TINY, True)
    b = ordered_scan(base, n, ["g"], order, {"s": "v"}, RankConfig(), False)
    key = lambda d: sorted(tuple(r) for r in d.select("id", "g", "_pos", "s").collect())
    assert key(a) == key(b)


def test_ntile_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(1, Decimal(5)), (2, Decimal(3))], "id long, m decimal(10,2)")
    for strategy in ("builtin", "distributed"):
        got = sorted(tuple(r) for r in rank_and_order(df, "m", "id", ntiles={"q": 4}, strategy=strategy, cfg=TINY)
                     .select("id", "q").collect())
        assert got == [(1, 1), (2, 2)]


def test_hot_groups_are_split_and_cold_groups_stay_builtin(spark):
    # group 0 holds 60% of the rows (hot under a bound of 100); groups 1..9 are small
    rows = [(i, 0 if i % 5 < 3 else 1 + i % 9, Decimal(i % 13)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, g int, v decimal(10,2)")
    base, n = _materialize(df)
    order = [F.col("v").desc(), F.col("id").asc()]
    cfg = RankConfig(small_rows=100, rows_per_partition=50, max_partitions=64)
    got = ordered_scan(base, n, ["g"], order, {"s": "v"}, cfg)
    ref = ordered_scan(base, n, ["g"], order, {"s": "v"}, RankConfig(small_rows=10**9))
    key = lambda d: sorted(tuple(r) for r in d.select("id", "g", "_pos", "s").collect())
    assert key(got) == key(ref)


def test_hot_groups_above_broadcast_bound_use_shuffle_joins(spark):
    # three hot groups with a broadcast bound of one key: the hot-key joins must shuffle
    rows = [(i, i % 4 if i % 10 < 9 else 4 + i % 7, Decimal(i % 11)) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, g int, v decimal(10,2)")
    base, n = _materialize(df)
    order = [F.col("v").asc(), F.col("id").asc()]
    cfg = RankConfig(small_rows=100, rows_per_partition=60, max_partitions=64, broadcast_rows=1)
    got = ordered_scan(base, n, ["g"], order, {"s": "v"}, cfg)
    ref = ordered_scan(base, n, ["g"], order, {"s": "v"}, RankConfig(small_rows=10**9))
    key = lambda d: sorted(tuple(r) for r in d.select("id", "g", "_pos", "s").collect())
    assert key(got) == key(ref)


@pytest.mark.parametrize("broadcast_rows", [1, 1000])
def test_frames_that_are_not_materialised_and_null_groups(spark, broadcast_rows):
    # the NULL group is hot; rows and groups are counted from the frame itself or from another one
    rows = [(i, None if i % 3 == 0 else i % 4 if i % 5 else 10 + i % 50, Decimal(i % 11)) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, g int, v decimal(10,2)").repartition(5)
    order = [F.col("v").desc(), F.col("id").asc()]
    cfg = RankConfig(small_rows=100, rows_per_partition=60, max_partitions=64, broadcast_rows=broadcast_rows)
    key = lambda d: sorted((tuple(r) for r in d.select("id", "g", "_pos", "s").collect()), key=repr)
    ref = key(ordered_scan(df, 1200, ["g"], order, {"s": "v"}, RankConfig(small_rows=10**9)))
    assert key(ordered_scan(df, None, ["g"], order, {"s": "v"}, cfg)) == ref
    assert key(ordered_scan(df, None, ["g"], order, {"s": "v"}, cfg, keys=df.select("g"))) == ref
    assert key(ordered_scan(df, None, ["g"], order, {"s": "v"}, cfg, True)) == ref
    more = df.select("g").union(df.select("g").where("g = 1"))
    assert key(ordered_scan(df, None, ["g"], order, {"s": "v"}, cfg, coarse=more)) == ref
    two = df.withColumn("h", F.col("id") % 2)
    by_two = lambda c, **kw: key(ordered_scan(two, None, ["g", "h"], order, {"s": "v"}, c, **kw))
    assert by_two(cfg, coarse=more) == by_two(RankConfig(small_rows=10**9))


def test_cold_groups_stay_in_the_plan_of_their_files(spark, tmp_path):
    spark.range(400).selectExpr("id", "cast(id % 40 as int) g", "cast(1 as decimal(10,2)) v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = ordered_scan(df, None, ["g"], [F.col("id").asc()], {"s": "v"}, RankConfig(small_rows=100))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "ExistingRDD" not in plan and out.where("_pos = 9 AND s = 10").count() == 40
