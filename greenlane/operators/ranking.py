"""Global RANK / NTILE / running SUM without funnelling the whole set into one task.

A window with no PARTITION BY is planned by Spark as ``Exchange SinglePartition``:
every row goes to one task. That is right for a few hundred weeks, wrong for an
unbounded number of customers or products. ``rank_and_order`` keeps the built-in
windows while the frame is small (a proven bound: at most ``small_rows`` rows) and
otherwise computes the same answers with partitioned work:

* **RANK** = 1 + number of rows with a strictly better measure. The frame is reduced
  to (group, measure, count) first (map-side combined, so a measure value held by a
  third of the rows collapses to one row), an ordered running count over those
  distinct values gives each value its rank, and the ranks are joined back on the
  value (broadcast only below ``broadcast_rows``; otherwise a shuffle join that AQE
  splits when one value is hot).
* **Position / NTILE / running sum** use the total order (measure, tie column). The
  frame is range-partitioned on that order, partition ids are pinned by a reliable
  checkpoint (range bounds come from a sample, so they must not be recomputed), a
  per-partition summary (at most one row per partition and group) yields exclusive
  prefix counts and sums, and a window local to each partition finishes the job.
  Because the tie column makes every key unique, a hot measure value is spread over
  many partitions instead of landing in one.

All decimal sums stay decimal, so the result does not depend on the order of
addition. Measures are expected to be non-NULL (they are COALESCEd upstream).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .joins import fits


@dataclass(frozen=True)
class RankConfig:
    small_rows: int = 200_000          # at or below: built-in windows (one task, bounded input)
    rows_per_partition: int = 1_000_000
    max_partitions: int = 8192
    broadcast_rows: int = 1_000_000    # largest derived lookup we broadcast


DEFAULT = RankConfig()

_CONF = {"small_rows": "greenlane.rank.smallRows", "rows_per_partition": "greenlane.rank.rowsPerPartition",
         "max_partitions": "greenlane.rank.maxPartitions", "broadcast_rows": "greenlane.rank.broadcastRows"}


def session_config(spark, cfg: RankConfig = DEFAULT) -> RankConfig:
    """``cfg`` with any ``greenlane.rank.*`` settings of the session applied (only for the default config)."""
    if cfg is not DEFAULT:
        return cfg
    values = {}
    for field, key in _CONF.items():
        v = spark.conf.get(key, None)
        if v is not None:
            values[field] = int(v)
    return RankConfig(**values) if values else cfg


def _order_col(name: str, descending: bool) -> Column:
    return F.col(name).desc() if descending else F.col(name).asc()


def _sum_type(dt: T.DataType) -> T.DataType:
    if isinstance(dt, T.DecimalType):
        return T.DecimalType(min(38, dt.precision + 10), dt.scale)
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    return T.DoubleType()


def _materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Reliable checkpoint (survives executor loss, cuts lineage) and its row count."""
    ensure_checkpoint_dir(df.sparkSession)
    cp = df.checkpoint(eager=True)
    return cp, cp.count()


def _shipped(df: DataFrame, n: int, cfg: RankConfig, measured: DataFrame) -> DataFrame:
    """``df`` (``n`` rows) as a side of a join: broadcast while its rows are few and ``measured``, a materialised frame
    of as many rows and like columns, fits a broadcast in bytes; else merged, whatever Spark estimates."""
    return F.broadcast(df) if n <= cfg.broadcast_rows and fits(measured) else df.hint("merge")


def _same_group(df: DataFrame, keyed: DataFrame, group: list[str]) -> Column:
    """Join condition on the groups of ``keyed`` (named ``_k_<group>``); NULL is a group of its own, as in a window."""
    out = F.lit(True)
    for g in group:
        out = out & df[g].eqNullSafe(keyed[f"_k_{g}"])
    return out


def _builtin_scan(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, str],
                  types: dict[str, T.DataType]) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn("_pos", F.row_number().over(w) - 1)
    for name, src in sums.items():
        out = out.withColumn(name, F.sum(src).over(run).cast(types[src]))
    return out


def _range_scan(df: DataFrame, n: int, group: list[str], order: list[Column], sums: dict[str, str],
                types: dict[str, T.DataType], cfg: RankConfig) -> DataFrame:
    k = max(2, min(cfg.max_partitions, math.ceil(n / cfg.rows_per_partition)))
    group_order = [F.col(g).asc() for g in group]
    ranged = df.repartitionByRange(k, *group_order, *order).withColumn("_pid", F.spark_partition_id())
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)  # pin partition ids: range bounds are sampled

    # Per (partition, group) summary: at most k + (#groups) rows.
    summary = ranged.groupBy("_pid", *group).agg(
        F.count(F.lit(1)).alias("_pc"), *[F.sum(src).alias(f"_ps_{name}") for name, src in sums.items()])
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    prefix = summary.select(
        F.col("_pid").alias("_k__pid"), *[F.col(g).alias(f"_k_{g}") for g in group],
        F.coalesce(F.sum("_pc").over(before), F.lit(0)).alias("_pre_pos"),
        *[F.coalesce(F.sum(f"_ps_{name}").over(before), F.lit(0)).alias(f"_pre_{name}") for name in sums],
    )
    prefix, n_prefix = _materialize(prefix)
    prefix = _shipped(prefix, n_prefix, cfg, prefix)

    local = Window.partitionBy("_pid", *group).orderBy(*order)
    run = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.withColumn("_rn", F.row_number().over(local))
    for name, src in sums.items():
        out = out.withColumn(f"_loc_{name}", F.sum(src).over(run))
    out = out.join(prefix, _same_group(out, prefix, ["_pid", *group]))
    out = out.withColumn("_pos", F.col("_pre_pos") + F.col("_rn") - 1)
    for name, src in sums.items():
        out = out.withColumn(name, (F.col(f"_pre_{name}") + F.col(f"_loc_{name}")).cast(types[src]))
    return out.drop("_pid", "_rn", "_pre_pos", "_k__pid", *[f"_k_{g}" for g in group], *[f"_pre_{n}" for n in sums], *[f"_loc_{n}" for n in sums])


def ordered_scan(df: DataFrame, n: int | None, group: list[str], order: list[Column], sums: dict[str, str],
                 cfg: RankConfig = DEFAULT, force_distributed: bool = False, keys: DataFrame | None = None,
                 coarse: DataFrame | None = None) -> DataFrame:
    """Add ``_pos`` (0-based position inside ``group`` by ``order``) and inclusive running sums.

    ``order`` must be a total order within each group; NULL is a group like any other. ``n`` is the
    row count of a frame that is materialised already. With ``n`` None the frame is not copied: rows
    and groups are counted from ``keys`` (a frame with the group columns of the same rows, where one
    is cheaper to read; else ``df`` pruned to them), cold rows stay in the caller's plan, and only
    the rows of hot groups are written, once, as range partitions. ``coarse`` is a frame with the first
    group column of at least these rows, read without joins: no group is larger than its first column's
    count there, so only groups of frequent values are counted, and none where no value is frequent.

    Without groups, a frame above ``cfg.small_rows`` rows takes the range-partitioned
    path. With groups, a plain ``Window.partitionBy(group)`` is already spread over
    tasks; only *hot* groups (more than ``cfg.small_rows`` rows) are split: they are
    found with one count per group, routed through the range-partitioned path, and
    the remaining groups use the built-in window.
    """
    cfg = session_config(df.sparkSession, cfg)
    types = {c: _sum_type(df.schema[c].dataType) for c in sums.values()}
    counted = df if keys is None else keys
    if n is None and (force_distributed or not group):
        n = counted.count()
    if force_distributed:
        return _range_scan(df, n, group, order, sums, types, cfg)
    if n is not None and n <= cfg.small_rows:
        return _builtin_scan(df, group, order, sums, types)
    if not group:
        return _range_scan(df, n, group, order, sums, types, cfg)
    if coarse is not None:
        frequent = coarse.groupBy(F.col(group[0]).alias(f"_k_{group[0]}")).agg(F.count(F.lit(1)).alias("_gn")).where(F.col("_gn") > cfg.small_rows)
        frequent, n_frequent = _materialize(frequent.drop("_gn"))
        if n_frequent == 0:
            return _builtin_scan(df, group, order, sums, types)
        frequent = _shipped(frequent, n_frequent, cfg, frequent)
        counted = counted.join(frequent, _same_group(counted, frequent, group[:1]), "left_semi")
    # At most n / small_rows groups can be hot; the key list is broadcast only below the
    # counted broadcast_rows, otherwise the semi/anti joins shuffle on the group keys.
    hot = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("_gn")).where(F.col("_gn") > cfg.small_rows)
    hot, n_hot = _materialize(hot.select(*[F.col(g).alias(f"_k_{g}") for g in group], "_gn"))
    if n_hot == 0:
        return _builtin_scan(df, group, order, sums, types)
    n_hot_rows = hot.agg(F.sum("_gn")).first()[0]
    hot = _shipped(hot, n_hot, cfg, hot)
    cold_rows = df.join(hot, _same_group(df, hot, group), "left_anti")
    hot_rows = df.join(hot, _same_group(df, hot, group), "left_semi")
    return _builtin_scan(cold_rows, group, order, sums, types).unionByName(
        _range_scan(hot_rows, n_hot_rows, group, order, sums, types, cfg))


def ntile_from_position(pos: Column, n_rows: Column | int, tiles: int) -> Column:
    """NTILE(tiles) of the row at 0-based ``pos`` among ``n_rows``: the first N mod k tiles hold one extra row."""
    n = F.lit(n_rows) if isinstance(n_rows, int) else n_rows
    b = F.call_function("div", n, F.lit(tiles))
    r = n % tiles
    big = r * (b + 1)
    return F.when(pos < big, F.call_function("div", pos, b + 1) + 1).otherwise(
        r + F.call_function("div", pos - big, F.greatest(b, F.lit(1))) + 1).cast("int")


def rank_and_order(
    df: DataFrame,
    measure: str,
    tie: str,
    *,
    ranks: dict[str, list[str] | tuple[str, list[str]]] | None = None,
    ntiles: dict[str, int] | None = None,
    running_sums: dict[str, str] | None = None,
    descending: bool = True,
    strategy: str = "auto",
    cfg: RankConfig = DEFAULT,
    rows: int | None = None,
) -> DataFrame:
    """Window measures over ``measure`` (descending by default).

    * ``ranks``:        out -> partition columns, or (other measure, partition columns);
                        ``RANK() OVER (PARTITION BY p ORDER BY measure)``
    * ``ntiles``:       out -> k; ``NTILE(k) OVER (ORDER BY measure, tie)``
    * ``running_sums``: out -> value column; ``SUM(value) OVER (ORDER BY measure, tie ROWS UNBOUNDED PRECEDING)``

    ``strategy``: ``builtin`` (plain windows), ``distributed`` (force the partitioned
    path, used by tests) or ``auto`` (built-in only while the frame has at most
    ``cfg.small_rows`` rows). ``rows``: the row count of a frame that is materialised already.
    """
    cfg = session_config(df.sparkSession, cfg)
    ranks, ntiles, running_sums = ranks or {}, ntiles or {}, running_sums or {}
    rank_specs = {name: (spec if isinstance(spec, tuple) else (measure, spec)) for name, spec in ranks.items()}
    m_order = _order_col(measure, descending)
    total = [m_order, F.col(tie).asc()]

    if strategy == "builtin":
        out = df
        for name, (m, part) in rank_specs.items():
            out = out.withColumn(name, F.rank().over(Window.partitionBy(*part).orderBy(_order_col(m, descending))))
        w = Window.orderBy(*total)
        for name, k in ntiles.items():
            out = out.withColumn(name, F.ntile(k).over(w))
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for name, src in running_sums.items():
            out = out.withColumn(name, F.sum(src).over(run))
        return out

    base, n = _materialize(df) if rows is None else (df, rows)
    if strategy == "auto" and n <= cfg.small_rows:
        return rank_and_order(base, measure, tie, ranks=ranks, ntiles=ntiles, running_sums=running_sums,
                              descending=descending, strategy="builtin", cfg=cfg)
    force = strategy == "distributed"

    out = base
    if ntiles or running_sums:
        out = ordered_scan(base, n, [], total, running_sums, cfg, force)
        for name, k in ntiles.items():
            out = out.withColumn(name, ntile_from_position(F.col("_pos"), n, k))
        out = out.drop("_pos")

    for name, (m, part) in rank_specs.items():
        values = base.groupBy(*part, m).agg(F.count(F.lit(1)).alias("_cnt"))
        values, n_values = _materialize(values)
        scanned = ordered_scan(values, n_values, list(part), [_order_col(m, descending)], {"_cum": "_cnt"}, cfg, force)
        lookup = scanned.select(*part, m, (F.col("_cum") - F.col("_cnt") + 1).cast("int").alias(name))
        lookup = _shipped(lookup, n_values, cfg, values)
        keys = [*part, m]
        lk = lookup.select(*[F.col(c).alias(f"_k_{c}") for c in keys], name)
        cond = [out[c].eqNullSafe(lk[f"_k_{c}"]) for c in keys]
        out = out.join(lk, cond, "inner").drop(*[f"_k_{c}" for c in keys])
    return out
