"""The build job: staging -> core -> KPI marts -> checks, written as Parquet.

The enriched lines are written first; order facts, order reconciliation and the customer
dimension aggregate the *written* lines, and every KPI mart reads the written core, so the
line-grain joins run once per build. Facts are partitioned by month and sorted inside
files by their common lookup keys. The written tables also cut lineage, so a lost executor
never recomputes the whole chain. Checks run on the written output, KPI marts included; error-severity failures stop the build after the report is
saved, warnings are only reported.

Disk beside the tables holds the shuffles of one step at a time, which go when the step has run. The steps with the largest are cut: the
enriched lines are written in slices of orders, each of which reads the tables once more but shuffles only its share, the
marts of the lines come before the other tables, and the checks run in groups that share no shuffled keys.
"""

from __future__ import annotations

import math
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as dq
from ..session import shuffles_freed
from ..sources.io import Tables, write_overwrite
from .core import Warehouse
from .kpi import KPI_MARTS

CORE_LAYOUT = {
    # model: (partition columns, sort-within-partition columns)
    "fct_order_items": (["order_month"], ["customer_id", "order_date", "order_id"]),
    "order_facts": (["order_month"], ["customer_id", "order_date"]),
    "fct_orders": (["order_month"], ["customer_id", "order_date"]),
    "fct_deliveries": (["scheduled_month"], ["driver_worker_id", "scheduled_date"]),
    "fct_worker_shifts": ([], ["worker_id", "shift_date"]),
    "dim_customers": ([], ["customer_id"]),
    "dim_products": ([], ["product_id"]),
    "dim_workers": ([], ["worker_id"]),
}
# Lines up to which they are written at once, and the slices that more are cut into at most: each reads all lines.
SLICE_ROWS, SLICES = 1_200_000, 8
# Marts of the lines alone. Their shuffles are among the largest: they run while the lines are the only table on disk.
LINE_MARTS = ("kpi_product_demand", "kpi_source_type_fill_rate")
_MONTH_OF = {"order_month": "order_date", "scheduled_month": "scheduled_date"}


class BuiltWarehouse(Warehouse):
    """A warehouse whose core models are read back from a build directory as they get written."""

    count_keys = True

    def __init__(self, spark: SparkSession, src: Tables, root: str):
        super().__init__(src)
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.root}/core/{name}")
        return df.drop(*[c for c in _MONTH_OF if c in df.columns])

    def mart(self, name: str) -> DataFrame:
        """A written KPI mart."""
        return self.spark.read.parquet(f"{self.root}/kpi/{name}")

    def derived_order_facts(self) -> DataFrame:
        """``order_facts`` from the written lines: one aggregation, no joins."""
        header = ("order_id", "order_date", "order_week", "customer_id", "customer_name", "market_type")
        return self.int_order_items_enriched.groupBy(*header).agg(
            F.count(F.lit(1)).alias("line_count"), F.sum("requested_value").alias("line_requested_value"),
            F.sum("confirmed_revenue").alias("line_confirmed_revenue"), F.sum("requested_quantity").alias("line_requested_quantity"),
            F.sum("confirmed_quantity").alias("line_confirmed_quantity"))

    @property
    def order_totals(self) -> DataFrame:
        return self.order_facts

    @cached_property
    def int_order_items_enriched(self) -> DataFrame:
        return self._read("fct_order_items")

    @cached_property
    def int_deliveries_enriched(self) -> DataFrame:
        return self._read("fct_deliveries")

    @cached_property
    def fct_orders(self) -> DataFrame:
        return self._read("fct_orders")

    @cached_property
    def order_facts(self) -> DataFrame:
        return self._read("order_facts")

    @cached_property
    def fct_worker_shifts(self) -> DataFrame:
        return self._read("fct_worker_shifts")

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self._read("dim_customers")

    @cached_property
    def dim_products(self) -> DataFrame:
        return self._read("dim_products")

    @cached_property
    def dim_workers(self) -> DataFrame:
        return self._read("dim_workers")


class SlicedWarehouse(Warehouse):
    """The orders of one of ``n`` slices with their lines; dimensions are measured once for all slices."""

    count_keys = True

    def __init__(self, src: Tables, k: int, n: int, fits: dict):
        for name in ("orders_cleaned", "order_items") if n > 1 else ():
            src = src.with_table(name, src[name].where(F.pmod(F.xxhash64("order_id"), F.lit(n)) == k))
        super().__init__(src)
        self._fits = fits


def line_slices(src: Tables) -> int:
    """Slices in which the enriched lines are written: as many as there are ``SLICE_ROWS`` lines, ``SLICES`` at most."""
    return max(1, min(SLICES, math.ceil(src.order_items.count() / SLICE_ROWS)))


def _with_month(df: DataFrame, parts: list[str]) -> DataFrame:
    for month_col, date_col in _MONTH_OF.items():
        if month_col in parts:
            df = df.withColumn(month_col, F.date_format(date_col, "yyyy-MM"))
    return df


def checked(models, checks: list[dq.Check]) -> DataFrame:
    """The summary of ``run_checks``, a group of checks at a time; a row per check passes through the driver."""
    groups = [dq.run_checks(models, group) for group in dq.check_groups(checks)]
    rows = {r["check_name"]: r for df in groups for r in df.collect()}
    return models.spark.createDataFrame([rows[c.name] for c in checks], groups[0].schema).coalesce(1)


def build(spark: SparkSession, src: Tables, root: str, fail_on_error: bool = False) -> dict[str, int]:
    """Write core and KPI tables under ``root``; returns rows written per table (plus the check report)."""
    with shuffles_freed(spark):
        report = _build(spark, src, root.rstrip("/"))
    if fail_on_error:
        dq.raise_on_error(spark.read.parquet(f"{root.rstrip('/')}/checks"))
    return report


def _build(spark: SparkSession, src: Tables, root: str) -> dict[str, int]:
    w, built = SlicedWarehouse(src, 0, 1, {}), BuiltWarehouse(spark, src, root)
    report: dict[str, int] = {}
    for name, (parts, sort) in CORE_LAYOUT.items():
        if name == "fct_order_items":
            n = line_slices(src)
            dfs = (SlicedWarehouse(src, k, n, w._fits).fct_order_items for k in range(n))
        elif name == "order_facts":
            dfs = [built.derived_order_facts()]
        elif name in ("fct_orders", "dim_customers"):  # from the order facts just written
            dfs = [getattr(Warehouse, name).func(built)]
        else:
            dfs = [getattr(w, name)]
        report[f"core/{name}"] = sum(
            write_overwrite(_with_month(df, parts), f"{root}/core/{name}", partition_by=parts, sort_within=sort, append=k > 0, compression="zstd")
            for k, df in enumerate(dfs))
        if name == "fct_order_items":
            for mart in LINE_MARTS:
                report[f"kpi/{mart}"] = write_overwrite(KPI_MARTS[mart](built), f"{root}/kpi/{mart}")
    for name, fn in KPI_MARTS.items():
        if name not in LINE_MARTS:
            report[f"kpi/{name}"] = write_overwrite(fn(built), f"{root}/kpi/{name}")
    checks = checked(built, dq.STAGING_CHECKS + dq.CORE_CHECKS + dq.KPI_CHECKS)
    report["checks"] = write_overwrite(checks, f"{root}/checks")
    return report
