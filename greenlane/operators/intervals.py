"""Sweep lines and runs over ordered events, split over tasks also within one driver or product.

Both reduce the rows to one per (key, instant) first and then take one running sum in the order of the instants
(``operators.ranking.ordered_scan``: a built-in window while a key is small, range-partitioned with prefix sums for a hot one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import DEFAULT, RankConfig, _materialize, ordered_scan


def open_intervals(intervals: DataFrame, key: str, strategy: str = "auto", cfg: RankConfig = DEFAULT) -> DataFrame:
    """(key, at, open): after every instant at which it changes, how many of the key's half-open [begins_at, ends_at) are open.

    Empty and reversed intervals and those with a NULL end are never open. What begins and ends at one instant is netted there.
    """
    real = intervals.where("begins_at < ends_at")
    step = lambda at, by: F.struct(F.col(at).alias("at"), F.lit(by).cast("long").alias("step"))
    events = real.select(key, F.inline(F.array(step("begins_at", 1), step("ends_at", -1)))).groupBy(key, "at").agg(F.sum("step").alias("step")).where("step <> 0")
    base, n = _materialize(events)
    return ordered_scan(base, n, [key], [F.col("at").asc()], {"open": "step"}, cfg, force_distributed=strategy == "distributed").select(key, "at", "open")


def runs_of_days(days: DataFrame, key: str, day: str, flag: str, strategy: str = "auto", cfg: RankConfig = DEFAULT) -> DataFrame:
    """``days`` (one row per key and day) where ``flag`` holds, with ``run``: equal for days that no unflagged day of the key parts.

    The number of unflagged days before a day is the same over such a run and differs between runs.
    """
    base, n = _materialize(days.withColumn("_parted", F.when(F.col(flag), 0).otherwise(1).cast("long")))
    scanned = ordered_scan(base, n, [key], [F.col(day).asc()], {"run": "_parted"}, cfg, force_distributed=strategy == "distributed")
    return scanned.where(flag).drop("_pos", "_parted")
