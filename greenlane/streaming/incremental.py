"""Incremental refresh driven by an ``updated_at`` high-water mark.

An insert-only source needs no copy of its lines. The state is one versioned table, the log: the partial
sums of each (order week, update day), one row a pair. A refresh

1. reads the source rows from the mark's calendar day on; the mark is the newest ``updated_at`` in the log. The day is
   read again as a whole, because rows may arrive later with the mark's own timestamp or another time of that day;
2. sums them per (order week, update day);
3. writes a new version of the log: the rows of earlier days, and the new sums in place of those of the days that were
   read again. Days more than ``KEPT_DAYS`` before the mark are folded into one, so the log holds at most weeks x (days
   kept + 1) rows, whatever the number of lines, in as few files as one shuffle's output makes;
4. sums the log per week and computes the rolling rates over those weeks (one row per week: a bounded frame).

Publication is one rename, mark included, so a failed refresh changes nothing and is simply run again.
``since`` reads an earlier day again too, for a backfill with old timestamps.

A source whose lines change (``key``) keeps the newest version of each line, partitioned by the month in which the order
week starts: a changed line must take back what it gave before. Touched months are rewritten in one commit, their
touched weeks summed anew, and the mark is advanced last. The touched weeks are a handful of dates per refresh.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.partitioned import PartitionedTable
from ..operators.writes import latest_or_none, merge_partitions, read_latest, write_version
from ..plans.kpi import weekly_fill_rate

KEPT_DAYS = 92
QUANTITIES = ("requested_quantity", "confirmed_quantity")


def _weekly(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("order_week").alias("week_start")).agg(*[F.sum(c).alias(c) for c in QUANTITIES])


def _from_day(lines: DataFrame, day: dt.date | None) -> DataFrame:
    return lines if day is None else lines.where(F.col("updated_at") >= F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz"))


def refresh_weekly_fill(spark: SparkSession, lines: DataFrame, state: str, key: list[str] | None = None, since: dt.date | None = None) -> DataFrame:
    """``lines``: order_week, requested_quantity, confirmed_quantity (0 for NULL), updated_at (+ key columns)."""
    state = state.rstrip("/")
    return _refresh_keyed(spark, lines, state, key) if key else _refresh_log(spark, lines, state, since)


def _refresh_log(spark: SparkSession, lines: DataFrame, state: str, since: dt.date | None) -> DataFrame:
    base = f"{state}/log"
    log = latest_or_none(spark, base)
    mark = None if log is None else log.agg(F.max("hwm").alias("hwm"), F.min("update_day").alias("first_day")).first()
    day = mark["hwm"].date() if mark and mark["hwm"] else None
    if since and day:
        if since <= mark["first_day"] and mark["first_day"] <= day - dt.timedelta(days=KEPT_DAYS):
            raise ValueError(f"the days up to {mark['first_day']} are folded into one and cannot be read again")
        day = min(day, since)
    new = _from_day(lines, day).withColumn("update_day", F.to_date("updated_at")).groupBy("order_week", "update_day").agg(
        *[F.sum(c).alias(c) for c in QUANTITIES], F.max("updated_at").alias("hwm"))
    if log is not None and day is not None:
        folded = F.greatest("update_day", F.lit(mark["hwm"].date() - dt.timedelta(days=KEPT_DAYS)))
        types = {c: new.schema[c].dataType for c in QUANTITIES}
        old = log.where(F.col("update_day") < F.lit(day)).groupBy("order_week", folded.alias("update_day")).agg(
            *[F.sum(c).cast(types[c]).alias(c) for c in QUANTITIES], F.max("hwm").alias("hwm"))
        new = old.unionByName(new)
    write_version(new.repartition(1), base, keep=2)  # some weeks x days rows: one file
    return weekly_fill_rate(_weekly(read_latest(spark, base)))


def _refresh_keyed(spark: SparkSession, lines: DataFrame, state: str, key: list[str]) -> DataFrame:
    mark = latest_or_none(spark, f"{state}/hwm")
    hwm = None if mark is None else mark.first()["hwm"]
    new = _from_day(lines, hwm and hwm.date())
    marks = new.agg(F.max("updated_at").alias("hwm"), F.collect_set("order_week").alias("weeks")).first()
    if marks["hwm"] is None:
        return weekly_fill_rate(read_latest(spark, f"{state}/weekly"))
    weeks = marks["weeks"]
    store = f"{state}/lines"
    # a line keeps its order week, so the partition column extends the key
    merge_partitions(spark, store, new.withColumn("order_month", F.trunc("order_week", "month")), [*key, "order_month"], ["order_month"], order_col="updated_at")
    months = {(w.replace(day=1),) for w in weeks}
    weekly = _weekly(PartitionedTable(spark, store).read(months).where(F.col("order_week").isin(weeks)))
    if hwm is not None:
        weekly = read_latest(spark, f"{state}/weekly").where(~F.col("week_start").isin(weeks)).unionByName(weekly)
    write_version(weekly, f"{state}/weekly", keep=2)
    write_version(spark.createDataFrame([(marks["hwm"],)], "hwm timestamp_ntz"), f"{state}/hwm", keep=2)
    return weekly_fill_rate(read_latest(spark, f"{state}/weekly"))
