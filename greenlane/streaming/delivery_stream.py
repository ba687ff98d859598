"""Daily on-time counts maintained by Structured Streaming, with corrections.

A delivery may come again: re-sent, re-scheduled, or with another status. The state is a keyed table of the newest version of
each delivery, in folders by ranges of the delivery id (new ids lie together, and so do most corrections), with the
totals per calendar day beside it. Each micro-batch finds the versions that are newer than the stored ones, takes back what
the stored version counted, adds what the new one counts, and publishes versions, totals and its own number in one commit.
A batch that was published before is skipped, so a replay after a failure changes nothing.

Newer is the greater ``updated_at`` (where the stream has that column); at equal or missing times the later batch, within a
batch the later day, then on time. Deliveries without an id cannot be corrected and count each time they come. There is no
watermark: a backfill arrives in any order of event time, and a watermark would drop it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import on_time_flag
from ..operators.partitioned import PartitionedTable
from ..operators.writes import _fs
from ..plans.staging import stg_deliveries
from ..session import ensure_checkpoint_dir

#: Deliveries per folder of the version table, by id.
IDS_PER_RANGE = 1 << 20
COUNTS = ("deliveries", "on_time_deliveries")
_NEVER = "0001-01-01 00:00:00"


def daily_on_time_counts(deliveries: DataFrame) -> DataFrame:
    """Totals per scheduled day of deliveries that come once each (a batch)."""
    return deliveries.groupBy(F.col("scheduled_at").cast("date").alias("delivery_date")).agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.sum(on_time_flag("delivery_status", "delivered_at", "scheduled_at")).alias("on_time_deliveries"))


def apply_deliveries(spark: SparkSession, target: str, batch: DataFrame, batch_id: int, source: str, ids_per_range: int = IDS_PER_RANGE) -> None:
    """One micro-batch of ``source`` into the versions and totals at ``target``."""
    ensure_checkpoint_dir(spark)
    table = PartitionedTable(spark, target)
    base = table.snapshot()
    done = base.meta.get("batches", {})
    if done.get(source, -1) >= batch_id:
        return
    updated = F.col("updated_at").cast("timestamp_ntz") if "updated_at" in batch.columns else F.lit(None).cast("timestamp_ntz")
    rows = batch.select(
        "delivery_id", F.coalesce(updated, F.lit(_NEVER).cast("timestamp_ntz")).alias("version"), F.col("scheduled_at").cast("date").alias("day"),
        on_time_flag("delivery_status", "delivered_at", "scheduled_at").cast("long").alias("on_time")).checkpoint()
    newest = rows.where("delivery_id IS NOT NULL").groupBy("delivery_id").agg(F.max(F.struct("version", "day", "on_time")).alias("v")).select(
        "delivery_id", F.floor(F.col("delivery_id") / ids_per_range).alias("id_range"), "v.*").checkpoint()
    touched = [tuple(r) for r in newest.select(F.col("id_range").cast("string")).distinct().collect()]
    stored = table.read(touched, base)
    stored = newest.limit(0) if stored is None else stored
    old = stored.select("delivery_id", "id_range", *[F.col(c).alias(f"old_{c}") for c in ("version", "day", "on_time")], F.lit(True).alias("known"))
    both = old.join(newest.withColumn("came", F.lit(True)), ["delivery_id", "id_range"], "full_outer")
    taken = F.col("came").isNotNull() & (F.col("known").isNull() | (F.col("version") >= F.col("old_version")))
    both = both.withColumn("taken", taken).checkpoint()
    pick = lambda c: F.when(F.col("taken"), F.col(c)).otherwise(F.col(f"old_{c}")).alias(c)
    change = F.filter(F.array(
        F.struct(F.col("day").alias("delivery_date"), F.lit(1).cast("long").alias("deliveries"), F.col("on_time").alias("on_time_deliveries")),
        F.when(F.col("known"), F.struct(F.col("old_day").alias("delivery_date"), F.lit(-1).cast("long").alias("deliveries"), (-F.col("old_on_time")).alias("on_time_deliveries")))),
        lambda x: x.isNotNull())
    changes = both.where("taken").select(F.inline(change))
    without_id = rows.where("delivery_id IS NULL").select(F.col("day").alias("delivery_date"), F.lit(1).cast("long").alias("deliveries"), F.col("on_time").alias("on_time_deliveries"))
    before = table.table("totals", base)
    parts = changes.unionByName(without_id) if before is None else changes.unionByName(without_id).unionByName(before)
    totals = parts.groupBy("delivery_date").agg(*[F.sum(c).alias(c) for c in COUNTS]).where("deliveries <> 0")
    table.commit(both.select("delivery_id", "id_range", pick("version"), pick("day"), pick("on_time")), ["id_range"], base, spread=["delivery_id"],
                 tables={"totals": totals}, meta={"batches": {**done, source: batch_id}})


def run_daily_on_time_stream(spark: SparkSession, stream: DataFrame, target: str, checkpoint: str, ids_per_range: int = IDS_PER_RANGE) -> DataFrame:
    """Process everything that is available and return the per-day totals table."""
    query = (stream.writeStream.foreachBatch(lambda batch, batch_id: apply_deliveries(spark, target, batch, batch_id, checkpoint, ids_per_range))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    totals = PartitionedTable(spark, target).table("totals")
    return daily_on_time_counts(stg_deliveries(_no_deliveries(spark))) if totals is None else totals


def _no_deliveries(spark: SparkSession) -> DataFrame:
    from ..sources.schemas import SCHEMAS

    return spark.createDataFrame([], SCHEMAS["deliveries"])


def stream_from_orders(spark: SparkSession, sf_dir: str, files_per_batch: int | None = None) -> DataFrame:
    """A file stream over the orders table (one file or a directory of part files), mapped to staged deliveries."""
    from ..sources.adapters import deliveries_from_orders, source_schema

    reader = spark.readStream.schema(source_schema("orders"))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    fs, path = _fs(spark, f"{sf_dir.rstrip('/')}/orders.parquet")
    if fs.getFileStatus(path).isDirectory():
        orders = reader.parquet(path.toString())
    else:
        orders = reader.option("pathGlobFilter", path.getName()).parquet(sf_dir)
    return stg_deliveries(deliveries_from_orders(orders, None))


def _scratch(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/greenlane-stream-{uuid.uuid4().hex}"


def streaming_daily_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _scratch(spark)
    return run_daily_on_time_stream(spark, stream_from_orders(spark, sf_dir), f"{base}/table", f"{base}/checkpoint")


def streaming_corrected_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deliveries, then corrections from a second stream: every 7th failed after all, every 11th was moved a day later."""
    base = _scratch(spark)
    sent = stream_from_orders(spark, sf_dir)
    run_daily_on_time_stream(spark, sent, f"{base}/table", f"{base}/checkpoint")
    moved = F.expr("CASE WHEN delivery_id % 11 = 0 THEN scheduled_at + INTERVAL 1 DAY ELSE scheduled_at END")
    again = sent.where("delivery_id % 7 = 0 OR delivery_id % 11 = 0").withColumns({
        "scheduled_at": moved, "delivery_status": F.expr("CASE WHEN delivery_id % 7 = 0 THEN 'failed' ELSE delivery_status END")})
    return run_daily_on_time_stream(spark, again, f"{base}/table", f"{base}/corrections")
