"""Write-path operators (U1-U11): set-based versions of the row-by-row jobs.

Upserts are a keyed merge expressed as one full outer join; the merged table, or its touched
partitions, are written to new directories and only then published (all-or-nothing).
Selection jobs (what still needs cleaning / items / a delivery) are anti joins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import norm
from .partitioned import PartitionedTable


# -- U1 / U2: keyed upsert ---------------------------------------------------
def latest_per_key(batch: DataFrame, key: list[str], order_col: str) -> DataFrame:
    """One row per key, the one with the greatest ``order_col`` (a later row wins).

    ``max_by`` aggregates partially before the shuffle, so a key repeated by a third
    of the batch is reduced on the map side instead of piling into one task.
    """
    rest = [c for c in batch.columns if c not in key]
    return batch.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_row")).select(*key, "_row.*")


def upsert(target: DataFrame, batch: DataFrame, key: list[str], update_cols: list[str] | None = None,
           order_col: str | None = None, now: Column | None = None) -> DataFrame:
    """INSERT ... ON CONFLICT (key) DO UPDATE SET update_cols, updated_at = now.

    New rows take every column that the batch has; existing rows keep all but ``update_cols``
    (default: every batch column outside the key).
    Returns the merged table plus ``_action`` ('inserted' | 'updated' | 'unchanged').
    ``now`` is passed in (default: current_timestamp) so a run can be replayed.
    """
    if order_col:
        batch = latest_per_key(batch, key, order_col)
    now = now if now is not None else F.localtimestamp()
    update_cols = update_cols or [c for c in batch.columns if c not in key and c in target.columns]
    brought = [c for c in batch.columns if c not in key and c in target.columns]
    b = batch.select(*key, *[F.col(c).alias(f"_b_{c}") for c in brought], F.lit(True).alias("_in_batch"))
    t = target.withColumn("_in_target", F.lit(True))
    j = t.join(b, key, "full_outer")
    in_b, in_t = F.col("_in_batch").isNotNull(), F.col("_in_target").isNotNull()
    cols = []
    for c in target.columns:
        if c in key:
            cols.append(F.col(c))
        elif c in update_cols:
            cols.append(F.when(in_b, F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c))
        elif c in brought:
            cols.append(F.when(in_t, F.col(c)).otherwise(F.col(f"_b_{c}")).alias(c))
        elif c == "updated_at":
            cols.append(F.when(in_b, now.cast("timestamp_ntz")).otherwise(F.col(c)).alias(c))
        elif c == "created_at":
            cols.append(F.when(in_t, F.col(c)).otherwise(now.cast("timestamp_ntz")).alias(c))
        else:
            cols.append(F.col(c))
    action = F.when(in_b & in_t, F.lit("updated")).when(in_b, F.lit("inserted")).otherwise(F.lit("unchanged"))
    return j.select(*cols, action.alias("_action"))


def merge_partitions(spark: SparkSession, path: str, batch: DataFrame, key: list[str], partition_by: list[str],
                     update_cols: list[str] | None = None, order_col: str | None = None,
                     now: Column | None = None) -> DataFrame:
    """Upsert ``batch`` into the ``PartitionedTable`` at ``path``, rewriting only touched partitions, in one commit.

    The partition values present in the batch are few (bounded by the partitioning, e.g.
    months): only their folders are read and replaced. The partition columns must be part of
    ``key`` (a key never moves between partitions). A reader sees the table before or after the merge; a
    writer that committed in between makes this one fail with ``ConcurrentCommit``, to be run again.
    A batch may bring new columns: stored rows get NULL there, and readers merge the file schemas.
    Returns the per-row actions of the touched partitions.
    """
    if not set(partition_by) <= set(key):
        raise ValueError("partition columns must be part of the key")
    if order_col:
        batch = latest_per_key(batch, key, order_col)
    table = PartitionedTable(spark, path)
    base = table.snapshot()
    touched = [tuple(r) for r in batch.select(*[F.col(c).cast("string") for c in partition_by]).distinct().collect()]
    # any failure of this read is raised: taking it for "no table yet" would drop the stored rows
    stored = table.read(touched, base)
    if stored is None:
        existing = batch.limit(0)
    else:
        added = [c for c in batch.columns if c not in stored.columns]
        stored = stored.select("*", *[F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in added])
        existing = stored.select(*batch.columns, *[c for c in stored.columns if c not in batch.columns])
    merged, _ = _checkpointed(upsert(existing, batch, key, update_cols, now=now))
    table.commit(merged.drop("_action"), partition_by, base, spread=[k for k in key if k not in partition_by])
    return merged


def _checkpointed(df: DataFrame):
    from .ranking import _materialize

    return _materialize(df)


def upsert_outcome_counts(merged: DataFrame) -> DataFrame:
    """How many batch rows were inserted vs updated (PostgreSQL's xmax = 0 test)."""
    return merged.where("_action <> 'unchanged'").groupBy("_action").agg(F.count(F.lit(1)).alias("rows"))


# -- U9 / U11: guarded and atomic writes ---------------------------------------
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """True when the path is there; anything but "not found" is raised."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _replace(spark: SparkSession, source, target) -> None:
    """Rename over an existing file in one step (raises if the file system refuses)."""
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(source, target, options)


def write_version(df: DataFrame, base: str, keep: int | None = None) -> str:
    """Write to a fresh version directory, then publish it by replacing the ``_LATEST`` pointer.

    The pointer is renamed over the old one in a single step, so readers see either the old or
    the new version and a crash at any point leaves one of them current. ``keep`` deletes all
    but that many newest versions after the publication (at least 2: a reader may still be on the last one).
    """
    spark, base = df.sparkSession, base.rstrip("/")
    version = f"v={uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{base}/{version}")
    fs, pointer = _fs(spark, f"{base}/_LATEST")
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/_LATEST.{version}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(version.encode()))
    out.close()
    _replace(spark, tmp, pointer)
    if keep is not None:
        _, root = _fs(spark, base)
        versions = sorted((f for f in fs.listStatus(root) if f.getPath().getName().startswith("v=")), key=lambda f: -f.getModificationTime())
        for old in versions[max(2, keep):]:
            if old.getPath().getName() != version:
                fs.delete(old.getPath(), True)
    return version


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    fs, pointer = _fs(spark, f"{base.rstrip('/')}/_LATEST")
    stream = fs.open(pointer)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(spark.sparkContext._jvm.java.io.InputStreamReader(stream))
    version = reader.readLine()
    reader.close()
    return spark.read.parquet(f"{base.rstrip('/')}/{version}")


def latest_or_none(spark: SparkSession, base: str) -> DataFrame | None:
    """The published version, or None where nothing was ever published; a failing read is raised."""
    return read_latest(spark, base) if exists(spark, f"{base.rstrip('/')}/_LATEST") else None


def load_if_empty(target: DataFrame, batch: DataFrame, path: str) -> bool:
    """Write ``batch`` only when the target holds no rows (stops at the first row found)."""
    if not target.isEmpty():
        return False
    batch.write.mode("overwrite").parquet(path)
    return True


# -- U3-U8, U10: selections -----------------------------------------------------
def unprocessed_raw_orders(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """Raw orders without a cleaned order (NOT IN over non-NULL ids == anti join)."""
    done = orders.where(F.col("raw_order_id").isNotNull()).select("raw_order_id")
    return raw.join(done, "raw_order_id", "left_anti").select(
        "raw_order_id", "customer_name_raw", "received_at", "source_channel")


def orders_needing_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """U4: clean / needs-review orders with a header count and no lines yet."""
    todo = orders.where(F.col("cleaning_status").isin("clean", "needs_review") & F.col("total_items").isNotNull())
    return todo.join(items.select("order_id"), "order_id", "left_anti").select(
        "order_id", "cleaning_status", "order_status", "total_items")


def deliverable_orders(orders: DataFrame, customers: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Shipped-status orders with a requested date and no delivery, with customer name and region."""
    todo = orders.where(F.col("order_status").isin("fulfilled", "partial", "shorted")
                        & F.col("requested_delivery_date").isNotNull())
    return (todo.join(customers.select("customer_id", "customer_name", "region"), "customer_id")
            .join(deliveries.select("order_id"), "order_id", "left_anti")
            .select("order_id", "order_status", "requested_delivery_date", "customer_name", "region"))


def active_drivers(workers: DataFrame) -> DataFrame:
    """Workers who can deliver."""
    return workers.where(F.col("is_active") & F.col("worker_role").isin("driver", "multi_role")).select(
        "worker_id", "worker_name", "worker_role")


def ids_by_name(rows: DataFrame, name: str, key: str) -> DataFrame:
    """(_name, key, _candidates): one id per name, the smallest; NULL names resolve nothing."""
    return rows.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("_name")).agg(
        F.min(key).alias(key), F.count_distinct(key).alias("_candidates"))


def resolve_customers(raw: DataFrame, customers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """U7 + U10: exact-name lookup among active customers; returns (resolved, rejected).

    A name shared by several active customers resolves to the smallest id (one raw order stays one
    order); ``ambiguous_names`` lists such names. Resolved rows carry customer_id and order_date =
    date of the received timestamp. Rejected rows are kept as an output instead of silently disappearing.
    Raw orders without a name never enter the join (they would share one hash partition).
    """
    names = ids_by_name(customers.where("is_active"), "customer_name", "customer_id")
    cols = ["raw_order_id", "customer_name_raw", "received_at", "source_channel", derive_order_date("received_at").alias("order_date")]
    rows = raw.select(*cols)
    j = rows.where(F.col("customer_name_raw").isNotNull()).join(names, F.col("customer_name_raw") == F.col("_name"), "left")
    resolved = j.where(F.col("customer_id").isNotNull()).select(
        "raw_order_id", "customer_name_raw", "customer_id", "received_at", "source_channel", "order_date")
    rejected = j.where(F.col("customer_id").isNull()).select(*rows.columns).unionByName(rows.where(F.col("customer_name_raw").isNull()))
    return resolved, rejected


def ambiguous_names(rows: DataFrame, name: str, key: str) -> DataFrame:
    """Names that more than one id carries, with the id they resolve to and how many share them."""
    return ids_by_name(rows, name, key).where("_candidates > 1").select(
        F.col("_name").alias(name), key, F.col("_candidates").alias("candidates"))


def derive_order_date(received_at: str | Column) -> Column:
    """Order date = calendar date of the received timestamp."""
    c = F.col(received_at) if isinstance(received_at, str) else received_at
    return F.to_date(c)


def resolve_suppliers(catalog: DataFrame, suppliers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """U8: catalog rows (…, supplier_name) -> supplier_id (the smallest of a shared name); unknown names go to the warning output."""
    names = ids_by_name(suppliers, "supplier_name", "supplier_id").drop("_candidates")
    j = catalog.join(names, F.col("supplier_name") == F.col("_name"), "left").drop("_name")
    return j.where(F.col("supplier_id").isNotNull()), j.where(F.col("supplier_id").isNull()).drop("supplier_id")


# -- A14 / A15: small reports -----------------------------------------------------
def status_breakdown(df: DataFrame, column: str) -> DataFrame:
    """Value-frequency breakdown (normalised value -> rows)."""
    return df.groupBy(norm(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def driver_assignment_counts(deliveries: DataFrame, workers: DataFrame) -> DataFrame:
    """Deliveries assigned per driver name (counted per id first, so one row per driver meets the workers)."""
    per_driver = deliveries.where(F.col("driver_worker_id").isNotNull()).groupBy("driver_worker_id").agg(F.count(F.lit(1)).alias("n"))
    w = workers.select(F.col("worker_id").alias("driver_worker_id"), "worker_name")
    return per_driver.join(w, "driver_worker_id").groupBy("worker_name").agg(F.sum("n").alias("deliveries"))
