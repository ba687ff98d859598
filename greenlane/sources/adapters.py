"""Derive the eleven operational tables from the TPC-H-like test tables.

The test harness only provides ``region nation customer supplier part orders
lineitem events``; these adapters map them onto the order-to-delivery model with
plain column expressions (integer arithmetic, CASE, casts), chosen so that the
same definitions give identical values in any SQL engine. Raw enum values are
deliberately mixed-case / padded so that the staging normalisation matters.

Everything is lazy: an adapter is a DataFrame plan, and Catalyst prunes the
columns and pushes the filters of whatever query consumes it into the Parquet scan.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import lookup_join
from .io import Tables

TPCH_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Column names and types of the test tables (the files' own Parquet types).
# Declaring them skips schema inference (a footer read on the driver per scan) and fails
# fast if a file's layout ever changes.
TPCH_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def source_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TPCH_SCHEMAS[name])


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(source_schema(name)).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"), F.lit(0), F.lit(0), F.lit(0))


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"), F.lit(0), F.lit(0))


def _cents_to_decimal(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(10,2)")


def deliveries_from_orders(o: DataFrame, n_suppliers: Column | None) -> DataFrame:
    """Deliveries derived from orders (also used on a stream of orders; without a supplier count the driver is NULL)."""
    k = F.col("o_orderkey")
    scheduled = F.col("o_orderdate") + _days(k % 3 + 1) + _hours(k % 10 + 8)
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("Delivered"))
        .when(F.col("o_orderstatus") == "P", _case(k % 4, {0: "failed", 1: "Cancelled", 2: "in_transit"}, "delivered"))
        .otherwise(F.lit("scheduled"))
    )
    delivered = (F.col("o_orderstatus") == "F") | ((F.col("o_orderstatus") == "P") & (k % 4 == 3))
    actual = (
        F.when(~delivered | (k % 97 == 0), F.lit(None).cast("timestamp_ntz"))
        .when(k % 5 == 0, scheduled + _days(F.lit(1)))
        .when(k % 5 == 1, scheduled - _hours(F.lit(20)))
        .otherwise(scheduled + _hours(k % 3))
    )
    if n_suppliers is None:
        driver = F.lit(None).cast("bigint")
    else:
        driver = F.when(F.col("o_custkey") % 11 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey") % n_suppliers)
    return o.where(((F.col("o_orderstatus") != "O") | (k % 3 == 0)) & (k % 13 != 0)).select(
        k.alias("delivery_id"),
        k.alias("order_id"),
        scheduled.alias("scheduled_delivery_time"),
        actual.alias("actual_delivery_time"),
        status.alias("delivery_status"),
        driver.alias("driver_worker_id"),
        F.concat(F.lit("Address "), F.col("o_custkey").cast("string")).alias("delivery_address"),
        F.col("o_orderdate").alias("created_at"),
        scheduled.alias("updated_at"),
    )


_MAX_NATIONS = 1000
_REGION_PAIRS: dict[tuple, list[tuple[int, str]] | None] = {}


class TpchAdapters:
    """Lazily built raw tables over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._scans: dict[str, DataFrame] = {}

    def t(self, name: str) -> DataFrame:
        """One scan object per table: the raw tables that share a source reuse its relation."""
        if name not in self._scans:
            self._scans[name] = _read(self.spark, self.sf_dir, name)
        return self._scans[name]

    # -- helpers -----------------------------------------------------------
    def _n_suppliers(self) -> Column:
        # Scalar subquery: evaluated once per query, no join.
        return self.t("supplier").agg(F.count(F.lit(1))).scalar()

    def _region_pairs(self) -> list[tuple[int, str]] | None:
        """(nation key, region name) while nations stay few (TPC-H fixes 25), else None.

        Read once per session, directory and state of the files (their modification times).
        """
        stamps = []
        for name in ("nation", "region"):
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir.rstrip('/')}/{name}.parquet")
            stamps.append(path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path).getModificationTime())
        key = (self.spark.sparkContext.applicationId, self.sf_dir, *stamps)
        if key not in _REGION_PAIRS:
            n, r = self.t("nation"), self.t("region")
            pairs = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name").take(_MAX_NATIONS + 1)
            _REGION_PAIRS[key] = [(p.n_nationkey, p.r_name) for p in pairs] if len(pairs) <= _MAX_NATIONS else None
        return _REGION_PAIRS[key]

    def _with_region(self, df: DataFrame, nation_key: str) -> DataFrame:
        """``df`` with ``_region``, the region name of a nation key: a literal map while nations are few, else a join.

        A join would make Spark's size estimate of the customer/supplier frames the *product* of
        both sides and block their broadcast.
        """
        pairs = self._region_pairs()
        if pairs is None:
            n, r = self.t("nation"), self.t("region")
            regions = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("n_nationkey").alias(nation_key), F.col("r_name").alias("_region"))
            return lookup_join(df, regions, nation_key, "left")
        names = F.create_map(*[F.lit(x) for p in pairs for x in p]) if pairs else F.create_map().cast("map<int,string>")
        return df.withColumn("_region", names[F.col(nation_key)])

    # -- dimensions --------------------------------------------------------
    def customers(self) -> DataFrame:
        c = self._with_region(self.t("customer"), "c_nationkey")
        signup = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 1461).cast("int"))
        market = _case(F.col("c_mktsegment"), {
            "AUTOMOBILE": "Restaurant", "BUILDING": " grocery", "FURNITURE": "WHOLESALE",
            "HOUSEHOLD": "Individual ", "MACHINERY": "distributor"}, "other")
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            market.alias("market_type"),
            F.when(F.col("c_custkey") % 23 == 0, F.lit(None).cast("string")).otherwise(F.col("_region")).alias("region"),
            signup.alias("signup_date"),
            (F.col("c_custkey") % 13 != 0).alias("is_active"),
            signup.cast("timestamp_ntz").alias("created_at"),
            signup.cast("timestamp_ntz").alias("updated_at"),
        )

    def suppliers(self) -> DataFrame:
        s = self._with_region(self.t("supplier"), "s_nationkey")
        stype = _case(F.col("s_nationkey") % 4, {0: "Own_Farm", 1: "external_farm", 2: "Distributor"}, "wholesale_market")
        return s.select(
            F.col("s_suppkey").alias("supplier_id"),
            F.col("s_name").alias("supplier_name"),
            F.col("_region").alias("supplier_region"),
            stype.alias("supplier_type"),
            (F.col("s_nationkey") % 2 == 0).alias("is_local"),
            (F.col("s_suppkey") % 17 != 0).alias("is_active"),
            F.lit(None).cast("timestamp_ntz").alias("created_at"),
            F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        )

    def workers(self) -> DataFrame:
        s = self.t("supplier")
        role = _case(F.col("s_suppkey") % 4, {0: "Driver", 1: "prep", 2: "multi_role"}, "Supervisor")
        return s.select(
            F.col("s_suppkey").alias("worker_id"),
            F.concat(F.lit("Worker#"), F.substring("s_name", 10, 64)).alias("worker_name"),
            role.alias("role"),
            F.date_add(F.lit("2015-01-01").cast("date"), (F.col("s_suppkey") % 2000).cast("int")).alias("hire_date"),
            (F.col("s_suppkey") % 19 != 0).alias("is_active"),
            F.lit(None).cast("timestamp_ntz").alias("created_at"),
            F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        )

    def products(self) -> DataFrame:
        p = self.t("part")
        kind = F.col("p_size") % 3
        # supplier ids run 0..n-1; the modulus n+1 leaves a few orphans for the FK check.
        supplier = F.when(kind == 2, F.lit(None).cast("bigint")).otherwise(F.col("p_partkey") % (self._n_suppliers() + 1))
        return p.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.lower("p_type").alias("category"),
            _case(kind, {0: "lb", 1: "case"}, "bunch").alias("unit"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("standard_price"),
            _case(kind, {0: "Own_Farm", 1: "outsourced"}, " Mixed").alias("source_type"),
            supplier.alias("supplier_id"),
            (F.col("p_partkey") % 11 != 0).alias("is_active"),
            F.lit(None).cast("timestamp_ntz").alias("created_at"),
            F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        )

    def inventory(self) -> DataFrame:
        e = self.t("events")
        return e.select(
            F.col("event_id").alias("inventory_id"),
            F.col("user_id").alias("product_id"),
            F.col("ts").cast("date").alias("inventory_date"),
            F.col("value").cast("decimal(10,2)").alias("available_quantity"),
            F.col("event_type").alias("warehouse_location"),
            F.col("ts").alias("created_at"),
            F.col("ts").alias("updated_at"),
        )

    # -- orders ------------------------------------------------------------
    def orders_cleaned(self) -> DataFrame:
        o = self.t("orders")
        k = F.col("o_orderkey")
        order_date = F.col("o_orderdate").cast("date")
        status = (
            F.when(k % 50 == 7, F.lit("Cancelled"))
            .when(F.col("o_orderstatus") == "F", F.lit("Fulfilled"))
            .when(F.col("o_orderstatus") == "P", F.when(k % 2 == 0, F.lit("partial")).otherwise(F.lit("SHORTED")))
            .otherwise(F.when(k % 2 == 0, F.lit("pending")).otherwise(F.lit("Confirmed ")))
        )
        cleaning = _case(k % 10, {0: "needs_review", 1: "Incomplete", 2: "rejected"}, "clean")
        return o.select(
            k.alias("order_id"),
            F.when(k % 41 == 0, F.lit(None).cast("bigint")).otherwise(k).alias("raw_order_id"),
            F.col("o_custkey").alias("customer_id"),
            order_date.alias("order_date"),
            F.when(k % 31 == 0, F.lit(None).cast("date"))
            .otherwise(F.date_add(order_date, (k % 3 + 1).cast("int"))).alias("requested_delivery_date"),
            status.alias("order_status"),
            cleaning.alias("cleaning_status"),
            F.when(k % 20 == 0, F.lit(None).cast("int")).otherwise((k % 7 + 1).cast("int")).alias("total_items"),
            F.col("o_totalprice").cast("decimal(10,2)").alias("total_value"),
            F.lit(None).cast("string").alias("notes"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )

    def _line_quantities(self) -> list[Column]:
        """(qty int, requested decimal, confirmed decimal|NULL, unit price decimal) of a lineitem row."""
        qty = F.col("l_quantity").cast("int")
        disc = F.round(F.col("l_discount") * 100).cast("int")
        requested = F.col("l_quantity").cast("decimal(10,2)")
        confirmed = (
            F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit(None).cast("decimal(10,2)"))
            .when(F.col("l_returnflag") == "R", (qty - F.call_function("div", qty * disc, F.lit(10))).cast("decimal(10,2)"))
            .otherwise(requested)
        )
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        unit_price = _cents_to_decimal(F.call_function("div", cents, qty))
        return [qty, requested, confirmed, unit_price]

    def order_items(self) -> DataFrame:
        li = self.t("lineitem")
        _, requested, confirmed, unit_price = self._line_quantities()
        status = (
            F.when(confirmed.isNull(), F.lit("Pending"))
            .when(confirmed == 0, F.lit("shorted"))
            .when(confirmed < requested, F.lit("Partial"))
            .otherwise(F.lit("fulfilled "))
        )
        return li.select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            requested.alias("requested_quantity"),
            confirmed.alias("confirmed_quantity"),
            unit_price.alias("unit_price"),
            status.alias("item_status"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
        )

    def prep_lists(self) -> DataFrame:
        li = self.t("lineitem")
        _, _, confirmed, _ = self._line_quantities()
        status = _case(F.col("l_linenumber") % 5, {0: "Pending", 1: "assigned", 2: "In_Progress", 3: "completed"}, "cancelled")
        return li.where(confirmed > 0).select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("prep_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            confirmed.alias("quantity_to_prepare"),
            status.alias("prep_status"),
            F.when(F.col("l_linenumber") % 5 == 0, F.lit(None).cast("bigint")).otherwise(F.col("l_suppkey")).alias("assigned_worker_id"),
            F.date_sub(F.col("l_shipdate").cast("date"), 1).alias("prep_date"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
        )

    def deliveries(self) -> DataFrame:
        return deliveries_from_orders(self.t("orders"), self._n_suppliers())

    def worker_shifts(self) -> DataFrame:
        li = self.t("lineitem")
        task = _case(F.col("l_linenumber") % 6, {0: "Prep", 1: "delivery", 2: "Cleaning ", 3: "inventory", 4: "ADMIN"}, "other")
        return li.select(
            (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("shift_id"),
            F.col("l_suppkey").alias("worker_id"),
            F.col("l_shipdate").cast("date").alias("shift_date"),
            task.alias("task_type"),
            (F.col("l_quantity") / 2).cast("decimal(5,2)").alias("hours_worked"),
            (F.col("l_linenumber") + 15).cast("decimal(10,2)").alias("hourly_rate"),
            F.col("l_orderkey").alias("related_order_id"),
            F.lit(None).cast("string").alias("notes"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_shipdate").alias("updated_at"),
        )

    def incoming_orders_raw(self) -> DataFrame:
        """One raw order per order. The test tables carry no messages: the text is the order's priority, as it stands."""
        o, c = self.t("orders"), self.t("customer")
        k = F.col("o_orderkey")
        channel = _case(k % 5, {0: "text", 1: "Email", 2: "spreadsheet", 3: "phone"}, "in_person")
        channel = F.when(k % 37 == 0, F.lit("SMS")).otherwise(channel)
        name = (
            F.when(k % 29 == 0, F.lit(None).cast("string"))
            .when(k % 17 == 0, F.concat(F.col("c_name"), F.lit(" ")))
            .otherwise(F.col("c_name"))
        )
        received = F.col("o_orderdate") + _hours(k % 12 + 6)
        return o.join(c, o.o_custkey == c.c_custkey, "left").select(
            k.alias("raw_order_id"),
            name.alias("customer_name_raw"),
            F.col("o_orderpriority").alias("order_text"),
            received.alias("received_timestamp"),
            channel.alias("source_channel"),
            F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("intake desk")).alias("entered_by"),
            received.alias("created_at"),
            received.alias("updated_at"),
        )

    def tables(self) -> Tables:
        t = Tables({name: getattr(self, name) for name in (
            "customers", "suppliers", "workers", "products", "inventory", "incoming_orders_raw",
            "orders_cleaned", "order_items", "prep_lists", "deliveries", "worker_shifts")})
        t.sf_dir = self.sf_dir
        return t


def tpch_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return TpchAdapters(spark, sf_dir).tables()
