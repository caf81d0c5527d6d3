"""Golden and broken star schemas over the public tables; no random numbers, no clock."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keymend.functions.keys import natural_key
from keymend.operators.corrupt import break_scd1, break_scd2, cohorts, key_changes
from keymend.operators.keymap import build_keymap, snapshot
from keymend.plans.specs import AlignFactSpec, DimSpec
from keymend.sources.tables import table

CUSTOMER = DimSpec("customer_key", ("customer_id",))
CUSTOMER2 = DimSpec("surrogate_key", ("customer_id",), 2, "eff_start", "eff_end")
PART = DimSpec("part_key", ("part_code", "source_system"))
SUPPLIER = DimSpec("supplier_key", ("supplier_code",))
ORDER_ALIGN = AlignFactSpec("b_order_fact", "customer_key", "event_date", "legacy_order_fact", "customer_key", ("order_id",), ("order_id",), ("customer_id",))
CUTOFF = datetime.datetime(2001, 6, 30)
ACTIVITY_CUTOFF = datetime.datetime(1998, 6, 30)
ACTIVITY_ALIGN = AlignFactSpec("named_activity", "surrogate_key", "event_date", "legacy_activity", "surrogate_key", ("activity_id",), ("activity_id",))
# The hub's lookup dimensions and their members.
HUB_REFS = {"account": 120, "subscriber": 80, "account_type": 12, "market": 20, "autopay": 8, "billing_product": 40, "payment_method": 15}


def once(build):
    """A table of a Star that is built once: those that number rows write an intermediate table."""
    def get(self):
        if build.__name__ not in self.built:
            self.built[build.__name__] = build(self)
        return self.built[build.__name__]
    return get


class Star:
    """The fixtures of one directory, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.built: dict[str, DataFrame] = {}

    def t(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def g_customer(self) -> DataFrame:
        return self.t("customer").select((F.col("c_custkey") + 1).alias("customer_key"), F.col("c_name").alias("customer_id"), F.col("c_mktsegment").alias("segment"))

    @once
    def b_customer(self) -> DataFrame:
        c = self.t("customer")
        unknown = self.spark.createDataFrame([(-1, "UNKNOWN", "N/A")], "customer_key long, customer_id string, segment string")
        kept = c.filter("c_custkey % 50 <> 0").select(F.lit(0).cast("long").alias("customer_key"), "c_name", F.col("c_mktsegment").alias("segment"))
        kept = break_scd1(kept, "customer_key", ["c_name"])
        kept = kept.select("customer_key", F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("customer_id"), "segment")
        new = c.filter("c_custkey < 15").select((F.col("c_custkey") + 1000000).alias("customer_key"), F.concat(F.lit("NEW#"), F.col("c_custkey").cast("string")).alias("customer_id"), F.lit("Gold").alias("segment"))
        return unknown.unionByName(kept).unionByName(new)

    def old1(self) -> DataFrame:
        return snapshot(self.g_customer(), CUSTOMER)

    def new1(self) -> DataFrame:
        return snapshot(self.b_customer(), CUSTOMER, "new_sk")

    def km1(self) -> DataFrame:
        return build_keymap(self.old1(), self.new1())

    def g_orders(self) -> DataFrame:
        return self.t("orders").select(F.col("o_orderkey").alias("order_id"), (F.col("o_custkey") + 1).alias("customer_key"), F.col("o_orderdate").alias("event_date"), F.col("o_totalprice").alias("amount"))

    def b_orders_ss(self) -> DataFrame:
        lost = F.col("order_id") % 97 == 0
        return self.g_orders().withColumn("customer_key", F.when(lost, 5000000 + F.col("order_id") % 20).otherwise(F.col("customer_key"))).withColumn("load_batch", F.when(lost, "INITIAL_SS_ORPHAN").otherwise("INITIAL_SS"))

    def b_orders(self) -> DataFrame:
        """Mixed cohorts with the true natural key attached."""
        g = self.g_customer()
        named = self.g_orders().join(g.select("customer_key", "customer_id"), "customer_key", "left")
        change = key_changes(g, self.b_customer(), "customer_key", natural_key(["customer_id"]))
        return cohorts(named, "customer_key", "order_id", change)

    def g_customer2(self) -> DataFrame:
        c = self.t("customer")
        day = lambda x: F.lit(datetime.date.fromisoformat(x))
        old = c.select((2 * F.col("c_custkey") + 1).alias("surrogate_key"), F.col("c_name").alias("customer_id"), day("1995-01-01").alias("eff_start"), day("1997-12-31").alias("eff_end"), F.lit("H").alias("record_status"))
        now = c.select((2 * F.col("c_custkey") + 2).alias("surrogate_key"), F.col("c_name").alias("customer_id"), day("1998-01-01").alias("eff_start"), day("2999-12-31").alias("eff_end"), F.lit("C").alias("record_status"))
        return old.unionByName(now)

    @once
    def b_customer2(self) -> DataFrame:
        return break_scd2(self.g_customer2(), "surrogate_key", [F.col("customer_id").desc(), F.col("eff_start")], "eff_start", "eff_end")

    def old2(self) -> DataFrame:
        return snapshot(self.g_customer2(), CUSTOMER2)

    def new2(self) -> DataFrame:
        return snapshot(self.b_customer2(), CUSTOMER2, "new_sk")

    def km2(self) -> DataFrame:
        return build_keymap(self.old2(), self.new2(), 2)

    def b_activity(self) -> DataFrame:
        early = F.col("o_orderdate") < F.lit(datetime.datetime(1998, 1, 1)).cast("timestamp_ntz")
        return self.t("orders").select(F.col("o_orderkey").alias("activity_id"), (2 * F.col("o_custkey") + F.when(early, 1).otherwise(2)).alias("surrogate_key"), F.col("o_orderdate").alias("event_date"), F.col("o_totalprice").alias("amount"))

    def b_activity_roles(self) -> DataFrame:
        """Activities with a second reference, to the first version of some customer: it fits only early events."""
        n = self.t("customer").agg(F.count(F.lit(1)).alias("n"))
        return self.b_activity().join(F.broadcast(n)).withColumn(  # one row
            "first_key", 2 * (F.col("activity_id") % F.col("n")) + 1).drop("n")

    def named_activity(self) -> DataFrame:
        """Activities on the current versions' keys, with the customer's natural key."""
        who = self.g_customer2().select(F.col("surrogate_key").alias("__sk"), "customer_id")
        named = self.b_activity().join(who, F.col("surrogate_key") == F.col("__sk")).drop("__sk", "surrogate_key")
        now = self.b_customer2().select("surrogate_key", F.col("customer_id").alias("__id"), "record_status")
        late = F.col("event_date") >= F.lit(datetime.datetime(1998, 1, 1)).cast("timestamp_ntz")
        return named.join(now, (F.col("customer_id") == F.col("__id")) & (F.col("record_status") == F.when(late, "C").otherwise("H"))).drop("__id", "record_status")

    def legacy_activity(self) -> DataFrame:
        """The legacy twin: through the cutoff, with gaps."""
        return self.b_activity().filter((F.col("event_date") <= F.lit(ACTIVITY_CUTOFF).cast("timestamp_ntz")) & (F.col("activity_id") % 5 != 0))

    def hub_scd2(self) -> DataFrame:
        """A type-2 hub: two versions of each supplier's account, each with seven references."""
        s = self.t("supplier")
        k, day = F.col("s_suppkey"), lambda x: F.lit(datetime.date.fromisoformat(x))
        version = s.withColumn("v", F.explode(F.array(F.lit(0), F.lit(1))))
        now = F.col("v") == 1
        refs = {f"{name}_key": ((k * (i + 3) + F.col("v") * 7) % size + 1).cast("long") for i, (name, size) in enumerate(HUB_REFS.items())}
        start = F.date_add(day("2023-01-01"), (180 * F.col("v") + (2 * k + F.col("v") + 1) % 30).cast("int"))
        return version.select(
            (2 * k + F.col("v") + 1).alias("detail_sk"), F.col("s_name").alias("account_number"), *(c.alias(n) for n, c in refs.items()),
            start.alias("effectiveStartDate"), F.when(now, day("2999-12-31")).otherwise(F.date_add(start, 179)).alias("effectiveEndDate"),
            F.when(now, "C").otherwise("H").alias("recordStatus"))

    def lookup(self, name: str) -> DataFrame:
        """A lookup dimension of the hub: members 1 to its size, and the unknown one."""
        member = self.spark.range(1, HUB_REFS[name] + 1).select(
            F.col("id").alias(f"{name}_key"), F.concat(F.lit(name.upper() + "-"), F.col("id").cast("string")).alias("code"))
        return member.unionByName(self.spark.createDataFrame([(-1, "UNKNOWN")], f"{name}_key long, code string"))

    def cutoff(self):
        return F.lit(CUTOFF).cast("timestamp_ntz")

    def legacy_orders(self) -> DataFrame:
        return self.g_orders().filter((F.col("event_date") <= self.cutoff()) & (F.col("order_id") % 500 != 0))

    def g_part(self) -> DataFrame:
        rows = self.t("part").select((F.col("p_partkey") + 1).alias("part_key"), F.concat(F.lit("PRD-"), F.col("p_partkey").cast("string")).alias("part_code"), F.lit("ERP").alias("source_system"), F.col("p_brand").alias("brand"))
        return rows.unionByName(self.spark.createDataFrame([(-1, "UNKNOWN", "N/A", "N/A")], "part_key long, part_code string, source_system string, brand string"))

    @once
    def b_part(self) -> DataFrame:
        return break_scd1(self.g_part(), "part_key", ["part_code", "source_system"])

    def km_part(self) -> DataFrame:
        return build_keymap(snapshot(self.g_part(), PART), snapshot(self.b_part(), PART, "new_sk"))

    def g_supplier(self) -> DataFrame:
        rows = self.t("supplier").select((F.col("s_suppkey") + 1).alias("supplier_key"), F.col("s_name").alias("supplier_code"))
        return rows.unionByName(self.spark.createDataFrame([(-1, "UNKNOWN")], "supplier_key long, supplier_code string"))

    @once
    def b_supplier(self) -> DataFrame:
        return break_scd1(self.g_supplier(), "supplier_key", ["supplier_code"])

    def km_supplier(self) -> DataFrame:
        return build_keymap(snapshot(self.g_supplier(), SUPPLIER), snapshot(self.b_supplier(), SUPPLIER, "new_sk"))

    def g_hub(self) -> DataFrame:
        parts = self.t("part").agg(F.count(F.lit(1)).alias("n"))
        return self.t("lineitem").join(F.broadcast(parts)).select(  # one row
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_id"), F.col("l_shipdate").alias("event_date"),
            (F.col("l_partkey") + 1).alias("part_key"), (F.col("l_suppkey") + 1).alias("supplier_key"),
            ((F.col("l_partkey") + 7) % F.col("n") + 1).alias("alt_part_key"), F.col("l_extendedprice").alias("amount"))

    def b_hub(self) -> DataFrame:
        bad = lambda c, k: F.when(F.col("order_id") % k == 0, 9000000 + F.col("line_id")).otherwise(F.col(c)).cast("long")
        return self.g_hub().withColumns({"part_key": bad("part_key", 89), "supplier_key": bad("supplier_key", 83), "load_batch": F.lit("INITIAL_SS")})
