"""One query per operator over the fixtures, and the same in DuckDB SQL."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keymend.functions.keys import business_key_equal, deterministic_key, natural_key, normalized
from keymend.operators import align, corrupt, keymap, repair, report, validate
from keymend.plans.specs import DimSpec
from keymend.sources import fixtures as fx
from keymend.sources.fixtures import Star

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: The fixtures in DuckDB SQL.
_NK = "coalesce(upper(trim(cast({0} as varchar))),'~NULL~')"
PRELUDE = f"""
with g_customer_dim as (select c_custkey+1 as customer_key, c_name as customer_id, c_mktsegment as segment from customer),
b_customer_dim as (
  select cast(-1 as bigint) as customer_key, 'UNKNOWN' as customer_id, 'N/A' as segment
  union all select cast(row_number() over (order by c_name desc) as bigint), '  ' || lower(c_name) || ' ', c_mktsegment from customer where c_custkey % 50 <> 0
  union all select 1000000+c_custkey, 'NEW#' || cast(c_custkey as varchar), 'Gold' from customer where c_custkey < 15),
old1 as (select customer_key as old_sk, {_NK.format('customer_id')} as natural_key from g_customer_dim),
new1 as (select customer_key as new_sk, {_NK.format('customer_id')} as natural_key from b_customer_dim),
km1 as (
  select coalesce(o.natural_key, n.natural_key) as natural_key, o.old_sk, n.new_sk, cast(null as timestamp) as valid_from, cast(null as timestamp) as valid_to,
    case when o.natural_key is null then 'ORPHAN_NEW' when n.natural_key is null then 'ORPHAN_OLD' else 'MATCHED' end as map_status
  from old1 o full outer join new1 n on o.natural_key = n.natural_key),
g_order_fact as (select o_orderkey as order_id, o_custkey+1 as customer_key, o_orderdate as event_date, o_totalprice as amount from orders),
b_order_fact_ss as (
  select order_id, case when order_id % 97 = 0 then 5000000 + order_id % 20 else customer_key end as customer_key, event_date, amount,
    case when order_id % 97 = 0 then 'INITIAL_SS_ORPHAN' else 'INITIAL_SS' end as load_batch from g_order_fact),
b_order_fact as (
  select f.order_id, case when f.order_id % 97 = 0 then 5000000 + f.order_id % 20 when f.order_id % 20 < 7 then coalesce(b.customer_key,-1) else f.customer_key end as customer_key,
    f.event_date, f.amount, g.customer_id, case when f.order_id % 97 = 0 then 'INITIAL_SS_ORPHAN' when f.order_id % 20 < 7 then 'DB_INCREMENTAL' else 'INITIAL_SS' end as load_batch
  from g_order_fact f left join g_customer_dim g on f.customer_key = g.customer_key left join b_customer_dim b on upper(trim(g.customer_id)) = upper(trim(b.customer_id))),
g_customer_scd2 as (
  select 2*c_custkey+1 as surrogate_key, c_name as customer_id, date '1995-01-01' as eff_start, date '1997-12-31' as eff_end, 'H' as record_status from customer
  union all select 2*c_custkey+2, c_name, date '1998-01-01', date '2999-12-31', 'C' from customer),
b_customer_scd2 as (
  select cast(row_number() over (order by customer_id desc, eff_start) as bigint) as surrogate_key, customer_id,
    case when record_status='H' then date '1995-01-16' else date '1998-01-16' end as eff_start, case when record_status='H' then date '1998-01-15' else eff_end end as eff_end, record_status
  from g_customer_scd2),
old2 as (select surrogate_key as old_sk, {_NK.format('customer_id')} as natural_key, eff_start as valid_from, eff_end as valid_to from g_customer_scd2),
new2 as (select surrogate_key as new_sk, {_NK.format('customer_id')} as natural_key, eff_start as valid_from, eff_end as valid_to from b_customer_scd2),
j2 as (
  select o.natural_key, o.old_sk, n.new_sk, n.valid_from, n.valid_to, count(n.new_sk) over (partition by o.old_sk) as c
  from old2 o left join new2 n on o.natural_key = n.natural_key and o.valid_from < coalesce(n.valid_to, date '9999-12-31') and n.valid_from < coalesce(o.valid_to, date '9999-12-31')),
km2 as (select natural_key, old_sk, new_sk, valid_from, valid_to, case when new_sk is null then 'ORPHAN_OLD' when c > 1 then 'AMBIGUOUS' else 'MATCHED' end as map_status from j2),
b_activity_fact as (
  select o_orderkey as activity_id, 2*o_custkey + case when o_orderdate < timestamp '1998-01-01 00:00:00' then 1 else 2 end as surrogate_key, o_orderdate as event_date, o_totalprice as amount from orders),
legacy_order_fact as (select * from g_order_fact where event_date <= timestamp '2001-06-30 00:00:00' and order_id % 500 <> 0),
dim_fixed_keep as (
  select coalesce(km.old_sk, d.customer_key) as customer_key, d.customer_id, d.segment
  from b_customer_dim d left join km1 km on {_NK.format('d.customer_id')} = km.natural_key and km.map_status = 'MATCHED'),
g_part_dim as (
  select p_partkey+1 as part_key, 'PRD-' || cast(p_partkey as varchar) as part_code, 'ERP' as source_system, p_brand as brand from part
  union all select cast(-1 as bigint), 'UNKNOWN', 'N/A', 'N/A'),
b_part_dim as (
  select cast(row_number() over (order by part_code desc, source_system desc) as bigint) as part_key, part_code, source_system, brand from g_part_dim where part_key > 0
  union all select cast(-1 as bigint), 'UNKNOWN', 'N/A', 'N/A'),
km_part as (
  select coalesce(o.nk, n.nk) as natural_key, o.old_sk, n.new_sk, case when o.nk is null then 'ORPHAN_NEW' when n.nk is null then 'ORPHAN_OLD' else 'MATCHED' end as map_status
  from (select part_key as old_sk, {_NK.format('part_code')} || '||' || {_NK.format('source_system')} as nk from g_part_dim) o
  full outer join (select part_key as new_sk, {_NK.format('part_code')} || '||' || {_NK.format('source_system')} as nk from b_part_dim) n on o.nk = n.nk),
g_supplier_dim as (select s_suppkey+1 as supplier_key, s_name as supplier_code from supplier union all select cast(-1 as bigint), 'UNKNOWN'),
b_supplier_dim as (
  select cast(row_number() over (order by supplier_code desc) as bigint) as supplier_key, supplier_code from g_supplier_dim where supplier_key > 0
  union all select cast(-1 as bigint), 'UNKNOWN'),
km_supplier as (
  select o.supplier_key as old_sk, n.supplier_key as new_sk from g_supplier_dim o join b_supplier_dim n on o.supplier_code = n.supplier_code),
g_hub as (
  select l_orderkey as order_id, l_linenumber as line_id, l_shipdate as event_date, l_partkey+1 as part_key, l_suppkey+1 as supplier_key,
    (l_partkey+7) % (select count(*) from part) + 1 as alt_part_key, l_extendedprice as amount from lineitem),
b_hub as (
  select order_id, line_id, event_date, cast(case when order_id % 89 = 0 then 9000000 + line_id else part_key end as bigint) as part_key,
    cast(case when order_id % 83 = 0 then 9000000 + line_id else supplier_key end as bigint) as supplier_key, alt_part_key, amount, 'INITIAL_SS' as load_batch from g_hub),
rekeyed as (
  select f.order_id, f.event_date, f.amount, f.load_batch, coalesce(km.new_sk, -1) as customer_key
  from b_order_fact_ss f left join km1 km on f.customer_key = km.old_sk and km.map_status = 'MATCHED'),
rekeyed2 as (
  select f.activity_id, f.event_date, f.amount, coalesce(km.new_sk, -1) as surrogate_key
  from b_activity_fact f left join km2 km on f.surrogate_key = km.old_sk and km.map_status in ('MATCHED', 'AMBIGUOUS')
    and f.event_date >= km.valid_from and f.event_date < coalesce(km.valid_to, date '9999-12-31')),
aligned_nk as (
  select f.order_id, f.event_date, f.amount, f.customer_id, f.load_batch,
    case when f.event_date <= timestamp '2001-06-30 00:00:00' then coalesce(s.customer_key, d.customer_key, km.old_sk, -1) else coalesce(d.customer_key, km.old_sk, -1) end as customer_key
  from b_order_fact f left join legacy_order_fact s on f.order_id = s.order_id
  left join dim_fixed_keep d on {_NK.format('f.customer_id')} = {_NK.format('d.customer_id')}
  left join km1 km on f.customer_key = km.new_sk and km.map_status = 'MATCHED'),
used_orders as (
  select customer_key as sk, count(*) as row_count, array_to_string(list_sort(list(distinct load_batch)), ',') as load_batches from b_order_fact_ss where customer_key <> -1 group by 1),
used_fixed as (
  select customer_key as sk, count(*) as row_count, array_to_string(list_sort(list(distinct load_batch)), ',') as load_batches from rekeyed where customer_key <> -1 group by 1),
issues_pre as (
  select u.*, g.customer_id as golden_nk, b.customer_id as broken_nk,
    case when b.customer_key is null then 'FK_ORPHAN' when g.customer_id is null and b.customer_id is null then 'FK_PRESENT' when g.customer_id is null then 'ORPHAN_NEW_DIM_ONLY'
      when b.customer_id is null then 'ORPHAN_OLD_DIM_MISSING' when g.customer_id = b.customer_id then 'NK_MATCH' else 'SILENT_CORRUPTION' end as issue_type
  from used_orders u left join b_customer_dim b on u.sk = b.customer_key left join g_customer_dim g on u.sk = g.customer_key),
issues_post as (
  select u.*, g.customer_id as golden_nk, b.customer_id as broken_nk,
    case when b.customer_key is null then 'FK_ORPHAN' when g.customer_id is null and b.customer_id is null then 'FK_PRESENT' when g.customer_id is null then 'ORPHAN_NEW_DIM_ONLY'
      when b.customer_id is null then 'ORPHAN_OLD_DIM_MISSING' when g.customer_id = b.customer_id then 'NK_MATCH' else 'SILENT_CORRUPTION' end as issue_type
  from used_fixed u left join b_customer_dim b on u.sk = b.customer_key left join g_customer_dim g on u.sk = g.customer_key)
"""


def query(sql: str | None = None):
    """Register a function of a Star under its name, with its SQL after the fixtures."""
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Star(spark, sf_dir))
        if sql is not None:
            SQL[f.__name__] = PRELUDE + sql
        return f
    return add


def rows() -> Column:
    return F.count(F.lit(1))


# --- keys -----------------------------------------------------------------------------------

@query("select customer_id, upper(trim(customer_id)) as nk from b_customer_dim")
def nk_normalize(s: Star) -> DataFrame:
    return s.b_customer().select("customer_id", normalized("customer_id").alias("nk"))


@query(f"select part_key, {_NK.format('part_code')} || '||' || {_NK.format('source_system')} as nk from g_part_dim")
def nk_composite(s: Star) -> DataFrame:
    return s.g_part().select("part_key", natural_key(["part_code", "source_system"]).alias("nk"))


@query("select f.order_id, f.customer_key, l.customer_key as legacy_key from b_order_fact f join legacy_order_fact l on cast(f.order_id as varchar) = cast(l.order_id as varchar)")
def bk_join_inner(s: Star) -> DataFrame:
    f, l = s.b_orders().alias("f"), s.legacy_orders().alias("l")
    return f.join(l, business_key_equal([F.col("l.order_id")], [F.col("f.order_id")])).select("f.order_id", "f.customer_key", F.col("l.customer_key").alias("legacy_key"))


@query()
def deterministic_sk(s: Star) -> DataFrame:
    return s.g_customer().select("customer_id", deterministic_key(["customer_id"]).alias("sk"))


# --- snapshots and pre-checks -----------------------------------------------------------------

@query("select * from old1")
def snapshot_scd1(s: Star) -> DataFrame:
    return s.old1()


@query("select * from old2")
def snapshot_scd2(s: Star) -> DataFrame:
    return s.old2()


@query("select coalesce(max(old_sk), 0) as max_sk from old1")
def max_sk(s: Star) -> DataFrame:
    return keymap.max_sk(s.old1())


@query(f"""select {' || chr(124) || chr(124) || '.join(_NK.format(c) for c in ('p_name', 'p_brand', 'p_type', 'p_size'))} as natural_key,
  count(*) as versions, count(distinct p_partkey) as distinct_sks from part group by 1 having count(*) > 1""")
def precheck_legacy_dups(s: Star) -> DataFrame:
    keyed = s.t("part").select(F.col("p_partkey").alias("old_sk"), natural_key(["p_name", "p_brand", "p_type", "p_size"]).alias("natural_key"))
    return keymap.duplicate_keys(keyed)


@query("select natural_key, count(*) as versions, count(distinct new_sk) as distinct_sks from new2 group by 1 having count(*) > 1")
def precheck_current_dups(s: Star) -> DataFrame:
    return keymap.duplicate_keys(s.new2(), "new_sk")


@query("select natural_key, valid_from, count(*) as versions from new2 group by 1, 2 having count(*) > 1")
def precheck_scd2_version_dups(s: Star) -> DataFrame:
    return keymap.duplicate_versions(s.new2())


@query("select natural_key, count(*) as versions from old2 group by 1 order by 2 desc, 1 limit 5")
def scd_type_discovery_topk(s: Star) -> DataFrame:
    return keymap.most_versions(s.old2())


# --- key-maps ----------------------------------------------------------------------------------

@query("select * from km1")
def keymap_scd1(s: Star) -> DataFrame:
    return s.km1()


@query("select * from km2")
def keymap_scd2(s: Star) -> DataFrame:
    return s.km2()


@query("select map_status, count(*) as n from km1 group by 1")
def keymap_status_scd1(s: Star) -> DataFrame:
    return keymap.status_counts(s.km1())


@query("select map_status, count(*) as n from km2 group by 1")
def keymap_status_scd2(s: Star) -> DataFrame:
    return keymap.status_counts(s.km2())


_IMPACT = "select coalesce(km.map_status, 'NOT_IN_LEGACY_DIM') as bucket, count(*) as fact_rows from {0} f left join {1} km on f.{2} = km.old_sk group by 1"


@query(_IMPACT.format("b_order_fact_ss", "km1", "customer_key"))
def impact_scd1(s: Star) -> DataFrame:
    return keymap.impact(s.b_orders_ss(), "customer_key", s.km1())


@query(_IMPACT.format("b_activity_fact", "km2", "surrogate_key"))
def impact_scd2(s: Star) -> DataFrame:
    return keymap.impact(s.b_activity(), "surrogate_key", s.km2())


@query(_IMPACT.format("b_activity_fact", "(select distinct old_sk, map_status from km2)", "surrogate_key"))
def impact_scd2_distinct(s: Star) -> DataFrame:
    return keymap.impact(s.b_activity(), "surrogate_key", s.km2(), distinct_rows=True)


@query(_IMPACT.format("b_order_fact", "km1", "customer_key"))
def impact_mixed(s: Star) -> DataFrame:
    return keymap.impact(s.b_orders(), "customer_key", s.km1())


@query("select count(*) as n from km1 where map_status = 'ORPHAN_NEW'")
def orphan_new_count(s: Star) -> DataFrame:
    return keymap.orphan_new_count(s.km1())


# --- re-keying ---------------------------------------------------------------------------------

@query("select * from rekeyed")
def rekey_scd1(s: Star) -> DataFrame:
    return repair.rekey(s.b_orders_ss(), ["customer_key"], s.km1())


@query("""select h.order_id, h.line_id, h.event_date, h.supplier_key, h.alt_part_key, h.amount, h.load_batch, coalesce(k.new_sk, -1) as part_key
  from b_hub h left join km_part k on h.part_key = k.old_sk and k.map_status = 'MATCHED'""")
def rekey_scd1_composite(s: Star) -> DataFrame:
    return repair.rekey(s.b_hub(), ["part_key"], s.km_part())


@query("""select h.order_id, h.line_id, h.event_date, h.supplier_key, h.amount, h.load_batch, coalesce(k.new_sk, -1) as part_key, coalesce(a.new_sk, -1) as alt_part_key
  from b_hub h left join km_part k on h.part_key = k.old_sk and k.map_status = 'MATCHED' left join km_part a on h.alt_part_key = a.old_sk and a.map_status = 'MATCHED'""")
def rekey_scd1_multirole(s: Star) -> DataFrame:
    return repair.rekey(s.b_hub(), ["part_key", "alt_part_key"], s.km_part())


@query("""select h.order_id, h.line_id, h.event_date, h.amount, h.load_batch, coalesce(k.new_sk, -1) as part_key, coalesce(a.new_sk, -1) as alt_part_key, coalesce(p.new_sk, -1) as supplier_key
  from b_hub h left join km_part k on h.part_key = k.old_sk and k.map_status = 'MATCHED' left join km_part a on h.alt_part_key = a.old_sk and a.map_status = 'MATCHED'
  left join km_supplier p on h.supplier_key = p.old_sk""")
def rekey_hub_all(s: Star) -> DataFrame:
    return repair.rekey_dimensions(s.b_hub(), [(["part_key", "alt_part_key"], s.km_part(), 1, None), (["supplier_key"], s.km_supplier(), 1, None)])


@query("select * from rekeyed2")
def rekey_scd2(s: Star) -> DataFrame:
    return repair.rekey(s.b_activity(), ["surrogate_key"], s.km2(), 2, "event_date")


@query("""select f.order_id, f.event_date, f.amount, f.customer_id, f.load_batch,
  case when f.load_batch <> 'DB_INCREMENTAL' then coalesce(km.new_sk, -1) else f.customer_key end as customer_key
  from b_order_fact f left join km1 km on f.customer_key = km.old_sk and km.map_status = 'MATCHED'""")
def rekey_only_where(s: Star) -> DataFrame:
    return repair.rekey(s.b_orders(), ["customer_key"], s.km1(), only_where=F.col("load_batch") != "DB_INCREMENTAL")


@query("""select f.order_id, coalesce(d.new_sk, -1) as customer_key, f.customer_id from b_order_fact f
  left join new1 d on upper(trim(f.customer_id)) = d.natural_key where f.load_batch = 'DB_INCREMENTAL'""")
def incremental_nk_lookup(s: Star) -> DataFrame:
    rows = s.b_orders().filter("load_batch = 'DB_INCREMENTAL'").select("order_id", "customer_key", "customer_id")
    return repair.lookup_incremental(rows, ["customer_id"], s.b_customer(), "customer_key", ["customer_id"], "customer_key")


# --- checks ------------------------------------------------------------------------------------

@query("""select count(*) as rows, count(*) filter (customer_key = -1) as unknown_customer_key, count(*) filter (customer_key is null) as null_customer_key from rekeyed""")
def unknown_count(s: Star) -> DataFrame:
    return validate.key_counts(rekey_scd1(s), ["customer_key"])


@query("select (select count(*) from b_order_fact_ss) as source_rows, (select count(*) from rekeyed) as fixed_rows, (select count(*) from b_order_fact_ss) = (select count(*) from rekeyed) as equal")
def row_count_invariant(s: Star) -> DataFrame:
    return validate.row_counts(s.b_orders_ss(), rekey_scd1(s))


@query("select f.* from b_order_fact f anti join b_customer_dim d on f.customer_key = d.customer_key where f.customer_key <> -1")
def ri_pre(s: Star) -> DataFrame:
    return validate.orphans(s.b_orders(), "customer_key", s.b_customer(), "customer_key")


@query("select count(*) as orphan_rows from rekeyed f anti join b_customer_dim d on f.customer_key = d.customer_key where f.customer_key <> -1")
def ri_post(s: Star) -> DataFrame:
    return validate.orphans(rekey_scd1(s), "customer_key", s.b_customer(), "customer_key").agg(rows().alias("orphan_rows"))


@query("""select 'part_key' as fk_column, count(*) as orphan_rows from b_hub h anti join b_part_dim d on h.part_key = d.part_key where h.part_key <> -1
  union all select 'supplier_key', count(*) from b_hub h anti join b_supplier_dim d on h.supplier_key = d.supplier_key where h.supplier_key <> -1
  union all select 'alt_part_key', count(*) from b_hub h anti join b_part_dim d on h.alt_part_key = d.part_key where h.alt_part_key <> -1""")
def ri_hub_matrix(s: Star) -> DataFrame:
    part, supplier = s.b_part(), s.b_supplier()
    return validate.orphan_matrix(s.b_hub(), [("part_key", part, "part_key"), ("supplier_key", supplier, "supplier_key"), ("alt_part_key", part, "part_key")])


@query("""select 'orders' as fact, (select count(*) from b_order_fact_ss) as source_rows, (select count(*) from rekeyed) as fixed_rows,
  (select count(*) from rekeyed f anti join b_customer_dim d on f.customer_key = d.customer_key where f.customer_key <> -1) as orphan_rows, 'PASS' as status""")
def post_repair_gate(s: Star) -> DataFrame:
    return validate.gate(s.b_orders_ss(), rekey_scd1(s), "customer_key", s.b_customer(), "customer_key", "orders")


_REC = """, a as (select {by} as k, sum(cast(amount as decimal(18,2))) as t from {l} group by 1), b as (select {by2} as k, sum(cast(amount as decimal(18,2))) as t from {f} group by 1)
select coalesce(a.k, b.k) as {name}, cast(a.t as double) as legacy_total, cast(b.t as double) as fixed_total, cast(coalesce(a.t, 0) - coalesce(b.t, 0) as double) as diff
from a full outer join b on a.k = b.k where abs(coalesce(a.t, 0) - coalesce(b.t, 0)) > 0.01"""


@query(""", lf as (select o.natural_key, f.amount from g_order_fact f join old1 o on f.customer_key = o.old_sk), ff as (select n.natural_key, f.amount from rekeyed f join new1 n on f.customer_key = n.new_sk)"""
       + _REC.format(by="natural_key", by2="natural_key", l="lf", f="ff", name="natural_key"))
def reconcile_by_nk(s: Star) -> DataFrame:
    legacy = s.g_orders().join(s.old1(), F.col("customer_key") == F.col("old_sk")).select("natural_key", "amount")
    fixed = rekey_scd1(s).join(s.new1(), F.col("customer_key") == F.col("new_sk")).select("natural_key", "amount")
    return validate.reconcile(legacy, fixed, "natural_key", "amount")


@query(""", ff as (select event_date, amount from aligned_nk where event_date <= timestamp '2001-06-30 00:00:00')"""
       + _REC.format(by="cast(event_date as date)", by2="cast(event_date as date)", l="legacy_order_fact", f="ff", name="day"))
def reconcile_by_day(s: Star) -> DataFrame:
    day = F.col("event_date").cast("date").alias("day")
    return validate.reconcile(s.legacy_orders().select(day, "amount"), align_fact_nk(s).filter(F.col("event_date") <= s.cutoff()).select(day, "amount"), "day", "amount")


@query("select f.* from b_activity_fact f join b_customer_scd2 d on f.surrogate_key = d.surrogate_key where f.event_date < d.eff_start or f.event_date >= d.eff_end")
def window_containment(s: Star) -> DataFrame:
    return validate.outside_window(s.b_activity(), "surrogate_key", "event_date", s.b_customer2(), "surrogate_key", "eff_start", "eff_end")


@query("""select g.customer_key as sk, upper(trim(g.customer_id)) as golden_nk, upper(trim(b.customer_id)) as current_nk
  from g_customer_dim g join b_customer_dim b on g.customer_key = b.customer_key where upper(trim(g.customer_id)) <> upper(trim(b.customer_id))""")
def silent_corruption(s: Star) -> DataFrame:
    return keymap.silent_corruption(s.g_customer(), s.b_customer(), "customer_key", ["customer_id"])


# --- alignment ---------------------------------------------------------------------------------

@query("select * from dim_fixed_keep")
def align_dim_keep(s: Star) -> DataFrame:
    return align.align_dim(s.b_customer(), fx.CUSTOMER, s.km1())


_ALLOCATE = """select coalesce(km.old_sk, x.next, d.customer_key) as customer_key, d.customer_id, d.segment from b_customer_dim d
  left join km1 km on {nk} = km.natural_key and km.map_status = 'MATCHED'
  left join (select natural_key, (select max(old_sk) from old1) + row_number() over (order by natural_key) as next from km1 where map_status = 'ORPHAN_NEW'{where}) x on {nk} = x.natural_key"""


@query(_ALLOCATE.format(nk=_NK.format("d.customer_id"), where=" and new_sk <> -1"))
def align_dim_allocate(s: Star) -> DataFrame:
    return align.align_dim(s.b_customer(), fx.CUSTOMER, s.km1(), "allocate_after_max", s.old1())


@query(_ALLOCATE.format(nk=_NK.format("d.customer_id"), where=""))
def align_dim_allocate_all(s: Star) -> DataFrame:
    return align.align_dim(s.b_customer(), fx.CUSTOMER, s.km1(), "allocate_after_max", s.old1(), allocate_unknown=True)


@query("""select surrogate_key, customer_id, eff_start, eff_end, record_status from (
  select coalesce(o.old_sk, d.surrogate_key) as surrogate_key, d.customer_id, d.eff_start, d.eff_end, d.record_status, o.old_sk,
    row_number() over (partition by upper(trim(d.customer_id)), d.eff_start, d.eff_end order by o.old_sk) as rn
  from b_customer_scd2 d left join old2 o on upper(trim(d.customer_id)) = o.natural_key and o.valid_from < coalesce(d.eff_end, date '9999-12-31') and d.eff_start < coalesce(o.valid_to, date '9999-12-31'))
  where rn = 1 or old_sk is null""")
def align_dim_scd2(s: Star) -> DataFrame:
    return align.align_dim_scd2(s.b_customer2(), fx.CUSTOMER2, s.old2())


@query("select count(*) as changed from b_customer_dim b join dim_fixed_keep f on upper(trim(b.customer_id)) = upper(trim(f.customer_id)) where b.customer_key <> f.customer_key")
def align_dim_changed(s: Star) -> DataFrame:
    return align.changed_keys(s.b_customer(), align_dim_keep(s), "customer_key", ["customer_id"])


@query("""select case when f.event_date <= timestamp '2001-06-30 00:00:00' and l.order_id is not null then 'MATCHED_SS_FACT' when f.event_date <= timestamp '2001-06-30 00:00:00' then 'MISSING_SS_FACT'
  when f.event_date > timestamp '2001-06-30 00:00:00' then 'AFTER_CUTOFF' end as bucket, count(*) as fact_rows from b_order_fact f left join legacy_order_fact l on f.order_id = l.order_id group by 1""")
def fact_match_audit(s: Star) -> DataFrame:
    return align.match_audit(s.b_orders(), s.legacy_orders(), fx.ORDER_ALIGN, s.cutoff())


@query("select * from aligned_nk")
def align_fact_nk(s: Star) -> DataFrame:
    return align.align_fact(s.b_orders(), s.legacy_orders(), fx.ORDER_ALIGN, align_dim_keep(s), fx.CUSTOMER, s.km1(), s.cutoff())


@query("""select f.order_id, f.event_date, f.amount, f.customer_id, f.load_batch,
  case when f.event_date <= timestamp '2001-06-30 00:00:00' then coalesce(s.customer_key, km.old_sk, -1) else coalesce(km.old_sk, -1) end as customer_key
  from b_order_fact f left join legacy_order_fact s on f.order_id = s.order_id left join km1 km on f.customer_key = km.new_sk and km.map_status = 'MATCHED'""")
def align_fact_keymap_only(s: Star) -> DataFrame:
    return align.align_fact(s.b_orders(), s.legacy_orders(), replace(fx.ORDER_ALIGN, nks=()), align_dim_keep(s), fx.CUSTOMER, s.km1(), s.cutoff())


@query("""select a.order_id, a.event_date, a.amount, a.customer_id, a.load_batch, coalesce(d.customer_key, -1) as customer_key
  from aligned_nk a left join (select distinct customer_key from dim_fixed_keep) d on a.customer_key = d.customer_key""")
def align_fact_park_missing(s: Star) -> DataFrame:
    return align.align_fact(s.b_orders(), s.legacy_orders(), fx.ORDER_ALIGN, align_dim_keep(s), fx.CUSTOMER, s.km1(), s.cutoff(), park_missing=True)


@query("""select (select count(*) from b_order_fact where event_date <= timestamp '2001-06-30 00:00:00') as through_cutoff,
  (select count(*) from b_order_fact f join legacy_order_fact l on f.order_id = l.order_id) as ss_matched""")
def align_stats(s: Star) -> DataFrame:
    return align.align_stats(s.b_orders(), s.legacy_orders(), fx.ORDER_ALIGN, s.cutoff())


@query("""select d.* from b_customer_dim d anti join old1 o on d.customer_key = o.old_sk where d.customer_key <> -1 and d.customer_key <= (select max(old_sk) from old1)
  union all select d.* from dim_fixed_keep d anti join old1 o on d.customer_key = o.old_sk where d.customer_key <> -1 and d.customer_key <= (select max(old_sk) from old1)""")
def dim_sk_sanity(s: Star) -> DataFrame:
    old = s.old1()
    return align.strange_keys(s.b_customer(), "customer_key", old).unionByName(align.strange_keys(align_dim_keep(s), "customer_key", old))


# --- report ------------------------------------------------------------------------------------

def _customer(s: Star, fixed: bool = False) -> report.Dimension:
    fact = rekey_scd1(s) if fixed else s.b_orders_ss()
    return report.Dimension("customer_dim", "customer_key", ("customer_id",), s.b_customer(), s.g_customer(), (("order_fact", fact, "customer_key"),))


def _text(df: DataFrame) -> DataFrame:
    return df.withColumn("load_batches", F.array_join("load_batches", ","))


@query("select sk, 'order_fact' as fact_table, 'customer_key' as fk_column, row_count, load_batches from used_orders")
def report_usage(s: Star) -> DataFrame:
    return _text(report.usage(s.b_orders_ss(), "customer_key", "order_fact"))


@query("select distinct part_key as sk, part_code || '|' || source_system as nk from b_part_dim where part_key <> -1")
def report_nk_map(s: Star) -> DataFrame:
    return report.nk_map(s.b_part(), "part_key", ("part_code", "source_system"))


@query("""select 'pre' as pass, 'customer_dim' as dimension, 'customer_key' as sk_column, sk, issue_type, golden_nk, broken_nk,
  'order_fact' as fact_table, 'customer_key' as fk_column, row_count, load_batches from issues_pre where issue_type <> 'NK_MATCH'""")
def report_issues_flat(s: Star) -> DataFrame:
    return _text(report.flatten(report.issues([_customer(s)], "pre")))


@query("""select 'pre' as pass, 'customer_dim' as dimension, 'customer_key' as sk_column, issue_type, count(*) as sk_count, cast(sum(row_count) as bigint) as fact_rows_affected
  from issues_pre where issue_type <> 'NK_MATCH' group by issue_type""")
def report_summary(s: Star) -> DataFrame:
    return report.summary(report.issues([_customer(s)], "pre"))


@query("""select 'customer_dim' as dimension, 'customer_key' as sk_column, coalesce(a.sk, b.sk) as sk, coalesce(a.issue_type, b.issue_type) as issue_type, a.row_count as pre_fact_rows, b.row_count as post_fact_rows,
  case when b.row_count is null then 'FIXED (gone post-repair)' when a.row_count is null then 'NEW post-repair' when b.row_count = 0 then 'FIXED' when b.row_count < a.row_count then 'IMPROVED' else 'UNCHANGED' end as status
  from (select * from issues_pre where issue_type <> 'NK_MATCH') a full outer join (select * from issues_post where issue_type <> 'NK_MATCH') b on a.sk = b.sk and a.issue_type = b.issue_type""")
def report_compare(s: Star) -> DataFrame:
    return report.compare(report.issues([_customer(s)], "pre"), report.issues([_customer(s, True)], "post"))


# --- corruption --------------------------------------------------------------------------------

@query("select * from b_part_dim")
def break_scd1(s: Star) -> DataFrame:
    return s.b_part()


@query("select * from b_customer_scd2")
def break_scd2(s: Star) -> DataFrame:
    return s.b_customer2()


@query("""select cast(row_number() over (order by customer_id desc) as bigint) as customer_key, customer_id, segment from g_customer_dim where customer_key % 50 <> 0
  union all select 2000000 + row_number() over (order by c_custkey), 'NEW#' || lpad(cast(c_custkey as varchar), 4, '0'), 'Gold' from customer where c_custkey < 15""")
def break_members(s: Star) -> DataFrame:
    fresh = s.t("customer").filter("c_custkey < 15").select(F.concat(F.lit("NEW#"), F.lpad(F.col("c_custkey").cast("string"), 4, "0")).alias("customer_id"), F.lit("Gold").alias("segment"))
    return corrupt.break_members(s.g_customer(), "customer_key", "customer_id", F.col("customer_key") % 50 == 0, fresh, 2_000_000)


@query("select * from b_order_fact")
def cohorts(s: Star) -> DataFrame:
    return s.b_orders()


@query("select load_batch, count(*) as n from b_order_fact group by 1")
def cohort_counts(s: Star) -> DataFrame:
    return s.b_orders().groupBy("load_batch").agg(rows().alias("n"))


@query("select * from g_order_fact where order_id >= 50")
def count_mismatch(s: Star) -> DataFrame:
    return corrupt.without_rows(s.g_orders(), F.col("order_id") < 50)


@query("select customer_key, customer_id, case when customer_key <= 30 then 'CHANGED' else segment end as segment from g_customer_dim")
def hash_mismatch(s: Star) -> DataFrame:
    return corrupt.with_values(s.g_customer(), F.col("customer_key") <= 30, {"segment": "CHANGED"})


@query("select 'CHANGED' as kind, count(*) as n from g_customer_dim where customer_key <= 30")
def recon_mismatches(s: Star) -> DataFrame:
    return corrupt.mismatches(s.g_customer(), hash_mismatch(s), "customer_key")


@query("select surrogate_key, customer_id, eff_start as \"effectiveStartDate\", eff_end as \"effectiveEndDate\", record_status as \"recordStatus\" from g_customer_scd2")
def scd2_normalize(s: Star) -> DataFrame:
    own = {"effectiveStartDate": ("eff_start",), "effectiveEndDate": ("eff_end",)}
    return corrupt.normalize_scd2(s.g_customer2(), aliases={k: v + own.get(k, ()) for k, v in corrupt.SCD2_ALIASES.items()})


@query("""select f.activity_id, case when f.event_date < d.eff_start or f.event_date > d.eff_end then cast(d.eff_start as timestamp) else f.event_date end as event_date
  from b_activity_fact f join b_customer_scd2 d on f.surrogate_key = d.surrogate_key""")
def event_clamp(s: Star) -> DataFrame:
    from keymend.functions.dates import clamped_to_start

    d = s.b_customer2().select("surrogate_key", "eff_start", "eff_end")
    start = F.col("eff_start").cast("timestamp_ntz")
    return s.b_activity().join(d, "surrogate_key").select("activity_id", clamped_to_start(F.col("event_date"), start, F.col("eff_end").cast("timestamp_ntz")).alias("event_date"))


_VERSIONS = """select o.order_id, o.part_key, row_number() over (partition by o.part_key order by o.order_id, o.line_id, o.supplier_key, o.event_date) as version
  from g_hub o"""


@query(_VERSIONS)
def hub_versions(s: Star) -> DataFrame:
    w = Window.partitionBy("part_key").orderBy("order_id", "line_id", "supplier_key", "event_date")
    return s.g_hub().select("order_id", "part_key", F.row_number().over(w).cast("long").alias("version"))


@query(_VERSIONS)
def hub_versions_whole(s: Star) -> DataFrame:
    """The name that hub_versions had while that numbered a tenth of the hub only."""
    return hub_versions(s)


# --- type 2 and several dimensions ------------------------------------------------------------

_NAMED = """, na as (
  select a.activity_id, a.event_date, a.amount, g.customer_id, b.surrogate_key from b_activity_fact a join g_customer_scd2 g on a.surrogate_key = g.surrogate_key
  join b_customer_scd2 b on b.customer_id = g.customer_id and b.record_status = case when a.event_date >= timestamp '1998-01-01 00:00:00' then 'C' else 'H' end),
la as (select activity_id, surrogate_key from b_activity_fact where event_date <= timestamp '1998-06-30 00:00:00' and activity_id % 5 <> 0),
back as (
  select f.activity_id, f.surrogate_key, km.old_sk from na f join km2 km on f.surrogate_key = km.new_sk and km.map_status in ('MATCHED', 'AMBIGUOUS')
    and f.event_date >= km.valid_from and f.event_date < coalesce(km.valid_to, date '9999-12-31'))
"""


def _align_activity(s: Star, dated: bool, branch: bool = False) -> DataFrame:
    spec = replace(fx.ACTIVITY_ALIGN, nks=("customer_id",)) if dated else fx.ACTIVITY_ALIGN
    limit = F.lit(fx.ACTIVITY_CUTOFF).cast("timestamp_ntz")
    return align.align_fact(s.named_activity(), s.legacy_activity(), spec, align_dim_scd2(s), fx.CUSTOMER2, s.km2(), limit, dated_lookup=dated, with_branch=branch)


@query(_NAMED + """select f.activity_id, f.event_date, f.amount, f.customer_id, coalesce(la.surrogate_key, back.old_sk, -1) as surrogate_key
  from na f left join la on f.activity_id = la.activity_id left join back on f.activity_id = back.activity_id""")
def align_fact_scd2(s: Star) -> DataFrame:
    return _align_activity(s, False)


@query(_NAMED + """, df as (
  select coalesce(min(o.old_sk), d.surrogate_key) as surrogate_key, d.customer_id, d.eff_start, d.eff_end from b_customer_scd2 d left join old2 o
  on upper(trim(d.customer_id)) = o.natural_key and o.valid_from < d.eff_end and d.eff_start < o.valid_to group by d.surrogate_key, d.customer_id, d.eff_start, d.eff_end)
select f.activity_id, f.event_date, f.amount, f.customer_id, coalesce(la.surrogate_key, df.surrogate_key, back.old_sk, -1) as surrogate_key,
  case when la.surrogate_key is not null then 'LEGACY_FACT' when df.surrogate_key is not null then 'NATURAL_KEY' when back.old_sk is not null then 'KEY_MAP' else 'UNKNOWN' end as branch
  from na f left join la on f.activity_id = la.activity_id left join back on f.activity_id = back.activity_id
  left join df on f.customer_id = df.customer_id and f.event_date >= df.eff_start and f.event_date < df.eff_end""")
def align_fact_dated(s: Star) -> DataFrame:
    return _align_activity(s, True, branch=True)


@query(""", roles as (select *, 2 * (activity_id % (select count(*) from customer)) + 1 as first_key from b_activity_fact)
select f.activity_id, f.event_date, f.amount, coalesce(a.new_sk, -1) as surrogate_key, coalesce(b.new_sk, -1) as first_key from roles f
  left join km2 a on f.surrogate_key = a.old_sk and a.map_status in ('MATCHED', 'AMBIGUOUS') and f.event_date >= a.valid_from and f.event_date < coalesce(a.valid_to, date '9999-12-31')
  left join km2 b on f.first_key = b.old_sk and b.map_status in ('MATCHED', 'AMBIGUOUS') and f.event_date >= b.valid_from and f.event_date < coalesce(b.valid_to, date '9999-12-31')""")
def rekey_scd2_multirole(s: Star) -> DataFrame:
    return repair.rekey(s.b_activity_roles(), ["surrogate_key", "first_key"], s.km2(), 2, "event_date")


_HUB = """select 2 * s_suppkey + v + 1 as detail_sk, s_name as account_number, """ + ", ".join(
    f"(s_suppkey * {i + 3} + v * 7) % {n} + 1 as {name}_key" for i, (name, n) in enumerate(fx.HUB_REFS.items())) + """,
  date '2023-01-01' + cast(180 * v + (2 * s_suppkey + v + 1) % 30 as integer) as "effectiveStartDate",
  case when v = 1 then date '2999-12-31' else date '2023-01-01' + cast((2 * s_suppkey + 1) % 30 + 179 as integer) end as "effectiveEndDate",
  case when v = 1 then 'C' else 'H' end as "recordStatus" from supplier, (values (0), (1)) as t(v)"""


@query(_HUB)
def hub_scd2(s: Star) -> DataFrame:
    return s.hub_scd2()


@query(f", hub as ({_HUB}), " + ", ".join(
    f"m_{name} as (select k as old_sk, row_number() over (order by '{name.upper()}-' || k desc) as new_sk from (select unnest(range(1, {n + 1})) as k))"
    for name, n in fx.HUB_REFS.items()) + """ select detail_sk, account_number, "effectiveStartDate", "effectiveEndDate", "recordStatus", """ + ", ".join(
    f"coalesce(m_{name}.new_sk, -1) as {name}_key" for name in fx.HUB_REFS) + " from hub " + " ".join(f"left join m_{name} on hub.{name}_key = m_{name}.old_sk" for name in fx.HUB_REFS))
def rekey_hub_scd2(s: Star) -> DataFrame:
    """All seven references of the hub in one rebuild."""
    def keys(name: str) -> DataFrame:
        spec = DimSpec(f"{name}_key", ("code",))
        golden = s.lookup(name)
        return keymap.build_keymap(keymap.snapshot(golden, spec), keymap.snapshot(corrupt.break_scd1(golden, spec.sk, ["code"]), spec, "new_sk"))
    return repair.rekey_dimensions(s.hub_scd2(), [([f"{name}_key"], keys(name), 1, None) for name in fx.HUB_REFS])


@query("""select count(*) filter (post_fact_rows is null or post_fact_rows = 0) as fixed, count(post_fact_rows) as still_open from (
  select a.row_count as pre_fact_rows, b.row_count as post_fact_rows from (select * from issues_pre where issue_type <> 'NK_MATCH') a
  full outer join (select * from issues_post where issue_type <> 'NK_MATCH') b on a.sk = b.sk and a.issue_type = b.issue_type)""")
def report_progress(s: Star) -> DataFrame:
    return report.progress(report_compare(s))
