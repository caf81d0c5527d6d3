"""Aligning dimensions and facts to the legacy surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keymend.functions.dates import contains, end_or_open, overlaps
from keymend.functions.keys import business_key_equal, natural_key
from keymend.operators.keymap import AMBIGUOUS, MATCHED, ORPHAN_NEW, max_sk
from keymend.plans.specs import AlignFactSpec, DimSpec
from keymend.sources.tables import numbered

UNKNOWN = -1


def align_dim(dim: DataFrame, spec: DimSpec, keymap: DataFrame, policy: str = "keep_current", snapshot: DataFrame | None = None,
              unknown: int = UNKNOWN, allocate_unknown: bool = False) -> DataFrame:
    """A type-1 dimension with legacy SKs where the key-map has them, the SK in front. New members keep
    their SK, or with `allocate_after_max` get numbers after the snapshot's largest, in key order; the unknown
    member keeps its SK unless `allocate_unknown`."""
    rest = [c for c in dim.columns if c != spec.sk]
    keyed = dim.withColumn("__nk", natural_key(spec.nks))
    old = keymap.filter(F.col("map_status") == MATCHED).select(F.col("natural_key").alias("__km_nk"), F.col("old_sk").alias("__old"))
    out = keyed.join(old, F.col("__nk") == F.col("__km_nk"), "left")
    choice = [F.col("__old")]
    if policy == "allocate_after_max":
        if snapshot is None:
            raise ValueError("allocate_after_max needs the legacy snapshot")
        fresh = keymap.filter(F.col("map_status") == ORPHAN_NEW)
        fresh = fresh if allocate_unknown else fresh.filter(F.col("new_sk") != unknown)
        fresh = numbered(fresh.select(F.col("natural_key").alias("__new_nk")), ["__new_nk"], "__rn")
        fresh = fresh.join(F.broadcast(max_sk(snapshot))).select("__new_nk", (F.col("max_sk") + F.col("__rn")).alias("__next"))  # one row
        out = out.join(fresh, F.col("__nk") == F.col("__new_nk"), "left")
        choice.append(F.col("__next"))
    elif policy != "keep_current":
        raise ValueError(f"unknown policy {policy!r}")
    return out.select(F.coalesce(*choice, F.col(spec.sk)).alias(spec.sk), *rest)


def align_dim_scd2(dim: DataFrame, spec: DimSpec, snapshot: DataFrame, pick: str = "min_sk") -> DataFrame:
    """A type-2 dimension with the legacy SK of an overlapping legacy version: the smallest, or with
    `max_overlap` that of the longest overlap. Rows that agree in key and window become one."""
    keyed = dim.withColumn("__nk", natural_key(spec.nks))
    old = snapshot.select(F.col("old_sk").alias("__old"), F.col("natural_key").alias("__o_nk"),
                          F.col("valid_from").alias("__o_from"), F.col("valid_to").alias("__o_to"))
    a, b = F.col(spec.valid_from), F.col(spec.valid_to)
    out = keyed.join(old, (F.col("__nk") == F.col("__o_nk")) & overlaps(F.col("__o_from"), F.col("__o_to"), a, b), "left")
    order = [F.col("__old")]
    if pick == "max_overlap":
        shared = F.datediff(F.least(end_or_open(b), end_or_open(F.col("__o_to"))), F.greatest(a, F.col("__o_from")))
        order.insert(0, shared.desc_nulls_last())
    elif pick != "min_sk":
        raise ValueError(f"unknown pick {pick!r}")
    first = Window.partitionBy("__nk", spec.valid_from, spec.valid_to).orderBy(*order, F.col(spec.sk))
    out = out.withColumn("__rn", F.row_number().over(first)).filter((F.col("__rn") == 1) | F.col("__old").isNull())
    return out.select(F.coalesce("__old", spec.sk).alias(spec.sk), *(c for c in dim.columns if c != spec.sk))


def changed_keys(before: DataFrame, after: DataFrame, sk: str, nks) -> DataFrame:
    """One row: dimension members whose SK the alignment changed."""
    a = before.select(natural_key(nks).alias("nk"), F.col(sk).alias("sk_before"))
    b = after.select(natural_key(nks).alias("nk"), F.col(sk).alias("sk_after"))
    return a.join(b, "nk").filter("sk_before <> sk_after").agg(F.count(F.lit(1)).alias("changed"))


def match_audit(fact: DataFrame, legacy: DataFrame, spec: AlignFactSpec, cutoff: Column) -> DataFrame:
    """Rows with a legacy row through the cutoff, without one, and after the cutoff (null dates: no bucket)."""
    f, s = fact.alias("f"), legacy.alias("s")
    on = business_key_equal([F.col(f"s.{c}") for c in spec.legacy_bk], [F.col(f"f.{c}") for c in spec.bk])
    day = F.col(f"f.{spec.event_date}")
    found = F.col(f"s.{spec.legacy_bk[0]}").isNotNull()
    bucket = F.when((day <= cutoff) & found, "MATCHED_SS_FACT").when(day <= cutoff, "MISSING_SS_FACT").when(day > cutoff, "AFTER_CUTOFF")
    return f.join(s, on, "left").groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("fact_rows"))


def align_fact(fact: DataFrame, legacy: DataFrame, spec: AlignFactSpec, dim_fixed: DataFrame, dim: DimSpec, keymap: DataFrame,
               cutoff: Column, unknown: int = UNKNOWN, park_missing: bool = False, keymap_only_where: Column | None = None,
               dated_lookup: bool = False, with_branch: bool = False) -> DataFrame:
    """The fact with its FK on legacy SKs: through the cutoff from the legacy fact, else by the fact's
    natural key in the aligned dimension, else by the key-map read backwards, else unknown.

    `park_missing` sends keys that the aligned dimension lacks to unknown; `keymap_only_where`
    keeps the key-map for rows known to hold current keys; `dated_lookup` adds the validity window
    to the natural-key lookup (type 2); `with_branch` adds the name of the branch taken."""
    from keymend.functions.keys import natural_key as nk

    day = F.col(f"f.{spec.event_date}")
    through = day <= cutoff  # later rows, and those without a date, need no legacy row
    out = fact.alias("f").join(legacy.alias("s"), through & business_key_equal(
        [F.col(f"s.{c}") for c in spec.legacy_bk], [F.col(f"f.{c}") for c in spec.bk]), "left")
    by_nk = F.lit(None).cast("long")
    if spec.nks:
        look = [F.col(dim.sk).alias("__dim_sk"), nk(dim.nks).alias("__dim_nk")]
        on = nk([F.col(f"f.{c}") for c in spec.nks]) == F.col("__dim_nk")
        if dated_lookup and dim.scd == 2:
            look += [F.col(dim.valid_from).alias("__dim_from"), F.col(dim.valid_to).alias("__dim_to")]
            on = on & contains(day, F.col("__dim_from"), F.col("__dim_to"))
        out = out.join(dim_fixed.select(*look), on, "left")
        by_nk = F.col("__dim_sk")
    back = keymap.filter(F.col("map_status").isin(*((MATCHED, AMBIGUOUS) if dim.scd == 2 else (MATCHED,))))
    back = back.select(F.col("new_sk").alias("__new"), F.col("old_sk").alias("__km_old"), F.col("valid_from").alias("__km_from"), F.col("valid_to").alias("__km_to"))
    on = F.col(f"f.{spec.fk}") == F.col("__new")
    if dim.scd == 2:
        on = on & contains(day, F.col("__km_from"), F.col("__km_to"))
    if keymap_only_where is not None:
        on = on & keymap_only_where
    out = out.join(back, on, "left")
    from_legacy = F.col(f"s.{spec.legacy_fk}")
    resolved = F.coalesce(from_legacy, by_nk, F.col("__km_old"), F.lit(unknown))
    branch = (F.when(from_legacy.isNotNull(), "LEGACY_FACT").when(by_nk.isNotNull(), "NATURAL_KEY")
              .when(F.col("__km_old").isNotNull(), "KEY_MAP").otherwise("UNKNOWN"))
    kept = [F.col(f"f.{c}") for c in fact.columns if c != spec.fk]
    out = out.select(*kept, resolved.alias(spec.fk), *([branch.alias("branch")] if with_branch else []))
    if park_missing:
        held = dim_fixed.select(F.col(dim.sk).alias("__held")).distinct()
        out = out.join(held, F.col(spec.fk) == F.col("__held"), "left")
        out = out.withColumn(spec.fk, F.coalesce("__held", F.lit(unknown))).drop("__held")
    return out


def align_stats(fact: DataFrame, legacy: DataFrame, spec: AlignFactSpec, cutoff: Column) -> DataFrame:
    """One row: fact rows through the cutoff, and pairs with the legacy fact."""
    through = fact.filter(F.col(spec.event_date) <= cutoff).agg(F.count(F.lit(1)).alias("through_cutoff"))
    on = business_key_equal([F.col(f"s.{c}") for c in spec.legacy_bk], [F.col(f"f.{c}") for c in spec.bk])
    pairs = fact.alias("f").join(legacy.alias("s"), on).agg(F.count(F.lit(1)).alias("ss_matched"))
    return through.join(pairs)  # one row each


def strange_keys(dim_fixed: DataFrame, sk: str, snapshot: DataFrame, unknown: int = UNKNOWN) -> DataFrame:
    """Aligned members in the legacy SK range whose SK the legacy dimension never had."""
    top = F.broadcast(max_sk(snapshot))  # one row
    return (dim_fixed.join(snapshot.select("old_sk"), F.col(sk) == F.col("old_sk"), "left_anti").filter(F.col(sk) != unknown)
            .join(top).filter(F.col(sk) <= F.col("max_sk")).drop("max_sk"))
