"""Snapshots, pre-checks, key-maps and their audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keymend.functions.dates import overlaps
from keymend.functions.keys import natural_key
from keymend.plans.specs import DimSpec

MATCHED, AMBIGUOUS, ORPHAN_OLD, ORPHAN_NEW = "MATCHED", "AMBIGUOUS", "ORPHAN_OLD", "ORPHAN_NEW"


def snapshot(dim: DataFrame, spec: DimSpec, sk_name: str = "old_sk") -> DataFrame:
    """SK, normalised natural key and, for type 2, the validity of a dimension."""
    spec.check(dim)
    cols = [F.col(spec.sk).alias(sk_name), natural_key(spec.nks).alias("natural_key")]
    if spec.scd == 2:
        cols += [F.col(spec.valid_from).alias("valid_from"), F.col(spec.valid_to).alias("valid_to")]
    return dim.select(*cols)


def max_sk(snap: DataFrame, sk: str = "old_sk") -> DataFrame:
    """One row: the largest SK, 0 for an empty dimension."""
    return snap.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long").alias("max_sk"))


def duplicate_keys(snap: DataFrame, sk: str = "old_sk", above: int = 1) -> DataFrame:
    """Natural keys with more than `above` rows: versions and distinct SKs."""
    return (snap.groupBy("natural_key").agg(F.count(F.lit(1)).alias("versions"), F.count_distinct(sk).alias("distinct_sks"))
            .filter(F.col("versions") > above))


def duplicate_versions(snap: DataFrame) -> DataFrame:
    """Type 2: (natural key, start) pairs that more than one version has; these fan out facts."""
    return (snap.groupBy("natural_key", "valid_from").agg(F.count(F.lit(1)).alias("versions")).filter("versions > 1"))


def most_versions(snap: DataFrame, k: int = 5) -> DataFrame:
    """The k natural keys with the most versions: more than one each tells of type 2."""
    return snap.groupBy("natural_key").agg(F.count(F.lit(1)).alias("versions")).orderBy(F.desc("versions"), "natural_key").limit(k)


def build_keymap(old: DataFrame, new: DataFrame, scd: int = 1, full: bool = False, resolve: str | None = None) -> DataFrame:
    """natural_key, old_sk, new_sk, valid_from, valid_to, map_status from two snapshots
    (old_sk / new_sk, natural_key[, valid_from, valid_to]).

    Type 1 is a full outer join on the key. Type 2 left-joins versions whose windows overlap; an
    old SK with several is AMBIGUOUS, and new versions without an old one don't show up unless `full`.
    `resolve='min_new_sk'` keeps one row per old SK and new window, which prevents fan-out."""
    o, n = old.alias("o"), new.alias("n")
    same = F.col("o.natural_key") == F.col("n.natural_key")
    if scd == 1:
        joined = o.join(n, same, "full_outer")
        status = (F.when(F.col("o.natural_key").isNull(), ORPHAN_NEW).when(F.col("n.natural_key").isNull(), ORPHAN_OLD).otherwise(MATCHED))
        none = F.lit(None).cast("timestamp")
        return joined.select(F.coalesce("o.natural_key", "n.natural_key").alias("natural_key"), F.col("o.old_sk"), F.col("n.new_sk"),
                             none.alias("valid_from"), none.alias("valid_to"), status.alias("map_status"))
    both = same & overlaps(F.col("o.valid_from"), F.col("o.valid_to"), F.col("n.valid_from"), F.col("n.valid_to"))
    joined = o.join(n, both, "full_outer" if full else "left").select(
        F.coalesce("o.natural_key", "n.natural_key").alias("natural_key"), F.col("o.old_sk"), F.col("n.new_sk"),
        F.col("n.valid_from").alias("valid_from"), F.col("n.valid_to").alias("valid_to"))
    if resolve == "min_new_sk":
        first = Window.partitionBy("old_sk", "valid_from").orderBy("new_sk")
        joined = joined.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn")
    matches = F.count("new_sk").over(Window.partitionBy("old_sk"))
    status = (F.when(F.col("old_sk").isNull(), ORPHAN_NEW).when(F.col("new_sk").isNull(), ORPHAN_OLD)
              .when(matches > 1, AMBIGUOUS).otherwise(MATCHED))
    return joined.withColumn("map_status", status)


def stamped(keymap: DataFrame) -> DataFrame:
    """With the time of building."""
    return keymap.withColumn("created_at", F.current_timestamp())


def provenance(legacy: str, current: str) -> dict[str, str]:
    return {"maps_legacy": legacy, "maps_current": current}


def status_counts(keymap: DataFrame) -> DataFrame:
    return keymap.groupBy("map_status").agg(F.count(F.lit(1)).alias("n"))


def impact(fact: DataFrame, fk: str, keymap: DataFrame, distinct_rows: bool = False) -> DataFrame:
    """Fact rows by what the key-map says of their FK. Type-2 maps count a row once per mapping,
    unless `distinct_rows`, which first makes the map one row per old SK."""
    km = keymap.filter(F.col("old_sk").isNotNull()).select("old_sk", "map_status")
    km = km.distinct() if distinct_rows else km
    return (fact.join(km, F.col(fk) == F.col("old_sk"), "left")
            .groupBy(F.coalesce("map_status", F.lit("NOT_IN_LEGACY_DIM")).alias("bucket")).agg(F.count(F.lit(1)).alias("fact_rows")))


def orphan_new_count(keymap: DataFrame) -> DataFrame:
    return keymap.filter(F.col("map_status") == ORPHAN_NEW).agg(F.count(F.lit(1)).alias("n"))


def silent_corruption(golden: DataFrame, current: DataFrame, sk: str, nks: Sequence[str | Column]) -> DataFrame:
    """SKs on both sides that mean different entities."""
    g = golden.select(F.col(sk).alias("sk"), natural_key(nks).alias("golden_nk"))
    c = current.select(F.col(sk).alias("sk"), natural_key(nks).alias("current_nk"))
    return g.join(c, "sk").filter("golden_nk <> current_nk")
