"""Breaking star schemas on purpose, without random numbers or clocks, and reconciling copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keymend.sources.tables import numbered

UNKNOWN = -1


def break_scd1(golden: DataFrame, sk: str, order: Sequence[str], unknown: int = UNKNOWN) -> DataFrame:
    """SKs renumbered from 1 against the key order; the unknown member stays."""
    rest = [c for c in golden.columns if c != sk]
    body = numbered(golden.filter(F.col(sk) != unknown).select(*rest), [F.col(c).desc() for c in order], sk)
    return golden.filter(F.col(sk) == unknown).unionByName(body.select(sk, *rest))


def break_scd2(golden: DataFrame, sk: str, order: Sequence, start: str, end: str, days: int = 15, open_end: str = "2999-12-31") -> DataFrame:
    """Versions renumbered in the given order and moved by `days`; open ends stay."""
    rest = [c for c in golden.columns if c != sk]
    body = numbered(golden.select(*rest), list(order), sk)
    stays = F.col(end) == F.lit(open_end).cast("date")
    return body.withColumn(end, F.when(stays, F.col(end)).otherwise(F.date_add(end, days))).withColumn(start, F.date_add(start, days)).select(sk, *rest)


def key_changes(before: DataFrame, after: DataFrame, sk: str, nk: Column) -> DataFrame:
    """old_sk, new_sk of each member on both sides."""
    return before.select(F.col(sk).alias("old_sk"), nk.alias("nk")).join(after.select(F.col(sk).alias("new_sk"), nk.alias("nk")), "nk").drop("nk")


def break_members(golden: DataFrame, sk: str, nk: str, drop: Column, fresh: DataFrame, base: int) -> DataFrame:
    """Members lost (`drop`), the rest reloaded in reverse order, and new ones (`fresh`: same columns without sk) after `base`."""
    rest = [c for c in golden.columns if c != sk]
    body = numbered(golden.filter(~drop).select(*rest), [F.col(nk).desc()], sk)
    new = numbered(fresh.select(*rest), [F.col(nk)], sk).withColumn(sk, F.col(sk) + F.lit(base))
    return body.select(sk, *rest).unionByName(new.select(sk, *rest))


def cohorts(fact: DataFrame, fk: str, business_key: str, mapping: DataFrame, base: int = 5_000_000, orphan_every: int = 97,
            share: int = 7, of: int = 20, unknown: int = UNKNOWN) -> DataFrame:
    """Every `orphan_every`-th row gets a key that no dimension has; `share` in `of` of the others are a later
    load that holds current keys (`mapping`: old_sk, new_sk); adds load_batch."""
    k = F.col(business_key)
    lost, later = k % orphan_every == 0, k % of < share
    out = fact.join(mapping, F.col(fk) == F.col("old_sk"), "left")
    key = F.when(lost, F.lit(base) + k % of).when(later, F.coalesce("new_sk", F.lit(unknown))).otherwise(F.col(fk))
    batch = F.when(lost, "INITIAL_SS_ORPHAN").when(later, "DB_INCREMENTAL").otherwise("INITIAL_SS")
    return out.withColumn(fk, key).withColumn("load_batch", batch).drop("old_sk", "new_sk")


def without_rows(df: DataFrame, gone: Column) -> DataFrame:
    """A target with missing rows."""
    return df.filter(~gone)


def with_values(df: DataFrame, where: Column, values: dict[str, object]) -> DataFrame:
    """A target with changed values in some rows."""
    return df.withColumns({c: F.when(where, F.lit(v).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()})


# Other names of the type-2 columns in legacy tables.
SCD2_ALIASES = {
    "effectiveStartDate": ("effective_start_date", "EffectiveStartDate", "valid_from"),
    "effectiveEndDate": ("effective_end_date", "EffectiveEndDate", "valid_to"),
    "recordStatus": ("record_status", "RecordStatus", "is_current"),
}


def normalize_scd2(df: DataFrame, open_end: str = "2999-12-31", aliases: dict[str, tuple[str, ...]] = SCD2_ALIASES) -> DataFrame:
    """Canonical type-2 columns: names, dates, and status C or H (from booleans, 1 and 0, else from the end
    date); other numbers stay, as text. `aliases` names further columns where a source has its own."""
    low = {c.lower(): c for c in df.columns}
    names = {low[a.lower()]: want for want, others in aliases.items() if want not in df.columns for a in others[:] if a.lower() in low}
    first: dict[str, str] = {}
    for have, want in names.items():
        first.setdefault(want, have)
    df = df.withColumnsRenamed({have: want for want, have in first.items()})
    if missing := [c for c in ("effectiveStartDate", "effectiveEndDate") if c not in df.columns]:
        raise ValueError(f"missing type-2 columns: {', '.join(missing)}")
    df = df.withColumns({c: F.col(c).cast("date") for c in ("effectiveStartDate", "effectiveEndDate")})
    ended = F.when(F.col("effectiveEndDate").isNull() | (F.col("effectiveEndDate") == F.lit(open_end).cast("date")), "C").otherwise("H")
    if "recordStatus" not in df.columns:
        return df.withColumn("recordStatus", ended)
    kind = df.schema["recordStatus"].dataType.typeName()
    if kind in ("boolean", "integer", "long", "short", "byte", "double", "float"):
        n = F.col("recordStatus").cast("double")
        return df.withColumn("recordStatus", F.when(n == 1, "C").when(n == 0, "H").otherwise(F.col("recordStatus").cast("string")))
    return df


def mismatches(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of two copies that differ: kind (MISSING, EXTRA or CHANGED) and count. Rows are compared by a hash of all columns."""
    cols = sorted(c for c in source.columns if c != key)
    a = source.select(F.col(key), F.xxhash64(*cols).alias("hash_a"))
    b = target.select(F.col(key), F.xxhash64(*cols).alias("hash_b"))
    kind = F.when(F.col("hash_b").isNull(), "MISSING").when(F.col("hash_a").isNull(), "EXTRA").when(F.col("hash_a") != F.col("hash_b"), "CHANGED")
    return a.join(b, key, "full_outer").withColumn("kind", kind).filter("kind is not null").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
