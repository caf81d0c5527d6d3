"""Checks of rebuilt tables: counts, referential integrity, reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = -1


def row_counts(source: DataFrame, fixed: DataFrame) -> DataFrame:
    """One row: rows of both tables and whether they are as many."""
    a = source.agg(F.count(F.lit(1)).alias("source_rows"))
    b = fixed.agg(F.count(F.lit(1)).alias("fixed_rows"))
    return a.join(b).withColumn("equal", F.col("source_rows") == F.col("fixed_rows"))  # one row on either side


def key_counts(fact: DataFrame, fks: Sequence[str], unknown: int = UNKNOWN) -> DataFrame:
    """Rows, and for each FK the rows on the unknown member and those without a key, in one scan."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for fk in fks:
        aggs += [F.count(F.when(F.col(fk) == unknown, 1)).alias(f"unknown_{fk}"), F.count(F.when(F.col(fk).isNull(), 1)).alias(f"null_{fk}")]
    return fact.agg(*aggs)


def orphans(fact: DataFrame, fk: str, dim: DataFrame, sk: str, unknown: int = UNKNOWN) -> DataFrame:
    """Fact rows whose FK is in no dimension row; unknown and null keys are not looked at."""
    return fact.filter(F.col(fk) != unknown).join(dim.select(F.col(sk).alias("__sk")), F.col(fk) == F.col("__sk"), "left_anti")


def orphan_matrix(fact: DataFrame, keys: Sequence[tuple[str, DataFrame, str]], unknown: int = UNKNOWN) -> DataFrame:
    """Orphan rows for each (fk, dimension, sk)."""
    return reduce(DataFrame.unionByName, (
        orphans(fact, fk, dim, sk, unknown).agg(F.count(F.lit(1)).alias("orphan_rows")).withColumn("fk_column", F.lit(fk))
        for fk, dim, sk in keys))


def gate(source: DataFrame, fixed: DataFrame, fk: str, dim: DataFrame, sk: str, name: str, unknown: int = UNKNOWN) -> DataFrame:
    """One row: whether a rebuilt fact has the source's row count and no orphan."""
    counts = row_counts(source, fixed)
    bad = orphans(fixed, fk, dim, sk, unknown).agg(F.count(F.lit(1)).alias("orphan_rows"))
    return counts.join(bad).select(F.lit(name).alias("fact"), "source_rows", "fixed_rows", "orphan_rows",
                                   F.when(F.col("equal") & (F.col("orphan_rows") == 0), "PASS").otherwise("FAIL").alias("status"))


def _total(c: str | Column) -> Column:
    """Exact sum of amounts with two decimals."""
    return F.sum((F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)"))


def reconcile(legacy: DataFrame, fixed: DataFrame, by: str, amount: str, tolerance: float | None = 0.01) -> DataFrame:
    """Sums by a key or a day on both sides that differ by over `tolerance` (all with None)."""
    a = legacy.groupBy(by).agg(_total(amount).alias("legacy_total"))
    b = fixed.groupBy(by).agg(_total(amount).alias("fixed_total"))
    zero = F.lit(0).cast("decimal(18,2)")
    diff = F.coalesce("legacy_total", zero) - F.coalesce("fixed_total", zero)
    out = a.join(b, by, "full_outer").select(by, *(F.col(c).cast("double").alias(c) for c in ("legacy_total", "fixed_total")),
                                              diff.cast("double").alias("diff"))
    return out if tolerance is None else out.filter(F.abs("diff") > tolerance)


def by_difference(reconciled: DataFrame) -> DataFrame:
    """reconcile()'s rows, the largest differences first."""
    return reconciled.orderBy(F.abs("diff").desc_nulls_last(), reconciled.columns[0])


def outside_window(fact: DataFrame, fk: str, event_date: str, dim: DataFrame, sk: str, start: str, end: str) -> DataFrame:
    """Fact rows whose event lies outside their version's validity."""
    d = dim.select(F.col(sk).alias("__sk"), F.col(start).alias("__from"), F.col(end).alias("__to"))
    joined = fact.join(d, F.col(fk) == F.col("__sk"))
    return joined.filter((F.col(event_date) < F.col("__from")) | (F.col(event_date) >= F.col("__to"))).drop("__sk", "__from", "__to")


class Checks:
    """Collects named checks; with fail_fast the first failure raises."""

    def __init__(self, fail_fast: bool = False):
        self.fail_fast, self.rows = fail_fast, []

    def add(self, test_id: str, name: str, passed: bool, detail: str = "") -> bool:
        self.rows.append((test_id, name, "PASS" if passed else "FAIL", detail))
        if self.fail_fast and not passed:
            raise AssertionError(f"{test_id} {name}: {detail}")
        return passed

    def frame(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rows, "test_id string, test_name string, status string, detail string")
