"""Re-keying facts through a key-map: old SK to new SK."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keymend.functions.dates import contains
from keymend.operators.keymap import AMBIGUOUS, MATCHED

UNKNOWN = -1


def rekey(fact: DataFrame, fks: Sequence[str], keymap: DataFrame, scd: int = 1, event_date: str | None = None,
          unknown: int = UNKNOWN, only_where: Column | None = None) -> DataFrame:
    """The fact with every FK in `fks` (roles of one dimension) mapped in one pass; what has no mapping goes to
    the unknown member. Mapped columns move to the end. Rows outside `only_where` keep their keys."""
    if scd == 2 and not event_date:
        raise ValueError("a type-2 re-key needs the event date")
    if scd == 1:
        usable = keymap.filter(F.col("map_status") == MATCHED).select("old_sk", "new_sk")
    else:
        usable = keymap.filter(F.col("map_status").isin(MATCHED, AMBIGUOUS)).select("old_sk", "new_sk", "valid_from", "valid_to")
    touch = F.lit(True) if only_where is None else F.coalesce(only_where, F.lit(False))
    out = fact if only_where is None else fact.withColumn("__touch", touch)
    flag = F.lit(True) if only_where is None else F.col("__touch")
    for j, fk in enumerate(fks):
        km = usable.select(*(F.col(c).alias(f"__{c}_{j}") for c in usable.columns))
        on = F.col(fk) == F.col(f"__old_sk_{j}")
        if scd == 2:
            on = on & contains(F.col(event_date), F.col(f"__valid_from_{j}"), F.col(f"__valid_to_{j}"))
        out = out.join(km, on & flag if only_where is not None else on, "left")
    kept = [F.col(c) for c in fact.columns if c not in fks]
    mapped = [F.when(flag, F.coalesce(F.col(f"__new_sk_{j}"), F.lit(unknown))).otherwise(F.col(fk)).alias(fk)
              if only_where is not None else F.coalesce(F.col(f"__new_sk_{j}"), F.lit(unknown)).alias(fk) for j, fk in enumerate(fks)]
    return out.select(*kept, *mapped)


def rekey_dimensions(fact: DataFrame, maps: Sequence[tuple[Sequence[str], DataFrame, int, str | None]],
                     unknown: int = UNKNOWN, only_where: Column | None = None) -> DataFrame:
    """Re-key through several dimensions' key-maps in one rebuild: (fks, key-map, scd, event date) each."""
    return reduce(lambda f, m: rekey(f, m[0], m[1], m[2], m[3], unknown, only_where), maps, fact)


def lookup_incremental(rows: DataFrame, nks: Sequence[str], dim: DataFrame, sk: str, dim_nks: Sequence[str], fk: str,
                       unknown: int = UNKNOWN) -> DataFrame:
    """New fact rows with their FK found by natural key; misses go to the unknown member."""
    from keymend.functions.keys import natural_key

    d = dim.select(F.col(sk).alias("__sk"), natural_key(dim_nks).alias("__nk"))
    out = rows.withColumn("__key", natural_key(nks)).join(d, F.col("__key") == F.col("__nk"), "left")
    return out.withColumn(fk, F.coalesce("__sk", F.lit(unknown))).drop("__sk", "__nk", "__key")
