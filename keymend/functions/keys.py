"""Natural keys: normalisation, equality, hashing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stands for a null part of a key, and separates the parts.
NULL_PART, SEPARATOR = "~NULL~", "||"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalized(c: str | Column) -> Column:
    """One key part as trimmed upper-case text (spaces only are trimmed); null becomes a marker."""
    return F.coalesce(F.upper(F.trim(_col(c).cast("string"))), F.lit(NULL_PART))


def natural_key(cols: Sequence[str | Column]) -> Column:
    """Normalised parts joined into one string. Values that hold the separator or the marker can collide."""
    return F.concat_ws(SEPARATOR, *map(normalized, cols))


def raw_key(cols: Sequence[str | Column]) -> Column:
    """The report's key: plain text of one column, or parts joined by '|' where null parts vanish."""
    if len(cols) == 1:
        return _col(cols[0]).cast("string")
    return F.concat_ws("|", *(_col(c).cast("string") for c in cols))


def business_key_equal(left: Sequence[str | Column], right: Sequence[str | Column]) -> Column:
    """Part-wise equality of two keys, nulls equal to nulls; Spark extracts the parts as join keys."""
    if len(left) != len(right):
        raise ValueError(f"business keys differ in length: {len(left)} and {len(right)}")
    return reduce(lambda a, b: a & b, (normalized(x) == normalized(y) for x, y in zip(left, right, strict=True)))


def deterministic_key(cols: Sequence[str | Column]) -> Column:
    """A surrogate key that any reload reproduces: 64-bit hash of the natural key."""
    return F.xxhash64(natural_key(cols))
