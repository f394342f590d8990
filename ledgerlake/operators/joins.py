"""Size-checked broadcast for dimension joins.

A broadcast join ships the small side to every executor and leaves the big
side where it is — far cheaper than shuffling a 100 TB fact table — but only
while the small side really is small.  ``measured_bytes`` computes the exact
in-memory (UnsafeRow) size of a DataFrame with one aggregate over it;
``broadcast_if_small`` broadcasts it only when that size is within a limit,
and otherwise returns it unchanged, leaving Spark to plan a sort-merge join
(whose skewed partitions AQE splits).  ``salted_left_join`` is the explicit
alternative for that case when AQE's skew handling is off: every key is
spread over ``buckets`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# An UnsafeRow holds a null bitmap (one 8-byte word per 64 fields), one 8-byte
# slot per field, and variable-length values padded to 8 bytes.
_WORD = 8


def _padded(length: Column) -> Column:
    return F.ceil(F.coalesce(length, F.lit(0)) / _WORD) * _WORD


def measured_bytes(df: DataFrame) -> int:
    """Exact UnsafeRow bytes of ``df`` (one distributed aggregate, one number back)."""
    fields = df.schema.fields
    fixed = _WORD * ((len(fields) + 63) // 64) + _WORD * len(fields)
    variable = [
        _padded(F.octet_length(F.col(f.name)))
        for f in fields
        if isinstance(f.dataType, (StringType, BinaryType))
    ]
    row = F.lit(fixed)
    for v in variable:
        row = row + v
    total = df.agg(F.sum(row.cast("long"))).first()[0]
    return int(total or 0)


def broadcast_if_small(df: DataFrame, max_bytes: int) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when ``df`` measures ≤ ``max_bytes``, else ``(df, False)``."""
    if max_bytes <= 0:
        return df, False
    if measured_bytes(df) <= max_bytes:
        return F.broadcast(df), True
    return df, False


def salted_left_join(
    big: DataFrame, small: DataFrame, key: str, buckets: int, salt_of: list[str]
) -> DataFrame:
    """``big ⟕ small`` on ``key`` with every key spread over ``buckets`` tasks.

    Each ``big`` row gets a salt from a hash of its own ``salt_of`` columns —
    deterministic, so a retried task routes every row the same way — and
    ``small`` is replicated once per salt value.  A key holding a third of
    ``big`` then lands in ``buckets`` partitions instead of one, for the price
    of ``buckets`` copies of the (unique-per-key) small side.
    """
    if buckets < 2:
        return big.join(small, on=key, how="left")
    salt = "__salt"
    big_s = big.withColumn(salt, F.pmod(F.xxhash64(*[F.col(c) for c in salt_of]), F.lit(buckets)))
    small_s = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)).cast("array<bigint>")))
    return big_s.join(small_s, on=[key, salt], how="left").drop(salt)
