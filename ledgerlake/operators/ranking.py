"""Top-n per group and first-row-per-key.

Both are ``row_number`` over a window followed by a bound on the number.
Catalyst plans that as ``WindowGroupLimit``: a *partial* limit runs in every
map task before the exchange, so a hot key ships at most ``n`` rows per map
task instead of all its rows, and the final limit runs after the shuffle.
Ties are broken by the order list only; callers pass enough keys to make it
total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _cols(items: Sequence[ColumnOrName]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in items]


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[ColumnOrName],
    order: Sequence[Column],
    n: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Keep the first ``n`` rows of every ``keys`` group by ``order``.

    Adds ``rank_col`` (a row number: ties get different numbers).
    """
    if n < 1:
        raise ValueError(f"n must be >= 1, got {n}")
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def first_per_key(df: DataFrame, keys: Sequence[ColumnOrName], order: Sequence[Column]) -> DataFrame:
    """One row per ``keys`` value: the first by ``order``; columns unchanged."""
    tmp = "__first_rn"
    return top_n_per_group(df, keys, order, 1, tmp).drop(tmp)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """A bounded preview of a result (the caller shows or collects it)."""
    return df.limit(n)
