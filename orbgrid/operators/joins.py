"""Joining big tables with small ones, without betting on the small side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20


def fits_broadcast(rows: int, row_bytes: int = 64) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def null_safe_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key meets a NULL key; keys come from ``big``."""
    there = small.select(
        *[F.col(c).alias(f"_on{k}") for k, c in enumerate(on)], *[c for c in small.columns if c not in on]
    )
    meet = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on{k}")) for k, c in enumerate(on)])
    return big.join(there, meet, how).drop(*[f"_on{k}" for k in range(len(on))])


def attach(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int | None = None,
    row_bytes: int = 64,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join ``big`` with ``small``.

    ``max_rows`` is a bound on ``small`` that follows from arithmetic (cells of
    a zoom, levels of an axis, rows of a configuration).  Within the limit the
    side is broadcast; without a bound the join is left to adaptive execution,
    which broadcasts on measured size and splits hot keys otherwise.  With
    ``null_safe`` NULL keys meet each other.
    """
    if max_rows is not None and fits_broadcast(max_rows, row_bytes):
        if null_safe:
            return null_safe_join(big, small.hint("broadcast"), on, how)
        small = F.broadcast(small)
    if null_safe:
        return null_safe_join(big, small, on, how)
    return big.join(small, on, how)
