"""Coarsening: each zoom is the mean of the four children one zoom up."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbgrid.functions.healpix import parent
from orbgrid.functions.scalars import nan_to_null


def coarsen(df: DataFrame, keys: list[str], values: list[str], ip: str = "healpix_index") -> DataFrame:
    """One zoom down: mean over the children present, missing if none is."""
    return df.groupBy(*keys, parent(ip).alias(ip)).agg(*[F.avg(v).alias(v) for v in values])


def coarsen_with(
    df: DataFrame, keys: list[str], value: str, reducer: Callable[[Column], Column], ip: str = "healpix_index"
) -> DataFrame:
    """One zoom down with another aggregate, such as ``F.max`` or ``F.median``."""
    return df.groupBy(*keys, parent(ip).alias(ip)).agg(reducer(F.col(value)).alias(value))


def coarsen_blocks(
    df: DataFrame,
    keys: list[str],
    value: str,
    reducer: Callable[[np.ndarray], np.ndarray],
    ip: str = "healpix_index",
) -> DataFrame:
    """One zoom down with a caller's NumPy reducer.

    ``reducer`` gets an array of shape (n, 4), the children in order with NaN
    where absent, and returns n numbers.  The children are lined up as columns
    by an ordinary aggregation, so Python sees whole Arrow batches of blocks
    instead of one group at a time.
    """
    child = F.col(ip).bitwiseAND(F.lit(3).cast("bigint"))
    wide = df.groupBy(*keys, parent(ip).alias(ip)).agg(
        *[F.max(F.when(child == k, F.col(value))).cast("double").alias(f"_c{k}") for k in range(4)]
    )

    @F.pandas_udf("double")
    def reduced(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(reducer(np.column_stack([a, b, c, d])))

    out = wide.withColumn(value, reduced("_c0", "_c1", "_c2", "_c3"))
    return out.select(*keys, ip, nan_to_null(F.col(value)).alias(value))


def pyramid(
    df: DataFrame,
    keys: list[str],
    values: list[str],
    top: int,
    bottom: int = 0,
    span: int = 5,
    cut: Callable[[DataFrame, int], DataFrame] | None = None,
    ip: str = "healpix_index",
) -> DataFrame:
    """All zooms from ``top`` to ``bottom`` in one table with a ``zoom`` column.

    Levels are chained, because a mean of means is not a flat mean when cells
    are missing.  Cells of one ancestor ``span`` zooms down are brought
    together once; the ``span`` aggregations below need no further shuffle.
    ``cut(level, zoom)`` may store a level and return it re-read, so that deep
    pyramids do not recompute the levels above.
    """
    level = df.select(*keys, F.col(ip).cast("bigint").alias(ip), *values)
    levels = [level.withColumn("zoom", F.lit(top))]
    for zoom in range(top - 1, bottom - 1, -1):
        done = top - 1 - zoom
        if cut is None and done % span == 0:
            depth = min(span, zoom - bottom + 1)
            tops = parent(ip, depth).alias("_top")
            level = level.select(*keys, ip, *values, tops).repartition(*keys, "_top")
        if cut is None:
            level = coarsen(level, [*keys, "_top"], values, ip)
        else:
            level = cut(coarsen(level, keys, values, ip), zoom)
        levels.append(level.select(*keys, ip, *values).withColumn("zoom", F.lit(zoom)))
    out = levels[0]
    for nxt in levels[1:]:
        out = out.unionByName(nxt)
    return out


def at_first_step(df: DataFrame, time: str = "time", by: list[str] | None = None) -> DataFrame:
    """Rows of the earliest time step (of each group in ``by``)."""
    by = by or []
    first = df.groupBy(*by).agg(F.min(time).alias(time))
    if not by:
        first = F.broadcast(first)  # exactly one row
    return df.join(first, [*by, time], "left_semi")


def coverage_weights(
    df: DataFrame, value: str, depth: int = 1, keys: list[str] | None = None, ip: str = "healpix_index"
) -> DataFrame:
    """Share of a cell that has data, ``depth`` zooms below a single time step.

    The first coarse zoom counts valid children over four.  Further zooms
    average the weights of the children that exist.
    """
    keys = keys or []
    out = df.groupBy(*keys, parent(ip).alias(ip)).agg((F.count(value) / F.lit(4.0)).alias("weights"))
    for _ in range(depth - 1):
        out = coarsen(out, keys, ["weights"], ip)
    return out
