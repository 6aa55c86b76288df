"""Vertical interpolation of irregular columns onto target levels.

Linear between neighbouring levels and extended linearly past both ends, for
any number of variables that share the vertical coordinate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orbgrid.functions.scalars import clamp_negative


def _targets_below(x: Column, targets: Sequence[float]) -> Column:
    """How many targets are less than ``x``."""
    return reduce(
        lambda a, b: a + b, [F.when(x > F.lit(float(t)), 1).otherwise(0) for t in targets], F.lit(0)
    )


def thin_columns(points: DataFrame, keys: list[str], p: str, values: list[str], targets: Sequence[float]) -> DataFrame:
    """The levels of each column that interpolation can use, by aggregation.

    Between two targets only the lowest and the highest level matter, and at
    each end the outermost two.  Minimum and maximum combine map-side, so a
    column of any length never meets in one task.
    """
    row = F.struct(p, *values)
    gaps = (
        points.groupBy(*keys, _targets_below(F.col(p), targets).alias("_gap"))
        .agg(F.min(row).alias("a"), F.max(row).alias("b"))
        .select(*keys, F.inline(F.array("a", "b")))
    )
    ends = points.groupBy(*keys).agg(F.min(p).alias("_lo"), F.max(p).alias("_hi"))
    second = (
        points.join(ends, keys)
        .groupBy(*keys)
        .agg(
            F.min(F.when(F.col(p) > F.col("_lo"), row)).alias("a"),
            F.max(F.when(F.col(p) < F.col("_hi"), row)).alias("b"),
        )
        .select(*keys, F.inline(F.array("a", "b")))
        .filter(F.col(p).isNotNull())
    )
    return gaps.union(second).dropDuplicates([*keys, p])


def interpolate_levels(
    points: DataFrame,
    keys: list[str],
    p: str,
    values: list[str],
    targets: Sequence[float],
    level: str = "level",
    clamp: bool = True,
    long_column: int | None = None,
) -> DataFrame:
    """Values at ``targets`` for every column with at least two levels.

    ``points`` holds one row per column (``keys``) and distinct ``p``.  Columns
    are ordered in place, as model columns are short.  Where columns have no
    bound, ``long_column`` asks for those with more levels to be thinned
    first (``thin_columns``), with the same result.
    """
    targets = sorted(float(t) for t in targets)
    points = points.select(*keys, p, *values).filter(F.col(p).isNotNull())
    if long_column is not None:
        long_keys = (
            points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > long_column).select(*keys)
        )
        # Few by construction: each stands for more than long_column rows.
        thinned = thin_columns(points.join(long_keys, keys, "left_semi"), keys, p, values, targets)
        points = points.join(long_keys, keys, "left_anti").union(thinned)

    # Targets below each level are counted once, ahead of the ordering.
    points = points.withColumn("_below", _targets_below(F.col(p), targets))
    w = Window.partitionBy(*keys).orderBy(p)
    ahead = {f"_{v}2": F.lead(v).over(w) for v in values}
    segments = points.withColumns(
        {
            "_p2": F.lead(p).over(w),
            "_below2": F.lead("_below").over(w),
            "_first": F.lag(p).over(w).isNull(),
            "_last": F.lead(p, 2).over(w).isNull(),
            **ahead,
        }
    ).filter(F.col("_p2").isNotNull())

    # Targets in [p, p2); the outer segments also take everything beyond.
    first = F.when(F.col("_first"), F.lit(0)).otherwise(F.col("_below"))
    stop = F.when(F.col("_last"), F.lit(len(targets))).otherwise(F.col("_below2"))
    hit = segments.withColumns({"_from": first, "_to": stop - 1}).filter(F.col("_from") <= F.col("_to"))
    hit = hit.withColumn("_k", F.explode(F.sequence("_from", "_to"))).withColumn(
        "_t", F.element_at(F.array(*[F.lit(t) for t in targets]), F.col("_k") + 1)
    )

    def at_target(v: str) -> Column:
        rise = (F.col(f"_{v}2") - F.col(v)) / (F.col("_p2") - F.col(p))
        y = F.col(v) + (F.col("_t") - F.col(p)) * rise
        return clamp_negative(y) if clamp else y

    return hit.select(*keys, F.col("_t").alias(level), *[at_target(v).alias(v) for v in values])


def times_differ(a: DataFrame, b: DataFrame, time: str = "time") -> DataFrame:
    """Times present on one side only; must be empty before interpolating."""
    ta, tb = a.select(time).distinct(), b.select(time).distinct()
    only_a = ta.join(tb, time, "left_anti").withColumn("missing_in", F.lit("pressure"))
    only_b = tb.join(ta, time, "left_anti").withColumn("missing_in", F.lit("values"))
    return only_a.union(only_b)
