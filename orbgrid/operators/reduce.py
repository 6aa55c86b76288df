"""Reductions over cells, time and levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbgrid.functions.scalars import order_bits
from orbgrid.operators.joins import attach
from orbgrid.session import lineage_cutter


def domain_mean(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Mean over cells; cells of a zoom have equal area, so it is unweighted."""
    return df.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


def weighted_domain_mean(df: DataFrame, keys: list[str], values: list[str], weight: str = "weights") -> DataFrame:
    """Mean over cells by coverage weight, over cells that have a value; NULL where the weights sum to 0."""
    w = F.col(weight)
    return df.groupBy(*keys).agg(
        *[
            F.try_divide(F.sum(F.col(v) * w), F.sum(F.when(F.col(v).isNotNull(), w))).alias(v)
            for v in values
        ]
    )


def zonal_mean(
    df: DataFrame,
    keys: list[str],
    value: str,
    cell: list[str],
    lat: str = "lat",
    bins: int = 1800,
) -> DataFrame:
    """Mean over time per cell, then over the cells of each latitude bin.

    Bins are equal and closed on the right; ``lat_mid`` is the bin middle.
    """
    width = 180.0 / bins
    per_cell = df.groupBy(*keys, *cell, lat).agg(F.avg(value).alias(value))
    edge = F.round((F.col(lat) + 90.0) / F.lit(width), 9)
    per_cell = per_cell.withColumn("lat_bin", F.ceil(edge).cast("int")).filter(F.col("lat_bin") >= 1)
    out = per_cell.groupBy(*keys, "lat_bin").agg(F.avg(value).alias(value))
    return out.withColumn("lat_mid", (F.col("lat_bin") - 0.5) * F.lit(width) - 90.0)


def vertical_profile(df: DataFrame, keys: list[str], level: str, values: list[str]) -> DataFrame:
    return df.groupBy(*keys, level).agg(*[F.avg(v).alias(v) for v in values])


def field_extent(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("vmin"), F.max(value).alias("vmax"))


def exact_quantiles(
    df: DataFrame,
    group: list[str],
    value: str,
    probs: Sequence[float],
    bins: int = 4096,
    window: int = 1_000_000,
    max_groups: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation: ``group..., prob, quantile``.

    Radix selection: values are ordered as their 64-bit keys (``order_bits``),
    and each wanted rank fixes the bits of its key from the top, those of
    ``bins`` (a power of two) in a round, until no prefix holds more than
    ``window`` distinct values.  With 4096 bins that takes six rounds at most,
    however the values are spread, and none where groups are small.  Equal
    values are merged first and counts combine map-side: the last step sees
    ``window`` rows at most.  ``max_groups`` bounds the number of groups, if
    it is known.

    Infinities are values; between one and a number lies the infinity.  NaN
    orders above all.  Null values are left out, null groups kept.
    """
    if bins < 2 or bins & (bins - 1):
        raise ValueError("bins must be a power of two")
    cut = lineage_cutter(df.sparkSession)  # every round reads the merged values again
    x = F.col(value).cast("double")
    counted = cut(
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, (x + F.lit(0.0)).alias("_x"))  # -0 becomes 0
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_key", order_bits("_x"))
    )
    ends = counted.groupBy(*group).agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d"))
    at = F.col("prob") * (F.col("_n") - 1)
    ranks = (
        ends.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumns({"_k": F.floor(at).cast("bigint"), "_frac": at - F.floor(at)})
        .withColumn("_r", F.explode(F.array_distinct(F.array("_k", F.least(F.col("_k") + 1, F.col("_n") - 1)))))
        .select(*group, "prob", "_k", "_frac", "_r", F.lit(0).cast("bigint").alias("_below"), F.lit(0).cast("bigint").alias("_prefix"), "_d")
    )
    ranks = cut(ranks)
    target = [*group, "prob", "_r"]
    max_ranks = None if max_groups is None else 2 * len(probs) * max_groups
    open_bits, width = 64, bins.bit_length() - 1

    def within() -> DataFrame:
        """Values that share the fixed bits of each rank."""
        met = attach(counted, ranks.drop("_d"), group, max_rows=max_ranks, null_safe=True)
        # A shift by 64 bits would be none.
        return met if open_bits == 64 else met.filter(F.shiftright("_key", open_bits) == F.col("_prefix"))

    while open_bits and (ranks.agg(F.max("_d")).first()[0] or 0) > window:
        found, open_bits = within(), max(0, open_bits - width)
        hist = found.groupBy(*target, "_k", "_frac", "_below", F.shiftright("_key", open_bits).alias("_bin")).agg(
            F.sum("_c").alias("_c"), F.count(F.lit(1)).alias("_d")
        )
        upto = F.sum("_c").over(Window.partitionBy(*target).orderBy("_bin"))
        ranks = cut(
            hist.withColumn("_upto", F.col("_below") + upto)
            .filter((F.col("_upto") > F.col("_r")) & (F.col("_upto") - F.col("_c") <= F.col("_r")))
            .select(*group, "prob", "_k", "_frac", "_r", (F.col("_upto") - F.col("_c")).alias("_below"), F.col("_bin").alias("_prefix"), "_d")
        )
    upto = F.col("_below") + F.sum("_c").over(Window.partitionBy(*target).orderBy("_key"))
    picked = within().withColumn("_upto", upto).filter(
        (F.col("_upto") > F.col("_r")) & (F.col("_upto") - F.col("_c") <= F.col("_r"))
    )
    low = F.max(F.when(F.col("_r") == F.col("_k"), F.col("_x")))
    high = F.max(F.when(F.col("_r") > F.col("_k"), F.col("_x")))
    frac = F.max("_frac")
    between = F.when(low == high, low).when(low == float("-inf"), low).otherwise(low + (high - low) * frac)
    return picked.groupBy(*group, "prob").agg(F.when(frac > 0, between).otherwise(low).alias("quantile"))


def robust_range(df: DataFrame, group: list[str], value: str, max_groups: int | None = None) -> DataFrame:
    """Symmetric display range of fields that lie around zero.

    ``vmax`` is the larger magnitude of the 2nd and 98th percentile; fields
    that do not lie around zero, constant ones among them, get no range.
    """
    ends = field_extent(df, group, value)
    diverging = F.try_divide(F.abs(F.col("vmax") + F.col("vmin")), F.col("vmax") - F.col("vmin")) < 0.5
    ends = ends.select(*group, F.coalesce(diverging, F.lit(False)).alias("diverging"))
    bound = exact_quantiles(df, group, value, (0.02, 0.98), max_groups=max_groups).groupBy(*group).agg(
        F.max(F.abs("quantile")).alias("_b")
    )
    out = ends.join(bound, group, "left")
    limit = F.when(F.col("diverging"), F.col("_b"))
    return out.select(*group, "diverging", (-limit).alias("vmin"), limit.alias("vmax"))
