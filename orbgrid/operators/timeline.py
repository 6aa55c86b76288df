"""Source times onto regular axes: snapping, shifting, trimming, gap checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orbgrid.functions.axes import TimeAxis, is_halfpast, shift_minutes
from orbgrid.operators.joins import attach, null_safe_join

_BLOCK = 4096


def shift_halfpast(
    df: DataFrame, field: list[str], time: str = "time", max_fields: int | None = None
) -> DataFrame:
    """Move half-past fields to the following full hour.

    A field counts as half-past when all its times are; such fields hold
    hourly means stamped at the middle of the hour.
    """
    flags = df.groupBy(*field).agg(F.bool_and(is_halfpast(time)).alias("halfpast"))
    marked = attach(df, flags, field, max_rows=max_fields, null_safe=True)
    return marked.withColumn(
        time, F.when(F.col("halfpast"), shift_minutes(time, 30)).otherwise(F.col(time))
    )


def settle_times(
    df: DataFrame, series: list[str], time: str = "time", full: int = 13, max_series: int | None = None
) -> DataFrame:
    """Trim and shift the times of source fields in one pass.

    The first of exactly ``full`` steps is dropped, and what remains moves to
    the full hour if all of it is stamped at half past.  Only the distinct
    steps of each series are looked at, and one small join applies the result.
    NULL is a series key like any other.
    """
    steps = df.select(*series, time).distinct()
    stats = steps.groupBy(*series).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(time).alias("_first"),
        F.count_if(is_halfpast(time)).alias("_half"),
    )
    surplus = F.col("_n") == full
    first_half = is_halfpast("_first").cast("int")
    kept = F.when(surplus, F.col("_n") - 1).otherwise(F.col("_n"))
    kept_half = F.when(surplus, F.col("_half") - first_half).otherwise(F.col("_half"))
    stats = stats.select(
        *series,
        F.when(surplus, F.col("_first")).alias("_drop"),
        F.when(kept == kept_half, 30).otherwise(0).alias("_shift"),
    )
    out = attach(df, stats, series, max_rows=max_series, row_bytes=256, null_safe=True)
    out = out.filter(F.col("_drop").isNull() | (F.col(time) != F.col("_drop")))
    moved = F.when(F.col("_shift") > 0, shift_minutes(time, 30)).otherwise(F.col(time))
    return out.withColumn(time, moved).drop("_drop", "_shift")


def snap_time(df: DataFrame, axis: TimeAxis, tolerance_minutes: float = 5.0, time: str = "time") -> DataFrame:
    """Nearest axis stamp by arithmetic; ``on_axis`` is strict in the tolerance."""
    idx = axis.nearest_index(time)
    snapped = df.withColumn("time_idx", idx).withColumn("snapped", axis.stamp_at("time_idx"))
    off = F.abs(F.timestamp_diff("MICROSECOND", F.col("snapped"), F.col(time)))
    return snapped.withColumn("on_axis", off < F.lit(int(tolerance_minutes * 60e6)))


def trim_first(df: DataFrame, series: list[str], time: str | list[str] = "time", full: int = 13) -> DataFrame:
    """Drop the first step of every series that has exactly ``full`` steps.

    Steps are ordered by ``time``, which may be several columns.
    """
    order = [time] if isinstance(time, str) else time
    steps = df.select(*series, *order).distinct()
    counts = steps.groupBy(*series).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == full)
    # Only series of that length are left, so few rows are compared.
    whole = null_safe_join(steps, counts.select(*series), series, "left_semi")
    first = whole.groupBy(*series).agg(F.min(F.struct(*order)).alias("_first")).select(*series, "_first.*")
    return null_safe_join(df, first, [*series, *order], "left_anti")


def trim_last(
    df: DataFrame, series: list[str], steps: DataFrame, time: str = "time", max_n: int | None = None
) -> DataFrame:
    """Keep the last ``n`` steps of every series; ``steps`` holds ``series..., n``.

    Only distinct steps are ranked, and no deeper than the largest ``n``
    (``max_n``, where it is known), so that long series are cut down
    before they are brought together.
    """
    latest = F.row_number().over(Window.partitionBy(*series).orderBy(F.col(time).desc()))
    ranked = df.select(*series, time).distinct().withColumn("_rn", latest)
    if max_n is not None:
        ranked = ranked.filter(F.col("_rn") <= int(max_n))
    kept = null_safe_join(ranked, steps.select(*series, "n"), series).filter(F.col("_rn") <= F.col("n"))
    cut = kept.groupBy(*series).agg(F.min(time).alias("_cut"))
    return null_safe_join(df, cut, series).filter(F.col(time) >= F.col("_cut")).drop("_cut")


def axis_gaps(
    df: DataFrame, series: list[str], axis: TimeAxis, time: str = "time", tolerance_minutes: float = 5.0
) -> DataFrame:
    """Steps not directly preceded by the step before: ``time_idx, prev_idx, n_missing``.

    Times that fit no stamp of the axis are no steps; a series with such has a
    row more, with their number in ``n_off_axis`` and no indices.

    The previous step is found within blocks of the axis, and across block
    edges from the last step of the block before, so the longest window is one
    block even for an endless series.
    """
    placed = snap_time(df.select(*series, F.col(time).alias("_time")).distinct(), axis, tolerance_minutes, "_time")
    off = placed.filter(~F.col("on_axis")).groupBy(*series).agg(F.count_distinct("_time").alias("n_off_axis"))
    steps = placed.filter("on_axis").select(*series, "time_idx").distinct()
    steps = steps.withColumn("_block", F.floor(F.col("time_idx") / F.lit(float(_BLOCK))).cast("bigint"))
    edges = steps.groupBy(*series, "_block").agg(F.max("time_idx").alias("_end"))
    edges = edges.withColumn(
        "_carry", F.lag("_end").over(Window.partitionBy(*series).orderBy("_block"))
    ).drop("_end")
    inside = F.lag("time_idx").over(Window.partitionBy(*series, "_block").orderBy("time_idx"))
    linked = null_safe_join(steps.withColumn("_prev", inside), edges, [*series, "_block"])
    linked = linked.withColumn("prev_idx", F.coalesce("_prev", "_carry"))
    gaps = linked.filter(F.col("time_idx") - F.col("prev_idx") > 1).select(
        *series,
        "time_idx",
        "prev_idx",
        (F.col("time_idx") - F.col("prev_idx") - 1).alias("n_missing"),
    )
    return gaps.unionByName(off, allowMissingColumns=True)


def nearest_level(df: DataFrame, level: str, wanted: float) -> DataFrame:
    """Rows on the level closest to ``wanted`` (the lower one on a tie)."""
    best = df.select(level).distinct().agg(
        F.min(F.struct(F.abs(F.col(level) - F.lit(wanted)), F.col(level).alias("pick"))).alias("m")
    ).select(F.col("m.pick").alias(level))
    return df.join(F.broadcast(best), level, "left_semi")  # exactly one row


def snapshot(df: DataFrame, index: int = 1, time: str = "time") -> DataFrame:
    """Rows of one time step, counted from 0 over the distinct steps; none where there are fewer steps."""
    steps = df.select(time).distinct().orderBy(time).limit(index + 1)
    pick = steps.agg(F.max(time).alias(time), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == index + 1).select(time)
    return df.join(F.broadcast(pick), time, "left_semi")  # exactly one row


def first_steps(df: DataFrame, n: int, time: str = "time") -> DataFrame:
    """Rows of the first ``n`` time steps."""
    steps = df.select(time).distinct().orderBy(time).limit(n)
    return df.join(F.broadcast(steps), time, "left_semi")  # n rows
