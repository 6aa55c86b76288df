"""Data-quality checks; each is a small report table that a caller may enforce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orbgrid.functions.axes import TimeAxis
from orbgrid.functions.healpix import every_cell
from orbgrid.functions.scalars import is_close
from orbgrid.operators.joins import attach

# Plausible ranges (lower, upper) and tolerance of the range
# check, the limit on missing cells of global data, and the zoom down to
# which regional data is not expected to be valid.
VALUE_RANGES: dict[str, tuple[float | None, float | None]] = {
    "tas": (150.0, 400.0),
    "pr": (0.0, None),
    "rlut": (0.0, None),
    "clw": (0.0, None),
}
RANGE_TOLERANCE = 1e-10
MAX_MISSING_GLOBAL = 0.50
REGIONAL_MIN_ZOOM = 2
NOT_CHECKED = ("weights",)
ONLY_ALL_MISSING = ("mrsol",)


def spine(spark: SparkSession, axis: TimeAxis, zoom: int, levels: Sequence[float] | None = None) -> DataFrame:
    """Every step, level and cell a dataset should have; generated, not stored."""
    out = axis.to_df(spark).select("time")
    if levels is not None:
        out = out.withColumn("level", F.explode(F.array(*[F.lit(float(x)) for x in levels])))
    return every_cell(out, zoom)


def missing_fraction(df: DataFrame, keys: list[str], value: str, expected: Column | int) -> DataFrame:
    """Share of expected values that are absent or missing.

    The expected count is arithmetic (steps x levels x cells), so the full
    grid of cells is not built.
    """
    expected = F.lit(expected) if isinstance(expected, int) else expected
    out = df.groupBy(*keys).agg(F.count(value).alias("n_valid"))
    out = out.withColumn("n_expected", expected.cast("bigint"))
    return out.withColumn("missing_fraction", 1 - F.col("n_valid") / F.col("n_expected"))


def missing_flags(df: DataFrame, keys: list[str], value: str, expected: Column | int) -> DataFrame:
    out = missing_fraction(df, keys, value, expected)
    return out.select(
        *keys,
        (F.col("n_valid") == 0).alias("all_missing"),
        (F.col("n_valid") < F.col("n_expected")).alias("any_missing"),
    )


def missing_rules(fractions: DataFrame, regional: bool = False) -> DataFrame:
    """Apply the limits to ``variable, missing_fraction`` rows: ``failure`` or NULL."""
    f = F.col("missing_fraction")
    checked = fractions.filter(~F.col("variable").isin(*NOT_CHECKED))
    failure = F.when(f >= 1.0, "all missing")
    if not regional:
        over = (f >= MAX_MISSING_GLOBAL) & ~F.col("variable").isin(*ONLY_ALL_MISSING)
        failure = failure.when(over, "too many missing")
    return checked.withColumn("failure", failure)


def range_checks(
    df: DataFrame,
    keys: list[str],
    value: str,
    ranges: dict[str, tuple[float | None, float | None]] = VALUE_RANGES,
    tolerance: float = RANGE_TOLERANCE,
) -> DataFrame:
    """Extremes of every ranged variable against its limits."""
    rules = df.sparkSession.createDataFrame(
        [(k, lo, hi) for k, (lo, hi) in ranges.items()], "variable string, lower double, upper double"
    )
    ends = df.groupBy(*keys, "variable").agg(F.min(value).alias("vmin"), F.max(value).alias("vmax"))
    out = attach(ends, rules, ["variable"], max_rows=len(ranges)).filter(F.col("vmin").isNotNull())
    low = F.coalesce(F.col("vmin") < F.col("lower") - tolerance, F.lit(False))
    high = F.coalesce(F.col("vmax") > F.col("upper") + tolerance, F.lit(False))
    return out.select(*keys, "variable", "vmin", "vmax", low.alias("below"), high.alias("above"))


def registry_diff(available: DataFrame, registered: DataFrame, key: str, suffix: str | None = None) -> DataFrame:
    """Registered datasets that are absent, and present ones not registered."""
    a, r = available.select(key).distinct(), registered.select(key).distinct()
    absent = r.join(a, key, "left_anti").withColumn("problem", F.lit("absent"))
    extra = a.filter(F.col(key).endswith(suffix)) if suffix else a
    extra = extra.join(r, key, "left_anti").withColumn("problem", F.lit("unregistered"))
    return absent.union(extra)


def dataset_shape(df: DataFrame, keys: list[str], time: str = "time", ip: str = "healpix_index") -> DataFrame:
    """Steps and cells of every dataset, and whether it can be opened at all."""
    out = df.groupBy(*keys).agg(
        F.count_distinct(time).alias("n_times"), F.count_distinct(ip).alias("n_cells")
    )
    return out.withColumn("ok", (F.col("n_times") >= 1) & (F.col("n_cells") > 0))


def inner_series_missing(
    df: DataFrame, keys: list[str], value: str, n_cells: int, over: list[str], time: str = "time"
) -> DataFrame:
    """Missing share of a series without its first and last step; NULL where there are no others.

    The axis of a series is the distinct steps of its ``over`` group (a subset
    of ``keys``, such as the dataset).
    """
    steps = df.groupBy(*over).agg(
        F.min(time).alias("_t0"), F.max(time).alias("_t1"), F.count_distinct(time).alias("_nt")
    )
    inner = (F.col(time) > F.col("_t0")) & (F.col(time) < F.col("_t1"))
    out = df.join(steps, over).groupBy(*keys).agg(
        F.count(F.when(inner, F.col(value))).alias("n_valid"), F.max("_nt").alias("_nt")
    )
    n = (F.col("_nt") - 2) * n_cells
    return out.select(*keys, "n_valid", (1 - F.try_divide(F.col("n_valid").cast("double"), n)).alias("missing_fraction"))


def store_checks(
    cells: DataFrame,
    regional: bool = False,
    ranges: dict[str, tuple[float | None, float | None]] = VALUE_RANGES,
    registered: DataFrame | None = None,
) -> DataFrame:
    """All checks of stored cells: one row per dataset, variable and check, with ``ok``.

    ``loads``: the dataset has a second step; ``missing``: the share of missing
    cells in that step keeps the rules; ``range``: all values lie within the
    variable's limits; ``series`` (zoom 0 only): no cell is missing between the
    first and the last step.  With ``registered`` (sim, freq, zoom, variable),
    ``present``: a registered variable has cells; one without them has this row
    alone.  Cells are aggregated once.
    """
    by = ["sim", "freq", "zoom"]
    steps = cells.select(*by, "time").distinct()
    nth = F.row_number().over(Window.partitionBy(*by).orderBy("time"))
    second = steps.withColumn("_k", nth).filter(F.col("_k") <= 2).groupBy(*by).agg(
        F.max("time").alias("_second"), F.count(F.lit(1)).alias("_n")
    )
    ends = steps.groupBy(*by).agg(F.min("time").alias("_t0"), F.max("time").alias("_t1"), F.count(F.lit(1)).alias("_nt"))
    at_second = F.col("time") == F.col("_second")
    inner = (F.col("time") > F.col("_t0")) & (F.col("time") < F.col("_t1"))
    depth = F.coalesce("level", F.lit(0.0))
    stats = cells.join(second.join(ends, by), by).groupBy(*by, "variable").agg(
        F.max("_n").alias("n_steps"),
        F.max("_nt").alias("_nt"),
        F.count(F.when(at_second, F.col("value"))).alias("n_valid"),
        F.count(F.when(inner, F.col("value"))).alias("n_inner"),
        F.greatest(F.count_distinct(depth), F.lit(1)).alias("n_levels"),
        F.min("value").alias("vmin"),
        F.max("value").alias("vmax"),
    )
    n_cells = F.col("n_levels") * F.call_function("shiftleft", F.lit(12).cast("bigint"), 2 * F.col("zoom"))
    stats = stats.withColumn("missing_fraction", 1 - F.col("n_valid") / n_cells)
    ruled = missing_rules(stats, regional)
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (lo, hi) in ranges.items():
        low = F.when(F.col("variable") == name, F.lit(lo).cast("double")).otherwise(low)
        high = F.when(F.col("variable") == name, F.lit(hi).cast("double")).otherwise(high)
    within = F.coalesce(F.col("vmin") >= low - RANGE_TOLERANCE, F.lit(True)) & F.coalesce(
        F.col("vmax") <= high + RANGE_TOLERANCE, F.lit(True)
    )
    series = F.when(F.col("zoom") == 0, F.col("n_inner") == F.greatest(F.col("_nt") - 2, F.lit(0)) * n_cells)
    checks = {"loads": F.col("n_steps") >= 2, "missing": F.col("failure").isNull(), "range": within, "series": series}
    if registered is not None:
        wanted = registered.select(*by, "variable").distinct().withColumn("_wanted", F.lit(True))
        ruled = ruled.join(wanted, [*by, "variable"], "full")
        there = F.col("n_steps").isNotNull()
        checks = {k: F.when(there, v) for k, v in checks.items()} | {"present": F.when(F.col("_wanted"), there)}
    pairs = F.array(*[F.struct(F.lit(k).alias("check"), v.alias("ok")) for k, v in checks.items()])
    return ruled.select(*by, "variable", F.inline(pairs)).filter(F.col("ok").isNotNull())


class QualityError(ValueError):
    pass


def require_some_values(df: DataFrame, keys: list[str], value: str) -> None:
    """Refuse to write variables that are missing everywhere."""
    empty = df.groupBy(*keys).agg(F.count(value).alias("n")).filter(F.col("n") == 0).drop("n")
    found = empty.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*keys)).alias("first")).first()
    if found.n:
        raise QualityError(f"all values missing in {found.n} groups, the first of them {tuple(found.first)}")


def absent_weights(needed: DataFrame, present: DataFrame, key: str = "grid_key") -> DataFrame:
    """Grids without stored weights; must be empty before static fields are regridded."""
    return needed.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")


def compare_runs(
    a: DataFrame, b: DataFrame, keys: list[str], value: str, rtol: float = 1e-5, atol: float = 1e-8
) -> DataFrame:
    """Rows on which two results differ, one-sided rows included."""
    left = a.select(*keys, F.col(value).alias("a"), F.lit(True).alias("_in_a"))
    right = b.select(*keys, F.col(value).alias("b"), F.lit(True).alias("_in_b"))
    both = left.join(right, keys, "full_outer")
    return both.filter(~is_close(F.col("a"), F.col("b"), rtol, atol)).drop("_in_a", "_in_b")
