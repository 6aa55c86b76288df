"""Interpolation weights from a rectilinear grid to HEALPix cells.

The source points form rows and columns, so the triangle around a target is
known in closed form: take the fractional index on each axis, cut the grid
cell along its rising diagonal, and use barycentric weights.  Weights are
non-negative, sum to one and are exact for fields linear in (lon, lat).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.functions.axes import LatLonGrid
from orbgrid.functions.healpix import npix, unwrap_lon, with_lonlat
from orbgrid.operators.cover import Extent, cells_of, cover


def inside_extent(df: DataFrame, extent: tuple[float, float, float, float], lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Rows strictly inside (west, east, south, north); east may pass 360."""
    west, east, south, north = extent
    x = unwrap_lon(lon, east)
    return df.withColumn(lon, x).filter(
        (F.col(lon) > west) & (F.col(lon) < east) & (F.col(lat) > south) & (F.col(lat) < north)
    )


def in_extent(cells: DataFrame, extent: Extent, zoom: int) -> DataFrame:
    return inside_extent(with_lonlat(cells, zoom), extent)


def target_cells_in(spark: SparkSession, extent: Extent, zoom: int) -> DataFrame:
    """Cells with their centres inside an extent, by way of its cover."""
    return in_extent(cells_of(spark, cover(extent, zoom).ranges), extent, zoom)


def target_cells(spark: SparkSession, zoom: int, grid: LatLonGrid | None = None) -> DataFrame:
    """Cell centres of a zoom; for a regional grid only those inside it."""
    if grid is not None and grid.regional:
        return target_cells_in(spark, tuple(map(float, grid.extent)), zoom)
    return with_lonlat(spark.range(npix(zoom)).withColumnRenamed("id", "healpix_index"), zoom)


def grid_weights(targets: DataFrame, grid: LatLonGrid, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Three source points and weights for every target, one row per target.

    Output: ``healpix_index, j0, i0, corners`` where ``corners`` is an array of
    ``(src_id, w)``.  Targets outside the source rows get no row.
    """
    n_lat, n_lon = grid.lat.size, grid.lon.size
    placed = targets.withColumns(
        {"_y": grid.lat.position(lat), "_x": grid.lon.position(lon)}
    ).filter(F.col("_y").isNotNull() & F.col("_x").isNotNull())
    # On the last row or column the target belongs to the cell before it.
    j0 = F.least(F.floor("_y"), F.lit(n_lat - 2)).cast("bigint")
    i0 = F.floor("_x") if grid.lon.cyclic else F.least(F.floor("_x"), F.lit(n_lon - 2))
    placed = placed.withColumns({"j0": j0, "_i": i0.cast("bigint")}).withColumns(
        {
            "_v": F.col("_y") - F.col("j0"),
            "_u": F.col("_x") - F.col("_i"),
            "i0": F.pmod(F.col("_i"), F.lit(n_lon)).cast("bigint"),
            "_i1": F.pmod(F.col("_i") + 1, F.lit(n_lon)).cast("bigint"),
        }
    )
    u, v, j = F.col("_u"), F.col("_v"), F.col("j0")
    east_first = u >= v
    middle = F.when(east_first, grid.src_id(j, "_i1")).otherwise(grid.src_id(j + 1, "i0"))
    corners = F.array(
        F.struct(grid.src_id(j, "i0").alias("src_id"), (1 - F.greatest(u, v)).alias("w")),
        F.struct(middle.alias("src_id"), F.abs(u - v).alias("w")),
        F.struct(grid.src_id(j + 1, "_i1").alias("src_id"), F.least(u, v).alias("w")),
    )
    return placed.withColumn("corners", corners).drop("_x", "_y", "_i", "_i1", "_u", "_v")


def explode_corners(weights: DataFrame, *keep: str) -> DataFrame:
    """Long form: ``healpix_index, src_id, w`` (three rows per target)."""
    return weights.select("healpix_index", *keep, F.inline("corners"))


def build_weights(spark: SparkSession, grid: LatLonGrid, zoom: int) -> DataFrame:
    return grid_weights(target_cells(spark, zoom, grid), grid).select(
        "healpix_index", "j0", "i0", "corners"
    )
