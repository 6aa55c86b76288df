"""Regional domains: active chunks, scatter, gather and bounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.functions.healpix import chunk_id, every_cell, npix, wrap_lon
from orbgrid.operators.cover import Extent, cells_of, cover, in_ranges, merge
from orbgrid.operators.joins import attach
from orbgrid.operators.weights import in_extent, target_cells_in


def chunks_touched(cells: DataFrame, cells_per_chunk: int, ip: str = "healpix_index") -> DataFrame:
    return cells.select(chunk_id(ip, cells_per_chunk).alias("chunk")).distinct()


def expand_chunks(chunks: DataFrame, cells_per_chunk: int) -> DataFrame:
    """Every cell of the given chunks."""
    first = F.col("chunk") * F.lit(cells_per_chunk).cast("bigint")
    return chunks.withColumn(
        "healpix_index", F.explode(F.sequence(first, first + F.lit(cells_per_chunk - 1).cast("bigint")))
    )


def cells_in_extent(spark: SparkSession, extent: Extent, zoom: int) -> DataFrame:
    """Cells of a zoom with their centres inside a domain; others are hardly looked at."""
    return target_cells_in(spark, extent, zoom)


def active_cells(spark: SparkSession, extent: Extent, zoom: int, cells_per_chunk: int) -> DataFrame:
    """Cells of a domain at a zoom: whole chunks, kept if the extent touches them.

    Centres are computed on the domain's edge alone, and there for chunks
    that nothing else touches.
    """
    found = cover(extent, zoom)
    sure = chunk_ranges(found.inside, cells_per_chunk)
    unsure = in_extent(cells_of(spark, found.edge).filter(~in_ranges("healpix_index", sure)), extent, zoom)
    chunks = cells_of(spark, sure // cells_per_chunk).withColumnRenamed("healpix_index", "chunk")
    return expand_chunks(chunks.unionByName(chunks_touched(unsure, cells_per_chunk)), cells_per_chunk)


def chunk_ranges(ranges: np.ndarray, cells_per_chunk: int) -> np.ndarray:
    """Ranges widened to whole chunks."""
    if not len(ranges):
        return ranges
    low = ranges[:, 0] // cells_per_chunk * cells_per_chunk
    return merge(np.stack([low, -(-ranges[:, 1] // cells_per_chunk) * cells_per_chunk], axis=1))


def scatter_global(field: DataFrame, keys: list[str], zoom: int, ip: str = "healpix_index") -> DataFrame:
    """All cells of the zoom for every key of the field; absent ones missing."""
    steps = field.select(*keys).distinct()
    spine = every_cell(steps, zoom, ip)
    return spine.join(field, [*keys, ip], "left")


def fill_active(
    field: DataFrame, keys: list[str], chunks: list[int], cells_per_chunk: int, ip: str = "healpix_index"
) -> DataFrame:
    """Every active cell for every key of the field; cells without a value missing.

    ``chunks`` is the list of active chunks, at most a few hundred numbers.
    """
    steps = field.select(*keys).distinct()
    listed = F.array(*[F.lit(c).cast("bigint") for c in chunks])
    spine = expand_chunks(steps.withColumn("chunk", F.explode(listed)), cells_per_chunk).drop("chunk")
    return spine.withColumnRenamed("healpix_index", ip).join(field, [*keys, ip], "left")


def gather_regional(field: DataFrame, active: DataFrame, zoom: int, ip: str = "healpix_index") -> DataFrame:
    """Restrict a field to the active cells of its zoom."""
    return attach(field, active.select(F.col("healpix_index").alias(ip)), [ip], "left_semi", max_rows=npix(zoom), row_bytes=16)


def domain_bounds(field: DataFrame, by: list[str], lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Corners of a grid, to three decimals, longitudes in [0, 360)."""
    return field.groupBy(*by).agg(
        F.round(F.min(lat), 3).alias("lower_left_lat"),
        F.round(wrap_lon(F.min(lon)), 3).alias("lower_left_lon"),
        F.round(F.max(lat), 3).alias("upper_right_lat"),
        F.round(wrap_lon(F.max(lon)), 3).alias("upper_right_lon"),
    )
