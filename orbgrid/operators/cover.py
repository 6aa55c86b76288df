"""Cells of a longitude/latitude box as index ranges, by descent from the twelve base cells.

A cell of the nested order holds its descendants as one index range.  Going
down, a cell whose circle misses the box is left out, one whose circle lies
inside is taken whole, and only the others are divided: what is looked at
grows with the box's edge and not with the number of cells of the zoom.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Extent = tuple[float, float, float, float]

#: Degrees by which a circle is widened, against rounding.
SLACK = 1e-6
#: Cells on the edge that are divided at most; more stay as they are, coarser than the zoom.
MAX_EDGE = 200_000


@dataclass(frozen=True)
class Cover:
    """Half-open index ranges of a zoom: ``inside`` surely in the box, ``edge`` to be looked at."""

    zoom: int
    inside: np.ndarray
    edge: np.ndarray
    examined: int

    @property
    def ranges(self) -> np.ndarray:
        """All of them, merged where they meet."""
        return merge(np.concatenate([self.inside, self.edge]))


def merge(ranges: np.ndarray, most: int | None = None) -> np.ndarray:
    """Ranges in order, joined where they touch; with ``most``, across the smallest gaps until so many are left."""
    if not len(ranges):
        return np.zeros((0, 2), np.int64)
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    ends = np.maximum.accumulate(ranges[:, 1])
    gaps = ranges[1:, 0] - ends[:-1]
    wide = gaps > 0
    if most is not None and wide.sum() >= most:
        wide = np.zeros(len(gaps), bool)
        wide[np.argsort(-gaps, kind="stable")[: most - 1]] = True
    cut = np.flatnonzero(wide)
    return np.stack([ranges[np.append(0, cut + 1), 0], ends[np.append(cut, len(ends) - 1)]], axis=1)


def _dense_bits(v: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros_like(v)
    for k in range(bits):
        out |= (v >> (2 * k) & 1) << k
    return out


def centres(cells: np.ndarray, zoom: int) -> tuple[np.ndarray, np.ndarray]:
    """Longitude and latitude, in degrees, of cells in nested order."""
    n = 1 << zoom
    face, within = cells >> (2 * zoom), cells & (n * n - 1)
    x, y = _dense_bits(within, zoom), _dense_bits(within >> 1, zoom)
    row = face >> 2
    ring = (row + 2) * n - x - y - 1
    near = np.minimum(np.minimum(ring, 4 * n - ring), n)
    south = 2 * n - ring
    z = np.where(near == n, south * 2.0 / (3 * n), np.sign(south) * (1 - near * near / (3.0 * n * n)))
    turn = (2 * (face & 3) + (row != 1)) * near + x - y
    return 45.0 * turn / near % 360.0, np.degrees(np.arcsin(z))


def cell_radius(zoom: int) -> float:
    """Degrees from a cell's centre to its farthest corner, for the widest cell of a zoom."""
    n = 1 << zoom
    # Widest are the cells next to the corners where polar and equatorial zone meet.
    corner = np.array([np.sqrt(1 - 4 / 9) * np.cos(np.pi / (4 * n)), np.sqrt(1 - 4 / 9) * np.sin(np.pi / (4 * n)), 2 / 3])
    z = 1 - (1 - 1 / n) ** 2 / 3
    other = np.array([np.sqrt(1 - z * z), 0.0, z])
    return float(np.degrees(np.arctan2(np.linalg.norm(np.cross(corner, other)), corner @ other)))


def _place(cells: np.ndarray, zoom: int, extent: Extent) -> tuple[np.ndarray, np.ndarray]:
    """Whether the circles of cells may meet the box, and whether they lie inside."""
    west, east, south, north = extent
    lon, lat = centres(cells, zoom)
    r = cell_radius(zoom) + SLACK
    over_pole = np.abs(lat) + r >= 90.0
    with np.errstate(invalid="ignore"):
        half = np.degrees(np.arcsin(np.minimum(1.0, np.sin(np.radians(min(r, 90.0))) / np.maximum(np.cos(np.radians(lat)), 1e-12)))) + SLACK
    half = np.where(over_pole, 180.0, half)
    width, at = east - west, (lon - west) % 360.0
    beside = ((at - half < width) | (at + half > 360.0)) if width < 360.0 else np.ones(len(cells), bool)
    meets = beside & (lat - r < north) & (lat + r > south)
    # Longitudes are compared as they are read, from 0 to 360 and past it up to the eastern edge.
    plain = 0.0 <= west and east <= 720.0
    inside = (at - half > 0) & (at + half < min(width, 360.0)) & (lat - r > south) & (lat + r < north) & ~over_pole
    return meets, inside & plain


def cover(extent: Extent, zoom: int, max_edge: int = MAX_EDGE) -> Cover:
    """Ranges of the cells whose centres lie in ``extent`` (west, east, south, north; east may pass 360)."""
    cells, at, examined = np.arange(12, dtype=np.int64), 0, 0
    inside = []
    while True:
        examined += len(cells)
        meets, whole = _place(cells, at, extent)
        span = 2 * (zoom - at)
        inside.append(np.stack([cells[whole] << span, cells[whole] + 1 << span], axis=1))
        cells = cells[meets & ~whole]
        if at == zoom or 4 * len(cells) > max_edge:
            edge = np.stack([cells << span, cells + 1 << span], axis=1)
            return Cover(zoom, merge(np.concatenate(inside)), merge(edge), examined)
        cells = (cells[:, None] * 4 + np.arange(4)).ravel()
        at += 1


def cells_of(spark: SparkSession, ranges: np.ndarray, piece: int = 4**7) -> DataFrame:
    """``healpix_index`` of every cell in the ranges, made in pieces that are spread over the tasks."""
    starts = [np.arange(lo, hi, piece) for lo, hi in ranges.tolist()]
    if not starts:
        return spark.createDataFrame([], "healpix_index bigint")
    lo = np.concatenate(starts)
    hi = np.concatenate([np.minimum(s + piece, h) for s, h in zip(starts, ranges[:, 1], strict=True)])
    pieces = spark.createDataFrame(list(zip(lo.tolist(), hi.tolist(), strict=True)), "lo bigint, hi bigint")
    return pieces.select(F.explode(F.sequence("lo", F.col("hi") - 1)).alias("healpix_index"))


def in_ranges(column: str, ranges: np.ndarray) -> Column:
    """Range predicates that a Parquet scan can skip by."""
    out = F.lit(False)
    for lo, hi in ranges.tolist():
        out = out | ((F.col(column) >= lo) & (F.col(column) < hi))
    return out
