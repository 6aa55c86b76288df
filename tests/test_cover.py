"""Covers of boxes: nothing lost, nothing far away looked at."""

import numpy as np
import pytest

from orbgrid.functions.healpix import npix, with_lonlat
from orbgrid.operators import cover as cv
from orbgrid.operators.regional import active_cells, cells_in_extent
from orbgrid.operators.weights import inside_extent

BOXES = [
    (10.0, 40.0, -20.0, 15.0), (330.0, 400.0, -30.0, 30.0), (0.0, 360.0, 60.0, 90.0), (100.0, 101.0, 0.0, 0.5),
    (0.0, 360.0, -90.0, 90.0), (200.0, 350.0, -90.0, -41.8), (350.0, 371.0, 80.0, 89.9), (45.0, 45.0, 0.0, 0.0), (-30.0, 30.0, -5.0, 5.0),
]


@pytest.mark.parametrize("zoom", [0, 6])
def test_centres_and_radius(spark, zoom):
    cells = with_lonlat(spark.range(npix(zoom)).withColumnRenamed("id", "healpix_index"), zoom).orderBy("healpix_index").toPandas()
    lon, lat = cv.centres(np.arange(npix(zoom)), zoom)
    assert np.allclose(cells.lon, lon, atol=1e-12) and np.allclose(cells.lat, lat, atol=1e-12)
    # Descendants lie within the radius of the cell that holds them.
    x, y = (np.radians(a.reshape(-1, 1)) for a in (lon, lat))
    u, v = (np.radians(a.reshape(-1, 64)) for a in cv.centres(np.arange(npix(zoom + 3)), zoom + 3))
    apart = np.degrees(np.arccos(np.clip(np.sin(y) * np.sin(v) + np.cos(y) * np.cos(v) * np.cos(x - u), -1, 1)))
    assert apart.max() <= cv.cell_radius(zoom)


def test_cells_are_those_of_a_whole_scan(spark):
    zoom = 5
    every = with_lonlat(spark.range(npix(zoom)).withColumnRenamed("id", "healpix_index"), zoom).cache()
    for k, extent in enumerate(BOXES):
        want = {r.healpix_index for r in inside_extent(every, extent).select("healpix_index").collect()}
        found = cv.cover(extent, zoom)
        inside = {k for lo, hi in found.inside.tolist() for k in range(lo, hi)}
        held = {k for lo, hi in found.ranges.tolist() for k in range(lo, hi)}
        assert inside <= want <= held, extent
        if k < 3:
            assert {r.healpix_index for r in cells_in_extent(spark, extent, zoom).collect()} == want
            got = [r.healpix_index for r in active_cells(spark, extent, zoom, 48).collect()]
            assert sorted(got) == sorted(k for c in {w // 48 for w in want} for k in range(c * 48, (c + 1) * 48))


def test_work_follows_the_edge():
    counts = [cv.cover((10.0, 40.0, -20.0, 15.0), zoom).examined for zoom in (7, 8, 9, 10)]
    # The edge doubles with each zoom, the cells of the sphere fourfold.
    assert all(b < 2.3 * a for a, b in zip(counts, counts[1:], strict=False)) and counts[-1] < 0.01 * npix(10)
    coarse = cv.cover((10.0, 40.0, -20.0, 15.0), 20, max_edge=5000)
    fine = cv.cover((10.0, 40.0, -20.0, 15.0), 12)
    size = lambda c: (c.ranges[:, 1] - c.ranges[:, 0]).sum() / npix(c.zoom)
    assert coarse.examined < 40_000 and size(fine) <= size(coarse) < 1.1 * size(fine)


def test_merged_ranges_hold_all():
    ranges = np.array([[0, 2], [2, 5], [9, 10], [30, 40], [11, 12]])
    assert cv.merge(ranges).tolist() == [[0, 5], [9, 10], [11, 12], [30, 40]]
    assert cv.merge(ranges, most=2).tolist() == [[0, 12], [30, 40]]
    assert cv.merge(ranges, most=1).tolist() == [[0, 40]]
    assert cv.merge(ranges[:0]).shape == (0, 2)
