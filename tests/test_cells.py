"""Cell arithmetic, weights and regridding."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbgrid.functions.axes import GridAxis, IrregularAxis, LatLonGrid, detect_grid
from orbgrid.functions.healpix import chunk_id, npix, parent, with_lonlat, zoom_from_nside
from orbgrid.operators.regional import active_cells, cells_in_extent
from orbgrid.operators.regrid import apply_weights, regrid
from orbgrid.operators.weights import build_weights, explode_corners


def centres(spark, zoom, **kw):
    df = spark.range(npix(zoom)).withColumnRenamed("id", "healpix_index")
    return with_lonlat(df, zoom, **kw).orderBy("healpix_index").toPandas()


def test_base_cells(spark):
    got = centres(spark, 0)
    lat = math.degrees(math.asin(2 / 3))
    assert np.allclose(got.lat, [lat] * 4 + [0] * 4 + [-lat] * 4)
    assert np.allclose(got.lon, [45, 135, 225, 315, 0, 90, 180, 270, 45, 135, 225, 315])


@pytest.mark.parametrize("zoom", [1, 3, 5])
def test_centres_are_distinct_and_balanced(spark, zoom):
    got = centres(spark, zoom)
    assert len(set(zip(got.lon.round(9), got.lat.round(9)))) == npix(zoom)
    assert abs(np.sin(np.radians(got.lat)).sum()) < 1e-8
    assert got.lon.between(0, 360, inclusive="left").all()


def test_children_surround_parent(spark):
    fine, coarse = centres(spark, 5), centres(spark, 4)

    def unit(d):
        lon, lat = np.radians(d.lon), np.radians(d.lat)
        return np.column_stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])

    mean = unit(fine).reshape(-1, 4, 3).mean(axis=1)
    cos = (mean / np.linalg.norm(mean, axis=1)[:, None] * unit(coarse)).sum(axis=1)
    assert np.degrees(np.arccos(np.clip(cos, -1, 1))).max() < 0.3


def test_zoom_column_matches_constant(spark):
    mixed = spark.range(48).select(F.col("id").alias("healpix_index"), F.lit(1).alias("zoom"))
    a = with_lonlat(mixed, "zoom").orderBy("healpix_index").toPandas()
    b = centres(spark, 1)
    assert np.allclose(a.lon, b.lon) and np.allclose(a.lat, b.lat)


def test_signed_longitude_and_ids(spark):
    got = centres(spark, 2, signed=True)
    assert got.lon.between(-180, 180, inclusive="right").all()
    row = spark.range(1).select(
        parent(F.lit(37).cast("bigint")).alias("p"),
        chunk_id(F.lit(37).cast("bigint"), 16).alias("c"),
        chunk_id(F.lit(37).cast("bigint"), 12).alias("d"),
        zoom_from_nside(F.lit(8)).alias("z"),
    ).first()
    assert (row.p, row.c, row.d, row.z) == (9, 2, 3, 3)


GLOBAL = LatLonGrid(GridAxis(-90.0, 10.0, 19), GridAxis(0.0, 15.0, 24, cyclic=True))


def test_weights_are_barycentric(spark):
    w = explode_corners(build_weights(spark, GLOBAL, 3)).groupBy("healpix_index").agg(
        F.sum("w").alias("s"), F.min("w").alias("lo"), F.count("w").alias("n"), F.max("src_id").alias("m")
    ).toPandas()
    assert len(w) == npix(3)
    assert np.allclose(w.s, 1) and w.lo.min() >= 0 and (w.n == 3).all() and w.m.max() < GLOBAL.size


def grid_field(spark, grid, expr):
    points = spark.range(grid.size).select(
        (F.lit(grid.lat.start) + F.lit(grid.lat.step) * F.floor(F.col("id") / grid.lon.size)).alias("lat"),
        (F.lit(grid.lon.start) + F.lit(grid.lon.step) * (F.col("id") % grid.lon.size)).alias("lon"),
    )
    return points.withColumns({"time": F.lit(0), "v": expr})


def test_fields_linear_in_latitude_are_exact(spark):
    out = regrid(grid_field(spark, GLOBAL, 3.0 * F.col("lat") + 7.0), GLOBAL, 3, ["time"], ["v"])
    got = with_lonlat(out, 3).toPandas()
    assert len(got) == npix(3)
    assert np.allclose(got.v, 3 * got.lat + 7)


@pytest.mark.parametrize("lat", [GridAxis(-30.0, 2.5, 25), GridAxis(30.0, -2.5, 25)])
def test_regional_linear_field_both_latitude_orders(spark, lat):
    grid = LatLonGrid(lat, GridAxis(320.0, 2.5, 41), regional=True)  # crosses 360
    out = regrid(grid_field(spark, grid, F.col("lat") - 2.0 * F.col("lon")), grid, 4, ["time"], ["v"])
    got = with_lonlat(out, 4).toPandas()
    lon = np.where(got.lon <= 420 - 360, got.lon + 360, got.lon)
    assert len(got) == cells_in_extent(spark, grid.extent, 4).count() > 100
    assert np.allclose(got.v, got.lat - 2 * lon)


@pytest.mark.parametrize("pack", [None, "time"])
@pytest.mark.parametrize("tile", [3, 7, 64])
@pytest.mark.parametrize("grid", [GLOBAL, LatLonGrid(GridAxis(-40.0, 4.0, 21), GridAxis(30.0, 5.0, 17), regional=True)])
def test_tiled_plan_equals_broadcast_plan(spark, grid, tile, pack):
    field = grid_field(spark, grid, F.when(F.rand(3) > 0.05, F.sin(F.col("lat")) * F.col("lon")))
    field = field.withColumn("time", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(5), F.lit(30)))).withColumn(
        "v", F.col("v") + F.col("time")
    ).cache()
    a = regrid(field, grid, 3, ["time"], ["v"], strategy="broadcast").toPandas()
    b = regrid(field, grid, 3, ["time"], ["v"], strategy="tiled", tile=tile, pack=pack).toPandas()
    key = ["time", "healpix_index"]
    a, b = a.sort_values(key).reset_index(drop=True), b.sort_values(key).reset_index(drop=True)
    assert len(a) and a[key].equals(b[key]) and np.allclose(a.v, b.v)


def test_tiled_plan_shuffles_each_side_once(spark):
    """Join and sum run where the tiles were put."""
    field = GLOBAL.with_src_id(grid_field(spark, GLOBAL, F.col("lat")))
    w = build_weights(spark, GLOBAL, 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = apply_weights(field, w, GLOBAL, npix(3), ["time"], ["v"], strategy="tiled", tile=5, pack="time")
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 2


def test_missing_corner_makes_cell_missing(spark):
    full = grid_field(spark, GLOBAL, F.lit(1.0))
    holes = GLOBAL.with_src_id(full).withColumn("v", F.when(F.col("src_id") != 100, F.col("v")))
    lost = explode_corners(build_weights(spark, GLOBAL, 3)).filter("src_id = 100").select("healpix_index").distinct()
    out = regrid(holes.drop("src_id"), GLOBAL, 3, ["time"], ["v"])
    assert out.count() == npix(3) - lost.count()
    assert out.join(lost, "healpix_index").count() == 0


def test_grid_is_read_from_the_field(spark):
    assert detect_grid(grid_field(spark, GLOBAL, F.lit(0.0))) == GLOBAL
    uneven = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (3.0, 2.0)], "lat double, lon double")
    assert detect_grid(uneven) == LatLonGrid(IrregularAxis((0.0, 1.0, 3.0)), GridAxis(0.0, 1.0, 3))
    lons = [0.0, 100.0, 180.0, 290.0]
    circle = spark.createDataFrame([(float(k), x) for k in range(3) for x in lons], "lat double, lon double")
    assert detect_grid(circle).lon == IrregularAxis(tuple(lons), cyclic=True)


def test_irregular_axes_find_positions(spark):
    xs = [-1.0, 0.0, 0.5, 1.0, 2.9, 3.0, 6.999, 7.0, 7.1, 359.0, 365.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    points = (0.0, 1.0, 3.0, 7.0)

    def plain(x):
        k = next((k for k in range(3) if points[k] <= x < points[k + 1]), None)
        return 3.0 if x == 7.0 else None if k is None else round(k + (x - points[k]) / (points[k + 1] - points[k]), 12)

    assert [r[0] for r in df.select(IrregularAxis(points).position("x")).collect()] == [plain(x) for x in xs]
    down = [r[0] for r in df.select(IrregularAxis(points[::-1]).position("x")).collect()]
    assert down == [None if plain(x) is None else pytest.approx(3 - plain(x), abs=1e-12) for x in xs]
    even, odd = GridAxis(10.0, 90.0, 4, cyclic=True), IrregularAxis((10.0, 100.0, 190.0, 280.0), cyclic=True)
    assert df.filter(even.position("x") != odd.position("x")).count() == 0
    assert df.limit(0).select(odd.index_of("x")).count() == 0


def test_uneven_rows_keep_linear_fields(spark):
    rows = tuple(-80.0 + 8.0 * k + (k % 2) * 3.0 for k in range(21))
    grid = LatLonGrid(IrregularAxis(rows), GLOBAL.lon)
    field = grid_field(spark, GLOBAL, F.lit(0.0)).select("time", "lon").distinct()
    field = field.crossJoin(spark.createDataFrame([(y,) for y in rows], "lat double")).withColumn("v", 2 * F.col("lat") + 1)
    out = with_lonlat(regrid(field, grid, 3, ["time"], ["v"]), 3)
    assert out.count() > 0 and out.filter(F.abs(F.col("v") - 2 * F.col("lat") - 1) > 1e-9).count() == 0


def test_active_cells_are_whole_chunks(spark):
    extent = (10.0, 50.0, -20.0, 25.0)
    active = active_cells(spark, extent, 4, 64).toPandas()
    inside = cells_in_extent(spark, extent, 4).toPandas()
    assert set(inside.healpix_index) <= set(active.healpix_index)
    assert set(active.chunk) == set(inside.healpix_index // 64)
    assert len(active) == 64 * active.chunk.nunique()
