"""One key holds a third of all rows or more; results stay whole and exact."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbgrid.functions.axes import GridAxis, LatLonGrid, TimeAxis
from orbgrid.functions.healpix import npix
from orbgrid.operators import timeline as tl
from orbgrid.operators.pyramid import pyramid
from orbgrid.operators.quality import missing_fraction
from orbgrid.operators.reduce import exact_quantiles
from orbgrid.operators.regrid import regrid

T0 = datetime(2020, 1, 20)
AXIS = TimeAxis(T0, T0 + timedelta(hours=30000), timedelta(hours=1))


@pytest.fixture(scope="module")
def series(spark):
    """Half of all rows in one series, the rest spread over many."""
    hot = spark.range(20_000).select(F.lit("hot").alias("s"), F.col("id").alias("k"))
    cold = spark.range(20_000).select((F.col("id") % 997).cast("string").alias("s"), F.floor(F.col("id") / 997).alias("k"))
    hours = F.make_dt_interval(hours=F.col("k").cast("int"))
    df = hot.union(cold).withColumn("time", (F.lit(T0).cast("timestamp_ntz") + hours).cast("timestamp_ntz"))
    return df.withColumn("v", F.rand(4)).cache()


def test_quantiles(spark, series):
    got = {(r.s, r.prob): r.quantile for r in exact_quantiles(series, ["s"], "v", (0.02, 0.98)).collect()}
    hot = [r.v for r in series.filter("s = 'hot'").select("v").collect()]
    assert len(got) == 2 * 998
    for p in (0.02, 0.98):
        assert got["hot", p] == pytest.approx(np.percentile(hot, 100 * p), rel=1e-12)


def test_time_operators(spark, series):
    holes = series.filter((F.col("k") % 5000 != 4096) | (F.col("s") != "hot"))
    gaps = tl.axis_gaps(holes, ["s"], AXIS).collect()
    assert sorted((r.time_idx, r.n_missing) for r in gaps) == [(k * 5000 + 4097, 1) for k in range(4)]
    last = tl.trim_last(series, ["s"], series.select("s").distinct().withColumn("n", F.lit(3)))
    assert last.count() == 998 * 3
    assert last.filter("s = 'hot'").agg(F.min("k")).first()[0] == 19_997
    assert tl.trim_first(series, ["s"], full=20).count() == series.count() - series.filter("s <> 'hot'").groupBy("s").count().filter("count = 20").count()
    assert tl.settle_times(series, ["s"]).count() == series.count()


def test_one_step_with_most_points(spark):
    """A full field on one step and remnants on many."""
    grid = LatLonGrid(GridAxis(-90.0, 10.0, 19), GridAxis(0.0, 10.0, 36, cyclic=True))
    points = spark.range(grid.size).withColumnRenamed("id", "src_id")
    at = points.withColumns(
        {"lat": -90.0 + 10.0 * F.floor(F.col("src_id") / 36), "lon": 10.0 * (F.col("src_id") % 36)}
    )
    full = at.withColumn("time", F.lit(0))
    rest = at.filter("src_id % 36 < 3").withColumn("time", F.explode(F.sequence(F.lit(1), F.lit(20))))
    field = full.union(rest).withColumn("v", F.col("lat") + F.col("time"))
    results = [
        regrid(field, grid, 3, ["time"], ["v"], strategy=s, tile=4, pack=p).orderBy("time", "healpix_index").toPandas()
        for s, p in (("broadcast", None), ("tiled", None), ("tiled", "time"))
    ]
    assert (results[0].time == 0).sum() == npix(3)
    for other in results[1:]:
        assert len(other) == len(results[0]) and np.allclose(other.v, results[0].v)


def test_one_variable_with_most_cells(spark):
    hot = spark.range(npix(4)).select(F.lit("hot").alias("variable"), F.col("id").alias("healpix_index"))
    cold = spark.range(600).select((F.col("id") % 200).cast("string").alias("variable"), (F.col("id") * 5).alias("healpix_index"))
    df = hot.union(cold).withColumn("v", F.lit(1.0))
    levels = pyramid(df, ["variable"], ["v"], 4, span=2)
    assert levels.filter("v <> 1").count() == 0
    assert levels.filter("variable = 'hot'").count() == sum(npix(z) for z in range(5))
    share = {r.variable: r.missing_fraction for r in missing_fraction(df, ["variable"], "v", npix(4)).collect()}
    assert share["hot"] == 0 and share["7"] == pytest.approx(1 - 3 / npix(4))
