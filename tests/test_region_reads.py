"""Boxes and time ranges of a stored dataset: right rows, and most of a store left unread."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orbgrid.functions.axes import TimeAxis
from orbgrid.functions.healpix import npix, with_lonlat
from orbgrid.operators.weights import inside_extent
from orbgrid.plans import jobs
from orbgrid.plans.config import Experiment, work_chunk
from orbgrid.sources.store import CellStore
from test_cover import BOXES
from test_jobs import T0, one_group

ZOOM, HOURS = 7, 48


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """Two days of hours at a zoom of 12 tiles, in twelve-hour blocks; pages as small beside a tile as at zoom 10."""
    store = CellStore(spark, str(tmp_path_factory.mktemp("boxes")), tile_bits=14)
    hour = F.col("id") % HOURS
    cells = spark.range(npix(ZOOM) * HOURS).select(
        F.lit("demo").alias("sim"), F.lit("PT1H").alias("freq"), F.lit(ZOOM).alias("zoom"), F.lit("a").alias("variable"),
        F.floor(hour / 12).alias("block"), (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(hours=hour.cast("int"))).alias("time"),
        F.lit(None).cast("double").alias("level"), F.floor(F.col("id") / HOURS).alias("healpix_index"), F.rand(7).alias("value"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("parquet.page.row.count.limit", "320")
    store.write_region(cells)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("parquet.page.row.count.limit")
    return store


@pytest.mark.parametrize("extent", BOXES)
def test_boxes_have_the_rows_of_a_whole_scan(store, extent):
    time = (T0 + timedelta(hours=5), T0 + timedelta(hours=7))
    want = inside_extent(with_lonlat(store.scan("demo", "PT1H", ZOOM), ZOOM), extent).filter(F.hour("time").isin(5, 6) & (F.col("block") == 0))
    got = store.open("demo", "PT1H", ZOOM, extent=extent, time=time, blocks=(0, 0))
    digest = lambda df: df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("healpix_index", "time", "value"))).first()
    assert digest(got) == digest(want)


def test_signed_longitudes_and_open_ends(store):
    got = store.open("demo", "PT1H", ZOOM, ["a"], True, (350.0, 370.0, -10.0, 10.0), (T0 + timedelta(hours=40), None))
    row = got.agg(F.min("lon").alias("w"), F.max("lon").alias("e"), F.min("time").alias("t"), F.max("time").alias("u")).first()
    assert -10 < row.w < -8 and 8 < row.e < 10
    assert (row.t, row.u) == (T0 + timedelta(hours=40), T0 + timedelta(hours=47))
    assert store.open("demo", "PT1H", ZOOM, time=(None, T0)).count() == 0
    assert store.open("absent", "PT1H", ZOOM, extent=BOXES[0]).count() == 0


def test_a_box_leaves_most_of_the_store_unread(store):
    """Rows let through are under five times those asked for: a block has twice the hours, the edge's pages twice the cells."""
    extent, time = (10.0, 40.0, -20.0, 15.0), (T0 + timedelta(hours=14), T0 + timedelta(hours=20))
    got = store.open("demo", "PT1H", ZOOM, extent=extent, time=time, blocks=(1, 1))
    n = got.count()
    read = read_by_scan(got)
    assert 0 < n <= read < 5 * n and read < 0.02 * npix(ZOOM) * HOURS


def read_by_scan(df):
    """Output rows of the Parquet scan, from the metrics of the plan that ran."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    todo, rows = [node], 0
    while todo:
        p = todo.pop()
        if "FileSourceScan" in p.getClass().getSimpleName():
            rows += p.metrics().get("numOutputRows").get().value()
        kids = p.children()
        todo += [kids.apply(k) for k in range(kids.size())]
        if "AdaptiveSparkPlan" in p.getClass().getSimpleName():
            todo.append(p.executedPlan())
    return rows


@pytest.mark.parametrize("zoom", [4, 3])
def test_blocks_hold_the_times(zoom):
    exp = one_group()
    axis = TimeAxis(T0, T0 + timedelta(days=30), timedelta(hours=1))
    width = 12 if zoom == exp.max_zoom else work_chunk(zoom)
    for a, b in [(0, 1), (5, 400), (63, 65), (700, 720)]:
        low, high = jobs._blocks_of((T0 + timedelta(hours=a), T0 + timedelta(hours=b)), axis, zoom, exp)
        need = {h // width for h in range(a, b)}
        assert low <= min(need) and max(need) <= high and high - low <= max(need) - min(need) + 3


def test_dataset_by_times(spark, store):
    exp = Experiment("demo", ZOOM, one_group().groups)
    time = (datetime(T0.year, T0.month, T0.day, 12), datetime(T0.year, T0.month, T0.day, 14))
    got = jobs.open_dataset(store, exp, "PT1H", ZOOM, time=time)
    assert got.count() == 2 * npix(ZOOM) and {r.block for r in got.select("block").distinct().collect()} == {1}
    assert len({f.split("block=")[1][0] for f in got.inputFiles()}) <= 4
