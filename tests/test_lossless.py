"""Jobs that must not lose data, and arithmetic at its edges."""

from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbgrid.functions import healpix as hp
from orbgrid.functions.axes import TimeAxis
from orbgrid.operators import mapping as mp
from orbgrid.operators import quality as ql
from orbgrid.operators import reduce as rd
from orbgrid.operators import reports as rp
from orbgrid.operators import timeline as tl
from orbgrid.plans import jobs
from orbgrid.plans.config import SURFACE
from orbgrid.sources import manifest as mf
from orbgrid.sources.store import CellStore
from test_jobs import GRID, T0, all_cycles, one_group, source_fields

def cycle(k):
    return F.lit(T0 + timedelta(hours=12 * k)).cast("timestamp_ntz")


def done(store, exp):
    return sorted(r.cycle for r in jobs.done_cycles(store, exp.key).collect())


def test_rerun_with_all_values_missing_is_refused(spark, tmp_path):
    exp, store = one_group(), CellStore(spark, str(tmp_path))
    fields = source_fields(spark, exp)
    jobs.regrid_cycles(fields.filter(F.col("cycle") == cycle(0)), all_cycles(fields).filter(F.col("cycle") == cycle(0)), exp, lambda _: GRID, store)
    empty = fields.withColumn("value", F.lit(None).cast("double"))
    fresh = CellStore(spark, str(tmp_path))
    with pytest.raises(ql.QualityError, match="all values missing"):
        jobs.regrid_cycles(empty, all_cycles(fields), exp, lambda _: GRID, fresh)
    # Neither is done: what the first one had is gone from the store.
    assert done(store, exp) == [] and store.scan().count() == 0


def test_each_cycle_matches_by_itself_and_bad_ones_stand_aside(spark, tmp_path):
    exp, store = one_group(), CellStore(spark, str(tmp_path))
    fields = source_fields(spark, exp)
    # Cell methods differ between the cycles: one match in each, two in both together.
    mixed = fields.withColumn("cell_methods", F.when(F.col("cycle") == cycle(1), F.array(F.lit("mean"))).otherwise(F.col("cell_methods")))
    jobs.regrid_cycles(mixed, all_cycles(mixed), exp, lambda _: GRID, store)
    assert len(done(store, exp)) == 2
    other = CellStore(spark, str(tmp_path / "other"))
    twice = fields.union(fields.filter(F.col("cycle") == cycle(0)).withColumn("stash", F.lit("m99s00i000")))
    jobs.regrid_cycles(twice, all_cycles(twice), exp, lambda _: GRID, other, strict=False)
    assert done(other, exp) == [T0 + timedelta(hours=12)]
    rejected = other.read_table("rejected", jobs.REJECTED_SCHEMA).collect()
    assert [r.cycle for r in rejected] == [T0] and "2 matches" in rejected[0].problem


def test_fields_without_a_code(spark, tmp_path):
    exp, store = one_group(), CellStore(spark, str(tmp_path))
    fields = source_fields(spark, exp).withColumn("stash", F.lit(None).cast("string"))
    jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, store)
    assert store.scan().select("time").distinct().count() == 24


def test_coarser_zoom_waits_for_the_finer_one(spark, tmp_path):
    exp, store = one_group(max_zoom=3), CellStore(spark, str(tmp_path))
    fields = source_fields(spark, exp)
    jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, store)
    assert jobs.coarsen_zoom(store, exp, "2d", 1) == 0
    assert jobs.coarsen_zoom(store, exp, "2d", 2, end=T0 - timedelta(hours=1)) == 0
    assert all(jobs.coarsen_all(store, exp, ("2d",)).values())
    assert store.scan(exp.key, "PT1H", 0).select("time").distinct().count() == 24


def test_gate_asks_for_the_cycle_before(spark):
    exp = one_group()
    axis = exp.groups[0].axis
    series = spark.createDataFrame([("s",)], "sim string")
    present = spark.createDataFrame([("s", T0 + timedelta(hours=12))], "sim string, cycle timestamp_ntz")
    gate = lambda **k: {r.chunk: r.runnable for r in mf.coverage_gate(series, present, axis, 12, **k).collect()}
    assert gate() == {0: False, 1: True}
    assert gate(preceding=True) == {0: False, 1: False}


def test_create_dataset_and_readers(spark, tmp_path):
    exp, store = one_group(regional=True, max_zoom=3, key="region"), CellStore(spark, str(tmp_path))
    with pytest.raises(ValueError, match="create_dataset"):
        fields = source_fields(spark, exp)
        jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, store)
        jobs.coarsen_zoom(store, exp, "2d", 2)
    jobs.create_dataset(store, exp, lambda _: GRID, shared={"processing_version": "v1"})
    assert jobs.is_created(store, exp)
    meta = store.read_table("metadata", jobs.METADATA_SCHEMA).collect()
    assert len(meta) == 4 and {m.attrs["processing_version"] for m in meta} == {"v1"}
    assert {m.zoom: m.crs["healpix_nside"] for m in meta} == {z: str(2**z) for z in range(4)}
    jobs.coarsen_all(store, exp, ("2d",))
    cells = jobs.with_coverage(store.open(exp.key, "PT1H", 1), store, exp.key, "PT1H", 1)
    assert cells.filter("weights is null or weights <= 0 or weights > 1").count() == 0 and cells.count() > 0


@pytest.mark.parametrize("zoom", [0, 9, 11, 20, 29])
def test_coordinates_by_column_equal_those_by_number(spark, zoom):
    ids = sorted({0, 1, hp.npix(zoom) // 2, hp.npix(zoom) // 3, hp.npix(zoom) - 1})
    df = spark.createDataFrame([(i, zoom) for i in ids], "healpix_index long, z int")
    a = [(r.lon, r.lat) for r in hp.with_lonlat(df, "z").orderBy("healpix_index").collect()]
    b = [(r.lon, r.lat) for r in hp.with_lonlat(df, zoom).orderBy("healpix_index").collect()]
    assert a == b


def test_every_cell_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(hp, "FAN_OUT", 16)
    rows = spark.createDataFrame([("a",), ("b",)], "k string")
    got = hp.every_cell(rows, 3)
    assert got.count() == got.distinct().count() == 2 * hp.npix(3)
    assert got.agg(F.min("healpix_index"), F.max("healpix_index")).first() == (0, hp.npix(3) - 1)


def test_times_off_the_axis_are_reported(spark):
    axis = one_group().groups[0].axis
    times = [T0, T0 + timedelta(hours=1), T0 + timedelta(hours=4), T0 + timedelta(days=60), T0 + timedelta(minutes=20)]
    df = spark.createDataFrame([(None, t) for t in times], "s string, time timestamp_ntz")
    rows = tl.axis_gaps(df, ["s"], axis).collect()
    assert sorted((r.time_idx, r.prev_idx, r.n_missing, r.n_off_axis) for r in rows if r.time_idx) == [(4, 1, 2, None)]
    assert [r.n_off_axis for r in rows if r.time_idx is None] == [2]


def test_snapshot_of_too_few_steps_is_empty(spark):
    df = spark.createDataFrame([(T0, 1.0)], "time timestamp_ntz, v double")
    assert tl.snapshot(df).count() == 0 and tl.snapshot(df, 0).count() == 1


def test_null_series_are_trimmed_and_kept(spark):
    rows = [(None, T0 + timedelta(hours=k)) for k in range(13)]
    df = spark.createDataFrame(rows, "s string, time timestamp_ntz")
    assert tl.trim_first(df, ["s"]).count() == 12 and tl.settle_times(df, ["s"]).count() == 12
    last = spark.createDataFrame([(None, 3)], "s string, n long")
    assert tl.trim_last(df, ["s"], last).count() == 3


def test_divisions_by_zero(spark):
    df = spark.createDataFrame([("k", 1.0, 0.0), ("k", 2.0, 0.0)], "k string, v double, weights double")
    assert rd.weighted_domain_mean(df, ["k"], ["v"]).first()["v"] is None
    constant = spark.createDataFrame([("k", 0.0)] * 5, "k string, v double")
    r = rd.robust_range(constant, ["k"], "v").first()
    assert (r.diverging, r.vmin, r.vmax) == (False, None, None)
    two = spark.createDataFrame([("k", T0, 1.0), ("k", T0 + timedelta(hours=1), 1.0)], "k string, time timestamp_ntz, v double")
    assert ql.inner_series_missing(two, ["k"], "v", 12, ["k"]).first()["missing_fraction"] is None
    assert spark.range(1).select(mp.OPERATORS["/"](F.lit(1.0), F.lit(0.0))).first()[0] is None


@pytest.mark.parametrize("window", [5, 1000])
def test_quantiles_of_heavy_tails(spark, window):
    rng = np.random.default_rng(3)
    values = np.concatenate([np.exp(rng.normal(0, 12, 900)), -np.exp(rng.normal(0, 12, 900)), [1e300, -1e300, 0.0]])
    df = spark.createDataFrame([("k", float(v)) for v in values] + [("c", 4.0)] * 3, "k string, v double")
    got = {(r.k, r.prob): r.quantile for r in rd.exact_quantiles(df, ["k"], "v", (0.02, 0.5, 0.98), window=window).collect()}
    for p in (0.02, 0.5, 0.98):
        assert got["k", p] == pytest.approx(np.percentile(values, 100 * p), rel=1e-9)
        assert got["c", p] == 4.0


def test_experiments_without_input_show_zero(spark):
    some = spark.createDataFrame([("a",)], "sim string")
    none = some.limit(0)
    rows = rp.completeness_report(some, none, none, none, 4, 4, spark.createDataFrame([("a",), ("b",)], "sim string")).collect()
    assert {r.sim: (r.num_inputs, r.inputs, r.regrid) for r in rows} == {"a": (1, 25.0, 0.0), "b": (0, 0.0, 0.0)}


def test_unreadable_names_stop_the_job(spark):
    files = spark.createDataFrame([("/x/run_20200120T00.pp", "run_20200120T00"), ("/x/odd.pp", "odd")], "path string, stem string")
    assert mf.file_cycles(files.limit(1)).first().cycle == datetime(2020, 1, 20)
    with pytest.raises(Exception, match="no cycle time"):
        mf.file_cycles(files).collect()


def test_grids_apart_by_little_have_their_own_key():
    from dataclasses import replace

    near = replace(GRID, lat=replace(GRID.lat, start=GRID.lat.start + 1e-9))
    assert near.key != GRID.key and replace(GRID).key == GRID.key


def test_notes_are_whole():
    notes = {s.short: s.attrs.get("notes", "") for s in SURFACE}
    assert notes["prs"].startswith("Hourly mean") and ". Hourly mean" in notes["pr"]


def means(store, exp, zoom):
    return store.scan(exp.key, "PT1H", zoom).agg(F.avg("value")).first()[0]


def test_corrected_cycles_reach_every_zoom(spark, tmp_path):
    exp, store = one_group(max_zoom=3), CellStore(spark, str(tmp_path))
    fields = source_fields(spark, exp)
    jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, store)
    assert all(jobs.coarsen_all(store, exp, ("2d",)).values())
    assert not any(jobs.coarsen_all(store, exp, ("2d",)).values())
    before = means(store, exp, 0)
    mended = fields.withColumn("value", F.col("value") + F.when(F.col("cycle") == cycle(1), 100.0).otherwise(0.0))
    jobs.reopen_cycles(store, exp, [T0 + timedelta(hours=12)])
    assert done(store, exp) == [T0]
    assert not any(jobs.coarsen_all(store, exp, ("2d",)).values())  # waits for the corrected cycle
    jobs.regrid_cycles(mended, all_cycles(fields).filter(F.col("cycle") == cycle(1)), exp, lambda _: GRID, store)
    assert all(jobs.coarsen_all(store, exp, ("2d",)).values())
    assert means(store, exp, 0) == pytest.approx(means(store, exp, 3), abs=1e-3) and means(store, exp, 0) - before == pytest.approx(50.0, abs=9)
    assert not any(jobs.coarsen_all(store, exp, ("2d",)).values())


def test_rerun_without_values_leaves_none_behind(spark, tmp_path):
    exp, store = one_group(), CellStore(spark, str(tmp_path))
    fields = source_fields(spark, exp)
    jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, store)
    gone = fields.withColumn("value", F.when(F.col("cycle") == cycle(0), F.col("value")))
    jobs.regrid_cycles(gone, all_cycles(fields), exp, lambda _: GRID, store, strict=False)
    assert done(store, exp) == [T0]
    assert store.scan().select("time").distinct().count() == 12
    rejected = lambda: [r.cycle for r in store.read_table("rejected", jobs.REJECTED_SCHEMA).collect()]
    assert rejected() == [T0 + timedelta(hours=12)]
    jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, store)
    assert rejected() == [] and len(done(store, exp)) == 2


def test_backlog_goes_in_waves(spark, tmp_path, monkeypatch):
    """A failure in the 40th of 50 cycles keeps the 39 before it."""
    exp, store = one_group(max_zoom=1), CellStore(spark, str(tmp_path))
    axis = TimeAxis(T0, T0 + timedelta(hours=12 * 50), timedelta(hours=1))
    exp = replace(exp, groups=(replace(exp.groups[0], axis=axis),))
    fields = source_fields(spark, exp, cycles=range(50))
    write, calls = CellStore.write_region, []

    def failing(self, df, expected=None):
        calls.append(sorted(expected.blocks))
        if 39 in expected.blocks:
            raise RuntimeError("disk full")
        return write(self, df, expected)

    monkeypatch.setattr(CellStore, "write_region", failing)
    with pytest.raises(RuntimeError, match="disk full"):
        jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, store, wave=13)
    assert len(done(store, exp)) == 39 and max(map(len, calls)) == 13
    monkeypatch.undo()
    left = mf.todo(all_cycles(fields), jobs.done_cycles(store, exp.key), ["sim", "cycle"])
    assert left.count() == 11
    jobs.regrid_cycles(fields, left, exp, lambda _: GRID, store, wave=13)
    assert len(done(store, exp)) == 50


def test_ranges_of_numbers(spark):
    got = spark.range(20).filter(jobs.in_ranges("id", [3, 4, 5, 9, 11, 12, 4])).collect()
    assert [r.id for r in got] == [3, 4, 5, 9, 11, 12]
    assert spark.range(5).filter(jobs.in_ranges("id", [])).count() == 0
