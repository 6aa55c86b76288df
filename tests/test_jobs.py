"""The whole pipeline on small synthetic source fields with known answers."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orbgrid.functions.axes import GridAxis, LatLonGrid, PRESSURE_LEVELS_HPA, TimeAxis
from orbgrid.functions.healpix import npix
from orbgrid.operators.mapping import FieldMismatch, FieldRule, VariableSpec
from orbgrid.operators.quality import QualityError
from orbgrid.operators.regional import active_cells
from orbgrid.plans import config, jobs
from orbgrid.plans.config import Experiment, GroupSpec
from orbgrid.plans.queries_checks import stored_fields
from orbgrid.sources import manifest as mf
from orbgrid.sources.store import CellStore, cached_weights, dataset_metadata
from orbgrid.streaming.incremental import complete_in_stream, pending_cycles, record_arrivals

T0 = datetime(2020, 1, 20)
GRID = LatLonGrid(GridAxis(-90.0, 30.0, 7), GridAxis(0.0, 30.0, 12, cyclic=True))
# Winds sit half a grid step to the east.
STAGGERED = LatLonGrid(GridAxis(-90.0, 30.0, 7), GridAxis(15.0, 30.0, 12, cyclic=True))
WINDS = ("uas", "vas", "ua", "va")
N_CYCLES = 2


def short(exp: Experiment, zoom: int) -> Experiment:
    """The same variables on two cycles' worth of time and a small zoom."""
    groups = tuple(
        replace(g, axis=TimeAxis(T0, T0 + timedelta(hours=12 * N_CYCLES), g.axis.step)) for g in exp.groups
    )
    return replace(exp, max_zoom=zoom, groups=groups)


def grid_of(name):
    return STAGGERED if name in WINDS else GRID


def source_fields(spark, exp: Experiment, cycles=range(N_CYCLES), grids=grid_of):
    """Every field the experiment asks for; value = code + latitude (+ pressure)."""
    parts, seen = [], {}
    for g in exp.groups:
        rules = {(r, s.short) for s in g.specs for r in s.fields}
        if any(s.levels_to_pressure for s in g.specs):
            rules.add((config.MODEL_LEVEL_PRESSURE, "p"))
        for rule, var in sorted(rules, key=str):
            # Winds name their own grid; each field is written once per group.
            if (g.name, rule) in seen:
                continue
            seen[g.name, rule] = True
            hourly = g.store == "PT1H"
            n_steps = 12 if hourly else 4
            levels = {"2d": [None], "2d_depth": [0.1, 0.35], "3d": [500.0, 850.0], "3d_ml": [1.0, 2.0, 3.0]}[g.name]
            offset = 30 if rule.averaged else 2
            grid = grids(var)
            base = spark.range(len(cycles) * n_steps * len(levels) * grid.size)
            at = F.col("id") % grid.size
            rest = F.floor(F.col("id") / grid.size)
            lev = F.element_at(F.array(*[F.lit(x).cast("double") for x in levels]), (rest % len(levels)).cast("int") + 1)
            rest = F.floor(rest / len(levels))
            step, cyc = rest % n_steps, F.floor(rest / n_steps) + min(cycles)
            start = F.lit(T0).cast("timestamp_ntz")
            minutes = cyc * 720 + step * (60 if hourly else 180) + offset
            code = (len(rule.name or rule.stash or "")) % 7 + 1
            pressure = lev * 30000.0
            lat = F.lit(grid.lat.start) + grid.lat.step * F.floor(at / grid.lon.size)
            if rule is config.MODEL_LEVEL_PRESSURE:
                value = pressure
            elif g.name == "3d_ml":
                value = 1e6 + pressure + lat
            else:
                value = code + lat
            parts.append(
                base.select(
                    F.lit(exp.key).alias("sim"),
                    (start + F.make_dt_interval(hours=(cyc * 12).cast("int"))).cast("timestamp_ntz").alias("cycle"),
                    F.lit("a").alias("stream"),
                    F.lit(rule.name or "precipitation").alias("field_name"),
                    F.lit(rule.stash or "m01s00").alias("stash"),
                    (F.array(F.lit("mean")) if rule.averaged else F.array().cast("array<string>")).alias("cell_methods"),
                    F.array(*[F.lit(x) for x in g.dims]).alias("dims"),
                    F.lit("src").alias("units"),
                    (start + F.make_dt_interval(mins=minutes.cast("int"))).cast("timestamp_ntz").alias("time"),
                    lev.alias("level"),
                    lat.alias("lat"),
                    (F.lit(grid.lon.start) + grid.lon.step * (at % grid.lon.size)).alias("lon"),
                    value.cast("double").alias("value"),
                )
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def all_cycles(fields):
    return fields.select("sim", "cycle").distinct()


@pytest.fixture(scope="module")
def global_run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    exp = short(config.EXPERIMENTS["glm.n1280_CoMA9"], 2)
    source_fields(spark, exp).write.parquet(f"{root}/fields")
    fields = spark.read.parquet(f"{root}/fields")
    store = CellStore(spark, str(root))
    jobs.regrid_cycles(fields, all_cycles(fields), exp, grid_of, store)
    written = jobs.coarsen_all(store, exp)
    return exp, fields, store, written


def test_every_variable_is_complete(global_run):
    exp, _, store, _ = global_run
    counts = {
        (r.freq, r.variable): r.n
        for r in store.scan().filter("zoom = 2").groupBy("freq", "variable").agg(F.count("*").alias("n")).collect()
    }
    assert set(counts) == {(st, s.short) for st, s in exp.stored_specs()}
    hours, cells = 12 * N_CYCLES, npix(2)
    for (freq, name), n in counts.items():
        steps = hours if freq == "PT1H" else 4 * N_CYCLES
        levels = 2 if name in ("mrsol", "ua", "zg", "va", "hur", "hus", "ta", "wa") else 1
        if name in ("cli", "clw", "qg", "qr"):
            levels = len(PRESSURE_LEVELS_HPA)
        assert n == steps * levels * cells, (freq, name)


def test_values_are_mapped_and_regridded(global_run):
    _, _, store, _ = global_run
    for name, expected in (
        ("tas", len("air_temperature") % 7 + 1 + F.col("lat")),
        ("hflso", -(len("surface_upward_latent_heat_flux") % 7 + 1 + F.col("lat"))),
        ("clt", 100 * (len("cloud_area_fraction_assuming_maximum_random_overlap") % 7 + 1 + F.col("lat"))),
        ("uas", len("x_wind") % 7 + 1 + F.col("lat")),
        ("prs", len("stratiform_snowfall_flux") % 7 + 1 + F.col("lat")),
        ("pr", len("m01s05i216") % 7 + 1 + F.col("lat")),
    ):
        off = store.open("glm.n1280_CoMA9", "PT1H", 2, [name]).filter(F.abs(F.col("value") - expected) > 1e-2)
        assert off.count() == 0, name


def test_model_levels_reach_the_pressure_axis(global_run):
    _, _, store, _ = global_run
    clw = store.open("glm.n1280_CoMA9", "PT3H", 2, ["clw"])
    assert clw.filter(F.abs(F.col("value") - (1e6 + 100 * F.col("level") + F.col("lat"))) > 1).count() == 0
    levels = sorted(r.level for r in clw.select("level").distinct().collect())
    assert levels == [float(p) for p in PRESSURE_LEVELS_HPA]


def test_times_lie_on_the_axes(global_run):
    _, _, store, _ = global_run
    ends = {
        (r.variable): (r.a, r.b)
        for r in store.scan().filter("zoom = 2 and freq = 'PT1H'").groupBy("variable").agg(
            F.min("time").alias("a"), F.max("time").alias("b")
        ).collect()
    }
    assert ends["tas"] == (T0, T0 + timedelta(hours=23))
    assert ends["prs"] == (T0 + timedelta(hours=1), T0 + timedelta(hours=24))  # half past, shifted


def test_pyramid_keeps_the_domain_mean(global_run):
    _, _, store, written = global_run
    assert set(written) == {f"{d}_z{z}" for d in ("2d", "3d") for z in (0, 1)} and all(v == 1 for v in written.values())
    means = store.scan().filter("variable = 'tas'").groupBy("time", "zoom").agg(F.avg("value").alias("v"))
    spread = means.groupBy("time").agg(F.count("*").alias("n"), (F.max("v") - F.min("v")).alias("d")).collect()
    assert len(spread) == 24 and all(r.n == 3 and r.d < 1e-3 for r in spread)


def test_rerun_changes_nothing(global_run):
    exp, fields, store, _ = global_run
    state = store.scan().agg(F.count("*"), F.sum(F.xxhash64("time", "healpix_index", "value", "variable", "zoom") % 1000003)).first()
    jobs.regrid_cycles(fields, all_cycles(fields), exp, grid_of, store)
    assert set(jobs.coarsen_all(store, exp).values()) == {0}
    again = store.scan().agg(F.count("*"), F.sum(F.xxhash64("time", "healpix_index", "value", "variable", "zoom") % 1000003)).first()
    assert tuple(state) == tuple(again)


def test_region_report_flags_missing_cells(global_run, spark, tmp_path):
    exp, _, store, _ = global_run
    report = jobs.region_report(store, exp, "PT1H", 2)
    assert report.count() == 27 * N_CYCLES and report.filter("any_missing or all_missing").count() == 0
    part = one_group(max_zoom=2)
    holes = source_fields(spark, part).filter("lat < 60")
    jobs.regrid_cycles(holes, all_cycles(holes), part, lambda _: GRID, CellStore(spark, str(tmp_path)))
    got = jobs.region_report(CellStore(spark, str(tmp_path)), part, "PT1H", 2).collect()
    assert [r.any_missing for r in got] == [True] * N_CYCLES and not any(r.all_missing for r in got)


def test_only_the_folders_of_a_dataset_are_listed(global_run):
    exp, _, store, _ = global_run
    files = store.open(exp.key, "PT1H", 2, ["tas", "absent"]).inputFiles()
    assert files and all("/zoom=2/variable=tas/" in f for f in files)
    assert store.open("unknown", "PT1H", 2).count() == 0


def test_variable_catalog_is_written(global_run):
    exp, _, store, _ = global_run
    schema = (
        "variable_id string, standard_name string, long_name string, units string, source_names array<string>,"
        " attrs map<string,string>, sim string, freq string, `group` string"
    )
    got = {(r.freq, r.variable_id): r for r in store.read_table("variables", schema).collect()}
    assert len(got) == len(exp.stored_specs())
    assert got["PT1H", "clt"].units == "%" and got["PT1H", "tas"].units == "src"
    assert got["PT1H", "pr"].attrs["notes"] == "Uses instantaneous total precipitation"


def test_weights_are_cached_per_grid(global_run, spark):
    _, _, store, _ = global_run
    from orbgrid.sources.store import WEIGHT_SCHEMA

    keys = {r.grid_key for r in store.read_table("weights", WEIGHT_SCHEMA).select("grid_key").distinct().collect()}
    assert keys == {GRID.key, STAGGERED.key}
    assert cached_weights(store, GRID, 2).count() == npix(2)


def test_static_fields(global_run, spark):
    exp, _, store, _ = global_run
    pts = spark.range(GRID.size).select(
        (F.lit(-90.0) + 30.0 * F.floor(F.col("id") / 12)).alias("lat"), (30.0 * (F.col("id") % 12)).alias("lon")
    ).withColumns({"orog": 10 * F.col("lat"), "sftlf": F.lit(0.25)})
    jobs.static_fields(pts, GRID, exp, store)
    cells = store.open(exp.key, "PT1H", 1, ["tas"])
    out = jobs.with_static(cells, store, exp.key, 1)
    assert out.filter("orog is null or abs(sftlf - 25) > 1e-6").count() == 0


def test_absent_field_stops_the_job(global_run):
    exp, fields, store, _ = global_run
    cut = fields.filter("field_name <> 'surface_temperature'")
    with pytest.raises(FieldMismatch, match="ts"):
        jobs.regrid_cycles(cut, all_cycles(cut), exp, grid_of, CellStore(store.spark, store.root, "other"))


ONE = (VariableSpec("tas", "air_temperature", (FieldRule("air_temperature"),)),)


def one_group(regional=False, max_zoom=4, key="demo"):
    axis = TimeAxis(T0, T0 + timedelta(hours=24), timedelta(hours=1))
    group = GroupSpec("2d", "PT1H", axis, ("time", "latitude", "longitude"), ONE)
    return Experiment(key, max_zoom, (group,), regional=regional)


def test_times_off_the_axis_fail(spark, tmp_path):
    exp = one_group()
    fields = source_fields(spark, exp).withColumn("time", F.col("time") + F.make_dt_interval(mins=F.lit(9)))
    with pytest.raises(Exception, match="off the axis"):
        jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, CellStore(spark, str(tmp_path)))


def test_gaps_within_a_cycle_fail(spark, tmp_path):
    exp = one_group()
    fields = source_fields(spark, exp).filter(F.hour("time") != 5)
    with pytest.raises(QualityError, match="gaps"):
        jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, CellStore(spark, str(tmp_path)))


def test_surplus_first_step_is_dropped(spark, tmp_path):
    """Thirteen steps from midnight on, then twelve stamped at half past."""
    exp, store = one_group(), CellStore(spark, str(tmp_path))
    fields = source_fields(spark, exp).filter(F.col("cycle") == F.lit(T0).cast("timestamp_ntz"))
    half = fields.withColumn("time", F.date_trunc("hour", "time").cast("timestamp_ntz") + F.make_dt_interval(mins=F.lit(30)))
    extra = fields.filter(F.hour("time") == 0).withColumn("time", F.lit(T0).cast("timestamp_ntz"))
    both = half.union(extra)
    jobs.regrid_cycles(both, all_cycles(both), exp, lambda _: GRID, store)
    got = store.scan().agg(F.min("time"), F.max("time"), F.count_distinct("time")).first()
    assert tuple(got) == (T0 + timedelta(hours=1), T0 + timedelta(hours=12), 12)


def test_level_times_must_match(global_run):
    exp, fields, store, _ = global_run
    late = F.col("time") > F.lit(T0 + timedelta(hours=20)).cast("timestamp_ntz")
    early = F.col("time") < F.lit(T0 + timedelta(hours=2)).cast("timestamp_ntz")
    group = next(g for g in exp.groups if g.name == "3d_ml")
    steps = jobs.snap_time(fields.filter(group.constraint()).select(*jobs.SERIES, "time").distinct(), group.axis)
    # Surplus steps before the first pressure step don't count.
    assert jobs.steps_unlike_pressure(steps.filter(~((F.col("field_name") == "air_pressure") & early)), group).count() == 0
    bad = jobs.steps_unlike_pressure(steps.filter(~((F.col("field_name") == "air_pressure") & late)), group).collect()
    assert bad and all("times differ" in r.problem for r in bad)


def test_all_missing_is_not_marked_done(spark, tmp_path):
    exp, store = one_group(), CellStore(spark, str(tmp_path))
    fields = source_fields(spark, exp).withColumn("value", F.lit(None).cast("double"))
    with pytest.raises(QualityError):
        jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: GRID, store)
    assert jobs.done_cycles(store, exp.key).count() == 0


def test_regional_run_with_coverage(spark, tmp_path):
    area = LatLonGrid(GridAxis(-30.0, 5.0, 13), GridAxis(330.0, 5.0, 15), regional=True)
    exp, store = one_group(regional=True), CellStore(spark, str(tmp_path))
    fields = source_fields(spark, exp, grids=lambda _: area)
    jobs.save_extent(store, exp, area)
    jobs.regrid_cycles(fields, all_cycles(fields), exp, lambda _: area, store)
    jobs.coarsen_all(store, exp, ("2d",))
    top = store.scan().filter("zoom = 4").select("healpix_index").distinct()
    cover = store.read_table("coverage", jobs.COVERAGE_SCHEMA)
    want = {}
    for r in top.collect():
        want[r.healpix_index >> 2] = want.get(r.healpix_index >> 2, 0) + 0.25
    got = {r.healpix_index: r.weights for r in cover.filter("zoom = 3").collect()}
    assert got == want and 0 < min(got.values()) < 1
    assert cover.select("zoom").distinct().count() == 4
    for zoom in (3, 0):
        active = active_cells(spark, area.extent, zoom, config.space_chunk(zoom, True)).select("healpix_index")
        have = store.scan().filter(F.col("zoom") == zoom).select("healpix_index").distinct()
        assert have.count() and have.join(active, "healpix_index", "left_anti").count() == 0


def test_incomplete_cycles_wait(spark, tmp_path):
    exp, store = one_group(), CellStore(spark, str(tmp_path))
    cycles = [T0 + timedelta(hours=12 * k) for k in range(2)]
    data = [(exp.key, cycles[0], s) for s in "abcd"] + [(exp.key, cycles[1], s) for s in "abc"]
    arrivals = spark.createDataFrame(data, "sim string, cycle timestamp_ntz, stream string")
    record_arrivals(arrivals, 0, store)
    record_arrivals(arrivals, 0, store)  # a batch that is tried again
    assert [r.cycle for r in pending_cycles(store, exp.key).collect()] == [cycles[0]]
    record_arrivals(arrivals.limit(1).withColumn("stream", F.lit("d")).withColumn("cycle", F.lit(cycles[1]).cast("timestamp_ntz")), 1, store)
    assert pending_cycles(store, exp.key).count() == 2
    assert pending_cycles(store, exp.key, end=cycles[0]).count() == 1


def test_stream_reports_complete_cycles(spark, tmp_path):
    data = [("s", T0, x) for x in "abcda"] + [("s", T0 + timedelta(hours=12), x) for x in "abc"]
    data += [("s", T0 + timedelta(days=30), "a")]  # moves the watermark past both
    df = spark.createDataFrame(data, "sim string, cycle_time timestamp, stream string")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    q = complete_in_stream(stream, 4).writeStream.format("memory").queryName("whole").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = [(r.sim, r.cycle_time, r.n_streams) for r in spark.table("whole").collect()]
    assert got == [("s", T0, 4)]


def test_files_of_complete_cycles(spark, tmp_path):
    for stream in "abcd":
        for stamp in ("20200120T00", "20200120T12"):
            if (stream, stamp) != ("d", "20200120T12"):
                folder = tmp_path / f"apve{stream}"
                folder.mkdir(exist_ok=True)
                (folder / f"run.apver{stream}_{stamp}.pp").write_text("x")
    (tmp_path / "apvea" / "run.apvere_20200120T12.pp").write_text("x")
    (tmp_path / "apvea" / "notes.txt").write_text("x")
    files = mf.file_cycles(mf.list_files(spark, str(tmp_path)))
    got = mf.complete_files(files, 4).collect()
    assert len(got) == 1 and got[0].cycle == T0 and len(got[0].paths) == 4


def test_metadata_merges_last_wins(spark):
    sets = spark.createDataFrame([("s", "PT1H", 3, {"regional": "maybe", "simulation": "s"})], "sim string, freq string, zoom int, config map<string,string>")
    row = dataset_metadata(sets, False, {"simulation": "shared"}).first()
    assert row.attrs["regional"] == "maybe" and row.attrs["simulation"] == "shared"
    assert row.attrs["Conventions"] == "CF-1.13" and "'upper_right_lon': 360" in row.attrs["regional_bounds"]
    assert row.crs["healpix_nside"] == "8" and row.crs["refinement_level"] == "3"


def test_source_blocks_cover_their_chunk():
    exp = config.EXPERIMENTS["glm.n1280_CoMA9"]
    for zoom in range(8, -1, -1):
        size = config.work_chunk(zoom)
        for chunk in (0, 1, 7):
            lo, hi = jobs._source_blocks(chunk, zoom, exp, 1)
            if zoom == 8:
                assert lo * 12 <= chunk * size and (hi + 1) * 12 >= (chunk + 1) * size
            else:
                finer = config.work_chunk(zoom + 1)
                assert lo * finer <= chunk * size and (hi + 1) * finer >= (chunk + 1) * size


def test_total_chunks_counts_both_stores():
    exp = config.EXPERIMENTS["glm.n1280_CoMA9"]
    want = sum(-(-n // config.work_chunk(z)) for n in (9745, 3249) for z in range(9))
    assert jobs.total_chunks(exp) == want


def test_source_fields_are_stored_once_in_few_files(spark, tmp_path):
    """However many tasks make the fields, each cycle is one file, and later steps read those alone."""
    start = datetime(2020, 1, 20)
    rows = [("demo", start + timedelta(hours=12 * (k % 3)), float(k)) for k in range(600)]
    many = spark.createDataFrame(rows, "sim string, cycle timestamp_ntz, value double").repartition(40)
    out = stored_fields(many, str(tmp_path))
    files = out.inputFiles()
    assert len(files) == 3 and all(str(tmp_path) in f for f in files)
    assert sorted(tuple(r) for r in out.select("sim", "cycle", "value").collect()) == sorted(rows)
