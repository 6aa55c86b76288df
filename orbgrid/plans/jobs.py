"""The batch jobs: regrid input cycles, then coarsen the pyramid.

Both work on whatever has arrived, skip what is done, and may be run again at
any time: regions are replaced as a whole and marked done only afterwards.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import replace
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbgrid.functions.axes import PRESSURE_LEVELS_HPA, LatLonGrid, TimeAxis, hpa_to_pa
from orbgrid.functions.healpix import npix
from orbgrid.operators.cover import Extent
from orbgrid.operators.joins import attach
from orbgrid.operators.mapping import (
    FieldMismatch,
    FieldRule,
    VariableSpec,
    count_matches,
    inventory,
    map_variables,
    mismatch_text,
    variable_catalog,
)
from orbgrid.operators.pyramid import at_first_step, coarsen, coverage_weights
from orbgrid.operators.quality import QualityError
from orbgrid.operators.regional import active_cells, gather_regional
from orbgrid.operators.regrid import apply_weights, regrid
from orbgrid.operators.timeline import settle_times, snap_time
from orbgrid.operators.vertical import interpolate_levels
from orbgrid.plans.config import MODEL_LEVEL_PRESSURE, Experiment, GroupSpec, space_chunk, work_chunk
from orbgrid.sources import ledger
from orbgrid.sources.manifest import coverage_gate
from orbgrid.sources.store import CellStore, Region, cached_weights, dataset_metadata

DONE_SCHEMA = "cycle timestamp_ntz, part string, at bigint, task string, sim string"
CYCLE_HOURS = 12
#: Cycles, and time chunks of a coarser zoom, that one write takes up and marks done.
WAVE_CYCLES, WAVE_CHUNKS = 8, 32
DIMS_STORE = {"2d": "PT1H", "3d": "PT3H"}


# --- bookkeeping -------------------------------------------------------------


def done_cycles(store: CellStore, sim: str) -> DataFrame:
    """Cycles that were regridded and not reopened since."""
    rows = store.read_table("done", DONE_SCHEMA).filter((F.col("sim") == sim) & F.col("task").isin("regrid", "reopen"))
    at = F.coalesce("at", F.lit(0).cast("bigint"))
    last = [F.max(F.when(F.col("task") == t, at)).alias(t) for t in ("regrid", "reopen")]
    both = rows.groupBy("sim", "cycle").agg(*last)
    return both.filter("regrid is not null and (reopen is null or regrid > reopen)").select("sim", "cycle")


def mark_done(store: CellStore, task: str, sim: str, rows: DataFrame, part: str) -> None:
    """``rows`` holds ``cycle`` (or nothing of interest) and a ``part`` column; one file for all of them.

    ``at`` tells later calls from earlier ones, by the clock of the driver.
    """
    at = F.lit(time.time_ns()).cast("bigint")
    out = rows.select(F.col("cycle"), F.col(part).alias("part"), at.alias("at"), F.lit(task).alias("task"), F.lit(sim).alias("sim"))
    store.append_table(out, "done", ["task", "sim"])


def _mark_cycles(store: CellStore, task: str, sim: str, cycles: list) -> None:
    if cycles:
        rows = [(c, c.strftime("%Y%m%dT%H")) for c in cycles]
        mark_done(store, task, sim, store.spark.createDataFrame(rows, "cycle timestamp_ntz, p string"), "p")


def reopen_cycles(store: CellStore, experiment: Experiment, cycles: list) -> None:
    """Have cycles done again: they count as pending, and what depends on them is made again after them."""
    _mark_cycles(store, "reopen", experiment.key, sorted(cycles))


# --- regridding --------------------------------------------------------------


SERIES = ["sim", "cycle", "field_name", "stash", "cell_methods"]


def group_rules(group: GroupSpec) -> list[FieldRule]:
    """Source fields a group reads."""
    rules = [r for s in group.specs for r in s.fields]
    if any(s.levels_to_pressure for s in group.specs):
        rules.append(MODEL_LEVEL_PRESSURE)
    return rules


def group_fields(
    fields: DataFrame, group: GroupSpec, max_series: int | None = None, tolerance_minutes: float = 5.0
) -> DataFrame:
    """Source rows of a group with their place on its time axis (``time_idx``).

    Times are settled on the source rows, before anything is combined or
    interpolated; a time that fits no stamp of the axis fails the job.
    """
    wanted = reduce(lambda a, b: a | b, [r.predicate() for r in group_rules(group)])
    mine = settle_times(fields.filter(group.constraint() & wanted), SERIES, max_series=max_series)
    snapped = snap_time(mine, group.axis, tolerance_minutes)
    idx = F.when(F.col("on_axis"), F.col("time_idx")).otherwise(
        F.raise_error(F.concat(F.lit("source time off the axis: "), F.col("time").cast("string")))
    )
    return snapped.withColumn("time_idx", idx.cast("bigint")).drop("time", "snapped", "on_axis")


def steps_off_axis(steps: DataFrame) -> DataFrame:
    """``cycle, problem`` of fields with times that fit no stamp."""
    off = steps.filter(~F.col("on_axis")).groupBy("cycle").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("field_name", "time")).alias("f")
    )
    text = F.format_string("%d source times off the axis, such as %s of %s", "n", F.col("f.time").cast("string"), F.col("f.field_name"))
    return off.select("cycle", text.alias("problem"))


def steps_with_gaps(steps: DataFrame) -> DataFrame:
    """``cycle, problem`` where the steps of a field don't follow each other without a gap."""
    per_field = steps.groupBy(*SERIES).agg(
        F.count_distinct("time_idx").alias("n"), F.min("time_idx").alias("a"), F.max("time_idx").alias("b")
    )
    bad = per_field.filter(F.col("n") != F.col("b") - F.col("a") + 1).groupBy("cycle").agg(
        F.count(F.lit(1)).alias("n"), F.min("field_name").alias("f")
    )
    return bad.select("cycle", F.format_string("source times of %d fields have gaps, such as %s", "n", "f").alias("problem"))


def steps_unlike_pressure(steps: DataFrame, group: GroupSpec) -> DataFrame:
    """``cycle, problem`` where model-level variables don't have the times of the pressure field.

    Steps of a variable before the first one of pressure are surplus and are
    not counted.
    """
    there = [F.max(s.fields[0].predicate()).alias(s.short) for s in group.specs]
    marked = steps.groupBy("sim", "cycle", "time_idx").agg(F.max(MODEL_LEVEL_PRESSURE.predicate()).alias("_p"), *there)
    first = marked.filter("_p").groupBy("sim", "cycle").agg(F.min("time_idx").alias("_t0"))
    checked = marked.join(first, ["sim", "cycle"], "left").filter(
        F.col("_t0").isNull() | (F.col("time_idx") >= F.col("_t0"))
    )
    wrong = reduce(lambda a, b: a | b, [F.col(s.short) != F.col("_p") for s in group.specs])
    bad = checked.filter(wrong).groupBy("cycle").agg(F.count(F.lit(1)).alias("n"))
    return bad.select("cycle", F.format_string("model-level and pressure times differ at %d steps", "n").alias("problem"))


def group_problems(
    fields: DataFrame, group: GroupSpec, cycles: list, max_series: int | None = None, tolerance_minutes: float = 5.0
) -> tuple[dict, dict]:
    """What is wrong with each cycle of a group: of its fields, and of their times.

    Every operand must match exactly one field in every cycle by itself.  All
    time checks look at the distinct steps only.  What comes to the driver is
    one text for a cycle and check.
    """
    mine = fields.filter(group.constraint())
    counts = count_matches(inventory(mine, ["sim", "cycle"]), group.specs, ["sim", "cycle"]).collect()
    present = {r.cycle for r in counts}
    unmatched: dict = {c: f"no fields of group {group.name}" for c in cycles if c not in present}
    for r in counts:
        if r.n_matches != 1:
            unmatched[r.cycle] = "; ".join(filter(None, [unmatched.get(r.cycle), mismatch_text(r)]))
    wanted = reduce(lambda a, b: a | b, [r.predicate() for r in group_rules(group)])
    distinct = mine.filter(wanted).select(*SERIES, "time").distinct()
    steps = snap_time(settle_times(distinct, SERIES, max_series=max_series), group.axis, tolerance_minutes).persist()
    checks = [steps_off_axis(steps), steps_with_gaps(steps.filter("on_axis"))]
    if any(s.levels_to_pressure for s in group.specs):
        checks.append(steps_unlike_pressure(steps.filter("on_axis"), group))
    mistimed: dict = {}
    for r in reduce(DataFrame.unionByName, checks).collect():
        mistimed[r.cycle] = "; ".join(filter(None, [mistimed.get(r.cycle), r.problem]))
    steps.unpersist()
    return unmatched, mistimed


def on_pressure_levels(source: DataFrame, group: GroupSpec, keys: list[str]) -> DataFrame:
    """Model-level variables of a group on the pressure axis.

    Values and pressure meet in one aggregation per grid point and level; the
    vertical step then finds its columns already in place.
    """
    names = [s.short for s in group.specs]
    column = [k for k in keys if k != "level"]
    picked = [F.max(F.when(s.fields[0].predicate(), F.col("value"))).alias(s.short) for s in group.specs]
    pressure = F.max(F.when(MODEL_LEVEL_PRESSURE.predicate(), F.col("value"))).alias("p")
    points = source.repartition(*column).groupBy(*column, "level").agg(pressure, *picked)
    targets = [p * 100.0 for p in PRESSURE_LEVELS_HPA]
    wide = interpolate_levels(points, column, "p", names, targets, level="level", clamp=True, long_column=None)
    pairs = F.array(*[F.struct(F.lit(n).alias("variable"), F.col(n).alias("value")) for n in names])
    return wide.select(*column, (F.col("level") / hpa_to_pa(F.lit(1))).alias("level"), F.inline(pairs))


def regrid_group(
    fields: DataFrame,
    group: GroupSpec,
    experiment: Experiment,
    grid_of: Callable[[str], LatLonGrid],
    store: CellStore,
    max_series: int | None = None,
) -> DataFrame:
    """Cells of all variables of a group at the top zoom, ready for the store.

    ``grid_of`` names the grid of a variable, as winds sit on staggered ones.
    """
    by_grid: dict[LatLonGrid, list[VariableSpec]] = {}
    for s in group.specs:
        by_grid.setdefault(grid_of(s.short), []).append(s)
    zoom = experiment.max_zoom
    keys = ["sim", "cycle", "time_idx", "level", "lat", "lon"]
    out_keys = ["sim", "cycle", "variable", "time_idx", "level"]
    parts = []
    for grid, specs in by_grid.items():
        # Each grid reads only the fields of its own variables.
        mine = replace(group, specs=tuple(specs))
        source = group_fields(fields, mine, max_series)
        if any(s.levels_to_pressure for s in specs):
            long = on_pressure_levels(source, mine, keys)
        else:
            long = map_variables(source, specs, keys)
        weights = cached_weights(store, grid, zoom)
        field = grid.with_src_id(long)
        steps = int(CYCLE_HOURS * 3600 // group.axis.step.total_seconds())
        levels = len(PRESSURE_LEVELS_HPA) if group.store == "PT3H" else 1
        rows = None if max_series is None else max_series * steps * levels * grid.size
        parts.append(apply_weights(field, weights, grid, npix(zoom), out_keys, ["value"], pack="time_idx", rows=rows))
    start = F.lit(group.axis.start).cast("timestamp_ntz")
    hours = F.timestamp_diff("HOUR", start, F.col("cycle"))
    return reduce(DataFrame.unionByName, parts).withColumns(
        {
            "time": group.axis.stamp_at("time_idx"),
            "freq": F.lit(group.store),
            "zoom": F.lit(zoom),
            "block": F.floor(hours / F.lit(float(CYCLE_HOURS))).cast("bigint"),
        }
    )


REJECTED_SCHEMA = "problem string, sim string, cycle timestamp_ntz"


def _cycle_block(group: GroupSpec, cycle) -> int:
    return int((cycle - group.axis.start).total_seconds() // 3600) // CYCLE_HOURS


def regrid_cycles(
    fields: DataFrame,
    cycles: DataFrame,
    experiment: Experiment,
    grid_of: Callable[[str], LatLonGrid],
    store: CellStore,
    strict: bool = True,
    wave: int = WAVE_CYCLES,
) -> None:
    """Regrid the given cycles of one experiment and mark them done, ``wave`` at a time.

    ``fields`` is the long source-field table partitioned by ``sim, cycle``;
    ``cycles`` holds ``sim, cycle``, at most one row per cycle.  Each wave is
    written, counted and marked done by itself: a failure keeps the waves
    before it, and no plan grows with the backlog.

    Cycles with unmatched fields, bad times or a variable without any value
    are set aside in the table ``rejected`` with the reason; the others go on
    and are marked done.  They stay (or become) pending, so that mended input
    is taken up by a later call; their row goes once they are done.  With
    ``strict`` the call raises in the end.  Cycles that were done before are
    replaced, and ``coarsen_zoom`` makes again what they are part of.
    """
    todo = sorted(
        r.cycle for r in cycles.filter(F.col("sim") == experiment.key).select("cycle").distinct().collect()
    )
    problems: dict = {}
    unmatched = False
    for at in range(0, len(todo), wave):
        some, odd = _regrid_wave(fields, todo[at : at + wave], experiment, grid_of, store)
        problems |= some
        unmatched = unmatched or odd
    if problems and strict:
        first = min(problems)
        kind = FieldMismatch if unmatched else QualityError
        raise kind(f"{len(problems)} of {len(todo)} cycles rejected; {first}: {problems[first]}")


def _regrid_wave(
    fields: DataFrame, todo: list, experiment: Experiment, grid_of: Callable[[str], LatLonGrid], store: CellStore
) -> tuple[dict, bool]:
    """One wave; what is wrong with its cycles, and whether that is unmatched fields."""
    sim = experiment.key

    def of(wanted: list) -> DataFrame:
        # At most as many as a wave.
        return fields.filter((F.col("sim") == sim) & F.col("cycle").isin([F.lit(c).cast("timestamp_ntz") for c in wanted]))

    unmatched: dict = {}
    mistimed: dict = {}
    for group in experiment.groups:
        # Fields x cycles bounds the series whose times are settled.
        for whole, found in zip((unmatched, mistimed), group_problems(of(todo), group, todo)):
            for c, text in found.items():
                whole[c] = "; ".join(filter(None, [whole.get(c), text]))
    good = [c for c in todo if c not in unmatched and c not in mistimed]
    empty: dict = {}
    versions: dict[str, dict[int, int]] = {}
    if good:
        mine = of(good)
        for group in experiment.groups:
            inv = inventory(mine.filter(group.constraint()), ["sim"]).persist()
            at = {c: _cycle_block(group, c) for c in good}
            names = [s.short for s in group.specs]
            region = Region(sim, group.store, experiment.max_zoom, names, set(at.values()))
            written = store.write_region(regrid_group(mine, group, experiment, grid_of, store, inv.count() * len(good)), region)
            there = versions.setdefault(group.store, {})
            for block, digest in written.digests.items():
                there[block] = there.get(block, 0) ^ digest
            for c in good:
                gone = [n for n in names if (n, at[c]) not in written.parts]
                if gone:
                    text = "all values missing: " + ", ".join(gone)
                    empty[c] = "; ".join(filter(None, [empty.get(c), text]))
            catalog = variable_catalog(inv, group.specs, ["sim"])
            store.write_table(
                catalog.withColumns({"freq": F.lit(group.store), "group": F.lit(group.name)}),
                "variables",
                ["sim", "freq", "group"],
            )
            inv.unpersist()
    for freq, there in versions.items():
        ledger.record(store, sim, freq, experiment.max_zoom, there)
    done = [c for c in good if c not in empty]
    _mark_cycles(store, "regrid", sim, done)
    problems = {
        c: "; ".join(filter(None, [unmatched.get(c), mistimed.get(c), empty.get(c)])) for c in todo if c not in done
    }
    if problems:
        # One that lost its values is not done any more.
        before = {r.cycle for r in done_cycles(store, sim).collect()} if empty else set()
        _mark_cycles(store, "reopen", sim, [c for c in empty if c in before])
        rows = [(text, sim, c) for c, text in problems.items()]
        store.write_table(store.spark.createDataFrame(rows, REJECTED_SCHEMA), "rejected", ["sim", "cycle"])
    for c in done:
        store.remove_rows("rejected", {"sim": sim, "cycle": c})
    return problems, bool(unmatched)


def region_report(store: CellStore, experiment: Experiment, freq: str, zoom: int) -> DataFrame:
    """Per variable and block: values stored, and whether any or all cells are missing.

    The expected number is steps x levels found x cells of the zoom; regional
    datasets, which hold active cells only, are expected to miss some.
    """
    found = store.scan(experiment.key, freq, zoom).groupBy("variable", "block").agg(
        F.count("value").alias("n_values"),
        F.count_distinct("time", F.coalesce("level", F.lit(0.0))).alias("n_fields"),
    )
    expected = F.col("n_fields") * npix(zoom)
    return found.withColumns(
        {"all_missing": F.col("n_values") == 0, "any_missing": F.col("n_values") < expected}
    )


STATIC_SCHEMA = "healpix_index bigint, orog double, sftlf double, sim string, zoom int"


def static_fields(
    static: DataFrame, grid: LatLonGrid, experiment: Experiment, store: CellStore
) -> None:
    """Terrain height and land share at every zoom, kept beside the cells.

    ``static`` holds ``lat, lon, orog, sftlf`` with the land share as fraction.
    Each zoom is stored before the next one reads it.
    """
    percent = static.withColumn("sftlf", F.col("sftlf") * 100)
    weights = cached_weights(store, grid, experiment.max_zoom)
    top = regrid(percent, grid, experiment.max_zoom, [], ["orog", "sftlf"], weights=weights)
    zoom, level = experiment.max_zoom, top
    while True:
        named = level.withColumns({"sim": F.lit(experiment.key), "zoom": F.lit(zoom)})
        store.write_table(named, "static", ["sim", "zoom"])
        if zoom == 0:
            return
        stored = store.read_table("static", STATIC_SCHEMA)
        stored = stored.filter((F.col("sim") == experiment.key) & (F.col("zoom") == zoom)).drop("sim", "zoom")
        level, zoom = coarsen(stored, [], ["orog", "sftlf"]), zoom - 1


def with_static(cells: DataFrame, store: CellStore, sim: str, zoom: int) -> DataFrame:
    """Attach terrain height and land share to cells of a zoom."""
    static = store.read_table("static", STATIC_SCHEMA).filter((F.col("sim") == sim) & (F.col("zoom") == zoom))
    return attach(cells, static.drop("sim", "zoom"), ["healpix_index"], "left", max_rows=npix(zoom), row_bytes=32)


def with_coverage(cells: DataFrame, store: CellStore, sim: str, freq: str, zoom: int) -> DataFrame:
    """Attach the coverage weights of a dataset to its cells; 1 at the top zoom, which has none."""
    mine = (F.col("sim") == sim) & (F.col("freq") == freq) & (F.col("zoom") == zoom)
    weights = store.read_table("coverage", COVERAGE_SCHEMA).filter(mine).select("healpix_index", "weights")
    out = attach(cells, weights, ["healpix_index"], "left", max_rows=npix(zoom), row_bytes=32)
    return out.withColumn("weights", F.coalesce("weights", F.lit(1.0)))


METADATA_SCHEMA = "attrs map<string,string>, crs map<string,string>, sim string, freq string, zoom int"


def create_dataset(
    store: CellStore,
    experiment: Experiment,
    grid_of: Callable[[str], LatLonGrid],
    static: DataFrame | None = None,
    shared: dict[str, str] | None = None,
) -> None:
    """What a dataset needs before its first cycle: extent, attributes of every zoom, static fields.

    Bounds and extent are those of the grid of the first variable, which is
    also the grid of ``static``.  May be called again; parts are replaced.
    """
    grid = grid_of(experiment.groups[0].specs[0].short)
    if experiment.regional:
        save_extent(store, experiment, grid)
    west, east, south, north = map(float, grid.extent)
    bounds = {
        "lower_left_lat": round(south, 3), "lower_left_lon": round(west % 360.0, 3),
        "upper_right_lat": round(north, 3), "upper_right_lon": round(east % 360.0, 3),
    }
    rows = [
        (experiment.key, freq, zoom, dict(experiment.metadata), str(bounds))
        for freq in dict.fromkeys(g.store for g in experiment.groups)
        for zoom in range(experiment.max_zoom + 1)
    ]
    sets = store.spark.createDataFrame(
        rows, "sim string, freq string, zoom int, config map<string,string>, bounds string"
    )
    meta = dataset_metadata(sets, experiment.regional, shared or {})
    store.write_table(meta.select("attrs", "crs", "sim", "freq", "zoom"), "metadata", ["sim", "freq", "zoom"])
    if static is not None:
        static_fields(static, grid, experiment, store)


def is_created(store: CellStore, experiment: Experiment) -> bool:
    return not store.read_table("metadata", METADATA_SCHEMA).filter(F.col("sim") == experiment.key).isEmpty()


# --- reading -----------------------------------------------------------------


def open_dataset(
    store: CellStore,
    experiment: Experiment,
    freq: str,
    zoom: int,
    variables: list[str] | None = None,
    extent: Extent | None = None,
    time: tuple[datetime | None, datetime | None] | None = None,
    signed_lon: bool = False,
) -> DataFrame:
    """``CellStore.open`` with only the folders that can hold the times; times are half open."""
    blocks = None
    if time is not None:
        axis = next(g.axis for g in experiment.groups if g.store == freq)
        blocks = _blocks_of(time, axis, zoom, experiment)
    return store.open(experiment.key, freq, zoom, variables, signed_lon, extent, time, blocks)


def _blocks_of(time, axis: TimeAxis, zoom: int, experiment: Experiment) -> tuple[int, int]:
    """First and last block of a zoom that can hold times in a half-open range."""
    first, before = time
    top = zoom == experiment.max_zoom
    width = timedelta(hours=CYCLE_HOURS) if top else axis.step * work_chunk(zoom, experiment.regional)
    low = 0 if first is None else (first - axis.start) // width
    high = (1 << 62) if before is None else (before - axis.start) // width
    # A cycle may hold the stamp that its successor starts with; a step is half a step around its stamp.
    return low - 1, high + 1


# --- coarsening --------------------------------------------------------------


def _done_parts(store: CellStore, task: str, sim: str) -> set[int]:
    """Chunks of a coarsening task that are done; at most one per step of the axis."""
    done = store.read_table("done", DONE_SCHEMA).filter((F.col("task") == task) & (F.col("sim") == sim))
    return {int(r.part) for r in done.select("part").collect()}


def _source_blocks(chunk: int, zoom: int, experiment: Experiment, step_hours: int) -> tuple[int, int]:
    """First and last block one zoom up that can hold steps of a time chunk."""
    size = work_chunk(zoom, experiment.regional)
    first, last = chunk * size, (chunk + 1) * size - 1
    if zoom + 1 == experiment.max_zoom:
        # A cycle may hold the stamp of the hour its successor starts with.
        return max(0, first * step_hours // CYCLE_HOURS - 1), last * step_hours // CYCLE_HOURS
    finer = work_chunk(zoom + 1, experiment.regional)
    return first // finer, last // finer


def in_ranges(column: str, numbers: Iterable[int]) -> Column:
    """Whether a column is one of the numbers, as ranges of consecutive ones."""
    ranges: list[list[int]] = []
    for n in sorted(set(numbers)):
        if ranges and n == ranges[-1][1] + 1:
            ranges[-1][1] = n
        else:
            ranges.append([n, n])
    return reduce(lambda a, b: a | b, [F.col(column).between(lo, hi) for lo, hi in ranges], F.lit(False))


def coarsen_zoom(
    store: CellStore, experiment: Experiment, dim: str, zoom: int, end=None, wave: int = WAVE_CHUNKS
) -> int:
    """Coarsen to ``zoom`` every time chunk that became complete or out of date; returns how many.

    Right below the top a chunk waits for all cycles that it touches and for
    the one before its first stamp; further down for all chunks of the finer
    zoom that it is made of.  A chunk is made again when a cycle or finer chunk
    that it was made of has been written since.  ``end`` leaves out cycles
    after that time.  Chunks are written and marked done ``wave`` at a time.
    """
    spark, sim, freq = store.spark, experiment.key, DIMS_STORE[dim]
    axis = next(g.axis for g in experiment.groups if g.store == freq)
    size = work_chunk(zoom, experiment.regional)
    task = f"coarsen_{dim}_z{zoom}"
    cycles = done_cycles(store, sim)
    if end is not None:
        cycles = cycles.filter(F.col("cycle") <= F.lit(end).cast("timestamp_ntz"))
    gate = coverage_gate(
        spark.createDataFrame([(sim,)], "sim string"), cycles, axis, size, CYCLE_HOURS, preceding=True
    ).filter("runnable")
    chunks = sorted(r.chunk for r in gate.select("chunk").collect())  # at most one per step of the axis
    if zoom + 1 < experiment.max_zoom:
        finer, size_there = _done_parts(store, f"coarsen_{dim}_z{zoom + 1}", sim), work_chunk(zoom + 1, experiment.regional)
        last = (axis.size - 2) // size_there
        chunks = [
            c
            for c in chunks
            if all(k in finer for k in range(c * size // size_there, min(((c + 1) * size - 1) // size_there, last) + 1))
        ]
    step_hours = int(axis.step.total_seconds() // 3600)
    spans = {c: _source_blocks(c, zoom, experiment, step_hours) for c in chunks}
    due = ledger.outdated(store, sim, freq, zoom, [(c, lo, hi) for c, (lo, hi) in spans.items()])
    names = [s.short for name, s in experiment.stored_specs() if name == freq]
    active = None
    if due and experiment.regional:
        extent = store.read_table("extent", EXTENT_SCHEMA).filter(F.col("sim") == sim).first()
        if extent is None:
            raise ValueError(f"{sim} has no extent; create_dataset stores it")
        active = active_cells(spark, tuple(extent[:4]), zoom, space_chunk(zoom, True))
    listed = sorted(due)
    for at in range(0, len(listed), wave):
        some = listed[at : at + wave]
        blocks = {b for c in some for b in range(spans[c][0], spans[c][1] + 1)}
        source = store.scan(sim, freq, zoom + 1).filter(in_ranges("block", blocks))
        chunk = F.floor(axis.nearest_index("time") / F.lit(float(size))).cast("bigint")
        source = source.withColumn("block", chunk).filter(in_ranges("block", some))
        coarse = coarsen(source, ["sim", "freq", "variable", "block", "time", "level"], ["value"])
        if active is not None:
            coarse = gather_regional(coarse, active, zoom)
        written = store.write_region(coarse.withColumn("zoom", F.lit(zoom)), Region(sim, freq, zoom, names, some))
        if experiment.regional and 0 in some:
            _write_coverage(store, experiment, freq, zoom)
        ledger.record(store, sim, freq, zoom, written.digests, due)
        rows = spark.createDataFrame(
            [(axis.start + axis.step * (c * size), str(c)) for c in some], "cycle timestamp_ntz, p string"
        )
        mark_done(store, task, sim, rows, "p")
    return len(listed)


EXTENT_SCHEMA = "west double, east double, south double, north double, sim string"
COVERAGE_SCHEMA = "healpix_index bigint, weights double, sim string, freq string, zoom int"


def save_extent(store: CellStore, experiment: Experiment, grid: LatLonGrid) -> None:
    row = store.spark.createDataFrame([(*map(float, grid.extent), experiment.key)], EXTENT_SCHEMA)
    store.write_table(row, "extent", ["sim"])


def _write_coverage(store: CellStore, experiment: Experiment, freq: str, zoom: int) -> None:
    """Coverage weights of a zoom, from the first step of the first variable."""
    spec = next(s for name, s in experiment.stored_specs() if name == freq)
    mine = (F.col("sim") == experiment.key) & (F.col("freq") == freq)
    if zoom == experiment.max_zoom - 1:
        top = store.scan(experiment.key, freq, zoom + 1, [spec.short])
        block = top.agg(F.min("block")).first()[0]  # partition values: no cell is read for it
        top = top.filter(F.col("block") == block)
        first = at_first_step(at_first_step(top), "level") if freq == "PT3H" else at_first_step(top)
        out = coverage_weights(first, "value")
    else:
        finer = store.read_table("coverage", COVERAGE_SCHEMA).filter(mine & (F.col("zoom") == zoom + 1))
        out = coarsen(finer, [], ["weights"])
    out = out.withColumns({"sim": F.lit(experiment.key), "freq": F.lit(freq), "zoom": F.lit(zoom)})
    store.write_table(out, "coverage", ["sim", "freq", "zoom"])


def coarsen_all(
    store: CellStore, experiment: Experiment, dims: tuple[str, ...] = ("2d", "3d"), end=None
) -> dict[str, int]:
    """All zooms of the pyramid; each is written before the next reads it."""
    written = {}
    for dim in dims:
        for zoom in range(experiment.max_zoom - 1, -1, -1):
            written[f"{dim}_z{zoom}"] = coarsen_zoom(store, experiment, dim, zoom, end)
    return written


def total_chunks(experiment: Experiment) -> int:
    """Time chunks of all coarser zooms of both stores."""
    total = 0
    for freq in DIMS_STORE.values():
        axis = next((g.axis for g in experiment.groups if g.store == freq), None)
        if axis is not None:
            total += sum(-(-axis.size // work_chunk(z, experiment.regional)) for z in range(experiment.max_zoom))
    return total
