"""Queries on completeness, data quality, reports and the cell store."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.functions.axes import TimeAxis, floor_hours
from orbgrid.functions.healpix import npix, parent
from orbgrid.operators import pyramid as pyr
from orbgrid.operators import quality as ql
from orbgrid.operators import reports as rp
from orbgrid.operators.mapping import FieldRule, VariableSpec, drop_unused, has_dims, inventory, override
from orbgrid.operators.timeline import first_steps, snapshot
from orbgrid.plans.config import Experiment, GroupSpec
from orbgrid.plans.inputs import (
    ARRIVALS_SQL,
    CELLS_SQL,
    GRID,
    MONTH_AXIS,
    SOURCES_SQL,
    ZOOM,
    arrivals,
    cells,
    day,
    latlon_sql,
    sources,
    src_id_sql,
    table,
    weights_sql,
)
from orbgrid.plans.jobs import coarsen_all, coarsen_zoom, regrid_cycles, reopen_cycles
from orbgrid.plans.queries_grid import _chain_sql, r6
from orbgrid.plans.queries_time import DEMO_SPECS
from orbgrid.plans.registry import register
from orbgrid.session import scratch_root
from orbgrid.sources import manifest as mf
from orbgrid.sources.store import CellStore, dataset_metadata, for_consumers, read_report, write_report
from orbgrid.streaming.incremental import complete_in_stream, run_available

NPIX = npix(ZOOM)
_K = '"time", variable,'
STREAMS = 5

# --- arrivals and gates ------------------------------------------------------


@register(
    f"""WITH {ARRIVALS_SQL} SELECT sim, cycle, count(DISTINCT stream) AS n_streams, count(DISTINCT stream) = 5 AS complete FROM man GROUP BY ALL"""
)
def cycle_completeness(spark: SparkSession, d: str) -> DataFrame:
    return mf.cycle_status(arrivals(spark, d), STREAMS, ["sim", "cycle"])


_COMPLETE_SQL = "comp AS (SELECT sim, cycle FROM man GROUP BY ALL HAVING count(DISTINCT stream) = 5)"
_DONE_SQL = """done AS (SELECT DISTINCT 'sim' || (user_id % 29) AS sim,
  time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2000-01-01')::TIMESTAMP AS cycle FROM events WHERE value > 150)"""


def _done(spark: SparkSession, d: str) -> DataFrame:
    return (
        table(spark, d, "events")
        .filter(F.col("value") > 150)
        .select(
            F.concat(F.lit("sim"), (F.col("user_id") % 29).cast("string")).alias("sim"),
            floor_hours("ts").alias("cycle"),
        )
        .distinct()
    )


@register(
    f"""WITH {ARRIVALS_SQL}, {_COMPLETE_SQL}, {_DONE_SQL}
SELECT sim, cycle FROM comp WHERE cycle <= TIMESTAMP '2024-01-25' AND NOT EXISTS (SELECT 1 FROM done WHERE done.sim = comp.sim AND done.cycle = comp.cycle)"""
)
def todo_anti_join(spark: SparkSession, d: str) -> DataFrame:
    whole = mf.complete_cycles(arrivals(spark, d), STREAMS, ["sim", "cycle"])
    return mf.todo(whole, _done(spark, d), ["sim", "cycle"], datetime(2024, 1, 25))


@register(
    f"""WITH {ARRIVALS_SQL}, s AS (SELECT DISTINCT sim FROM man), pres AS (SELECT sim, cycle FROM man GROUP BY ALL HAVING count(DISTINCT stream) >= 3),
st AS (SELECT sim, k // 16 AS chunk, time_bucket(INTERVAL 12 HOUR, TIMESTAMP '2024-01-01' + to_hours(k::INT), TIMESTAMP '2000-01-01')::TIMESTAMP AS cycle
  FROM s, (SELECT unnest(range({MONTH_AXIS.size - 1})) AS k)),
t AS (SELECT DISTINCT sim, chunk, cycle FROM st)
SELECT sim, chunk, count(*) AS n_cycles, bool_and(p.cycle IS NOT NULL) AS runnable FROM t LEFT JOIN pres p USING (sim, cycle) GROUP BY ALL"""
)
def coverage_gate(spark: SparkSession, d: str) -> DataFrame:
    """16-step chunks whose every 12-hour cycle has at least three streams."""
    man = arrivals(spark, d)
    present = mf.cycle_status(man, STREAMS, ["sim", "cycle"]).filter(F.col("n_streams") >= 3)
    return mf.coverage_gate(man.select("sim").distinct(), present, MONTH_AXIS, 16)


@register(
    """WITH s AS (SELECT event_type, user_id, count(DISTINCT date_trunc('hour', ts)) AS n_steps FROM events GROUP BY ALL)
SELECT event_type, user_id, n_steps, chunk, chunk * 16 AS start_idx, (chunk + 1) * 16 AS end_idx
FROM (SELECT *, unnest(range(ceil(n_steps / 16.0)::BIGINT)) AS chunk FROM s)"""
)
def chunk_plan(spark: SparkSession, d: str) -> DataFrame:
    steps = table(spark, d, "events").groupBy("event_type", "user_id").agg(
        F.count_distinct(F.date_trunc("hour", "ts")).alias("n_steps")
    )
    return mf.chunk_plan(steps, 16)


# --- quality -----------------------------------------------------------------

_SNAP_SQL = """snap AS (SELECT * FROM ev WHERE "time" = (SELECT max("time") FROM (SELECT DISTINCT "time" FROM ev ORDER BY 1 LIMIT 2)))"""


@register(
    f"""WITH {CELLS_SQL}, {_SNAP_SQL} SELECT variable, count(v) AS n_valid, {NPIX}::BIGINT AS n_expected,
round(1 - count(v) / {NPIX}::DOUBLE, 6) AS missing_fraction FROM snap GROUP BY ALL"""
)
def missing_fraction(spark: SparkSession, d: str) -> DataFrame:
    out = ql.missing_fraction(snapshot(cells(spark, d)), ["variable"], "v", NPIX)
    return out.withColumn("missing_fraction", F.round("missing_fraction", 6))


@register(
    f"""WITH {CELLS_SQL}, {_SNAP_SQL}, f AS (SELECT variable, round(1 - count(v) / {NPIX}::DOUBLE, 6) AS missing_fraction FROM snap GROUP BY ALL)
SELECT variable, missing_fraction, CASE WHEN missing_fraction >= 1 THEN 'all missing' WHEN missing_fraction >= 0.5 THEN 'too many missing' END AS failure FROM f"""
)
def missing_rules(spark: SparkSession, d: str) -> DataFrame:
    out = ql.missing_fraction(snapshot(cells(spark, d)), ["variable"], "v", NPIX)
    out = out.select("variable", F.round("missing_fraction", 6).alias("missing_fraction"))
    return ql.missing_rules(out, regional=False)


@register(
    f"""WITH {CELLS_SQL}, c AS (SELECT "time", variable, healpix_index >> 4 AS ip, avg(v) AS v FROM ev GROUP BY ALL)
SELECT "time", variable, count(v) = 0 AS all_missing, count(v) < 48 AS any_missing FROM c GROUP BY ALL"""
)
def missing_flags(spark: SparkSession, d: str) -> DataFrame:
    keys = ["time", "variable"]
    coarse = cells(spark, d).groupBy(*keys, parent("healpix_index", 2).alias("ip")).agg(F.avg("v").alias("v"))
    return ql.missing_flags(coarse, keys, "v", npix(1))


_RANGES = {"view": (0.5, None), "click": (0.0, 200.0), "error": (None, 150.0)}


@register(
    """WITH r(variable, lo, hi) AS (VALUES ('view', 0.5e0, NULL), ('click', 0e0, 200e0), ('error', NULL, 150e0)),
e AS (SELECT date_trunc('day', ts)::TIMESTAMP AS "time", event_type AS variable, min(value) AS vmin, max(value) AS vmax FROM events GROUP BY ALL)
SELECT "time", variable, vmin, vmax, coalesce(vmin < lo - 1e-10, false) AS below, coalesce(vmax > hi + 1e-10, false) AS above FROM e JOIN r USING (variable)"""
)
def range_checks(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events").select(day("ts").alias("time"), F.col("event_type").alias("variable"), "value")
    return ql.range_checks(ev, ["time"], "value", _RANGES)


@register(
    """WITH a AS (SELECT DISTINCT 'cust' || user_id AS ds FROM events), r AS (SELECT DISTINCT 'cust' || c_custkey AS ds FROM customer WHERE c_acctbal > 0)
SELECT ds, 'absent' AS problem FROM r WHERE ds NOT IN (SELECT ds FROM a)
UNION ALL SELECT ds, 'unregistered' FROM a WHERE ds LIKE '%7' AND ds NOT IN (SELECT ds FROM r)"""
)
def registry_diff(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "events").select(F.concat(F.lit("cust"), F.col("user_id").cast("string")).alias("ds"))
    want = table(spark, d, "customer").filter("c_acctbal > 0").select(
        F.concat(F.lit("cust"), F.col("c_custkey").cast("string")).alias("ds")
    )
    return ql.registry_diff(have, want, "ds", suffix="7")


@register(
    f"""WITH {CELLS_SQL} SELECT variable, count(DISTINCT "time") AS n_times, count(DISTINCT healpix_index) AS n_cells,
count(DISTINCT "time") >= 1 AND count(DISTINCT healpix_index) > 0 AS ok FROM ev GROUP BY ALL"""
)
def dataset_opens(spark: SparkSession, d: str) -> DataFrame:
    return ql.dataset_shape(cells(spark, d), ["variable"])


_JANUARY = TimeAxis(datetime(2024, 1, 1), datetime(2024, 1, 31), timedelta(days=1))


@register(
    f"""WITH {CELLS_SQL}, pres AS (SELECT "time", healpix_index, count(*) AS n FROM ev GROUP BY ALL),
sp AS (SELECT TIMESTAMP '2024-01-01' + to_days(k::INT) AS "time", c AS healpix_index FROM (SELECT unnest(range(31)) AS k), (SELECT unnest(range({NPIX})) AS c))
SELECT "time", count(*) AS n_cells, count(n) AS n_present, coalesce(sum(n), 0)::BIGINT AS n_values FROM sp LEFT JOIN pres USING ("time", healpix_index) GROUP BY ALL"""
)
def spine_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Cells present on every step of the axis, absent steps included."""
    have = cells(spark, d).groupBy("time", "healpix_index").agg(F.count(F.lit(1)).alias("n"))
    out = ql.spine(spark, _JANUARY, ZOOM).join(have, ["time", "healpix_index"], "left")
    return out.groupBy("time").agg(
        F.count(F.lit(1)).alias("n_cells"), F.count("n").alias("n_present"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_values"),
    )


@register(
    """WITH need AS (SELECT DISTINCT l_returnflag || l_linestatus || (l_suppkey % 40) AS grid_key FROM lineitem),
have AS (SELECT DISTINCT l_returnflag || l_linestatus || (l_suppkey % 40) AS grid_key FROM lineitem WHERE l_suppkey % 3 <> 0)
SELECT grid_key FROM need WHERE grid_key NOT IN (SELECT grid_key FROM have)
UNION ALL SELECT DISTINCT 'next' || l_returnflag FROM lineitem"""
)
def absent_weights(spark: SparkSession, d: str) -> DataFrame:
    """Grids in use for which no weights are stored; those of a new domain have none yet."""
    key = F.concat("l_returnflag", "l_linestatus", (F.col("l_suppkey") % 40).cast("string")).alias("grid_key")
    li = table(spark, d, "lineitem")
    new = li.select(F.concat(F.lit("next"), "l_returnflag").alias("grid_key"))
    return ql.absent_weights(li.select(key).union(new), li.filter("l_suppkey % 3 <> 0").select(key))


@register(f"WITH {CELLS_SQL}, {_SNAP_SQL} SELECT variable, \"time\", count(DISTINCT healpix_index) AS n_cells FROM snap GROUP BY ALL")
def single_step_loads(spark: SparkSession, d: str) -> DataFrame:
    return snapshot(cells(spark, d)).groupBy("variable", "time").agg(
        F.count_distinct("healpix_index").alias("n_cells")
    )


@register(
    f"""WITH {CELLS_SQL}, f AS (SELECT * FROM ev WHERE "time" IN (SELECT DISTINCT "time" FROM ev ORDER BY 1 LIMIT 6))
SELECT variable, "time", round(avg(v), 6) AS v FROM f GROUP BY ALL"""
)
def first_six_steps(spark: SparkSession, d: str) -> DataFrame:
    return first_steps(cells(spark, d), 6).groupBy("variable", "time").agg(F.round(F.avg("v"), 6).alias("v"))


@register(
    f"""WITH {CELLS_SQL}, {_chain_sql('ev', _K, ['v'])}, b AS (SELECT min("time") AS t0, max("time") AS t1, count(DISTINCT "time") AS nt FROM ev)
SELECT variable, count(CASE WHEN "time" > t0 AND "time" < t1 THEN v END) AS n_valid,
round(1 - count(CASE WHEN "time" > t0 AND "time" < t1 THEN v END) / ((max(nt) - 2) * 12)::DOUBLE, 6) AS missing_fraction FROM z0, b GROUP BY ALL"""
)
def zoom0_no_missing(spark: SparkSession, d: str) -> DataFrame:
    levels = pyr.pyramid(cells(spark, d), ["time", "variable"], ["v"], ZOOM).filter("zoom = 0")
    out = ql.inner_series_missing(levels.withColumn("sim", F.lit("all")), ["sim", "variable"], "v", npix(0), ["sim"])
    return out.select("variable", "n_valid", F.round("missing_fraction", 6).alias("missing_fraction"))


@register(
    f"""WITH {CELLS_SQL}, {_chain_sql('ev', _K, ['v'])}, flat AS (SELECT "time", variable, healpix_index >> 4 AS healpix_index, avg(v) AS b FROM ev WHERE v > 2 GROUP BY ALL)
SELECT "time", variable, healpix_index, round(v, 6) AS a, round(b, 6) AS b FROM z1 FULL JOIN flat USING ("time", variable, healpix_index)
WHERE NOT coalesce(abs(v - b) <= 1e-8 + 1e-5 * abs(b), false)"""
)
def compare_runs(spark: SparkSession, d: str) -> DataFrame:
    """Chained against flat means: all cells on which two results differ."""
    ev = cells(spark, d)
    keys = ["time", "variable", "healpix_index"]
    chained = pyr.pyramid(ev, keys[:2], ["v"], ZOOM, 1).filter("zoom = 1")
    flat = ev.filter("v > 2").groupBy("time", "variable", parent("healpix_index", 2).alias("healpix_index")).agg(
        F.avg("v").alias("v")
    )
    return ql.compare_runs(chained, flat, keys, "v").select(*keys, r6("a"), r6("b"))


# --- reports -----------------------------------------------------------------

def _coded(specs) -> list[VariableSpec]:
    """Each field by its own code as well, as there is one field of a name for each of three codes."""
    return [replace(s, fields=tuple(replace(f, stash=f.stash or f"m01s0{n % 3}") for n, f in enumerate(s.fields))) for s in specs]


_RUNS = {
    "run0": DEMO_SPECS,
    "run1": DEMO_SPECS,
    "run2": DEMO_SPECS,
    "run3": override(DEMO_SPECS, {"vpc": None, "tot": dict(fields=(FieldRule("view", averaged=True),), ops=(), attrs={})}),
}
_RUNS = {k: _coded(v) for k, v in _RUNS.items()}
_EXPERIMENTS = {k: [("PT1H", s) for s in v] for k, v in _RUNS.items()}


def _report(spark: SparkSession, d: str) -> DataFrame:
    plane = sources(spark, d).filter(has_dims("time", "latitude", "longitude"))
    return rp.mapping_report(spark, inventory(plane, ["expt"]), _EXPERIMENTS)


def _spec_rows() -> str:
    rows = []
    for expt, specs in _RUNS.items():
        for s in specs:
            for n, f in enumerate(s.fields):
                op = s.ops[n - 1] if n else ""
                av = "NULL" if f.averaged is None else str(f.averaged).lower()
                st = "NULL" if f.stash is None else f"'{f.stash}'"
                un = "NULL" if s.units is None else f"'{s.units}'"
                post = "NULL" if s.post_name is None else f"'{s.post_name}'"
                attrs = str(dict(s.attrs)).replace("'", "''")
                rows.append(
                    f"('{expt}', '{s.short}', '{s.long}', {n}, '{op}', '{f.name}', {st}, {av}, {un}, '{attrs}', {post})"
                )
    return ", ".join(rows)


_REPORT_SQL = f"""{SOURCES_SQL}, inv AS (SELECT DISTINCT expt, field_name, stash, averaged, units FROM src WHERE NOT deep),
sp(expt, variable_id, standard_name, n, op, fn, st, av, un, extra_attrs, extra_processing) AS (VALUES {_spec_rows()}),
hit AS (SELECT sp.*, count(inv.field_name) AS k, min(inv.field_name) AS f, min(inv.stash) AS s, min(inv.units) AS u
  FROM sp LEFT JOIN inv ON inv.expt = sp.expt AND inv.field_name = sp.fn AND (sp.st IS NULL OR inv.stash = sp.st) AND (sp.av IS NULL OR inv.averaged = sp.av)
  GROUP BY ALL),
rep AS (SELECT expt, 'PT1H' AS store, variable_id, standard_name,
  CASE WHEN bool_and(k = 1) THEN coalesce(max(un), max(CASE WHEN n = 0 THEN u END)) END AS units, bool_and(k = 1) AS is_present,
  CASE WHEN bool_and(k = 1) THEN string_agg(CASE WHEN n = 0 THEN f ELSE op || ' ' || f END, ' ' ORDER BY n) END AS cube_name,
  CASE WHEN bool_and(k = 1) THEN string_agg(CASE WHEN n = 0 THEN s ELSE op || ' ' || s END, ' ' ORDER BY n) END AS stash_code,
  max(extra_attrs) AS extra_attrs, max(extra_processing) AS extra_processing
  FROM hit GROUP BY expt, variable_id, standard_name)"""
_SAME_COLS = ", ".join(c for c in rp.REPORT_COLUMNS if c != "expt")


@register(f"WITH {_REPORT_SQL} SELECT * FROM rep")
def mapping_report(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d)


@register(
    f"WITH {_REPORT_SQL} SELECT {_SAME_COLS} FROM rep GROUP BY ALL HAVING count(*) = (SELECT count(DISTINCT expt) FROM rep)"
)
def mapping_same_everywhere(spark: SparkSession, d: str) -> DataFrame:
    return rp.same_everywhere(_report(spark, d))


@register(
    f"""WITH {_REPORT_SQL}, part AS (SELECT variable_id FROM (SELECT {_SAME_COLS}, count(*) AS c FROM rep GROUP BY ALL) WHERE c < (SELECT count(DISTINCT expt) FROM rep)
  UNION SELECT variable_id FROM rep WHERE NOT is_present) SELECT * FROM rep WHERE variable_id IN (SELECT variable_id FROM part)"""
)
def mapping_differs(spark: SparkSession, d: str) -> DataFrame:
    return rp.differs_somewhere(_report(spark, d))


@register(f"WITH {_REPORT_SQL} SELECT expt, variable_id, is_present, cube_name FROM rep")
def report_csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """The mapping report written as CSV and read back."""
    path = f"{scratch_root(spark)}/report"
    rep = _report(spark, d)
    write_report(rep, path)
    return read_report(spark, path, rep.schema).select("expt", "variable_id", "is_present", "cube_name")


@register(
    f"""WITH {ARRIVALS_SQL}, {_COMPLETE_SQL}, {_DONE_SQL}, ni AS (SELECT sim, count(*) AS num_inputs FROM comp GROUP BY 1),
ex AS (SELECT DISTINCT sim FROM man UNION SELECT 'not_started'),
rg AS (SELECT sim, count(*) AS n FROM comp JOIN done USING (sim, cycle) GROUP BY 1),
co AS (SELECT sim, count(DISTINCT cycle) AS n FROM man WHERE stream = 'view' GROUP BY 1),
cr AS (SELECT DISTINCT sim FROM man WHERE stream = 'error')
SELECT sim, 60::BIGINT AS expected_num_inputs, coalesce(num_inputs, 0) AS num_inputs, cr.sim IS NOT NULL AS created, coalesce(rg.n, 0) AS num_regrids_done,
round(coalesce(co.n, 0) * 100e0 / 60, 6) AS coarsen, round(coalesce(num_inputs, 0) * 100e0 / 60, 6) AS inputs, round(coalesce(rg.n * 100e0 / num_inputs, 0), 6) AS regrid
FROM ex LEFT JOIN ni USING (sim) LEFT JOIN rg USING (sim) LEFT JOIN co USING (sim) LEFT JOIN cr USING (sim)"""
)
def completeness_report(spark: SparkSession, d: str) -> DataFrame:
    man = arrivals(spark, d)
    whole = mf.complete_cycles(man, STREAMS, ["sim", "cycle"])
    out = rp.completeness_report(
        whole,
        man.filter("stream = 'error'").select("sim").distinct(),
        whole.join(_done(spark, d), ["sim", "cycle"], "left_semi"),
        man.filter("stream = 'view'").select("sim", "cycle").distinct(),
        expected_inputs=60,
        coarsen_jobs=60,
        experiments=man.select("sim").union(spark.createDataFrame([("not_started",)], "sim string")),
    )
    return out.withColumns({c: F.round(c, 6) for c in ("coarsen", "inputs", "regrid")})


@register(
    "SELECT event_type, user_id, count(*) AS n, count(DISTINCT date_trunc('day', ts)) AS n_days FROM events GROUP BY ALL"
)
def grouped_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.date_trunc("day", "ts")).alias("n_days")
    )


# --- store -------------------------------------------------------------------


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """EV as store rows: one block per day."""
    ordinal = F.datediff(F.col("time"), F.lit("2024-01-01").cast("date")).cast("bigint")
    return cells(spark, d).select(
        F.lit("demo").alias("sim"), F.lit("P1D").alias("freq"), F.lit(ZOOM).alias("zoom"), "variable",
        ordinal.alias("block"), "time", F.lit(None).cast("double").alias("level"), "healpix_index",
        F.col("v").alias("value"),
    )


@register(
    f"""WITH {CELLS_SQL} SELECT variable, "time", healpix_index,
round((CASE WHEN "time" >= TIMESTAMP '2024-01-08' AND "time" < TIMESTAMP '2024-01-15' THEN v * 2 ELSE v END)::FLOAT::DOUBLE, 4) AS value FROM ev"""
)
def region_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """Write all blocks, then replace one week of them; the rest stays."""
    store = CellStore(spark, scratch_root(spark))
    rows = _stored(spark, d)
    store.write_region(rows)
    store.write_region(rows.filter(F.col("block").between(7, 13)).withColumn("value", F.col("value") * 2))
    return store.scan().select(
        "variable", "time", "healpix_index", F.round(F.col("value").cast("double"), 4).alias("value")
    )


@register(
    f"""WITH {CELLS_SQL} SELECT 'demo' AS sim, 'P1D' AS freq, {ZOOM} AS zoom, variable, count(*) AS n_values,
'nested' AS indexing_scheme, '{2 ** ZOOM}' AS healpix_nside, 'CF-1.13' AS conventions, 'demo' AS simulation FROM ev GROUP BY ALL"""
)
def catalog_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Datasets in the store with their metadata, and one opened with coordinates."""
    store = CellStore(spark, scratch_root(spark))
    store.write_region(_stored(spark, d))
    names = store.catalog()
    sets = names.select("sim", "freq", "zoom").distinct().withColumn(
        "config", F.create_map(F.lit("simulation"), F.col("sim"), F.lit("Conventions"), F.lit("none"))
    )
    meta = dataset_metadata(sets, regional=False, shared={"processing_version": "v1"})
    opened = store.open("demo", "P1D", ZOOM).filter(F.col("lat").between(-90, 90))
    counts = opened.groupBy("variable").agg(F.count(F.lit(1)).alias("n_values"))
    return names.join(counts, "variable").join(meta, ["sim", "freq", "zoom"]).select(
        "sim", "freq", "zoom", "variable", "n_values",
        F.col("crs")["indexing_scheme"].alias("indexing_scheme"), F.col("crs")["healpix_nside"].alias("healpix_nside"),
        F.col("attrs")["Conventions"].alias("conventions"), F.col("attrs")["simulation"].alias("simulation"),
    )


@register(
    f"""WITH {CELLS_SQL} SELECT "time", variable, healpix_index >> 2 AS healpix_index, round(max(v) - min(v), 6) AS v FROM ev GROUP BY ALL"""
)
def block_reducer(spark: SparkSession, d: str) -> DataFrame:
    """A caller's own array reducer over the children of each cell."""
    def spread(blocks: np.ndarray) -> np.ndarray:
        return np.nanmax(blocks, axis=-1) - np.nanmin(blocks, axis=-1)

    return pyr.coarsen_blocks(cells(spark, d), ["time", "variable"], "v", spread).select(
        "time", "variable", "healpix_index", r6("v")
    )


@register(
    f"""WITH {CELLS_SQL}, a AS (SELECT healpix_index AS cell, min("time") AS first_time, count(*) AS n FROM ev GROUP BY ALL) SELECT * FROM a"""
)
def consumer_view(spark: SparkSession, d: str) -> DataFrame:
    """Stored cells under the names analysis code expects, without helper columns."""
    out = for_consumers(drop_unused(_stored(spark, d), ("sim", "freq", "height", "sigma")))
    return out.groupBy("cell").agg(F.min("time").alias("first_time"), F.count(F.lit(1)).alias("n"))


@register(
    f"""WITH a AS (SELECT 'sim' || (user_id % 29) AS sim, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2000-01-01')::TIMESTAMP AS cycle_time, event_type FROM events)
SELECT sim, cycle_time, count(DISTINCT event_type) AS n_streams FROM a
WHERE cycle_time + INTERVAL 12 HOUR <= (SELECT max(cycle_time) FROM a) GROUP BY ALL HAVING count(DISTINCT event_type) = 5"""
)
def stream_complete_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Completeness as streaming state; a cycle is reported once it is over."""
    root = scratch_root(spark)
    source = table(spark, d, "events").schema
    arrivals_in = spark.readStream.schema(source).option("pathGlobFilter", "events.parquet").parquet(d)
    rows = arrivals_in.select(
        F.concat(F.lit("sim"), (F.col("user_id") % 29).cast("string")).alias("sim"),
        floor_hours("ts").cast("timestamp").alias("cycle_time"),
        F.col("event_type").alias("stream"),
    )
    query = (
        complete_in_stream(rows, STREAMS, late="0 seconds")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start(f"{root}/complete")
    )
    query.awaitTermination()
    out = spark.read.schema("sim string, cycle_time timestamp, n_streams bigint").parquet(f"{root}/complete")
    return out.withColumn("cycle_time", F.col("cycle_time").cast("timestamp_ntz"))


# --- incremental -------------------------------------------------------------

# Months of the fixture become the hours of a cycle, years the cycles.
_START = datetime(2020, 1, 20)
_AXIS = TimeAxis(_START, _START + timedelta(hours=84), timedelta(hours=1))
_HOURLY_SPECS = (
    VariableSpec("qty", "quantity", (FieldRule("quantity"),)),
    VariableSpec("sum", "quantity_plus_tax", (FieldRule("quantity"), FieldRule("tax")), ("+",)),
)
_DEMO = Experiment(
    "demo", ZOOM, (GroupSpec("2d", "PT1H", _AXIS, ("time", "latitude", "longitude"), _HOURLY_SPECS),), first_cycle=_START
)


def source_fields(spark: SparkSession, d: str) -> DataFrame:
    """LL per month as a source-field table in two streams."""
    year, month = F.year("l_shipdate"), F.month("l_shipdate")
    base = F.lit(_START).cast("timestamp_ntz")
    grouped = table(spark, d, "lineitem").groupBy(
        (base + F.make_dt_interval(hours=(year - 1995) * 12)).cast("timestamp_ntz").alias("cycle"),
        (base + F.make_dt_interval(hours=(year - 1995) * 12 + month - 1)).cast("timestamp_ntz").alias("time"),
        (F.lit(-85.0) + 10.0 * (F.col("l_partkey") % 18)).alias("lat"),
        (F.lit(5.0) + 10.0 * (F.col("l_orderkey") % 36)).alias("lon"),
    ).agg(F.avg(F.sqrt("l_quantity")).alias("q"), F.avg("l_tax").alias("t"))
    pairs = F.array(
        F.struct(F.lit("a").alias("stream"), F.lit("quantity").alias("field_name"), F.lit("m01s01").alias("stash"), F.col("q").alias("value")),
        F.struct(F.lit("b").alias("stream"), F.lit("tax").alias("field_name"), F.lit("m01s02").alias("stash"), F.col("t").alias("value")),
    )
    return grouped.select("cycle", "time", "lat", "lon", F.inline(pairs)).withColumns(
        {
            "sim": F.lit("demo"),
            "cell_methods": F.array().cast("array<string>"),
            "dims": F.array(F.lit("time"), F.lit("latitude"), F.lit("longitude")),
            "units": F.lit("1"),
            "level": F.lit(None).cast("double"),
        }
    )


def stored_fields(fields: DataFrame, root: str) -> DataFrame:
    """``fields`` written by cycle and read back: the table behind them is read once, and files don't rise with it."""
    path = f"{root}/fields"
    fields.hint("rebalance", "sim", "cycle").write.partitionBy("sim", "cycle").parquet(path)
    return fields.sparkSession.read.schema(fields.schema).parquet(path)


_RUN_SQL = f"""WITH {latlon_sql('month').replace('avg(sqrt(l_quantity)) AS v', 'avg(sqrt(l_quantity)) AS qty, avg(sqrt(l_quantity)) + avg(l_tax) AS "sum"')},
fld AS (SELECT TIMESTAMP '2020-01-20' + to_hours(((year("time") - 1995) * 12 + month("time") - 1)::INT) AS "time", {src_id_sql(GRID)} AS src_id, qty, "sum" FROM ll),
{weights_sql(GRID, ZOOM)},
hp AS (SELECT "time", healpix_index, sum(qty * w)::FLOAT AS qty, sum("sum" * w)::FLOAT AS "sum" FROM fld JOIN wts USING (src_id) GROUP BY ALL HAVING count(*) = 3),
top AS (SELECT "time", 'qty' AS variable, healpix_index, qty AS v FROM hp UNION ALL SELECT "time", 'sum', healpix_index, "sum" FROM hp),
z3 AS (SELECT * FROM top), z2 AS (SELECT "time", variable, healpix_index >> 2 AS healpix_index, avg(v)::FLOAT AS v FROM z3 GROUP BY ALL),
z1 AS (SELECT "time", variable, healpix_index >> 2 AS healpix_index, avg(v)::FLOAT AS v FROM z2 GROUP BY ALL),
z0 AS (SELECT "time", variable, healpix_index >> 2 AS healpix_index, avg(v)::FLOAT AS v FROM z1 GROUP BY ALL)"""


@register(
    _RUN_SQL + " " + " UNION ALL ".join(
        f"SELECT {z} AS zoom, variable, \"time\", count(*) AS n_cells, round(avg(v::DOUBLE), 4) AS v FROM z{z} GROUP BY ALL" for z in range(4)
    )
)
def incremental_rerun(spark: SparkSession, d: str) -> DataFrame:
    """Cycles that arrive in two batches, ingested, coarsened and run once more."""
    root = scratch_root(spark)
    store = CellStore(spark, root)
    fields = stored_fields(source_fields(spark, d), root)
    early = F.col("cycle") < F.lit(_START + timedelta(hours=48)).cast("timestamp_ntz")

    def arrive(rows: DataFrame) -> None:
        rows.hint("rebalance", "sim", "stream").write.mode("append").partitionBy("sim", "stream").parquet(f"{root}/incoming")

    def ingest() -> None:
        run_available(
            spark, f"{root}/incoming", fields.schema, _DEMO, lambda _: GRID, store, f"{root}/progress", expected=2
        )

    arrive(fields.filter(early))
    ingest()
    arrive(fields.filter(~early))
    ingest()
    ingest()
    return store.scan().groupBy("zoom", "variable", "time").agg(
        F.count(F.lit(1)).alias("n_cells"), F.round(F.avg(F.col("value").cast("double")), 4).alias("v")
    )


_LATE = replace(_DEMO, key="late")


@register(
    _RUN_SQL + " " + " UNION ALL ".join(
        f"SELECT {z} AS zoom, variable, \"time\" + INTERVAL 1 HOUR AS \"time\", count(*) AS n_cells, round(avg(v::DOUBLE), 4) AS v FROM z{z} GROUP BY ALL" for z in range(4)
    )
)
def late_cycle_rerun(spark: SparkSession, d: str) -> DataFrame:
    """Half-past fields whose second cycle arrives last; coarser zooms are asked for first.

    The last step of a cycle belongs to the hour that its successor starts
    with.  The result is that of cycles in order.
    """
    root = scratch_root(spark)
    store = CellStore(spark, root)
    shifted = F.col("time") + F.make_dt_interval(mins=F.lit(30))
    fields = source_fields(spark, d).withColumns({"sim": F.lit("late"), "time": shifted.cast("timestamp_ntz")})
    fields = stored_fields(fields, root)
    cycles = fields.select("sim", "cycle").distinct()
    late = F.col("cycle") == F.lit(_START + timedelta(hours=12)).cast("timestamp_ntz")
    for part in (cycles.filter(~late), cycles.filter(late)):
        regrid_cycles(fields, part, _LATE, lambda _: GRID, store)
        coarsen_zoom(store, _LATE, "2d", 1)  # before zoom 2 is there: must not be taken as done
        coarsen_all(store, _LATE, ("2d",))
    return store.scan().groupBy("zoom", "variable", "time").agg(
        F.count(F.lit(1)).alias("n_cells"), F.round(F.avg(F.col("value").cast("double")), 4).alias("v")
    )


_MENDED = replace(_DEMO, key="mended")


@register(
    _RUN_SQL + " " + " UNION ALL ".join(
        f"SELECT {z} AS zoom, variable, \"time\", count(*) AS n_cells, round(avg(v::DOUBLE), 4) AS v FROM z{z} GROUP BY ALL" for z in range(4)
    )
)
def corrected_cycle(spark: SparkSession, d: str) -> DataFrame:
    """A cycle that came with wrong values and is done again after all zooms were made.

    The result is that of the right values from the start, at every zoom.
    """
    root = scratch_root(spark)
    store = CellStore(spark, root)
    fields = source_fields(spark, d).withColumn("sim", F.lit("mended"))
    fields = stored_fields(fields, root)
    cycles = fields.select("sim", "cycle").distinct()
    second = _START + timedelta(hours=12)
    is_second = F.col("cycle") == F.lit(second).cast("timestamp_ntz")
    wrong = fields.withColumn("value", F.when(is_second, F.col("value") * 3 - 7).otherwise(F.col("value")))
    regrid_cycles(wrong, cycles, _MENDED, lambda _: GRID, store)
    coarsen_all(store, _MENDED, ("2d",))
    reopen_cycles(store, _MENDED, [second])
    regrid_cycles(fields, cycles.filter(is_second), _MENDED, lambda _: GRID, store)
    coarsen_all(store, _MENDED, ("2d",))
    return store.scan().groupBy("zoom", "variable", "time").agg(
        F.count(F.lit(1)).alias("n_cells"), F.round(F.avg(F.col("value").cast("double")), 4).alias("v")
    )
