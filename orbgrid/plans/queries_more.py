"""Queries on whole stores, versions, names and rules."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.functions.axes import IrregularAxis, floor_hours
from orbgrid.functions.healpix import zoom_from_nside
from orbgrid.operators import mapping as mp
from orbgrid.operators import quality as ql
from orbgrid.operators.mapping import FieldRule, VariableSpec, inventory
from orbgrid.operators.timeline import snapshot
from orbgrid.operators.weights import build_weights, explode_corners
from orbgrid.plans import jobs
from orbgrid.plans.inputs import ARRIVALS_SQL, CELLS_SQL, GRID, SOURCES_SQL, ZOOM, arrivals, cells, lonlat_sql, sources, table, weights_sql
from orbgrid.plans.queries_checks import _DEMO, _K, _SNAP_SQL, NPIX, STREAMS, _stored
from orbgrid.plans.queries_grid import _chain_sql
from orbgrid.plans.registry import register
from orbgrid.session import scratch_root
from orbgrid.sources import manifest as mf
from orbgrid.sources.store import CellStore, Region, cached_weights

_BOX = (330.5, 401.0, -33.0, 47.0)
_BOX_SQL = "(lon > 330.5 OR lon < 41) AND lat > -33 AND lat < 47"
_RANGES = {"click": (2.0, None), "view": (0.0, 1e9)}


def _check_sql(zoom: int) -> str:
    n = 12 << (2 * zoom)
    series = f"UNION ALL SELECT variable, 'series', n_inner = greatest(nt - 2, 0) * {n} FROM a{zoom}" if not zoom else ""
    return f"""b{zoom} AS (SELECT min("time") AS t0, max("time") AS t1, count(DISTINCT "time") AS nt FROM z{zoom}),
t{zoom} AS (SELECT max("time") AS snd, count(*) AS k FROM (SELECT DISTINCT "time" FROM z{zoom} ORDER BY 1 LIMIT 2)),
a{zoom} AS (SELECT variable, max(k) AS k, max(nt) AS nt, count(CASE WHEN "time" = snd THEN v END) AS n_valid,
  count(CASE WHEN "time" > t0 AND "time" < t1 THEN v END) AS n_inner, min(v) AS lo, max(v) AS hi FROM z{zoom}, b{zoom}, t{zoom} GROUP BY 1),
c{zoom} AS (SELECT variable, 'loads' AS "check", k >= 2 AS ok FROM a{zoom}
  UNION ALL SELECT variable, 'missing', 1 - n_valid / {n}::DOUBLE < 0.5 FROM a{zoom}
  UNION ALL SELECT variable, 'range', NOT (variable = 'click' AND lo < 2 - 1e-10 OR variable = 'view' AND (lo < -1e-10 OR hi > 1e9)) FROM a{zoom} {series})"""


@register(
    f"""WITH {CELLS_SQL}, {_chain_sql('ev', _K, ['v'])}, {", ".join(map(_check_sql, range(ZOOM + 1)))}
""" + " UNION ALL ".join(f"SELECT 'demo' AS sim, 'P1D' AS freq, {z} AS zoom, variable, \"check\", ok FROM c{z}" for z in range(ZOOM + 1))
)
def store_checks(spark: SparkSession, d: str) -> DataFrame:
    """Every check of every dataset of a store, all zooms."""
    from orbgrid.operators.pyramid import pyramid

    store = CellStore(spark, scratch_root(spark))
    levels = pyramid(_stored(spark, d).drop("zoom"), ["sim", "freq", "variable", "block", "time", "level"], ["value"], ZOOM)
    store.write_region(levels)
    return ql.store_checks(store.scan(), ranges=_RANGES)


@register("SELECT l_linenumber AS zoom, count(*) AS n FROM lineitem GROUP BY 1")
def zoom_of_nside(spark: SparkSession, d: str) -> DataFrame:
    nside = F.call_function("shiftleft", F.lit(1), F.col("l_linenumber").cast("int"))
    return table(spark, d, "lineitem").groupBy(zoom_from_nside(nside).alias("zoom")).agg(F.count(F.lit(1)).alias("n"))


@register(
    f"""WITH {CELLS_SQL}, {_SNAP_SQL} SELECT variable, round(1 - count(v) / {NPIX}::DOUBLE, 6) AS missing_fraction,
CASE WHEN count(v) = 0 THEN 'all missing' END AS failure FROM snap GROUP BY 1"""
)
def regional_missing_rules(spark: SparkSession, d: str) -> DataFrame:
    """Regional data may miss any share but all."""
    out = ql.missing_fraction(snapshot(cells(spark, d)), ["variable"], "v", NPIX)
    return ql.missing_rules(out.select("variable", F.round("missing_fraction", 6).alias("missing_fraction")), regional=True)


@register(
    f"""WITH {CELLS_SQL} SELECT variable, date_diff('day', DATE '2024-01-01', "time"::DATE)::BIGINT AS block, count(v) AS n_values,
count(DISTINCT "time") AS n_fields, count(v) = 0 AS all_missing, count(v) < count(DISTINCT "time") * {NPIX} AS any_missing FROM ev GROUP BY ALL"""
)
def region_report(spark: SparkSession, d: str) -> DataFrame:
    """What was stored of each block."""
    store = CellStore(spark, scratch_root(spark))
    store.write_region(_stored(spark, d))
    return jobs.region_report(store, replace(_DEMO, max_zoom=ZOOM), "P1D", ZOOM)


@register(
    f"""WITH {CELLS_SQL}, p AS ({lonlat_sql('ev', ZOOM, '*')})
SELECT variable, "time", healpix_index, round(v::FLOAT::DOUBLE, 4) AS value, round(CASE WHEN lon <= 180 THEN lon ELSE lon - 360 END, 6) AS lon,
round(lat, 6) AS lat FROM p WHERE "time" >= TIMESTAMP '2024-01-05' AND "time" < TIMESTAMP '2024-01-19' AND {_BOX_SQL}"""
)
def region_read(spark: SparkSession, d: str) -> DataFrame:
    """A box across the zero meridian and two weeks of a stored dataset."""
    store = CellStore(spark, scratch_root(spark))
    store.write_region(_stored(spark, d))
    days = (datetime(2024, 1, 5), datetime(2024, 1, 19))
    out = store.open("demo", "P1D", ZOOM, extent=_BOX, time=days, blocks=(4, 17), signed_lon=True)
    return out.select(
        "variable", "time", "healpix_index", F.round(F.col("value").cast("double"), 4).alias("value"),
        F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"),
    )


@register(
    f"""WITH {CELLS_SQL} SELECT 'v1' AS version, variable, count(*) AS n FROM ev GROUP BY ALL
UNION ALL SELECT 'v2', variable, count(*) FROM ev WHERE variable <> 'click' GROUP BY ALL"""
)
def version_refresh(spark: SparkSession, d: str) -> DataFrame:
    """A new version is a store of its own; the old one stays as it was."""
    root, rows = scratch_root(spark), _stored(spark, d)
    parts = []
    for version, some in (("v1", rows), ("v2", rows.filter("variable <> 'click'"))):
        store = CellStore(spark, root, version)
        store.write_region(some)
        counts = store.scan().groupBy("variable").agg(F.count(F.lit(1)).alias("n"))
        parts.append(counts.select(F.lit(version).alias("version"), "variable", "n"))
    return parts[0].union(parts[1])


@register(
    f"""WITH {SOURCES_SQL}, inv AS (SELECT DISTINCT expt, field_name, stash, averaged, deep, units FROM src)
SELECT expt, 'late' AS variable, 0 AS operand, count(*) FILTER (WHERE stash > 'm01s00' AND units <> 'uv') AS n_matches FROM inv GROUP BY 1"""
)
def rules_by_predicate(spark: SparkSession, d: str) -> DataFrame:
    """Fields picked by a free condition."""
    rule = FieldRule(where=lambda: (F.col("stash") > "m01s00") & (F.substring("field_name", 1, 1) != "v"))
    return mp.count_matches(inventory(sources(spark, d), ["expt"]), [VariableSpec("late", "late", (rule,))], ["expt"])


@register('SELECT l_orderkey, l_linenumber, l_tax * 100 AS l_tax, l_discount * 100 AS l_discount FROM lineitem')
def map_over_variables(spark: SparkSession, d: str) -> DataFrame:
    """One function over every variable, by ``transform``."""
    wide = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", "l_discount")
    return wide.transform(mp.map_values, ["l_tax", "l_discount"], lambda x: x * 100)


@register(
    f"""WITH {weights_sql(GRID, ZOOM)} SELECT healpix_index, src_id, round(w, 9) AS w, (SELECT count(*) FROM region) AS n FROM wts"""
)
def weight_cache(spark: SparkSession, d: str) -> DataFrame:
    """Weights are built once: the second call reads what the first one stored."""
    store = CellStore(spark, scratch_root(spark))
    cached_weights(store, GRID, ZOOM)
    rows = cached_weights(store, GRID, ZOOM).select("healpix_index", F.inline("corners"))
    n = table(spark, d, "region").agg(F.count(F.lit(1)).alias("n"))  # one row
    return rows.select("healpix_index", "src_id", F.round("w", 9).alias("w")).join(F.broadcast(n))


_UNEVEN = tuple(-85.0 + 10.0 * j + (0.0, 2.5, -1.5)[j % 3] for j in range(18))
_UNEVEN_GRID = replace(GRID, lat=IrregularAxis(_UNEVEN))
_STEPS_SQL = ", ".join(f"({j}, {a}e0, {b}e0)" for j, (a, b) in enumerate(zip(_UNEVEN, _UNEVEN[1:])))
_EVEN_Y = f"round((lat - ({GRID.lat.start}e0)) / {GRID.lat.step}e0, 12) AS y"
_UNEVEN_Y = "(SELECT round(k + (lat - a) / (b - a), 12) FROM ax WHERE lat >= a AND lat < b) AS y"


@register(
    f"""WITH ax(k, a, b) AS (VALUES {_STEPS_SQL}), {weights_sql(GRID, ZOOM).replace(_EVEN_Y, _UNEVEN_Y)}
SELECT healpix_index, src_id, round(w, 6) AS w, (SELECT count(*) FROM nation) AS n FROM wts"""
)
def weights_irregular(spark: SparkSession, d: str) -> DataFrame:
    """Weights from a grid whose rows are not equally spaced."""
    n = table(spark, d, "nation").agg(F.count(F.lit(1)).alias("n"))  # one row
    long = explode_corners(build_weights(spark, _UNEVEN_GRID, ZOOM))
    return long.select("healpix_index", "src_id", F.round("w", 6).alias("w")).join(F.broadcast(n))


@register(
    """SELECT time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2000-01-01')::TIMESTAMP AS cycle, count(DISTINCT event_type) AS n_files
FROM events WHERE event_type <> 'error' GROUP BY 1"""
)
def discovered_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Files written by cycle and stream, found again by their names alone."""
    root = scratch_root(spark)
    ev = table(spark, d, "events").withColumn("ts", floor_hours("ts"))
    kind = F.when(F.col("event_type") == "error", "apvere").otherwise(F.col("event_type"))
    stem = F.concat(F.lit("run."), kind, F.lit("_"), F.date_format("ts", "yyyyMMdd'T'HH"))
    ev.select(F.lit("x").alias("value"), stem.alias("stem")).distinct().write.partitionBy("stem").text(root)
    found = mf.list_files(spark, root, "*.txt", folders="stem=run*").withColumn("stem", F.regexp_extract("path", "stem=([^/]+)/", 1))
    return mf.file_cycles(found).groupBy("cycle").agg(F.count_distinct("stem").alias("n_files"))


@register(
    f"""WITH {ARRIVALS_SQL}, f AS (SELECT sim, cycle, sim || '/' || strftime(cycle, '%Y%m%dT%H') || '/' || stream || '.pp' AS path FROM man)
SELECT sim, cycle, string_agg(path, ';' ORDER BY path) AS paths FROM f GROUP BY ALL HAVING count(*) = {STREAMS}"""
)
def sorted_inputs(spark: SparkSession, d: str) -> DataFrame:
    """The files of each complete cycle, in order."""
    stamp = F.date_format("cycle", "yyyyMMdd'T'HH")
    path = F.concat_ws("/", "sim", stamp, F.concat("stream", F.lit(".pp")))
    found = mf.complete_files(arrivals(spark, d).withColumn("path", path), STREAMS, ["sim", "cycle"])
    return found.select("sim", "cycle", F.concat_ws(";", "paths").alias("paths"))


@register(
    f"""WITH {CELLS_SQL}, b AS (SELECT variable, date_diff('day', DATE '2024-01-01', "time"::DATE)::BIGINT AS block, v FROM ev)
SELECT variable, block, count(v) AS n_values FROM b WHERE NOT (variable = 'click' AND block BETWEEN 7 AND 13) GROUP BY ALL"""
)
def emptied_blocks(spark: SparkSession, d: str) -> DataFrame:
    """A rerun that has no values for a week of one variable: its blocks leave the store, the others stay."""
    store, rows = CellStore(spark, scratch_root(spark)), _stored(spark, d)
    store.write_region(rows)
    week = rows.filter(F.col("block").between(7, 13))
    rerun = week.withColumn("value", F.when(F.col("variable") != "click", F.col("value")))
    store.write_region(rerun, Region("demo", "P1D", ZOOM, ["click"], range(7, 14)))
    return store.scan().groupBy("variable", "block").agg(F.count("value").alias("n_values"))


@register(
    f"""WITH {CELLS_SQL} SELECT variable, date_diff('day', DATE '2024-01-01', "time"::DATE)::BIGINT AS block, count(v) AS n_values,
'v1/cells/sim=demo/freq=P1D/zoom={ZOOM}/variable=' || variable || '/block=' || date_diff('day', DATE '2024-01-01', "time"::DATE) AS folder
FROM ev GROUP BY ALL"""
)
def store_paths(spark: SparkSession, d: str) -> DataFrame:
    """Where the store keeps each variable and block."""
    store = CellStore(spark, scratch_root(spark))
    store.write_region(_stored(spark, d))
    folder = F.regexp_extract(F.input_file_name(), "(v1/cells/.*)/[^/]+$", 1)
    rows = store.scan().select("variable", "block", "value", folder.alias("folder"))
    return rows.groupBy("variable", "block", "folder").agg(F.count("value").alias("n_values"))


@register(
    f"""WITH {CELLS_SQL}, {_check_sql(ZOOM).replace(f'z{ZOOM}', 'ev')}
SELECT 'demo' AS sim, variable, "check", ok FROM c{ZOOM} UNION ALL SELECT DISTINCT 'demo', event_type, 'present', TRUE FROM events
UNION ALL SELECT r_name, 'click', 'present', FALSE FROM region"""
)
def registered_checks(spark: SparkSession, d: str) -> DataFrame:
    """Checks of a store against its registry; datasets that are not there fail."""
    store = CellStore(spark, scratch_root(spark))
    store.write_region(_stored(spark, d))
    named = [F.lit("P1D").alias("freq"), F.lit(ZOOM).alias("zoom")]
    there = table(spark, d, "events").select(F.lit("demo").alias("sim"), *named, F.col("event_type").alias("variable"))
    absent = table(spark, d, "region").select(F.col("r_name").alias("sim"), *named, F.lit("click").alias("variable"))
    out = ql.store_checks(store.scan(), ranges=_RANGES, registered=there.union(absent))
    return out.select("sim", "variable", "check", "ok")
