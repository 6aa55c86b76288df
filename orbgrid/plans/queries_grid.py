"""Queries on cells, weights, regridding, pyramids and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.functions.healpix import chunk_id, npix, parent, with_lonlat
from orbgrid.functions.scalars import to_percent
from orbgrid.operators import pyramid as pyr
from orbgrid.operators import reduce as red
from orbgrid.operators.joins import attach
from orbgrid.operators.regional import (
    active_cells,
    cells_in_extent,
    chunks_touched,
    domain_bounds,
    expand_chunks,
    fill_active,
    gather_regional,
    scatter_global,
)
from orbgrid.operators.regrid import regrid
from orbgrid.operators.weights import build_weights, explode_corners, inside_extent
from orbgrid.plans.inputs import (
    CELLS_SQL,
    CHUNK,
    GRID,
    REGION,
    ZOOM,
    cells,
    latlon,
    latlon_sql,
    lonlat_sql,
    src_id_sql,
    table,
    weights_sql,
)
from orbgrid.plans.registry import register

EXTENT = REGION.extent
WEST, EAST, SOUTH, NORTH = EXTENT
INSIDE_SQL = f"lon > {WEST}e0 AND lon < {EAST}e0 AND lat > {SOUTH}e0 AND lat < {NORTH}e0"
NPIX = npix(ZOOM)
FINE = 6


def r6(c: str, name: str | None = None):
    return F.round(F.col(c), 6).alias(name or c)


# --- cell arithmetic ---------------------------------------------------------


@register(
    f"""WITH {CELLS_SQL} {lonlat_sql('ev', ZOOM, '"time", variable, healpix_index, round(v, 6) AS v, round(lon, 6) AS lon, round(lat, 6) AS lat')}"""
)
def attach_coords(spark: SparkSession, d: str) -> DataFrame:
    out = with_lonlat(cells(spark, d), ZOOM)
    return out.select("time", "variable", "healpix_index", r6("v"), r6("lon"), r6("lat"))


@register(
    f"""WITH {CELLS_SQL}, c AS (SELECT healpix_index, count(*) AS n_values FROM ev GROUP BY ALL),
p AS ({lonlat_sql('c', ZOOM, '*')})
SELECT healpix_index, n_values, round(CASE WHEN lon <= 180 THEN lon ELSE lon - 360 END, 6) AS lon, round(lat, 6) AS lat,
       healpix_index >> 2 AS parent, healpix_index >> 6 AS ancestor_3, healpix_index * 4 AS first_child,
       healpix_index // {CHUNK} AS chunk
FROM p"""
)
def attach_coords_signed(spark: SparkSession, d: str) -> DataFrame:
    ip = F.col("healpix_index")
    per_cell = cells(spark, d).groupBy(ip).agg(F.count(F.lit(1)).alias("n_values"))
    return with_lonlat(per_cell, ZOOM, signed=True).select(
        ip, "n_values", r6("lon"), r6("lat"),
        parent(ip).alias("parent"), parent(ip, 3).alias("ancestor_3"),
        F.shiftleft(ip, 2).alias("first_child"), chunk_id(ip, CHUNK).alias("chunk"),
    )


@register(
    f"""WITH {CELLS_SQL}, kids AS (SELECT DISTINCT healpix_index AS parent_cell, unnest(range(healpix_index * 4, healpix_index * 4 + 4)) AS healpix_index FROM (SELECT DISTINCT healpix_index FROM ev)),
kc AS ({lonlat_sql('kids', ZOOM + 1, '*')}), pc AS ({lonlat_sql('(SELECT DISTINCT healpix_index FROM ev)', ZOOM, '*')})
SELECT pc.healpix_index AS parent_cell, round(pc.lat, 6) AS lat, round(avg(kc.lat), 6) AS child_lat, count(*) AS n_children
FROM kc JOIN pc ON kc.parent_cell = pc.healpix_index GROUP BY ALL"""
)
def children_drill(spark: SparkSession, d: str) -> DataFrame:
    """Cells joined with their children one zoom finer."""
    seen = cells(spark, d).select("healpix_index").distinct()
    coarse = with_lonlat(seen, ZOOM).select(F.col("healpix_index").alias("parent_cell"), "lat")
    first = F.shiftleft("healpix_index", 2)
    kids = seen.select(F.explode(F.sequence(first, first + 3)).alias("healpix_index"))
    fine = with_lonlat(kids, ZOOM + 1).select(parent("healpix_index").alias("parent_cell"), F.col("lat").alias("_lat"))
    return attach(fine, coarse, ["parent_cell"], max_rows=NPIX).groupBy("parent_cell", "lat").agg(
        F.round(F.avg("_lat"), 6).alias("child_lat"), F.count(F.lit(1)).alias("n_children")
    ).withColumn("lat", F.round("lat", 6))


# --- weights and regridding --------------------------------------------------

_OBS_SQL = f"""obs AS (SELECT {src_id_sql(GRID)} AS src_id, sum(n) AS n_obs FROM (
  SELECT -85e0 + 10e0 * (l_partkey % 18) AS lat, 5e0 + 10e0 * (l_orderkey % 36) AS lon, count(*) AS n
  FROM lineitem GROUP BY ALL) GROUP BY 1)"""


def _observed(spark: SparkSession, d: str, grid) -> DataFrame:
    """Rows of the source table behind each grid point."""
    points = table(spark, d, "lineitem").select(
        (F.lit(-85.0) + 10.0 * (F.col("l_partkey") % 18)).alias("lat"),
        (F.lit(5.0) + 10.0 * (F.col("l_orderkey") % 36)).alias("lon"),
    )
    west, east, south, north = grid.extent
    if grid.regional:
        points = points.filter(F.col("lat").between(south, north) & F.col("lon").between(west, east))
    return grid.with_src_id(points).groupBy("src_id").agg(F.count(F.lit(1)).alias("n_obs"))


def _weights_used(spark: SparkSession, d: str, grid) -> DataFrame:
    long = explode_corners(build_weights(spark, grid, ZOOM))
    return attach(long, _observed(spark, d, grid), ["src_id"], max_rows=grid.size).select(
        "healpix_index", "src_id", r6("w"), "n_obs"
    )


@register(
    f"""WITH {_OBS_SQL}, {weights_sql(GRID, ZOOM)}
SELECT healpix_index, src_id, round(w, 6) AS w, n_obs::BIGINT AS n_obs FROM wts JOIN obs USING (src_id)"""
)
def weights_latlon(spark: SparkSession, d: str) -> DataFrame:
    return _weights_used(spark, d, GRID)


@register(
    f"""WITH robs AS (SELECT {src_id_sql(REGION)} AS src_id, count(*) AS n_obs FROM (
  SELECT -85e0 + 10e0 * (l_partkey % 18) AS lat, 5e0 + 10e0 * (l_orderkey % 36) AS lon FROM lineitem)
  WHERE lat BETWEEN {SOUTH} AND {NORTH} AND lon BETWEEN {WEST} AND {EAST} GROUP BY 1), {weights_sql(REGION, ZOOM)}
SELECT healpix_index, src_id, round(w, 6) AS w, n_obs FROM wts JOIN robs USING (src_id)"""
)
def weights_regional(spark: SparkSession, d: str) -> DataFrame:
    return _weights_used(spark, d, REGION)


def _regrid_sql(time: str, grid=GRID, where: str = "") -> str:
    return f"""WITH {latlon_sql(time)}, fld AS (SELECT "time", {src_id_sql(grid)} AS src_id, v FROM ll {where}),
{weights_sql(grid, ZOOM)},
hp AS (SELECT "time", healpix_index, CASE WHEN count(v) = 3 THEN sum(v * w) END AS v
       FROM fld JOIN wts USING (src_id) GROUP BY ALL)"""


_PLAIN = 'SELECT "time", healpix_index, round(v, 6) AS v FROM hp WHERE v IS NOT NULL'


@register(f"{_regrid_sql('year')} {_PLAIN}")
def regrid_latlon(spark: SparkSession, d: str) -> DataFrame:
    """Yearly field onto cells."""
    return regrid(latlon(spark, d), GRID, ZOOM, ["time"], ["v"]).select("time", "healpix_index", r6("v"))


@register(_regrid_sql("year").replace(weights_sql(GRID, ZOOM), weights_sql(GRID, FINE)) + " " + _PLAIN)
def regrid_fine(spark: SparkSession, d: str) -> DataFrame:
    """Yearly field onto a fine zoom: many more cells than grid points."""
    return regrid(latlon(spark, d), GRID, FINE, ["time"], ["v"]).select("time", "healpix_index", r6("v"))


@register(f"{_regrid_sql('month')} {_PLAIN}")
def regrid_with_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Monthly field with absent points: a cell needs all three of its corners."""
    return regrid(latlon(spark, d, "month"), GRID, ZOOM, ["time"], ["v"]).select("time", "healpix_index", r6("v"))


@register(f"{_regrid_sql('month')} {_PLAIN}")
def regrid_tiled(spark: SparkSession, d: str) -> DataFrame:
    """The same through the plan for large weights, twelve months side by side."""
    field = latlon(spark, d, "month").withColumn("month", 12 * F.year("time") + F.month("time") - 1)
    out = regrid(field, GRID, ZOOM, ["month"], ["v"], strategy="tiled", tile=6, pack="month")
    first = F.make_timestamp_ntz(
        F.floor(F.col("month") / 12.0).cast("int"), (F.col("month") % 12 + 1).cast("int"),
        F.lit(1), F.lit(0), F.lit(0), F.lit(0),
    )
    return out.select(first.alias("time"), "healpix_index", r6("v"))


def _region(spark: SparkSession, d: str) -> DataFrame:
    field = latlon(spark, d)
    return field.filter(F.col("lat").between(SOUTH, NORTH) & F.col("lon").between(WEST, EAST))


_IN_REGION = f"WHERE lat BETWEEN {SOUTH} AND {NORTH} AND lon BETWEEN {WEST} AND {EAST}"


@register(
    f"""{_regrid_sql('year', REGION, _IN_REGION)},
act AS (SELECT unnest(range(chunk * {CHUNK}, (chunk + 1) * {CHUNK})) AS healpix_index FROM (SELECT DISTINCT healpix_index // {CHUNK} AS chunk FROM tgt)),
spine AS (SELECT "time", healpix_index FROM (SELECT DISTINCT "time" FROM fld), act)
SELECT "time", healpix_index, round(v, 6) AS v FROM spine LEFT JOIN hp USING ("time", healpix_index)"""
)
def regrid_regional(spark: SparkSession, d: str) -> DataFrame:
    """Limited area: values inside the extent, the rest of each touched chunk missing."""
    hp = regrid(_region(spark, d), REGION, ZOOM, ["time"], ["v"])
    touched = chunks_touched(cells_in_extent(spark, EXTENT, ZOOM), CHUNK)
    chunks = sorted(r.chunk for r in touched.collect())  # at most NPIX / CHUNK numbers
    return fill_active(hp, ["time"], chunks, CHUNK).select("time", "healpix_index", r6("v"))


# --- pyramids ----------------------------------------------------------------

_KEYS = ["time", "variable"]


@register(
    f"""WITH {CELLS_SQL} SELECT "time", variable, healpix_index >> 2 AS healpix_index, round(avg(v), 6) AS v FROM ev GROUP BY ALL"""
)
def coarsen_one(spark: SparkSession, d: str) -> DataFrame:
    return pyr.coarsen(cells(spark, d), _KEYS, ["v"]).select(*_KEYS, "healpix_index", r6("v"))


def _chain_sql(rel: str, keys: str, values: list[str], top: int = ZOOM) -> str:
    """CTEs z<top> .. z0 chained by means of four."""
    means = ", ".join(f"avg({v}) AS {v}" for v in values)
    out = [f"z{top} AS (SELECT {keys} healpix_index, {', '.join(values)} FROM {rel})"]
    for z in range(top - 1, -1, -1):
        out.append(
            f"z{z} AS (SELECT {keys} healpix_index >> 2 AS healpix_index, {means} FROM z{z + 1} GROUP BY ALL)"
        )
    return ", ".join(out)


def _levels_sql(keys: str, values: list[str], top: int = ZOOM) -> str:
    cols = ", ".join(f"round({v}, 6) AS {v}" for v in values)
    return " UNION ALL ".join(
        f"SELECT {z} AS zoom, {keys} healpix_index, {cols} FROM z{z}" for z in range(top, -1, -1)
    )


_K = '"time", variable,'


@register(f"WITH {CELLS_SQL}, {_chain_sql('ev', _K, ['v'])} {_levels_sql(_K, ['v'])}")
def pyramid_all(spark: SparkSession, d: str) -> DataFrame:
    """All zooms by chained means, three aggregations behind one shuffle."""
    out = pyr.pyramid(cells(spark, d), _KEYS, ["v"], ZOOM)
    return out.select("zoom", *_KEYS, "healpix_index", r6("v"))


@register(
    f"""WITH ll AS (SELECT -85e0 + 10e0 * (l_partkey % 18) AS lat, 5e0 + 10e0 * (l_orderkey % 36) AS lon,
  avg(sqrt(l_extendedprice)) AS orog, avg(sqrt(l_discount)) * 100 AS sftlf FROM lineitem GROUP BY ALL),
fld AS (SELECT {src_id_sql(GRID)} AS src_id, orog, sftlf FROM ll), {weights_sql(GRID, ZOOM)},
hp AS (SELECT healpix_index, CASE WHEN count(orog) = 3 THEN sum(orog * w) END AS orog,
  CASE WHEN count(sftlf) = 3 THEN sum(sftlf * w) END AS sftlf FROM fld JOIN wts USING (src_id) GROUP BY ALL HAVING count(*) = 3),
{_chain_sql('hp', '', ['orog', 'sftlf'])} {_levels_sql('', ['orog', 'sftlf'])}"""
)
def static_pyramid(spark: SparkSession, d: str) -> DataFrame:
    """Terrain height and land share (in percent) at every zoom."""
    static = (
        table(spark, d, "lineitem")
        .groupBy(
            (F.lit(-85.0) + 10.0 * (F.col("l_partkey") % 18)).alias("lat"),
            (F.lit(5.0) + 10.0 * (F.col("l_orderkey") % 36)).alias("lon"),
        )
        .agg(F.avg(F.sqrt("l_extendedprice")).alias("orog"), F.avg(F.sqrt("l_discount")).alias("sftlf"))
        .withColumn("sftlf", to_percent(F.col("sftlf")))
    )
    hp = regrid(static, GRID, ZOOM, [], ["orog", "sftlf"])
    out = pyr.pyramid(hp, [], ["orog", "sftlf"], ZOOM)
    return out.select("zoom", "healpix_index", r6("orog"), r6("sftlf"))


@register(
    f"""WITH {CELLS_SQL}, st AS (SELECT l_suppkey % {NPIX} AS healpix_index, avg(l_extendedprice) AS orog, avg(l_discount) * 100 AS sftlf FROM lineitem GROUP BY ALL)
SELECT "time", variable, count(*) AS n, count(orog) AS n_static, round(avg(orog), 4) AS orog, round(avg(sftlf), 4) AS sftlf
FROM ev LEFT JOIN st USING (healpix_index) GROUP BY ALL"""
)
def static_attach(spark: SparkSession, d: str) -> DataFrame:
    """Static fields of a zoom attached to every step of it."""
    static = table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % NPIX).alias("healpix_index")).agg(
        F.avg("l_extendedprice").alias("orog"), to_percent(F.avg("l_discount")).alias("sftlf")
    )
    both = attach(cells(spark, d), static, ["healpix_index"], "left", max_rows=NPIX)
    return both.groupBy("time", "variable").agg(
        F.count(F.lit(1)).alias("n"), F.count("orog").alias("n_static"),
        F.round(F.avg("orog"), 4).alias("orog"), F.round(F.avg("sftlf"), 4).alias("sftlf"),
    )


# --- coverage weights --------------------------------------------------------

_FIRST_SQL = 'f AS (SELECT * FROM ev WHERE "time" = (SELECT min("time") FROM ev))'
_W1_SQL = "w1 AS (SELECT variable, healpix_index >> 2 AS healpix_index, count(v) / 4e0 AS weights FROM f GROUP BY ALL)"


@register(f"WITH {CELLS_SQL}, {_FIRST_SQL}, {_W1_SQL} SELECT * FROM w1")
def coverage_weights_1(spark: SparkSession, d: str) -> DataFrame:
    return pyr.coverage_weights(pyr.at_first_step(cells(spark, d)), "v", keys=["variable"])


@register(
    f"""WITH {CELLS_SQL}, {_FIRST_SQL}, {_W1_SQL}
SELECT variable, healpix_index >> 2 AS healpix_index, avg(weights) AS weights FROM w1 GROUP BY ALL"""
)
def coverage_weights_2(spark: SparkSession, d: str) -> DataFrame:
    return pyr.coverage_weights(pyr.at_first_step(cells(spark, d)), "v", depth=2, keys=["variable"])


@register(
    f"""WITH {CELLS_SQL}, {_FIRST_SQL}, {_W1_SQL},
c AS (SELECT "time", variable, healpix_index >> 2 AS healpix_index, avg(v) AS v FROM ev GROUP BY ALL)
SELECT "time", variable, round(sum(v * weights) / sum(CASE WHEN v IS NOT NULL THEN weights END), 6) AS v, count(*) AS n_cells
FROM c JOIN w1 USING (variable, healpix_index) GROUP BY ALL"""
)
def weighted_domain_mean(spark: SparkSession, d: str) -> DataFrame:
    """Domain mean one zoom down, weighted by how much of each cell has data."""
    ev = cells(spark, d)
    w = pyr.coverage_weights(pyr.at_first_step(ev), "v", keys=["variable"])
    both = attach(pyr.coarsen(ev, _KEYS, ["v"]), w, ["variable", "healpix_index"])
    means = red.weighted_domain_mean(both, _KEYS, ["v"])
    counts = both.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("n_cells"))
    return means.join(counts, _KEYS).select(*_KEYS, r6("v"), "n_cells")


# --- regions -----------------------------------------------------------------


@register(
    f"""WITH {CELLS_SQL}, {'inside AS (' + lonlat_sql('ev', ZOOM, '*', 'WHERE ' + INSIDE_SQL) + ')'},
c AS (SELECT healpix_index // {CHUNK} AS chunk, count(*) AS n_values FROM inside GROUP BY ALL)
SELECT chunk, unnest(range(chunk * {CHUNK}, (chunk + 1) * {CHUNK})) AS healpix_index, n_values FROM c"""
)
def active_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks with data strictly inside the extent, expanded to all their cells."""
    inside = inside_extent(with_lonlat(cells(spark, d), ZOOM), EXTENT)
    chunks = inside.groupBy(chunk_id("healpix_index", CHUNK).alias("chunk")).agg(F.count(F.lit(1)).alias("n_values"))
    return expand_chunks(chunks, CHUNK).select("chunk", "healpix_index", "n_values")


@register(
    f"""WITH {CELLS_SQL}, k AS (SELECT DISTINCT "time", variable FROM ev),
spine AS (SELECT *, unnest(range({NPIX})) AS healpix_index FROM k)
SELECT "time", variable, healpix_index, round(v, 6) AS v FROM spine LEFT JOIN ev USING ("time", variable, healpix_index)"""
)
def scatter_to_global(spark: SparkSession, d: str) -> DataFrame:
    return scatter_global(cells(spark, d), _KEYS, ZOOM).select(*_KEYS, "healpix_index", r6("v"))


@register(
    f"""WITH {CELLS_SQL}, inside AS ({lonlat_sql('(SELECT unnest(range(%d)) AS healpix_index)' % NPIX, ZOOM, 'healpix_index', 'WHERE ' + INSIDE_SQL)}),
act AS (SELECT DISTINCT healpix_index // {CHUNK} AS chunk FROM inside)
SELECT "time", variable, healpix_index, round(v, 6) AS v FROM ev WHERE healpix_index // {CHUNK} IN (SELECT chunk FROM act)"""
)
def gather_to_regional(spark: SparkSession, d: str) -> DataFrame:
    active = active_cells(spark, EXTENT, ZOOM, CHUNK)
    return gather_regional(cells(spark, d), active, ZOOM).select(*_KEYS, "healpix_index", r6("v"))


@register(
    f"""WITH {CELLS_SQL}, inside AS ({lonlat_sql('(SELECT unnest(range(%d)) AS healpix_index)' % (NPIX // 4), ZOOM - 1, 'healpix_index', 'WHERE ' + INSIDE_SQL)}),
act AS (SELECT DISTINCT healpix_index // {CHUNK} AS chunk FROM inside),
c AS (SELECT "time", variable, healpix_index >> 2 AS healpix_index, avg(v) AS v FROM ev GROUP BY ALL)
SELECT "time", variable, healpix_index, round(v, 6) AS v FROM c WHERE healpix_index // {CHUNK} IN (SELECT chunk FROM act)"""
)
def coarsen_regional(spark: SparkSession, d: str) -> DataFrame:
    """Coarsen, then keep the active cells of the coarser zoom."""
    coarse = pyr.coarsen(cells(spark, d), _KEYS, ["v"])
    active = active_cells(spark, EXTENT, ZOOM - 1, CHUNK)
    return gather_regional(coarse, active, ZOOM - 1).select(*_KEYS, "healpix_index", r6("v"))


@register(
    f"""WITH {latlon_sql()} SELECT "time", round(min(lat), 3) AS lower_left_lat, round(min(lon) % 360, 3) AS lower_left_lon,
round(max(lat), 3) AS upper_right_lat, round(max(lon) % 360, 3) AS upper_right_lon FROM ll {_IN_REGION} GROUP BY ALL"""
)
def regional_bounds(spark: SparkSession, d: str) -> DataFrame:
    return domain_bounds(_region(spark, d), ["time"])


# --- reductions --------------------------------------------------------------


@register(
    f"""WITH {CELLS_SQL}, {_chain_sql('ev', _K, ['v'])}, allz AS ({' UNION ALL '.join(f'SELECT {z} AS zoom, * FROM z{z}' for z in range(ZOOM + 1))})
SELECT zoom, "time", variable, round(avg(v), 6) AS v FROM allz GROUP BY ALL"""
)
def domain_mean_series(spark: SparkSession, d: str) -> DataFrame:
    out = pyr.pyramid(cells(spark, d), _KEYS, ["v"], ZOOM)
    return red.domain_mean(out, ["zoom", *_KEYS], ["v"]).select("zoom", *_KEYS, r6("v"))


@register(
    f"""WITH {CELLS_SQL}, {_chain_sql('ev', _K, ['v'])}, allz AS ({' UNION ALL '.join(f'SELECT {z} AS zoom, * FROM z{z}' for z in range(ZOOM + 1))}),
m AS (SELECT zoom, variable, healpix_index, avg(v) AS v FROM allz GROUP BY ALL),
p AS ({lonlat_sql('m', 'zoom', 'zoom, variable, v, ceil(round((lat + 90) / 0.1e0, 9))::INT AS lat_bin', '', ZOOM)})
SELECT zoom, variable, lat_bin, round(avg(v), 6) AS v, round((lat_bin - 0.5e0) * 0.1e0 - 90, 6) AS lat_mid FROM p GROUP BY ALL"""
)
def zonal_mean(spark: SparkSession, d: str) -> DataFrame:
    """Mean over time, then over 0.1 degree latitude bins, for every zoom."""
    out = with_lonlat(pyr.pyramid(cells(spark, d), _KEYS, ["v"], ZOOM), "zoom")
    means = red.zonal_mean(out, ["zoom", "variable"], "v", ["healpix_index"])
    return means.select("zoom", "variable", "lat_bin", r6("v"), r6("lat_mid"))


@register(
    f"""WITH {CELLS_SQL} SELECT variable, round(min(v), 6) AS vmin, round(max(v), 6) AS vmax FROM ev GROUP BY ALL"""
)
def field_extent(spark: SparkSession, d: str) -> DataFrame:
    return red.field_extent(cells(spark, d), ["variable"], "v").select("variable", r6("vmin"), r6("vmax"))


_MEASURES = "SELECT 'qty_anomaly' AS variable, l_quantity - 25.5e0 AS v FROM lineitem UNION ALL SELECT 'price', l_extendedprice FROM lineitem UNION ALL SELECT 'discount', l_discount FROM lineitem"


def _measures(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    pairs = F.array(
        F.struct(F.lit("qty_anomaly").alias("variable"), (F.col("l_quantity") - 25.5).alias("v")),
        F.struct(F.lit("price").alias("variable"), F.col("l_extendedprice").alias("v")),
        F.struct(F.lit("discount").alias("variable"), F.col("l_discount").alias("v")),
    )
    return li.select(F.inline(pairs))


@register(
    f"""WITH m AS ({_MEASURES}), r AS (SELECT variable, coalesce(abs(max(v) + min(v)) / (max(v) - min(v)) < 0.5, false) AS diverging,
greatest(abs(quantile_cont(v, 0.02)), abs(quantile_cont(v, 0.98))) AS b FROM m GROUP BY ALL)
SELECT variable, diverging, round(CASE WHEN diverging THEN -b END, 6) AS vmin, round(CASE WHEN diverging THEN b END, 6) AS vmax FROM r"""
)
def robust_range(spark: SparkSession, d: str) -> DataFrame:
    out = red.robust_range(_measures(spark, d), ["variable"], "v", max_groups=3)
    return out.select("variable", "diverging", r6("vmin"), r6("vmax"))


@register(
    f"""WITH m AS ({_MEASURES}) SELECT variable, prob, round(q, 6) AS quantile FROM (
SELECT variable, unnest([0.02e0, 0.5e0, 0.98e0]) AS prob, unnest(quantile_cont(v, [0.02, 0.5, 0.98])) AS q FROM m GROUP BY variable)"""
)
def exact_percentiles(spark: SparkSession, d: str) -> DataFrame:
    out = red.exact_quantiles(_measures(spark, d), ["variable"], "v", (0.02, 0.5, 0.98), max_groups=3)
    return out.select("variable", "prob", r6("quantile"))


_WIDE = """SELECT l_linestatus AS variable, CASE l_orderkey % 997 WHEN 0 THEN 'Infinity'::DOUBLE WHEN 1 THEN '-Infinity'::DOUBLE
ELSE (l_quantity - 25) * ('1e' || (l_partkey % 121 - 60))::DOUBLE END AS v FROM lineitem"""


@register(
    f"""WITH m AS ({_WIDE}) SELECT variable, prob, sign(q)::BIGINT AS side, round(log10(abs(q)), 6) AS magnitude FROM (
SELECT variable, unnest([0.02e0, 0.4e0, 0.7e0, 0.98e0]) AS prob, unnest(quantile_cont(v, [0.02, 0.4, 0.7, 0.98])) AS q FROM m GROUP BY variable)"""
)
def wide_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles of values over 120 powers of ten, infinities among them, from small windows."""
    odd = F.col("l_orderkey") % 997
    power = F.concat(F.lit("1e"), F.col("l_partkey") % 121 - 60).cast("double")
    v = F.when(odd == 0, F.lit(float("inf"))).when(odd == 1, F.lit(float("-inf"))).otherwise((F.col("l_quantity") - 25) * power)
    values = table(spark, d, "lineitem").select(F.col("l_linestatus").alias("variable"), v.alias("v"))
    out = red.exact_quantiles(values, ["variable"], "v", (0.02, 0.4, 0.7, 0.98), window=16, max_groups=2)
    return out.select("variable", "prob", F.signum("quantile").cast("bigint").alias("side"), F.round(F.log10(F.abs("quantile")), 6).alias("magnitude"))
