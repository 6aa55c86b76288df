"""Gridded inputs derived from the driver tables, in Spark and in SQL.

The tables hold no gridded fields, so each input states the same expressions
twice: a DataFrame builder and the text of a common table expression.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.functions.axes import GridAxis, LatLonGrid, TimeAxis, floor_hours

ZOOM = 3
N_LAT, N_LON = 18, 36
GRID = LatLonGrid(GridAxis(-85.0, 10.0, N_LAT), GridAxis(5.0, 10.0, N_LON, cyclic=True))
# Rows 4..13 and columns 6..23 of GRID as a limited area.
REGION = LatLonGrid(GridAxis(-45.0, 10.0, 10), GridAxis(65.0, 10.0, 18), regional=True)
CHUNK = 16
MONTH_AXIS = TimeAxis(datetime(2024, 1, 1), datetime(2024, 2, 1), timedelta(hours=1))
COLUMN_TARGETS = tuple(range(10000, 100001, 10000))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(ts: str) -> Column:
    return F.date_trunc("day", F.col(ts)).cast("timestamp_ntz")


def cells(spark: SparkSession, d: str) -> DataFrame:
    """EV: sparse daily cell field at ZOOM, one variable per event type.

    The square root keeps means of means off decimal rounding ties.
    """
    return (
        table(spark, d, "events")
        .groupBy(
            day("ts").alias("time"),
            F.col("event_type").alias("variable"),
            ((F.col("user_id") * 7919 + F.col("event_id")) % 768).alias("healpix_index"),
        )
        .agg(F.avg(F.sqrt("value")).alias("v"))
    )


CELLS_SQL = """ev AS (
  SELECT date_trunc('day', ts)::TIMESTAMP AS "time", event_type AS variable,
         (user_id * 7919 + event_id) % 768 AS healpix_index, avg(sqrt(value)) AS v
  FROM events GROUP BY ALL)"""


def latlon(spark: SparkSession, d: str, time: str = "year") -> DataFrame:
    """LL: lat/lon field per year (dense) or per month (with gaps)."""
    unit = F.date_trunc(time, F.col("l_shipdate")).cast("timestamp_ntz")
    return (
        table(spark, d, "lineitem")
        .groupBy(
            unit.alias("time"),
            (F.lit(-85.0) + 10.0 * (F.col("l_partkey") % N_LAT)).alias("lat"),
            (F.lit(5.0) + 10.0 * (F.col("l_orderkey") % N_LON)).alias("lon"),
        )
        .agg(F.avg(F.sqrt("l_quantity")).alias("v"))
    )


def latlon_sql(time: str = "year") -> str:
    return f"""ll AS (
  SELECT date_trunc('{time}', l_shipdate)::TIMESTAMP AS "time",
         -85e0 + 10e0 * (l_partkey % {N_LAT}) AS lat, 5e0 + 10e0 * (l_orderkey % {N_LON}) AS lon,
         avg(sqrt(l_quantity)) AS v
  FROM lineitem GROUP BY ALL)"""


def columns(spark: SparkSession, d: str) -> DataFrame:
    """COL: irregular vertical columns, one per order."""
    return (
        table(spark, d, "lineitem")
        .groupBy("l_orderkey", F.col("l_extendedprice").alias("p"))
        .agg(F.avg("l_quantity").alias("v"), F.avg("l_discount").alias("x"))
    )


COLUMNS_SQL = """col AS (
  SELECT l_orderkey, l_extendedprice AS p, avg(l_quantity) AS v, avg(l_discount) AS x
  FROM lineitem GROUP BY ALL)"""


def arrivals(spark: SparkSession, d: str) -> DataFrame:
    """MAN: files that arrived, as (sim, cycle, stream)."""
    return table(spark, d, "events").select(
        F.concat(F.lit("sim"), (F.col("user_id") % 29).cast("string")).alias("sim"),
        floor_hours("ts").alias("cycle"),
        F.col("event_type").alias("stream"),
    ).distinct()


ARRIVALS_SQL = """man AS (
  SELECT DISTINCT 'sim' || (user_id % 29) AS sim,
         time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2000-01-01')::TIMESTAMP AS cycle, event_type AS stream
  FROM events)"""


def sources(spark: SparkSession, d: str) -> DataFrame:
    """SRC: long source-field table, one row per field and grid point."""
    u, e = F.col("user_id"), F.col("event_id")
    plane = F.array(*[F.lit(x) for x in ("time", "latitude", "longitude")])
    deep = F.array(*[F.lit(x) for x in ("time", "depth", "latitude", "longitude")])
    return (
        table(spark, d, "events")
        .groupBy(
            F.concat(F.lit("run"), (u % 4).cast("string")).alias("expt"),
            F.col("event_type").alias("field_name"),
            F.concat(F.lit("m01s0"), (u % 3).cast("string")).alias("stash"),
            (u % 2 == 1).alias("averaged"),
            (u % 5 == 4).alias("deep"),
            F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("time"),
            (u % N_LAT).alias("lat_j"),
            (e % N_LON).alias("lon_i"),
        )
        .agg(F.avg(F.sqrt("value")).alias("value"))
        .withColumns(
            {
                "cell_methods": F.when(F.col("averaged"), F.array(F.lit("mean"))).otherwise(
                    F.array().cast("array<string>")
                ),
                "dims": F.when(F.col("deep"), deep).otherwise(plane),
                "units": F.concat(F.lit("u"), F.substring("field_name", 1, 1)),
            }
        )
    )


SOURCES_SQL = f"""src AS (
  SELECT 'run' || (user_id % 4) AS expt, event_type AS field_name, 'm01s0' || (user_id % 3) AS stash,
         user_id % 2 = 1 AS averaged, user_id % 5 = 4 AS deep,
         date_trunc('hour', ts)::TIMESTAMP AS "time",
         user_id % {N_LAT} AS lat_j, event_id % {N_LON} AS lon_i, avg(sqrt(value)) AS value,
         'u' || substr(event_type, 1, 1) AS units
  FROM events GROUP BY ALL)"""


# --- the same geometry in SQL ------------------------------------------------


def lonlat_sql(rel: str, zoom: int | str, columns: str, where: str = "", max_zoom: int = 10) -> str:
    """``SELECT columns FROM rel`` with lon (0..360) and lat of each cell."""
    bits = zoom if isinstance(zoom, int) else max_zoom
    n = f"(1 << {zoom})" if isinstance(zoom, int) else f"(1::BIGINT << {zoom})"
    even = " + ".join(f"(((q >> {2 * k}) & 1) << {k})" for k in range(bits)) or "0"
    odd = " + ".join(f"(((q >> {2 * k + 1}) & 1) << {k})" for k in range(bits)) or "0"
    return f"""SELECT {columns} FROM (
  SELECT *, (45e0 * (CASE WHEN t < 0 THEN t + 8 * nr ELSE t END) / nr) % 360e0 AS lon, degrees(asin(zz)) AS lat FROM (
  SELECT *, jp * nr + ix - iy AS t,
    CASE WHEN jr < n THEN 1e0 - (nr * nr) / (3e0 * n * n) WHEN jr > 3 * n THEN (nr * nr) / (3e0 * n * n) - 1e0
         ELSE (2 * n - jr) * 2e0 / (3e0 * n) END AS zz FROM (
  SELECT *, CASE WHEN jr < n THEN jr WHEN jr > 3 * n THEN 4 * n - jr ELSE n END AS nr FROM (
  SELECT *, (f // 4 + 2) * n - ix - iy - 1 AS jr,
    2 * (f % 4) + CASE WHEN f // 4 = 1 THEN 0 ELSE 1 END AS jp FROM (
  SELECT *, {even} AS ix, {odd} AS iy FROM (
  SELECT *, healpix_index // (n * n) AS f, healpix_index % (n * n) AS q FROM (
  SELECT *, {n} AS n FROM {rel}))))))) {where}"""


def weights_sql(grid: LatLonGrid, zoom: int) -> str:
    """CTEs ``tgt``, ``wide`` and ``wts`` (healpix_index, src_id, w)."""
    west, east, south, north = grid.extent
    where = (
        f"WHERE lon > {west}e0 AND lon < {east}e0 AND lat > {south}e0 AND lat < {north}e0"
        if grid.regional
        else ""
    )
    target = f"(SELECT unnest(range(12 * {4 ** zoom})) AS healpix_index)"
    x = f"(lon - {grid.lon.start}e0) / {grid.lon.step}e0"
    if grid.lon.cyclic:
        x = f"((({x}) % {grid.lon.size}e0) + {grid.lon.size}e0) % {grid.lon.size}e0"
    i0 = "floor(x)" if grid.lon.cyclic else f"least(floor(x), {grid.lon.size - 2})"
    n = grid.lon.size
    return f"""tgt AS ({lonlat_sql(target, zoom, 'healpix_index, lon, lat', where)}),
pos AS (SELECT healpix_index, round((lat - ({grid.lat.start}e0)) / {grid.lat.step}e0, 12) AS y, round({x}, 12) AS x FROM tgt),
cut AS (SELECT healpix_index, y, x, least(floor(y), {grid.lat.size - 2})::BIGINT AS j0, ({i0})::BIGINT AS ii
        FROM pos WHERE y >= 0 AND y <= {grid.lat.size - 1} AND x >= 0 AND x <= {n if grid.lon.cyclic else n - 1}),
wide AS (SELECT healpix_index, j0, ii % {n} AS i0, (ii + 1) % {n} AS i1, y - j0 AS v, x - ii AS u FROM cut),
wts AS (
  SELECT healpix_index, j0 * {n} + i0 AS src_id, 1 - greatest(u, v) AS w FROM wide
  UNION ALL
  SELECT healpix_index, CASE WHEN u >= v THEN j0 * {n} + i1 ELSE (j0 + 1) * {n} + i0 END, abs(u - v) FROM wide
  UNION ALL
  SELECT healpix_index, (j0 + 1) * {n} + i1, least(u, v) FROM wide)"""


def src_id_sql(grid: LatLonGrid) -> str:
    return (
        f"(round((lat - ({grid.lat.start}e0)) / {grid.lat.step}e0)::BIGINT * {grid.lon.size}"
        f" + round((lon - ({grid.lon.start}e0)) / {grid.lon.step}e0)::BIGINT)"
    )
