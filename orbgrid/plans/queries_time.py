"""Queries on time axes, variable mapping and vertical columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.functions.axes import floor_hours, hpa_to_pa, parse_cycle, shift_minutes
from orbgrid.functions.scalars import invert_sign, to_percent
from orbgrid.operators import mapping as mp
from orbgrid.operators import timeline as tl
from orbgrid.operators.mapping import FieldRule, VariableSpec
from orbgrid.operators.reduce import vertical_profile as level_means
from orbgrid.operators.vertical import interpolate_levels, times_differ
from orbgrid.plans.inputs import (
    COLUMN_TARGETS,
    COLUMNS_SQL,
    MONTH_AXIS,
    SOURCES_SQL,
    columns,
    sources,
    table,
)
from orbgrid.plans.queries_grid import r6
from orbgrid.plans.registry import register

_AXIS0 = "TIMESTAMP '2024-01-01'"
_LAST = MONTH_AXIS.size - 1

# --- time --------------------------------------------------------------------


@register(
    f"""WITH s AS (SELECT event_id, ts, least(greatest(round(epoch_us(ts - {_AXIS0}) / 3.6e9)::BIGINT, 0), {_LAST}) AS time_idx
  FROM (SELECT event_id, ts FROM events))
SELECT event_id, time_idx, {_AXIS0} + to_hours(time_idx::INT) AS snapped,
  abs(epoch_us(ts - ({_AXIS0} + to_hours(time_idx::INT)))) < 300000000 AS on_axis FROM s"""
)
def time_snap_5min(spark: SparkSession, d: str) -> DataFrame:
    """Nearest hourly stamp and whether it lies within five minutes."""
    ev = table(spark, d, "events").select("event_id", F.col("ts").alias("time"))
    return tl.snap_time(ev, MONTH_AXIS).select("event_id", "time_idx", "snapped", "on_axis")


_HALF_SQL = """h AS (SELECT event_type || (user_id % 50) AS field_name,
  date_trunc('hour', ts)::TIMESTAMP + CASE WHEN user_id % 50 % 3 = 0 THEN INTERVAL 30 MINUTE
    WHEN user_id % 50 % 3 = 1 AND user_id % 2 = 0 THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END AS "time", value FROM events)"""


@register(
    f"""WITH {_HALF_SQL}, f AS (SELECT field_name, bool_and(minute("time") = 30 AND second("time") = 0) AS halfpast FROM h GROUP BY 1)
SELECT field_name, "time" + CASE WHEN halfpast THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END AS "time", halfpast, count(*) AS n
FROM h JOIN f USING (field_name) GROUP BY ALL"""
)
def halfpast_shift(spark: SparkSession, d: str) -> DataFrame:
    """Fields stamped at half past throughout move to the next full hour."""
    u = F.col("user_id") % 50
    half = (u % 3 == 0) | ((u % 3 == 1) & (F.col("user_id") % 2 == 0))
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    ev = table(spark, d, "events").select(
        F.concat("event_type", u.cast("string")).alias("field_name"),
        F.when(half, shift_minutes(hour, 30)).otherwise(hour).alias("time"),
    )
    out = tl.shift_halfpast(ev, ["field_name"])
    return out.groupBy("field_name", "time", "halfpast").agg(F.count(F.lit(1)).alias("n"))


@register(
    """WITH r AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY user_id, event_type) AS n
  FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
SELECT event_id, user_id, event_type, value FROM r WHERE n <> 13 OR rn > 1"""
)
def trim_first_of_13(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events")
    return tl.trim_first(ev, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "event_id", "user_id", "event_type", "value"
    )


@register(
    f"""WITH s AS (SELECT event_type || user_id AS series, event_id,
  date_trunc('hour', ts)::TIMESTAMP + CASE WHEN user_id % 3 = 0 THEN INTERVAL 30 MINUTE
    WHEN user_id % 3 = 1 AND ts > TIMESTAMP '2024-01-03' THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END AS t FROM events),
d AS (SELECT DISTINCT series, t FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY t) AS rn, count(*) OVER (PARTITION BY series) AS n FROM d),
k AS (SELECT series, t FROM r WHERE n <> 13 OR rn > 1),
h AS (SELECT series, bool_and(minute(t) = 30 AND second(t) = 0) AS half FROM k GROUP BY 1)
SELECT series, event_id, t + CASE WHEN half THEN INTERVAL 30 MINUTE ELSE INTERVAL 0 MINUTE END AS "time" FROM s JOIN k USING (series, t) JOIN h USING (series)"""
)
def settle_times(spark: SparkSession, d: str) -> DataFrame:
    """Surplus first steps dropped and half-past series shifted, in one pass."""
    u = F.col("user_id") % 3
    late = F.col("ts") > F.lit("2024-01-03").cast("timestamp_ntz")
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    ev = table(spark, d, "events").select(
        F.concat("event_type", F.col("user_id").cast("string")).alias("series"),
        "event_id",
        F.when((u == 0) | ((u == 1) & late), shift_minutes(hour, 30)).otherwise(hour).alias("time"),
    )
    return tl.settle_times(ev, ["series"]).select("series", "event_id", "time")


_DAYS_SQL = """dd AS (SELECT event_id, user_id, date_trunc('day', ts)::TIMESTAMP AS "time" FROM events),
pr AS (SELECT user_id, count(DISTINCT date_trunc('day', ts)) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1)"""


@register(
    f"""WITH {_DAYS_SQL}, t AS (SELECT DISTINCT user_id, "time" FROM dd),
rk AS (SELECT user_id, "time", row_number() OVER (PARTITION BY user_id ORDER BY "time" DESC) AS rn FROM t)
SELECT event_id, dd.user_id, dd."time" FROM dd JOIN rk USING (user_id, "time") JOIN pr USING (user_id) WHERE rn <= n"""
)
def trim_last_n(spark: SparkSession, d: str) -> DataFrame:
    """Keep as many trailing days per user as that user has purchase days."""
    ev = table(spark, d, "events").withColumn("time", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    steps = (
        ev.filter(F.col("event_type") == "purchase").groupBy("user_id").agg(F.count_distinct("time").alias("n"))
    )
    return tl.trim_last(ev, ["user_id"], steps).select("event_id", "user_id", "time")


@register(
    """SELECT time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '2000-01-01')::TIMESTAMP AS cycle, event_type, count(*) AS n, round(avg(value), 6) AS v
FROM events GROUP BY ALL"""
)
def floor_12h(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(floor_hours("ts").alias("cycle"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("v")
    )


@register(
    f"""WITH p AS (SELECT user_id, event_type, ts, least(greatest(round(epoch_us(ts - {_AXIS0}) / 3.6e9)::BIGINT, 0), {_LAST}) AS time_idx FROM events),
o AS (SELECT *, abs(epoch_us(ts - {_AXIS0}) - time_idx * 3600000000) < 1500000000 AS fits FROM p),
s AS (SELECT DISTINCT user_id, event_type, time_idx FROM o WHERE fits),
g AS (SELECT *, lag(time_idx) OVER (PARTITION BY user_id, event_type ORDER BY time_idx) AS prev_idx FROM s)
SELECT user_id, event_type, time_idx, prev_idx, time_idx - prev_idx - 1 AS n_missing, NULL::BIGINT AS n_off_axis FROM g WHERE time_idx - prev_idx > 1
UNION ALL SELECT user_id, event_type, NULL, NULL, NULL, count(DISTINCT ts) FROM o WHERE NOT fits GROUP BY ALL"""
)
def time_axis_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Gaps between hours within 25 minutes of an event, and how many times fit no hour of the month."""
    return tl.axis_gaps(
        table(spark, d, "events"), ["user_id", "event_type"], MONTH_AXIS, time="ts", tolerance_minutes=25.0
    )


@register(
    """WITH s AS (SELECT 'run.' || event_type || '_' || CASE WHEN user_id % 2 = 0 THEN strftime(ts, '%Y%m%dT%H%MZ') ELSE strftime(ts, '%Y%m%dT%H') END AS stem, ts, user_id FROM events)
SELECT stem, CASE WHEN user_id % 2 = 0 THEN date_trunc('minute', ts) ELSE date_trunc('hour', ts) END::TIMESTAMP AS cycle, count(*) AS n FROM s GROUP BY ALL"""
)
def parse_cycle_time(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts")
    stamp = F.when(
        F.col("user_id") % 2 == 0, F.date_format(ts, "yyyyMMdd'T'HHmm'Z'")
    ).otherwise(F.date_format(ts, "yyyyMMdd'T'HH"))
    stems = table(spark, d, "events").select(F.concat(F.lit("run."), "event_type", F.lit("_"), stamp).alias("stem"))
    out = stems.groupBy("stem").agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("cycle", parse_cycle("stem"))


@register(
    """SELECT event_type, count(*) AS n, round(avg(value), 6) AS v FROM events
WHERE ts <= TIMESTAMP '2024-01-20 06:00:00' AND ts >= TIMESTAMP '2024-01-03' GROUP BY ALL"""
)
def time_slice(spark: SparkSession, d: str) -> DataFrame:
    """End-time limit and slice by value; both reach the scan."""
    lim = (F.col("ts") <= F.lit("2024-01-20 06:00:00").cast("timestamp_ntz")) & (
        F.col("ts") >= F.lit("2024-01-03").cast("timestamp_ntz")
    )
    return table(spark, d, "events").filter(lim).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("v")
    )


# --- mapping -----------------------------------------------------------------

# Variables over the event types of the driver tables, in the shapes the real
# configuration uses: plain, by code, by cell methods, sums and post-processing.
DEMO_SPECS = (
    VariableSpec("clk", "clicks", (FieldRule("click"),)),
    VariableSpec("err", "errors_by_code", (FieldRule("error", stash="m01s01"),)),
    VariableSpec("pur", "mean_purchases", (FieldRule("purchase", averaged=True),), post=invert_sign),
    VariableSpec("vpc", "view_percent", (FieldRule("view", averaged=False),), post=to_percent, units="%"),
    VariableSpec(
        "tot", "signup_plus_view",
        (FieldRule("signup", averaged=False), FieldRule("view", averaged=False)), ("+",), attrs={"notes": "sum"},
    ),
    VariableSpec(
        "mix", "click_minus_error_times_view",
        (FieldRule("click", averaged=False), FieldRule("error", averaged=False), FieldRule("view", averaged=False)),
        ("-", "*"),
    ),
)
_GRIDKEYS = ["expt", "time", "lat_j", "lon_i"]
# Fields that differ in what is not selected on are averaged into one first.
_MERGED_SQL = """f AS (SELECT expt, field_name, averaged, "time", lat_j, lon_i, avg(value) AS value FROM src GROUP BY ALL)"""
_MEET = 'expt, "time", lat_j'


def _merged(spark: SparkSession, d: str) -> DataFrame:
    """Source fields by name and cell methods on (expt, time, lat_j)."""
    return sources(spark, d).groupBy("expt", "field_name", "stash", "cell_methods", "time", "lat_j", "lon_i").agg(
        F.avg("value").alias("value")
    )


def _rows_sql(specs: str) -> str:
    return f"""WITH {SOURCES_SQL}, m AS (SELECT expt, field_name, stash, averaged, "time", lat_j, lon_i, avg(value) AS value FROM src GROUP BY ALL) {specs}"""


_SINGLE = [s for s in DEMO_SPECS if len(s.fields) == 1]


@register(
    _rows_sql(
        """SELECT expt, "time", lat_j, lon_i, variable, round(value, 6) + 0e0 AS value, count(*) AS n FROM (
SELECT expt, "time", lat_j, lon_i, 'clk' AS variable, value FROM m WHERE field_name = 'click'
UNION ALL SELECT expt, "time", lat_j, lon_i, 'err', value FROM m WHERE field_name = 'error' AND stash = 'm01s01'
UNION ALL SELECT expt, "time", lat_j, lon_i, 'pur', -value FROM m WHERE field_name = 'purchase' AND averaged
UNION ALL SELECT expt, "time", lat_j, lon_i, 'vpc', value * 100 FROM m WHERE field_name = 'view' AND NOT averaged) GROUP BY ALL"""
    )
)
def map_variables(spark: SparkSession, d: str) -> DataFrame:
    """Select, rename, flip and rescale in one scan without a shuffle of its own."""
    out = mp.map_variables(_merged(spark, d), _SINGLE, _GRIDKEYS)
    return out.groupBy(*_GRIDKEYS, "variable", F.round("value", 6).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _daily(spark: SparkSession, d: str) -> DataFrame:
    """Coarser keys so that the operands of sums meet: one row per field and cell."""
    return (
        sources(spark, d)
        .withColumn("time", F.date_trunc("day", "time").cast("timestamp_ntz"))
        .groupBy("expt", "field_name", "cell_methods", "time", "lat_j")
        .agg(F.avg("value").alias("value"))
        .withColumn("stash", F.lit("m01s00"))
    )


_DAILY_SQL = f"""WITH {SOURCES_SQL}, m AS (SELECT expt, field_name, averaged, date_trunc('day', "time")::TIMESTAMP AS "time", lat_j, avg(value) AS value FROM src GROUP BY ALL),
w AS (SELECT expt, "time", lat_j,
  max(CASE WHEN field_name = 'signup' AND NOT averaged THEN value END) AS s,
  max(CASE WHEN field_name = 'view' AND NOT averaged THEN value END) AS v,
  max(CASE WHEN field_name = 'click' AND NOT averaged THEN value END) AS c,
  max(CASE WHEN field_name = 'error' AND NOT averaged THEN value END) AS e FROM m GROUP BY ALL)"""


@register(
    f"""{_DAILY_SQL} SELECT expt, "time", lat_j, variable, round(value, 6) + 0e0 AS value FROM (
SELECT expt, "time", lat_j, 'tot' AS variable, s + v AS value FROM w WHERE s IS NOT NULL OR v IS NOT NULL
UNION ALL SELECT expt, "time", lat_j, 'mix', (c - e) * v FROM w WHERE c IS NOT NULL OR e IS NOT NULL OR v IS NOT NULL)"""
)
def combine_fields(spark: SparkSession, d: str) -> DataFrame:
    """Left fold over operators; a missing operand makes the result missing."""
    joint = [s for s in DEMO_SPECS if len(s.fields) > 1]
    out = mp.map_variables(_daily(spark, d), joint, ["expt", "time", "lat_j"])
    return out.select("expt", "time", "lat_j", "variable", r6("value"))


@register(
    f"""{_DAILY_SQL} SELECT expt, "time", lat_j, round(s + v, 6) AS tot, round(v * 100, 6) AS vpc FROM w
WHERE s IS NOT NULL OR v IS NOT NULL"""
)
def variables_as_columns(spark: SparkSession, d: str) -> DataFrame:
    keys = ["expt", "time", "lat_j"]
    specs = [s for s in DEMO_SPECS if s.short in ("tot", "vpc")]
    wide = mp.pivot_variables(mp.map_variables(_daily(spark, d), specs, keys), keys, ["tot", "vpc"])
    return wide.select(*keys, r6("tot"), r6("vpc"))


@register(
    f"""WITH {SOURCES_SQL} SELECT expt, field_name, stash, averaged, count(*) AS n, round(avg(value), 6) AS v FROM src
WHERE NOT deep AND ((field_name = 'click' AND stash = 'm01s02') OR (field_name = 'view' AND averaged)) GROUP BY ALL"""
)
def field_constraints(spark: SparkSession, d: str) -> DataFrame:
    """Exact dimensions, name, code and cell-method conditions combined."""
    a = FieldRule("click", stash="m01s02").predicate()
    b = FieldRule("view", averaged=True).predicate()
    src = sources(spark, d).filter(mp.has_dims("time", "latitude", "longitude") & (a | b))
    return src.groupBy("expt", "field_name", "stash", (F.size("cell_methods") > 0).alias("averaged")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("v")
    )


@register(
    f"""WITH {SOURCES_SQL}, inv AS (SELECT DISTINCT expt, field_name, stash, averaged, deep FROM src),
r(variable, operand, fn, st, av) AS (VALUES ('clk', 0, 'click', NULL, NULL), ('err', 0, 'error', 'm01s01', NULL),
 ('pur', 0, 'purchase', NULL, true), ('vpc', 0, 'view', NULL, false), ('tot', 0, 'signup', NULL, false), ('tot', 1, 'view', NULL, false),
 ('mix', 0, 'click', NULL, false), ('mix', 1, 'error', NULL, false), ('mix', 2, 'view', NULL, false))
SELECT expt, variable, operand, count(*) FILTER (WHERE field_name = fn AND (st IS NULL OR stash = st) AND (av IS NULL OR averaged = av)) AS n_matches
FROM inv, r GROUP BY ALL"""
)
def exactly_one_report(spark: SparkSession, d: str) -> DataFrame:
    """How many source fields each operand matches; anything but one is an error."""
    return mp.count_matches(mp.inventory(sources(spark, d), ["expt"]), DEMO_SPECS, ["expt"])


@register(
    f"""WITH {SOURCES_SQL}, inv AS (SELECT DISTINCT expt, field_name, stash, averaged, deep, units FROM src)
SELECT expt, 'clk' AS variable_id, 'clicks' AS long_name, min(units) AS units, '' AS notes, 'click' AS sources FROM inv WHERE field_name = 'click' GROUP BY expt
UNION ALL SELECT expt, 'pur', 'mean_purchases', min(units), '', 'purchase' FROM inv WHERE field_name = 'purchase' AND averaged GROUP BY expt
UNION ALL SELECT expt, 'vpc', 'view_percent', '%', '', 'view' FROM inv WHERE field_name = 'view' AND NOT averaged GROUP BY expt
UNION ALL SELECT expt, 'tot', 'signup_plus_view', min(CASE WHEN field_name = 'signup' THEN units END), 'sum', 'signup,view' FROM inv WHERE field_name IN ('signup', 'view') AND NOT averaged
  GROUP BY expt HAVING count(DISTINCT field_name) = 2"""
)
def variable_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Names, units and attributes; a changed and a dropped variable."""
    specs = mp.override(DEMO_SPECS, {"mix": None, "err": None})
    cat = mp.variable_catalog(mp.inventory(sources(spark, d), ["expt"]), specs, ["expt"])
    return cat.select(
        "expt", "variable_id", "long_name", "units",
        F.coalesce(F.col("attrs")["notes"], F.lit("")).alias("notes"),
        F.array_join("source_names", ",").alias("sources"),
    )


# --- vertical ----------------------------------------------------------------

_TARGETS_SQL = ", ".join(f"{t}e0" for t in COLUMN_TARGETS)


def _interp_sql(clamp: bool, levels: str = _TARGETS_SQL) -> str:
    def out(c: str) -> str:
        y = f"{c} + (t - p) * ({c}2 - {c}) / (p2 - p)"
        y = f"CASE WHEN {y} < 0 THEN 0e0 ELSE {y} END" if clamp else y
        return f"round({y}, 6) + 0e0 AS {c}"

    return f"""{COLUMNS_SQL}, g AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY l_orderkey) AS n,
  lead(p) OVER w AS p2, lead(v) OVER w AS v2, lead(x) OVER w AS x2 FROM col WINDOW w AS (PARTITION BY l_orderkey ORDER BY p)),
tg AS (SELECT unnest([{levels}]) AS t),
ip AS (SELECT l_orderkey, t AS level, {out('v')}, {out('x')} FROM g, tg
  WHERE p2 IS NOT NULL AND (t >= p OR rn = 1) AND (t < p2 OR rn = n - 1))"""


@register(f"WITH {_interp_sql(False)} SELECT * FROM ip")
def vertical_interp(spark: SparkSession, d: str) -> DataFrame:
    """Linear in the vertical, extended past both ends; two variables at once."""
    out = interpolate_levels(columns(spark, d), ["l_orderkey"], "p", ["v", "x"], COLUMN_TARGETS, clamp=False)
    return out.select("l_orderkey", "level", r6("v"), r6("x"))


@register(f"WITH {_interp_sql(True)} SELECT * FROM ip")
def vertical_interp_clamped(spark: SparkSession, d: str) -> DataFrame:
    """With negatives set to zero, and long columns thinned before ordering."""
    out = interpolate_levels(
        columns(spark, d), ["l_orderkey"], "p", ["v", "x"], COLUMN_TARGETS, clamp=True, long_column=5
    )
    return out.select("l_orderkey", "level", r6("v"), r6("x"))


@register(
    """WITH s AS (SELECT l_linestatus AS "time", round(l_quantity * 100 + l_linenumber, 6) AS p, avg(l_extendedprice) AS v FROM lineitem GROUP BY ALL),
g AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY "time") AS n, lead(p) OVER w AS p2, lead(v) OVER w AS v2
  FROM s WINDOW w AS (PARTITION BY "time" ORDER BY p)), tg AS (SELECT unnest([1, 10, 20, 30, 50, 75]) AS hpa)
SELECT "time", hpa AS pressure, round(v + (hpa * 100 - p) * (v2 - v) / (p2 - p), 6) + 0e0 AS v FROM g, tg
WHERE p2 IS NOT NULL AND (hpa * 100 >= p OR rn = 1) AND (hpa * 100 < p2 OR rn = n - 1)"""
)
def vertical_interp_long_columns(spark: SparkSession, d: str) -> DataFrame:
    """Few, very long columns: thinned by aggregation, targets given in hPa."""
    li = table(spark, d, "lineitem").groupBy(
        F.col("l_linestatus").alias("time"), F.round(F.col("l_quantity") * 100 + F.col("l_linenumber"), 6).alias("p")
    ).agg(F.avg("l_extendedprice").alias("v"))
    hpa = (1, 10, 20, 30, 50, 75)
    out = interpolate_levels(li, ["time"], "p", ["v"], [t * 100 for t in hpa], clamp=False, long_column=50)
    pairs = F.create_map(*[c for t in hpa for c in (hpa_to_pa(F.lit(t)).cast("double"), F.lit(t))])
    return out.select("time", pairs[F.col("level")].alias("pressure"), r6("v"))


_TIMES_SQL = """a AS (SELECT DISTINCT date_trunc('hour', ts)::TIMESTAMP AS "time" FROM events WHERE event_type = 'view'),
b AS (SELECT DISTINCT date_trunc('hour', ts)::TIMESTAMP AS "time" FROM events WHERE event_type = 'purchase')"""


@register(
    f"""WITH {_TIMES_SQL} SELECT "time", 'pressure' AS missing_in FROM a WHERE "time" NOT IN (SELECT "time" FROM b)
UNION ALL SELECT "time", 'values' FROM b WHERE "time" NOT IN (SELECT "time" FROM a)"""
)
def vertical_time_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Times on which values and pressure do not both exist."""
    ev = table(spark, d, "events").withColumn("time", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return times_differ(ev.filter("event_type = 'view'"), ev.filter("event_type = 'purchase'"))


@register(
    f"""WITH {_interp_sql(True)}, l AS (SELECT level FROM ip GROUP BY 1 ORDER BY abs(level - 47000), level LIMIT 1)
SELECT l_orderkey, level, v FROM ip WHERE level = (SELECT level FROM l)"""
)
def nearest_level(spark: SparkSession, d: str) -> DataFrame:
    """The level closest to the one asked for."""
    out = interpolate_levels(columns(spark, d), ["l_orderkey"], "p", ["v"], COLUMN_TARGETS)
    return tl.nearest_level(out, "level", 47000.0).select("l_orderkey", "level", r6("v"))


@register(f"WITH {_interp_sql(True)} SELECT level, round(avg(v), 4) AS v, round(avg(x), 4) AS x FROM ip GROUP BY ALL")
def vertical_profile(spark: SparkSession, d: str) -> DataFrame:
    out = interpolate_levels(columns(spark, d), ["l_orderkey"], "p", ["v", "x"], COLUMN_TARGETS)
    means = level_means(out, [], "level", ["v", "x"])
    return means.select("level", F.round("v", 4).alias("v"), F.round("x", 4).alias("x"))


@register(
    """WITH m AS (SELECT l_orderkey, (l_linenumber - 1) % 4 AS layer, avg(l_quantity) AS mrsol FROM lineitem GROUP BY ALL)
SELECT l_orderkey, round(max(CASE WHEN layer = 0 THEN mrsol END), 6) AS mrsol0, round(max(CASE WHEN layer = 1 THEN mrsol END), 6) AS mrsol1,
round(max(CASE WHEN layer = 2 THEN mrsol END), 6) AS mrsol2, round(max(CASE WHEN layer = 3 THEN mrsol END), 6) AS mrsol3 FROM m GROUP BY ALL"""
)
def layer_pivot(spark: SparkSession, d: str) -> DataFrame:
    layers = table(spark, d, "lineitem").groupBy(
        "l_orderkey", ((F.col("l_linenumber") - 1) % 4).alias("layer")
    ).agg(F.avg("l_quantity").alias("mrsol"))
    out = mp.split_layers(layers, ["l_orderkey"], "mrsol", "layer", 4)
    return out.select("l_orderkey", *[r6(f"mrsol{k}") for k in range(4)])
