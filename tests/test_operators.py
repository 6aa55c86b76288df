"""Pyramids, vertical columns, quantiles, time axes, mapping and checks."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbgrid.functions.axes import TimeAxis, floor_hours, parse_cycle
from orbgrid.functions.healpix import npix
from orbgrid.functions.scalars import clamp_negative, nan_to_null
from orbgrid.operators import mapping as mp
from orbgrid.operators import pyramid as pyr
from orbgrid.operators import quality as ql
from orbgrid.operators import reduce as red
from orbgrid.operators import timeline as tl
from orbgrid.operators.mapping import FieldRule, VariableSpec
from orbgrid.operators.vertical import interpolate_levels, thin_columns
from orbgrid.plans import config
from orbgrid.session import lineage_cutter


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- pyramids ----------------------------------------------------------------


def sparse_cells(spark, zoom=4, share=0.6):
    df = spark.range(npix(zoom)).select(F.col("id").alias("healpix_index"), F.lit(0).alias("time"))
    return df.filter(F.rand(5) < share).withColumn("v", F.rand(6) * 100)


def brute_pyramid(cells, zoom):
    levels = {zoom: dict(cells)}
    for z in range(zoom - 1, -1, -1):
        groups = {}
        for ip, v in levels[z + 1].items():
            groups.setdefault(ip // 4, []).append(v)
        levels[z] = {ip: float(np.mean(vs)) for ip, vs in groups.items()}
    return levels


@pytest.mark.parametrize("span", [1, 2, 5])
@pytest.mark.parametrize("cut", [False, True])
def test_pyramid_against_brute_force(spark, span, cut):
    df = sparse_cells(spark).cache()
    want = brute_pyramid([(r.healpix_index, r.v) for r in df.collect()], 4)
    out = pyr.pyramid(df, ["time"], ["v"], 4, span=span, cut=lineage_cutter(spark) if cut else None).collect()
    got = {}
    for r in out:
        got.setdefault(r.zoom, {})[r.healpix_index] = r.v
    assert got.keys() == want.keys()
    for z in want:
        assert got[z].keys() == want[z].keys()
        assert all(abs(got[z][k] - want[z][k]) < 1e-9 for k in want[z])


def test_global_mean_does_not_change_without_gaps(spark):
    df = sparse_cells(spark, share=2.0)
    means = [r.v for r in red.domain_mean(pyr.pyramid(df, ["time"], ["v"], 4), ["zoom"], ["v"]).collect()]
    assert len(means) == 5 and max(means) - min(means) < 1e-9


def test_coarsen_skips_missing_and_keeps_all_missing(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 3.0), (4, None), (5, None)], "healpix_index long, v double")
    assert rows(pyr.coarsen(df, [], ["v"]), "healpix_index") == [(0, 2.0), (1, None)]
    w = pyr.coverage_weights(df, "v")
    assert rows(w, "healpix_index") == [(0, 0.5), (1, 0.0)]


def test_block_reducers(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 5.0), (2, None), (8, 2.0)], "healpix_index long, v double")
    share = pyr.coarsen_blocks(df, [], "v", lambda a: (~np.isnan(a)).sum(axis=-1) / 4)
    assert rows(share, "healpix_index") == [(0, 0.5), (2, 0.25)]
    assert rows(pyr.coarsen_with(df, [], "v", F.max), "healpix_index") == [(0, 5.0), (2, 2.0)]


# --- vertical ----------------------------------------------------------------


def brute_interp(p, v, targets, clamp):
    order = np.argsort(p)
    p, v = np.asarray(p)[order], np.asarray(v)[order]
    out = []
    for t in targets:
        k = int(np.clip(np.searchsorted(p, t, side="right") - 1, 0, len(p) - 2))
        y = v[k] + (t - p[k]) * (v[k + 1] - v[k]) / (p[k + 1] - p[k])
        out.append(max(y, 0.0) if clamp else y)
    return out


@pytest.mark.parametrize("long_column", [None, 1, 8])
@pytest.mark.parametrize("clamp", [False, True])
def test_vertical_against_brute_force(spark, long_column, clamp):
    rng = np.random.default_rng(1)
    targets = [100.0, 250.0, 500.0, 700.0, 900.0]
    data, want = [], {}
    for key in range(40):
        n = int(rng.integers(1, 25))
        p = rng.choice(np.arange(1, 1100), n, replace=False).astype(float)
        v = rng.normal(size=n) * 5
        data += [(key, float(a), float(b)) for a, b in zip(p, v)]
        if n > 1:
            want.update({(key, t): y for t, y in zip(targets, brute_interp(p, v, targets, clamp))})
    df = spark.createDataFrame(data, "k int, p double, v double")
    out = interpolate_levels(df, ["k"], "p", ["v"], targets, clamp=clamp, long_column=long_column)
    got = {(r.k, r.level): r.v for r in out.collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_one_column_with_most_rows(spark):
    """A third and more of all rows in one column: thinned to a few levels."""
    hot = spark.range(50_000).select(F.lit("hot").alias("k"), (F.col("id") / 50.0).alias("p"))
    cold = spark.range(20_000).select((F.col("id") % 500).cast("string").alias("k"), (F.col("id") / 20.0).alias("p"))
    df = hot.union(cold).withColumn("v", 2 * F.col("p") + 1)
    targets = [-5.0, 10.0, 333.3, 5000.0]
    assert thin_columns(df.filter("k = 'hot'"), ["k"], "p", ["v"], targets).count() <= 2 * len(targets) + 6
    out = interpolate_levels(df, ["k"], "p", ["v"], targets, clamp=False, long_column=1000).collect()
    assert len(out) == 501 * 4
    assert all(abs(r.v - (2 * r.level + 1)) < 1e-6 for r in out)


def test_missing_level_value_stays_missing(spark):
    df = spark.createDataFrame([(0, 1.0, 1.0), (0, 2.0, None), (0, 3.0, 5.0), (0, 4.0, -9.0)], "k int, p double, v double")
    got = {r.level: r.v for r in interpolate_levels(df, ["k"], "p", ["v"], [1.5, 2.5, 3.0, 3.9]).collect()}
    assert got[1.5] is None and got[2.5] is None and got[3.0] == 5.0 and got[3.9] == 0.0


# --- quantiles ---------------------------------------------------------------


@pytest.mark.parametrize("bins", [4, 4096])
def test_exact_quantiles_on_awkward_values(spark, bins):
    rng = np.random.default_rng(2)
    groups = {
        "normal": rng.normal(size=999),
        "ties": rng.integers(0, 3, size=1000).astype(float),
        "spread": 10.0 ** rng.uniform(-30, 30, size=500),
        "outlier": np.append(rng.uniform(size=400), [1e300, -1e300]),
        "one": np.array([4.5]),
        "same": np.full(50, -2.0),
    }
    data = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("normal", None)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = (0.0, 0.02, 0.5, 0.98, 1.0)
    got = {(r.g, r.prob): r.quantile for r in red.exact_quantiles(df, ["g"], "v", probs, bins=bins).collect()}
    for g, xs in groups.items():
        for p in probs:
            assert got[g, p] == pytest.approx(np.percentile(xs, p * 100), rel=1e-9), (g, p)


def test_robust_range_only_around_zero(spark):
    xs = np.random.default_rng(3).normal(size=500)
    data = [("a", float(x)) for x in xs] + [("b", float(x) + 100) for x in xs]
    got = {r.g: r for r in red.robust_range(spark.createDataFrame(data, "g string, v double"), ["g"], "v").collect()}
    vmax = max(abs(np.percentile(xs, 2)), abs(np.percentile(xs, 98)))
    assert got["a"].vmax == pytest.approx(vmax) and got["a"].vmin == pytest.approx(-vmax)
    assert not got["b"].diverging and got["b"].vmax is None


def test_zonal_bins_close_on_the_right(spark):
    df = spark.createDataFrame(
        [(0, 0.0, 1.0), (1, 0.05, 3.0), (2, 0.1, 5.0), (3, 89.95, 7.0)], "healpix_index long, lat double, v double"
    )
    got = {r.lat_bin: (r.v, round(r.lat_mid, 6)) for r in red.zonal_mean(df, [], "v", ["healpix_index"]).collect()}
    assert got == {900: (1.0, -0.05), 901: (4.0, 0.05), 1800: (7.0, 89.95)}


# --- time --------------------------------------------------------------------

T0 = datetime(2020, 1, 20)
AXIS = TimeAxis(T0, T0 + timedelta(hours=9000), timedelta(hours=1))


def stamps(spark, *values, field="a"):
    return spark.createDataFrame([(field, v) for v in values], "field string, time timestamp_ntz")


def test_snap_is_strict_at_the_tolerance(spark):
    df = stamps(spark, T0 + timedelta(minutes=4, seconds=59), T0 + timedelta(minutes=65), T0 - timedelta(hours=3))
    got = rows(tl.snap_time(df, AXIS).select("time_idx", "snapped", "on_axis"), "time")
    assert got == [(0, T0, False), (0, T0, True), (1, T0 + timedelta(hours=1), False)]


def test_halfpast_needs_all_times(spark):
    h = timedelta(minutes=30)
    df = stamps(spark, T0 + h, T0 + 3 * h).union(stamps(spark, T0 + h, T0 + 2 * h, field="b"))
    got = rows(tl.shift_halfpast(df, ["field"]).select("field", "time"), "field", "time")
    assert got == [("a", T0 + 2 * h), ("a", T0 + 4 * h), ("b", T0 + h), ("b", T0 + 2 * h)]


def test_trim_first_only_at_thirteen(spark):
    hours = [T0 + timedelta(hours=k) for k in range(13)]
    df = stamps(spark, *hours).union(stamps(spark, *hours[:12], field="b"))
    got = tl.trim_first(df, ["field"]).groupBy("field").agg(F.min("time"), F.count("*"))
    assert rows(got, "field") == [("a", hours[1], 12), ("b", hours[0], 12)]


def test_gaps_across_blocks(spark):
    idx = [0, 1, 2, 5, 4095, 4096, 4098, 8999]
    df = stamps(spark, *[T0 + timedelta(hours=k) for k in idx])
    got = rows(tl.axis_gaps(df, ["field"], AXIS).drop("field", "n_off_axis"), "time_idx")
    assert got == [(5, 2, 2), (4095, 5, 4089), (4098, 4096, 1), (8999, 4098, 4900)]


def test_nearest_level_takes_lower_on_tie(spark):
    df = spark.createDataFrame([(400.0,), (600.0,), (925.0,)], "level double")
    assert rows(tl.nearest_level(df, "level", 500.0), "level") == [(400.0,)]


def test_cycles_and_floor(spark):
    df = spark.createDataFrame(
        [("x.apvera_20200120T12",), ("x.apvera_20200121T0030Z",), ("readme",)], "stem string"
    )
    got = [r.c for r in df.select(parse_cycle("stem").alias("c")).collect()]
    assert got == [datetime(2020, 1, 20, 12), datetime(2020, 1, 21, 0, 30), None]
    one = stamps(spark, datetime(2020, 1, 20, 23, 59)).select(floor_hours("time").alias("c")).first()
    assert one.c == datetime(2020, 1, 20, 12)
    assert config.HOURLY.size == 9745 and config.THREE_HOURLY.size == 3249


# --- mapping -----------------------------------------------------------------

SOURCE = "field_name string, stash string, cell_methods array<string>, dims array<string>, units string, k int, value double"
PLANE = ["time", "latitude", "longitude"]


def field_rows(*items):
    return [(n, s, m, PLANE, "u", k, v) for n, s, m, k, v in items]


def test_combination_needs_all_operands(spark):
    spec = VariableSpec("t", "total", (FieldRule("a"), FieldRule("b"), FieldRule("c")), ("+", "-"))
    df = spark.createDataFrame(
        field_rows(("a", "s", [], 1, 1.0), ("b", "s", [], 1, 2.0), ("c", "s", [], 1, 5.0), ("a", "s", [], 2, 1.0)), SOURCE
    )
    assert rows(mp.map_variables(df, [spec], ["k"]), "k") == [(1, "t", -2.0), (2, "t", None)]


def test_one_field_may_serve_two_variables(spark):
    specs = [
        VariableSpec("p", "plain", (FieldRule("a"),)),
        VariableSpec("s", "sum", (FieldRule("a"), FieldRule("b")), ("+",)),
    ]
    df = spark.createDataFrame(field_rows(("a", "s", [], 1, 1.0), ("b", "s", [], 1, 2.0)), SOURCE)
    assert rows(mp.map_variables(df, specs, ["k"]), "variable") == [(1, "p", 1.0), (1, "s", 3.0)]


def test_functions_over_all_variables(spark):
    df = spark.createDataFrame([(1, 2.0, -3.0)], "k int, a double, b double")
    assert rows(mp.map_values(df, ["a", "b"], clamp_negative).transform(mp.drop_unused, ["k", "absent"]), "a") == [(2.0, 0.0)]


def test_exactly_one_is_enforced(spark):
    df = spark.createDataFrame(
        field_rows(("a", "s1", [], 1, 1.0), ("a", "s2", ["mean"], 1, 2.0)), SOURCE
    ).withColumn("sim", F.lit("x"))
    inv = mp.inventory(df, ["sim"])
    mp.require_exactly_one(inv, [VariableSpec("v", "v", (FieldRule("a", averaged=True),))], ["sim"])
    with pytest.raises(mp.FieldMismatch, match="2 matches"):
        mp.require_exactly_one(inv, [VariableSpec("v", "v", (FieldRule("a"),))], ["sim"])
    with pytest.raises(mp.FieldMismatch, match="0 matches"):
        mp.require_exactly_one(inv, [VariableSpec("v", "v", (FieldRule("b"),))], ["sim"])


def test_experiment_overrides():
    ex = config.EXPERIMENTS
    names = {k: [s.short for _, s in e.stored_specs()] for k, e in ex.items()}
    assert len(ex) == 11 and len(names["glm.n2560_RAL3p3.tuned"]) == 26 + 1 + 7 + 5
    assert len(names["glm.n1280_CoMA9"]) == 38 and "qs" not in names["glm.n1280_CoMA9"]
    assert len(names["glm.n1280_GAL9_v2"]) == 37
    pr = {k: next(s for _, s in e.stored_specs() if s.short == "pr") for k, e in ex.items()}
    assert len(pr["glm.n1280_GAL9_v2"].fields) == 4 and pr["glm.n1280_CoMA9"].fields[0].stash == "m01s05i216"
    regional = names["CTC_km4p4_CoMA9_TBv1.n2560_CoMA9_hier_v2"]
    assert "clwvi" not in regional and "mrsol" not in regional and "qs" not in regional
    assert "qs" in names["SEA_km4p4_RAL3P3.n1280_CoMA9"]


# --- checks ------------------------------------------------------------------


def test_missing_rules(spark):
    df = spark.createDataFrame(
        [("tas", 0.1), ("pr", 0.5), ("mrsol", 0.7), ("ts", 1.0), ("weights", 1.0)], "variable string, missing_fraction double"
    )
    got = {r.variable: r.failure for r in ql.missing_rules(df).collect()}
    assert got == {"tas": None, "pr": "too many missing", "mrsol": None, "ts": "all missing"}
    assert {r.variable for r in ql.missing_rules(df, regional=True).filter("failure is not null").collect()} == {"ts"}


def test_ranges_allow_rounding_noise(spark):
    df = spark.createDataFrame(
        [("pr", -1e-18), ("pr", 2.0), ("tas", 149.0), ("tas", 300.0), ("other", -5.0)], "variable string, v double"
    )
    got = {r.variable: (r.below, r.above) for r in ql.range_checks(df, [], "v").collect()}
    assert got == {"pr": (False, False), "tas": (True, False)}


def test_all_missing_is_refused(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "variable string, v double")
    ql.require_some_values(df.filter("variable = 'a'"), ["variable"], "v")
    with pytest.raises(ql.QualityError):
        ql.require_some_values(df, ["variable"], "v")


def test_nan_and_clamp(spark):
    df = spark.createDataFrame([(float("nan"),), (-1.0,), (2.0,), (None,)], "v double")
    got = [r.v for r in df.select(clamp_negative(nan_to_null(F.col("v"))).alias("v")).collect()]
    assert got == [None, 0.0, 2.0, None]


def test_compare_reports_one_sided_rows(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0 + 1e-7), (2, 2.1), (4, 4.0)], "k int, v double")
    assert rows(ql.compare_runs(a, b, ["k"], "v"), "k") == [(2, 2.0, 2.1), (3, 3.0, None), (4, None, 4.0)]


def test_rules_may_hold_any_condition(spark):
    """A rule with a condition of its own, without a field name."""
    big = FieldRule(where=lambda: F.col("value") > 1.5)
    specs = [VariableSpec("b", "big", (big,)), VariableSpec("a", "a", (FieldRule("a"),))]
    df = spark.createDataFrame(field_rows(("a", "s", [], 1, 1.0), ("a", "s", [], 2, 2.0), ("z", "s", [], 3, 3.0)), SOURCE)
    assert rows(mp.map_variables(df, specs, ["k"]), "k", "variable") == [
        (1, "a", 1.0), (2, "a", 2.0), (2, "b", 2.0), (3, "b", 3.0)
    ]
    assert rows(mp.map_variables(df, specs[:1], ["k"]), "k") == [(2, "b", 2.0), (3, "b", 3.0)]
