"""Radix selection: order-preserving keys and a bounded number of rounds."""

import struct

import numpy as np
import pytest

from orbgrid.functions.scalars import order_bits
from orbgrid.operators import reduce as rd


def test_keys_are_the_bits_of_the_numbers(spark):
    rng = np.random.default_rng(1)
    xs = [0.0, -0.0, 5e-324, 2.0**-1022, np.nextafter(2.0**-1022, 0), 1.7976931348623157e308, 1.0, np.nextafter(1.0, 0), np.nextafter(1.0, 2)]
    xs += [2.0**k for k in range(-1074, 1024, 7)] + [float(np.nextafter(2.0**k, 0)) for k in range(-1021, 1024, 7)]
    xs += [x for x in np.frombuffer(rng.bytes(8 * 3000), "<f8").tolist() if x == x]
    xs += [-x for x in xs] + [float("inf"), float("-inf")]
    got = spark.createDataFrame([(float(x),) for x in xs], "x double").select("x", order_bits("x").alias("k")).collect()
    for r in got:
        size = struct.unpack("<q", struct.pack("<d", abs(r.x)))[0]
        assert r.k == (-size if r.x < 0 else size), r.x
    nan = spark.createDataFrame([(float("nan"),)], "x double").select(order_bits("x")).first()[0]
    assert nan > max(r.k for r in got)


@pytest.mark.parametrize(
    "values",
    [
        [s * m * 10.0**k for k in range(-60, 61) for m in (1, 2, 7) for s in (1, -1)],
        [float("-inf")] + [float(k) for k in range(31)],
        [float("inf")] * 3 + [float("-inf")] * 2 + list(np.random.default_rng(2).standard_cauchy(500)),
        [1.0 + k * 2.0**-52 for k in range(400)],
    ],
)
def test_rounds_are_bounded(spark, monkeypatch, values):
    cuts = []

    def counting(session):
        def cut(df, *_):
            cuts.append(1)
            return spark.createDataFrame(df.collect(), df.schema)

        return cut

    monkeypatch.setattr(rd, "lineage_cutter", counting)
    df = spark.createDataFrame([("a", float(v)) for v in values], "g string, v double")
    probs = (0.1, 0.5, 0.9)
    got = {r.prob: r.quantile for r in rd.exact_quantiles(df, ["g"], "v", probs, window=2).collect()}
    # The merged values, the ranks, and six rounds at most.
    assert len(cuts) <= 2 + 6
    for p in probs:
        assert got[p] == pytest.approx(np.percentile(values, 100 * p), rel=1e-12)


def test_infinite_neighbours_and_null_groups(spark):
    rows = [(None, 1.0), (None, 2.0), ("a", float("-inf")), ("a", 3.0), ("b", None)]
    got = {r.g: r.quantile for r in rd.exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", (0.5,)).collect()}
    assert got == {None: 1.5, "a": float("-inf")}


def test_bins_are_a_power_of_two(spark):
    with pytest.raises(ValueError, match="power of two"):
        rd.exact_quantiles(spark.createDataFrame([(1.0,)], "v double"), [], "v", (0.5,), bins=100)
