"""Regular axes: time axes, lat/lon grid axes, vertical level lists."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The pressure axis (hPa) that 3-D variables are delivered on.
PRESSURE_LEVELS_HPA = (
    1, 5, 10, 20, 30, 50, 70, 100, 150, 200, 250, 300, 400,
    500, 600, 700, 750, 800, 850, 875, 900, 925, 950, 975, 1000,
)


#: Points of an axis without equal spacing.
MAX_POINTS = 100_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hpa_to_pa(p: Column | str) -> Column:
    return _col(p) * 100


def floor_hours(ts: Column | str, hours: int = 12) -> Column:
    """Start of the ``hours``-long cycle that contains ``ts``."""
    ts = _col(ts)
    day = F.date_trunc("day", ts)
    slot = F.floor(F.hour(ts) / F.lit(float(hours))).cast("int") * hours
    return (day + F.make_dt_interval(hours=slot)).cast("timestamp_ntz")


def is_halfpast(ts: Column | str) -> Column:
    ts = _col(ts)
    return (F.minute(ts) == 30) & (F.floor(F.second(ts)) == 0)


def shift_minutes(ts: Column | str, minutes: int) -> Column:
    return _col(ts) + F.make_dt_interval(mins=F.lit(minutes))


def parse_cycle(stem: Column | str) -> Column:
    """Cycle time from a file stem such as ``run.stream_20200120T00``.

    The stamp is ``yyyymmddThh`` or, with a trailing Z, ``yyyymmddThhmmZ``.
    """
    stamp = F.regexp_extract(_col(stem), r"_(\d{8}T\d{2}(?:\d{2}Z)?)$", 1)
    padded = F.when(F.length(stamp) == 11, F.concat(stamp, F.lit("00Z"))).otherwise(stamp)
    return F.try_to_timestamp(padded, F.lit("yyyyMMdd'T'HHmm'Z'")).cast("timestamp_ntz")


@dataclass(frozen=True)
class TimeAxis:
    """A regular time axis, both ends included."""

    start: datetime
    end: datetime
    step: timedelta

    @property
    def size(self) -> int:
        return int((self.end - self.start) / self.step) + 1

    def _micros(self) -> int:
        return int(self.step / timedelta(microseconds=1))

    def stamps(self) -> Column:
        """Array column with every stamp of the axis."""
        return F.sequence(
            F.lit(self.start).cast("timestamp_ntz"),
            F.lit(self.end).cast("timestamp_ntz"),
            F.make_dt_interval(secs=F.lit(self.step.total_seconds())),
        )

    def to_df(self, spark: SparkSession, name: str = "time") -> DataFrame:
        return spark.range(1).select(F.posexplode(self.stamps()).alias("time_idx", name))

    def nearest_index(self, ts: Column | str) -> Column:
        """Index of the nearest stamp, held inside the axis."""
        gap = F.timestamp_diff("MICROSECOND", F.lit(self.start).cast("timestamp_ntz"), _col(ts))
        idx = F.round(gap / F.lit(float(self._micros()))).cast("bigint")
        return F.least(F.greatest(idx, F.lit(0)), F.lit(self.size - 1))

    def stamp_at(self, idx: Column | str) -> Column:
        seconds = _col(idx) * F.lit(self.step.total_seconds())
        return (
            F.lit(self.start).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
        ).cast("timestamp_ntz")


@dataclass(frozen=True)
class GridAxis:
    """A regular grid axis ``start + step * k`` for ``k < size``.

    ``cyclic`` closes a longitude circle: the point after the last is the first.
    """

    start: float
    step: float
    size: int
    cyclic: bool = False

    @property
    def last(self) -> float:
        return self.start + self.step * (self.size - 1)

    def position(self, x: Column | str) -> Column:
        """Fractional index, NULL outside the axis.

        Rounded at 1e-12 of a grid step so that the choice of triangle does
        not hang on the last bit of a trigonometric result.
        """
        x = _col(x)
        raw = (x - F.lit(float(self.start))) / F.lit(float(self.step))
        if self.cyclic:
            return F.round(F.pmod(raw, F.lit(float(self.size))), 12)
        raw = F.round(raw, 12)
        return F.when((raw >= 0) & (raw <= self.size - 1), raw)

    def index_of(self, x: Column | str) -> Column:
        """Grid index of a coordinate that lies on the axis."""
        raw = F.round((_col(x) - F.lit(float(self.start))) / F.lit(float(self.step))).cast("bigint")
        return F.pmod(raw, F.lit(self.size)) if self.cyclic else raw


@dataclass(frozen=True)
class IrregularAxis:
    """A grid axis given by its points, ascending or descending.

    ``cyclic`` closes a longitude circle, as for ``GridAxis``.
    """

    values: tuple[float, ...]
    cyclic: bool = False

    @property
    def start(self) -> float:
        return self.values[0]

    @property
    def last(self) -> float:
        return self.values[-1]

    @property
    def size(self) -> int:
        return len(self.values)

    def position(self, x: Column | str) -> Column:
        """Fractional index, NULL outside the axis; rounded as that of ``GridAxis``.

        The points are a literal that is searched by halving.
        """
        sign = 1.0 if self.values[-1] > self.values[0] else -1.0
        nodes = [sign * float(v) for v in self.values]
        x = _col(x) * F.lit(sign)
        if self.cyclic:
            nodes.append(nodes[0] + 360.0)
            x = F.pmod(x - F.lit(nodes[0]), F.lit(360.0)) + F.lit(nodes[0])
        points, last = F.array(*[F.lit(v) for v in nodes]), len(nodes) - 1

        def halve(s: Column, _: Column) -> Column:
            middle = F.call_function("div", s["lo"] + s["hi"], F.lit(2)).cast("int")
            right = F.get(points, middle) <= x
            return F.struct(F.when(right, middle).otherwise(s["lo"]).alias("lo"), F.when(right, s["hi"]).otherwise(middle).alias("hi"))

        whole = F.struct(F.lit(0).alias("lo"), F.lit(last).alias("hi"))
        below = F.aggregate(F.sequence(F.lit(1), F.lit(max(last, 1).bit_length())), whole, halve, lambda s: s["lo"])
        # Only points of the axis itself are searched, so the next one is there.
        at = F.get(points, below)
        within = (x - at) / (F.get(points, F.least(below + 1, F.lit(last))) - at)
        inside = (x >= F.lit(nodes[0])) & (x < F.lit(nodes[-1]))
        out = F.when(inside, F.round(below + within, 12))
        return out if self.cyclic else out.when(x == F.lit(nodes[-1]), F.lit(float(last)))

    def index_of(self, x: Column | str) -> Column:
        """Grid index of a coordinate that lies on the axis."""
        at = F.round(self.position(x)).cast("bigint")
        return F.pmod(at, F.lit(self.size)) if self.cyclic else at


@dataclass(frozen=True)
class LatLonGrid:
    """A rectilinear grid; points are numbered ``lat_index * n_lon + lon_index``."""

    lat: GridAxis | IrregularAxis
    lon: GridAxis | IrregularAxis
    regional: bool = False

    @property
    def size(self) -> int:
        return self.lat.size * self.lon.size

    @property
    def key(self) -> str:
        """Cache key: a digest of all numbers of the grid, to the last bit."""
        return "grid-" + hashlib.sha256(repr(self).encode()).hexdigest()[:32]

    @property
    def extent(self) -> tuple[float, float, float, float]:
        """West, east, south, north of the grid points."""
        lats = sorted((self.lat.start, self.lat.last))
        return self.lon.start, self.lon.last, lats[0], lats[1]

    def src_id(self, lat_idx: Column | str, lon_idx: Column | str) -> Column:
        return _col(lat_idx).cast("bigint") * F.lit(self.lon.size) + _col(lon_idx).cast("bigint")

    def with_src_id(self, df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
        return df.withColumn("src_id", self.src_id(self.lat.index_of(lat), self.lon.index_of(lon)))


def detect_grid(df: DataFrame, lat: str = "lat", lon: str = "lon", regional: bool = False) -> LatLonGrid:
    """Read the two axes off a field table.

    Of equally spaced axes only the ends and lengths come back to the driver,
    of others the points (``MAX_POINTS`` at most).  Whole circles are
    recognised as cyclic.
    """
    axes: list = []
    for name in (lat, lon):
        values = df.select(F.col(name).alias("x")).distinct()
        ends = values.agg(F.min("x").alias("a"), F.max("x").alias("b"), F.count("x").alias("n")).first()
        if ends.n < 2:
            raise ValueError(f"axis {name} has fewer than two points")
        step = (ends.b - ends.a) / (ends.n - 1)
        pos = (F.col("x") - F.lit(ends.a)) / F.lit(step)
        off = values.agg(F.max(F.abs(pos - F.round(pos))).alias("off")).first().off
        whole = not regional and name == lon
        if off <= 1e-3:
            axes.append(GridAxis(ends.a, step, ends.n, whole and abs(step * ends.n - 360.0) < 1e-6 * 360.0))
            continue
        if ends.n > MAX_POINTS:
            raise ValueError(f"axis {name} has {ends.n} points without equal spacing")
        points = [r.x for r in values.filter(F.col("x").isNotNull()).orderBy("x").collect()]
        widest = max(b - a for a, b in zip(points, points[1:]))
        # A circle is whole when the way round is no longer than the widest step.
        axes.append(IrregularAxis(tuple(points), whole and 0 < 360.0 - (points[-1] - points[0]) <= 1.001 * widest))
    return LatLonGrid(*axes, regional)
