"""Weight application: regridding as a join and a sum.

Two physical plans give the same result:

* ``broadcast`` - the weights of the zoom are small (their size is known from
  the zoom alone), so the field is not shuffled for the join.
* ``tiled`` - source grid points are grouped into square tiles by index
  arithmetic.  A point on a tile edge is sent to the neighbours whose targets
  use it, so one shuffle of the field, not widened by the three corners, puts
  every target next to all its sources; join and sum then run in place.  Up to
  ``LANES`` consecutive time steps travel as columns of one row, which divides
  the cost of joining and hashing by as much.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orbgrid.functions.axes import LatLonGrid
from orbgrid.functions.healpix import npix
from orbgrid.functions.scalars import nan_to_null
from orbgrid.operators.weights import build_weights, explode_corners
from orbgrid.session import keep_copartitioning

# The broadcast plan joins three rows per cell and step, but drops unused source
# points at once, so it pays while targets are few (up to zoom 7).  The size of
# the weights follows from the number of targets.
BROADCAST_WEIGHTS_BYTES = 32 << 20
_WEIGHT_ROW_BYTES = 32
TILE_POINTS = 64
#: Source rows of a task of the tiled plan, about.
TASK_ROWS = 4_000_000
LANES = 12


def _tile(j: Column, i: Column, tile: int, tiles_per_row: int) -> Column:
    return F.floor(j / F.lit(float(tile))).cast("bigint") * tiles_per_row + F.floor(
        i / F.lit(float(tile))
    ).cast("bigint")


def _weighted(joined: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """Sum of value x weight; missing as soon as one corner is missing."""
    sums = [
        F.when(F.count(F.col(v)) == 3, F.sum(F.col(v) * F.col("w"))).alias(v) for v in values
    ]
    return joined.groupBy(*by).agg(*sums).filter(F.coalesce(*values).isNotNull())


def _apply_broadcast(field: DataFrame, weights: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    joined = field.select(*keys, "src_id", *values).join(
        F.broadcast(explode_corners(weights)), "src_id"
    )
    return _weighted(joined, [*keys, "healpix_index"], values)


def _halo_tiles(grid: LatLonGrid, tile: int, per_row: int) -> Column:
    """Tiles whose targets use a source point: its own and those it borders."""
    n_lat, n_lon = grid.lat.size, grid.lon.size
    j = F.floor(F.col("src_id") / F.lit(float(n_lon))).cast("bigint")
    i = F.pmod(F.col("src_id"), F.lit(n_lon))
    below, here = F.greatest(j - 1, F.lit(0)), F.least(j, F.lit(n_lat - 2))
    west = F.pmod(i - 1, F.lit(n_lon)) if grid.lon.cyclic else F.greatest(i - 1, F.lit(0))
    return F.array_distinct(
        F.array(*[_tile(a, b, tile, per_row) for a in (below, here) for b in (west, i)])
    )


def _apply_tiled(
    field: DataFrame,
    weights: DataFrame,
    keys: list[str],
    values: list[str],
    grid: LatLonGrid,
    tile: int,
    partitions: int,
    pack: str | None,
) -> DataFrame:
    per_row = -(-grid.lon.size // tile)
    n_tiles = per_row * -(-grid.lat.size // tile)
    # Few tiles: split each of them by the field's other keys as well, so the
    # number of independent groups always exceeds the number of tasks.
    slots = max(1, -(-4 * partitions // n_tiles))
    # One column, so that constants in it cannot be folded out of the placing.
    place = "_place"

    run = [k for k in keys if k != pack]
    if pack is not None:
        step_type = field.schema[pack].dataType
        step = F.col(pack).cast("bigint")
        field = field.withColumns(
            {
                "_lane": F.pmod(step, F.lit(LANES)).cast("int"),
                "_run": F.floor(step / F.lit(float(LANES))).cast("bigint"),
            }
        )
        run = [*run, "_run"]
    slot = F.pmod(F.xxhash64(*run), F.lit(slots)).cast("int") if run else F.lit(0)
    left = field.withColumns(
        {"_slot": slot, "_tile": F.explode(_halo_tiles(grid, tile, per_row))}
    ).select(
        *run, "src_id", *values, *(["_lane"] if pack else []),
        (F.col("_tile") * slots + F.col("_slot")).alias(place),
    ).repartition(partitions, place)

    first = _tile(F.col("j0"), F.col("i0"), tile, per_row) * slots
    right = weights.withColumn(place, F.explode(F.sequence(first, first + (slots - 1))))
    right = explode_corners(right.repartition(partitions, place), place)

    if pack is None:
        joined = left.join(right, [place, "src_id"])
        return _weighted(joined, [place, *run, "healpix_index"], values).drop(place)

    # Steps side by side: one join row and one hash entry serve LANES steps.
    # A missing step is NaN here, which makes the whole sum NaN.
    cells = [(v, n, f"_{v}_{n}") for v in values for n in range(LANES)]
    packed = left.groupBy(place, *run, "src_id").agg(
        *[F.max(F.when(F.col("_lane") == n, F.col(v).cast("double"))).alias(c) for v, n, c in cells]
    )
    joined = packed.join(right, [place, "src_id"])
    missing = F.lit(float("nan"))
    sums = joined.groupBy(place, *run, "healpix_index").agg(
        F.count(F.lit(1)).alias("_corners"),
        *[F.sum(F.coalesce(c, missing) * F.col("w")).alias(c) for _, _, c in cells],
    ).filter(F.col("_corners") == 3)
    steps = [
        F.struct(
            (F.col("_run") * LANES + n).cast(step_type).alias(pack),
            *[nan_to_null(F.col(f"_{v}_{n}")).alias(v) for v in values],
        )
        for n in range(LANES)
    ]
    others = [k for k in keys if k != pack]
    out = sums.select(*others, "healpix_index", F.inline(F.array(*steps)))
    return out.filter(F.coalesce(*values).isNotNull()).select(*keys, "healpix_index", *values)


def apply_weights(
    field: DataFrame,
    weights: DataFrame,
    grid: LatLonGrid,
    n_targets: int,
    keys: list[str],
    values: list[str],
    strategy: str | None = None,
    tile: int = TILE_POINTS,
    pack: str | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Regrid ``values`` of a field table ``(keys..., src_id, values...)``.

    ``keys`` are all dimensions other than the grid (variable, time, level);
    together with the point they are unique.  ``pack`` names an integer one
    (such as a time index) whose consecutive values the tiled plan handles
    side by side.  Only cells with a value are returned; missing cells are
    absent rows.  ``rows`` is about how many rows the field has, where that is
    known (fields x steps x points): the tiled plan then makes as many tasks as that needs, and
    splits its tiles by the other keys accordingly.
    """
    if strategy is None:
        small = 3 * n_targets * _WEIGHT_ROW_BYTES <= BROADCAST_WEIGHTS_BYTES
        strategy = "broadcast" if small else "tiled"
    if strategy == "broadcast":
        return _apply_broadcast(field, weights, keys, values)
    keep_copartitioning(field.sparkSession)
    partitions = max(
        int(field.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // TASK_ROWS)
    )
    return _apply_tiled(field, weights, keys, values, grid, tile, partitions, pack)


def regrid(
    field: DataFrame,
    grid: LatLonGrid,
    zoom: int,
    keys: list[str],
    values: list[str],
    lat: str = "lat",
    lon: str = "lon",
    weights: DataFrame | None = None,
    strategy: str | None = None,
    tile: int = TILE_POINTS,
    pack: str | None = None,
) -> DataFrame:
    """Regrid a field given by coordinates; builds the weights if none are passed."""
    if weights is None:
        weights = build_weights(field.sparkSession, grid, zoom)
    return apply_weights(
        grid.with_src_id(field, lat, lon), weights, grid, npix(zoom), keys, values, strategy, tile, pack
    )
