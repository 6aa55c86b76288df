"""HEALPix nested-order arithmetic as Spark columns.

Cells are ``BIGINT`` ids in nested order, so the four children of cell ``p``
are ``4p .. 4p+3`` and an ancestor ``k`` zooms up is ``p >> 2k``.  Everything
here stays inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_ZOOM = 29


def nside(zoom: int) -> int:
    return 1 << zoom


def npix(zoom: int) -> int:
    return 12 << (2 * zoom)


def zoom_from_nside(n: Column) -> Column:
    """Zoom of a power-of-two ``nside`` column."""
    return F.round(F.log2(n)).cast("int")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parent(ip: Column | str, levels: int = 1) -> Column:
    return F.shiftright(_col(ip), 2 * levels)


def children(ip: Column | str) -> Column:
    """Array of the four child ids."""
    first = F.shiftleft(_col(ip), 2)
    return F.sequence(first, first + F.lit(3))


def chunk_id(ip: Column | str, cells_per_chunk: int) -> Column:
    """Spatial chunk of a cell; power-of-two sizes become a shift."""
    if cells_per_chunk & (cells_per_chunk - 1) == 0:
        return F.shiftright(_col(ip), cells_per_chunk.bit_length() - 1)
    return F.floor(_col(ip) / F.lit(float(cells_per_chunk))).cast("bigint")


def wrap_lon(lon: Column | str) -> Column:
    """Longitude in [0, 360)."""
    return F.pmod(_col(lon), F.lit(360.0))


def signed_lon(lon: Column | str) -> Column:
    """Longitude in (-180, 180]."""
    lon = wrap_lon(lon)
    return F.when(lon <= 180.0, lon).otherwise(lon - 360.0)


def unwrap_lon(lon: Column | str, max_lon: float) -> Column:
    """Longitude matched to a domain whose eastern edge may lie past 360."""
    lon = wrap_lon(lon)
    if max_lon <= 360.0:
        return lon
    return F.when(lon <= max_lon - 360.0, lon + 360.0).otherwise(lon)


#: Cells that one row fans out into at a time.
FAN_OUT = 4**7


def every_cell(rows: DataFrame, zoom: int, ip: str = "healpix_index") -> DataFrame:
    """All cells of a zoom for each row, by way of blocks of FAN_OUT cells that are spread over the tasks."""
    if npix(zoom) <= FAN_OUT:
        cells = F.sequence(F.lit(0).cast("bigint"), F.lit(npix(zoom) - 1).cast("bigint"))
        return rows.withColumn(ip, F.explode(cells))
    blocks = F.sequence(F.lit(0).cast("bigint"), F.lit(npix(zoom) // FAN_OUT - 1).cast("bigint"))
    spread = rows.withColumn("_block", F.explode(blocks)).repartition(*rows.columns, "_block")
    first = F.col("_block") * F.lit(FAN_OUT).cast("bigint")
    return spread.withColumn(ip, F.explode(F.sequence(first, first + F.lit(FAN_OUT - 1).cast("bigint")))).drop("_block")


def _even_bits(q: Column, bits: int) -> Column:
    """Gather bits 0, 2, 4, ... of ``q`` into a dense integer."""
    picked = [
        F.shiftleft(F.shiftright(q, 2 * k).bitwiseAND(F.lit(1)), k) for k in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), picked, F.lit(0).cast("bigint"))


def with_lonlat(
    df: DataFrame,
    zoom: int | str,
    ip: str = "healpix_index",
    lon: str = "lon",
    lat: str = "lat",
    signed: bool = False,
) -> DataFrame:
    """Attach cell-centre coordinates (Gorski et al. 2005, nested order).

    ``zoom`` is a number, or the name of a column so that one table may hold
    several zooms, up to ``MAX_ZOOM``.  The steps are
    separate projections so that no sub-expression is expanded twice.
    """
    if isinstance(zoom, str):
        z, bits = F.col(zoom).cast("int"), MAX_ZOOM
        n = F.call_function("shiftleft", F.lit(1).cast("bigint"), z)
        n2 = n * n
        face = F.call_function("shiftright", F.col(ip), 2 * z)
        within = F.pmod(F.col(ip), n2)
    else:
        bits = zoom
        n = F.lit(nside(zoom)).cast("bigint")
        face = F.shiftright(F.col(ip), 2 * zoom)
        within = F.col(ip).bitwiseAND(F.lit(nside(zoom) ** 2 - 1).cast("bigint"))
    nd = F.col("_n").cast("double")
    row = F.shiftright(F.col("_face"), 2)
    staged = (
        df.withColumns({"_n": n, "_face": face, "_q": within})
        .withColumns(
            {
                "_ix": _even_bits(F.col("_q"), bits),
                "_iy": _even_bits(F.shiftright(F.col("_q"), 1), bits),
            }
        )
        .withColumns(
            {
                "_jr": (row + 2) * F.col("_n") - F.col("_ix") - F.col("_iy") - 1,
                "_jp": 2 * F.col("_face").bitwiseAND(F.lit(3).cast("bigint"))
                + F.when(row == 1, 0).otherwise(1),
                "_d": F.col("_ix") - F.col("_iy"),
            }
        )
        .withColumn("_nr", F.least("_jr", "_n", 4 * F.col("_n") - F.col("_jr")))
    )
    nr = F.col("_nr").cast("double")
    rows_off = 2 * F.col("_n") - F.col("_jr")  # rows from the equator
    cap = 1.0 - nr * nr / (3.0 * nd * nd)
    z = F.when(F.col("_nr") == F.col("_n"), rows_off.cast("double") * 2.0 / (3.0 * nd)).otherwise(
        F.signum(rows_off.cast("double")) * cap
    )
    turn = (F.col("_jp") * F.col("_nr") + F.col("_d")).cast("double")
    staged = staged.withColumns({"_z": z, "_lon": 45.0 * turn / nr})
    out = signed_lon("_lon") if signed else wrap_lon("_lon")
    # Coordinates leave through a one-element inline: filters on them then use
    # the finished columns instead of being pushed down as the whole formula.
    finished = F.array(F.struct(out.alias(lon), F.degrees(F.asin("_z")).alias(lat)))
    kept = [c for c in df.columns if c not in (lon, lat)]
    return staged.select(*kept, F.inline(finished))
