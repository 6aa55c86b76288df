"""The cell store: partitioned Parquet with idempotent region writes.

Cells are stored long, one row per variable, time, level and cell.  Variables
reach the store from differently staggered grids and with times that are not
aligned between variables of one input cycle; a partition per variable and
block lets each be rewritten on its own, and selecting variables prunes
partitions just as it would prune columns.

``block`` numbers the unit of rewriting along time: the input cycle at the top
zoom, the time chunk at the coarser zooms.

Within a block, rows are laid out by tiles of cells, then by time and cell: the
statistics of files, row groups and pages are narrow, so that a read of a box
skips most of a block.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orbgrid.functions.axes import LatLonGrid
from orbgrid.functions.healpix import npix, signed_lon as to_signed, with_lonlat
from orbgrid.operators.cover import Extent, cover, in_ranges, merge
from orbgrid.operators.weights import build_weights, inside_extent

PARTITIONS = ["sim", "freq", "zoom", "variable", "block"]
#: Bits of the cells in a tile: a million cells, a base cell of zoom 10.  Zooms up to 8 are one tile.
TILE_BITS = 20
#: Index ranges in the filter of a read; more are joined across the smallest gaps.
READ_RANGES = 64
CELL_SCHEMA = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("level", T.DoubleType()),
        T.StructField("healpix_index", T.LongType()),
        T.StructField("value", T.FloatType()),
        T.StructField("sim", T.StringType()),
        T.StructField("freq", T.StringType()),
        T.StructField("zoom", T.IntegerType()),
        T.StructField("variable", T.StringType()),
        T.StructField("block", T.LongType()),
    ]
)


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Remove one partition folder; whether there was one."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def partition_folder(spark: SparkSession, path: str, values: dict) -> str:
    """Folder of a partition below ``path``, with the names that Spark's writer gives."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join([path, *[f"{k}={escape(str(v))}" for k, v in values.items()]])


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def overwrite_partitions(
    df: DataFrame, path: str, partitions: list[str], order: Sequence[str] = (), tile: Column | None = None
) -> None:
    """Replace exactly the partitions that occur in ``df``.

    Rows are rebalanced by partition and ``tile``: large parts are split over
    several tasks and small ones share one, so no writer gets a hot partition
    whole.  In a file, rows go by partition, tile and ``order``.
    """
    tiles = [] if tile is None else ["_tile"]
    out = df if tile is None else df.withColumn("_tile", tile)
    out = out.hint("rebalance", *partitions, *tiles)
    if order or tiles:
        out = out.sortWithinPartitions(*partitions, *tiles, *order)
    (
        out.drop("_tile").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


@dataclass(frozen=True)
class Region:
    """Blocks of one dataset that a write is to fill."""

    sim: str
    freq: str
    zoom: int
    variables: Sequence[str]
    blocks: Collection[int]


@dataclass(frozen=True)
class Written:
    """What a write left: ``(variable, block)`` pairs with values, and digests of the expected blocks' cells."""

    parts: set[tuple[str, int]]
    digests: dict[int, int]


class CellStore:
    """Cells of all simulations, frequencies and zooms under one root and version."""

    def __init__(self, spark: SparkSession, root: str, version: str = "v1", tile_bits: int = TILE_BITS):
        self.spark = spark
        self.tile_bits = tile_bits
        self.root = f"{root.rstrip('/')}/{version}"
        self.cells_path = f"{self.root}/cells"

    # cells

    def write_region(self, df: DataFrame, expected: Region | None = None) -> Written:
        """Write blocks; blocks already there are replaced, others untouched.

        What got values in this very write is noted while it runs: the
        ``(variable, block)`` pairs (at most variables x blocks), and for the
        blocks of ``expected`` a digest of their cells.  Pairs of ``expected``
        that got none are removed from the store, so that no reader is served
        what an earlier write left there.
        """
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in CELL_SCHEMA.fields]
        seen = Observation()
        rows = df.filter(F.col("value").isNotNull()).select(*cols)
        cell = F.xxhash64("variable", "time", "level", "healpix_index", "value")
        blocks = sorted(set(expected.blocks)) if expected is not None else []
        digests = [F.bit_xor(F.when(F.col("block") == b, cell)).alias(f"b{b}") for b in blocks]
        rows = rows.observe(seen, F.collect_set(F.struct("variable", "block")).alias("parts"), *digests)
        tile = F.shiftright("healpix_index", self.tile_bits)
        overwrite_partitions(rows, self.cells_path, PARTITIONS, ["time", "level", "healpix_index"], tile)
        try:
            noted = seen.get
        except Py4JJavaError:  # input that is proved empty is planned without the note
            noted = {}
        found = {(p["variable"], p["block"]) for p in noted.get("parts") or []}
        if expected is not None:
            for variable in expected.variables:
                for block in blocks:
                    if (variable, block) not in found:
                        self.remove_block(expected.sim, expected.freq, expected.zoom, variable, block)
        return Written(found, {b: noted.get(f"b{b}") or 0 for b in blocks})

    def remove_block(self, sim: str, freq: str, zoom: int, variable: str, block: int) -> bool:
        values = dict(zip(PARTITIONS, (sim, freq, zoom, variable, block), strict=True))
        return remove_folder(self.spark, partition_folder(self.spark, self.cells_path, values))

    def scan(
        self,
        sim: str | None = None,
        freq: str | None = None,
        zoom: int | None = None,
        variables: list[str] | None = None,
    ) -> DataFrame:
        """Cells of the given datasets.

        Leading partition values go into the path, so that only the folders of
        the dataset are listed and not the whole store.
        """
        given = {"sim": sim, "freq": freq, "zoom": zoom}
        leading: dict = {}
        for name, value in given.items():
            if value is None:
                break
            leading[name] = value
        folders = [partition_folder(self.spark, self.cells_path, leading)]
        if len(leading) == len(given) and variables is not None:
            folders = [partition_folder(self.spark, folders[0], {"variable": v}) for v in variables]
        folders = [f for f in folders if table_exists(self.spark, f)]
        if not folders:
            return self.spark.createDataFrame([], CELL_SCHEMA)
        out = self.spark.read.schema(CELL_SCHEMA).option("basePath", self.cells_path).parquet(*folders)
        for name, value in given.items():
            if value is not None:
                out = out.filter(F.col(name) == value)
        return out if variables is None else out.filter(F.col("variable").isin(variables))

    def open(
        self,
        sim: str,
        freq: str,
        zoom: int,
        variables: list[str] | None = None,
        signed_lon: bool = False,
        extent: Extent | None = None,
        time: tuple[datetime | None, datetime | None] | None = None,
        blocks: tuple[int, int] | None = None,
    ) -> DataFrame:
        """One dataset with coordinates; only its partitions are read.

        ``extent`` (west, east, south, north; east may pass 360) keeps cells with
        their centres strictly inside, ``time`` (from, before; either may be
        None) a half-open range of times.  A box reaches the Parquet scan as the
        index ranges of its cover, which skip what lies apart; the centres of
        the rest are looked at.  Times are compared row by row, as Parquet
        filters leave out timestamps without a zone: ``blocks`` (first, last)
        prunes their folders, and ``jobs.open_dataset`` derives it from them.
        ``signed_lon`` concerns the longitudes of the result alone.
        """
        out = self.scan(sim, freq, zoom, variables)
        if blocks is not None:
            out = out.filter(F.col("block").between(*blocks))
        first, before = time or (None, None)
        if first is not None:
            out = out.filter(F.col("time") >= F.lit(first).cast("timestamp_ntz"))
        if before is not None:
            out = out.filter(F.col("time") < F.lit(before).cast("timestamp_ntz"))
        if extent is None:
            return with_lonlat(out, zoom, signed=signed_lon)
        ranges = merge(cover(extent, zoom).ranges, READ_RANGES)
        if len(ranges) != 1 or tuple(ranges[0]) != (0, npix(zoom)):
            out = out.filter(in_ranges("healpix_index", ranges))
        placed = with_lonlat(out, zoom).withColumn("_lon", F.col("lon"))
        boxed = inside_extent(placed, extent, lon="_lon").drop("_lon")
        return boxed.withColumn("lon", to_signed("lon")) if signed_lon else boxed

    def catalog(self) -> DataFrame:
        """Datasets and variables there are, from partition values only."""
        return self.scan().select("sim", "freq", "zoom", "variable").distinct()

    # small tables beside the cells

    def write_table(self, df: DataFrame, name: str, partitions: list[str]) -> None:
        overwrite_partitions(df, f"{self.root}/{name}", partitions)

    def append_table(self, df: DataFrame, name: str, partitions: list[str]) -> None:
        """Add rows in one file a call and partition; a repeated call repeats them."""
        df.coalesce(1).write.mode("append").partitionBy(*partitions).parquet(f"{self.root}/{name}")

    def remove_rows(self, name: str, partition: dict) -> bool:
        """Remove one partition of a table."""
        return remove_folder(self.spark, partition_folder(self.spark, f"{self.root}/{name}", partition))

    def read_table(self, name: str, schema) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/{name}", schema)


def for_consumers(df: DataFrame) -> DataFrame:
    """The names analysis code expects: cells are called ``cell``."""
    return df.withColumnRenamed("healpix_index", "cell")


# --- weights -----------------------------------------------------------------

WEIGHT_SCHEMA = (
    "healpix_index bigint, j0 bigint, i0 bigint, corners array<struct<src_id:bigint, w:double>>,"
    " zoom int, grid_key string"
)


def cached_weights(store: CellStore, grid: LatLonGrid, zoom: int) -> DataFrame:
    """Weights of a grid and zoom, built and stored the first time they are asked for."""
    have = store.read_table("weights", WEIGHT_SCHEMA)
    mine = (F.col("zoom") == zoom) & (F.col("grid_key") == grid.key)
    if have.filter(mine).isEmpty():
        fresh = build_weights(store.spark, grid, zoom)
        fresh = fresh.withColumns({"zoom": F.lit(zoom), "grid_key": F.lit(grid.key)})
        store.write_table(fresh, "weights", ["zoom", "grid_key"])
        have = store.read_table("weights", WEIGHT_SCHEMA)
    return have.filter(mine)


# --- metadata ----------------------------------------------------------------

# Attributes every dataset carries.
DEFAULT_ATTRIBUTES = {
    "latitiude_convention": "[-90, 90]",  # spelled so in the delivered datasets
    "longitude_convention": "[0, 360]",
}
CONVENTIONS = {"Conventions": "CF-1.13"}
GLOBAL_BOUNDS = {"lower_left_lat": -90, "lower_left_lon": 0, "upper_right_lat": 90, "upper_right_lon": 360}


def merge_maps(*maps: Column) -> Column:
    """Union of maps; later ones win."""
    def two(a: Column, b: Column) -> Column:
        kept = F.map_filter(a, lambda k, _: ~F.array_contains(F.map_keys(b), k))
        return F.map_concat(kept, b)

    return reduce(two, maps)


def dataset_metadata(datasets: DataFrame, regional: bool, shared: dict[str, str]) -> DataFrame:
    """One row per dataset: merged attributes and the grid mapping.

    ``datasets`` holds ``sim, freq, zoom, config`` (a map) and, for regional
    ones, ``bounds`` (text).
    """
    def lit_map(d: dict[str, str]) -> Column:
        return F.create_map(*[F.lit(x) for kv in d.items() for x in kv]).cast("map<string,string>")

    bounds = F.col("bounds") if regional else F.lit(str(GLOBAL_BOUNDS))
    attrs = merge_maps(
        F.map_concat(lit_map({**DEFAULT_ATTRIBUTES, "regional": str(regional)}), F.create_map(F.lit("regional_bounds"), bounds)),
        F.col("config"),
        lit_map(shared) if shared else F.create_map().cast("map<string,string>"),
        lit_map(CONVENTIONS),
    )
    return datasets.select("sim", "freq", "zoom", attrs.alias("attrs")).withColumn("crs", grid_mapping("zoom"))


# Names and values of the grid mapping that readers look for.
def grid_mapping(zoom: str) -> Column:
    z = F.col(zoom).cast("int")
    return F.create_map(
        F.lit("grid_mapping_name"), F.lit("healpix"),
        F.lit("indexing_scheme"), F.lit("nested"),
        F.lit("refinement_level"), z.cast("string"),
        F.lit("healpix_nside"), F.call_function("shiftleft", F.lit(1), z).cast("string"),
        F.lit("healpix_order"), F.lit("nest"),
    )


# --- reports -----------------------------------------------------------------


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def read_report(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read.option("header", "true")
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)
