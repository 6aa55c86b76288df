"""Incremental ingest with Structured Streaming.

The stream only announces arrivals: it reads the identifying columns of new
source files.  Each batch updates the arrival manifest, finds the cycles that
have become complete and not been done, and runs the batch jobs for those.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from orbgrid.functions.axes import LatLonGrid
from orbgrid.plans.config import STREAMS_PER_CYCLE, Experiment
from orbgrid.plans.jobs import coarsen_all, create_dataset, done_cycles, is_created, regrid_cycles
from orbgrid.sources.manifest import complete_cycles, todo
from orbgrid.sources.store import CellStore

ARRIVAL_SCHEMA = "cycle timestamp_ntz, stream string, sim string, batch bigint"


def arrivals_stream(spark: SparkSession, path: str, schema, per_trigger: int = 10_000) -> DataFrame:
    """New source files as ``sim, cycle, stream`` rows."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", per_trigger)
        .parquet(path)
        .select("sim", "cycle", "stream")
    )


def complete_in_stream(arrivals: DataFrame, expected: int, late: str = "7 days") -> DataFrame:
    """Cycles as they become complete, with one row of state per open cycle.

    Each stream of a cycle counts once; a cycle leaves the state when the
    watermark has passed its twelve hours.
    """
    once = arrivals.withWatermark("cycle_time", late).dropDuplicates(["sim", "cycle_time", "stream"])
    counts = once.groupBy("sim", F.window("cycle_time", "12 hours")).agg(F.count(F.lit(1)).alias("n_streams"))
    return counts.filter(F.col("n_streams") == expected).select("sim", F.col("window.start").alias("cycle_time"), "n_streams")


def pending_cycles(store: CellStore, sim: str, expected: int = STREAMS_PER_CYCLE, end=None) -> DataFrame:
    """Complete cycles of the manifest that have no result yet."""
    seen = store.read_table("arrivals", ARRIVAL_SCHEMA).filter(F.col("sim") == sim)
    whole = complete_cycles(seen, expected, ["sim", "cycle"])
    return todo(whole, done_cycles(store, sim), ["sim", "cycle"], end)


def record_arrivals(batch: DataFrame, batch_id: int, store: CellStore) -> None:
    """Add a batch to the manifest; a repeated batch replaces itself."""
    rows = batch.select("cycle", "stream", "sim").distinct().withColumn("batch", F.lit(batch_id))
    store.write_table(rows, "arrivals", ["sim", "batch"])


def run_available(
    spark: SparkSession,
    source: str,
    schema,
    experiment: Experiment,
    grid_of: Callable[[str], LatLonGrid],
    store: CellStore,
    checkpoint: str,
    expected: int = STREAMS_PER_CYCLE,
    coarser: bool = True,
    end=None,
    static: DataFrame | None = None,
) -> StreamingQuery:
    """Process everything that has arrived since the last call, then stop.

    The first call creates the dataset.  Cycles that can't be regridded are
    set aside and don't hold up others (table ``rejected``).  Cycles after
    ``end`` are left for later.
    """
    if not is_created(store, experiment):
        create_dataset(store, experiment, grid_of, static)

    def step(batch: DataFrame, batch_id: int) -> None:
        record_arrivals(batch, batch_id, store)
        fields = spark.read.schema(schema).parquet(source)
        pending = pending_cycles(store, experiment.key, expected, end)
        regrid_cycles(fields, pending, experiment, grid_of, store, strict=False)
        if coarser:
            dims = tuple(d for d, f in (("2d", "PT1H"), ("3d", "PT3H")) if any(g.store == f for g in experiment.groups))
            coarsen_all(store, experiment, dims, end)

    query = (
        arrivals_stream(spark, source, schema)
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
