"""Which input cycles have arrived, which are complete, what is left to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.functions.axes import TimeAxis, floor_hours, parse_cycle

# Streams whose name holds this text are not used.
IGNORED_STREAM = "apvere"


def list_files(spark: SparkSession, root: str, pattern: str = "*.pp", folders: str | None = None) -> DataFrame:
    """Files under ``root`` as ``path, stem``; contents are not read.

    ``folders`` is a pattern for the folders directly below ``root`` that
    hold streams, such as ``apve*``; others are not listed.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root if folders is None else f"{root.rstrip('/')}/{folders}")
        .select("path")
    )
    return files.withColumn("stem", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1))


def file_cycles(files: DataFrame) -> DataFrame:
    """``path, stem, cycle`` of the files that take part; a stem without a cycle time stops the job."""
    used = files.filter(~F.contains("stem", F.lit(IGNORED_STREAM)))
    stamp = F.coalesce(
        parse_cycle("stem"),
        F.raise_error(F.concat(F.lit("no cycle time in the name of "), F.col("path"))).cast("timestamp_ntz"),
    )
    return used.withColumn("cycle", stamp)


def complete_files(files: DataFrame, expected: int, keys: list[str] | None = None) -> DataFrame:
    """``cycle, paths`` of cycles with exactly ``expected`` files.

    Counted before anything is collected, so every list has that length.
    """
    keys = keys or ["cycle"]
    whole = files.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == expected)
    kept = files.join(whole.select(*keys), keys, "left_semi")
    return kept.groupBy(*keys).agg(F.array_sort(F.collect_list("path")).alias("paths"))


def cycle_status(arrivals: DataFrame, expected: int, keys: list[str]) -> DataFrame:
    """Streams seen per cycle, and whether that is all of them."""
    seen = arrivals.groupBy(*keys).agg(F.count_distinct("stream").alias("n_streams"))
    return seen.withColumn("complete", F.col("n_streams") == expected)


def complete_cycles(arrivals: DataFrame, expected: int, keys: list[str]) -> DataFrame:
    return cycle_status(arrivals, expected, keys).filter("complete").select(*keys)


def todo(complete: DataFrame, done: DataFrame, keys: list[str], end=None) -> DataFrame:
    """Complete cycles without a result, up to an end time."""
    if end is not None:
        complete = complete.filter(F.col("cycle") <= F.lit(end).cast("timestamp_ntz"))
    return complete.join(done, keys, "left_anti")


def chunk_plan(steps: DataFrame, chunk: int, n: str = "n_steps") -> DataFrame:
    """Time chunks of series of ``n`` steps: ``chunk, start_idx, end_idx``."""
    count = F.ceil(F.col(n) / F.lit(float(chunk))).cast("bigint")
    listed = steps.filter(F.col(n) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0), count - 1)))
    return listed.withColumns(
        {"start_idx": F.col("chunk") * chunk, "end_idx": (F.col("chunk") + 1) * chunk}
    )


def coverage_gate(
    series: DataFrame, present: DataFrame, axis: TimeAxis, chunk: int, hours: int = 12, preceding: bool = False
) -> DataFrame:
    """Time chunks of each series and whether all cycles they touch are present.

    A stamp at the start of a cycle may come from the cycle before (half-past
    steps move to the full hour); with ``preceding`` that one must be present
    as well, unless it lies before the axis.

    ``series`` has one row per dataset (``sim``); ``present`` holds
    ``sim, cycle``.  The last stamp of the axis lies beyond the last input and
    is left out.
    """
    steps = series.select("sim", F.posexplode(axis.stamps()).alias("time_idx", "time")).filter(
        F.col("time_idx") < axis.size - 1
    )
    own = floor_hours("time", hours)
    before = floor_hours(F.col("time") - F.make_dt_interval(secs=F.lit(1)), hours)
    cycles = F.array(own, before) if preceding else F.array(own)
    touched = steps.select(
        "sim",
        F.floor(F.col("time_idx") / F.lit(float(chunk))).cast("bigint").alias("chunk"),
        F.explode(cycles).alias("cycle"),
    ).distinct()
    touched = touched.filter(F.col("cycle") >= F.lit(axis.start).cast("timestamp_ntz"))
    marked = touched.join(present.select("sim", "cycle", F.lit(True).alias("_here")), ["sim", "cycle"], "left")
    return marked.groupBy("sim", "chunk").agg(
        F.count(F.lit(1)).alias("n_cycles"),
        F.bool_and(F.col("_here").isNotNull()).alias("runnable"),
    )
