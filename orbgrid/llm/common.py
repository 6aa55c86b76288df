"""Helpers of the training-data operators: stored tables, dense row numbers, ASCII lower case."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbgrid.session import scratch_root

#: Bits of ``monotonically_increasing_id`` that hold the row within its partition.
_ROW_BITS = 33


def stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's shared scratch folder and read back.

    The result doesn't depend on any executor: a lost one costs a read, never
    a different answer.  The folder belongs to ``spark.checkpoint.dir`` and is
    cleaned with it.
    """
    path = scratch_root(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_summary(rows: DataFrame, summary: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``summary``, an aggregate by ``key``.

    The key is wrapped, so that both sides are shuffled for the join alone and
    not placed by the aggregation: adaptive execution may then split a hot key's rows.
    """
    other = summary.select(F.struct(key).alias("_key"), *[c for c in summary.columns if c != key])
    return rows.withColumn("_key", F.struct(key)).join(other, "_key").drop("_key")


def packed(df: DataFrame, *keep: str) -> DataFrame:
    """``keep`` as they are and all other columns in one struct, so that no name of theirs can clash."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in keep] or [F.lit(0).alias("none")]
    return df.select(*[F.col(f"`{c}`") for c in keep], F.struct(*rest).alias("_rest"))


def unpacked(df: DataFrame, columns: list[str], keep: tuple[str, ...], *more: Column) -> DataFrame:
    """The columns that ``packed`` was given, and ``more``."""
    own = [F.col(f"`{c}`") if c in keep else F.col("_rest").getField(c).alias(c) for c in columns]
    return df.select(*own, *more)


def require_new(df: DataFrame, names: tuple[str, ...]) -> None:
    """Columns that an operator adds may not be there already."""
    there = sorted(set(names) & set(df.columns))
    if there:
        raise ValueError(f"the input has columns named {there}; rename them or the result's")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters untouched; null becomes empty.

    Texts of ASCII alone (as many bytes as characters) take Spark's fast
    ``lower``, which is the same there.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def dense_index(spark: SparkSession, df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number all rows from 0 without gaps, in ascending ``order`` (nulls first).

    One range shuffle sorts the rows; each knows its place in its partition;
    the starts of the partitions come from their counts, one row a partition.
    No task sees more than its own partition, whatever the keys.  The sorted
    rows are stored before they are counted, so that the numbers hold when a
    task is run again.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(spark, ordered.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_m"), _ROW_BITS)
    counts = rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # One row for each partition of the shuffle.
    return (
        rows.withColumn("_p", part)
        .join(F.broadcast(starts), "_p")
        .withColumn(name, F.col("_start") + F.col("_m").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_p", "_m", "_start")
    )
