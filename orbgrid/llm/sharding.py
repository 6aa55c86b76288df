"""Reproducible shuffle into shards: a Feistel permutation of global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.llm.common import dense_index, packed, require_new, unpacked

ROUNDS = 6
#: Out-of-range values are under one in ``sqrt(n)``, and fewer than this where ``n`` is small.
WALKS = 40


def _mixed(value: Column, step: Column, key: int, size: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(key).cast("long"), step.cast("long"), value), F.lit(size))


def _permuted(x: Column, a: int, b: int, key: int) -> Column:
    """A permutation of 0 .. a*b-1: halves modulo ``a`` and ``b``, changed in turn by the other's hash."""

    def step(s: Column, k: Column) -> Column:
        left, right = s["l"], s["r"]
        return F.when(
            k % 2 == 0, F.struct(F.pmod(left + _mixed(right, k, key, a), F.lit(a)).alias("l"), right.alias("r"))
        ).otherwise(F.struct(left.alias("l"), F.pmod(right + _mixed(left, k, key, b), F.lit(b)).alias("r")))

    start = F.struct(F.call_function("div", x, F.lit(b)).alias("l"), F.pmod(x, F.lit(b)).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["l"] * b + s["r"])


def permute(row: Column, n: int, key: int) -> Column:
    """The place of row number ``row`` in a keyed shuffle of ``0 .. n-1``.

    The Feistel network runs on a grid of ``a * b >= n`` cells, hardly more
    than ``n``; a value past the end is permuted again until it falls inside
    (cycle walking), which keeps the map one-to-one.  A walk that isn't over
    after ``WALKS`` steps stops the job rather than give a wrong place; it
    can't happen for ``n`` up to 1,600 and has odds below ``n**-20`` above.
    """
    n = max(n, 1)
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    x = row.cast("long")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        _permuted(x, a, b, key),
        lambda y, _: F.when(y < n, y).otherwise(_permuted(y, a, b, key)),
    )
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def place(row: Column, n: int, n_shards: int, key: int) -> tuple[Column, Column]:
    """Shard and slot of row number ``row`` among ``n``; needs no other row."""
    p = permute(row, n, key)
    return F.pmod(p, F.lit(n_shards)).cast("int"), F.call_function("div", p, F.lit(n_shards))


def shard_rows(
    spark: SparkSession, df: DataFrame, order: list[str], n_shards: int, key: int, names=("row", "shard", "slot")
) -> DataFrame:
    """Add the global row number, shard and slot to every row.

    Rows are numbered in ``order`` (nulls first; rows equal in it in any order
    between themselves) and shuffled by ``permute``.  Shards differ by at most
    one row, slots of a shard run from 0 without gaps, and the same rows, key
    and shard count give the same result everywhere.  An empty table stays
    empty.  ``names`` are the columns added, which may not exist; others are passed through.
    """
    require_new(df, names)
    numbered = dense_index(spark, packed(df, *order), order, "_row")
    n = numbered.count()
    shard, slot = place(F.col("_row"), n, n_shards, key)
    placed = numbered.withColumn("_place", F.struct(shard.alias("s"), slot.alias("t")))
    return unpacked(
        placed,
        df.columns,
        tuple(order),
        F.col("_row").alias(names[0]),
        F.col("_place.s").alias(names[1]),
        F.col("_place.t").alias(names[2]),
    )
