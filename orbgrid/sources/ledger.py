"""Versions of the blocks of a store: what each was made of, and what is out of date.

Every write of blocks adds a row for each: its version, which is a digest of
its cells, and for blocks of coarser zooms the blocks one zoom up, with their
versions, that it was made of.  A block is out of date when that is no longer
what there is; a block that was written again as it had been changes nothing.
Rows are only added; the latest one of a block counts, by the clock of the
driver.  A dataset has one writer at a time.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orbgrid.sources.store import CellStore

LEDGER_SCHEMA = (
    "freq string, zoom int, block bigint, at bigint, version bigint, made_of array<struct<block: bigint, version: bigint>>, sim string"
)
Sources = list[tuple[int, int]]


def latest(store: CellStore, sim: str, freq: str) -> DataFrame:
    """``zoom, block, version, made_of`` of the blocks as they are."""
    rows = store.read_table("ledger", LEDGER_SCHEMA).filter((F.col("sim") == sim) & (F.col("freq") == freq))
    newest = F.max_by(F.struct("version", "made_of"), "at").alias("_b")
    return rows.groupBy("zoom", "block").agg(newest).select("zoom", "block", "_b.version", "_b.made_of")


def record(
    store: CellStore, sim: str, freq: str, zoom: int, versions: dict[int, int], made_of: dict[int, Sources] | None = None
) -> None:
    """Note that blocks were written, each with its version and, below the top, what it was made of."""
    if not versions:
        return
    at = time.time_ns()
    rows = [(freq, zoom, b, at, v, made_of[b] if made_of else None, sim) for b, v in sorted(versions.items())]
    store.append_table(store.spark.createDataFrame(rows, LEDGER_SCHEMA), "ledger", ["sim"])


def outdated(store: CellStore, sim: str, freq: str, zoom: int, spans: list[tuple[int, int, int]]) -> dict[int, Sources]:
    """Blocks of a zoom to be made (again), each with what it will be made of.

    ``spans`` holds block, first and last source block one zoom up; at most
    one row per step of the axis.  A block is due when it was never made or
    was made of other versions than those there are, some that have come or
    gone included; without any source it isn't.
    """
    if not spans:
        return {}
    now = latest(store, sim, freq)
    wanted = store.spark.createDataFrame(spans, "block bigint, lo bigint, hi bigint")
    source = now.filter(F.col("zoom") == zoom + 1).select(F.col("block").alias("source"), "version")
    parts = wanted.select("block", F.explode(F.sequence("lo", "hi")).alias("source")).join(source, "source")
    there = parts.groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct(F.col("source").alias("block"), "version"))).alias("there")
    )
    made = now.filter(F.col("zoom") == zoom).select("block", "made_of")
    due = there.join(made, "block", "left").filter(F.col("made_of").isNull() | (F.col("made_of") != F.col("there")))
    return {r.block: [(s.block, s.version) for s in r.there] for r in due.collect()}
