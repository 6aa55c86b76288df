"""Hard negatives by exact integer scores: subset-sum tables of the anchors, bit planes of the candidates.

A component becomes the integer floor(scale * x).  A candidate is kept as bit
planes of its integers: of each plane, one byte for every eight dimensions.
An anchor block is kept as tables: for each eight dimensions, the sums of all
256 subsets of its components.  A candidate's bytes index the tables; the
sums of a plane, shifted to its weight, add up to the full inner product
(the highest plane is the sign and counts negative).

Candidates are held in slabs, anchors stream past them in blocks, and each
slab answers with the few best rows of an anchor, never with its scores.
Positives need slabs of the anchor's label alone, so those are cut by label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbgrid.llm.common import join_summary, stored

#: Candidates that a task holds at a time, anchors whose tables it holds, candidates scored at a time.
SLAB_ROWS, BLOCK_ANCHORS, STEP_ROWS = 1 << 18, 256, 1024
#: Dimensions of one table; a byte indexes it.
GROUP = 8
#: Scores stay below this, so that window bounds (100 times a score) fit a long too.
LARGEST = (1 << 62) // 100
_NONE = np.iinfo(np.int64).min


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sums of every subset of eight components, for rows of integers."""
    n, dims = anchors.shape
    x = anchors.reshape(n, dims // GROUP, GROUP)
    out = np.zeros((dims // GROUP, 1 << GROUP, n), np.int64)
    for d in range(GROUP):
        out[:, 1 << d : 2 << d] = out[:, : 1 << d] + x[:, :, d].T[:, None]
    return out


def to_planes(x: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes: bit p of eight dimensions each, in two's complement."""
    bits = (x[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def scores(tables: np.ndarray, planes: np.ndarray, wide: type) -> np.ndarray:
    """(candidates, anchors) inner products from lookups, shifts and additions alone."""
    total = np.zeros((len(planes), tables.shape[2]), wide)
    part, row = np.empty((2, len(planes), tables.shape[2]), tables.dtype)
    top = planes.shape[1] - 1
    for p in range(top + 1):
        np.take(tables[0], planes[:, p, 0], axis=0, out=part, mode="clip")
        for g in range(1, len(tables)):
            np.take(tables[g], planes[:, p, g], axis=0, out=row, mode="clip")
            part += row
        shifted = part.astype(wide) << p
        if p == top:
            total -= shifted
        else:
            total += shifted
    return total


def _narrowest(bound: int) -> type:
    return np.int16 if bound < 1 << 15 else np.int32 if bound < 1 << 31 else np.int64


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of integers as rows of ``dims``, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _packed(dims: int, planes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                rows = to_planes(_integers(part.column("x"), dims), planes)
                data = pa.array([r.tobytes() for r in rows], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), data], ["vec_id", "label", "planes"])

    return run


class _Best:
    """The first ``keep`` candidates of each anchor and window so far."""

    def __init__(self, low: np.ndarray, high: np.ndarray, keep: int):
        self.low, self.high, self.keep = low, high, keep
        self.score = np.full((*low.shape, keep), _NONE)
        self.vec = np.zeros((*low.shape, keep), np.int64)

    def add(self, score: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Rows of ``score`` are candidates in ascending order of their ids, so a tie with the last one kept is lost."""
        for k in range(self.low.shape[1]):
            least = np.maximum(self.low[:, k], self.score[:, k, -1] + 1)
            c, a = np.nonzero(allowed & (score >= least) & (score <= self.high[:, k]))
            if not len(c):
                continue
            old = np.flatnonzero(self.score[:, k, 0] != _NONE)
            old = old[np.isin(old, a)]
            was = self.score[old, k] != _NONE
            anchor = np.concatenate([a, np.repeat(old, self.keep)[was.ravel()]])
            value = np.concatenate([score[c, a].astype(np.int64), self.score[old, k][was]])
            vec = np.concatenate([ids[c], self.vec[old, k][was]])
            order = np.lexsort((vec, -value, anchor))
            anchor, value, vec = anchor[order], value[order], vec[order]
            heads = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            place = np.arange(len(anchor)) - np.repeat(heads, np.diff(np.append(heads, len(anchor))))
            keep = place < self.keep
            self.score[np.unique(anchor), k] = _NONE
            self.score[anchor[keep], k, place[keep]] = value[keep]
            self.vec[anchor[keep], k, place[keep]] = vec[keep]


def _search(dims: int, planes: int, largest: int, keep: int, same_label: bool, block_anchors: int):
    """Slabs come before the anchors of their key; answers are (anchor row, window, candidate, score)."""
    groups = dims // GROUP
    shape = (-1, planes, groups)

    def answer(held: list[pa.RecordBatch], asked: pa.Table) -> Iterator[pa.RecordBatch]:
        for at in range(0, asked.num_rows, block_anchors):
            block = asked.slice(at, block_anchors).combine_chunks()
            x = _integers(block["x"], dims)
            bound = int(np.abs(x).sum(axis=1).max())
            tables = subset_sums(x).astype(_narrowest(bound))
            wide = _narrowest(max(bound * (largest + 1) * 4, 1 << 16))
            names, labels = block["vec_id"].to_numpy(), block["label"].to_numpy()
            windows = [np.array(block[c].to_pylist(), np.int64).reshape(len(x), -1) for c in ("low", "high")]
            best = _Best(*windows, keep)
            for batch in held:
                ids, own = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
                data = np.frombuffer(b"".join(batch.column("planes").to_pylist()), np.uint8).reshape(shape)
                # The first steps are short: nothing is known yet that keeps rows out.
                cuts = sorted({0, 64, 256, *range(0, len(ids), STEP_ROWS), len(ids)})
                for lo, hi in zip(cuts, cuts[1:], strict=False):
                    if hi > len(ids):
                        break
                    allowed = ids[lo:hi, None] != names
                    if not same_label:
                        allowed &= own[lo:hi, None] != labels
                    best.add(scores(tables, data[lo:hi], wide), ids[lo:hi], allowed)
            a, k, n = np.nonzero(best.score != _NONE)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [block["row"].combine_chunks().take(pa.array(a)), pa.array(k.astype(np.int32)), pa.array(best.vec[a, k, n]), pa.array(best.score[a, k, n])],
                    ["row", "k", "found_id", "score"],
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            own, slab = (batch.column(c).to_numpy() for c in ("own", "slab"))
            anchors = np.array(batch.column("anchor").to_pylist(), bool)
            cuts = np.flatnonzero((own[1:] != own[:-1]) | (slab[1:] != slab[:-1]) | (anchors[1:] != anchors[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(own)], strict=True):
                if lo == hi:
                    continue
                if (own[lo], slab[lo]) != key:
                    key, held = (own[lo], slab[lo]), []
                part = batch.slice(lo, hi - lo)
                if not anchors[lo]:
                    held.append(part)
                elif held:
                    yield from answer(held, pa.Table.from_batches([part]))

    return run


def _points(df: DataFrame, id_col: str, vec_col: str, label: Column, scale: int) -> DataFrame:
    x = F.col("_x")
    return (
        df.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vec_col).alias("_x"))
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull())
        .where(F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))))
        .select("vec_id", "label", F.transform(x, lambda a: F.floor(a.cast("double") * scale)).alias("x"), F.aggregate(x, F.lit(0.0), lambda m, a: F.greatest(m, F.abs(a.cast("double") * scale))).alias("_top"))
    )


def hard_negatives(
    spark: SparkSession,
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int] = (80, 100),
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    An anchor's positives are its first ``positives`` rows of the same label.
    Each gets the first ``negatives`` rows of other labels whose score is from
    ``window[0]`` to ``window[1]`` per cent of the positive's (none, if that is
    negative).  Scores are exact integers; higher ones come first, ties by
    smaller id.  ``is_anchor`` is a column of ``vec_id``, ``label`` one of the
    input.  Nothing is sampled or capped: all rows are scored.

    No part take rows whose id, label or vector is null, or whose vector holds
    a null or a non-finite number.  Shorter vectors are filled up with zeros;
    an empty one scores 0.  A repeated id is as many rows: each can be found
    and each anchor among them answers, but never one with another of its own
    id.  An empty table gives an empty result.  Other columns are not read.
    Vectors whose scores would not fit a long raise ValueError.

    Work is anchors times rows, as an exact answer over all rows needs; what
    moves are the packed rows twice and an anchor once for each slab of
    SLAB_ROWS candidates.
    """
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    points = _points(vectors, id_col, vec_col, label, scale)
    seen = points.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dims"), F.max("_top").alias("top")).first()
    if not seen.n:
        return spark.createDataFrame([], result)
    dims = max(GROUP, -(-seen.dims // GROUP) * GROUP)
    largest = int(seen.top) + 1 if math.isfinite(seen.top) else LARGEST
    if dims * largest * largest > LARGEST:
        raise ValueError(f"scores of vectors with components up to {largest} (scaled) don't fit a long")
    planes = largest.bit_length() + 1

    points = points.drop("_top")
    packed = stored(spark, points.mapInArrow(_packed(dims, planes), "vec_id long, label long, planes binary"))
    anchors = stored(spark, points.where(is_anchor).withColumn("row", F.monotonically_increasing_id()))
    slabs = max(-(-seen.n // SLAB_ROWS), spark.sparkContext.defaultParallelism)
    salt = F.xxhash64("vec_id")
    rows = F.least(F.lit(SLAB_ROWS), F.lit(-(-seen.n // slabs)))
    by_label = packed.groupBy("label").agg(F.ceil(F.count("*") / rows).alias("slabs"))

    def searched(held: DataFrame, asked: DataFrame, keep: int, same_label: bool) -> DataFrame:
        """The first ``keep`` rows of each anchor and window, from the slabs of the same ``own`` and ``slab``."""
        asked = asked.select("own", "slab", F.lit(True).alias("anchor"), "vec_id", "label", F.lit(None).cast("binary").alias("planes"), "row", "x", "low", "high")
        only = [F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in ("row", "x", "low", "high")]
        held = held.select("own", "slab", F.lit(False).alias("anchor"), "vec_id", "label", "planes", *only)
        runs = held.unionByName(asked).repartition(4 * slabs, "own", "slab").sortWithinPartitions("own", "slab", "anchor", "vec_id")
        found = runs.mapInArrow(_search(dims, planes, largest, keep, same_label, BLOCK_ANCHORS), "row long, k int, found_id long, score long")
        first = Window.partitionBy("row", "k").orderBy(F.desc("score"), "found_id")
        return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= keep)

    near = (
        join_summary(anchors, by_label, "label")
        .withColumns({"own": F.col("label"), "low": F.array(F.lit(-LARGEST)), "high": F.array(F.lit(LARGEST))})
        .withColumn("slab", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slabs") - 1)))
    )
    same = join_summary(packed, by_label, "label").withColumns({"own": F.col("label"), "slab": F.pmod(salt, F.col("slabs"))})
    chosen = stored(
        spark,
        searched(same, near, positives, True)
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", F.col("found_id").alias("id"), "score"))).alias("chosen")),
    )
    # Every anchor has as many windows; that of a negative positive, or of one that is not there, is empty.
    least, most = window
    low = F.expr(f"transform(chosen, p -> if(p.score < 0, {LARGEST}L, (p.score * {least} + 99) div 100))")
    high = F.expr(f"transform(chosen, p -> if(p.score < 0, -{LARGEST}L, (p.score * {most}) div 100))")
    filled = lambda a, none: F.slice(F.concat(a, F.array_repeat(F.lit(none).cast("long"), positives)), 1, positives)
    everywhere = F.sequence(F.lit(0).cast("long"), F.lit(slabs - 1).cast("long"))
    far = (
        anchors.join(chosen, "row")
        .withColumns({"own": F.lit(0).cast("long"), "low": filled(low, LARGEST), "high": filled(high, -LARGEST)})
        .withColumn("slab", F.explode(everywhere))
    )
    others = packed.withColumns({"own": F.lit(0).cast("long"), "slab": F.pmod(salt, F.lit(slabs).cast("long"))})
    found = searched(others, far, negatives, False)
    of = F.element_at("chosen", F.col("k") + 1)
    return (
        found.join(chosen, "row").join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
        .select(
            "anchor_id", of["id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
            of["score"].alias("positive_score"), F.col("score").alias("negative_score"),
        )
    )
