"""Approximate nearest neighbours by inner product: a forest of sorted hash strings.

Every tree hashes a vector to a string of symbols; a symbol is the axis, and
its sign, that a random projection leaves largest (cross-polytope hashing).
Vectors get one more coordinate that makes their norms equal, so that the
largest inner product is the smallest angle.  A tree is the sorted array of
its strings; what shares a prefix with a query is a range of it, found by
binary search.

A search descends in all trees at once to the longest prefix, then ascends
in step: the level is the deepest at which the ranges of all trees together
hold ``candidates`` entries, which grow with the table (``wanted``).  Every entry of those ranges is scored.  If even
the first symbol doesn't give so many, all vectors are scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

from orbgrid.llm.common import stored

TREES, SYMBOLS, SEED = 56, 4, 4711
#: Entries that the ranges of all trees hold at the level of a search, at least.
CANDIDATES = 2500
#: Entries of a sorted array that a task holds; more under one first symbol are cut into slices.
SLICE_ROWS = 4096


def symbol_bits(dims: int) -> int:
    """Bits of one symbol for vectors of ``dims`` numbers (one is added)."""
    return (2 * (dims + 1) - 1).bit_length()


def wanted(rows: int, dims: int) -> int:
    """Entries that a search asks for: half of what one symbol leaves of ``rows`` evenly spread vectors.

    A second symbol leaves too few of them, at any size of the table; where
    vectors are dense enough for longer prefixes to hold as many, those do.
    """
    return max(CANDIDATES, -(-TREES * rows // (4 * (dims + 1))))


def hash_strings(vectors: np.ndarray, tree: int) -> np.ndarray:
    """The string of each (extended) vector in one tree, first symbol in the highest bits."""
    dims = vectors.shape[1]
    bits, out = symbol_bits(dims - 1), np.zeros(len(vectors), np.int64)
    for s in range(SYMBOLS):
        turn = np.random.default_rng((SEED, tree, s)).standard_normal((dims, dims), np.float32)
        seen = vectors @ turn
        axis = np.abs(seen).argmax(axis=1)
        out = out << bits | (2 * axis + (seen[np.arange(len(seen)), axis] < 0))
    return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow column of equally long binaries as rows of numbers."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<f8" if len(data) == 8 * dims * len(column) else "<f4").reshape(len(column), dims)


def _hashed(dims: int, norm: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                x = _matrix(part.column("vec"), dims)
                query = np.array(part.column("query").to_pylist(), bool)
                rest = np.sqrt(np.maximum(norm * norm - (x.astype(np.float64) ** 2).sum(axis=1), 0.0))
                wide = np.hstack([x, np.where(query, 0.0, rest)[:, None]]).astype(np.float32)
                for tree in range(TREES):
                    yield pa.RecordBatch.from_arrays(
                        [part.column("id"), part.column("query"), pa.array(np.full(len(x), tree, np.int32)), pa.array(hash_strings(wide, tree))],
                        ["id", "query", "tree", "h"],
                    )

    return run


def _runs(batches: Iterator[pa.RecordBatch], answer) -> Iterator[pa.RecordBatch]:
    """Feed runs of equal ``key`` to ``answer``: the array first (held), then its queries batch by batch."""
    key, held, array = None, [], None
    for batch in batches:
        keys = batch.column("key").to_numpy(zero_copy_only=False)
        query = np.array(batch.column("query").to_pylist(), bool)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (query[1:] != query[:-1])) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if lo == hi:
                continue
            part = batch.slice(lo, hi - lo)
            if keys[lo] != key:
                key, held, array = keys[lo], [], None
            if not query[lo]:
                held.append(part)
            elif held:
                if array is None:
                    array = pa.Table.from_batches(held).combine_chunks()
                yield from answer(array, part)


def _range(strings: np.ndarray, h, level, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the range that shares ``level`` symbols with ``h``."""
    shift = bits * (SYMBOLS - level)
    low = h >> shift << shift
    return np.searchsorted(strings, low), np.searchsorted(strings, low + (1 << shift))


def _counted(bits: int):
    def answer(array: pa.Table, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        strings = array["h"].to_numpy()
        h = queries.column("h").to_numpy(zero_copy_only=False)
        ends = [_range(strings, h, level, bits) for level in range(1, SYMBOLS + 1)]
        yield pa.RecordBatch.from_arrays(
            [queries.column("id"), *[pa.array((hi - lo).astype(np.int64)) for lo, hi in ends]],
            ["id", *[f"n{k + 1}" for k in range(SYMBOLS)]],
        )

    return lambda batches: _runs(batches, answer)


def _best(bits: int, dims: int, keep: int):
    def answer(array: pa.Table, queries: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        strings, ids = array["h"].to_numpy(), array["id"].to_numpy()
        own = _matrix(array["vec"].combine_chunks(), dims).astype(np.float64)
        asked = _matrix(queries.column("vec"), dims).astype(np.float64)
        h, levels = queries.column("h").to_numpy(), queries.column("level").to_numpy()
        names = queries.column("id").to_numpy()
        out: tuple[list, list, list] = ([], [], [])
        for k in range(len(h)):
            lo, hi = _range(strings, h[k], int(levels[k]), bits) if levels[k] else (0, len(strings))
            if lo == hi:
                continue
            score = own[lo:hi] @ asked[k]
            # A few more than asked for, as the last bits of a product depend on where it stands.
            near = np.argpartition(-score, keep + 3)[: keep + 4] if hi - lo > keep + 4 else np.arange(hi - lo)
            exact = (own[lo:hi][near] * asked[k]).sum(axis=1)
            order = np.lexsort((ids[lo:hi][near], -exact))[:keep]
            out[0].append(np.full(len(order), names[k]))
            out[1].append(ids[lo:hi][near][order])
            out[2].append(exact[order])
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["query_id", "rid", "score"])

    return lambda batches: _runs(batches, answer)


def nearest(
    spark: SparkSession,
    vectors: DataFrame,
    is_query,
    k: int = 20,
    candidates: int | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products found for each query.

    ``candidates`` are by default those of ``wanted``.

    Queries are the rows where the column ``is_query`` holds; candidates all
    rows but the query's own.  Products are of the original numbers, in double
    precision; ties go to the smaller id.  Rows take no part whose id or vector
    is null, whose vector is zero, holds a null or a non-finite number, or is
    not as long as most are.  If an id repeats, its smallest vector counts.
    Equal vectors are searched as one and reported as themselves.

    Array entries are dealt out by tree and first symbol, in slices of about
    SLICE_ROWS, so that no task holds more than a slice; queries stream past
    it.  Each task answers with ``k`` rows a query and slice, never with all
    it has scored.
    """
    x = F.col("_v")
    valid = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("_v"), F.coalesce(is_query, F.lit(False)).alias("_q")).where(
        F.col("vec_id").isNotNull()
        & F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
        & F.exists(x, lambda a: a != 0)
    )
    common = valid.groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    result = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], result)
    dims = common["d"]
    is_double = isinstance(vectors.schema[vec_col].dataType.elementType, DoubleType)
    rows = stored(
        spark, valid.where(F.size("_v") == dims).groupBy("vec_id").agg(F.min("_v").alias("_v"), F.max("_q").alias("_q"))
    )
    square = F.aggregate(x, F.lit(0.0), lambda s, a: s + a.cast("double") * a.cast("double"))
    total = rows.agg(F.max(square)).first()[0]

    by_id = Window.partitionBy("_v").orderBy("vec_id")
    classes = stored(
        spark,
        rows.withColumn("_n", F.row_number().over(by_id)).where(F.col("_n") <= k + 1)
        .groupBy("_v").agg(F.min("vec_id").alias("rid"), F.collect_list("vec_id").alias("members")),
    )
    queries = rows.where("_q").select("vec_id", "_v")

    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        return v.map(lambda a: np.asarray(a, "<f8" if is_double else "<f4").tobytes())

    points = stored(
        spark,
        classes.select(F.col("rid").alias("id"), packed("_v").alias("vec"), F.lit(False).alias("query")).unionByName(
            queries.select(F.col("vec_id").alias("id"), packed("_v").alias("vec"), F.lit(True).alias("query"))
        ),
    )
    bits = symbol_bits(dims)
    first = F.shiftright("h", bits * (SYMBOLS - 1))
    strings = stored(
        spark, points.mapInArrow(_hashed(dims, float(total) ** 0.5), "id bigint, query boolean, tree int, h bigint")
    ).withColumn("symbol", first)
    # As many rows as trees times symbols.
    sizes = strings.where("not query").groupBy("tree", "symbol").agg(
        F.ceil(F.count("*") / SLICE_ROWS).cast("int").alias("slices")
    )
    n_all = classes.count()
    candidates = wanted(n_all, dims) if candidates is None else candidates

    def dealt(asked: DataFrame) -> DataFrame:
        """Array entries and queries, each with the key of its slice (queries: of all slices)."""
        own = F.shiftleft(F.col("tree").cast("long"), 48) + F.shiftleft(F.col("symbol"), 32)
        there = strings.where("not query").drop("query").join(F.broadcast(sizes), ["tree", "symbol"])
        there = there.select((own + F.pmod(F.xxhash64("id"), F.col("slices"))).alias("key"), F.lit(False).alias("query"), "h", "id")
        each = asked.join(F.broadcast(sizes), ["tree", "symbol"])
        each = each.withColumn("s", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        each = each.select((own + F.col("s")).alias("key"), F.lit(True).alias("query"), "h", "id")
        return there.unionByName(each)

    def in_runs(df: DataFrame) -> DataFrame:
        return df.repartition("key").sortWithinPartitions("key", "query", "h")

    levels = [f"n{s}" for s in range(1, SYMBOLS + 1)]
    counts = in_runs(dealt(strings.where("query"))).mapInArrow(
        _counted(bits), "id bigint, " + ", ".join(f"{n} bigint" for n in levels)
    )
    level = F.lit(0)
    for s, n in enumerate(levels, 1):
        level = F.when(F.sum(n) >= candidates, s).otherwise(level)
    found = stored(spark, counts.groupBy("id").agg(level.cast("int").alias("level")))

    asked = points.where("query").select("id", "vec").join(found, "id", "left").withColumn("level", F.coalesce("level", F.lit(0)))
    deep = strings.where("query").drop("query").join(asked.where("level > 0").select("id"), "id", "left_semi")
    in_trees = dealt(deep)
    # Queries that found too little meet all vectors, in slices of their own.
    everywhere = max(1, -(-n_all // SLICE_ROWS))
    slice_of = F.lit(-1).cast("long") - F.pmod(F.xxhash64("id"), F.lit(everywhere))
    wide = asked.where("level = 0").select("id").withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(everywhere - 1))))
    some = asked.where("level = 0").limit(1).count() > 0
    if some:
        in_trees = in_trees.unionByName(
            points.where("not query").select(slice_of.alias("key"), F.lit(False).alias("query"), F.lit(0).cast("long").alias("h"), "id")
        ).unionByName(
            wide.select((F.lit(-1).cast("long") - F.col("s")).alias("key"), F.lit(True).alias("query"), F.lit(0).cast("long").alias("h"), "id")
        )
    told = points.where("not query").select("id", "query", "vec", F.lit(0).alias("level")).unionByName(
        asked.select("id", F.lit(True).alias("query"), "vec", "level")
    )
    scored = in_runs(in_trees.join(told, ["id", "query"])).select("key", "query", "h", "id", "vec", "level").mapInArrow(
        _best(bits, dims, k + 1), "query_id bigint, rid bigint, score double"
    )
    own = queries.join(classes, "_v").select(F.col("vec_id").alias("query_id"), "rid", square.alias("score"))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "rid")
    best = (
        scored.unionByName(own)
        .groupBy("query_id", "rid").agg(F.max("score").alias("score"))
        .withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") <= k + 1)
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.join(classes.select("rid", "members"), "rid")
        .select("query_id", F.explode("members").alias("vec_id"), "score")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
