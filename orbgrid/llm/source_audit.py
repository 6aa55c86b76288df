"""How far the sources of a language differ in their terms: bitmaps of the terms that occur so often.

A group (language and source) keeps, for each count, the bitset of the ids of
the terms it has so often.  For two groups, AND and popcount of their bitsets
give the number of terms for each pair of counts; such a cell is multiplied
with the divergence of the two counts, which is the same for all its terms.
Terms that a group does not have are the complement of its bitsets.

Bitsets are kept in words of 64 ids; ids follow the terms' frequency, so that
a word holds few different counts.  Tasks compare the groups over a block of
ids, and sums over blocks are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbgrid.llm.byte_words import byte_class, slices, split_words
from orbgrid.llm.common import dense_index, join_summary, stored

WORD = 64
#: Term ids of a block, and groups of a language that a task compares with as many others.
BLOCK_IDS, CHUNK_GROUPS = 4096, 32
#: Probabilities are integers of this unit.
UNIT = 1_000_000_000

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each slice of a batch: (lang, source, term) with its occurrences and documents; a row without a term for each group."""
    letters = byte_class(LETTERS)
    for batch in batches:
        names = batch.select(["lang", "source"])
        _, group = np.unique(np.array([f"{len(a)} {a}{b}" for a, b in zip(*(c.to_pylist() for c in names.columns), strict=True)]), return_inverse=True)
        first = np.zeros(group.max(initial=-1) + 1, np.int64)
        first[group[::-1]] = np.arange(len(group))[::-1]
        for lo, hi in slices(batch.column("text")):
            words, row = split_words(batch.column("text").slice(lo, hi - lo), letters)
            coded = words.dictionary_encode()
            n, terms = max(1, len(coded.dictionary)), coded.indices.to_numpy().astype(np.int64)
            in_row, times = np.unique((row + lo) * n + terms, return_counts=True)
            cell = group[in_row // n] * n + in_row % n
            order = np.argsort(cell, kind="stable")
            cell, times = cell[order], times[order]
            heads = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
            keys = pa.array(first[cell[heads] // n])
            yield pa.RecordBatch.from_arrays(
                [*[c.take(keys) for c in names.columns], coded.dictionary.take(pa.array(cell[heads] % n)),
                 pa.array(np.add.reduceat(times, heads) if len(heads) else heads), pa.array(np.diff(np.append(heads, len(cell))))],
                ["lang", "source", "term", "n", "docs"],
            )
        yield pa.RecordBatch.from_arrays(
            [*[c.take(pa.array(first)) for c in names.columns], pa.nulls(len(first), pa.string()), pa.array(np.zeros(len(first), np.int64)), pa.array(np.zeros(len(first), np.int64))],
            ["lang", "source", "term", "n", "docs"],
        )


def probability(n: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a term that occurs ``n`` times among ``total``, in whole units; exact at any size."""
    wide = "decimal(38,0)"
    top = (n.cast("decimal(20,0)") + 2) * F.lit(UNIT).cast("decimal(10,0)")
    return F.call_function("div", top.cast(wide), (total + 2 * terms).cast(wide)) + 1


def _levels(rows: pa.Table, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitsets and probabilities of one group, (words, levels); the first level is the complement of all others."""
    word, bits, p, n = (rows[c].to_numpy() for c in ("word", "bits", "p", "n"))
    zero = p[n == 0][0]
    word, bits, p = word[n > 0], bits[n > 0].view(np.uint64), p[n > 0]
    order = np.argsort(word, kind="stable")
    word, bits, p = word[order], bits[order], p[order]
    each = np.bincount(word, minlength=len(valid))
    place = 1 + np.arange(len(word)) - np.repeat(np.cumsum(each) - each, each)
    sets = np.zeros((len(valid), 1 + int(each.max(initial=0))), np.uint64)
    ps = np.full(sets.shape, zero, np.int64)
    sets[word, place], ps[word, place] = bits, p
    sets[:, 0] = valid & ~np.bitwise_or.reduce(sets[:, 1:], axis=1)
    return sets, ps


def compare(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum over the ids of a block of (p-q)^2 div (p+q), from the joint cells of two groups' levels."""
    cells = np.bitwise_count(one[0][:, :, None] & other[0][:, None, :])
    w, i, j = np.nonzero(cells)
    p, q = one[1][w, i], other[1][w, j]
    return int(((p - q) ** 2 // (p + q) * cells[w, i, j]).sum())


def _pairs(block_ids: int, chunk_groups: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """All pairs of the groups of one chunk with those of another (or its own) over one block of ids."""
        lang, block, low, high = (k.as_py() for k in key)
        size = min(block_ids, max(0, rows["terms"][0].as_py() - block * block_ids))
        full, rest = divmod(size, WORD)
        valid = np.full(full + 1, ~np.uint64(0))
        valid[full] = np.uint64((1 << rest) - 1)
        group = rows["number"].to_numpy()
        order = np.argsort(group, kind="stable")
        rows, group = rows.take(pa.array(order)), group[order]
        heads = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        ends = np.append(heads[1:], len(group))
        names = group[heads]
        held = [_levels(rows.slice(a, b - a), valid) for a, b in zip(heads, ends, strict=True)]
        out: list[tuple[int, int, int]] = []
        for i, one in enumerate(held):
            for j in range(i + 1, len(held)):
                # Two of one chunk belong to the task of that chunk alone.
                if low == high or names[i] // chunk_groups != names[j] // chunk_groups:
                    out.append((names[i], names[j], compare(one, held[j])))
        a, b, v = zip(*out, strict=True) if out else ((), (), ())
        columns = {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "value": pa.array(v, pa.int64())}
        return pa.table({"lang": pa.array([lang] * len(out), pa.string()), **columns})

    return run


def audit(
    spark: SparkSession,
    docs: DataFrame,
    min_docs: int = 10,
    top: int = 10,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """lang, source, part, item, value, rank: divergence of each source from the others and from its language.

    Terms are runs of letters (any character beyond ASCII counts as one), A-Z
    lower-cased; a language keeps those in ``min_docs`` of its documents at
    least.  With n occurrences a group has p = 1 + UNIT (n + 2) div (N + 2 V)
    for each of the V kept terms, N being the sum of n; two such numbers
    differ by (p-q)^2 div (p+q).  Part ``pair``: item is each other source of
    the language, value the sum over all kept terms.  Part ``term``: item is a
    term that the source has and has more of than the language (q), the first
    ``top`` of them.  Ranks from 1, by value descending, then item.

    Null texts, languages and sources count as empty ones; a group without
    terms takes part, a language without kept terms has pairs of value 0, and
    a language of one source none.  Every row is a document, repeated ones
    too.  An empty table gives an empty result; other columns are not read.
    """
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    cells = stored(
        spark,
        plain.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
    )
    kept = cells.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
    kept = kept.where(F.col("docs") >= min_docs).select("lang", (-F.col("in_lang")).alias("less"), "term")
    ids = stored(spark, dense_index(spark, kept, ["lang", "less", "term"], "id"))
    by_lang = ids.groupBy("lang").agg(F.min("id").alias("first"), F.count("*").alias("terms"), F.sum(-F.col("less")).alias("lang_n"))

    named = F.struct("lang", "term")
    there = cells.where("term is not null").withColumn("key", named)
    there = stored(
        spark,
        join_summary(
            there.join(ids.select(named.alias("key"), "id", (-F.col("less")).alias("in_lang")), "key").drop("key", "docs"), by_lang, "lang"
        ).withColumn("id", F.col("id") - F.col("first")).drop("first"),
    )
    # One row for each group and for each language: as many as sources.
    sums = there.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = stored(
        spark,
        cells.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(by_lang.select("lang", "terms"), "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("group_n", "terms")])
        .withColumn("number", F.row_number().over(numbered).cast("long") - 1)
        .withColumn("chunks", F.ceil(F.count("*").over(Window.partitionBy("lang")) / CHUNK_GROUPS)),
    )
    who = F.struct("lang", "source")
    known = there.withColumn("key", who).drop("lang", "source", "terms").join(groups.select(who.alias("key"), "lang", "source", "group_n", "terms", "number", "chunks"), "key").drop("key")
    known = stored(spark, known.withColumn("p", probability(F.col("n"), F.col("group_n"), F.col("terms"))))

    at = F.pmod("id", F.lit(BLOCK_IDS))
    levels = (
        known.withColumns({"block": F.shiftright("id", BLOCK_IDS.bit_length() - 1), "word": F.shiftright(at, WORD.bit_length() - 1)})
        .groupBy("lang", "block", "number", "chunks", "terms", "n", "p", "word")
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(id % {WORD} as int))")).alias("bits"))
    )
    last = F.greatest(F.ceil(F.col("terms") / BLOCK_IDS) - 1, F.lit(0).cast("long"))
    spine = groups.select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), "number", "chunks", "terms", F.lit(0).cast("long").alias("n"),
        F.when(F.col("terms") > 0, probability(F.lit(0).cast("long"), F.col("group_n"), F.col("terms"))).otherwise(1).alias("p"),
        F.lit(0).cast("long").alias("word"), F.lit(0).cast("long").alias("bits"),
    )
    own = F.shiftright("number", CHUNK_GROUPS.bit_length() - 1)
    dealt = (
        levels.unionByName(spine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .withColumns({"low": F.least(own, "other"), "high": F.greatest(own, "other")})
        .select("lang", "block", "low", "high", "number", "terms", "n", "p", "word", "bits")
    )
    pairs = dealt.groupBy("lang", "block", "low", "high").applyInArrow(_pairs(BLOCK_IDS, CHUNK_GROUPS), "lang string, a long, b long, value long")
    pairs = pairs.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = lambda c, out: groups.select("lang", F.col("number").alias(c), F.col("source").alias(out))
    pairs = both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    q = probability(F.col("in_lang"), F.col("lang_n"), F.col("terms"))
    more = known.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    first = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    terms = more.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(first)).unionByName(terms)
