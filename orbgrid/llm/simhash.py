"""SimHash near-dedup with Golay-code keys.

Two fingerprints link when at most ``RADIUS`` of their 64 bits differ.  The
bits are cut into segments of 23, 23 and 18.  The perfect binary Golay code
[23, 12, 7] has, for every segment, either one codeword within two bits, or
one at three bits and five at four; those are its one or six keys.  Segments
that differ in at most two bits always share a key (it holds because the
extended code splits 24 bits into sextets).

Errors of a link are spread over the segments, four at most in all:

* one segment has none: of the other two, one has at most two.  Key: the
  whole clean segment and a Golay key of the other (six such families);
* no segment is clean: then two have exactly one error, the third at most
  two.  Key: a clean half of each of the two and a Golay key of the third
  (twelve families).

So every link shares a key of 30 to 36 bits in some family, and hardly
anything else does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orbgrid.llm.common import join_summary, packed, stored, unpacked
from orbgrid.llm.components import components

RADIUS = 4
SHINGLE_WORDS = 4
SEED = 42

#: Fingerprints of one bucket that one task compares at once; larger buckets are cut into slices.
BUCKET_ROWS = 4096

#: First bit and width of the segments; bits of their lower halves.
SEGMENTS = ((0, 23), (23, 23), (46, 18))

#: Generator polynomial of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
_GENERATOR = 0b101011100011


# -- fingerprints ---------------------------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit SimHash of a whole text.

    A-Z are lower-cased, words are runs of anything but ASCII white space,
    features are shingles of four words with repeats (the whole text when it
    has fewer); their XXH64 votes.  Null, empty and blank texts give 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(SHINGLE_WORDS, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - k + 1].tolist()
    ends = ends[k - 1 :].tolist()
    one = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), 32768):  # bounded memory for very long texts
        part = [one(joined[i:j], SEED) for i, j in zip(starts[at : at + 32768], ends[at : at + 32768], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int32)
    mine = np.packbits(2 * votes > len(starts), bitorder="little")
    return int(mine.view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t.as_py()) for t in batch.column("_text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(np.array(values, np.uint64).view(np.int64))], ["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and signed 64-bit ``fp`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        _fingerprints, f"doc_id {kind}, fp bigint"
    )


# -- keys -----------------------------------------------------------------------------------------


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator."""
    words = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, _GENERATOR << (bit - 11), 0)
    return words


def _golay_errors() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome its error patterns (padded to six) and how many there are."""
    bits = 1 << np.arange(23)
    patterns = [0]
    for weight in range(1, 5):
        last = np.zeros(1, np.int64)
        highest = np.full(1, -1)
        for _ in range(weight):
            last = np.concatenate([last[highest < b] | bits[b] for b in range(23)])
            highest = np.floor(np.log2(last)).astype(int)
        patterns.extend(np.unique(last).tolist())
    patterns = np.array(patterns)
    syndromes = _syndromes(patterns)
    errors, counts = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    lightest = np.full(2048, 9)
    for p, s, w in zip(patterns, syndromes, np.bitwise_count(patterns), strict=True):
        lightest[s] = min(lightest[s], w)
        if w <= 3 or lightest[s] == 3:
            errors[s, counts[s]] = p
            counts[s] += 1
    return errors, counts


_TABLES: tuple | None = None


def _tables() -> tuple:
    global _TABLES
    if _TABLES is None:
        low, high = _syndromes(np.arange(1 << 12)), _syndromes(np.arange(1 << 11) << 12)
        _TABLES = (low, high, *_golay_errors())
    return _TABLES


def golay_keys(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and 12-bit codeword indices: one or six for each 23-bit segment."""
    low, high, errors, counts = _tables()
    syndrome = low[segment & 0xFFF] ^ high[segment >> 12]
    n = counts[syndrome]
    rows = np.repeat(np.arange(len(segment)), n)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, (segment[rows] ^ errors[syndrome[rows], nth]) >> 11


def golay_codewords() -> np.ndarray:
    """The 4,096 words of the extended code [24, 12, 8]: those of the perfect code with a parity bit above."""
    words = np.arange(1 << 12) << 11
    words ^= _syndromes(words)
    return words | (np.bitwise_count(words).astype(np.int64) & 1) << 23


def link_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and 64-bit keys of unsigned fingerprints; see the module."""
    parts = [((fps >> np.uint64(at)) & np.uint64((1 << wide) - 1)).astype(np.int64) for at, wide in SEGMENTS]
    halves = [
        (p & ((1 << wide // 2) - 1), p >> (wide // 2)) for p, (_, wide) in zip(parts, SEGMENTS, strict=True)
    ]
    codes = [golay_keys(p) for p in parts]
    rows, keys, family = [], [], 0
    for k in range(3):
        at, code = codes[k]
        i, j = [x for x in range(3) if x != k]
        clean = [parts[i], parts[j]] + [(x << 12) | y for x in halves[i] for y in halves[j]]
        for c in clean:
            rows.append(at)
            keys.append(family << 48 | c[at] << 12 | code)
            family += 1
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = batch.column("fp").to_numpy(zero_copy_only=False)
        for at in range(0, len(every), 2000):
            fps = every[at : at + 2000]
            rows, keys = link_keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps[rows])], ["key", "fp"])


# -- links ----------------------------------------------------------------------------------------


def _close(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= radius


def bucket_forest(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links of one bucket that connect whatever its links connect; fewer than it has members.

    Grows one component after another.  A fingerprint is compared with those
    not reached yet only, so that a group of near copies costs little more
    than its size.
    """
    left, right = [], []
    rest = fps
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            x = reached.pop()
            hit = _close(np.full(len(rest), x), rest, radius)
            if hit.any():
                new = rest[hit]
                rest = rest[~hit]
                left.append(np.full(len(new), x))
                right.append(new)
                reached.extend(new.tolist())
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _links(limit: int | None, radius: int):
    """Links within runs of equal ``key``; runs over ``limit`` come out as they are, marked hot."""

    def small(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of short runs, by distance within the run, without a loop over runs."""
        a, b, shift = [], [], 1
        while shift < len(keys):
            same = np.flatnonzero(keys[shift:] == keys[:-shift])
            if not len(same):
                break
            hit = same[_close(fps[same], fps[same + shift], radius)]
            a.append(fps[hit])
            b.append(fps[hit + shift])
            shift += 1
        none = np.zeros(0, np.int64)
        return (np.concatenate(a), np.concatenate(b)) if a else (none, none)

    def out(hot: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), hot)), pa.array(a), pa.array(b)], ["hot", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k = held_f = np.zeros(0, np.int64)
        hot_key = None
        for batch in batches:
            k = batch.column("key").to_numpy(zero_copy_only=False)
            f = batch.column("fp").to_numpy(zero_copy_only=False)
            if hot_key is not None:  # the run that was handed on goes on
                n = int(np.searchsorted(k, hot_key, "right"))
                if n:
                    yield out(True, k[:n], f[:n])
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                hot_key = None
            k, f = np.concatenate([held_k, k]), np.concatenate([held_f, f])
            starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
            sizes = np.diff(np.concatenate([starts, [len(k)]]))
            last = starts[-1] if len(starts) else 0
            yield from finished(k[:last], f[:last], starts[:-1], sizes[:-1])
            held_k, held_f = k[last:], f[last:]
            if limit is not None and len(held_k) > limit:
                yield out(True, held_k, held_f)
                hot_key, held_k, held_f = held_k[0], held_k[:0], held_f[:0]
        if len(held_k):
            yield from finished(held_k, held_f, np.zeros(1, int), np.array([len(held_k)]))

    def finished(k, f, starts, sizes) -> Iterator[pa.RecordBatch]:
        if not len(k):
            return
        short = np.repeat(sizes <= 16, sizes)
        a, b = small(k[short], f[short])
        yield out(False, a, b)
        for at, n in zip(starts[sizes > 16], sizes[sizes > 16], strict=True):
            if limit is not None and n > limit:
                yield out(True, k[at : at + n], f[at : at + n])
            else:
                yield out(False, *bucket_forest(f[at : at + n], radius))

    return run


def link_fingerprints(spark: SparkSession, fps: DataFrame, keyed=_keyed, radius: int = RADIUS) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints (column ``fp``) that connect all linked ones.

    ``keyed`` gives the keys from the rows of ``fps``; two fingerprints within
    ``radius`` bits link if they share one.  Keys are shuffled once and compared in sorted runs.  A run longer than
    ``BUCKET_ROWS`` is cut into slices by hash, and every pair of slices meets
    in a task of its own: bounded memory, no link lost, and no pairs written
    but a forest.
    """
    keys = fps.mapInArrow(keyed, "key bigint, fp bigint")
    found = stored(
        spark,
        keys.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
            _links(BUCKET_ROWS, radius), "hot boolean, a bigint, b bigint"
        ),
    )
    hot = found.where("hot").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    sizes = hot.groupBy("key").agg(F.ceil(F.count("*") / (BUCKET_ROWS / 2)).cast("int").alias("g"))
    mine = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
    met = (
        hot.join(sizes, "key")
        .withColumn("s", mine)
        .select("key", "fp", "s", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("t"))
        .select(F.xxhash64("key", F.least("s", "t"), F.greatest("s", "t")).alias("key"), "fp")
    )
    # Slice pairs that meet under one hash only add members to a bucket.
    more = met.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
        _links(None, radius), "hot boolean, a bigint, b bigint"
    )
    return found.where(~F.col("hot")).unionByName(more).select("a", "b").distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (signed), ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, the row's own
    included.  Rows with equal fingerprints are linked; texts without words
    have fingerprint 0 like any other.  Repeated ids keep all their rows; a
    component of null ids alone has a null ``component_id``.
    """
    rows = stored(spark, fingerprints(docs, id_col, text_col))
    known = stored(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("_first")))
    roots = components(spark, link_fingerprints(spark, known.select("fp")))
    placed = known.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "_first", F.coalesce("root", "fp").alias("_root")
    )
    ids = placed.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = join_summary(placed, ids, "_root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(spark: SparkSession, docs: DataFrame, groups=near_duplicates) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest id.

    Of rows that repeat under that id, the one with the smallest text (then the
    smallest of the other columns) stays.  Rows with a null id can't be named
    and all stay.  Columns are unchanged.  ``groups`` gives each row its ``component_id``.
    """
    named = docs.where(F.col("doc_id").isNotNull())
    stay = groups(spark, named).where("doc_id = component_id").select("doc_id").distinct()
    rest = [F.col("_rest").getField(c).cast("string") for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("doc_id").orderBy("text", *rest)
    first = (
        packed(named, "doc_id", "text")
        .join(stay, "doc_id", "left_semi")
        .withColumn("_nth", F.row_number().over(order))
        .where("_nth = 1")
    )
    return unpacked(first, docs.columns, ("doc_id", "text")).unionByName(docs.where(F.col("doc_id").isNull()))
