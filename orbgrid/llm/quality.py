"""Quality classifier: document statistics, random Fourier features, ridge scores, isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "longest_word", "upper", "digits", "marks", "other_marks", "non_ascii",
    "spaces", "lines_per_word", "distinct_words", "top_word", "repeated_lines", "line_words", "sentence_lines",
    "doubled_marks", "long_words", "short_words", "capital_words",
)

#: Random features of the kernel, and its width in standard deviations of the statistics.
N_FEATURES, WIDTH, RIDGE, SEED = 256, 6.0, 1e-3, 9176
#: Partial sums that reach the driver: this many matrices of N_FEATURES + 1 squared.
PARTIALS = 32
#: Score bins that calibration is fitted on.
BINS = 1024
FOLDS = 5

# Byte classes: 0 other, 1 upper, 2 digit, 3 common mark, 4 other mark, 5 not ASCII, 6 white space.
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[33, 34, 35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]] = 4
_CLASS[[39, 40, 41, 44, 45, 46, 58, 59, 63]] = 3
_CLASS[128:] = 5
_CLASS[[9, 10, 11, 12, 13, 32]] = 6


def statistics(text: str | None) -> list[float]:
    """The ``STATISTICS`` of one whole text; zeros for null and empty texts."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kind = _CLASS[raw]
    upper, digit, mark, other, wide, space = (np.bincount(kind, minlength=7) / len(raw))[1:7]
    doubled = float(np.count_nonzero((kind[1:] == 4) & (kind[:-1] == 4))) / len(raw)
    words = text.split()
    n = max(len(words), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(len(lines), 1)
    return [
        math.log1p(len(raw)),
        math.log1p(len(words)),
        min(float(sizes.mean()), 50.0),
        math.log1p(float(sizes.max())),
        upper,
        digit,
        mark,
        other,
        wide,
        space,
        m / n,
        math.log1p(len(seen)) / math.log1p(n),
        max(seen.values(), default=0) / n,
        1 - len(set(lines)) / m,
        math.log1p(n / m),
        sum(x.rstrip()[-1] in ".!?" for x in lines) / m,
        doubled,
        float((sizes > 15).mean()),
        float((sizes < 3).mean()),
        sum(w.isupper() for w in words) / n,
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in texts])


@dataclass
class QualityModel:
    """What scoring needs; a few thousand numbers."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    values: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    def features(self, stats: np.ndarray) -> np.ndarray:
        return _fourier(stats, self.mean, self.scale)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)

    def score_text(self, text: Column) -> Column:
        """The calibrated score of a text column, 0 to 1."""
        model = self

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            return pd.Series(model.score(np.array([statistics(t) for t in texts]).reshape(len(texts), len(STATISTICS))))

        return score(text)

    def score_statistics(self, stats: Column) -> Column:
        model = self

        @F.pandas_udf("double")
        def score(rows: pd.Series) -> pd.Series:
            return pd.Series(model.score(np.array(rows.tolist(), float).reshape(len(rows), len(STATISTICS))))

        return score(stats)


def _fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of the Gaussian kernel, and a constant.

    ``cos(w.x + b)`` with normal ``w`` and uniform ``b``: inner products of
    these approach the kernel's values.  Statistics are held to eight
    standard deviations, so that a freak text meets the kernel's tail.
    """
    rng = np.random.default_rng(SEED)
    w = rng.standard_normal((stats.shape[1], N_FEATURES)) / WIDTH
    b = rng.uniform(0, 2 * np.pi, N_FEATURES)
    x = np.clip((stats - mean) / scale, -8, 8)
    z = np.sqrt(2 / N_FEATURES) * np.cos(x @ w + b)
    return np.hstack([z, np.ones((len(z), 1))])


def _sums(mean: np.ndarray, scale: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = N_FEATURES + 1
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            stats = np.array(batch.column("stats").to_pylist(), float).reshape(batch.num_rows, len(STATISTICS))
            z = _fourier(stats, mean, scale)
            left += z.T @ z
            right += z.T @ batch.column("y").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_pydict({"a": [left.tobytes()], "b": [right.tobytes()]})

    return run


def isotonic(total: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The nondecreasing fit to ``total / weight`` (pool adjacent violators)."""
    pools: list[list[float]] = []
    for t, w in zip(total, weight, strict=True):
        pools.append([t, w, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            t2, w2, n2 = pools.pop()
            pools[-1] = [pools[-1][0] + t2, pools[-1][1] + w2, pools[-1][2] + n2]
    return np.concatenate([np.full(int(n), t / w) for t, w, n in pools]) if pools else np.zeros(0)


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo FOLDS; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def fit(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from the labelled rows outside fold 0.

    ``stats`` has ``doc_id`` and ``stats``; ``labels`` has ``doc_id`` and
    ``quality`` (0 or 1; null rows are left out).  Folds 1 to 3 give the
    normal equations of ridge regression, summed in at most ``PARTIALS`` tasks
    and then on the driver (each a fixed-size matrix); fold 4 calibrates, in
    ``BINS`` bins.  Every labelled row counts.  Without labelled rows every
    score is 0.5; with too few to calibrate, the ridge score itself is used.
    """
    known = stats.join(
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).select(
            "doc_id", F.col("quality").cast("double").alias("y")
        ),
        "doc_id",
    ).withColumn("_fold", fold("doc_id"))
    train = known.where(F.col("_fold").between(1, 3)).select("stats", "y")
    each = [F.col("stats")[i] for i in range(len(STATISTICS))]
    row = train.agg(F.count("*").alias("n"), *[F.avg(x) for x in each], *[F.stddev_pop(x) for x in each]).first()
    size = len(STATISTICS)
    if not row["n"]:
        half = np.full(2, 0.5)
        return QualityModel(np.zeros(size), np.ones(size), np.zeros(N_FEATURES + 1), values=half)
    mean = np.array(row[1 : 1 + size], float)
    scale = np.array(row[1 + size :], float)
    scale = np.where(scale > 1e-9, scale, 1.0)
    left, right = np.zeros((N_FEATURES + 1, N_FEATURES + 1)), np.zeros(N_FEATURES + 1)
    for part in train.repartition(PARTIALS).mapInArrow(_sums(mean, scale), "a binary, b binary").toLocalIterator():
        left += np.frombuffer(part["a"]).reshape(left.shape)
        right += np.frombuffer(part["b"])
    penalty = RIDGE * row["n"] * np.eye(N_FEATURES + 1) / N_FEATURES
    penalty[-1, -1] = 1e-9
    model = QualityModel(mean, scale, np.linalg.solve(left + penalty, right))

    @F.pandas_udf("double")
    def raw(rows: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.array(rows.tolist(), float).reshape(len(rows), len(STATISTICS))))

    low, high = -0.5, 1.5
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("r") - low) / (high - low) * BINS)))
    bins = (
        known.where(F.col("_fold") == 4)
        .select(raw("stats").alias("r"), "y")
        .groupBy(place.cast("int").alias("bin"))
        .agg(F.sum("y").alias("t"), F.count("*").alias("w"), F.avg("r").alias("x"))
        .orderBy("bin")
        .collect()
    )
    if len(bins) > 1:
        model.knots = np.array([b["x"] for b in bins])
        model.values = isotonic(np.array([b["t"] for b in bins]), np.array([float(b["w"]) for b in bins]))
    return model
