"""The prefix forest against brute force, and the pipeline stage by stage."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orbgrid.llm import line_dedup, near_texts, prefix_forest, simhash
from orbgrid.llm.common import stored
from orbgrid.llm.queries import GOOD, QUERIES

SF = "/root/testdata/sf0.001"


def exact(ids, vectors, queries, k):
    out = {}
    for q in queries:
        score = vectors @ vectors[q]
        order = [j for j in np.lexsort((ids, -score)) if j != q][:k]
        out[ids[q]] = [(ids[j], score[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_small_table_is_searched_exactly(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    want = exact(ids, x, [k for k, i in enumerate(ids) if i % 20 == 0], 20)
    got = found(QUERIES["op6_prefix_forest"](spark, SF))
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_recall_of_the_trees(spark, monkeypatch):
    """Clusters, a hot one among them, norms that differ, and slices smaller than a hot range."""
    monkeypatch.setattr(prefix_forest, "SLICE_ROWS", 200)
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((40, 16))
    which = np.where(rng.random(3000) < 0.33, 0, rng.integers(0, 40, 3000))
    x = (centres[which] + 0.35 * rng.standard_normal((3000, 16))) * rng.uniform(0.5, 2.0, (3000, 1))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = found(prefix_forest.nearest(spark, df, F.col("vec_id") % 100 == 0, 10, candidates=1500))
    want = exact(list(range(3000)), x, range(0, 3000, 100), 10)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    assert all(abs(s - x[q] @ x[i]) < 1e-12 for q, rows in got.items() for i, s in rows)


def test_recall_past_the_second_symbol(spark, monkeypatch):
    """Evenly spread vectors, so many that two symbols leave CANDIDATES entries."""
    monkeypatch.setattr(prefix_forest, "CANDIDATES", 100)
    x = np.random.default_rng(12).standard_normal((12_000, 16))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = exact(list(range(12_000)), x, range(0, 12_000, 400), 10)

    def recall(**options):
        got = found(prefix_forest.nearest(spark, df, F.col("vec_id") % 400 == 0, 10, **options))
        return sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (10 * len(want))

    fixed, grown = recall(candidates=100), recall()
    print(f"recall {fixed:.2f} with a fixed number of candidates, {grown:.2f} with one that grows")
    assert fixed < 0.9 <= grown


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    same = [1.0, 2.0]
    rows = [
        (0, same), (1, same), (2, same), (3, [0.5, -0.0]), (4, [0.5, 0.0]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]),
        (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0]), (None, [9.0, 9.0]), (20, [-1.0, 0.5]), (20, [-1.0, 0.5]), (40, []),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, rank string, id int")
    got = found(prefix_forest.nearest(spark, df, F.col("vec_id") % 20 == 0, 3))
    assert got.keys() == {0, 20}
    assert got[0] == [(1, 5.0), (2, 5.0), (3, 0.5)]
    assert got[20] == [(0, 0.0), (1, 0.0), (2, 0.0)]
    every = found(prefix_forest.nearest(spark, df, F.col("vec_id") == 20, 50))
    assert [i for i, _ in every[20]] == [0, 1, 2, 3, 4]
    assert prefix_forest.nearest(spark, df.limit(0), F.col("vec_id") == 0).count() == 0


def test_prefix_ranges_are_found_by_binary_search():
    rng = np.random.default_rng(1)
    bits = prefix_forest.symbol_bits(3)
    strings = np.sort(rng.integers(0, 1 << (bits * prefix_forest.SYMBOLS), 500))
    for level in range(1, prefix_forest.SYMBOLS + 1):
        shift = bits * (prefix_forest.SYMBOLS - level)
        for h in strings[::50]:
            lo, hi = prefix_forest._range(strings, h, level, bits)
            assert (np.flatnonzero(strings >> shift == h >> shift) == np.arange(lo, hi)).all()


# -- pipeline ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(spark, stage(spark, out[-1], SF)))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "mixture", "pieces"]
    assert all(s.columns == steps[0].columns for s in steps[1:-1])


def test_quality_stage_keeps_what_scores_well(spark, steps):
    scores = {r.doc_id: r.score for r in QUERIES["op9_quality_rff"](spark, SF).collect()}
    assert by_id(steps[1]).keys() == {d for d, s in scores.items() if s >= GOOD}


def test_line_stage_takes_out_what_the_operator_does(spark, steps):
    want = {
        r.doc_id: r.text
        for r in line_dedup.dedup_lines(spark, steps[1]).collect()
        if r.n_removed == 0 or r.text.strip(" ")
    }
    got = by_id(steps[2])
    assert {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_near_duplicate_stage_keeps_one_of_each(spark, steps):
    groups = {}
    for r in simhash.near_duplicates(spark, steps[2]).collect():
        groups.setdefault(r.component_id, set()).add(r.doc_id)
    assert by_id(steps[3]).keys() == {min(g) for g in groups.values()}


def test_near_duplicate_stage_against_brute_force(spark):
    """Copies with one to six changed words of 120: five-word shingles, Jaccard 0.8."""
    rng = np.random.default_rng(8)
    rows, pairs = [], []
    for k in range(90):
        words = [f"w{x}" for x in rng.integers(0, 3000, 120)]
        copy = list(words)
        for at in rng.choice(120, 1 + k % 6, replace=False):
            copy[at] = f"new{at}"
        a, b = ({tuple(w[i : i + 5]) for i in range(116)} for w in (words, copy))
        pairs.append(len(a & b) / len(a | b) >= 0.8)
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(copy))]
    df = spark.createDataFrame([(*r, "en", "src0", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = by_id(corpus_pipeline.one_of_each(spark, df, SF)).keys()
    found = [2 * k + 1 not in left for k in range(90)]
    assert all(2 * k in left for k in range(90)) and not any(f and not p for f, p in zip(found, pairs))
    assert sum(found) >= 0.95 * sum(pairs) > 0


def test_near_duplicates_come_through_golay_keys(spark):
    """Every Golay codeword is decoded, with up to three wrong bits; alike texts share a key and stay within the radius."""
    words = simhash.golay_codewords()
    assert np.unique(np.bitwise_count(words[1:] ^ words[0])).tolist() == [8, 12, 16, 24]
    rng = np.random.default_rng(3)
    signs = np.where(words[:, None] >> np.arange(24) & 1, 1, -1)
    right = near_texts.decoded(signs)
    assert len(np.unique(right)) == 4096
    for row in signs:
        row[rng.choice(24, 3, replace=False)] *= -1
    assert (near_texts.decoded(signs) == right).all()

    found, close, n = 0, 0, 0
    for _ in range(300):
        text = [f"w{x}" for x in rng.integers(0, 3000, 120)]
        at = rng.integers(0, 112)
        a, b = (near_texts.shingles(" ".join(t))[1] for t in (text, [*text[:at], *["new"] * 8, *text[at + 8 :]]))
        if not near_texts.alike(a, b):
            continue
        v, w = near_texts.votes(a), near_texts.votes(b)
        x, y = (near_texts.segment_keys(near_texts.decoded(k[: 24 * near_texts.SEGMENTS])[None])[0] for k in (v, w))
        found, close, n = found + bool((x == y).any()), close + (((v > 0) != (w > 0))[:64].sum() <= near_texts.RADIUS), n + 1
    assert n > 250 and found >= 0.97 * n and close >= 0.98 * n

    # Votes of more shingles than one byte lane holds.
    hashes = rng.integers(0, 1 << 63, 700).astype(np.uint64)
    plain = [((near_texts._mixed(h ^ near_texts._SALTS)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).ravel() for h in hashes]
    assert (near_texts.votes(hashes) == 2 * np.sum(plain, axis=0, dtype=np.int64) - 700).all()


def test_mixture_keeps_all_and_pieces_decode(steps):
    assert by_id(steps[3]) == by_id(steps[4])
    last = by_id(steps[5])
    assert last.keys() == by_id(steps[4]).keys() and all(r.round_trip and len(r.ids) == r.n_pieces for r in last.values())


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_and_empty_tables(spark, k):
    rows = [(1, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c d e f", "en", None, 11), (2, "a b c d e f", "en", None, 11), (None, "x", None, "", 1)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, fp string, _row int")
    _, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, df, SF)
    assert out.count() >= 1 and (k == 4 or out.columns == df.columns)
    assert stage(spark, df.limit(0), SF).count() == 0


def test_run_gives_the_last_stage(spark, steps):
    assert by_id(corpus_pipeline.run(spark, SF)).keys() == by_id(steps[5]).keys()


def test_prefixes_of_the_result_hold_the_weights(spark):
    """A hot source, and stages that are written and read again; until the first source runs out."""
    n = {"src0": 300, "src1": 60, "src2": 60, "src3": 40, "other": 20}
    named = [s for s, k in n.items() for _ in range(k)]
    df = spark.createDataFrame([(k, f"text {k}", "en", s, 6) for k, s in enumerate(named)], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[3:]:
        df = stored(spark, stage(spark, df, SF))
    rows = sorted(df.select("source", "position").collect(), key=lambda r: r.position)
    assert [r.position for r in rows] == list(range(len(named)))
    tickets = {s: corpus_pipeline.TICKETS.get(s, 1) for s in n}
    ends = min(max(r.position for r in rows if r.source == s) for s in n)
    assert ends > 150
    for k in range(1, ends + 1):
        for s in n:
            share = k * tickets[s] / sum(tickets.values())
            assert abs(sum(r.source == s for r in rows[:k]) - share) < 2 * corpus_pipeline.BLOCK_ROWS
