"""Hard negatives, source divergence and license scan against plain code."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbgrid.llm import four_russians, license_scan, source_audit
from orbgrid.llm.byte_words import byte_class, split_words

NAN, INF = float("nan"), float("inf")


# -- hard negatives -------------------------------------------------------------------------------


def plain_negatives(rows, positives=5, negatives=5):
    """Rows of (id, vector, label) as the operator takes part."""
    use = [
        (i, [math.floor(256 * x) for x in v], lab)
        for i, v, lab in rows
        if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, v, lab in use:
        if i % 100:
            continue
        near = sorted((-dot(v, w), j) for j, w, m in use if m == lab and j != i)[:positives]
        far = sorted((-dot(v, w), j) for j, w, m in use if m != lab and j != i)
        for s, p in near:
            fits = [(t, j) for t, j in far if 80 * -s <= 100 * -t <= 100 * -s][:negatives]
            out += [(i, p, k, j, -s, -t) for k, (t, j) in enumerate(fits, 1)]
    return sorted(out)


def found_negatives(spark, rows, kind="array<float>", **more):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, label int").withColumns(
        {c: F.lit("x") for c in ("row", "key", "x", "planes", "slab", "own", "score", "rank")}
    )
    out = four_russians.hard_negatives(spark, df, F.col("vec_id") % 100 == 0, F.col("label"), **more)
    return sorted(map(tuple, out.collect()))


def test_negatives_of_odd_rows(spark):
    """Nulls, non-finite numbers, short and empty vectors, ties, repeated ids, negative scores."""
    rng = np.random.default_rng(5)
    grid = lambda: [float(np.float32(x)) for x in rng.integers(-3, 4, 11) / 8]
    rows = [(k, grid(), int(rng.integers(0, 3))) for k in range(420)]
    rows += [(200, grid(), 1), (200, rows[200][1], rows[200][2]), (7, rows[7][1], rows[7][2])]
    rows += [(None, grid(), 1), (500, None, 1), (600, grid(), None), (700, [1.0, NAN], 1), (800, [INF], 1), (900, [None, 1.0], 1)]
    rows += [(1000, [], 1), (1100, [0.5, 0.25], 2), (1101, [-2.0] * 13, 2), (1200, [-1.0] * 13, 0), (1300, grid(), 9)]
    assert found_negatives(spark, rows) == plain_negatives(rows)


def test_negatives_in_many_slabs(spark, monkeypatch):
    """Slabs and anchor blocks far smaller than a hot label."""
    monkeypatch.setattr(four_russians, "SLAB_ROWS", 90)
    monkeypatch.setattr(four_russians, "BLOCK_ANCHORS", 3)
    rng = np.random.default_rng(6)
    rows = [(k, [float(np.float32(x)) for x in rng.standard_normal(16) + 0.7], 0 if rng.random() < 0.5 else int(rng.integers(1, 5))) for k in range(1500)]
    assert found_negatives(spark, rows) == plain_negatives(rows)


def test_scores_are_exact_at_any_size():
    rng = np.random.default_rng(7)
    for top in (1, 200, 1 << 13, 1 << 24):
        a, c = rng.integers(-top, top + 1, (9, 24)), rng.integers(-top, top + 1, (50, 24))
        a[0], c[0] = -top, -top
        planes = four_russians.to_planes(c, int(top).bit_length() + 1)
        assert (four_russians.scores(four_russians.subset_sums(a), planes, np.int64) == c @ a.T).all()


def test_negatives_empty_and_too_large(spark):
    assert found_negatives(spark, []) == []
    assert found_negatives(spark, [(None, None, None)]) == []
    with pytest.raises(ValueError, match="fit a long"):
        found_negatives(spark, [(0, [1e300], 1)], "array<double>")


# -- source divergence ----------------------------------------------------------------------------


def plain_audit(rows, min_docs=10, top=10):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))) for text, lang, source in rows]
    seen, every, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        seen[lang].update(set(terms))
        every[lang].update(terms)
        groups[lang, source].update(terms)
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in seen[lang].items() if n >= min_docs]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        own = {s: shares(c) for (x, s), c in groups.items() if x == lang}
        q = shares(every[lang])
        for s, p in own.items():
            pair = sorted((-sum(f(p[t], r[t]) for t in kept), o.encode(), o) for o, r in own.items() if o != s)
            term = sorted((-f(p[t], q[t]), t.encode(), t) for t in kept if groups[lang, s][t] and p[t] > q[t])[:top]
            out += [(lang, s, part, o, -v, k) for part, xs in (("pair", pair), ("term", term)) for k, (v, _, o) in enumerate(xs, 1)]
    return sorted(out)


def found_audit(spark, rows, **more):
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({c: F.lit(1) for c in ("term", "n", "id", "p", "value", "key")})
    return sorted(map(tuple, source_audit.audit(spark, df, **more).collect()))


def test_audit_of_odd_rows(spark):
    """Nulls, groups without terms, a language without kept terms, one of one source, characters beyond ASCII, repeats."""
    rng = np.random.default_rng(8)
    words = ["Alpha", "beta", "ÄRGER", "naïve", "x", "Ümlaut", "日本語", "don't", "zwei2drei", *[f"w{chr(97 + k)}" for k in range(20)]]
    text = lambda n: " ".join(rng.choice(words, n, p=np.arange(len(words), 0, -1) / sum(range(len(words) + 1))))
    rows = [(text(int(rng.integers(0, 60))), str(rng.choice(["en", "de"])), f"s{rng.integers(0, 6)}") for _ in range(300)]
    rows += [(None, "en", "empty"), ("", "en", "é"), ("1 2 3", "en", "digits"), (None, None, None), ("alpha beta", None, "s1"), ("alpha", "fr", "one"), ("beta", "fr", "two")]
    rows += [("only source", "it", "s0")] * 12 + [(text(3000), "en", "s1"), ("-" * 100_000, "de", "s2")]
    assert found_audit(spark, rows) == plain_audit(rows)


def test_audit_over_many_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "BLOCK_IDS", 128)
    monkeypatch.setattr(source_audit, "CHUNK_GROUPS", 4)
    monkeypatch.setattr("orbgrid.llm.byte_words.SLICE_BYTES", 2000)
    rng = np.random.default_rng(9)
    name = lambda k: "".join(chr(97 + int(d)) for d in str(k))
    rows = [(" ".join(name(int(k)) for k in rng.zipf(1.3, 40) % 700), "en", f"s{0 if rng.random() < 0.3 else rng.integers(1, 11)}") for _ in range(600)]
    assert found_audit(spark, rows, min_docs=3) == plain_audit(rows, min_docs=3)


def test_audit_empty(spark):
    assert found_audit(spark, []) == []


# -- license scan ---------------------------------------------------------------------------------


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    starts = [(n, k) for n, t in license_scan.PHRASES for k in range(len(words)) if words[k : k + len(t.split())] == t.split()]
    met = [(n, 1.0) for n, _ in starts]
    for n, t in license_scan.NOTICES:
        want = set(license_scan.words_of(t))
        for at in range(0, len(words), license_scan.STEP_WORDS):
            share = len(want & set(words[at : at + license_scan.BLOCK_WORDS])) / len(want)
            if share >= license_scan.CONTAINMENT:
                met.append((n, share))
    at = [k for _, k in starts]
    return (
        len(words), len(at), min(at, default=None), max(at, default=None),
        ",".join(sorted({n for n, _ in starts})), ",".join(sorted({n for n, _ in met})), max([s for _, s in met], default=0.0),
    )


def test_scan_of_odd_texts(spark):
    """Nulls, phrases at every distance from a block's edge, templates with words missing, long and empty texts."""
    rng = np.random.default_rng(10)
    noise = lambda n: " ".join(rng.choice(["the", "license", "under", "by", "software", "é", "Lorem", "2"], n))
    phrases, notices = [t for _, t in license_scan.PHRASES], [t for _, t in license_scan.NOTICES]
    texts = [None, "", "...", "UNDER THE MIT LICENSE", "under the mit licenses", "cc-BY-nc", "cc by nc by nc cc by nc", "mit the under license"]
    texts += [f"{noise(k)} {phrases[k % 3]} {noise(int(rng.integers(0, 60)))}" for k in range(0, 150, 3)]
    for t in notices:
        words = t.split()
        for drop in (0, 1, 2, 4, 8):
            kept = [w for k, w in enumerate(words) if k not in set(rng.choice(len(words), drop, replace=False).tolist())]
            texts.append(f"{noise(int(rng.integers(0, 100)))}\n{' '.join(kept)}\n{noise(30)}")
    texts += [noise(40_000) + " Apache License, Version 2.0 " + notices[0], "mit " * 5000, texts[8], texts[8]]
    rows = [(None if k == 3 else k // 2, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(0) for c in ("id", "n_words", "matches", "labels", "score")})
    got = license_scan.summary(license_scan.scan(spark, df)).collect()
    want = [(i, *plain_scan(t)) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r.labels for r in got} >= {"mit", "gpl-3", "apache-2,mit"}


def test_scan_empty_and_template_bounds(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert license_scan.scan(spark, empty).count() == 0
    with pytest.raises(ValueError, match="words"):
        license_scan.scan(spark, empty, notices=[("long", "word " * 200)])


def test_frequency_order_never_decides():
    rng = np.random.default_rng(3)
    pairs = rng.integers(0, 40, (3000,)), None
    base = license_scan.Templates.of(license_scan.PHRASES, license_scan.NOTICES, 0.6)
    results = []
    for seed in (0, 1):
        t = base.ordered({w: int(n) for w, n in zip(base.vocabulary, np.random.default_rng(seed).permutation(len(base.vocabulary)), strict=True)})
        words = np.random.default_rng(4).choice(base.vocabulary, 3000)
        block, template, shared = license_scan.join_blocks(pairs[0], np.array([t.number[w] for w in words]), t)
        results.append(sorted(zip(block.tolist(), [t.labels[k] for k in template], shared.tolist(), strict=True)))
    assert results[0] == results[1] and results[0]


def test_words_of_bytes():
    import pyarrow as pa

    words, row = split_words(pa.array(["Ab c", None, "", "é1É", "x"]).slice(0, 5), byte_class(license_scan.WORD_CHARS))
    assert words.to_pylist() == ["ab", "c", "é1É", "x"] and row.tolist() == [0, 0, 3, 4]
